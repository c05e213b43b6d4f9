"""Exact removal of repeated byte passages with suffix arrays.

A byte goes when it is covered by a ``least``-byte string that also starts in a document with a
smaller doc_id. Every such string holds one anchor, the place of the smallest hash among its
``ANCHOR``-byte strings, which depends on the string alone; strings of a document with the same
anchor form a window (67 bytes on average). Equal strings therefore meet under equal anchors:

1. (anchor hash, window hash, sides, doc_id) rows are sorted by anchor and streamed. Of equal
   windows all documents but the first lose every string of it. Where an anchor has several
   different windows, the first document of each sends its window on, unless the sides show that
   the window shares no string with any other of the anchor (``_sides``; nothing shared is missed).
2. These windows are dealt by anchor into shards of about ``shard_bytes``; each shard's text gets
   its suffix array by induced sorting and its common prefixes in text order. Neighbouring
   suffixes with ``least`` bytes in common are one string; those whose document is not the
   string's smallest lose it.
3. The lost strings of a document, as ranges of places, are joined to its text, and it is cut.

An anchor with more than ``hot_windows`` different windows would not fit a shard's bound; its
strings are counted one by one (smallest document a string, by a partial aggregate) instead.

Defined cases: NULL text counts as empty; rows with a NULL doc_id lose nothing and take nothing;
rows that repeat a doc_id never remove each other; texts shorter than ``least`` bytes stay; bytes
are those of UTF-8 and the kept bytes need not be valid UTF-8; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Powers, by_id, map_texts, mix, release, written
from tickforge.llm.suffix_array import common_prefixes, suffix_array, words8

LEAST, ANCHOR = 50, 16
SHARD_BYTES = 1_000_000
HOT_WINDOWS = 10_000
SIDES = 4
#: Places told apart in the low bits of a packed (hash, place); longer texts are read in pieces.
_PLACE_BITS = 23
_ODD = np.uint64(0x9E3779B97F4A7C15)


def windows(raw: bytes, sizes: np.ndarray, powers: Powers, least: int = LEAST):
    """The windows of the texts joined in ``raw`` (their byte counts in ``sizes``): (text, first
    and last start of its strings within ``raw``, anchor hash, window hash), as arrays."""
    return _windows(raw, sizes, powers, least)[:5]


def _sides(chain: np.ndarray, down: np.ndarray, start: np.ndarray, stop: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """What a window can share with another one of its anchor, as ``SIDES`` keys of 16 bits. A
    string reaches some bytes left of the anchor and the rest right of it, so two windows that
    hold it agree in one of ``SIDES`` splits: in so many bytes left and in all but a few of the
    others right. A key is 0 where the window does not reach that far."""
    more = least - ANCHOR
    step = -(-(more + 1) // SIDES)
    out = np.zeros(len(start), dtype=np.uint64)
    for k in range(SIDES):
        left, right = k * step, max(0, more - (k + 1) * step + 1)
        reaches = (at - left >= start) & (at + right + ANCHOR <= stop + least)
        a, b = at[reaches] - left, at[reaches] + right + ANCHOR
        with np.errstate(over="ignore"):
            key = mix((chain[b - 7] - chain[a]) * down[a]) % np.uint64(0xFFFF) + np.uint64(1)
        out[reaches] |= key << np.uint64(16 * k)
    return out


def _windows(raw: bytes, sizes: np.ndarray, powers: Powers, least: int):
    """``windows``, and the sides of each."""
    b = np.frombuffer(raw, dtype=np.uint8)
    n, strings = len(b), len(b) - least + 1
    none = np.zeros(0, dtype=np.int64)
    if strings <= 0:
        return none, none, none, *[none.view(np.uint64)] * 3
    if strings > 1 << _PLACE_BITS:  # one very long text (or several): in pieces that share no string
        step, parts, ends = 1 << _PLACE_BITS, [], np.cumsum(sizes)
        for at in range(0, strings, step):
            to = min(n, at + step + least - 1)
            first, last = np.searchsorted(ends, at, side="right"), np.searchsorted(ends, to - 1, side="right")
            own = np.diff(np.clip(np.concatenate([[0], ends[first : last + 1]]), at, to))
            own[0] = min(ends[first], to) - at
            text, lo, hi, *hashes = _windows(raw[at:to], own, powers, least)
            parts.append((text + first, lo + at, hi + at, *hashes))
        return tuple(np.concatenate(x) for x in zip(*parts))
    up, down = powers.get(n + 1)
    x = words8(b)
    with np.errstate(over="ignore"):
        m = mix(x)
        # Hash of the ANCHOR (two times eight) bytes from each place on.
        h = mix(m[: n - 8] * _ODD + x[8:])[: n - ANCHOR + 1]
        chain = np.concatenate([[np.uint64(0)], np.cumsum(m * up[:n])])
    place = np.uint64((1 << _PLACE_BITS + 1) - 1)
    low = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    # Smallest (hash, place) among the anchors of each string, by doubling.
    width, have = least - ANCHOR + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    at = (np.minimum(low[:strings], low[width - have : width - have + strings]) & place).astype(np.int64)
    # Strings that lie inside one text, and where the anchor or the text changes.
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)[:strings]
    inside = np.arange(strings) + least <= ends[text]
    start = np.flatnonzero(inside & np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    if not len(start):
        return none, none, none, *[none.view(np.uint64)] * 3
    change = np.flatnonzero(np.concatenate([(at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~inside[1:], [True]]))
    stop = change[np.searchsorted(change, start)]
    with np.errstate(over="ignore"):
        window = mix((chain[stop + least - 7] - chain[start]) * down[start] + (stop - start).astype(np.uint64))
    return text[start], start, stop, h[at[start]], window, _sides(chain, down, start, stop, at[start], least)


def _joined(texts: list[str | None]) -> tuple[list[bytes], bytes, np.ndarray]:
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    return parts, b"".join(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))


def _anchors(docs: DataFrame, least: int) -> DataFrame:
    powers = Powers()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, raw, sizes = _joined(batch.column(1).to_pylist())
        text, _, _, *hashes = _windows(raw, sizes, powers, least)
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[text]
        return pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in hashes], pa.array(ids)], ["anchor", "window", "sides", "doc_id"])

    return map_texts(docs.where(F.col("doc_id").isNotNull()), run, "anchor long, window long, sides long, doc_id long")


def _to_compare(a, w, s, d):
    """The heads of windows (sorted by anchor; w and s their hashes and sides, d their documents)
    that share a side with another window of their anchor, where the documents differ."""
    first = np.concatenate([[True], a[1:] != a[:-1]])
    head = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    several = np.flatnonzero((np.minimum.reduceat(d, head) < np.maximum.reduceat(d, head))[group])
    agree = np.zeros(len(several), dtype=bool)
    for k in range(SIDES):
        side = (s[several].view(np.uint64) >> np.uint64(16 * k)) & np.uint64(0xFFFF)
        _, which, count = np.unique((group[several].astype(np.uint64) << np.uint64(16)) | side, return_inverse=True, return_counts=True)
        agree |= (side > 0) & (count[which] > 1)
    return several[agree]


def _judge(batches):
    """Rows sorted by (anchor, window, doc_id) -> (doc_id, anchor, window, whole): documents that
    lose the whole window, and first documents of windows that must be compared."""
    names = ["doc_id", "anchor", "window", "whole"]
    none = np.zeros(0, dtype=np.int64)
    waiting = (none,) * 4  # anchor, window, sides, first document of each window of the open anchor
    window = first = None  # the open window and its first document

    def rows(d, a, w, whole):
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(w), pa.array(np.full(len(d), whole))], names)

    for batch in batches:
        a, w, s, d = (batch.column(i).to_numpy() for i in range(4))
        if not len(a):
            continue
        new = np.concatenate([[not len(waiting[0]) or a[0] != waiting[0][-1] or w[0] != window], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
        heads = np.flatnonzero(new)
        smallest = np.concatenate([[first if first is not None else 0], d[heads]])[np.cumsum(new)]
        lose = (d > smallest) & np.concatenate([[True], (d[1:] != d[:-1]) | new[1:]])
        if lose.any():
            yield rows(d[lose], a[lose], w[lose], True)
        known = tuple(np.concatenate([x, y[heads]]) for x, y in zip(waiting, (a, w, s, d)))
        open_ = np.searchsorted(known[0], a[-1])
        closed, waiting = tuple(x[:open_] for x in known), tuple(x[open_:] for x in known)
        if open_:
            pick = _to_compare(*closed)
            if len(pick):
                yield rows(closed[3][pick], closed[0][pick], closed[1][pick], False)
        window, first = w[-1], smallest[-1]
    if len(waiting[0]):
        pick = _to_compare(*waiting)
        if len(pick):
            yield rows(waiting[3][pick], waiting[0][pick], waiting[1][pick], False)


def _cut(raw: bytes, first: np.ndarray, last: np.ndarray, least: int) -> tuple[int, int, str]:
    """(removed bytes, maximal runs, digest of the rest) when the strings that start from each
    place of ``first`` to that of ``last`` go."""
    if not len(first):
        return 0, 0, hashlib.sha256(raw).hexdigest()
    n = len(raw)
    edge = np.bincount(first, minlength=n + 1) - np.bincount(last + least, minlength=n + 1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()).hexdigest()


def _ranges(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last numbers of the runs of consecutive numbers in ``at`` (sorted)."""
    step = np.flatnonzero(np.diff(at) != 1)
    return at[np.concatenate([[0], step + 1])].astype(np.int32), at[np.append(step, len(at) - 1)].astype(np.int32)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all entries of a list column."""
    row = pa.compute.list_parent_indices(column)
    return row.to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)


_FINAL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _apply(verdicts: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """Texts with their verdicts: final rows, and (``raw`` not NULL) windows to be compared, or
    texts that wait for them (``window`` NULL)."""
    per_doc = verdicts.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("window").alias("windows"), F.collect_list("whole").alias("whole"))
    rows = docs.join(per_doc, "doc_id", "left").select("doc_id", "text", "anchors", "windows", "whole")
    powers = Powers()
    schema = _FINAL + ", key long, anchor long, start int, raw binary, first array<int>, last array<int>"
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), *[pa.list_(pa.int32())] * 2]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, raw, sizes = _joined(batch.column(1).to_pylist())
        ids = batch.column(0).to_pylist()
        text, lo, hi, h, w = windows(raw, sizes, powers, least)
        h, w = h.view(np.int64), w.view(np.int64)
        # What is said of a window is looked up by one number, and compared in full.
        row, anchors = _lists(batch.column(2))
        said = (row, anchors, _lists(batch.column(3))[1])
        whole = _lists(batch.column(4))[1].astype(bool)
        gone = ask = np.zeros(len(text), dtype=bool)
        if len(row):
            with np.errstate(over="ignore"):
                name, mine = (mix(x.astype(np.uint64) * _ODD + mix(a.view(np.uint64)) + b.view(np.uint64)) for x, a, b in (said, (text, h, w)))
            order = np.argsort(name)
            at = order[np.minimum(np.searchsorted(name[order], mine), len(name) - 1)]
            told = (said[0][at] == text) & (said[1][at] == h) & (said[2][at] == w)
            gone, ask = told & whole[at], told & ~whole[at]
        begin = np.cumsum(sizes) - sizes
        cut = np.searchsorted(text, np.arange(len(sizes) + 1))
        out = []
        for i, (doc_id, own) in enumerate(zip(ids, parts)):
            k = slice(cut[i], cut[i + 1])
            first, last = lo[k] - begin[i], hi[k] - begin[i]
            lost, compare = gone[k], np.flatnonzero(ask[k])
            if not len(compare):
                out.append((doc_id, len(own), *_cut(own, first[lost], last[lost], least), None, None, None, None, None, None))
                continue
            # A doc_id may come with several texts: the key tells them apart.
            key = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little", signed=True)
            out.append((doc_id, len(own), None, None, None, key, None, None, own, first[lost].astype(np.int32), last[lost].astype(np.int32)))
            for a, f, l in zip(h[k][compare].tolist(), first[compare].tolist(), last[compare].tolist()):
                out.append((doc_id, None, None, None, None, key, a, f, own[f : l + least], None, None))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return map_texts(rows, run, schema)


def repeated_in_shard(pieces: list[bytes], owners: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For each piece the starts of its ``least``-byte strings that also occur in a piece of a
    smaller owner, from the suffix array of all pieces."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    ends = np.cumsum(sizes + 1)  # a separator behind each piece
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    t = np.empty(len(raw) + 1, dtype=np.int64)
    t[:-1], t[-1] = raw.astype(np.int64) + 2, 0
    t[ends - 1] = 1
    sa = suffix_array(t, 258)[1:]
    before = np.full(len(raw), -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    room = ends[piece] - 1 - np.arange(len(raw))  # bytes left in the piece
    shared = common_prefixes(raw, before, least)
    shared = np.minimum(shared, room)
    shared[before >= 0] = np.minimum(shared[before >= 0], room[before[before >= 0]])
    sa = sa[room[sa] >= least]
    if not len(sa):
        return [np.zeros(0, dtype=np.int64) for _ in pieces]
    # Neighbours with ``least`` bytes in common are the same string.
    head = np.flatnonzero(np.concatenate([[True], shared[sa[1:]] < least]))
    owner = owners[piece[sa]]
    smallest = np.repeat(np.minimum.reduceat(owner, head), np.diff(np.append(head, len(sa))))
    gone = np.sort(sa[owner > smallest])
    which = piece[gone]
    begin = ends - sizes - 1
    cut = np.searchsorted(which, np.arange(len(pieces) + 1))
    return [gone[a:b] - begin[i] for i, (a, b) in enumerate(zip(cut, cut[1:]))]


def _compare(found: DataFrame, least: int, shard_bytes: int, hot_windows: int) -> DataFrame:
    """(doc_id, key, first, last): runs of strings of compared windows that occur in a smaller document."""
    rows = found.where(F.col("anchor").isNotNull()).select("doc_id", "key", "anchor", "start", "raw")
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    hot = written(rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot_windows).select("anchor"), "repeats-hot")
    shards = max(1, -(-total // shard_bytes))
    dealt = rows.join(hot, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "doc_id", "key", "start"], ignore_index=True)
        got = repeated_in_shard(pdf["raw"].tolist(), pdf["doc_id"].to_numpy(), least)
        start = pdf["start"].to_numpy()
        keep = [i for i, g in enumerate(got) if len(g)]
        found = [_ranges(got[i] + start[i]) for i in keep]
        n = [len(f) for f, _ in found]
        ends = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int32)] * 2
        return pd.DataFrame({"doc_id": np.repeat(pdf["doc_id"].to_numpy()[keep], n), "key": np.repeat(pdf["key"].to_numpy()[keep], n), "first": ends[0], "last": ends[1]})

    lost = dealt.select("doc_id", "key", "anchor", "start", "raw", "shard").groupBy("shard").applyInPandas(run, "doc_id long, key long, first int, last int")
    if hot.isEmpty():
        return lost
    at = F.explode(F.sequence(F.lit(0), F.octet_length("raw") - least))
    one = rows.join(hot, "anchor", "left_semi").select("doc_id", "key", "start", "raw", at.alias("at"))
    one = one.select("doc_id", "key", (F.col("start") + F.col("at")).alias("start"), F.substring("raw", F.col("at") + 1, F.lit(least)).alias("string"))
    low = one.groupBy("string").agg(F.min("doc_id").alias("low"))
    more = one.join(low, "string").where("doc_id > low").select("doc_id", "key", F.col("start").cast("int").alias("first"), F.col("start").cast("int").alias("last"))
    return lost.unionByName(more)


def remove_repeats(documents: DataFrame, *, least: int = LEAST, shard_bytes: int = SHARD_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    docs = by_id(documents)
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    anchors = _anchors(docs, least).repartition(n, "anchor").sortWithinPartitions("anchor", "window", "doc_id")
    verdicts = written(anchors.mapInArrow(_judge, "doc_id long, anchor long, window long, whole boolean"), "repeats-verdicts")
    found = written(_apply(verdicts, docs, least), "repeats-found")
    release(verdicts)
    # Firsts and lasts only count in and out of strings, so their order does not matter.
    lost = _compare(found, least, shard_bytes, hot_windows).groupBy("doc_id", "key").agg(F.collect_list("first").alias("lost_first"), F.collect_list("last").alias("lost_last"))
    final = found.where(F.col("kept_sha256").isNotNull()).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    waiting = found.where(F.col("n_bytes").isNotNull() & F.col("kept_sha256").isNull()).select("doc_id", "key", "raw", "first", "last").join(lost, ["doc_id", "key"], "left")

    def cut(batches):
        names = [x.split()[0] for x in _FINAL.split(", ")]
        for batch in batches:
            rows = np.arange(batch.num_rows + 1)
            ends = []
            for i in (2, 3, 4, 5):
                row, at = _lists(batch.column(i))
                ends.append((at, np.searchsorted(row, rows)))
            out = []
            for r, (doc_id, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                first, last, more, more_last = (at[c[r] : c[r + 1]] for at, c in ends)
                out.append((doc_id, len(raw), *_cut(raw, np.concatenate([first, more]), np.concatenate([last, more_last]), least)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])], names)

    return final.unionByName(waiting.select("doc_id", "raw", "first", "last", "lost_first", "lost_last").mapInArrow(cut, _FINAL))
