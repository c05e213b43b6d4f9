"""Ranked lexical search with Block-Max MaxScore over an inverted index in shards.

``build_index`` reads the texts once for their counts (documents with terms, all terms) and once
for the index: each task cuts its documents into shards of up to ``shard_chars`` code points and
writes a row a term: the postings in blocks of ``BLOCK``, compressed (differences of places and
occurrences as variable-length integers), with each block's last place and largest impact. The
impact of a posting is all of a score but the term's weight, so an index serves any query.

``search`` joins the lists with the terms of the items (items in blocks of ``item_block``) and
searches every shard for every item. The lists of the largest bounds give a first threshold. Global
bounds then part the lists: those whose bounds together stay below the threshold are not essential,
as no document of theirs alone can reach it. Documents of the essential lists are candidates; the
block maxima of the other lists at their places reject those that cannot reach the threshold,
before any block of these lists is decompressed; the rest are scored exactly. A document that may
tie with the threshold stays. The best of all shards are merged.

Defined cases: a NULL or empty text has no terms and is no document of the statistics; a document
row that repeats is ranked each time; a NULL doc_id ranks behind others of its score; rows that
repeat an item_id are one item with all their terms, rows without an item_id none; items without a
document above 0 give no rows; ties go to the smaller doc_id; extra columns, whatever their names,
play no part; texts of any length are indexed whole; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, map_texts, written

TOP = 20
BLOCK = 128
SHARD_CHARS = 16_000_000
#: Most documents of a shard (places are kept as 32-bit numbers).
SHARD_DOCS = 65_536
ITEM_BLOCK = 500
#: Distinct terms of the items up to which they are broadcast (some 40 bytes each); more go
#: through a shuffle.
BROADCAST_TERMS = 200_000

# Fixed values of the score: terms, scale of weights and impacts, and length normalisation.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_IN_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_IMPACT = 1_000_000_000


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


def length_norm(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    return 75 + (25 * n * docs) // terms


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (_IMPACT * tf) // (1000 * tf + 12 * norm)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass
class Index:
    rows: DataFrame  # shard, term (NULL: the shard's documents), df, top, last, tops, at, data
    docs: int
    terms: int


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Documents with terms, and terms of all."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = term_counts(batch.column(1))
        return pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["docs", "terms"])

    row = map_texts(docs, count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def term_counts(texts: pa.Array) -> np.ndarray:
    """Terms of each text (NULL: none), from its bytes."""
    n = len(texts)
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer("".join(t or "" for t in texts.to_pylist()).encode(), dtype=np.uint8)
    inside = _IN_TERM[raw]
    begin = np.cumsum(sizes) - sizes
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[begin] = True  # a term does not go on into the next text
    start = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | first[:-1]))
    return np.bincount(np.searchsorted(begin + sizes, start, side="right"), minlength=n) if len(start) else np.zeros(n, dtype=np.int64)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes (seven bits each, low ones first) and the number for each value."""
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 9):
        size += values >= 1 << 7 * k
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for k in range(int(size.max(initial=1))):
        own = size > k
        out[at[own] + k] = (values[own] >> 7 * k & 127) | np.where(size[own] > k + 1, 128, 0)
    return out, size


def unpack(raw: np.ndarray) -> np.ndarray:
    last = raw < 128
    start = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    nth = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * nth, start)


_INDEX = "shard long, term string, df long, top long, last array<int>, tops array<long>, at array<int>, data binary"


class _Shard:
    """Postings of the documents met since the last shard was closed."""

    def __init__(self, docs: int, terms: int):
        self.docs, self.terms = docs, terms
        self.clear()

    def clear(self):
        self.words: dict[str, int] = {}
        self.word, self.tf, self.sizes, self.ids, self.lengths, self.chars = [], [], [], [], [], 0

    def add(self, doc_id: int | None, text: str | None):
        counts = Counter(terms_of(text))
        self.chars += len(text or "")
        if counts:
            words = self.words
            self.word.append(np.fromiter((words.setdefault(t, len(words)) for t in counts), dtype=np.int32, count=len(counts)))
            self.tf.append(np.fromiter(counts.values(), dtype=np.int64, count=len(counts)))
            self.sizes.append(len(counts))
            self.ids.append(doc_id)
            self.lengths.append(counts.total())

    def full(self, shard_chars: int) -> bool:
        return self.chars >= shard_chars or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int):
        """The shard as record batches, terms in order; and an empty shard again."""
        if not self.ids:
            self.clear()
            return
        words = np.array(sorted(self.words), dtype=object)
        rank = np.empty(len(words), dtype=np.int32)
        rank[[self.words[w] for w in words]] = np.arange(len(words), dtype=np.int32)
        word, tf = rank[np.concatenate(self.word)], np.concatenate(self.tf)
        place = np.repeat(np.arange(len(self.ids)), self.sizes)
        ids, n = self.ids, np.array(self.lengths, dtype=np.int64)
        self.clear()
        order = np.argsort(word, kind="stable")
        word, tf, place = word[order], tf[order], place[order]
        norm = length_norm(n, self.docs, self.terms)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        df = np.diff(np.append(first, len(word)))
        impact = impacts(tf, norm[place])
        # Blocks: every BLOCK postings of a list. A block's first difference is from its own base,
        # so that each can be read alone.
        nth = np.arange(len(word)) - np.repeat(first, df)
        head = np.flatnonzero(nth % BLOCK == 0)
        size = np.diff(np.append(head, len(word)))
        step = np.concatenate([[0], place[1:] - place[:-1]])
        step[head] = place[head]
        raw, bytes_of = pack(np.stack([step, tf - 1], axis=1).ravel())
        ends = np.cumsum(bytes_of.reshape(-1, 2).sum(axis=1))
        block_from = np.concatenate([[0], ends])[head]
        list_from = np.concatenate([[0], ends])[np.append(first, len(word))]
        blocks = -(-df // BLOCK)
        block_list = np.repeat(np.arange(len(df)), blocks)
        tops = np.maximum.reduceat(impact, head)
        cuts = np.concatenate([[0], np.cumsum(blocks)])
        last, at = place[head + size - 1].astype(np.int32), (block_from - list_from[block_list]).astype(np.int32)
        top = np.maximum.reduceat(tops, cuts[:-1])
        names = [x.split()[0] for x in _INDEX.split(", ")]
        whole = np.array(ids, dtype=object)
        known = np.array([i is not None for i in ids])
        whole[~known] = 0
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        facts = [pa.array([shard]), pa.array([None], pa.string()), pa.array([len(ids)]), pa.array([0]), pa.array([known.astype(np.int32).tolist()], ints), pa.array([whole.astype(np.int64).tolist()], longs), pa.array([[]], ints), pa.array([norm.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(facts, names)
        for a in range(0, len(df), 20_000):
            b = min(len(df), a + 20_000)
            x, y = cuts[a], cuts[b]
            lists = pa.array((cuts[a : b + 1] - x).astype(np.int32))
            offsets = (list_from[a : b + 1] - list_from[a]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[list_from[a] : list_from[b]].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, shard)), pa.array(words[a:b], pa.string()), pa.array(df[a:b]), pa.array(top[a:b])]
                + [pa.ListArray.from_arrays(lists, pa.array(v[x:y])) for v in (last, tops, at)] + [data],
                names,
            )


def build_index(documents: DataFrame, *, shard_chars: int = SHARD_CHARS) -> Index:
    """The written index of all documents."""
    docs = by_id(documents)
    n_docs, n_terms = statistics(docs)

    def run(batches):
        from pyspark import TaskContext

        base, made, shard = TaskContext.get().partitionId() << 32, 0, _Shard(n_docs, n_terms)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(a, 256).columns)):
                    shard.add(doc_id, text)
                    if shard.full(shard_chars):
                        yield from shard.rows(base + made)
                        made += 1
        yield from shard.rows(base + made)

    return Index(written(docs.mapInArrow(run, _INDEX), "lexical-index"), n_docs, n_terms)


class Postings:
    """One term's list in a shard; a block is decompressed when first asked for, and kept while the
    items of a block are searched."""

    def __init__(self, df: int, last: np.ndarray, tops: np.ndarray, at: np.ndarray, data: bytes):
        self.tops, self.last = np.append(tops, 0), last
        self.ends, self.raw = np.append(at, len(data)), np.frombuffer(data, dtype=np.uint8)
        self.size = np.minimum(BLOCK, df - BLOCK * np.arange(len(at)))
        # Places of blocks not read yet count as their last one, which keeps the order.
        self.place, self.impact = np.repeat(last.astype(np.int64), self.size), np.zeros(df, dtype=np.int64)
        self.have = np.zeros(len(at), dtype=bool)

    def read(self, which: np.ndarray, norm: np.ndarray):
        """The blocks ``which`` (rising), decompressed if they are not yet."""
        which = which[~self.have[which]]
        if not len(which):
            return
        whole = len(which) == len(self.have)
        raw = self.raw if whole else np.concatenate([self.raw[self.ends[b] : self.ends[b + 1]] for b in which.tolist()])
        pairs = unpack(raw).reshape(-1, 2)
        # The first difference of a block is its first place.
        size = self.size[which]
        head = np.cumsum(size) - size
        place = np.cumsum(pairs[:, 0])
        place -= np.repeat(place[head] - pairs[head, 0], size)
        into = slice(None) if whole else np.repeat(which * BLOCK - head, size) + np.arange(len(place))
        self.place[into], self.impact[into] = place, impacts(pairs[:, 1] + 1, norm[place])
        self.have[which] = True


class PostingList:
    """A list for one item: ``times`` the impacts of the postings, and the most that it can add."""

    def __init__(self, times: int, top: int, postings: Postings):
        self.weight, self.bound, self.postings = times, times * top, postings

    def all(self, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.postings
        p.read(np.arange(len(p.have)), norm)
        return p.place, self.weight * p.impact

    def block_bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that could hold each place, and the most that it can add."""
        block = np.searchsorted(self.postings.last, places)
        return block, self.weight * self.postings.tops[block]

    def scores(self, places: np.ndarray, block: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """What the list adds to each place (rising); only the blocks asked for are read."""
        p = self.postings
        wanted = np.zeros(len(p.have) + 1, dtype=bool)
        wanted[block] = True
        p.read(np.flatnonzero(wanted[:-1]), norm)
        at = np.minimum(np.searchsorted(p.place, places), len(p.place) - 1)
        return np.where(p.place[at] == places, self.weight * p.impact[at], 0)


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score; 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def max_score(lists: list[PostingList], norm: np.ndarray, k: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Places (rising) and scores of at least the ``k`` best documents of a shard, ties of the
    last included."""
    none = np.zeros(0, dtype=np.int64)
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    if not lists:
        return none, none
    total = np.zeros(len(norm), dtype=np.int64)
    before = np.cumsum([0, *(x.bound for x in lists)])  # what the lists below each one can add
    # Lists from the largest bound down are essential while those below them can reach the
    # threshold, which grows with what has been added already (scores only grow).
    first, threshold, probe = len(lists), 0, 1
    while first and before[first] >= max(threshold, 1):
        first -= 1
        places, scores = lists[first].all(norm)
        total[places] += scores
        held = np.flatnonzero(total)
        threshold = max(threshold, _kth(total[held], k))
        if first and before[first] >= max(threshold, 1) and len(held) >= k and len(lists) - first >= probe:
            # The most promising of them, scored whole, raise the threshold further.
            probe = 4 * (len(lists) - first)
            best = np.sort(held[np.argpartition(total[held], len(held) - min(len(held), 2 * k))[-2 * k :]])
            threshold = max(threshold, _kth(_finish(lists[:first], best, total[best], norm, 0, k)[1], k))
    candidates = np.flatnonzero(total)
    return _finish(lists[:first], candidates, total[candidates], norm, threshold, k)


def _finish(lists: list[PostingList], places: np.ndarray, scores: np.ndarray, norm: np.ndarray, threshold: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores of the places that can reach ``threshold``."""
    rest = sum(x.bound for x in lists)
    keep = scores + rest >= threshold
    places, scores = places[keep], scores[keep]
    if not lists or not len(places):
        return places, scores
    # Block maxima, of all lists at once, before any block is read.
    blocks, bounds = zip(*(x.block_bounds(places) for x in lists))
    blocks, bounds = np.stack(blocks), np.stack(bounds)
    open_bound = bounds.sum(axis=0)
    keep = scores + open_bound >= threshold
    places, scores, blocks, bounds, open_bound = places[keep], scores[keep], blocks[:, keep], bounds[:, keep], open_bound[keep]
    for i in range(len(lists) - 1, -1, -1):
        if not len(places):
            break
        scores = scores + lists[i].scores(places, blocks[i], norm)
        open_bound = open_bound - bounds[i]
        threshold = max(threshold, _kth(scores, k))
        keep = scores + open_bound >= threshold
        if not keep.all():
            places, scores, blocks, bounds, open_bound = places[keep], scores[keep], blocks[:, keep], bounds[:, keep], open_bound[keep]
    return places, scores


_FOUND = "item_id long, doc_id long, score long"

_SQL_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
SQL = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (SELECT r, {_SQL_TERMS} AS term FROM numbered),
tfs AS (SELECT r, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_SQL_TERMS} AS term FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
scored AS (
  SELECT item_id, r, CAST(sum(times * CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN dfs USING (term) JOIN lengths USING (r) CROSS JOIN totals GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN numbered USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def search(index: Index, items: DataFrame, *, top: int = TOP, item_block: int = ITEM_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item."""
    spark = items.sparkSession
    n_docs = index.docs
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("item_id").isNotNull())
    wanted = map_texts(wanted, _item_terms, "item_id long, term string, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))
    wanted = written(wanted, "lexical-items")
    counts = wanted.agg(F.count_distinct("item_id"), F.count_distinct("term")).first()
    if not counts[0] or not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = -(-counts[0] // item_block)
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    terms = wanted.select("term", "block").distinct()
    small = counts[1] * min(blocks, counts[0]) <= BROADCAST_TERMS
    lists = index.rows.where(F.col("term").isNotNull()).join(F.broadcast(terms) if small else terms, "term")
    lists = written(lists, "lexical-lists")
    weights = lists.select("shard", "term", "df").distinct().groupBy("term").agg(F.sum("df").alias("all_df"))
    # One packed row a block of items meets each shard that holds any of its terms.
    asked = wanted.join(weights, "term").groupBy("block").agg(F.collect_list(F.struct("item_id", "term", "times", "all_df")).alias("items"))
    shards = lists.select("shard", "block").distinct()
    heads = index.rows.where(F.col("term").isNull()).select("shard", F.col("last").alias("known"), F.col("tops").alias("ids"), F.col("data").alias("norms"))
    asked = shards.join(asked, "block").join(heads, "shard").select(F.col("shard").alias("in_shard"), F.col("block").alias("of_block"), "items", "known", "ids", "norms")

    def run(key, left, right):
        return _search_shard(left, right, n_docs, top)

    lists = lists.select("shard", "block", "term", "df", "top", "last", "tops", "at", "data")
    found = lists.groupBy("shard", "block").cogroup(asked.groupBy("in_shard", "of_block")).applyInArrow(run, _FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _item_terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [(i, t, n) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for t, n in Counter(terms_of(text)).items()]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["item_id", "term", "times"])


def _search_shard(lists: pa.Table, asked: pa.Table, n_docs: int, top: int) -> pa.Table:
    """The best documents of one shard for each item of a block."""
    out = ([], [], [])
    if lists.num_rows and asked.num_rows:
        norm = np.frombuffer(asked.column("norms")[0].as_py(), dtype=np.int64)
        ids = asked.column("ids").combine_chunks().flatten().to_numpy()
        known = asked.column("known").combine_chunks().flatten().to_numpy() > 0
        terms = {t: i for i, t in enumerate(lists.column("term").to_pylist())}
        tops, dfs, columns = lists.column("top").to_pylist(), lists.column("df").to_pylist(), {c: lists.column(c) for c in ("last", "tops", "at", "data")}
        known_lists: dict[int, Postings] = {}

        def postings(i: int) -> Postings:
            if i not in known_lists:
                known_lists[i] = Postings(dfs[i], *(columns[c][i].values.to_numpy() for c in ("last", "tops", "at")), columns["data"][i].as_py())
            return known_lists[i]

        items: dict[int, list[PostingList]] = {}
        for x in asked.column("items")[0].as_py():
            i = terms.get(x["term"])
            if i is not None:
                items.setdefault(x["item_id"], []).append(PostingList(x["times"] * weight(n_docs, x["all_df"]), tops[i], postings(i)))
        for item, own in items.items():
            places, scores = max_score(own, norm, top)
            order = np.lexsort((ids[places], ~known[places], -scores))[:top]
            out[0].extend([item] * len(order))
            out[1].extend(int(ids[p]) if known[p] else None for p in places[order])
            out[2].extend(scores[order].tolist())
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("item_id", "doc_id", "score"), out)})
