"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of up to ``chunk_chars`` code points is one chunk. A longer one is cut into chunks that run
``overlap`` code points into their neighbour; the chunks are dealt out and pre-tokenised in
parallel, each from its own first character. A pre-token depends only on what follows its start, so
from the first place on where a chunk and its neighbour both have a boundary the two agree with the
whole text: there they are stitched (only behind visible characters, since the pattern looks past
the end of white space). The pieces between such places are encoded in parallel, too
(each pre-token by the merges of the rank file), and a text's ids are those of its pieces in order.
Where two chunks share no boundary in their overlap (a run of one kind of character that is
longer), the whole text is one piece. Decoding concatenates the raw bytes of the ids.

Defined cases: NULL and empty texts have no ids and decode to no bytes; strings that look like
special tokens are ordinary text; rows that repeat (NULL ids included) give a row each; extra
columns, whatever their names, play no part; texts of any length are encoded whole; an empty table
gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, map_texts, texts_of

CHUNK_CHARS, OVERLAP = 32_768, 512
#: Code points before a cut whose boundaries are not relied on: the pattern looks one character
#: ahead of a match, and its longest fixed alternative has three characters.
MARGIN = 8


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and a number a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Words(dict):
    """Ids (little-endian int32) of the pre-tokens met so far."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        got = np.array(self.merge(word.encode()), dtype="<i4").tobytes()
        if len(word) <= 64:
            self[word] = got
        return got


class Coder:
    """Pattern and merges of one vocabulary; one a worker. ``cached_words`` bounds its memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached_words: int = 200_000):
        import regex
        import tiktoken

        self.pattern, self.blank = regex.compile(pattern), regex.compile(r"\s")
        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.words, self.cached_words = _Words(core.encode_single_piece), cached_words
        self.raw = pa.array([token for token, _ in sorted(ranks.items(), key=lambda x: x[1])], pa.binary())
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must run from 0 without gaps")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids end."""
        if len(self.words) > self.cached_words:
            self.words.clear()
        known, cut = self.words.__getitem__, self.pattern.findall
        parts = [b"".join(map(known, cut(t))) for t in texts]
        return np.frombuffer(b"".join(parts), dtype="<i4"), np.cumsum([0, *map(len, parts)]) // 4

    def boundaries(self, text: str) -> np.ndarray:
        """Where the pre-tokens of ``text`` start, and its end."""
        return np.cumsum([0, *map(len, self.pattern.findall(text))])


def cut_points(length: int, chunk_chars: int) -> list[int]:
    """Where the chunks of a text of ``length`` code points start."""
    return list(range(0, max(1, length), chunk_chars))


def _coder(shared, ready: list) -> Coder:
    if not ready:
        ready.append(Coder(*shared.value))
    return ready[0]


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids of every text."""
    # A rank file is bounded by its vocabulary (0.8 MB here), whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    ready: list[Coder] = []

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, ends = _coder(shared, ready).encode(texts_of(batch))
        rest = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
        return pa.RecordBatch.from_arrays([*rest, _lists(flat, ends)], [*(n for n in batch.schema.names if n != "text"), "ids"])

    def chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [(i, d, k, t[at : at + chunk_chars + overlap]) for i, d, t in zip(*(c.to_pylist() for c in batch.columns)) for k, at in enumerate(cut_points(len(t), chunk_chars))]
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], ["doc_id", "digest", "chunk", "text"])

    def ends_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Boundaries (places in the whole text) in the two overlaps of each chunk."""
        heads, tails = [], []
        for text, at in zip(texts_of(batch), (np.asarray(batch.column(2)) * chunk_chars).tolist()):
            found = _coder(shared, ready).boundaries(text)
            heads.append((found[found <= overlap] + at).tolist())
            tail = found[(found >= chunk_chars) & (found <= len(text) - MARGIN)].tolist()
            tails.append([x + at for x in tail if not _coder(shared, ready).blank.match(text, x - 1)])
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, longs), pa.array(tails, longs)], [*batch.schema.names, "head", "tail"])

    rows = by_id(docs)
    long_text = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = map_texts(rows.where(~long_text), encode, "doc_id long, ids array<int>")

    # Rows that repeat go on as one, with their number.
    cut = map_texts(rows.where(long_text).select("doc_id", F.sha2("text", 256).alias("digest"), "text"), chunks, "doc_id long, digest string, chunk int, text string")
    cut = cut.groupBy("doc_id", "digest", "chunk").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    cut = cut.select("doc_id", "digest", "chunk", "text", "copies")
    marked = map_texts(cut, ends_of, "doc_id long, digest string, chunk int, text string, copies long, head array<long>, tail array<long>")
    # The chunks of one text: as many rows as one row of the input held.
    whole = Window.partitionBy("doc_id", "digest")
    order = whole.orderBy("chunk")
    at, last = F.col("chunk").cast("long") * chunk_chars, F.lead("chunk").over(order).isNull()
    met = marked.select("doc_id", "digest", "chunk", "text", "copies", F.array_min(F.array_intersect("tail", F.lead("head").over(order))).alias("met"), last.alias("last"))
    met = met.withColumn("torn", F.max(F.col("met").isNull() & ~F.col("last")).over(whole)).withColumn("from", F.coalesce(F.lag("met").over(order), at))
    start = F.when(F.col("torn"), at).otherwise(F.col("from"))
    stop = F.when(F.col("last"), at + chunk_chars + overlap).when(F.col("torn"), at + chunk_chars).otherwise(F.col("met"))
    part = F.expr("substring(text, cast(start - chunk * {0}L + 1 as int), cast(stop - start as int))".format(chunk_chars))
    piece = F.when(F.col("torn"), 0).otherwise(F.col("chunk"))
    pieces = met.withColumns({"start": start, "stop": stop, "piece": piece}).select("doc_id", "digest", "piece", "copies", F.struct("chunk", part.alias("part")).alias("x"))
    pieces = pieces.groupBy("doc_id", "digest", "piece", "copies").agg(F.array_sort(F.collect_list("x")).alias("x"))
    pieces = pieces.select("doc_id", "digest", "piece", "copies", F.array_join("x.part", "").alias("text"))
    coded = map_texts(pieces, encode, "doc_id long, digest string, piece int, copies long, ids array<int>")
    coded = coded.groupBy("doc_id", "digest", "copies").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("x"))
    long = coded.select("doc_id", F.flatten("x.ids").alias("ids"), F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "ids")
    return short.unionByName(long)


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids and the bytes that they stand for (NULL ids: no bytes)."""
    shared = encoded.sparkSession.sparkContext.broadcast((ranks, pattern))
    ready: list[Coder] = []

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            ends = np.cumsum(np.concatenate([[0], np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))]))
            # The data of the taken tokens lies end to end: the decoded texts.
            taken = _coder(shared, ready).raw.take(lists.flatten())
            offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)[ends] if len(taken) else np.zeros(len(ends), dtype=np.int32)
            raw = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
            back = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int32)), raw])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, back], ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
