"""Benchmark decontamination by edit distance.

Texts and benchmark items are read as lower-case words. A document leaks an item when some
window of it is within ``1 - similarity`` of the item's length in word edits. Candidates come
from a random-walk embedding (CGK): a walk copies the word it stands on and then steps on or
stays, as a random bit of (repetition, step, word) says; two sequences a few edits apart soon
walk in step again, so that their copies agree in most places and edit distance becomes Hamming
distance. Bit sampling of the copies (the start word always among them) makes LSH keys; every
item is entered under several start words and ``repetitions`` walks, so the chance that a leak
shares no key is small. Of an item so short that its edits may spoil every walk's first two words,
one start word more than it may have edits is entered by itself: one of them is always left. Each candidate window is then verified by its exact edit distance.

Items are taken in blocks of ``block_items`` (one broadcast index a block); all documents are
read whole against every block.

Defined cases: NULL or wordless texts and items match nothing; items under ``least_words`` words
cannot be told from ordinary prose and match nothing; repeated rows are matched each; an item_id
that repeats with other texts is looked for in each of them (the best match is reported).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, map_texts, texts_of

SIMILARITY = 0.8
LEAST_WORDS = 5
REPETITIONS = 4
#: Start words an item.
STARTS = 8
BLOCK_ITEMS = 20_000
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


_NONE: dict = {}


class Bits:
    """Fair bits of (repetition, step, word), the same in every process."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=64).digest(), "little")
        return got


def edit_ends(pattern: list[str], text: list[str]) -> list[int]:
    """Least edit distance of ``pattern`` to a part of ``text`` ending behind each word (bit-parallel)."""
    m = len(pattern)
    where: dict[str, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, []
    for w in text:
        eq = where.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus = plus << 1 & full
        up = (minus << 1 & full) | ~(diagonal | plus) & full
        down = plus & diagonal
        out.append(score)
    return out


def best_window(pattern: list[str], text: list[str]) -> tuple[int, int, int]:
    """(distance, start, end) of the closest part of ``text``, the earliest end among equals."""
    ends = edit_ends(pattern, text)
    if not ends:
        return len(pattern), 0, 0
    distance = min(ends)
    end = ends.index(distance) + 1
    back = edit_ends(pattern[::-1], text[:end][::-1])
    # The longest stretch of that distance that ends here.
    start = next((end - 1 - i for i in range(len(back) - 1, -1, -1) if back[i] == distance), 0)
    return distance, start, end


class Index:
    """LSH index of one block of items: a trie of sampled words a repetition and size class."""

    def __init__(self, items: list[tuple[int, str | None]], *, similarity: float = SIMILARITY, repetitions: int = REPETITIONS, least_words: int = LEAST_WORDS):
        self.items: list[tuple[int, list[str], int]] = []
        for item_id, text in items:
            w = words(text)
            if len(w) >= least_words:
                self.items.append((item_id, w, int((1 - similarity) * len(w) + 1e-9)))
        spread = Counter(x for _, w, _ in self.items for x in set(w))
        self.bits = Bits()
        #: start word -> the word behind it (a walk's first new copy, sampled by every
        #: repetition; None: any word) -> {(repetition, further sampled steps): trie}
        self.starts: dict[str, dict[str, dict[tuple, dict]]] = {}
        for k, (_, w, _) in enumerate(self.items):
            steps = 6 if len(w) < 16 else 10 if len(w) < 32 else 14
            last = max(1, len(w) - steps // 2)
            # Start words that few items share and, of those, the longest: long words are rare in
            # prose, so that few windows of the documents start with them.
            rare = sorted(range(last), key=lambda o: (spread[w[o]] > max(2, len(self.items) // 50), -len(w[o]), o))[:STARTS]
            for o in sorted(rare):
                for r in range(repetitions):
                    sample = _sample(r, steps)
                    node = self.starts.setdefault(w[o], {}).setdefault(w[o + 1] if o + 1 < len(w) else "", {}).setdefault((r, sample), {})
                    for word in self._copies(w, o, r, sample):
                        node = node.setdefault(word, {})
                    node.setdefault(None, []).append((k, o))
            # An edit touches at most two of the pairs (start word, next).
            if last <= 2 * self.items[k][2] + 1:
                alone = sorted(range(len(w)), key=lambda o: (spread[w[o]] > max(2, len(self.items) // 50), -len(w[o]), o))
                for o in alone[: self.items[k][2] + 1]:
                    self.starts.setdefault(w[o], {}).setdefault(None, {}).setdefault((0, ()), {}).setdefault(None, []).append((k, o))

    def _copies(self, w: list[str], at: int, r: int, sample: tuple[int, ...]):
        """The words that the walk from ``at`` copies at the sampled steps ("" past the end)."""
        step = 0
        for goal in sample:
            while step < goal and at < len(w):
                at += self.bits(w[at]) >> (r * 31 + step) & 1
                step += 1
            yield w[at] if at < len(w) else ""

    def matches(self, w: list[str]) -> dict[int, tuple[int, int, int]]:
        """item position -> (distance, start word, end word) of its best verified window."""
        found: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        starts = self.starts
        for p in [i for i, x in enumerate(w) if x in starts]:
            behind = starts[w[p]]
            for (r, sample), trie in (*behind.get(w[p + 1] if p + 1 < len(w) else "", _NONE).items(), *behind.get(None, _NONE).items()):
                node = trie
                for word in self._copies(w, p, r, sample):
                    node = node.get(word)
                    if node is None:
                        break
                for k, o in (node or {}).get(None, ()):
                    if (k, p - o) in tried or k in found and found[k][0] == 0:
                        continue
                    tried.add((k, p - o))
                    _, item, most = self.items[k]
                    a = max(0, p - o - most)
                    d, s, e = best_window(item, w[a : p - o + len(item) + most])
                    if d <= most and (k not in found or (d, a + s) < found[k][:2]):
                        found[k] = (d, a + s, a + e)
        return found


def _sample(r: int, steps: int) -> tuple[int, ...]:
    """Two steps drawn for repetition ``r``, in order (the start word and the next are always sampled)."""
    draw = hashlib.blake2b(b"%d,%d" % (r, steps)).digest()
    return tuple(sorted(sorted(range(1, steps), key=lambda j: draw[j])[:2]))


def _blocks(benchmark: DataFrame, block_items: int) -> list[list[tuple[int, str | None]]]:
    """Blocks of items, each small enough to broadcast; one is held at a time by the caller."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    n = max(1, -(-items.count() // block_items))
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY, repetitions: int = REPETITIONS, least_words: int = LEAST_WORDS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, distance, item_words, start_word, end_word: one row a document and item."""
    schema = "doc_id long, item_id long, distance int, item_words int, start_word int, end_word int"
    parts = []
    for block in _blocks(benchmark, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, similarity=similarity, repetitions=repetitions, least_words=least_words))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            index, out = shared.value, []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                best: dict[int | None, tuple] = {}
                for k, (d, a, b) in index.matches(words(text)).items():
                    item_id, item, _ = index.items[k]
                    best[item_id] = min(best.get(item_id, (d, a, b, len(item))), (d, a, b, len(item)))
                out += [(doc_id, i, d, n, a, b) for i, (d, a, b, n) in best.items()]
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "item_id", "distance", "item_words", "start_word", "end_word"])

        parts.append(map_texts(by_id(docs), run, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY, repetitions: int = REPETITIONS, least_words: int = LEAST_WORDS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents (all their columns) that leak no item."""
    for block in _blocks(benchmark, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, similarity=similarity, repetitions=repetitions, least_words=least_words))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            return batch.filter(pa.array([not shared.value.matches(words(t)) for t in texts_of(batch)], pa.bool_()))

        docs = map_texts(docs, run, docs.schema)
    return docs
