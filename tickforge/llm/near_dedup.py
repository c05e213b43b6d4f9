"""Near-duplicate classes with DartMinHash signatures.

A document is the set of its ``shingle_words``-word shingles (a shorter text is one shingle of
all its words), each weighing 1, or its count with ``weighted``. Darts are thrown, by hash, into
the unit cells of every element's weight x rank region; the earliest dart (smallest rank) in each
of ``coordinates`` coordinates makes the signature, so a whole signature costs about
``coordinates * log(coordinates)`` darts, however many shingles there are. Bands of the signature
are joined; each candidate link is verified exactly (Jaccard, or weighted Jaccard) on the shingles
themselves, and the classes are the connected components of the verified links.

No group is ever expanded into its pairs. Equal shingle sets are first collapsed to one
representative. In a round every member of a bucket is compared with the bucket's leaders (one in
the first round, more later), unless both are of one class already; leaders then leave
the bucket, and rounds go on with new leaders in the buckets that still hold members of different
classes, until none does. A pair is compared only in the first bucket that it shares.
Sets are left out that hold too many elements of no other candidate (no link could cover them),
and pairs that cannot share enough: by the same counts, or because the parity prints of the two
sets (a bit of ``PRINT_WORDS`` words flips for every element) differ in more bits than linked sets
have elements apart. Both bounds are exact, so no link between different classes is missed, and a
large group of copies is done after one round. Joins are on (band, key) with the few leaders on
one side, so a hot bucket splits by its members.

Defined cases: NULL text counts as empty; texts without words are equal if the texts are equal;
a document's class is the smallest doc_id in it; rows that repeat a doc_id are one document each
with its own text (the classes of all its texts are linked); a NULL doc_id gets the class of its
text's other documents, else NULL; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import Powers, beside, by_id, free_broadcasts, map_texts, mix, release, texts_of, watched, written
from tickforge.operators.sequence import content_hash

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Leaders a bucket in the second round, four times as many in each further one.
LEADERS = 8
#: 64-bit words of a set's parity print: the differing bits of two prints are at most the elements
#: that only one of the sets has.
PRINT_WORDS = 16
#: Lanes of the join that names large classes.
SALTS = 16
# Words are runs of ASCII letters, digits and underscores and of all characters beyond ASCII.
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() or b == 95 for b in range(256)])
# Darts in a cell of area one (Poisson), by twelve random bits.
_DARTS = np.searchsorted(np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 12)])), (np.arange(4096) + 0.5) / 4096, side="right")


def shingle_sets(texts: list[str], powers: Powers, size: int = SHINGLE_WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of each text, and their counts; all texts at once."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    inside = _IN_WORD[raw]
    start = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    stop = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    up, down = powers.get(len(raw) + 1)
    with np.errstate(over="ignore"):
        chain = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
        word = mix((chain[stop] - chain[start]) * down[start] + (stop - start).astype(np.uint64))
        acc = np.zeros(max(0, len(word) - size + 1), dtype=np.uint64)
        for k in range(size):
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + word[k : k + len(acc)]
        acc = mix(acc)
        at = np.concatenate([[0], np.searchsorted(start, ends)])
        out = []
        for i, (a, b) in enumerate(zip(at, at[1:])):
            if b - a >= size:
                out.append(np.unique(acc[a : b - size + 1], return_counts=True))
                continue
            # Fewer words are one shingle; without any word the text itself is.
            whole = np.uint64(0)
            for x in word[a:b]:
                whole = whole * np.uint64(0x9E3779B97F4A7C15) + x
            if a == b:
                whole = np.frombuffer(hashlib.blake2b(parts[i], digest_size=8).digest(), dtype=np.uint64)[0]
            out.append((mix(np.array([whole + np.uint64(1 + b - a)])), np.ones(1, dtype=np.int64)))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int, weighted: bool = False) -> np.ndarray:
    """The earliest dart (its rank, which tells darts apart) per document and coordinate."""
    out = np.zeros((len(sets), coordinates), dtype=np.uint64)
    todo = np.arange(len(sets))
    darts = coordinates * (np.log(coordinates) + 2)
    while len(todo):
        elements = np.concatenate([sets[i][0] for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo]) if weighted else np.ones(len(elements), dtype=np.int64)
        doc = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        total = np.bincount(doc, weights, len(todo))
        reach = darts / total  # darts below this rank take part: about ``darts`` a document
        # Unit cells: ``weights`` along the weight axis, ceil(reach) along the rank axis.
        depth = np.ceil(reach).astype(np.int64)[doc]
        cells = weights * depth
        cell = np.repeat(np.arange(len(elements)), cells)
        inside = np.arange(len(cell)) - np.repeat(np.cumsum(cells) - cells, cells)
        level, layer = inside // depth[cell], inside % depth[cell]
        with np.errstate(over="ignore"):
            seed = mix(elements[cell] + mix(level.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + layer.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(1)))
            count = _DARTS[(seed >> np.uint64(52)).astype(np.int64)]
            where = np.repeat(np.arange(len(cell)), count)
            nth = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix(seed[where] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB))
        rank = layer[where] + (mix(dart) >> np.uint64(11)) * 2.0**-53
        owner = doc[cell[where]]
        near = rank <= reach[owner]
        slot = owner[near] * coordinates + (dart[near] % np.uint64(coordinates)).astype(np.int64)
        # The rank names the dart: no two of 53 random bits (and a layer) are alike.
        got = np.full(len(todo) * coordinates, np.inf)
        np.minimum.at(got, slot, rank[near])
        full = np.isfinite(got)
        got = got.view(np.uint64)
        whole = full.reshape(-1, coordinates).all(axis=1)
        out[todo[whole]] = got.reshape(-1, coordinates)[whole]
        todo = todo[~whole]
        darts *= 2  # a coordinate without a dart: throw further ones, the earlier stay
    return out


def digests(sets: list[tuple[np.ndarray, np.ndarray]], weighted: bool = False) -> list[bytes]:
    """What tells sets apart."""
    return [hashlib.blake2b(s.tobytes() + (c.tobytes() if weighted else b""), digest_size=16).digest() for s, c in sets]


def signed(docs: DataFrame, *, bands: int = BANDS, rows: int = ROWS, shingle_words: int = SHINGLE_WORDS, weighted: bool = False) -> DataFrame:
    """doc_id, same (digest of the shingle set), bands (a hash a band)."""
    powers = Powers()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(texts_of(batch), powers, shingle_words)
        sig = signatures(sets, bands * rows, weighted).reshape(len(sets), bands, rows)
        key = np.zeros((len(sets), bands), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for r in range(rows):
                key = mix(key * np.uint64(31) + sig[:, :, r] + np.uint64(r + 1))
        same = digests(sets, weighted)
        keys = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), keys], ["doc_id", "same", "bands"])

    return map_texts(by_id(docs), run, "doc_id long, same binary, bands array<long>")


def parity_prints(sets: list[tuple[np.ndarray, np.ndarray]], weighted: bool = False) -> np.ndarray:
    """A row of ``PRINT_WORDS`` words a set: each element (each unit of weight) flips one bit."""
    elements = np.concatenate([s for s, _ in sets])
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    if weighted:
        counts = np.concatenate([c for _, c in sets])
        first = np.cumsum(counts) - counts
        level = np.arange(counts.sum()) - np.repeat(first, counts)
        elements, doc = np.repeat(elements, counts) + mix(level.astype(np.uint64)), np.repeat(doc, counts)
    bits = 64 * PRINT_WORDS
    flips = np.bincount(doc * bits + (mix(elements) % np.uint64(bits)).astype(np.int64), minlength=len(sets) * bits)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64).reshape(len(sets), PRINT_WORDS)


def _sets(docs: DataFrame, shingle_words: int, weighted: bool) -> DataFrame:
    """same, elements, counts, print of documents."""
    powers = Powers()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(texts_of(batch), powers, shingle_words)
        ends = np.concatenate([[0], np.cumsum([len(s) for s, _ in sets])]).astype(np.int32)
        elements, counts = (np.concatenate(x) for x in zip(*sets))
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(a)) for a in (elements.view(np.int64), counts.astype(np.int32))]
        prints = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * PRINT_WORDS), pa.array(parity_prints(sets, weighted).ravel()))
        return pa.RecordBatch.from_arrays([pa.array(digests(sets, weighted), pa.binary()), *lists, prints], ["same", "elements", "counts", "print"])

    return map_texts(docs, run, "same binary, elements array<long>, counts array<int>, print array<long>")


def _measures(sets: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """rep, size, print, shared (weight of the elements that some other set has too) of the sets
    that can be linked at all: a link covers ``similarity`` of the set, and no lone element."""
    each = sets.select("rep", F.explode(F.arrays_zip("elements", "counts")).alias("x")).select("rep", F.col("x.elements").alias("element"), (F.col("x.counts") if weighted else F.lit(1)).cast("long").alias("weight"))
    lone = each.groupBy("element").agg(F.count("*").alias("n"), F.min("rep").alias("rep"), F.min("weight").alias("weight")).where("n = 1").groupBy("rep").agg(F.sum("weight").alias("lone"))
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x) if weighted else F.size("elements").cast("long")
    sized = sets.select("rep", "print", size.alias("size")).join(lone, "rep", "left")
    sized = sized.select("rep", "size", "print", (F.col("size") - F.coalesce("lone", F.lit(0))).alias("shared"))
    return sized.where(F.col("shared") >= similarity * F.col("size") - 1e-9)


def _counted(df: DataFrame, name: str, rows: int | None = None, **watch: "F.Column") -> DataFrame:
    """``written``, its rows counted."""
    return written(df, name, rows, watch={"rows": F.count(F.lit(1)), **watch})


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label) of the nodes of ``links`` (a, b; at most ``rows``): label is the smallest node of
    the component.

    Alternating large-star and small-star steps (each a partial aggregate and a join on the
    node), written to the shared folder; ends when the links are stars: every node that has a
    smaller neighbour has no other one."""
    edges = _counted(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-links", rows)
    while True:
        rows = 2 * watched(edges)  # a link has two nodes, and a step makes no more links than that
        # Both minima are partial aggregates, one row a node; a hot node's edges stay where they are.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        low = _counted(low, "near-lowest", rows, open=F.count_if(F.expr("m <> u and n > 1")))
        if not watched(low, "open"):
            release(low)
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            out._tf_path, out._tf_watched = edges._tf_path, edges._tf_watched
            return out
        large = both.join(beside(low.drop("n"), watched(low)), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = _counted(large.groupBy("u").agg(F.min("v").alias("m")), "near-lowest", rows)
        small = large.join(beside(least, watched(least)), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        before, edges = edges, _counted(small.where("u <> v").distinct(), "near-links", rows)
        release(before, low, least)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    own = sets.select(F.col("rep").alias("b"), F.col("elements").alias("eb"), F.col("counts").alias("cb"))
    other = sets.select(F.col("rep").alias("a"), F.col("elements").alias("ea"), F.col("counts").alias("ca"))
    if not weighted:
        own, other = own.drop("cb"), other.drop("ca")
    met = own.join(beside(pairs, watched(pairs)), "b").join(other, "a")
    if weighted:
        near = F.map_from_arrays("eb", "cb")
        shared = F.aggregate(F.zip_with("ea", "ca", lambda e, c: F.least(c, F.coalesce(F.element_at(near, e), F.lit(0)))), F.lit(0).cast("long"), lambda s, x: s + x)
        sizes = [F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x) for c in ("ca", "cb")]
    else:
        shared = F.size(F.array_intersect("ea", "eb")).cast("long")
        sizes = [F.size("ea").cast("long"), F.size("eb").cast("long")]
    return met.where(shared >= similarity * (sizes[0] + sizes[1] - shared) - 1e-9).select("a", "b")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the label of their class; ``labels`` as ``components`` gives them."""
    named = members.join(beside(labels, watched(labels)).select(F.col("node").alias("rep"), "label"), "rep", "left")
    return named.withColumn("label", F.coalesce("label", "rep"))


def _may_link(similarity: float) -> "F.Column":
    """Whether a member and a leader can be as similar as that, by exact upper bounds."""
    # What two sets share is at most what either shares with any other.
    most = F.least("shared", "led_shared")
    both = F.col("size") + F.col("led_size")
    apart = sum((F.bit_count(F.get("print", F.lit(i)).bitwiseXOR(F.get("led_print", F.lit(i)))) for i in range(PRINT_WORDS)), F.lit(0))
    return (most >= similarity * (both - most) - 1e-9) & (apart * (1 + similarity) <= (1 - similarity) * both + 1e-9)


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class): one row a row of ``docs``."""
    marks, names = _classes(docs, **how)
    return marks.select("doc_id", "same").join(names, "same").select("doc_id", "class_id")


def _classes(docs: DataFrame, *, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, shingle_words: int = SHINGLE_WORDS, weighted: bool = False) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and same, class_id of every set."""
    marks = _counted(signed(docs, bands=bands, rows=rows, shingle_words=shingle_words, weighted=weighted), "near-signatures")
    # Equal sets go on as one node (rep), numbered once for all by this write: a doc_id that comes
    # with several texts has several nodes.
    reps = marks.groupBy("same").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    reps = _counted(reps.withColumn("rep", F.monotonically_increasing_id()), "near-representatives", watched(marks))
    # ``earlier`` holds the keys of the bands before: a pair that shares one of them meets there.
    members = reps.where(F.col("id").isNotNull()).select("rep", "bands", F.posexplode("bands").alias("band", "key"))
    members = members.select("rep", "band", "key", F.slice("bands", F.lit(1), F.col("band")).alias("earlier"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").select("band", "key")
    members = _counted(members.join(shared, ["band", "key"]), "near-members", bands * watched(reps))
    met = reps.select("same", "id", "rep").join(members.select("rep").distinct(), "rep", "left_semi")
    wanted = by_id(docs).join(met.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # All texts of these doc_ids; the digest tells which set each of them is.
    sets = _sets(wanted, shingle_words, weighted).groupBy("same").agg(*[F.first(c).alias(c) for c in ("elements", "counts", "print")])
    sets = _counted(sets.join(met.select("same", "rep"), "same").drop("same"), "near-sets")
    measures = written(_measures(sets, similarity, weighted), "near-measures", watched(sets))
    most = watched(members)
    members = members.join(measures, "rep")
    shared = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").select("band", "key")
    members = members.join(shared, ["band", "key"])

    # The sets of a doc_id that came with several texts are links by themselves.
    texts = marks.where(F.col("doc_id").isNotNull()).select("doc_id", "same").distinct()
    twice = texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    texts = texts.join(twice, "doc_id", "left_semi").join(reps.select("same", "rep"), "same").select("doc_id", "rep")
    links = texts.join(texts.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))
    links = written(links, "near-found")
    labels = components(links)
    members = _counted(_labelled(members, labels), "near-members", most)
    lanes = 1
    while most := watched(members):
        free_broadcasts(docs.sparkSession)
        # The leader is the member with the smallest share of lone elements: the most central one.
        typical = F.struct((1 - F.col("shared") / F.col("size")).alias("lone"), F.col("rep").alias("led"), *[F.col(c).alias(f"led_{c}") for c in ("size", "shared", "label", "print", "earlier")])
        leaders = members.groupBy("band", "key", F.pmod(F.xxhash64("rep"), F.lit(lanes)).alias("lane")).agg(F.min(typical).alias("x"))
        leaders = _counted(leaders.select("band", "key", *[f"x.led{c}" for c in ("", "_size", "_shared", "_label", "_print", "_earlier")]), "near-leaders", most)
        led = beside(leaders, watched(leaders))
        pairs = members.join(led, ["band", "key"]).where((F.col("label") != F.col("led_label")) & _may_link(similarity) & ~F.arrays_overlap("earlier", "led_earlier"))
        # In a round of one leader a bucket no member has more than one pair there.
        pairs = _counted(pairs.select(F.least("rep", "led").alias("a"), F.greatest("rep", "led").alias("b")).distinct(), "near-pairs", lanes * most)
        some = watched(pairs)
        found = _counted(_verified(pairs, sets, similarity, weighted), "near-found", some)
        old = labels
        if watched(found):
            # A label stands for its class: links between labels carry the classes on.
            links = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found)
            labels = components(links, watched(labels) + some)
        # A leader has met every member of its bucket and leaves it. Buckets whose other members
        # are all of one class are done.
        rest = members.join(led.select("band", "key", F.col("led").alias("rep")), ["band", "key", "rep"], "left_anti")
        rest = written(_labelled(rest.drop("label"), labels), "near-members", most)
        mixed = rest.groupBy("band", "key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("band", "key")
        mixed = _counted(mixed, "near-mixed", most)
        before, members = members, _counted(rest.join(beside(mixed, watched(mixed)), ["band", "key"]), "near-members", most)
        release(before, leaders, pairs, found, rest, mixed, *([old] if old is not labels else []))
        lanes = max(LEADERS, 4 * lanes)
    # From nodes to doc_ids: the smallest of a class, brought to its sets by a salted join.
    named = _labelled(reps.select("same", "id", "rep"), labels)
    least = named.groupBy("label").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = named.withColumn("salt", F.pmod(F.xxhash64("same"), F.lit(SALTS)).cast("int")).join(least, ["label", "salt"], "left")
    return marks, named.select("same", F.coalesce("least", "id").alias("class_id"))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One document (all its columns) of each class: that whose id names the class, and of several
    rows with this id the one of the smallest text hash, then row hash. Documents without an id
    stay only if no document with one has their set: one row, by hash, a set."""
    marks, names = _classes(docs, **how)
    classes = marks.select("doc_id", "same").join(names, "same")
    gone = written(classes.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("gone")).distinct(), "near-gone")
    ids = marks.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("again")).agg(F.count("*").alias("n")).where("n > 1")
    again = written(ids.select("again"), "near-again")
    own = docs["doc_id"].cast("long")
    kept = docs.join(gone, own == gone["gone"], "left_anti").where(own.isNotNull())
    single = kept.join(again, own == again["again"], "left_anti")
    # Rows that share an id: the least is found before the shuffle, task by task.
    many = kept.join(again, own == again["again"], "left_semi")
    order = F.struct(F.xxhash64(F.col("text").cast("string")), content_hash(docs, docs.columns))
    many = many.groupBy(own.alias("_id")).agg(F.min_by(F.struct(*docs.columns), order).alias("_row")).select("_row.*")
    lost = _with_digest(docs.where(own.isNull()), how.get("shingle_words", SHINGLE_WORDS), how.get("weighted", False))
    lost = lost.groupBy("_same").agg(F.min_by("_row", "_hash").alias("_row"))
    known = names.where(F.col("class_id").isNotNull()).select(F.col("same").alias("_same"))
    return single.unionByName(many).unionByName(lost.join(known, "_same", "left_anti").select("_row.*"))


def _with_digest(docs: DataFrame, shingle_words: int, weighted: bool) -> DataFrame:
    """text, _row (the whole row), _hash (of its content), _same (the digest of its set)."""
    powers = Powers()
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("_row"), content_hash(docs, docs.columns).alias("_hash"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = digests(shingle_sets(texts_of(batch), powers, shingle_words), weighted)
        return batch.append_column("_same", pa.array(same, pa.binary()))

    return map_texts(rows, run, T.StructType([*rows.schema.fields, T.StructField("_same", T.BinaryType())]))
