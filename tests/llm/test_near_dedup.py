import random
import re

import numpy as np
from pyspark.sql import functions as F

from tickforge.llm import near_dedup
from tickforge.llm.common import Powers, table, watched, written
from tickforge.llm.near_dedup import components, keep_first, near_duplicates, shingle_sets, signatures

from .conftest import TABLES


def brute(rows, least=0.8):
    """Classes by comparing all pairs of shingle sets."""
    sets = [set(map(int, s[0])) for s in shingle_sets([t or "" for _, t in rows], Powers())]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= least * len(sets[i] | sets[j]) - 1e-9:
                label[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    smallest = {g: min([x for x in v if x is not None], default=None) for g, v in groups.items()}
    return sorted(((d, smallest[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def classes(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in df.collect()), key=str)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    e = rng.integers(0, 1 << 62, 900).astype(np.uint64)
    a, b = np.unique(e[:800]), np.unique(e[100:])
    sig = signatures([(a, np.ones(800, int)), (b, np.ones(800, int))], 1500)
    assert abs((sig[0] == sig[1]).mean() - 700 / 900) < 0.04
    # weights: twice the weight everywhere against once is one half
    sig = signatures([(a, np.ones(800, int)), (a, np.full(800, 2))], 1500, weighted=True)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.05


def test_shingles_are_five_words():
    text = "One two, three four five six seven"
    words = re.findall(r"\w+", text.lower())
    (h, n), (h2, _), (h3, _), (h4, _) = shingle_sets([text, "one two three four five six seven", "one two", "two one"], Powers())
    assert len(h) == len(words) - 4 and n.sum() == 3 and (h == h2).all() and h3[0] != h4[0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101), (105, 101), (105, 104), (7, 7)]
    out = dict((r[0], r[1]) for r in components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert all(out[i] == 0 for i in range(1, 21)) and {out[i] for i in (101, 104, 105)} == {100}


def test_planted_copies(spark, make_docs):
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(3000)]
    rows = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        for c in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 60)):
                w[rng.randrange(len(w))] = "z%d" % rng.randrange(10**6)
            rows.append((len(rows), " ".join(w)))
    rows += [(500, None), (501, ""), (502, "!!!"), (503, "a b"), (504, "A, b"), (None, rows[0][1]), (506, rows[0][1].upper()), (507, "!!!"), (510, "x " * 4000), (511, "x " * 3000)]
    df = make_docs(rows).repartition(4)
    assert classes(near_duplicates(df)) == brute(rows)
    kept = sorted(r["doc_id"] for r in keep_first(df).where("doc_id is not null").collect())
    assert kept == sorted({c for _, c in brute(rows) if c is not None})


def test_empty_and_extra_columns(make_docs):
    assert classes(near_duplicates(make_docs([]))) == []
    df = make_docs([(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")]).selectExpr("*", "1 AS rep", "2 AS band", "3 AS key", "4 AS gone")
    assert classes(near_duplicates(df)) == [(1, 1), (1, 1), (2, 1)]
    out = keep_first(df)
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [1]


def test_a_table_ingested_twice_leaves_one_row_a_class(make_docs):
    rows = [(i, f"text number {i} of a small table with words enough") for i in range(5)] + [(7, "one"), (7, "two"), (7, "two")]
    df = make_docs(rows + rows + [(9, rows[0][1])])
    kept = keep_first(df).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 2, 3, 4, 7]
    assert {r["text"] for r in kept if r["doc_id"] == 7} == {r["text"] for r in keep_first(df.repartition(5)).collect() if r["doc_id"] == 7}


def test_one_id_with_two_texts_links_their_classes(make_docs):
    a, b = " ".join("a%d" % i for i in range(20)), " ".join("b%d" % i for i in range(20))
    assert classes(near_duplicates(make_docs([(1, a), (2, a), (2, b), (3, b)]))) == [(1, 1), (2, 1), (2, 1), (3, 1)]


def test_every_text_of_an_id_is_verified(make_docs):
    """Near copies of either text of a doc_id, whichever row comes first."""
    a, b = [["%s%d" % (x, i) for i in range(60)] for x in "ab"]
    near_a, near_b = [" ".join([*x[:-1], "z"]) for x in (a, b)]
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near_a), (6, near_b), (8, " ".join(b)), (9, "alone"), (3, "other one"), (4, "other one")]
    for order in (rows, rows[::-1], [rows[1], rows[0], *rows[2:]]):
        assert set(classes(near_duplicates(make_docs(order)))) == {(5, 5), (6, 5), (7, 5), (8, 5), (9, 9), (3, 3), (4, 3)}
    # an id that is the smallest of neither text still links both
    assert set(classes(near_duplicates(make_docs([(1, near_a), (9, " ".join(a)), (9, " ".join(b)), (2, near_b)])))) == {(1, 1), (9, 1), (2, 1)}


def test_copies_without_an_id_do_not_stay(make_docs):
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, "A b c d e f"), (None, "lone text"), (None, "Lone, text"), (None, None), (None, "")]
    out = keep_first(make_docs(rows).selectExpr("*", "1 AS _same"))
    kept = [(r["doc_id"], (r["text"] or "").lower().replace(",", "")) for r in out.collect()]
    assert sorted(kept, key=str) == sorted([(1, "a b c d e f"), (None, "lone text"), (None, "")], key=str)


def test_whole_table(spark):
    docs = table(spark, TABLES, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert classes(near_duplicates(docs)) == brute(rows)


def test_no_query_only_counts_rows(spark, make_docs, monkeypatch):
    """Every count comes with the write of its table, and each round lets the driver drop broadcasts."""
    rows = [(i, " ".join(f"w{g}x{k}" for k in range(40 + i % 3))) for i, g in enumerate([1, 1, 1, 2, 2, 3])]
    docs, frame, rounds = make_docs(rows), type(spark.range(0)), []
    monkeypatch.setattr(near_dedup, "free_broadcasts", rounds.append)
    with monkeypatch.context() as m:
        m.setattr(frame, "count", lambda self: 1 / 0)
        m.setattr(frame, "isEmpty", lambda self: 1 / 0)
        out = near_duplicates(docs)
    assert classes(out) == brute(rows) and rounds
    for n in (0, 7):
        table_ = written(spark.range(n), "counted", watch={"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
        assert (watched(table_), watched(table_, "odd")) == (n, n // 2) == (table_.count(), table_.where("id % 2 = 1").count())
