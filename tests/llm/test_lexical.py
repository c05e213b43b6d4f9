"""Ranked lexical search against plain scoring of every document."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import lexical
from tickforge.llm.common import table
from tickforge.llm.queries import op13_lexical

from .conftest import TABLES


def brute(docs, items, top=lexical.TOP):
    """(item_id, rank, doc_id, score) by the definition, in Python integers."""
    counts = [(i, Counter(lexical.terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(lexical.terms_of(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counts:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
            score = sum(k * lexical.weight(n_docs, df[t]) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in terms.items() if c[t])
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(scored[:top], 1)]
    return sorted(out)


def found(index, items, **how):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(index, items, **how).collect())


def test_terms():
    assert lexical.terms_of("Ab-c_d É\x7fx1\u00a0y \x00Z") == ["ab", "c", "d", "É", "x1\u00a0y", "z"]
    assert lexical.terms_of(None) == lexical.terms_of(" .,") == []


def test_variable_length_numbers():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.arange(300), 2 ** rng.integers(0, 40, 200) + rng.integers(0, 3, 200)]).astype(np.int64)
    raw, size = lexical.pack(values)
    assert size.sum() == len(raw) and (lexical.unpack(raw) == values).all()


def test_blocks_are_skipped_and_results_whole():
    rng = np.random.default_rng(4)
    norm = rng.integers(75, 300, 40_000)
    lists = []
    for share, times in ((0.9, 40), (0.7, 90), (0.5, 300), (0.02, 5_000), (0.01, 6_000), (0.001, 9_000)):
        places = np.flatnonzero(rng.random(len(norm)) < share)
        tf = rng.geometric(0.6, len(places)).astype(np.int64)
        impact = lexical.impacts(tf, norm[places])
        heads = np.arange(0, len(places), lexical.BLOCK)
        steps = np.diff(places, prepend=0)
        steps[heads] = places[heads]
        raw, size = lexical.pack(np.stack([steps, tf - 1], axis=1).ravel())
        at = np.concatenate([[0], np.cumsum(size.reshape(-1, 2).sum(axis=1))])[heads]
        last = places[np.append(heads[1:], len(places)) - 1]
        lists.append((lexical.PostingList(times, int(impact.max()), lexical.Postings(len(places), last, np.maximum.reduceat(impact, heads), at, raw.tobytes())), places, times * impact))
    total = np.zeros(len(norm), dtype=np.int64)
    for _, places, scores in lists:
        total[places] += scores
    places, scores = lexical.max_score([x for x, _, _ in lists], norm)
    best = sorted(zip(-total, range(len(total))))[:20]
    assert sorted(zip(-scores, places))[:20] == best and (total[places] == scores).all()
    read, whole = (sum(f(x.postings.have) for x, _, _ in lists[:3]) for f in (sum, len))
    assert read < whole / 2


@pytest.mark.parametrize("shard_chars,item_block", [(400, 3), (10**9, 500)])
def test_against_plain_scoring(spark, make_docs, shard_chars, item_block):
    rng = random.Random(13)
    words = [f"w{int(rng.paretovariate(0.5)) % 300}" for _ in range(400)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    docs += [(7, docs[7][1])] * 3 + [(900, docs[8][1]), (None, docs[8][1]), (901, None), (902, ""), (903, "... !"), (904, "w1 " * 5000)]
    items = [(k, " ".join(rng.choice(words).upper() for _ in range(rng.randrange(1, 25)))) for k in range(12)]
    items += [(3, "w1 w1 w2"), (3, "w1 w1 w2"), (None, "w1"), (50, None), (51, "unheard"), (52, docs[8][1])]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns({"term": F.lit(1), "block": F.lit("x")})
    clash = make_docs(docs).withColumns({"term": F.lit("x"), "shard": F.lit(2), "score": F.lit(None).cast("int")})
    index = lexical.build_index(clash.repartition(4, "doc_id"), shard_chars=shard_chars)
    assert found(index, frame, item_block=item_block) == brute(docs, items)


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(lexical.build_index(make_docs([])), items) == []
    assert found(lexical.build_index(make_docs([(1, None), (2, "!")])), items) == []
    index = lexical.build_index(make_docs([(1, "a b"), (2, "c")]))
    assert found(index, items.where("false")) == []
    assert [x[2] for x in found(index, items)] == [1]


def test_whole_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, TABLES, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, TABLES, "benchmark").collect()]
    want = brute(docs, items)
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in op13_lexical(spark, TABLES).collect()) == want
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    assert sorted(con.execute(lexical.SQL).fetchall()) == want
