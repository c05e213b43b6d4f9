import hashlib
import random

import numpy as np

from tickforge.llm.common import table
from tickforge.llm.repeats import remove_repeats, repeated_in_shard, windows
from tickforge.llm.common import Powers
from tickforge.llm.suffix_array import common_prefixes, suffix_array

from .conftest import TABLES


def brute(rows, least=50):
    """The definition, string by string."""
    first: dict[bytes, int] = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        if i is not None:
            for p in range(len(raw) - least + 1):
                s = raw[p : p + least]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        if i is not None:
            for p in range(len(raw) - least + 1):
                if first[raw[p : p + least]] < i:
                    gone[p : p + least] = True
        runs = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_suffix_array_matches_sorting():
    rng = random.Random(1)
    for _ in range(150):
        k = rng.randint(1, 4)
        t = [rng.randint(1, k) for _ in range(rng.randint(1, 80))] + [0]
        assert suffix_array(np.array(t), k + 1).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_long_alphabets_use_the_same_order():
    rng = random.Random(2)
    t = [rng.randint(1, 3000) for _ in range(4000)] + [0]
    assert suffix_array(np.array(t), 3001).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_common_prefixes():
    raw = np.frombuffer(b"abcabcabcdabcabcabce" * 3, dtype=np.uint8)
    before = np.arange(len(raw)) - 1
    out = common_prefixes(raw, before, 50)
    for i in range(1, len(raw)):
        n = 0
        while n < 50 and i + n < len(raw) and raw[i + n] == raw[i - 1 + n]:
            n += 1
        assert out[i] == n or i + n == len(raw)


def test_shard_finds_strings_of_smaller_owners():
    a, b = b"x" * 10 + b"0123456789" * 6 + b"y", b"zz" + b"0123456789" * 6
    first, second = repeated_in_shard([a, b], np.array([1, 2]))
    assert len(first) == 0 and second.tolist() == list(range(2, 13))


def test_windows_hold_every_string_once():
    raw = bytes(random.Random(3).choices(b"abcdef ", k=3000))
    sizes = np.array([700, 0, 30, 2270])
    text, lo, hi, _, _ = windows(raw, sizes, Powers())
    seen = sorted(p for a, b in zip(lo, hi) for p in range(a, b + 1))
    assert seen == list(range(0, 651)) + list(range(730, 2951))
    assert text.tolist() == sorted(text.tolist())


def test_random_texts(make_docs):
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcd ", k=rng.randint(40, 160))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            parts.append(rng.choice([p, p[: rng.randint(0, len(p))], p[rng.randint(0, len(p)) :], "".join(rng.choices("abcdefé ", k=rng.randint(0, 80)))]))
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (None, passages[0] * 3), (5, rows[7][1]), (8, rows[8][1]), (8, rows[8][1]), (102, "a" * 500), (103, "a" * 300 + "b"), (104, "é" * 100), (105, "é" * 90)]
    df = make_docs(rows).repartition(5)
    assert got(remove_repeats(df)) == brute(rows)
    # tiny shards and the path of anchors with many windows give the same result
    assert got(remove_repeats(df, shard_bytes=200, hot_windows=2)) == brute(rows)


def test_empty_and_extra_columns(spark, make_docs):
    assert got(remove_repeats(make_docs([]))) == []
    df = make_docs([(1, "x" * 60), (2, "x" * 60)]).selectExpr("*", "1 AS anchor", "2 AS window", "3 AS raw", "'q' AS start")
    assert [r[2] for r in got(remove_repeats(df))] == [0, 60]


def test_whole_table(spark):
    docs = table(spark, TABLES, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(remove_repeats(docs)) == brute(rows)
