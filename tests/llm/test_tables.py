"""Chats, vectors, archives, the pipeline and the entry."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pytest

from tickforge.llm import ann, chat, warc
from tickforge.llm.common import table
from tickforge.session import scratch_dir

from .conftest import TABLES


# -- chats -----------------------------------------------------------------------------------


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(chat.SQL).fetchall(), key=str)


def test_snapshots_against_sql(spark):
    rng = random.Random(1)
    rows = []
    for c in range(80):
        base = rng.randrange(12)
        rows += [(c, t, ["user", "assistant"][t % 2], f"text {base} {t if rng.random() < 0.95 else 'x'}") for t in range(rng.randint(1, 8))]
    rows += rows[:5] + [(200, None, None, None), (200, 1, "user", ""), (None, 1, "user", "a"), (None, None, "user", "b"), (201, 1, "user", "tie 1"), (201, 1, "user", "tie 2")]
    rows += [(300, t, "user", f"long {t}") for t in range(700)] + [(301, t, "user", f"long {t}") for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS position")
    for partitions in (1, 7):
        hashed = chat.prefix_hashes(df.repartition(3), partitions)
        out = chat.render(chat.maximal(hashed))
        assert sorted((tuple(r) for r in out.collect()), key=str) == by_sql(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


# -- vectors ---------------------------------------------------------------------------------


def exact(rows, neighbours=5):
    out = {}
    for q, v in rows:
        if q % 50 == 0:
            near = [(-(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [i for _, i in sorted((round(s, 12), i) for s, i in near)[:neighbours]]
    return out


def test_recall_and_scores(spark):
    vectors = table(spark, TABLES, "embeddings")
    rows = [(r[0], np.array(r[1], dtype=float)) for r in vectors.select("vec_id", "embedding").collect()]
    out = ann.nearest(vectors, shard_rows=100).collect()  # several shards
    want = exact(rows)
    got = {}
    for r in out:
        got.setdefault(r["query_id"], {})[r["rank"]] = r
    hit = sum(len({x["vec_id"] for x in got[q].values()} & set(w)) for q, w in want.items())
    assert hit >= 0.95 * sum(map(len, want.values())) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    by = dict(rows)
    for r in out:
        a, b = by[r["query_id"]], by[r["vec_id"]]
        assert r["score"] == pytest.approx(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-12)


def test_graph_is_diverse_and_bounded():
    rng = np.random.default_rng(0)
    u = ann._units(rng.normal(size=(1500, 16)))
    graph, start = ann.build_graph(u, degree=12, beam=32)
    assert graph.shape == (1500, 12) and all(i not in set(row) for i, row in enumerate(graph))
    found, dist = ann.beam_search(graph, u, start, u[:200], 48)
    want = np.argsort(-(u[:200] @ u.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b[:5])) / 5 for a, b in zip(want, found)]) > 0.9
    assert (np.diff(np.where(np.isfinite(dist), dist, 9), axis=1) >= 0).all()


def test_copies_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 120)] + [(200, [2.0, 1.0]), (250, None), (300, [0.0, 0.0]), (350, [float("nan"), 1.0]), (400, [1.0, None]), (450, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (200, [2.0, 1.0]), (451, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS shard", "3 AS vec", "4 AS label")
    out = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    assert out == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 200: [0, 1, 2, 3, 4]}
    assert ann.nearest(df.limit(0)).count() == 0


# -- archives --------------------------------------------------------------------------------


def described(rows, least=0):
    keeper = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= least and i is not None:
            keeper[p] = max(keeper.get(p, i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        k = keeper.get(p)
        revisit = i is not None and k is not None and k != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_archive_round_trip(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h{rng.randrange(3)}.example.com/p{rng.randrange(40)}?q={rng.randrange(3)}", rng.choice(["<p>é</p>" * rng.randint(0, 50), f"<b>{i}</b>", "", None])) for i in range(1500)]
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, "http://[bad", "y"), (2003, "not a url\nat all", "z\r\n\r\nWARC/1.1"), (2004, "HTTP://WWW.Example.COM:8080/A?b#c", "q"), (None, "http://h0.example.com/", "nobody"), (2005, "http://h0.example.com/", "l" * 2_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS digest", "3 AS keeper")
    for least in (0, 10):
        root = scratch_dir(spark, "warc-test")
        manifest = warc.write_archives(df, root, least_bytes=least, partitions=5)
        out = warc.lookup(df, root, manifest, partitions=3)
        assert sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=str) == described(rows, least)
    whole = {r["page_id"]: bytes(r["payload"]) for r in out.where("record_type = 'response'").collect()}
    assert whole[2005] == b"l" * 2_000_000 and whole[2003] == b"z\r\n\r\nWARC/1.1"
    some = spark.createDataFrame([(rows[3][1], 3), ("http://nowhere.example.com/", 1), (rows[4][1], 5000)], "url string, page_id long")
    assert [r["page_id"] for r in warc.lookup(some, root, manifest).collect()] == [3]


def test_keys_reverse_hosts():
    assert warc.url_key("http://WWW.Example.com:8080/a/B?c=d#e") == "com,example,www:8080)/a/B?c=d"
    assert warc.url_key("https://example.com") == "com,example)/" and warc.url_key(None) == ")/"


def test_repeated_pages_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a/", "x"), (1, "http://a/", "x"), (0, "http://b/", "x")], "page_id long, url string, html string")
    root = scratch_dir(spark, "warc-test")
    out = warc.lookup(df, root, warc.write_archives(df, root))
    assert sorted((r["page_id"], r["record_type"]) for r in out.collect()) == [(0, "revisit"), (1, "response"), (1, "response")]
    assert warc.lookup(df.limit(0), root, warc.write_archives(df.limit(0), root)).count() == 0


def test_whole_pages_table(spark):
    rows = [tuple(r) for r in table(spark, TABLES, "pages").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in warc.archive_pages(spark, TABLES).select(*COLUMNS).collect()), key=str) == described(rows)


# -- pipeline and entry ----------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    from .test_near_dedup import brute
    from .test_texts import brute_leaks, contract
    from tickforge.llm.common import written

    docs = table(spark, TABLES, "documents")
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece_encoding"]
    (_, good), (_, near), (_, leak), (_, scan), (_, encode) = p.STAGES
    kept = written(good(spark, docs, TABLES), "test")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, TABLES, "labels").collect()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and np.mean([(i in ids) == (q == 1) for i, q in labels.items()]) > 0.97
    one = written(near(spark, kept, TABLES), "test")
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == {c for _, c in brute(rows)}
    clean = written(leak(spark, one, TABLES), "test")
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, TABLES, "benchmark").collect()]
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in brute_leaks(rows, items)}
    safe = written(scan(spark, clean, TABLES), "test")
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    after = {r["doc_id"]: r["text"] for r in safe.collect()}
    assert safe.columns == docs.columns and before.keys() == after.keys()
    assert not any(contract(t) for t in after.values()) and all(after[i] == t for i, t in before.items() if not contract(t))
    last = encode(spark, safe, TABLES).collect()
    assert len(last) == len(after) and all(r["round_trip"] for r in last)


def test_entry_lists_the_operators():
    import __spark_entry__ as e

    names = list(e.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)] and "pipeline" in names
    assert set(e.oracle_sql()) <= set(names)


def test_nearest_of_extreme_norms(spark):
    rng = np.random.default_rng(9)
    plain = rng.normal(size=(120, 8))
    scale = np.choose(np.arange(120) % 3, [1e-200, 1.0, 1e200])[:, None]
    frame = lambda v: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    want = {(r["query_id"], r["rank"]): r for r in ann.nearest(frame(plain)).collect()}
    got = {(r["query_id"], r["rank"]): r for r in ann.nearest(frame(plain * scale)).collect()}
    assert got.keys() == want.keys() and len(got) == 15
    for k, r in got.items():
        assert r["vec_id"] == want[k]["vec_id"] and abs(r["score"] - want[k]["score"]) < 1e-12
