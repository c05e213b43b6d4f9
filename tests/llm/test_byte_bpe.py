"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickforge.llm import byte_bpe
from tickforge.llm.common import table
from tickforge.llm.queries import op11_byte_bpe

from .conftest import TABLES

RANKS = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "it's  we'll\n\n they're", "<|endoftext|>", "日本語 😀 ẞ", "a" * 700, " " * 300 + "x", "١٢٣ ² x", "\u0000a", "!?" * 200, "é́ '"]


def _coded(df, **how):
    return byte_bpe.decode_documents(byte_bpe.encode_documents(df, RANKS, P.PATTERN, **how), RANKS, P.PATTERN)


def _same(df, rows, **how):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"], bytes(r["decoded"])) for r in _coded(df, **how).collect())
    want = sorted((i is None, i or 0, THEIRS.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert got == want


def test_cases_short_and_chunked(make_docs):
    rows = [*enumerate(ODD), (None, "null id"), (None, "null id"), (50, None), (50, "again " * 60), (50, "again " * 60)]
    clash = make_docs(rows).withColumns({"ids": F.lit(1), "chunk": F.lit("x"), "text_": F.lit(None).cast("string")})
    _same(clash, rows)
    _same(clash, rows, chunk_chars=64, overlap=24)
    assert _coded(make_docs([])).count() == 0


def test_chunks_cut_anywhere(make_docs):
    rng = random.Random(11)
    bits = ["'", "'s", "'r", "'re", "'ll", " ", "  ", "\n", "a", "Word", "12", "²", "é", "!", "...", "日", "\t", "'l"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60, 400)))) for i in range(250)]
    _same(make_docs(rows), rows, chunk_chars=rng.randrange(37, 50), overlap=20)


def test_runs_longer_than_the_overlap(make_docs):
    rows = [(1, "w " * 30 + "x" * 500 + " y" * 30), (2, "w " * 30 + " " * 500 + "y z" * 30), (3, "é!" * 20 + "1" * 333)]
    _same(make_docs(rows), rows, chunk_chars=50, overlap=20)


def test_a_very_long_text(make_docs):
    text = " ".join(f"w{i * 7919 % 1000}'s" for i in range(60_000))
    rows = [(1, text), (2, "short")]
    _same(make_docs(rows), rows)


def test_whole_table_digests(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, TABLES, "documents").select("doc_id", "text").collect()}
    rows = op11_byte_bpe(spark, TABLES).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = THEIRS.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_ranks_with_gaps_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.Coder({b"a": 0, b"b": 2}, P.PATTERN)
