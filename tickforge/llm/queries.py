"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import ann, byte_bpe, chat, decontam, langid, lexical, near_dedup, quality, repeats, secret_scan, sentencepiece_codec, warc, whitening
from tickforge.llm.common import table, written


def model_bytes(path: str | None = None) -> bytes:
    """A SentencePiece model file; by default the public one installed with the tokenizers."""
    if path is None:
        path = "/opt/tokenizers/piece_bpe_32k.model"
    with open(path, "rb") as f:
        return f.read()


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), model_bytes())


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = written(secret_scan.scan(table(spark, sf_dir, "documents")), "secrets-scanned")
    return secret_scan.label(scanned, secret_scan.train(scanned))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, sf_dir)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score_documents(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predict_documents(documents, langid.train(documents))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    coded = byte_bpe.decode_documents(byte_bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_table(table(spark, sf_dir, "embeddings"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corpus_pipeline import run

    own = (op1_chat_format, op2_sentencepiece, op3_ann, op4_decontamination, op5_secret_scan, op6_warc, op7_near_dedup, op8_quality, op9_langid, op10_suffix_dedup, op11_byte_bpe, op12_whitening, op13_lexical)
    return {f.__name__: f for f in own} | {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    from tickforge.llm import oracles

    return oracles.SQL
