"""Language identification by compression.

Every language gets a zstandard raw-content dictionary cut from documents of that language; a
text is compressed whole with each dictionary and belongs to the language whose dictionary makes
it smallest. When the runner-up is nearly as small, the decision is marked as not accepted.

The dictionaries come from at most ``sample_docs`` documents a language (chosen by a hash of the
id) and hold ``dictionary_bytes`` each; predictions cover all rows and whole texts.

Defined cases: NULL text or a text without any letter is ``und`` with score 0 and not accepted; a
NULL doc_id has no fold (``held_out`` NULL) and never trains; NULL languages never train; equal
sizes go to the language first in alphabetical order; with no learned language all is ``und``;
repeated rows are predicted each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, fold, hash_below, map_texts

SAMPLE_DOCS = 400
DICTIONARY_BYTES = 96 * 1024
LEVEL = 6
#: Bytes saved by the best dictionary over the next, as a share of the size; less is rejected.
MARGIN = 0.01

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case words parted by single spaces; digits and punctuation say nothing here."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def train(documents: DataFrame, *, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES, folds: int = 4, held_out: int = 2) -> dict[str, bytes]:
    """language -> raw dictionary content."""
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held_out)
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(10_001).collect()}
    if len(counts) > 10_000:
        raise ValueError("lang holds more than 10,000 values; it is no language column")
    if not counts:
        return {}
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / n)))))
    picked = known.where(hash_below(F.col("doc_id"), share[F.col("lang")], "langid"))
    # The dictionary is a bounded excerpt: the sampled documents share its bytes evenly.
    piece = max(256, 4 * dictionary_bytes // sample_docs)

    def excerpt(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [letters(t)[:piece] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2)], ["doc_id", "text", "lang"])

    rows = map_texts(picked, excerpt, "doc_id long, text string, lang string").toPandas().sort_values(["lang", "doc_id", "text"])
    out = {}
    for lang, group in rows.groupby("lang"):
        content = "\n".join(dict.fromkeys(group["text"])).encode()
        out[lang] = content[:dictionary_bytes] if len(content) >= 8 else content.ljust(8)
    return out


class Compressors:
    """One prepared compressor a language (built once a task)."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.langs = sorted(dictionaries)
        self.packers = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.packers.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        """(language, score 0..1, accepted)."""
        plain = letters(text or "")
        # Numerals such as superscripts and fractions are word characters, too, but no letters.
        if not self.langs or not any(map(str.isalpha, plain)):
            return "und", 0.0, False
        raw = plain.encode("utf-8", "surrogatepass")
        sizes = np.array([len(p.compress(raw)) for p in self.packers], dtype=float)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        gap = (others.min() - sizes[best]) / max(sizes[best], 1.0) if len(others) else 1.0
        weight = np.exp2(-np.minimum(8 * (sizes - sizes[best]), 60))
        return self.langs[best], float(1 / weight.sum()), bool(gap >= margin)


def predict_documents(documents: DataFrame, dictionaries: dict[str, bytes], *, level: int = LEVEL, margin: float = MARGIN, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every document."""
    # The dictionaries are bounded: DICTIONARY_BYTES a language.
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)
    ready: list[Compressors] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Compressors(shared.value, level))
        got = [ready[0].predict(t, margin) for t in batch.column(1).to_pylist()]
        lang, score, accepted = zip(*got)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(accepted)], ["doc_id", "lang_pred", "score", "accepted"])

    out = map_texts(by_id(documents), run, "doc_id long, lang_pred string, score double, accepted boolean")
    return out.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "lang_pred", "score", "accepted")
