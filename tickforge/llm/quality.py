"""Quality classifier: histogram gradient-boosted trees over document statistics.

``document_features`` turns a whole text into a row of numbers. ``fit`` bins each feature into
quantile bins and grows small trees on the logistic loss from per-bin gradient histograms; the
forest is flattened into arrays (feature, threshold, children, leaf value) and ``Forest.score``
walks all trees for all rows of a batch at once in numpy.

The fit uses at most ``sample_rows`` labelled documents (chosen by a hash of the id, so the
choice does not depend on partitioning); everything else covers all rows. The driver sees only
the feature rows of that sample.

Defined cases: a NULL text counts as empty and is scored like any other text; a NULL doc_id has
no fold (``held_out`` NULL) and never trains; labels that are NULL are ignored; several labels of
one document count as their mean (>= 0.5 is 1); repeated documents are scored each; without any
training label every score is 0.5, with one class the forest is a constant.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import by_id, fold, hash_below, map_texts, texts_of

#: Bound of the fitting sample (labelled documents).
SAMPLE_ROWS = 20_000
#: A document is kept when its score reaches this.
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "top_word", "log_lines", "line_words", "distinct_lines",
    "longest_line", "upper", "digit", "space", "punctuation", "non_ascii", "exclamation", "hash_dollar", "percent_and",
    "star", "pipe", "symbol_words", "compressed", "stop_period", "short_words",
)
_SYMBOLS = frozenset("!#$%&*|<>{}[]=_~^@\\")


def document_features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text, over the whole text."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=1)
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        n = len(raw)
        words = text.split()
        lines = text.split("\n")
        c = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        m, b = max(len(words), 1), max(n, 1)
        ascii_symbols = c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()
        out[i] = (
            np.log1p(n), np.log1p(len(words)), (n - c[32] - c[10]) / m, len(counts) / m, max(counts.values(), default=0) / m,
            np.log1p(len(lines)), len(words) / len(lines), len(set(lines)) / len(lines), max(map(len, lines)) / b,
            c[65:91].sum() / b, c[48:58].sum() / b, (c[32] + c[10]) / b, ascii_symbols / b, c[128:].sum() / b, c[33] / b,
            (c[35] + c[36]) / b, (c[37] + c[38]) / b, c[42] / b, c[124] / b,
            sum(k for w, k in counts.items() if w[-1] in _SYMBOLS) / m, len(packer.compress(raw)) / b, c[46] / m,
            sum(k for w, k in counts.items() if len(w) <= 2) / m,
        )
    return out


@dataclass(frozen=True)
class Forest:
    """Trees side by side in flat arrays; a leaf's children point to itself."""

    base: float
    depth: int
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.root, (len(x), len(self.root))).copy()
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: int = 10) -> Forest:
    """Boost ``trees`` trees of ``depth`` levels on quantile-binned features (logistic loss)."""
    feature, threshold, left, right, value, root = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        for a, v in ((feature, 0), (threshold, 0.0), (left, k), (right, k), (value, 0.0)):
            a.append(v)
        return k

    n, width = x.shape if x.size else (0, len(FEATURES))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(share / (1 - share)))
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        offset = np.arange(width) * bins
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            root.append(node())
            work = [(root[-1], np.arange(n), 0)]
            while work:
                k, rows, level = work.pop()
                g, h = grad[rows].sum(), hess[rows].sum()
                best = (1e-6, -1, -1)
                if level < depth and len(rows) >= 2 * least:
                    flat = (binned[rows] + offset).ravel()
                    hist = [np.bincount(flat, np.repeat(w, width), width * bins).reshape(width, bins).cumsum(1) for w in (grad[rows], hess[rows], np.ones(len(rows)))]
                    gl, hl, nl = (a[:, :-1] for a in hist)
                    gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    f, b = divmod(int(gain.argmax()), bins - 1)
                    if gain[f, b] > best[0] and b < len(edges[f]):
                        best = (gain[f, b], f, b)
                if best[1] < 0:
                    value[k] = -rate * g / (h + l2)
                    margin[rows] += value[k]
                    continue
                feature[k], threshold[k] = best[1], float(edges[best[1]][best[2]])
                below = binned[rows, best[1]] <= best[2]
                left[k], right[k] = node(), node()
                work += [(left[k], rows[below], level + 1), (right[k], rows[~below], level + 1)]
    if not root:
        root.append(node())
    return Forest(base, depth, np.array(root), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def train(documents: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, folds: int = 5, held_out: int = 0) -> Forest:
    """Fit on at most about ``sample_rows`` labelled documents outside fold ``held_out``."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where(F.col("quality").isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    total = known.count()
    # Bounded by sample_rows (a documented parameter), hence small enough to broadcast.
    sample = known.where(hash_below(F.col("doc_id"), min(1.0, sample_rows / max(total, 1)), "quality"))
    rows = by_id(documents).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")

    def featurize(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = document_features(texts_of(batch))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    got = map_texts(rows, featurize, "doc_id long, label int, x array<double>").toPandas()
    got = got.sort_values(["doc_id"], kind="stable")
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), -1) if len(got) else np.zeros((0, len(FEATURES)))
    # A fixed row order makes the fit repeatable, whatever the partitions were.
    order = np.lexsort((*x.T, got["label"].to_numpy())) if len(got) else []
    return fit(x[order], got["label"].to_numpy(dtype=float)[order] if len(got) else np.zeros(0))


def score_documents(documents: DataFrame, forest: Forest, *, threshold: float = THRESHOLD, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = forest.score(document_features(texts_of(batch)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = map_texts(by_id(documents), run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", "predicted")


def keep_good(documents: DataFrame, forest: Forest, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns) that the forest does not reject."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(forest.score(document_features(texts_of(batch))) >= threshold))

    return map_texts(documents, run, documents.schema)
