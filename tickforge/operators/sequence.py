"""Row positions and ordered row-frame windows that never put a whole group in one task.

``with_sequence`` gives every row its 0-based position ``seq`` inside its group (or the whole
table) under a total order:

1. one small job counts the rows and the range of the leading order column; rows are put into
   buckets by approximate quantiles of that column when the size bound needs it (``Bucketizer``
   over ``percentile_approx`` edges, so bursts in time are split) or by equal-width ranges when
   only parallelism asks for buckets; a value repeated over several quantile edges (a hot tie)
   gets its own bucket and is numbered recursively by the next order column;
2. rows are counted per (group, bucket) -- a partial aggregate, a hot group is pre-reduced
   on every mapper;
3. the small count table is turned into running offsets per group (and the group size and
   requested group minima are attached to it);
4. rows are numbered inside their bucket; ``seq = offset + row_number - 1``.

The join of step 3 and the numbering of step 4 share one hash exchange on (group, bucket).

``ordered_windows`` cuts every group's sequence into fixed-size blocks, copies the last
``lookback`` rows of a block into the next block (and the first ``lookahead`` rows into the
previous one), evaluates the windows per (group, block) and keeps the block's own rows. A hot
group is therefore spread over ``n / block_rows`` tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

GKEY = "_tf_group"
BUCKET = "_tf_bucket"
OFFSET = "_tf_offset"
BLOCK = "_tf_block"
OWN = "_tf_own"

DEFAULT_ROWS_PER_BUCKET = 2_000_000
MIN_ROWS_PER_BUCKET = 4_096
DEFAULT_BLOCK_ROWS = 65_536
MAX_BUCKETS = 200_000


def _is_global(df: DataFrame) -> bool:
    """The group key of a sequence without groups is the integer constant 0 (else a struct)."""
    from pyspark.sql.types import StructType

    return not isinstance(df.schema[GKEY].dataType, StructType)


def content_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """Deterministic 64-bit hash of a row's hashable columns (map columns are skipped)."""
    from pyspark.sql.types import MapType

    usable = [F.col(c) for c in cols if not isinstance(df.schema[c].dataType, MapType)]
    return F.xxhash64(*usable) if usable else F.lit(0).cast("bigint")


def group_key(group_cols: Sequence[str]) -> Column:
    """One non-null column standing for the group (struct equality treats NULL fields as equal)."""
    if not group_cols:
        return F.lit(0)
    return F.struct(*[F.col(c) for c in group_cols])


def _order_exprs(order_cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_cols]


def _number(col: str) -> Column:
    """The column as a double for bucket edges; NaN counts as NULL (both go to the last bucket)."""
    number = F.col(col).cast("double")
    return F.when(~F.isnan(number), number)


def quantile_edges(df: DataFrame, col: str, n_buckets: int) -> tuple[list[float], list[float]]:
    """Approximate quantile edges splitting ``col`` into ``n_buckets`` similar-size parts.

    Returns (distinct edges, hot values). A value that comes out as two or more edges holds more
    than a bucket's worth of rows by itself (a tie in the order key): it is returned as hot, so
    that its rows get their own bucket and are numbered by the next order column."""
    if n_buckets <= 1:
        return [], []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    # Edges only need to be right to a fraction of a bucket: rank error <= n / (4 * buckets)
    # keeps the sketch per partial aggregate small even for many buckets.
    accuracy = max(10_000, 4 * n_buckets)
    row = df.agg(F.percentile_approx(_number(col), probs, accuracy).alias("e")).first()
    vals = [float(v) for v in ((row["e"] if row is not None else None) or []) if v is not None and not math.isnan(v)]
    counts: dict[float, int] = {}
    for v in vals:
        counts[v] = counts.get(v, 0) + 1
    return sorted(counts), sorted(v for v, c in counts.items() if c >= 2)


@dataclass(frozen=True)
class BucketPlan:
    """Row count of the input and the bucket edges of its leading order column."""

    n: int
    edges: tuple[float, ...]
    hot: tuple[float, ...] = ()
    constant: bool = False  # every row has the same (non-NULL) leading value


def plan_buckets(df: DataFrame, key: str, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> BucketPlan:
    """One small job: count and range of ``key``. When the size bound needs several buckets the
    edges are approximate quantiles (a second job; bursts in time are split); when only the
    parallelism floor asks for buckets, equal-width edges over the range are enough."""
    number = _number(key)
    row = df.agg(F.count(F.lit(1)), F.min(number), F.max(number), F.count(key), F.min(key).eqNullSafe(F.max(key))).first()
    n, lo, hi = int(row[0]), row[1], row[2]
    if n and int(row[3]) == n and row[4]:
        return BucketPlan(n, (), constant=True)
    k = bucket_count(df.sparkSession, n, rows_per_bucket)
    if k <= 1 or lo is None or hi is None or hi <= lo:
        return BucketPlan(n, ())
    if math.ceil(n / max(1, rows_per_bucket)) > 1:
        edges, hot = quantile_edges(df, key, k)
        # [v, next double above v) holds exactly the rows whose key equals the hot value v.
        isolated = sorted(set(edges) | {math.nextafter(v, math.inf) for v in hot})
        return BucketPlan(n, tuple(isolated), tuple(hot))
    return BucketPlan(n, tuple(lo + (hi - lo) * i / k for i in range(1, k)))


def bucket_count(spark, n: int, rows_per_bucket: int) -> int:
    """Enough buckets to keep each under ``rows_per_bucket`` rows, and (for inputs of more than a
    few thousand rows) at least two per core so numbering never runs in a single task."""
    by_size = math.ceil(n / max(1, rows_per_bucket))
    cores = max(1, spark.sparkContext.defaultParallelism)
    by_cores = min(2 * cores, n // MIN_ROWS_PER_BUCKET)
    return min(MAX_BUCKETS, max(1, by_size, by_cores))


def with_bucket(df: DataFrame, key: str, edges: list[float]) -> DataFrame:
    if not edges:
        return df.withColumn(BUCKET, F.lit(0))
    tmp = "_tf_bkey"
    splits = [-math.inf, *edges, math.inf]
    keyed = df.withColumn(tmp, F.coalesce(F.col(key).cast("double"), F.lit(float("nan"))))
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep").transform(keyed)
    return out.withColumn(BUCKET, F.col(BUCKET).cast("int")).drop(tmp)


def with_sequence(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    *,
    seq_col: str = "seq",
    count_col: str = "n_group",
    min_cols: Sequence[str] = (),
    running_sums: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    plan: BucketPlan | None = None,
) -> DataFrame:
    """G1: add ``seq`` (0-based position in group), ``count_col`` (group size) and the group minimum
    ``min_<c>`` for ``c`` in ``min_cols`` (e.g. the first timestamp). For ``c`` in ``running_sums``
    also ``cum_<c>`` (inclusive running sum in order) and ``total_<c>`` (group sum), carried by
    the same bucket offsets and the same exchange. Keeps the helper group key column
    ``_tf_group`` (dropped by :func:`drop_helpers`).

    Rows tied on a hot value of the leading order column are numbered by the next order column
    (recursively). With a single order column, tied rows are interchangeable and callers rank
    distinct values with counts instead (see :func:`exact_quantiles`)."""
    order_cols, group_cols = list(order_cols), list(group_cols)
    base = df.withColumn(GKEY, group_key(group_cols))
    plan = plan or plan_buckets(df, order_cols[0], rows_per_bucket)
    if plan.constant and len(order_cols) > 1:
        # One leading value for all rows orders nothing: the next column takes its place.
        return with_sequence(
            df, order_cols[1:], group_cols, seq_col=seq_col, count_col=count_col, min_cols=min_cols,
            running_sums=running_sums, rows_per_bucket=rows_per_bucket,
        )
    b = with_bucket(base, order_cols[0], list(plan.edges))

    aggs = [F.count(F.lit(1)).alias("_tf_cnt")]
    aggs += [F.sum(c).alias(f"_tf_bsum_{i}") for i, c in enumerate(running_sums)]
    aggs += [F.min(c).alias(f"_tf_bmin_{i}") for i, c in enumerate(min_cols)]
    stats = b.groupBy(GKEY, BUCKET).agg(*aggs)
    wg = Window.partitionBy(GKEY).orderBy(BUCKET)
    stat_cols = [
        F.col(GKEY),
        F.col(BUCKET),
        F.coalesce(F.sum("_tf_cnt").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(OFFSET),
        F.sum("_tf_cnt").over(Window.partitionBy(GKEY)).alias(count_col),
    ]
    for i, c in enumerate(running_sums):
        prev = F.sum(f"_tf_bsum_{i}").over(wg.rowsBetween(Window.unboundedPreceding, -1))
        stat_cols.append(F.coalesce(prev, F.lit(0)).alias(f"_tf_boff_{i}"))
        stat_cols.append(F.sum(f"_tf_bsum_{i}").over(Window.partitionBy(GKEY)).alias(f"total_{c}"))
    for i, c in enumerate(min_cols):
        stat_cols.append(F.min(f"_tf_bmin_{i}").over(Window.partitionBy(GKEY)).alias(f"min_{c}"))
    stats = stats.select(*stat_cols)

    split_ties = bool(plan.hot) and len(order_cols) > 1
    if split_ties:
        is_tie = F.col(order_cols[0]).cast("double").isin(list(plan.hot))
        tied, b = b.where(is_tie), b.where(~is_tie | F.col(order_cols[0]).isNull())

    joined = b.join(stats, on=[GKEY, BUCKET], how="inner")
    # Rows tied on every order column are ordered by a hash of their content, so a recomputed
    # partition (lost executor) numbers them exactly as the first attempt did.
    content = content_hash(df, df.columns)
    w = Window.partitionBy(GKEY, BUCKET).orderBy(*_order_exprs(order_cols), content)
    out = joined.withColumn(seq_col, F.col(OFFSET) + F.row_number().over(w) - F.lit(1))
    if running_sums:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns(
            {f"cum_{c}": F.col(f"_tf_boff_{i}") + F.sum(c).over(upto) for i, c in enumerate(running_sums)}
        ).drop(*[f"_tf_boff_{i}" for i in range(len(running_sums))])
    out = out.drop(OFFSET, BUCKET)
    if split_ties:
        out = out.unionByName(
            _number_ties(tied, stats, order_cols, group_cols, seq_col, count_col, min_cols, running_sums, rows_per_bucket)
        )
    out._tf_rows = plan.n  # read by ordered_windows to size blocks when called right after
    return out


def _number_ties(tied, stats, order_cols, group_cols, seq_col, count_col, min_cols, running_sums, rows_per_bucket):
    """Rows of hot tie values: each value has its own bucket, whose offset (and running-sum
    offsets) are attached by a size-checked broadcast or a salted join -- never a shuffle keyed
    on the hot bucket --, then the rows are numbered by the remaining order columns with the tie
    value as an extra group, recursively and again without a single task per value.

    Integers beyond 2**53 share a double with their neighbours: the group is the double, and the
    distance of the integer from it is the next order column."""
    from tickforge.operators.joins import attach

    keep = [c for c in stats.columns if c not in (GKEY, BUCKET)]
    t = attach(tied, stats, [GKEY, BUCKET], how="inner").drop(GKEY, BUCKET)
    ren = {OFFSET: "_tf_toff"}
    for i, c in enumerate(running_sums):
        ren[f"_tf_boff_{i}"] = f"_tf_tboff_{i}"
        ren[f"total_{c}"] = f"_tf_ttot_{i}"
    ren[count_col] = "_tf_tn"
    t = t.withColumnsRenamed({k: v for k, v in ren.items() if k in keep})
    rest = order_cols[1:]
    t = t.withColumn("_tf_tie", F.col(order_cols[0]).cast("double"))
    if t.schema[order_cols[0]].dataType.typeName() in ("long", "decimal"):
        t = t.withColumn("_tf_rest", F.col(order_cols[0]).cast("decimal(38,0)") - F.col("_tf_tie").cast("decimal(38,0)"))
        rest = ["_tf_rest", *rest]
    local = with_sequence(
        t, rest, [*group_cols, "_tf_tie"], seq_col="_tf_lseq", count_col="_tf_ln",
        running_sums=running_sums, rows_per_bucket=rows_per_bucket,
    ).drop(GKEY, "_tf_ln", "_tf_tie", "_tf_rest")
    cols = {seq_col: F.col("_tf_toff") + F.col("_tf_lseq"), count_col: F.col("_tf_tn")}
    for i, c in enumerate(running_sums):
        cols[f"cum_{c}"] = F.col(f"_tf_tboff_{i}") + F.col(f"cum_{c}")
        cols[f"total_{c}"] = F.col(f"_tf_ttot_{i}")
    out = local.withColumns(cols).withColumn(GKEY, group_key(group_cols))
    drop = ["_tf_toff", "_tf_lseq", "_tf_tn"] + [f"_tf_tboff_{i}" for i in range(len(running_sums))]
    drop += [f"_tf_ttot_{i}" for i in range(len(running_sums))]
    return out.drop(*drop)


Stage = Callable[[WindowSpec], dict[str, Column]]


def ordered_windows(
    df_seq: DataFrame,
    stages: Sequence[Stage],
    *,
    seq_col: str = "seq",
    lookback: int = 0,
    lookahead: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    n_rows: int | None = None,
) -> DataFrame:
    """Evaluate window stages over ``Window.partitionBy(group, block).orderBy(seq)``.

    ``lookback`` must be at least the longest look-back of any frame or lag (a ``w``-row frame
    looks back ``w-1`` rows), ``lookahead`` the longest lead. Each stage maps the window spec
    to new named columns; later stages may use columns of earlier ones. With ``n_rows`` the
    block size shrinks (never below four halos) until there are about two blocks per core, so
    small inputs are spread as well; ``block_rows`` caps it for large ones.
    """
    if GKEY not in df_seq.columns:
        raise ValueError("ordered_windows expects the output of with_sequence")
    if n_rows is None:
        n_rows = getattr(df_seq, "_tf_rows", None)
    size = block_size(df_seq.sparkSession, n_rows, block_rows, max(lookback, lookahead))
    blk = F.floor(F.col(seq_col) / F.lit(size)).cast("bigint")
    pos = F.col(seq_col) - blk * F.lit(size)
    targets = [blk]
    if lookback > 0:
        targets.append(F.when(pos >= F.lit(size - lookback), blk + 1))
    if lookahead > 0:
        targets.append(F.when((pos < F.lit(lookahead)) & (blk > 0), blk - 1))
    if len(targets) == 1:
        x = df_seq.withColumns({BLOCK: blk, OWN: F.lit(True)})
    else:
        x = df_seq.withColumn(BLOCK, F.explode(F.filter(F.array(*targets), lambda t: t.isNotNull())))
        x = x.withColumn(OWN, F.col(BLOCK) == blk)
    # One exchange on (group, block): explicit so that it also happens when the numbering stage
    # was hash-partitioned on the group alone (single bucket), which would otherwise be reused.
    # The window stage is compute-bound (frames are re-aggregated per row), so its partition
    # count is fixed to the configured shuffle partitions rather than coalesced by bytes.
    parts = int(df_seq.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Without groups the key is a constant, which the optimizer drops from the window's
    # partitioning; partition on the block alone so the requirement is met by this exchange.
    keys = [BLOCK] if _is_global(df_seq) else [GKEY, BLOCK]
    x = x.repartition(parts, *keys)
    w = Window.partitionBy(*keys).orderBy(seq_col)
    for stage in stages:
        x = x.withColumns(stage(w))
    return x.where(F.col(OWN)).drop(BLOCK, OWN)


def block_size(spark, n_rows: int | None, block_rows: int, halo: int) -> int:
    """Rows per block: at most ``block_rows``; with a known row count about four blocks per core
    (hash placement of few blocks is uneven); never below four halos (halo copies stay a small
    share of the rows)."""
    size = int(block_rows)
    if n_rows is not None:
        cores = max(1, spark.sparkContext.defaultParallelism)
        size = min(size, math.ceil(max(1, n_rows) / (4 * cores)))
    return max(size, 4 * int(halo), 1)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(GKEY, BUCKET, OFFSET, BLOCK, OWN)


def rows_frame(w: WindowSpec, size: int) -> WindowSpec:
    """Trailing frame of ``size`` rows ending at the current row (partial frames at the start)."""
    return w.rowsBetween(-(int(size) - 1), 0)


# --------------------------------------------------------------------------- positions


def positional_slices(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    *,
    head: int = 1000,
    tail: int = 1000,
    **seq_kw,
) -> DataFrame:
    """first/second half by position (``iloc[:n//2]``) and first/last ``head``/``tail`` rows."""
    s = with_sequence(df, order_cols, group_cols, **seq_kw)
    n = F.col("n_group")
    return drop_helpers(
        s.withColumns(
            {
                "half": F.when(F.col("seq") < F.floor(n / 2), F.lit("first")).otherwise(F.lit("second")),
                "in_head": F.col("seq") < F.lit(head),
                "in_tail": F.col("seq") >= n - F.lit(tail),
            }
        )
    )


def temporal_split(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    *,
    test_ratio: float = 0.2,
    **seq_kw,
) -> DataFrame:
    """Rows before ``int(n * (1 - test_ratio))`` are train, the rest test (bound in double)."""
    s = with_sequence(df, order_cols, group_cols, **seq_kw)
    bound = F.floor(F.col("n_group").cast("double") * F.lit(1.0 - float(test_ratio)))
    return drop_helpers(s.withColumn("split", F.when(F.col("seq") < bound, F.lit("train")).otherwise(F.lit("test"))))


# --------------------------------------------------------------------------- order statistics


def _evenly_spaced(probs: Sequence[float]) -> bool:
    k = len(probs)
    return k > 2 and all(abs(float(p) - i / (k - 1)) < 1e-12 for i, p in enumerate(probs))


def quantiles_from_counts(
    ranked: DataFrame,
    value_col: str,
    count_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    out_col: str = "edges",
) -> DataFrame:
    """Linear-interpolation quantiles from a table of distinct values ranked in value order with
    running counts (``cum_<count_col>``, ``total_<count_col>`` from :func:`with_sequence`).

    A value covers ranks [cum - count, cum - 1]; it emits the wanted ranks floor/ceil((n-1)p) it
    covers (``2 * len(probs)`` rows per group in total), which are interpolated per p. Few
    probabilities are tested against every row; many evenly spaced ones (transform knots) only
    against the few candidate indices the row's rank range can hit."""
    cum, total, cnt = F.col(f"cum_{count_col}"), F.col(f"total_{count_col}"), F.col(count_col)
    n1 = total - 1
    start, end = cum - cnt, cum - 1
    k = len(probs)
    parr = F.array(*[F.lit(float(p)) for p in probs])

    def entry(i: Column, role: int) -> Column:
        h = n1 * F.element_at(parr, i + 1)
        rank = F.floor(h) if role == 0 else F.ceil(h)
        return F.struct(i.alias("i"), F.lit(role).alias("role"), rank.alias("rank"), (h - F.floor(h)).alias("frac"))

    if k <= MAX_PROBS_BY_VALUE or not _evenly_spaced(probs):
        cands = F.array(*[entry(F.lit(i), role) for i in range(k) for role in (0, 1)])
    else:
        step = F.lit(float(k - 1)) / F.greatest(n1, F.lit(1)).cast("double")
        i_lo = F.greatest(F.floor((start - 1) * step) - 1, F.lit(0)).cast("int")
        i_hi = F.least(F.ceil((end + 1) * step) + 1, F.lit(k - 1)).cast("int")
        idx = F.sequence(i_lo, i_hi)
        cands = F.flatten(F.transform(idx, lambda i: F.array(entry(i, 0), entry(i, 1))))
    hits = ranked.where((cnt > 0) & (total > 0)).select(
        *group_cols, F.col(value_col).alias("_tf_v"), total.alias("_tf_n"),
        F.explode(F.filter(cands, lambda x: (x["rank"] >= start) & (x["rank"] <= end))).alias("_w"),
    )
    per_p = hits.groupBy(*group_cols, F.col("_w.i").alias("i")).agg(
        F.max(F.when(F.col("_w.role") == 0, F.col("_tf_v"))).alias("_lo"),
        F.max(F.when(F.col("_w.role") == 1, F.col("_tf_v"))).alias("_hi"),
        F.max("_w.frac").alias("_frac"),
        F.max("_tf_n").alias("_tf_n"),
    )
    edge = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
    per_group = per_p.groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct("i", edge.alias("e")))).alias("_es"), F.max("_tf_n").alias("n_values")
    )
    return per_group.select(*group_cols, F.col("_es.e").alias(out_col), F.col("n_values").cast("bigint").alias("n_values"))


# Up to this many probabilities every value row is tested against every wanted rank.
MAX_PROBS_BY_VALUE = 64


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    *,
    out_col: str = "edges",
    **seq_kw,
) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``linear`` / SQL ``quantile_cont``) per group,
    as distributed order statistics; returns ``group_cols + [out_col array<double>, n_values]``.

    Rows are counted per (group, distinct value) -- a partial aggregate, so repeated values
    (ties, however hot) collapse before any shuffle --, the distinct values are ranked with
    running counts, and the wanted ranks are read off each value's rank range."""
    from tickforge.operators.materialize import hold, small_result

    group_cols = list(group_cols)
    vals = df.select(*group_cols, F.col(value_col).cast("double").alias("_tf_v")).where(F.col("_tf_v").isNotNull())
    dv, release_dv = hold(vals.groupBy(*group_cols, "_tf_v").agg(F.count(F.lit(1)).cast("double").alias("_tf_c")))
    ranked, release = hold(drop_helpers(with_sequence(dv, ["_tf_v"], group_cols, running_sums=["_tf_c"], **seq_kw)))
    out = small_result(quantiles_from_counts(ranked, "_tf_v", "_tf_c", probs, group_cols, out_col))
    release_dv()
    release()
    return out


# Cells (rows times columns) that a task of :func:`exact_quantiles_wide` sorts at a time.
WIDE_CELLS = 4_000_000


def exact_quantiles_wide(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    *,
    out_col: str = "edges",
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """:func:`exact_quantiles` of many columns of one table, without a row a cell: returns
    ``(feature, out_col array<double>, n_values)``, features without a value left out.

    Tasks sort chunks of rows column by column and send each column as one run of distinct values
    with their counts (repeated values collapse before the shuffle). Columns of more than
    ``rows_per_bucket`` rows are cut into ranges at approximate quantiles, so no task sorts more; the
    counts of the ranges give every wanted rank its range, where it is read off the merged runs."""
    from tickforge.operators.materialize import hold, small_result

    cols, probs = list(columns), [float(p) for p in probs]
    vals = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    buckets = math.ceil(df.count() / max(1, rows_per_bucket))
    edges: list[np.ndarray] = [np.empty(0)] * len(cols)
    if buckets > 1:
        # Any edges are right; a rank error of a tenth of a range keeps the ranges alike.
        wanted, accuracy = [i / buckets for i in range(1, buckets)], max(200, 10 * buckets)
        found = vals.agg(*[F.percentile_approx(_number(c), wanted, accuracy) for c in vals.columns]).first()
        edges = [np.unique(np.asarray(e or [], dtype=float)) for e in found]
    step = max(1, WIDE_CELLS // max(1, len(cols)))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def sorted_runs() -> pa.RecordBatch:
            chunk = pa.Table.from_batches(waiting)
            out: list[tuple[int, int, int, bytes, bytes]] = []
            for i, column in enumerate(chunk.columns):
                v, n = _value_counts(column.drop_null().to_numpy() + 0.0)  # -0.0 is 0.0
                cuts = [0, *np.searchsorted(v, edges[i], side="left").tolist(), len(v)]
                for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    if hi > lo:
                        out.append((i, b, int(n[lo:hi].sum()), v[lo:hi].tobytes(), n[lo:hi].tobytes()))
            names, kinds = ["at", "bucket", "n", "v", "c"], [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 5, kinds)], names)

        held = 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= step:
                yield sorted_runs()
                waiting, held = [], 0
        if held:
            yield sorted_runs()

    pieces, release = hold(vals.mapInArrow(runs, "at int, bucket int, n bigint, v binary, c binary"))
    # One row a (column, range): of the size of the column list and of rows / rows_per_bucket.
    before: dict[tuple[int, int], int] = {}
    total = [0] * len(cols)
    for at, b, n in sorted(tuple(r) for r in pieces.groupBy("at", "bucket").agg(F.sum("n")).collect()):
        before[at, b] = total[at]
        total[at] += n
    parr = np.asarray(probs)

    def ranks(key: tuple, group: pa.Table) -> pa.Table:
        at, b = key[0].as_py(), key[1].as_py()
        v = np.concatenate([np.frombuffer(x.as_py()) for x in group.column("v")])
        c = np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64) for x in group.column("c")])
        order = np.argsort(v, kind="stable")  # sorted runs: they are merged
        v, c = v[order], c[order]
        end = before[at, b] + np.cumsum(c)  # equal values may stay apart: ranks meet either
        h = (total[at] - 1) * parr
        found = []
        for rank in (np.floor(h), np.ceil(h)):
            here = (rank >= before[at, b]) & (rank < end[-1])
            hit = np.full(len(parr), np.nan)
            hit[here] = v[np.searchsorted(end, rank[here], side="right")]
            found.append(pa.array(hit, mask=~here))
        some = [i for i in range(len(parr)) if found[0][i].is_valid or found[1][i].is_valid]
        return pa.table({"at": pa.array([at] * len(some), pa.int32()), "i": pa.array(some, pa.int32()), "lo": found[0].take(pa.array(some, pa.int64())), "hi": found[1].take(pa.array(some, pa.int64()))})

    per_p = pieces.groupBy("at", "bucket").applyInArrow(ranks, "at int, i int, lo double, hi double")
    per_p = per_p.groupBy("at", "i").agg(F.max("lo").alias("_lo"), F.max("hi").alias("_hi"))
    names = df.sparkSession.createDataFrame(
        [(i, c, n) for i, (c, n) in enumerate(zip(cols, total)) if n], "at int, feature string, n_values bigint"
    )
    h = (F.col("n_values") - 1).cast("double") * F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1)
    edge = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (h - F.floor(h))
    out = per_p.join(F.broadcast(names), "at").groupBy("feature", "n_values").agg(
        F.array_sort(F.collect_list(F.struct("i", edge.alias("e")))).alias("_es")
    )
    out = small_result(out.select("feature", F.col("_es.e").alias(out_col), "n_values"))
    release()
    return out


def _value_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each comes; NaN is one value, the largest."""
    return np.unique(values, return_counts=True, equal_nan=True)


def approx_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    *,
    out_col: str = "edges",
    accuracy: int = 10_000,
) -> DataFrame:
    """Approximate quantiles per group from one ``percentile_approx`` aggregate: each partial
    aggregate keeps a sketch of bounded size (rank error about n / ``accuracy``), so a hot group
    costs no more memory than any other. The option for scale where exact order statistics are
    not required (edges of buckets, knots of the transform)."""
    v = F.col(value_col).cast("double")
    return (
        df.where(v.isNotNull())
        .groupBy(*group_cols)
        .agg(
            F.percentile_approx(v, [float(p) for p in probs], int(accuracy)).cast("array<double>").alias(out_col),
            F.count(F.lit(1)).alias("n_values"),
        )
    )
