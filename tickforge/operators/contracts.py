"""Row and dataset data contracts plus profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickforge.schema import TRADE_COLS

# Bounds of the trade row contract and of the scoring-request variant.
TRADE_RULES = {
    "min_timestamp": 1_500_000_000_000,
    "max_price": 1_000_000.0,
    "max_quantity": 100_000.0,
    "quote_tolerance": 0.05,
}
API_MIN_TIMESTAMP = 1_000_000_000_000
# Dataset contract defaults.
MIN_ROWS = 1_000
MAX_NULL_PCT = 0.001
MAX_DUPLICATE_SHARE = 0.05


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _violations(checks: list[tuple[str, Column]]) -> Column:
    """array<string> of the names of failed checks (a check passes only when TRUE)."""
    return F.filter(F.array(*[F.when(~_true(ok), F.lit(name)) for name, ok in checks]), lambda x: x.isNotNull())


def row_contract(df: DataFrame, variant: str = "trade") -> DataFrame:
    """Add ``violations`` (array<string>) and ``is_valid``; defaults are applied.

    ``trade``: id > 0; 0 < price < 1e6; 0 < quantity < 1e5; quote >= 0; time > 1.5e12 ms;
    maker flag required; best-match defaults to true; the quote must lie within 5% of
    price * quantity (checked only when price, quantity and quote pass their own rules).
    ``api``: id, price, quantity > 0; quote defaults to 0 and must be >= 0; time > 1e12 ms;
    maker defaults to false, best-match to true."""
    p, q, qq, ts = F.col("price"), F.col("quantity"), F.col("quote_quantity"), F.col("timestamp")
    if variant == "trade":
        price_ok = (p > 0) & (p < TRADE_RULES["max_price"])
        qty_ok = (q > 0) & (q < TRADE_RULES["max_quantity"])
        quote_ok = qq >= 0
        expected = p * q
        mismatch_ok = F.when(
            _true(price_ok) & _true(qty_ok) & _true(quote_ok),
            F.abs(qq - expected) / (expected + F.lit(1e-9)) <= TRADE_RULES["quote_tolerance"],
        ).otherwise(F.lit(True))
        checks = [
            ("trade_id", F.col("trade_id") > 0),
            ("price", price_ok),
            ("quantity", qty_ok),
            ("quote_quantity", quote_ok),
            ("timestamp", ts > TRADE_RULES["min_timestamp"]),
            ("is_buyer_maker", F.col("is_buyer_maker").isNotNull()),
            ("quote_mismatch", mismatch_ok),
        ]
        out = df.withColumn("is_best_match", F.coalesce(F.col("is_best_match"), F.lit(True)))
    elif variant == "api":
        checks = [
            ("trade_id", F.col("trade_id") > 0),
            ("price", p > 0),
            ("quantity", q > 0),
            ("quote_quantity", F.coalesce(qq, F.lit(0.0)) >= 0),
            ("timestamp", ts > API_MIN_TIMESTAMP),
        ]
        out = df.withColumns(
            {
                "quote_quantity": F.coalesce(qq, F.lit(0.0)),
                "is_buyer_maker": F.coalesce(F.col("is_buyer_maker"), F.lit(False)),
                "is_best_match": F.coalesce(F.col("is_best_match"), F.lit(True)),
            }
        )
    else:
        raise ValueError(f"variant must be 'trade' or 'api', got {variant!r}")
    v = _violations(checks)
    return out.withColumns({"violations": v, "is_valid": F.size(v) == 0})


def split_by_contract(df: DataFrame, variant: str = "trade") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their violations)."""
    checked = row_contract(df, variant)
    return checked.where("is_valid").drop("violations", "is_valid"), checked.where("not is_valid").drop("is_valid")


def write_by_contract(df: DataFrame, root: str, variant: str = "trade") -> tuple[DataFrame, DataFrame, dict]:
    """Write accepted and quarantined rows from one evaluation of ``df``, under ``is_valid=true``
    and ``is_valid=false`` of ``root``; both read back, and the measures of the written stream.

    The measures (total_rows, accepted_rows, invalid_prices, invalid_quantities, max_null_pct) are
    observed while the rows are written, so an empty or bad input is known without a second scan.
    A side without rows reads back as an empty table; an empty input measures 0 throughout."""
    seen = Observation("row contract")
    checked = row_contract(df, variant)
    cols = [c for c in TRADE_COLS if c in df.columns]
    n = F.count(F.lit(1))
    nulls = [F.count_if(F.col(c).isNull()) / F.greatest(n, F.lit(1)) for c in cols]
    measured = checked.observe(
        seen,
        n.alias("total_rows"),
        F.count_if(F.col("is_valid")).alias("accepted_rows"),
        F.count_if(F.col("price") <= 0).alias("invalid_prices"),
        F.count_if(F.col("quantity") <= 0).alias("invalid_quantities"),
        F.greatest(*nulls, F.lit(0.0)).alias("max_null_pct"),
    )
    measured.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_valid").parquet(root)
    back = df.sparkSession.read.schema(checked.schema).parquet(root)
    accepted = back.where("is_valid").drop("violations", "is_valid")
    return accepted, back.where("not is_valid").drop("is_valid"), seen.get


def dataset_contract(
    df: DataFrame,
    *,
    min_rows: int = MIN_ROWS,
    max_null_pct: float = MAX_NULL_PCT,
    group_cols: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """C3 (+A5, A6): one report row per group (whole table when ``group_cols`` is empty).

    Columns: total_rows, checks_passed, errors (array<string>, in check order), max_null_pct
    (worst column), invalid_prices, invalid_quantities, duplicate_trades (rows minus distinct
    ids, NULL ids counting as one value). One aggregate pass; distinct ids are counted with a
    partial-aggregated distinct."""
    cols = list(columns) if columns is not None else [c for c in TRADE_COLS if c in df.columns]
    n = F.count(F.lit(1))
    null_rates = [F.count_if(F.col(c).isNull()) for c in cols]
    agg = df.groupBy(*group_cols).agg(
        n.alias("total_rows"),
        *[r.alias(f"_tf_null_{i}") for i, r in enumerate(null_rates)],
        F.count_if(F.col("price") <= 0).alias("invalid_prices"),
        F.count_if(F.col("quantity") <= 0).alias("invalid_quantities"),
        F.count_distinct("trade_id").alias("_tf_ids"),
        F.max(F.col("trade_id").isNull().cast("int")).alias("_tf_null_id"),
    )
    denom = F.greatest(F.col("total_rows"), F.lit(1)).cast("double")
    worst = F.greatest(*[F.col(f"_tf_null_{i}") / denom for i in range(len(cols))], F.lit(0.0)) if cols else F.lit(0.0)
    dup = F.col("total_rows") - F.col("_tf_ids") - F.coalesce(F.col("_tf_null_id"), F.lit(0))
    r = agg.withColumns({"max_null_pct": worst, "duplicate_trades": dup})
    errors = F.filter(
        F.array(
            F.when(
                F.col("total_rows") < min_rows,
                F.format_string(f"Row count %d is below minimum threshold ({min_rows})", F.col("total_rows")),
            ),
            F.when(
                F.col("max_null_pct") > max_null_pct,
                F.format_string(f"Null percentage %.4f exceeds threshold ({max_null_pct})", F.col("max_null_pct")),
            ),
            F.when(
                (F.col("invalid_prices") > 0) | (F.col("invalid_quantities") > 0),
                F.format_string(
                    "Found %d non-positive prices and %d non-positive quantities.",
                    F.col("invalid_prices"),
                    F.col("invalid_quantities"),
                ),
            ),
            F.when(
                F.col("duplicate_trades") > F.col("total_rows") * F.lit(MAX_DUPLICATE_SHARE),
                F.format_string("Excessive duplicate trade_ids found: %d", F.col("duplicate_trades")),
            ),
        ),
        lambda e: e.isNotNull(),
    )
    return r.select(
        *group_cols,
        "total_rows",
        (F.size(errors) == 0).alias("checks_passed"),
        errors.alias("errors"),
        "max_null_pct",
        "invalid_prices",
        "invalid_quantities",
        "duplicate_trades",
    )


def profile(df: DataFrame, col: str = "price", group_cols: Sequence[str] = ()) -> DataFrame:
    """A4: row count and value range."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max")
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A5: share of NULLs per column, as a long table (column_name, null_pct)."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_pct)")


def duplicate_count(df: DataFrame, key: str = "trade_id") -> DataFrame:
    """Rows minus distinct keys (NULL keys count as one value)."""
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(key) - F.max(F.col(key).isNull().cast("int"))).alias("duplicate_count")
    )


def drift_request_check(
    df: DataFrame, sample_col: str = "sample", group_cols: Sequence[str] = (), threshold: float = 0.20, min_values: int = 10
) -> DataFrame:
    """C4: both samples need at least ``min_values`` values and 0 < threshold < 1."""
    return df.groupBy(*group_cols).agg(
        F.count_if(F.col(sample_col) == "ref").alias("n_ref"),
        F.count_if(F.col(sample_col) == "cur").alias("n_cur"),
    ).withColumn(
        "is_valid",
        (F.col("n_ref") >= min_values) & (F.col("n_cur") >= min_values) & F.lit(0.0 < threshold < 1.0),
    )
