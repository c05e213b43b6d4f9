"""Queries: Silver, OLAP latest-wins, partition counts, contracts, profiles (S/K/P/D/C/A ops)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import contracts, silver
from tickforge.operators.features import size_features
from tickforge.plans.registry import register
from tickforge.plans.sql_tapes import E_TAPE, L_BROKEN, L_TAPE, with_tapes
from tickforge.session import scratch_dir
from tickforge.sources.tapes import tape_events, tape_lineitem, tape_lineitem_broken

LI_DEDUPE_ORDER = ("timestamp", "price", "quantity", "quote_quantity", "l_partkey", "l_suppkey")


@register(
    "silver_dedupe",
    "P1 P2 D1 E5",
    with_tapes(L_TAPE)
    + """
, d AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY "timestamp" DESC, price DESC, quantity DESC,
                               quote_quantity DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM l WHERE price > 0 AND quantity > 0)
SELECT CAST(trade_id AS BIGINT) AS trade_id, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
       CAST(quote_quantity AS DOUBLE) AS quote_quantity, CAST("timestamp" AS BIGINT) AS "timestamp",
       CAST(is_buyer_maker AS BOOLEAN) AS is_buyer_maker, CAST(is_best_match AS BOOLEAN) AS is_best_match,
       strftime(make_timestamp(("timestamp" // 86400000) * 86400000000), '%Y-%m-%d') AS partition_date
FROM d WHERE rn = 1""",
)
def q_silver_dedupe(spark, sf):
    return silver.silver(tape_lineitem(spark, sf), order_cols=LI_DEDUPE_ORDER)


@register(
    "latest_wins_olap",
    "D2 K5",
    with_tapes(L_TAPE)
    + """
, d AS (
  SELECT *, row_number() OVER (PARTITION BY ds, trade_id, "timestamp"
                               ORDER BY price DESC, quantity DESC, quote_quantity DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM l)
SELECT trade_id, price, quantity, quote_quantity, "timestamp",
       CAST(CASE WHEN is_buyer_maker THEN 1 ELSE 0 END AS TINYINT) AS is_buyer_maker,
       CAST(CASE WHEN is_best_match THEN 1 ELSE 0 END AS TINYINT) AS is_best_match,
       ds AS partition_date
FROM d WHERE rn = 1""",
)
def q_latest_wins_olap(spark, sf):
    t = tape_lineitem(spark, sf).withColumnRenamed("ds", "partition_date")
    kept = silver.latest_wins(t, order_cols=("price", "quantity", "quote_quantity", "l_partkey", "l_suppkey"))
    return silver.olap_projection(kept)


@register(
    "partition_counts",
    "K6",
    with_tapes(E_TAPE) + "\nSELECT ds, CAST(count(*) AS BIGINT) AS n_rows FROM e GROUP BY ds",
)
def q_partition_counts(spark, sf):
    return silver.partition_counts(tape_events(spark, sf), "ds")


_ROW_CONTRACT_SQL = """
SELECT trade_id, "timestamp", l_partkey, l_suppkey,
       concat_ws(',',
         CASE WHEN NOT coalesce(trade_id > 0, false) THEN 'trade_id' END,
         CASE WHEN NOT coalesce(price > 0 AND price < 1000000.0, false) THEN 'price' END,
         CASE WHEN NOT coalesce(quantity > 0 AND quantity < 100000.0, false) THEN 'quantity' END,
         CASE WHEN NOT coalesce(quote_quantity >= 0, false) THEN 'quote_quantity' END,
         CASE WHEN NOT coalesce("timestamp" > 1500000000000, false) THEN 'timestamp' END,
         CASE WHEN is_buyer_maker IS NULL THEN 'is_buyer_maker' END,
         CASE WHEN coalesce(price > 0 AND price < 1000000.0, false) AND coalesce(quantity > 0 AND quantity < 100000.0, false)
                   AND coalesce(quote_quantity >= 0, false)
                   AND NOT coalesce(abs(quote_quantity - price * quantity) / (price * quantity + 1e-9) <= 0.05, false)
              THEN 'quote_mismatch' END) AS violations,
       concat_ws(',',
         CASE WHEN NOT coalesce(trade_id > 0, false) THEN 'trade_id' END,
         CASE WHEN NOT coalesce(price > 0 AND price < 1000000.0, false) THEN 'price' END,
         CASE WHEN NOT coalesce(quantity > 0 AND quantity < 100000.0, false) THEN 'quantity' END,
         CASE WHEN NOT coalesce(quote_quantity >= 0, false) THEN 'quote_quantity' END,
         CASE WHEN NOT coalesce("timestamp" > 1500000000000, false) THEN 'timestamp' END,
         CASE WHEN is_buyer_maker IS NULL THEN 'is_buyer_maker' END,
         CASE WHEN coalesce(price > 0 AND price < 1000000.0, false) AND coalesce(quantity > 0 AND quantity < 100000.0, false)
                   AND coalesce(quote_quantity >= 0, false)
                   AND NOT coalesce(abs(quote_quantity - price * quantity) / (price * quantity + 1e-9) <= 0.05, false)
              THEN 'quote_mismatch' END) = '' AS is_valid
FROM lb"""


@register("row_contract_violations", "C1", with_tapes(L_TAPE, L_BROKEN) + _ROW_CONTRACT_SQL)
def q_row_contract(spark, sf):
    c = contracts.row_contract(tape_lineitem_broken(spark, sf), "trade")
    return c.select("trade_id", "timestamp", "l_partkey", "l_suppkey", F.array_join("violations", ",").alias("violations"),
                    "is_valid")


@register(
    "quarantine_one_pass",
    "C1 C3",
    with_tapes(L_TAPE, L_BROKEN)
    + """
SELECT trade_id, "timestamp", l_partkey, l_suppkey, violations, is_valid, count(*) OVER () AS total_rows,
       CAST(count_if(is_valid) OVER () AS BIGINT) AS accepted_rows,
       CAST(count_if(coalesce(price <= 0, false)) OVER () AS BIGINT) AS invalid_prices
FROM ("""
    + _ROW_CONTRACT_SQL.replace("SELECT trade_id,", "SELECT price, trade_id,", 1)
    + ")",
)
def q_quarantine_one_pass(spark, sf):
    good, bad, seen = contracts.write_by_contract(tape_lineitem_broken(spark, sf), scratch_dir(spark, "quarantine"))
    keys = ["trade_id", "timestamp", "l_partkey", "l_suppkey"]
    good = good.select(*keys, F.lit("").alias("violations"), F.lit(True).alias("is_valid"))
    bad = bad.select(*keys, F.array_join("violations", ",").alias("violations"), F.lit(False).alias("is_valid"))
    return good.unionByName(bad).select(
        "*", *[F.lit(seen[c]).cast("long").alias(c) for c in ("total_rows", "accepted_rows", "invalid_prices")]
    )


@register(
    "api_contract_violations",
    "C2",
    with_tapes(L_TAPE, L_BROKEN)
    + """
SELECT trade_id, "timestamp", l_partkey, l_suppkey,
       concat_ws(',',
         CASE WHEN NOT coalesce(trade_id > 0, false) THEN 'trade_id' END,
         CASE WHEN NOT coalesce(price > 0, false) THEN 'price' END,
         CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity' END,
         CASE WHEN NOT coalesce(coalesce(quote_quantity, 0.0) >= 0, false) THEN 'quote_quantity' END,
         CASE WHEN NOT coalesce("timestamp" > 1000000000000, false) THEN 'timestamp' END) AS violations,
       coalesce(trade_id > 0, false) AND coalesce(price > 0, false) AND coalesce(quantity > 0, false)
         AND coalesce(coalesce(quote_quantity, 0.0) >= 0, false) AND coalesce("timestamp" > 1000000000000, false) AS is_valid
FROM lb""",
)
def q_api_contract(spark, sf):
    c = contracts.row_contract(tape_lineitem_broken(spark, sf), "api")
    return c.select("trade_id", "timestamp", "l_partkey", "l_suppkey", F.array_join("violations", ",").alias("violations"),
                    "is_valid")


def _dataset_contract_sql(tape: str) -> str:
    return f"""
, a AS (
  SELECT count(*) AS total_rows,
         greatest(count_if(trade_id IS NULL), count_if(price IS NULL), count_if(quantity IS NULL),
                  count_if(quote_quantity IS NULL), count_if("timestamp" IS NULL), count_if(is_buyer_maker IS NULL),
                  count_if(is_best_match IS NULL)) / greatest(count(*), 1) AS max_null_pct,
         count_if(price <= 0) AS invalid_prices,
         count_if(quantity <= 0) AS invalid_quantities,
         count(*) - count(DISTINCT trade_id) - max(CASE WHEN trade_id IS NULL THEN 1 ELSE 0 END) AS duplicate_trades
  FROM {tape}),
r AS (
  SELECT *, list_filter([
      CASE WHEN total_rows < 1000 THEN printf('Row count %d is below minimum threshold (1000)', total_rows) END,
      CASE WHEN max_null_pct > 0.001 THEN printf('Null percentage %.4f exceeds threshold (0.001)', max_null_pct) END,
      CASE WHEN invalid_prices > 0 OR invalid_quantities > 0
           THEN printf('Found %d non-positive prices and %d non-positive quantities.', invalid_prices, invalid_quantities) END,
      CASE WHEN duplicate_trades > total_rows * 0.05 THEN printf('Excessive duplicate trade_ids found: %d', duplicate_trades) END
    ], lambda x: x IS NOT NULL) AS errs
  FROM a)
SELECT CAST(total_rows AS BIGINT) AS total_rows, len(errs) = 0 AS checks_passed, array_to_string(errs, ' | ') AS errors,
       CAST(max_null_pct AS DOUBLE) AS max_null_pct, CAST(invalid_prices AS BIGINT) AS invalid_prices,
       CAST(invalid_quantities AS BIGINT) AS invalid_quantities, CAST(duplicate_trades AS BIGINT) AS duplicate_trades
FROM r"""


def _contract_report(df):
    r = contracts.dataset_contract(df)
    return r.withColumn("errors", F.array_join("errors", " | "))


@register("dataset_contract_clean", "C3 A5 A6", with_tapes(E_TAPE) + _dataset_contract_sql("e"))
def q_dataset_contract_clean(spark, sf):
    return _contract_report(tape_events(spark, sf))


@register("dataset_contract_dirty", "C3 A5 A6", with_tapes(L_TAPE) + _dataset_contract_sql("l"))
def q_dataset_contract_dirty(spark, sf):
    return _contract_report(tape_lineitem(spark, sf))


@register(
    "profile_price",
    "A4",
    with_tapes(E_TAPE)
    + "\nSELECT symbol, CAST(count(*) AS BIGINT) AS total_rows, min(price) AS price_min, max(price) AS price_max FROM e GROUP BY symbol",
)
def q_profile_price(spark, sf):
    return contracts.profile(tape_events(spark, sf), "price", ["symbol"])


@register(
    "size_features",
    "P6 P7 E1 E2 E4",
    with_tapes(L_TAPE)
    + """
SELECT trade_id, "timestamp", l_partkey, l_suppkey,
       round(ln(1 + quantity), 6) AS log_quantity,
       round(ln(1 + quote_quantity), 6) AS log_quote_quantity,
       CAST(is_buyer_maker AS BIGINT) AS buyer_maker_int,
       round(quote_quantity / (quantity + 1e-9), 6) AS implied_price,
       CAST(CASE WHEN is_buyer_maker THEN -1.0 ELSE 1.0 END AS DOUBLE) AS tick_direction,
       CAST(CASE WHEN is_buyer_maker THEN -1.0 ELSE 1.0 END AS DOUBLE) * quantity AS signed_volume
FROM l""",
)
def q_size_features(spark, sf):
    f = size_features(tape_lineitem(spark, sf))
    return f.select(
        "trade_id", "timestamp", "l_partkey", "l_suppkey",
        F.round("log_quantity", 6).alias("log_quantity"),
        F.round("log_quote_quantity", 6).alias("log_quote_quantity"),
        "buyer_maker_int",
        F.round("implied_price", 6).alias("implied_price"),
        "tick_direction", "signed_volume",
    )


@register(
    "quote_fallback",
    "P4 P3",
    with_tapes(E_TAPE)
    + """
, z AS (SELECT trade_id, price, quantity, CASE WHEN symbol = 'view' THEN 0.0 ELSE quote_quantity END AS quote_quantity, symbol FROM e),
s AS (SELECT symbol, coalesce(sum(quote_quantity), 0.0) AS qs FROM z GROUP BY symbol)
SELECT z.trade_id, z.symbol, round(CASE WHEN s.qs = 0 THEN z.price * z.quantity ELSE z.quote_quantity END, 6) AS quote_quantity
FROM z JOIN s USING (symbol)""",
)
def q_quote_fallback(spark, sf):
    t = tape_events(spark, sf)
    z = t.withColumn("quote_quantity", F.when(F.col("symbol") == "view", F.lit(0.0)).otherwise(F.col("quote_quantity")))
    out = silver.quote_fallback(z.select("trade_id", "price", "quantity", "quote_quantity", "symbol"), ["symbol"])
    return out.select("trade_id", "symbol", F.round("quote_quantity", 6).alias("quote_quantity"))
