"""The trade tapes as DuckDB CTEs (same expressions as :mod:`tickforge.sources.tapes`)."""

E_TAPE = """e AS (
  SELECT event_id + 1 AS trade_id,
         value AS price,
         CAST(user_id % 7 + 1 AS DOUBLE) AS quantity,
         value * CAST(user_id % 7 + 1 AS DOUBLE) AS quote_quantity,
         epoch_us(ts) // 1000 AS "timestamp",
         event_type IN ('click', 'error') AS is_buyer_maker,
         event_type <> 'signup' AS is_best_match,
         event_type AS symbol,
         strftime(ts, '%Y-%m-%d') AS ds
  FROM events)"""

L_TAPE = """l AS (
  SELECT l_orderkey * 10 + l_linenumber AS trade_id,
         l_extendedprice / l_quantity AS price,
         l_quantity AS quantity,
         l_extendedprice AS quote_quantity,
         epoch_us(l_shipdate) // 1000 + 800000000000 AS "timestamp",
         l_returnflag = 'R' AS is_buyer_maker,
         l_linestatus = 'O' AS is_best_match,
         CAST(l_suppkey AS VARCHAR) AS symbol,
         strftime(l_shipdate + INTERVAL 800000000 SECOND, '%Y-%m-%d') AS ds,
         l_partkey,
         l_suppkey
  FROM lineitem)"""

L_BROKEN = """lb AS (
  SELECT trade_id,
         CASE WHEN trade_id % 101 = 0 THEN -price ELSE price END AS price,
         quantity,
         CASE WHEN trade_id % 103 = 0 THEN quote_quantity * 1.10 ELSE quote_quantity END AS quote_quantity,
         CASE WHEN trade_id % 107 = 0 THEN "timestamp" - 800000000000 ELSE "timestamp" END AS "timestamp",
         is_buyer_maker, is_best_match, symbol, ds, l_partkey, l_suppkey
  FROM l)"""


def with_tapes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
