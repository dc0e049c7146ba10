"""Inputs of the queries: portable SQL over the test tables, run by Spark here and by DuckDB in the oracles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW_BARS = """
SELECT CAST(l_suppkey AS STRING) AS ticker,
       CASE WHEN l_suppkey % 10 < 6 THEN 'main' WHEN l_suppkey % 10 < 8 THEN 'star' WHEN l_suppkey % 10 < 9 THEN 'b_share' ELSE 'other' END AS board,
       CAST(l_shipdate AS DATE) AS date,
       p AS open, p * (1 + l_tax) AS high, p * (1 - l_discount) AS low,
       CAST(CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL WHEN l_tax = 0.01 AND l_discount = 0.01 THEN 0.0 ELSE p * (1 + 1.25 * l_tax - l_discount) END AS DOUBLE) AS close,
       p * (1 - l_discount) AS adj_close,
       l_quantity - 1 AS volume,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_discount ELSE 0.0 END AS DOUBLE) AS dividends,
       CAST(CASE WHEN l_quantity = 50 THEN 2.0 ELSE 0.0 END AS DOUBLE) AS splits,
       CAST(ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS BIGINT) AS seq
FROM (SELECT *, CAST(1000.0 + l_suppkey + l_quantity AS DOUBLE) AS p FROM lineitem) t"""

CLEAN_BARS = """
SELECT ticker, board, date, open, high, low, close, adj_close, volume, dividends, splits
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, date ORDER BY seq DESC) AS rn FROM raw_bars) x
WHERE rn = 1 AND close IS NOT NULL AND close > 0
  AND NOT coalesce(open <= 0, false) AND NOT coalesce(high <= 0, false)
  AND NOT coalesce(low <= 0, false) AND NOT coalesce(adj_close <= 0, false)
  AND NOT coalesce(volume < 0, false)
  AND NOT coalesce(high < greatest(open, close, low) - 1e-6, false)
  AND NOT coalesce(low > least(open, close, high) + 1e-6, false)"""

OVERLAY = """
SELECT ticker, date, open, high, low, close * 1.01 AS close, adj_close, volume, dividends, splits
FROM clean_bars WHERE date >= DATE '2001-06-01' AND CAST(ticker AS INT) % 4 = 0"""

EVENT_BARS = """
SELECT CAST(user_id AS STRING) AS ticker, CAST(ts AS DATE) AS date,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low,
       max_by(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY user_id, CAST(ts AS DATE)"""

LISTINGS = """
SELECT code || '.SS' AS ticker, code, substr(code, 1, 3) AS block, name, market_cap, in_screener, in_probe
FROM (SELECT (CASE p_partkey % 12 WHEN 0 THEN '600' WHEN 1 THEN '601' WHEN 2 THEN '603' WHEN 3 THEN '605' WHEN 4 THEN '688' WHEN 5 THEN '689' WHEN 6 THEN '900' WHEN 7 THEN '510' WHEN 8 THEN '508' WHEN 9 THEN '113' WHEN 10 THEN '000' ELSE '777' END)
             || right('000' || CAST(CAST(floor(p_partkey / 12) AS INT) % 1000 AS STRING), 3) AS code,
             p_name AS name,
             CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice * p_size * 1000000.0 END AS market_cap,
             p_partkey % 7 <> 0 AS in_screener, p_partkey % 5 <> 0 AS in_probe
      FROM part) t"""

MASTER = """
SELECT ticker, CASE WHEN b IN ('600', '601', '603', '605') THEN 'main' WHEN b IN ('688', '689') THEN 'star' WHEN b = '900' THEN 'b_share' ELSE 'other' END AS board, name,
       CASE k % 11 WHEN 0 THEN 'inactive' WHEN 1 THEN NULL ELSE 'active' END AS status,
       CASE k % 4 WHEN 0 THEN 'r0' WHEN 1 THEN NULL ELSE 'r1' END AS run_id,
       CASE k % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'empty' WHEN 2 THEN NULL ELSE 'ok' END AS ingest_state
FROM (SELECT ticker, min(substr(code, 1, 3)) AS b, min(name) AS name, CAST(floor(min(market_cap) / 1000000) AS BIGINT) + CAST(min(code) AS BIGINT) AS k FROM listings GROUP BY ticker) m"""

SNAPSHOTS = """
SELECT run_id, source, taken_at, symbol
FROM (SELECT concat('u', k % 9) AS run_id, CASE WHEN in_screener THEN 'screener' ELSE 'probe' END AS source, date_add(CAST('2026-08-01' AS DATE), CAST(k % 9 AS INT)) AS taken_at, ticker AS symbol
      FROM (SELECT DISTINCT ticker, in_screener, CAST(code AS BIGINT) AS k FROM listings) x) y"""

RUNS = """
SELECT CAST(o_orderkey AS STRING) AS id, CASE o_orderkey % 3 WHEN 0 THEN 'update' WHEN 1 THEN 'backfill' ELSE 'discover' END AS kind,
       CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'failed' ELSE 'ok' END AS status,
       CAST(o_orderdate AS DATE) AS started_at,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 30 AS INT)) END AS heartbeat_at
FROM orders"""

VIEWS = {"raw_bars": RAW_BARS, "clean_bars": CLEAN_BARS, "overlay": OVERLAY, "event_bars": EVENT_BARS, "listings": LISTINGS, "master": MASTER, "snapshots": SNAPSHOTS, "runs": RUNS}
TABLES = ("lineitem", "events", "part", "orders")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the tables of ``sf_dir``."""
    sql, frames = VIEWS[name], {}
    for t in (*TABLES, *VIEWS):
        if re.search(rf"FROM {t}\b", sql):
            sql = re.sub(rf"FROM {t}\b", f"FROM {{{t}}}", sql)
            frames[t] = view(spark, sf_dir, t) if t in VIEWS else spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(sql, **frames)


def ctes(*names: str) -> str:
    """WITH clauses of the named views and those they need, for an oracle."""
    wanted = set(names)
    for v in reversed(VIEWS):  # a view only reads those before it
        if v in wanted:
            wanted |= {w for w in VIEWS if re.search(rf"FROM {w}\b", VIEWS[v])}
    return "WITH " + ", ".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted)
