"""Collects queries and their oracle SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name!r} registered twice")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def flat(df: DataFrame) -> DataFrame:
    """Bar time as epoch ms and no timeframe column, for comparison."""
    if "time_rounded" in df.columns:
        df = df.withColumn("bar_ms", F.unix_millis("time_rounded")).drop("time_rounded")
    return df.drop("timeframe")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def as_long(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


# --- oracle SQL building blocks ---------------------------------------------------------------

TAPE = """tape AS (
  SELECT 'S' || CAST(user_id % 4 AS VARCHAR) AS symbol, event_id AS id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS qty, epoch_us(ts) // 1000 AS t,
         event_type IN ('click', 'view') AS maker
  FROM events)"""

# Price level by symbol; the decimal cast makes half-up rounding exact.
LEVEL = """CASE WHEN symbol IN ('S0', 'S1') THEN CAST(round(CAST(price AS DECIMAL(18,4)), 0) AS DOUBLE)
     WHEN symbol = 'S2' THEN CAST(round(CAST(price AS DECIMAL(18,4)), 1) AS DOUBLE) ELSE price END"""

WIDTH = {
    "1m": 60000, "5m": 300000, "15m": 900000, "30m": 1800000, "1h": 3600000,
    "4h": 14400000, "12h": 43200000, "1d": 86400000, "1w": 604800000,
}


def bars_sql(timeframe: str) -> str:
    """CTEs ``tape`` and ``bars`` (symbol, bar_ms, open, close, high, low, qty, i)."""
    w = WIDTH[timeframe]
    return f"""{TAPE}, bars AS (
  SELECT symbol, t - t % {w} AS bar_ms, first(price ORDER BY t, id) AS open, last(price ORDER BY t, id) AS close,
         max(price) AS high, min(price) AS low, sum(qty) AS qty,
         row_number() OVER (PARTITION BY symbol ORDER BY t - t % {w}) - 1 AS i
  FROM tape GROUP BY symbol, t - t % {w})"""


def levels_sql(timeframe: str, level: str = LEVEL) -> str:
    """CTEs ``tape`` and ``levels`` (symbol, bar_ms, price_level, bq, bn, aq, an)."""
    w = WIDTH[timeframe]
    return f"""{TAPE}, levels AS (
  SELECT symbol, t - t % {w} AS bar_ms, {level} AS price_level,
         sum(CASE WHEN maker THEN qty ELSE 0 END) AS bq, count(*) FILTER (WHERE maker) AS bn,
         sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS aq, count(*) FILTER (WHERE NOT maker) AS an
  FROM tape GROUP BY ALL)"""


def indexed_levels_sql(timeframe: str) -> str:
    """Adds CTEs ``idx`` (symbol, bar_ms, i) and ``lev`` (levels with i)."""
    return f"""{levels_sql(timeframe)}, idx AS (
  SELECT symbol, bar_ms, row_number() OVER (PARTITION BY symbol ORDER BY bar_ms) - 1 AS i
  FROM (SELECT DISTINCT symbol, bar_ms FROM levels)),
lev AS (SELECT l.*, x.i FROM levels l JOIN idx x USING (symbol, bar_ms))"""


def profile_sql(timeframe: str) -> str:
    """Adds CTEs ``prof`` (rolling profile) and ``area`` (poc, val, vah, poc_rank per bar)."""
    return f"""{indexed_levels_sql(timeframe)}, prof AS (
  SELECT b.symbol, b.i, l.price_level, sum(l.bq + l.aq) AS volume, min(l.i) AS first_bar
  FROM idx b JOIN lev l ON l.symbol = b.symbol AND l.i BETWEEN b.i - 39 AND b.i
  WHERE b.i > 40 GROUP BY ALL),
top AS (SELECT symbol, i, first(price_level ORDER BY volume DESC, first_bar, price_level DESC) AS poc
        FROM prof GROUP BY ALL),
walk AS (
  SELECT p.*, t.poc,
    sum(CASE WHEN price_level < poc THEN volume END) OVER (PARTITION BY symbol, i) AS lo,
    sum(CASE WHEN price_level > poc THEN volume END) OVER (PARTITION BY symbol, i) AS hi,
    sum(CASE WHEN price_level < poc THEN volume END) OVER (PARTITION BY symbol, i ORDER BY price_level DESC) AS down,
    sum(CASE WHEN price_level > poc THEN volume END) OVER (PARTITION BY symbol, i ORDER BY price_level) AS up
  FROM prof p JOIN top t USING (symbol, i)),
area AS (
  SELECT symbol, i, max(poc) AS poc,
    coalesce(max(CASE WHEN price_level < poc AND down / lo > 0.4 THEN price_level END),
             min(CASE WHEN price_level < poc THEN price_level END), max(poc)) AS val,
    coalesce(min(CASE WHEN price_level > poc AND up / hi > 0.4 THEN price_level END),
             max(CASE WHEN price_level > poc THEN price_level END), max(poc)) AS vah,
    count(*) FILTER (WHERE price_level < poc) AS poc_rank
  FROM walk GROUP BY symbol, i)"""


def smooth_sql(name: str, src: str, x: str, n: int, alpha: str, lead: int = 0) -> str:
    """Recursive CTE ``name`` (symbol, i, y): exponential smoothing of ``src.x`` seeded by a mean."""
    return f"""{name} AS (
  SELECT symbol, CAST({lead + n - 1} AS BIGINT) AS i, avg({x}) AS y FROM {src}
  WHERE i BETWEEN {lead} AND {lead + n - 1} GROUP BY symbol HAVING count(*) = {n}
  UNION ALL
  SELECT s.symbol, s.i, {alpha} * s.{x} + (1 - {alpha}) * r.y
  FROM {name} r JOIN {src} s ON s.symbol = r.symbol AND s.i = r.i + 1)"""
