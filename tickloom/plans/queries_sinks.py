"""Registered queries that write tables, write again and read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.bars import ohlcv
from tickloom.plans.catalog import TAPE, bars_sql, flat, register
from tickloom.plans.stage import shared_folder
from tickloom.plans.tape import tape_events
from tickloom.sinks import files, writers

CUT = datetime(2024, 1, 15, tzinfo=timezone.utc)
CUT_MS = int(CUT.timestamp() * 1000)
MONTHS = ("symbol", "month")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _two_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Bars written for the days before and from a cut on; the second range leaves the first."""
    tape, out = tape_events(spark, d), _folder(spark)
    for part in ("transact_time < {}", "transact_time >= {}", "transact_time < {}"):
        writers.write_bars(ohlcv(tape.where(part.format(CUT_MS)), "4h"), out)
    return flat(spark.read.parquet(out)).drop("date")


register("bars_two_ranges", _two_ranges, f"WITH {bars_sql('4h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars")


def _cut_at_noon(spark: SparkSession, d: str) -> DataFrame:
    """Bars written as a whole, and again from noon of a day on: the bars of that morning stay."""
    bars, out = ohlcv(tape_events(spark, d), "1h"), _folder(spark)
    writers.write_bars(bars.where(f"time_rounded < timestamp_millis({CUT_MS + 2 * 86400000})"), out)
    writers.write_bars(bars.where(f"time_rounded >= timestamp_millis({CUT_MS + 43200000})"), out)
    return flat(spark.read.parquet(out)).drop("date")


register("bars_cut_at_noon", _cut_at_noon, f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars")


def _without_ids(spark: SparkSession, d: str) -> DataFrame:
    """Trades of which a third has no id, delivered twice in overlapping parts."""
    tape, out = tape_events(spark, d), _folder(spark)
    tape = tape.withColumn("agg_trade_id", F.when(F.col("agg_trade_id") % 3 > 0, F.col("agg_trade_id")))
    writers.merge_day(tape.where(f"transact_time < {CUT_MS}"), out)
    writers.merge_day(tape, out)
    return writers.read_partitioned(spark, out, MONTHS).select("symbol", "agg_trade_id", "price", "transact_time")


register(
    "landed_without_ids",
    _without_ids,
    f"WITH {TAPE} SELECT symbol, CASE WHEN id % 3 > 0 THEN id END AS agg_trade_id, price, t AS transact_time FROM tape",
)


def _keeps_columns(spark: SparkSession, d: str) -> DataFrame:
    """New rows without a stored column take over their keys; the others keep that column."""
    tape, out = tape_events(spark, d), _folder(spark)
    writers.merge_day(tape.withColumn("note", F.col("quantity")), out)
    writers.merge_day(tape.where("agg_trade_id % 2 = 0").drop("first_trade_id").withColumn("price", F.col("price") + 1), out)
    return writers.read_partitioned(spark, out, MONTHS).select("symbol", "agg_trade_id", "first_trade_id", "price", "note")


register(
    "upsert_keeps_columns",
    _keeps_columns,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, CASE WHEN id % 2 > 0 THEN id END AS first_trade_id,
    CASE WHEN id % 2 = 0 THEN price + 1 ELSE price END AS price, CASE WHEN id % 2 > 0 THEN qty END AS note FROM tape""",
)


def _siblings(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose names begin alike; writing one again leaves the other."""
    bars, base = ohlcv(tape_events(spark, d), "1h"), _folder(spark)
    writers.write_range_named(bars.where(f"time_rounded < timestamp_millis({CUT_MS})"), base, "s")
    writers.write_range_named(bars, base, "s_1h")
    for _ in range(2):
        writers.write_range_named(bars, base, "s")
    names = sorted(c for c in files.children(spark, base))
    counts = [spark.read.parquet(f"{base}/{n}").select(F.lit(n).alias("name")).groupBy("name").agg(F.count("*").alias("n")) for n in names]
    return counts[0].union(counts[1]) if len(counts) == 2 else spark.createDataFrame([(n, -1) for n in names], "name string, n bigint")


register(
    "range_named_siblings",
    _siblings,
    f"""WITH {bars_sql('1h')}, r AS (SELECT strftime(make_timestamp(min(bar_ms) * 1000), '%Y%m%d%H%M') || '_' ||
      strftime(make_timestamp(max(bar_ms) * 1000), '%Y%m%d%H%M') AS span, count(*) AS n FROM bars)
    SELECT name || span AS name, n FROM r, (VALUES ('s_'), ('s_1h_')) v(name)""",
)


def _purge_then_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned tape purged up to a day inside its month; then every fifth trade comes again at another price."""
    tape, out = tape_events(spark, d), _folder(spark)
    writers.merge_day(tape, out)
    writers.archive_and_purge(spark, out, _folder(spark), CUT)
    writers.merge_day(tape.where(f"agg_trade_id % 5 = 0 AND transact_time >= {CUT_MS}").withColumn("price", -F.col("price")), out)
    return writers.read_partitioned(spark, out, MONTHS).select("symbol", "agg_trade_id", "price", "quantity")


register(
    "purge_then_upsert",
    _purge_then_upsert,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, CASE WHEN id % 5 = 0 THEN -price ELSE price END AS price, qty AS quantity
    FROM tape WHERE t >= {CUT_MS}""",
)


def _purge_resumed(spark: SparkSession, d: str) -> DataFrame:
    """A purge that ended between archive and removal, old trades that land late, and the purge again: each old trade is archived once."""
    tape, out, archive = tape_events(spark, d), _folder(spark), _folder(spark)
    writers.merge_day(tape.where("agg_trade_id % 3 > 0"), out)
    writers.archive_old(spark, out, archive, CUT)
    writers.merge_day(tape.where("agg_trade_id % 3 = 0"), out)
    for _ in range(2):
        writers.archive_and_purge(spark, out, archive, CUT)
    kept = writers.read_partitioned(spark, out, MONTHS)
    stored = spark.read.schema(kept.schema).option("header", True).csv([f"{archive}/{c}" for c in files.children(spark, archive) if c.startswith("archive_")])
    shown = ("symbol", "agg_trade_id", "price", "quantity", "transact_time")
    return stored.select(F.lit("archive").alias("place"), *shown).union(kept.select(F.lit("table").alias("place"), *shown))


register(
    "purge_resumed",
    _purge_resumed,
    f"""WITH {TAPE} SELECT CASE WHEN t < {CUT_MS} THEN 'archive' ELSE 'table' END AS place, symbol, id AS agg_trade_id, price, qty AS quantity,
    t AS transact_time FROM tape""",
)
