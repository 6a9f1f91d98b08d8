"""Trade tapes derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.bars import ohlcv
from tickloom.operators.footprint import footprint_levels
from tickloom.plans.stage import staged

EVENT_TICKS = {"S0": 0, "S1": 0, "S2": 1}


def utc(spark: SparkSession) -> None:
    """The tables carry UTC wall times without a zone; epoch times need the session to read them so."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_tape(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("symbol"),
        F.col("event_id").alias("agg_trade_id"),
        F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("double") + 1).alias("quantity"),
        F.col("event_id").alias("first_trade_id"),
        F.col("event_id").alias("last_trade_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("transact_time"),
        F.col("event_type").isin("click", "view").alias("is_buyer_maker"),
    )


def tape_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades from ``events``: unique ids, millisecond times, four symbols."""
    return as_tape(_table(spark, sf_dir, "events"))


def tape_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume tape from ``lineitem``: day-resolution times and no unique id."""
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("P"), (F.col("l_partkey") % 4).cast("string")).alias("symbol"),
        F.lit(None).cast("bigint").alias("agg_trade_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("transact_time"),
        (F.col("l_linestatus") == "O").alias("is_buyer_maker"),
    )


def event_bars(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    """Bars of the event tape as a table, as the series operators expect it."""
    return staged(ohlcv(tape_events(spark, sf_dir), timeframe))


def event_levels(spark: SparkSession, sf_dir: str, timeframe: str = "4h") -> DataFrame:
    return staged(footprint_levels(tape_events(spark, sf_dir), timeframe, EVENT_TICKS))
