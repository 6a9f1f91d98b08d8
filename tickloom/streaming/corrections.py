"""Final bars that take late rows in, however late: the landed minutes are the state.

Every micro-batch is merged into its minutes first. Bars that the watermark has just passed are then
built from the minutes; rows behind the watermark name bars that were written before, and those alone
are built again. All writes replace by key, so a batch that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions.expressions import floor_ms
from tickloom.operators.footprint import bars_with_footprint
from tickloom.schema import timeframe_ms
from tickloom.sinks import files
from tickloom.sinks.writers import upsert_minutes, write_bars
from tickloom.sources.readers import MINUTE_PARTS, read_partitioned

PROGRESS = "watermark bigint"


def _watermark(spark: SparkSession, progress: str, number: int) -> int | None:
    """Watermark (ms) after the batches before ``number``; one that is replayed sees what it saw first."""
    known = [int(c.split("=")[1]) for c in files.children(spark, progress) if c.startswith("batch=")]
    done = [n for n in known if n < number and files.exists(spark, f"{progress}/batch={n}/_SUCCESS")]
    return spark.read.schema(PROGRESS).parquet(f"{progress}/batch={max(done)}").first()[0] if done else None


def _day(ms: int) -> str:
    return datetime.fromtimestamp(ms / 1000, timezone.utc).date().isoformat()


def changed_bars(
    spark: SparkSession,
    landing: str,
    timeframe: str,
    before: int,
    now: int,
    late: DataFrame,
    ticks: Mapping[str, int] | None = None,
    decimals: int | None = None,
    parts: Sequence[str] = MINUTE_PARTS,
) -> DataFrame | None:
    """Bars that end after ``before`` and by ``now``, and those named by ``late`` (symbol, bar_ms), from the landed minutes.

    Only the folders of their symbols and days are listed and read. None if there is nothing to build.
    """
    width = timeframe_ms(timeframe)
    late = late.persist()
    try:
        days = F.sequence(F.timestamp_millis("bar_ms").cast("date"), F.timestamp_millis(F.col("bar_ms") + width - 1).cast("date"))
        named = late.select("symbol", F.explode(days).alias("day")).select("symbol", F.col("day").cast("string")).distinct()
        wanted = [files.partition_folder(spark, landing, r.asDict()) for r in named.collect()]
        if now > before:
            first, last = _day(before - width), _day(now)
            symbols = [f"{landing}/{c}" for c in files.children(spark, landing) if c.startswith("symbol=")]
            wanted += [f"{s}/{c}" for s in symbols for c in files.children(spark, s) if c.startswith("day=") and first <= c[4:] <= last]
        there = [f for f in dict.fromkeys(wanted) if files.exists(spark, f)]
        if not there:
            return None
        rows = read_partitioned(spark, landing, parts, there).withColumn("bar_ms", floor_ms("transact_time", timeframe))
        end = F.col("bar_ms") + width
        # The keys may be many (a long outage), so their rows decide how they are joined.
        again = rows.where(end <= before).join(late, ["symbol", "bar_ms"], "left_semi")
        chosen = rows.where((end > before) & (end <= now)).unionByName(again)
        return bars_with_footprint(chosen.drop("bar_ms"), timeframe, ticks, decimals)
    finally:
        late.unpersist()


def correct_bars(
    batch: DataFrame,
    number: int,
    landing: str,
    out: str,
    progress: str,
    timeframe: str,
    delay_ms: int,
    ticks: Mapping[str, int] | None = None,
    decimals: int | None = None,
    parts: Sequence[str] = MINUTE_PARTS,
) -> None:
    """One micro-batch: land it, write the bars that are due and those that its late rows belong to."""
    spark, width = batch.sparkSession, timeframe_ms(timeframe)
    batch = batch.where(F.col("transact_time").isNotNull()).persist()
    try:
        first, newest = batch.agg(F.min("transact_time"), F.max("transact_time")).first()
        if first is None:
            return
        upsert_minutes(batch, landing, parts=parts)
        before = _watermark(spark, progress, number)
        # Nothing was due before the first batch; its own first bar is the first that can be.
        before = first - first % width if before is None else before
        now = max(before, newest - delay_ms)
        late = batch.select("symbol", floor_ms("transact_time", timeframe).alias("bar_ms")).distinct().where(F.col("bar_ms") + width <= before)
        bars = changed_bars(spark, landing, timeframe, before, now, late, ticks, decimals, parts)
        if bars is not None:
            write_bars(bars, out)
        spark.createDataFrame([(now,)], PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch={number}")
        files.delete(spark, f"{progress}/batch={number - 2}")
    finally:
        batch.unpersist()


def write_corrected_bars(
    trades: DataFrame,
    landing: str,
    out: str,
    progress: str,
    timeframe: str,
    checkpoint: str,
    delay_ms: int = 60_000,
    ticks: Mapping[str, int] | None = None,
    decimals: int | None = None,
    parts: Sequence[str] = MINUTE_PARTS,
) -> DataStreamWriter:
    """Writer that lands every trade and keeps the final bars below ``out`` equal to those of all landed trades.

    A bar is written when it ends ``delay_ms`` before the newest trade; a later row of it causes that
    bar to be built again, and only the day it lies on is rewritten. ``parts`` are the partitions of the landed
    trades: symbol, day and down to which part of it.
    """

    def merge(batch: DataFrame, number: int) -> None:
        correct_bars(batch, number, landing, out, progress, timeframe, delay_ms, ticks, decimals, parts)

    return trades.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
