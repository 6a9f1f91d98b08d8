"""Live trades as Structured Streaming: decode, dedupe, bars, levels, summaries, landing.

All symbols share one stream keyed by ``symbol``. Windowed results drop rows later than the
watermark; the raw landing merges every row into its minute, however late.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.bars import bar_aggregates
from tickloom.operators.footprint import FINAL, bars_of_partials, level_partials, side_sums, with_price_level
from tickloom.operators.lifecycle import TRADE_KEY
from tickloom.operators.stats import trade_summary
from tickloom.schema import timeframe_seconds
from tickloom.sinks.writers import upsert_minutes
from tickloom.sources.messages import decode_messages


def read_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Trades from a folder of JSON-lines files, in the order of the files' modification times.

    Files of equal times may come in any order, and one that is read behind newer ones may be behind the
    watermark, so a producer gives its files rising times.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode_messages(reader.load(path))


def decode_stream(messages: DataFrame, column: str = "value") -> DataFrame:
    """Trades from any message stream with a text or binary column (a Kafka source, for one)."""
    return decode_messages(messages.select(F.col(column).cast("string").alias("value")))


def with_event_time(trades: DataFrame, delay: str) -> DataFrame:
    """Add ``event_time_ts`` from the trade time and set the watermark."""
    return trades.withColumn("event_time_ts", F.timestamp_millis("transact_time")).withWatermark("event_time_ts", delay)


def dedupe_stream(trades: DataFrame, delay: str = "1 minute", keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    """Each trade once; ids are kept in state for the watermark delay.

    A trade without an id is known by all its columns instead, so different ones stay apart.
    """
    marked = trades if "event_time_ts" in trades.columns else with_event_time(trades, delay)
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    whole = F.when(unknown, F.to_json(F.struct(*trades.columns)))
    return marked.withColumn("_whole", whole).dropDuplicatesWithinWatermark([*keys, "_whole"]).drop("_whole")


def _windowed(trades: DataFrame, timeframe: str, delay: str) -> tuple[DataFrame, Column]:
    marked = trades if "event_time_ts" in trades.columns else with_event_time(trades, delay)
    return marked, F.window("event_time_ts", f"{timeframe_seconds(timeframe)} seconds")


def stream_bars(trades: DataFrame, timeframe: str, delay: str = "1 minute", wide_ids: bool = False) -> DataFrame:
    """Tumbling bars with the aggregates of the batch bars."""
    marked, window = _windowed(trades, timeframe, delay)
    bars = marked.groupBy("symbol", window.alias("w")).agg(*bar_aggregates(timeframe, wide_ids))
    return bars.select(
        "symbol", F.lit(timeframe).alias("timeframe"), F.col("w.start").alias("time_rounded"),
        "open", "close", "high", "low", "qty",
    )


def stream_levels(
    trades: DataFrame,
    timeframe: str,
    delay: str = "1 minute",
    ticks: Mapping[str, int] | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Tumbling long footprint with the aggregates of the batch footprint."""
    marked, window = _windowed(trades, timeframe, delay)
    known = marked.where(F.col("price").isNotNull() & F.col("quantity").isNotNull() & F.col("is_buyer_maker").isNotNull())
    sums = side_sums()
    levels = with_price_level(known, ticks, decimals).groupBy("symbol", window.alias("w"), "price_level").agg(*sums)
    return levels.select(
        "symbol", F.lit(timeframe).alias("timeframe"), F.col("w.start").alias("time_rounded"),
        "price_level", *[c for c in levels.columns if c.startswith("total_")],
    )


def stream_final_bars(
    trades: DataFrame,
    timeframe: str,
    delay: str = "1 minute",
    ticks: Mapping[str, int] | None = None,
    decimals: int | None = None,
    wide_ids: bool = False,
) -> DataFrame:
    """Final bars with side totals and footprint map in one query: levels per window, then bars over the windows' times.

    The batch aggregates in two chained stateful steps, for append mode. State holds open price levels,
    never trades, and a hot symbol is spread over its levels; a bar comes once the watermark has
    passed its end in both steps. Rows behind the watermark are not in it (see ``corrections``).
    """
    marked, window = _windowed(trades, timeframe, delay)
    levels = with_price_level(marked, ticks, decimals).groupBy("symbol", window.alias("w"), "price_level").agg(*level_partials(timeframe, wide_ids))
    again = F.window(F.window_time("w"), f"{timeframe_seconds(timeframe)} seconds")
    bars = levels.groupBy("symbol", again.alias("w")).agg(*bars_of_partials())
    return bars.select("symbol", F.lit(timeframe).alias("timeframe"), F.col("w.start").alias("time_rounded"), *FINAL)


def stream_summary(trades: DataFrame, timeframe: str = "1m", delay: str = "1 minute") -> DataFrame:
    """Trade summary per symbol and window."""
    marked, window = _windowed(trades, timeframe, delay)
    summary = trade_summary(marked.withColumn("w", window), ("symbol", "w"))
    return summary.withColumn("time_rounded", F.col("w.start")).drop("w")


def stream_last_seen(trades: DataFrame) -> DataFrame:
    """Newest trade time per symbol, for update mode."""
    return trades.groupBy("symbol").agg(F.max("transact_time").alias("last_ms"))


def land_minutes(trades: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = TRADE_KEY) -> DataStreamWriter:
    """Writer that merges every micro-batch into the minute partitions, late rows included.

    The merge keeps one row per key, so a batch replayed after a failure changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert_minutes(batch, path, keys)

    return trades.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = "20 seconds", sink: Callable | None = None
) -> DataStreamWriter:
    """Parquet writer in append mode, each window once; ``every=None`` runs until the input is used up."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(sink) if sink else writer.format("parquet").option("path", path)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
