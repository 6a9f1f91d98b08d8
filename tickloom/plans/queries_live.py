"""Streaming queries over the event table: messages that arrive in several parts, with repeats and late rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.footprint import explode_footprint
from tickloom.operators.lifecycle import newest_per_key
from tickloom.plans.catalog import TAPE, bars_sql, flat, levels_sql, register, rounded
from tickloom.plans.queries_tape import LEVEL_NAMES
from tickloom.plans.stage import shared_folder
from tickloom.plans.tape import EVENT_TICKS, tape_events
from tickloom.streaming import corrections, live

DAY_MS = 86_400_000
#: Midnights of 11 and 21 January 2024, where one part of the messages ends and the next begins.
CUTS = [1_704_931_200_000, 1_705_795_200_000]
#: The symbol of a last trade far ahead, which lets the watermark pass every bar.
END = "~"
DELAY = "1 day"


def _message(*columns: str) -> Column:
    return F.to_json(F.struct(F.lit("aggTrade").alias("e"), *[F.expr(c) for c in columns]))


def parts(spark: SparkSession, sf_dir: str, late_days: int = 0) -> list[DataFrame]:
    """The event tape as messages (JSON lines) in order of arrival.

    Of the last twelve hours of a part every fifth trade comes with the next one, within the watermark's
    delay, and every seventh comes again. With ``late_days`` every fortieth trade of the days before the last
    of a part comes with the next part as well, far behind the watermark.
    """
    tape = tape_events(spark, sf_dir)
    t, number = F.col("transact_time"), F.col("agg_trade_id")
    own = sum((t >= cut).cast("int") for cut in CUTS)
    close = F.lit(False)
    behind = F.lit(False)
    for cut in CUTS:
        close = close | t.between(cut - DAY_MS // 2, cut - 1)
        behind = behind | (t.between(cut - late_days * DAY_MS, cut - 2 * DAY_MS - 1))
    moved = (close & (number % 5 == 0)) | (behind & (number % 40 == 7))
    first = own + moved.cast("int")
    arrivals = F.when(close & (number % 7 == 0), F.array(first, own + 1)).otherwise(F.array(first))
    sent = tape.select(F.explode(F.array_distinct(arrivals)).alias("part"), "symbol", "agg_trade_id", "price", "quantity", "transact_time", "is_buyer_maker")
    end = spark.createDataFrame([(len(CUTS), END, 0, 1.0, 1.0, CUTS[-1] + 400 * DAY_MS, True)], sent.schema)
    text = sent.unionByName(end).select(
        "part",
        _message(
            "transact_time + 3 AS E", "transact_time AS T", "symbol AS s", "agg_trade_id AS a", "cast(price AS string) AS p",
            "cast(quantity AS string) AS q", "is_buyer_maker AS m",
        ).alias("value"),
    )
    return [text.where(F.col("part") == k).select("value") for k in range(len(CUTS) + 1)]


def arriving(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame, str], DataStreamWriter], late_days: int = 0) -> str:
    """Let the parts arrive one after the other; after each, the stream that ``start`` makes runs until it is used up.

    A run resumes from the checkpoint of the one before, so every part is at least one micro-batch. Returns
    the folder of the streams.
    """
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    for part in parts(spark, sf_dir, late_days):
        part.write.mode("append").text(f"{base}/in")
        start(live.read_messages(spark, f"{base}/in"), base).trigger(availableNow=True).start().awaitTermination()
    return base


def _appended(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream in append mode has written in the end."""

    def start(trades: DataFrame, base: str) -> DataStreamWriter:
        return live.write_stream(make(live.dedupe_stream(trades, DELAY)), f"{base}/out", f"{base}/checkpoint", every=None)

    base = arriving(spark, sf_dir, start)
    return spark.read.parquet(f"{base}/out").where(F.col("symbol") != END)


def _updated(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame], keys: Sequence[str]) -> DataFrame:
    """The last state of every key of a stream in update mode; each batch is appended with its number."""

    def start(trades: DataFrame, base: str) -> DataStreamWriter:
        def append(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{base}/out")

        return make(trades).writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{base}/checkpoint")

    rows = spark.read.parquet(f"{arriving(spark, sf_dir, start)}/out").where(F.col("symbol") != END)
    return newest_per_key(rows, keys, ["batch"]).drop("batch")


def _stream(name: str, make: Callable[[DataFrame], DataFrame], sql: str, *places: str) -> None:
    register(name, lambda spark, d: rounded(flat(_appended(spark, d, make)), *places), sql)


_stream(
    "stream_dedupe",
    lambda trades: trades.select("symbol", "agg_trade_id", "price", "transact_time"),
    f"WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, t AS transact_time FROM tape",
)
_stream(
    "stream_bars_1h",
    lambda trades: live.stream_bars(trades, "1h", DELAY),
    f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars",
)
_stream(
    "stream_levels_4h",
    lambda trades: live.stream_levels(trades, "4h", DELAY, EVENT_TICKS),
    f"WITH {levels_sql('4h')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
)
_stream(
    "stream_summary_1h",
    lambda trades: live.stream_summary(trades, "1h", DELAY),
    f"""WITH {TAPE} SELECT symbol, t - t % 3600000 AS bar_ms, count(*) AS total_trades, sum(qty) AS total_volume,
    round(CAST(sum(CAST(price AS DECIMAL(18,4)) * CAST(qty AS DECIMAL(18,4))) AS DOUBLE), 6) AS total_value,
    round(CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(*), 6) AS average_price, round(avg(qty), 6) AS average_quantity, max(price) AS max_price,
    min(price) AS min_price, count(*) FILTER (WHERE maker) AS buyer_market_trades,
    count(*) FILTER (WHERE NOT maker) AS seller_market_trades FROM tape GROUP BY ALL""",
    "total_value", "average_price", "average_quantity",
)
register(
    "stream_last_seen",
    lambda spark, d: _updated(spark, d, live.stream_last_seen, ["symbol"]),
    f"WITH {TAPE} SELECT symbol, max(t) AS last_ms FROM tape GROUP BY symbol",
)

# Final bars in long form, with the bar's own measures on every level.
FINAL_SQL = f"""WITH {levels_sql('4h')}, bars AS (
  SELECT symbol, t - t % 14400000 AS bar_ms, first(price ORDER BY t, id) AS open, last(price ORDER BY t, id) AS close, max(price) AS high,
    min(price) AS low, sum(qty) AS qty, sum(CASE WHEN maker THEN qty ELSE 0 END) AS sum_total_bid_qty,
    sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS sum_total_ask_qty FROM tape GROUP BY ALL)
SELECT *  REPLACE (CAST(total_bid_trades AS DOUBLE) AS total_bid_trades, CAST(total_ask_trades AS DOUBLE) AS total_ask_trades)
FROM (SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels) JOIN bars USING (symbol, bar_ms)"""


def _with_levels(final: DataFrame) -> DataFrame:
    bars = final.select("symbol", "timeframe", "time_rounded", "open", "close", "high", "low", "qty", "sum_total_bid_qty", "sum_total_ask_qty")
    return flat(explode_footprint(final).join(bars, ["symbol", "timeframe", "time_rounded"]))


register(
    "stream_final_bars",
    lambda spark, d: _with_levels(_appended(spark, d, lambda trades: live.stream_final_bars(trades, "4h", DELAY, EVENT_TICKS))),
    FINAL_SQL,
)


def _corrected(spark: SparkSession, d: str) -> DataFrame:
    """Bars that rows from days before the watermark have been taken into."""

    def start(trades: DataFrame, base: str) -> DataStreamWriter:
        places = [f"{base}/{x}" for x in ("minutes", "out", "progress")]
        return corrections.write_corrected_bars(trades, *places, "4h", f"{base}/checkpoint", DAY_MS, EVENT_TICKS, parts=("symbol", "day"))

    base = arriving(spark, d, start, late_days=5)
    return _with_levels(spark.read.parquet(f"{base}/out").where(F.col("symbol") != END))


register("stream_late_corrections", _corrected, FINAL_SQL)
