"""Registered queries that write the event tape in a layout and read it back with the reader for it."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.bars import ohlcv
from tickloom.plans.catalog import TAPE, bars_sql, flat, register
from tickloom.plans.stage import shared_folder
from tickloom.plans.tape import tape_events
from tickloom.schema import AGG_TRADES, TAPE as TAPE_SCHEMA
from tickloom.sinks import files, writers
from tickloom.sources import readers

FIRST_MS = 1_704_067_200_000  # 1 January 2024
SHOWN = ("symbol", "agg_trade_id", "price", "quantity", "transact_time", "is_buyer_maker")
SHOWN_SQL = "symbol, id AS agg_trade_id, price, qty AS quantity, t AS transact_time, maker AS is_buyer_maker"


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _daily(spark: SparkSession, d: str) -> DataFrame:
    base, tape = _folder(spark), tape_events(spark, d)
    tape.withColumn("date", F.timestamp_millis("transact_time").cast("date")).write.partitionBy("symbol", "date").parquet(base)
    return readers.read_daily_trades(spark, base, ["S0", "S2", "absent"], "2024-01-05", "2024-01-12").select(*SHOWN)


register(
    "read_daily",
    _daily,
    f"WITH {TAPE} SELECT {SHOWN_SQL} FROM tape WHERE symbol IN ('S0', 'S2') AND t >= {FIRST_MS + 4 * 86400000} AND t < {FIRST_MS + 12 * 86400000}",
)


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    """Years and months of folders that only the ids decide."""
    base, number = _folder(spark), F.col("agg_trade_id")
    parts = {"year": (number % 2 + 2023).cast("int"), "month": (number % 12 + 1).cast("int")}
    tape_events(spark, d).withColumns(parts).write.partitionBy("symbol", "year", "month").parquet(base)
    return readers.read_monthly_trades(spark, base, ["S1", "S3"], (2023, 6), (2024, 3)).select(*SHOWN, "year", "month")


register(
    "read_monthly",
    _monthly,
    f"""WITH {TAPE} SELECT {SHOWN_SQL}, CAST(2023 + id % 2 AS INTEGER) AS year, CAST(id % 12 + 1 AS INTEGER) AS month FROM tape
    WHERE symbol IN ('S1', 'S3') AND (2023 + id % 2) * 12 + id % 12 + 1 BETWEEN 2023 * 12 + 6 AND 2024 * 12 + 3""",
)


def _existing(spark: SparkSession, d: str) -> DataFrame:
    """A list of files of which every other one is not there."""
    base, tape = _folder(spark), tape_events(spark, d).persist()
    names = []
    for k in range(4):
        tape.where(F.col("symbol") == f"S{k}").write.parquet(f"{base}/part{k}")
        names += [f"{base}/part{k}", f"{base}/absent{k}"]
    tape.unpersist()
    return readers.read_existing_files(spark, names, TAPE_SCHEMA).select(*SHOWN)


register("read_existing", _existing, f"WITH {TAPE} SELECT {SHOWN_SQL} FROM tape")

CSV_SHOWN = [c for c in SHOWN if c != "symbol"]
CSV_SQL = SHOWN_SQL.removeprefix("symbol, ")


def _headerless(spark: SparkSession, d: str) -> DataFrame:
    """Half of the files have a header line, which is dropped from among the data."""
    base, rows = _folder(spark), tape_events(spark, d).select(*AGG_TRADES.fieldNames())
    for half, header in ((0, True), (1, False)):
        rows.where(F.col("agg_trade_id") % 2 == half).write.option("header", header).csv(f"{base}/{half}")
    return readers.read_headerless_trades(spark, [f"{base}/0", f"{base}/1"]).select(*CSV_SHOWN)


register("read_headerless", _headerless, f"WITH {TAPE} SELECT {CSV_SQL} FROM tape")


def _by_name(spark: SparkSession, d: str) -> DataFrame:
    """Columns in another order than declared."""
    base = _folder(spark)
    tape_events(spark, d).select(*AGG_TRADES.fieldNames()[::-1]).write.option("header", True).csv(base)
    return readers.read_trades_csv(spark, base).select(*CSV_SHOWN)


register("read_csv_by_name", _by_name, f"WITH {TAPE} SELECT {CSV_SQL} FROM tape")


def _dataset(spark: SparkSession, d: str) -> DataFrame:
    base = _folder(spark)
    rows = tape_events(spark, d).selectExpr(
        "agg_trade_id AS id", "price", "quantity AS `qty `", "cast(null AS double) AS quote_qty", "transact_time AS time", "is_buyer_maker"
    )
    rows.write.option("header", True).csv(base)
    return readers.read_dataset(spark, "trades", base).drop("quote_qty")


register("read_dataset", _dataset, f"WITH {TAPE} SELECT id, price, qty, t AS time, maker AS is_buyer_maker FROM tape")


def _klines(spark: SparkSession, d: str) -> DataFrame:
    """Bars of one symbol as the exchange lists them, by position."""
    base, bars = _folder(spark), ohlcv(tape_events(spark, d), "1h").where(F.col("symbol") == "S1")
    opened = F.unix_millis("time_rounded")
    zeros = [F.lit(0).alias(f"z{k}") for k in range(5)]
    bars.select(opened.alias("t"), "open", "high", "low", "close", "qty", (opened + 3_599_999).alias("c"), *zeros).write.csv(base)
    return flat(readers.klines_as_bars(readers.read_klines(spark, base), "S1", "1h"))


register(
    "read_klines",
    _klines,
    f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, open, close, high, low, qty AS volume FROM bars WHERE symbol = 'S1'",
)


def _accounted(spark: SparkSession, d: str) -> DataFrame:
    """Symbols found in the names of folders, with the files that each has (one, as written here)."""
    base = _folder(spark)
    with writers.open_partitions(spark):
        tape_events(spark, d).repartition("symbol").write.partitionBy("symbol").parquet(base)
    names = readers.symbols_in_paths(spark.read.parquet(base))
    counted = readers.file_accounting(readers.list_files(spark, base, ".parquet"))
    return names.join(counted, "symbol").select("symbol", "files", (F.col("bytes") > 0).alias("has_bytes"))


register("files_per_symbol", _accounted, f"WITH {TAPE} SELECT DISTINCT symbol, CAST(1 AS BIGINT) AS files, true AS has_bytes FROM tape")


def _formats(spark: SparkSession, d: str) -> DataFrame:
    """The tape through every format of the plain reader and writer."""
    base, rows, out = _folder(spark), tape_events(spark, d).select("symbol", "agg_trade_id", "price"), None
    schema = "symbol string, agg_trade_id bigint, price double"
    for fmt in readers.FORMATS:
        options = {"header": True} if fmt == "csv" else {}
        writers.write_data(rows, f"{base}/{fmt}", fmt, **options)
        read = readers.read_data(spark, f"{base}/{fmt}", fmt, **options)
        read = read.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")]).withColumn("fmt", F.lit(fmt))
        out = read if out is None else out.unionByName(read)
    return out


register(
    "read_written_formats",
    _formats,
    f"WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, fmt FROM tape, (VALUES ('parquet'), ('csv'), ('json')) x(fmt)",
)


def _symbol_files(spark: SparkSession, d: str) -> DataFrame:
    """Files named by symbol below exchange and timeframe, and one whose name does not follow the layout."""
    base, aside = _folder(spark), _folder(spark)
    tape = tape_events(spark, d)
    with writers.open_partitions(spark):
        tape.select("symbol", *AGG_TRADES.fieldNames()).write.partitionBy("symbol").option("header", True).csv(aside)
    spark.createDataFrame([], AGG_TRADES).coalesce(1).write.option("header", True).csv(f"{base}/x/1h")
    for folder in [c for c in files.children(spark, aside) if c.startswith("symbol=")]:
        parts = sorted(c for c in files.children(spark, f"{aside}/{folder}") if c.startswith("part-"))
        for k, part in enumerate(parts):
            files.rename(spark, f"{aside}/{folder}/{part}", f"{base}/x/1h/{folder.split('=')[1]}__2024-{k}.csv")
    return readers.read_symbol_csvs(spark, base).select(*SHOWN, "exchange")


register("read_symbol_files", _symbol_files, f"WITH {TAPE} SELECT {SHOWN_SQL}, 'x' AS exchange FROM tape")


def _archived(spark: SparkSession, d: str) -> DataFrame:
    rows = tape_events(spark, d).select(*SHOWN)
    stored = writers.write_csv_archive(rows, _folder(spark), datetime(2024, 2, 1, tzinfo=timezone.utc))
    return spark.read.schema(rows.schema).option("header", True).csv(stored)


register("csv_archive", _archived, f"WITH {TAPE} SELECT {SHOWN_SQL} FROM tape")


def _consolidated(spark: SparkSession, d: str) -> DataFrame:
    """One folder for each symbol and exchange."""
    base, rows = _folder(spark), tape_events(spark, d).select(*SHOWN).withColumn("exchange", F.concat(F.lit("x"), F.col("agg_trade_id") % 2))
    writers.write_symbol_csv(rows, base)
    return spark.read.schema(rows.schema).option("header", True).csv(base)


register("symbol_csv", _consolidated, f"WITH {TAPE} SELECT {SHOWN_SQL}, 'x' || CAST(id % 2 AS VARCHAR) AS exchange FROM tape")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    """The tape with its month run through in an hour, so that minutes hold many trades."""
    time = FIRST_MS + F.floor((F.col("transact_time") - FIRST_MS) / 720)
    return tape_events(spark, d).withColumn("transact_time", time)


DENSE = f"{TAPE}, dense AS (SELECT symbol, id, price, qty, maker, {FIRST_MS} + (t - {FIRST_MS}) // 720 AS t FROM tape)"


def _minutes(spark: SparkSession, d: str) -> str:
    """Minutes landed in two parts."""
    base, dense = _folder(spark), _dense(spark, d)
    for half in range(2):
        writers.append_minutes(dense.where(F.col("agg_trade_id") % 2 == half), base)
    return base


register(
    "appended_minutes",
    lambda spark, d: readers.read_partitioned(spark, _minutes(spark, d), readers.MINUTE_PARTS).select(*SHOWN, "day", "hour", "minute"),
    f"""WITH {DENSE} SELECT {SHOWN_SQL}, strftime(make_timestamp_ms(t), '%Y-%m-%d') AS day, strftime(make_timestamp_ms(t), '%H') AS hour,
    strftime(make_timestamp_ms(t), '%M') AS minute FROM dense""",
)
register(
    "latest_minutes_of_folders",
    lambda spark, d: readers.read_latest_minutes(spark, _minutes(spark, d), 15).select(*SHOWN),
    f"""WITH {DENSE} SELECT {SHOWN_SQL} FROM dense
    WHERE t // 60000 IN (SELECT DISTINCT t // 60000 AS m FROM dense ORDER BY m DESC LIMIT 15)""",
)
