"""Wide-column form: ``(row_key, qualifier, value)`` rows and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.series import index_in_order


def to_cells(df: DataFrame, row_key: Column, columns: Sequence[str]) -> DataFrame:
    """One row per cell, values as strings; null cells are not written."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(row_key.alias("row_key"), F.inline(cells)).where(F.col("value").isNotNull())


def bar_cells(bars: DataFrame, exchange: str, columns: Sequence[str] = ("open", "close", "high", "low", "qty")) -> DataFrame:
    """Bars as cells under ``exchange#symbol#timeframe#time``."""
    time = F.unix_millis("time_rounded").cast("string")
    return to_cells(bars, F.concat_ws("#", F.lit(exchange), "symbol", "timeframe", time), columns)


def trade_row_keys(trades: DataFrame) -> DataFrame:
    """Add ``row_key`` = ``symbol#yyyy-MM#seq``, seq counting the month's trades by (time, id).

    Numbering runs per minute and is shifted by the trades of earlier minutes: a hot symbol's month
    is spread over its minutes, and the offsets are at most 44 640 rows per symbol and month.
    """
    time = F.col("transact_time")
    dated = trades.withColumn("_month", F.trunc(F.timestamp_millis(time), "month"))
    minute = time - F.pmod(time, F.lit(60_000))
    numbered = index_in_order(dated, ["symbol", "_month"], ["transact_time", "agg_trade_id"], minute, "seq")
    month = F.substring(F.col("_month").cast("string"), 1, 7)
    return numbered.withColumns(
        {
            "month": month,
            "row_key": F.concat("symbol", F.lit("#"), month, F.lit("#"), F.col("seq").cast("string")),
        }
    ).drop("_month")


def trade_cells(
    trades: DataFrame, columns: Sequence[str] = ("price", "quantity", "transact_time", "is_buyer_maker")
) -> DataFrame:
    return to_cells(trade_row_keys(trades), F.col("row_key"), columns)


def scan_prefix(cells: DataFrame, symbol: str, columns: Mapping[str, str]) -> DataFrame:
    """Rows whose key starts with ``symbol#``, one typed column per qualifier; missing cells are null."""
    return pivot_cells(cells.where(F.col("row_key").startswith(f"{symbol}#")), columns)


def pivot_cells(cells: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Turn cells into one row per key with the given ``qualifier -> type`` columns."""
    return cells.groupBy("row_key").agg(
        *[
            F.max(F.when(F.col("qualifier") == name, F.col("value"))).try_cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )
