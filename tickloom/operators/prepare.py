"""Row-level preparation of the tape: names, types, times, sides and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.expressions import col, side_flag
from tickloom.schema import AGG_TRADES, ALIASES, TRADE_COLUMNS


def rename_by_position(df: DataFrame, names: Sequence[str] = TRADE_COLUMNS) -> DataFrame:
    """Give the columns of a headerless file their canonical names."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def drop_header_rows(df: DataFrame, id_column: str = "agg_trade_id") -> DataFrame:
    """Drop rows whose id is not a number (header lines read as data)."""
    return df.where(F.col(id_column).try_cast("bigint").isNotNull())


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename known spellings to the canonical trade columns."""
    renames = {
        alias: name
        for name, aliases in ALIASES.items()
        if name not in df.columns
        for alias in aliases
        if alias in df.columns
    }
    return df.withColumnsRenamed(renames)


def canonical_types(df: DataFrame) -> DataFrame:
    """Cast trade columns to their declared types; values that do not parse become null."""
    casts = {}
    for field in AGG_TRADES.fields:
        if field.name == "is_buyer_maker" and field.name in df.columns:
            casts[field.name] = side_flag(field.name)
        elif field.name in df.columns:
            casts[field.name] = F.col(field.name).try_cast(field.dataType)
    return df.withColumns(casts)


def canonical_trades(df: DataFrame) -> DataFrame:
    return canonical_types(canonical_names(df))


def with_readable_time(df: DataFrame, ms: str = "transact_time", name: str = "time") -> DataFrame:
    """Add the timestamp of an epoch-ms column (milliseconds kept)."""
    return df.withColumn(name, F.timestamp_millis(F.col(ms)))


def round_down_to_interval(df: DataFrame, seconds: int, time: str | None = None) -> DataFrame:
    """Add ``time_rounded``: the start of the epoch-aligned interval of ``seconds``.

    The time column is ``time``, else ``timestamp``, else ``transact_time``; epoch ms or timestamp.
    """
    time = time or next((c for c in ("time", "timestamp", "transact_time") if c in df.columns), None)
    if time is None:
        raise ValueError("no time column")
    stamp = F.col(time)
    if df.schema[time].dataType.simpleString() in ("bigint", "int"):
        stamp = F.timestamp_millis(stamp)
    micros = F.unix_micros(stamp)
    return df.withColumn("time_rounded", F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000))))


def split_sides(df: DataFrame) -> DataFrame:
    """Add one struct per aggressor side; the other side's struct is null."""

    def side(flag: Column, name: str) -> Column:
        return F.when(
            flag,
            F.struct(
                F.col("price").alias("price_level"),
                F.col("quantity").alias(f"{name}_qty"),
                F.lit(1).alias(f"{name}_trades"),
                F.lit(1).alias(f"{name}_trades_aggr"),
            ),
        )

    maker = F.col("is_buyer_maker")
    return df.withColumns({"foot_bid": side(maker, "bid"), "foot_ask": side(~maker, "ask")})


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def with_tags(df: DataFrame, **tags: str) -> DataFrame:
    """Add literal columns such as timeframe, exchange and symbol."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def with_minute_parts(df: DataFrame, ms: str = "transact_time") -> DataFrame:
    """Add ``day``, ``hour`` and ``minute`` strings used as landing partitions."""
    stamp = F.timestamp_millis(F.col(ms))
    return df.withColumns(
        {
            "day": stamp.cast("date").cast("string"),
            "hour": F.lpad(F.hour(stamp).cast("string"), 2, "0"),
            "minute": F.lpad(F.minute(stamp).cast("string"), 2, "0"),
        }
    )


def in_universe(symbol: str | Column = "symbol") -> Column:
    """Quoted in USDT and not a USDC base."""
    return col(symbol).endswith("USDT") & ~col(symbol).startswith("USDC")


def analysis_frame(bars: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Select and rename final bars to the names the analysis stage uses."""
    names = {
        "time_rounded": "date",
        "qty": "volume",
        "sum_total_bid_qty": "total_bid_qty",
        "sum_total_ask_qty": "total_ask_qty",
        **(renames or {}),
    }
    kept = ["symbol", "timeframe", "time_rounded", "open", "close", "high", "low", "qty"]
    kept += ["sum_total_bid_qty", "sum_total_ask_qty", "footprint"]
    return bars.select(*[F.col(c).alias(names.get(c, c)) for c in kept if c in bars.columns])


def before_midnight(ms: str | Column, as_of: Column) -> Column:
    """True for times before midnight UTC of the ``as_of`` timestamp."""
    midnight = F.unix_millis(as_of)
    return col(ms) < midnight - F.pmod(midnight, F.lit(86_400_000))


def in_calendar_range(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Rows of the days ``start..end`` (both included); prunes when ``date`` is a partition."""
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


