"""Decode JSON trade messages, from files or from a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.expressions import side_flag
from tickloom.schema import MESSAGE_KEYS, MESSAGE_TYPE


def parse_messages(df: DataFrame, column: str = "value") -> DataFrame:
    """Add the message fields and ``corrupt``: the text of a message that is not a JSON object.

    Parsed once into a map, whose keys keep their case.
    """
    parsed = df.withColumn("_m", F.from_json(F.col(column).cast("string"), "map<string,string>"))

    def field(name: str) -> Column:
        return F.col("_m").getItem(MESSAGE_KEYS[name])

    event_time = field("event_time").try_cast("bigint")
    return parsed.select(
        *df.columns,
        field("type").alias("type"),
        field("symbol").alias("symbol"),
        field("agg_trade_id").try_cast("bigint").alias("agg_trade_id"),
        field("price").try_cast("double").alias("price"),
        field("quantity").try_cast("double").alias("quantity"),
        event_time.alias("event_time"),
        F.coalesce(field("transact_time").try_cast("bigint"), event_time).alias("transact_time"),
        side_flag(field("is_buyer_maker")).alias("is_buyer_maker"),
        F.when(F.col("_m").isNull(), F.col(column).cast("string")).alias("corrupt"),
    )


def decode_messages(df: DataFrame, column: str = "value") -> DataFrame:
    """Trades of the trade messages; other event types are ignored."""
    parsed = parse_messages(df, column).where(F.col("type") == MESSAGE_TYPE)
    return parsed.drop("type", "corrupt", column)


def corrupt_messages(df: DataFrame, column: str = "value") -> DataFrame:
    return parse_messages(df, column).where(F.col("corrupt").isNotNull()).select("corrupt")
