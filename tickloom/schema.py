"""Declared schemas, column aliases, timeframes and tick sizes of the trade tape."""

from __future__ import annotations

from pyspark.sql import types as T

# Supported timeframes and their width in seconds.
TIMEFRAMES = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "4h": 14400,
    "12h": 43200,
    "1d": 86400,
    "1w": 604800,
}

# Decimals a price level is rounded to; other symbols stay unrounded.
TICK_DECIMALS = {"BTCUSDT": 0, "ETHUSDT": 0, "SOLUSDT": 1}


_TYPES = {"string": T.StringType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType}


def _schema(text: str) -> T.StructType:
    """Build a StructType from ``name type, name type`` (no session needed)."""
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in fields])


AGG_TRADES = _schema(
    "agg_trade_id bigint, price double, quantity double, first_trade_id bigint, "
    "last_trade_id bigint, transact_time bigint, is_buyer_maker boolean"
)
TRADE_COLUMNS = AGG_TRADES.fieldNames()
TAPE = T.StructType([T.StructField("symbol", T.StringType()), *AGG_TRADES.fields])

KLINES = _schema(
    "open_time bigint, open double, high double, low double, close double, volume double, "
    "close_time bigint, quote_volume double, count bigint, taker_buy_volume double, "
    "taker_buy_quote_volume double, ignore string"
)

# Columns of the exchange's other market datasets.
DATASETS = {
    "aggTrades": AGG_TRADES,
    "klines": KLINES,
    "trades": _schema(
        "id bigint, price double, qty double, quote_qty double, time bigint, is_buyer_maker boolean"
    ),
    "bookTicker": _schema(
        "update_id bigint, best_bid_price double, best_bid_qty double, best_ask_price double, "
        "best_ask_qty double, transaction_time bigint, event_time bigint"
    ),
    "bookDepth": _schema("percentage double, depth double, notional double, timestamp string"),
    "liquidationSnapshot": _schema(
        "side string, order_type string, time_in_force string, "
        "original_quantity double, price double, average_price double, order_status string, "
        "last_fill_quantity double, accumulated_fill_quantity double"
    ),
    "metrics": _schema(
        "symbol string, sum_open_interest double, "
        "sum_open_interest_value double, count_toptrader_long_short_ratio double, "
        "sum_toptrader_long_short_ratio double, count_long_short_ratio double, "
        "sum_taker_long_short_vol_ratio double"
    ),
}

# Keys of the JSON trade message (case matters: E is the event time, e the type).
MESSAGE_TYPE = "aggTrade"
MESSAGE_KEYS = {
    "type": "e",
    "event_time": "E",
    "transact_time": "T",
    "symbol": "s",
    "agg_trade_id": "a",
    "price": "p",
    "quantity": "q",
    "is_buyer_maker": "m",
}

# Spellings found in landed files, mapped to the canonical trade columns.
ALIASES = {
    "agg_trade_id": ("id", "market_raw_id", "aggregate_trade_id", "a"),
    "price": ("p",),
    "quantity": ("qty", "q"),
    "transact_time": ("time", "timestamp"),
    "is_buyer_maker": ("is_buyer_market", "m"),
}


def timeframe_seconds(timeframe: str) -> int:
    """Width of a timeframe in seconds; unknown names raise."""
    try:
        return TIMEFRAMES[timeframe]
    except KeyError:
        raise ValueError(f"unsupported timeframe {timeframe!r}; known: {list(TIMEFRAMES)}") from None


def timeframe_ms(timeframe: str) -> int:
    return timeframe_seconds(timeframe) * 1000
