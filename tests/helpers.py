"""Small hand-made tapes and bars."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.schema import TAPE

HOUR = 3_600_000


def tape(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows ``(symbol, id, price, quantity, ms, maker)``."""
    return spark.createDataFrame([(s, i, p, q, i, i, t, m) for s, i, p, q, t, m in rows], TAPE)


def random_rows(n: int, symbols=("BTCUSDT", "XYZ"), step_ms: int = 600_000, seed: int = 7, hot: float = 0.5) -> list[tuple]:
    """A random tape; the first symbol takes the share ``hot`` of the trades."""
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rng.randrange(1, step_ms)
        symbol = symbols[0] if rng.random() < hot else rng.choice(symbols[1:])
        rows.append((symbol, i, round(100 + 10 * rng.random(), 2), float(rng.randrange(1, 50)), t, rng.random() < 0.5))
    return rows


def bars_of(spark: SparkSession, closes: dict[str, list[float]], timeframe: str = "1h") -> DataFrame:
    """Hourly bars from closes; high and low one around them, volume counting up."""
    rows = [
        (s, timeframe, i * HOUR, c, c, c + 1.0, c - 1.0, float(1 + i % 7))
        for s, values in closes.items()
        for i, c in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "symbol string, timeframe string, ms bigint, open double, close double, high double, low double, volume double")
    return df.withColumn("time_rounded", F.timestamp_millis("ms")).drop("ms")


def walk(n: int, seed: int = 3) -> list[float]:
    rng, x, out = random.Random(seed), 100.0, []
    for _ in range(n):
        x = max(5.0, x + rng.gauss(0, 1.5))
        out.append(round(x, 4))
    return out


def by_key(df: DataFrame, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in df.select(key, value).collect()}
