"""Indicators whose state does not compose over blocks: one ordered pass per series.

Spark partitions by series, sorts, and streams each partition through ``mapInPandas``; a worker holds
one Arrow batch and a few numbers of state, never a series. Input rows are bars, so the length of a
series is bounded by the calendar however many trades its symbol has.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.operators.indicators.spec import at_least, source

# Takes the state and high, low and the price source of the next bar; changes the state, returns one value per output.
Step = Callable[[dict[str, Any], float, float, float], tuple[float | None, ...]]


@dataclass(frozen=True)
class Stateful:
    """An ordered fold; its state holds numbers, flags and lists of numbers only, so that it can be stored as JSON."""

    outputs: tuple[str, ...]
    start: Callable[[], dict[str, Any]]
    step: Step
    column: str = "close"


def psar(acceleration: float = 0.02, maximum: float = 0.2) -> Stateful:
    """Wilder's parabolic stop-and-reverse."""

    def start() -> dict[str, Any]:
        return {"long": True, "sar": None, "best": 0.0, "rate": acceleration, "highs": [], "lows": []}

    def step(s: dict[str, Any], high: float, low: float, _: float) -> tuple[float | None, ...]:
        highs, lows = s["highs"], s["lows"]
        if not highs:
            pass
        elif s["sar"] is None:
            s["long"] = high - highs[-1] >= lows[-1] - low
            s["sar"] = lows[-1] if s["long"] else highs[-1]
            s["best"] = max(high, highs[-1]) if s["long"] else min(low, lows[-1])
        else:
            sar = s["sar"] + s["rate"] * (s["best"] - s["sar"])
            sar = min(sar, *lows) if s["long"] else max(sar, *highs)
            if (low < sar) if s["long"] else (high > sar):
                sar = s["best"]
                s.update(long=not s["long"], best=low if s["long"] else high, rate=acceleration)
            elif (high > s["best"]) if s["long"] else (low < s["best"]):
                s.update(best=high if s["long"] else low, rate=min(s["rate"] + acceleration, maximum))
            s["sar"] = sar
        s.update(highs=[*highs[-1:], high], lows=[*lows[-1:], low])
        return (s["sar"],)

    return Stateful((f"PSAR_{acceleration}_{maximum}",), start, step)


def mcgd(length: int = 10, c: float = 1.0, column: str = "close") -> Stateful:
    """McGinley dynamic; where its denominator vanishes the value is null and starts anew."""
    n = at_least(length, 1)

    def step(s: dict[str, Any], _: float, __: float, x: float) -> tuple[float | None, ...]:
        y = s["y"]
        if not y:
            y = x
        else:
            ratio = (x / y) * (x / y)
            bottom = c * n * ratio * ratio
            y = y + (x - y) / bottom if bottom else None
        s["y"] = y
        return (y,)

    return Stateful((f"MCGD_{n}",), lambda: {"y": None}, step, column)


def mama_period(period: float) -> float:
    """Period used for the limits: halved while above 3."""
    while period > 3:
        period /= 2
    return 1.0 if period < 1 else period


def mama(length: float = 14, column: str = "close") -> Stateful:
    """Ehlers' MESA adaptive average and its follower, limits 0.5/p and 0.05/p."""
    p = mama_period(float(length))
    fast, slow = 0.5 / p, 0.05 / p

    def hilbert(v: list[float], scale: float) -> float:
        # Taps of the published Hilbert transformer, newest first.
        return (0.0962 * v[0] + 0.5769 * v[2] - 0.5769 * v[4] - 0.0962 * v[6]) * scale

    def start() -> dict[str, Any]:
        numbers = dict.fromkeys(("period", "i2", "q2", "re", "im", "phase", "mama", "fama"), 0.0)
        return numbers | {"seen": 0, "price": [0.0] * 4} | {name: [0.0] * 7 for name in ("smooth", "trend", "quad", "inph")}

    def push(s: dict[str, Any], name: str, x: float) -> list[float]:
        s[name] = [x, *s[name][:-1]]
        return s[name]

    def step(s: dict[str, Any], _: float, __: float, x: float) -> tuple[float | None, ...]:
        s["seen"] += 1
        price = push(s, "price", x)
        if s["seen"] < 6:
            s["mama"] = s["fama"] = x
            return (x, x)
        scale = 0.075 * s["period"] + 0.54
        smooth = push(s, "smooth", (4 * price[0] + 3 * price[1] + 2 * price[2] + price[3]) / 10)
        trend = push(s, "trend", hilbert(smooth, scale))
        quad = push(s, "quad", hilbert(trend, scale))
        inph = push(s, "inph", trend[3])
        i2 = 0.2 * (inph[0] - hilbert(quad, scale)) + 0.8 * s["i2"]
        q2 = 0.2 * (quad[0] + hilbert(inph, scale)) + 0.8 * s["q2"]
        re = 0.2 * (i2 * s["i2"] + q2 * s["q2"]) + 0.8 * s["re"]
        im = 0.2 * (i2 * s["q2"] - q2 * s["i2"]) + 0.8 * s["im"]
        period = s["period"]
        if re and im:
            period = 2 * math.pi / math.atan(im / re)
        period = max(min(period, 1.5 * s["period"]), 0.67 * s["period"])
        period = 0.2 * max(min(period, 50.0), 6.0) + 0.8 * s["period"]
        phase = math.degrees(math.atan(quad[0] / inph[0])) if inph[0] else s["phase"]
        alpha = min(max(fast / max(s["phase"] - phase, 1.0), slow), fast)
        s["mama"] = alpha * x + (1 - alpha) * s["mama"]
        s["fama"] = 0.5 * alpha * s["mama"] + (1 - 0.5 * alpha) * s["fama"]
        s.update(period=period, i2=i2, q2=q2, re=re, im=im, phase=phase)
        return (s["mama"], s["fama"])

    return Stateful((f"MAMA_{p}", f"FAMA_{p}"), start, step, column)


def add_stateful(
    df: DataFrame, indicators: Sequence[Stateful], keys: Sequence[str], stored: str | None = None, left: str | None = None
) -> DataFrame:
    """Add the outputs of stateful indicators to an indexed frame.

    ``stored`` names a column with the states to start a series from (JSON; null: from the beginning), ``left``
    a new one that gets the states after the last bar of a series, on that bar's row.
    """
    if not indicators:
        return df
    keys, names = list(keys), df.columns
    plain = [c.replace(".", "_dot_") for c in names]  # mapInPandas wants names without dots
    inputs = [f"_x{k}" for k in range(len(indicators))]
    outputs = [name for s in indicators for name in s.outputs]
    df = df.toDF(*plain)
    fields = [*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name in outputs]]
    fields += [T.StructField(left, T.StringType())] if left else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        series, states = None, []
        for batch in batches:
            values: list[list[float | None]] = [[] for _ in outputs]
            columns = [batch[c].tolist() for c in ("high", "low", *inputs)]
            before = batch[stored].tolist() if stored else [None] * len(batch)
            last = (batch["i"] == batch["n_bars"] - 1).tolist() if left else before
            ends = []
            for key, known, end, high, low, *xs in zip(zip(*[batch[k] for k in keys], strict=True), before, last, *columns, strict=True):
                if key != series:
                    series, states = key, json.loads(known) if known else [s.start() for s in indicators]
                row = [v for s, state, x in zip(indicators, states, xs, strict=True) for v in s.step(state, high, low, x)]
                for cells, value in zip(values, row, strict=True):
                    cells.append(value)
                ends.append(json.dumps(states) if left and end else None)
            out = batch.drop(columns=inputs)
            made = {n: pd.Series(v, index=out.index, dtype="float64") for n, v in zip(outputs, values, strict=True)}
            yield out.assign(**made, **({left: pd.Series(ends, index=out.index, dtype="object")} if left else {}))

    prices = {name: source(s.column) for name, s in zip(inputs, indicators, strict=True)}
    ordered = df.withColumns(prices).repartition(*keys).sortWithinPartitions(*keys, F.col("i"))
    return ordered.mapInPandas(run, T.StructType(fields)).toDF(*names, *outputs, *([left] if left else []))
