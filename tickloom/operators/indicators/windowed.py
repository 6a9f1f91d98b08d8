"""Indicators of a bounded look-back. A value is null until its window is full."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tickloom.functions.expressions import weighted_sum
from tickloom.operators.indicators.spec import Indicator, Phase, at_least, ref, source, windowed
from tickloom.operators.series import Blocks, Recurrence


def weighted(b: Blocks, x: Column, weights: list[float]) -> Column:
    """Mean of the newest rows with fixed weights, oldest first."""
    n, total = len(weights), sum(weights)
    rows = F.collect_list(x).over(b.last(n))
    return F.when(F.size(rows) == n, weighted_sum(rows, [w / total for w in weights]))


def linear_weights(n: int) -> list[float]:
    return [float(k) for k in range(1, n + 1)]


def _weighted_average(name: str, weights: list[float], column: str) -> Indicator:
    return windowed((name,), len(weights), lambda b: {name: weighted(b, source(column), weights)})


def sma(length: int = 50, column: str = "close") -> Indicator:
    n, name, x = at_least(length, 1), f"SMA_{int(length)}", source(column)
    return windowed((name,), n, lambda b: {name: b.full(F.avg(x), x, n)})


def wma(length: int = 30, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _weighted_average(f"WMA_{n}", linear_weights(n), column)


def sinwma(length: int = 14, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _weighted_average(f"SINWMA_{n}", [math.sin(k * math.pi / (n + 1)) for k in range(1, n + 1)], column)


def alma(length: int = 9, sigma: float = 6.0, offset: float = 0.85, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    m, s = offset * (n - 1), n / sigma
    return _weighted_average(f"ALMA_{n}", [math.exp(-((k - m) ** 2) / (2 * s * s)) for k in range(n)], column)


def swma(length: int = 10, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _weighted_average(f"SWMA_{n}", [float(min(k, n + 1 - k)) for k in range(1, n + 1)], column)


def fwma(length: int = 10, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    weights = [1.0, 1.0]
    while len(weights) < n:
        weights.append(weights[-1] + weights[-2])
    return _weighted_average(f"FWMA_{n}", weights[:n], column)


def hma(length: int = 9, column: str = "close") -> Indicator:
    n = at_least(length, 2)
    half, root, name, x = n // 2, int(math.sqrt(n)), f"HMA_{n}", source(column)
    raw = f"_{name}_raw"
    return windowed(
        (name,),
        n + root,
        lambda b: {raw: 2 * weighted(b, x, linear_weights(half)) - weighted(b, x, linear_weights(n))},
        lambda b: {name: weighted(b, F.col(raw), linear_weights(root))},
    )


def trima(length: int = 10, column: str = "close") -> Indicator:
    n, name, x = at_least(length, 1), f"TRIMA_{int(length)}", source(column)
    inner, outer, raw = n // 2 + 1, math.ceil((n + 1) / 2), f"_{name}_raw"
    return windowed(
        (name,),
        inner + outer,
        lambda b: {raw: b.full(F.avg(x), x, inner)},
        lambda b: {name: b.full(F.avg(raw), raw, outer)},
    )


def linreg(length: int = 14, column: str = "close") -> Indicator:
    """Newest value of the least-squares line: 3 * linearly weighted mean - 2 * mean."""
    n, name, x = at_least(length, 2), f"LR_{int(length)}", source(column)
    return windowed(
        (name,), n, lambda b: {name: 3 * weighted(b, x, linear_weights(n)) - 2 * b.full(F.avg(x), x, n)}
    )


def vwma(length: int = 10, column: str = "close") -> Indicator:
    n, name, x, v = at_least(length, 1), f"VWMA_{int(length)}", source(column), F.col("volume")
    return windowed((name,), n, lambda b: {name: F.try_divide(b.full(F.sum(x * v), x * v, n), b.full(F.sum(v), v, n))})


def vwap(length: int = 14) -> Indicator:
    n, name = at_least(length, 1), f"VWAP_{int(length)}"
    v, tpv = F.col("volume"), source("hlc3") * F.col("volume")
    return windowed((name,), n, lambda b: {name: F.try_divide(b.full(F.sum(tpv), tpv, n), b.full(F.sum(v), v, n))})


def _range_share(b: Blocks, n: int) -> tuple[Column, Column, Column]:
    """Lowest low, highest high and close over the newest n rows."""
    return b.full(F.min("low"), "low", n), b.full(F.max("high"), "high", n), F.col("close")


def stoch(fastk_period: int = 14, slowk_period: int = 3, slowd_period: int = 3) -> Indicator:
    n, k, d = at_least(fastk_period, 1), at_least(slowk_period, 1), at_least(slowd_period, 1)
    tag = f"{n}_{k}_{d}"
    raw, out_k, out_d = f"_STOCH_{tag}_raw", f"STOCHk_{tag}", f"STOCHd_{tag}"

    def first(b: Blocks) -> dict[str, Column]:
        low, high, close = _range_share(b, n)
        return {raw: F.try_divide(100 * (close - low), high - low)}

    return windowed(
        (out_k, out_d),
        n + k + d,
        first,
        lambda b: {out_k: b.full(F.avg(raw), raw, k)},
        lambda b: {out_d: b.full(F.avg(out_k), out_k, d)},
    )


def willr(length: int = 14) -> Indicator:
    n, name = at_least(length, 1), f"WILLR_{int(length)}"

    def layer(b: Blocks) -> dict[str, Column]:
        low, high, close = _range_share(b, n)
        return {name: F.try_divide(-100 * (high - close), high - low)}

    return windowed((name,), n, layer)


def cci(length: int = 20, c: float = 0.015) -> Indicator:
    n, name, tp = at_least(length, 1), f"CCI_{int(length)}_{c}", source("hlc3")
    mean = f"_CCI_{n}_mean"

    def deviation(b: Blocks) -> dict[str, Column]:
        apart = F.transform(F.collect_list(tp).over(b.last(n)), lambda v: F.abs(v - F.col(mean)))
        spread = F.aggregate(apart, F.lit(0.0), lambda total, v: total + v) / n
        return {name: F.try_divide(tp - F.col(mean), c * spread)}

    return windowed((name,), n, lambda b: {mean: b.full(F.avg(tp), tp, n)}, deviation)


def roc(length: int = 12, column: str = "close") -> Indicator:
    n, name, x = at_least(length, 1), f"ROC_{int(length)}", source(column)
    return windowed((name,), n + 1, lambda b: {name: 100 * (F.try_divide(x, b.lag(x, n)) - 1)})


def bbands(length: int = 20, std: float = 2.0, column: str = "close") -> Indicator:
    n, tag, x = at_least(length, 2), f"{int(length)}_{float(std)}", source(column)
    low, mid, high, width, share = (f"{p}_{tag}" for p in ("BBL", "BBM", "BBU", "BBB", "BBP"))
    dev = f"_BB_{tag}_dev"
    return windowed(
        (low, mid, high, width, share),
        n,
        lambda b: {mid: b.full(F.avg(x), x, n), dev: b.full(F.stddev_pop(x), x, n)},
        lambda b: {low: ref(mid) - std * ref(dev), high: ref(mid) + std * ref(dev)},
        lambda b: {
            width: F.try_divide(100 * (ref(high) - ref(low)), ref(mid)),
            share: F.try_divide(x - ref(low), ref(high) - ref(low)),
        },
    )


def mfi(length: int = 14) -> Indicator:
    n, name, tp = at_least(length, 1), f"MFI_{int(length)}", source("hlc3")
    up, down, flow = f"_{name}_up", f"_{name}_down", tp * F.col("volume")

    def first(b: Blocks) -> dict[str, Column]:
        change = tp - b.lag(tp)
        return {
            up: F.when(change > 0, flow).when(change.isNotNull(), 0.0),
            down: F.when(change < 0, flow).when(change.isNotNull(), 0.0),
        }

    def second(b: Blocks) -> dict[str, Column]:
        gain, loss = b.full(F.sum(up), up, n), b.full(F.sum(down), down, n)
        return {name: F.try_divide(100 * gain, gain + loss)}

    return windowed((name,), n + 1, first, second)


def hilo(length: int = 13) -> Indicator:
    """Mean of lows after a close above the previous mean of highs, and the reverse; else as before."""
    n, m = at_least(length, 1), int(int(length) * 1.8)
    name = f"HILO_{n}_{m}"
    high, low, pick, held = f"_{name}_h", f"_{name}_l", f"_{name}_pick", f"_{name}_held"

    def choose(b: Blocks) -> dict[str, Column]:
        above, below = F.col("close") > b.lag(high), F.col("close") < b.lag(low)
        known = b.lag(high).isNotNull() & b.lag(low).isNotNull()
        return {pick: F.when(known & above, F.col(low)).when(known & below, F.col(high))}

    return Indicator(
        (name,),
        (
            Phase(
                (lambda b: {high: b.full(F.avg("high"), "high", n), low: b.full(F.avg("low"), "low", m)}, choose),
                lambda: {held: Recurrence(pick, keep="last")},
            ),
            Phase((lambda b: {name: F.col(held)},)),
        ),
        pre=m + 1,
    )
