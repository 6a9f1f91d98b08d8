"""Indicators with a running value ``y = a*y_prev + b``, computed by the block scan."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from tickloom.operators.indicators.spec import Indicator, Phase, at_least, source_sql
from tickloom.operators.series import Blocks, Recurrence


def smooth(x: str, n: int, alpha: float, rank: str, gaps: bool = False) -> Recurrence:
    """Exponential smoothing of the SQL expression ``x``, seeded with the mean of the first n inputs.

    ``rank`` counts the inputs from 1 (0 or less before the first). While the seed builds up each
    input adds x/n, so the value at rank n is their mean. With ``gaps``, a null input later on leaves
    the value as it is; without, smoothings of equal length share their factor.
    """
    known = f" AND {x} IS NOT NULL" if gaps else ""
    return Recurrence(
        a=f"CASE WHEN {rank} > {n}{known} THEN {1.0 - alpha!r}D ELSE 1D END",
        b=f"CASE WHEN {rank} > {n} THEN {alpha!r}D * {x} WHEN {rank} > 0 THEN {x} / {n} END",
        least=1.0 - alpha,
    )


def smooth_of(weights: Mapping[str, float], n: int, alpha: float, rank: str) -> Recurrence:
    """As :func:`smooth`, of a weighted sum of running values of the same scan."""
    share = f"CASE WHEN {rank} > {n} THEN {alpha!r}D WHEN {rank} > 0 THEN 1D / {n} ELSE 0D END"
    return Recurrence(
        a=f"CASE WHEN {rank} > {n} THEN {1.0 - alpha!r}D ELSE 1D END",
        of={name: share if w == 1.0 else f"({share}) * {w!r}D" for name, w in weights.items()},
        least=1.0 - alpha,
    )


def row_rank(lead: int = 0) -> str:
    """Rank of a row's input when only the first ``lead`` rows have none."""
    return f"(i + 1 - {lead})"


def from_rank(n: int, value: str, rank: str) -> Column:
    return F.expr(f"CASE WHEN {rank} >= {n} THEN {value} END")


def ema_alpha(n: int) -> float:
    return 2.0 / (n + 1)


def _single(name: str, n: int, alpha: float, x: str) -> Indicator:
    y = f"_{name}_y"
    return Indicator(
        (name,),
        (
            Phase((), lambda: {y: smooth(x, n, alpha, row_rank())}),
            Phase((lambda b: {name: from_rank(n, y, row_rank())},)),
        ),
    )


def ema(length: int = 20, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _single(f"EMA_{n}", n, ema_alpha(n), source_sql(column))


def rma(length: int = 14, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _single(f"RMA_{n}", n, 1.0 / n, source_sql(column))


def macd(fast: int = 12, slow: int = 26, signal: int = 9, column: str = "close") -> Indicator:
    f, s, g = at_least(fast, 1), at_least(slow, 1), at_least(signal, 1)
    if f >= s:
        raise ValueError("fast must be below slow")
    tag, x = f"{f}_{s}_{g}", source_sql(column)
    line, hist, sig = f"MACD_{tag}", f"MACDh_{tag}", f"MACDs_{tag}"
    ef, es, eg = f"_{line}_f", f"_{line}_s", f"_{line}_g"
    return Indicator(
        (line, hist, sig),
        (
            Phase(
                (),
                lambda: {
                    ef: smooth(x, f, ema_alpha(f), row_rank()),
                    es: smooth(x, s, ema_alpha(s), row_rank()),
                    eg: smooth_of({ef: 1.0, es: -1.0}, g, ema_alpha(g), row_rank(s - 1)),
                },
            ),
            Phase(
                (
                    lambda b: {
                        line: from_rank(s, f"{ef} - {es}", row_rank()),
                        sig: from_rank(g, eg, row_rank(s - 1)),
                    },
                    lambda b: {hist: F.col(line) - F.col(sig)},
                )
            ),
        ),
    )


def rsi(length: int = 14, column: str = "close") -> Indicator:
    n, name, x = at_least(length, 1), f"RSI_{int(length)}", source_sql(column)
    change, qg, ql = (f"_{name}_{p}" for p in ("change", "qg", "ql"))
    return Indicator(
        (name,),
        (
            Phase(
                (lambda b: {change: F.expr(x) - b.lag(F.expr(x))},),
                lambda: {
                    qg: smooth(f"greatest({change}, 0D * {change})", n, 1.0 / n, row_rank(1)),
                    ql: smooth(f"greatest(-{change}, 0D * {change})", n, 1.0 / n, row_rank(1)),
                },
            ),
            Phase((lambda b: {name: from_rank(n, f"try_divide(100 * {qg}, {qg} + {ql})", row_rank(1))},)),
        ),
        pre=1,
    )


def true_range(b: Blocks) -> Column:
    """Range of the bar including the gap to the previous close; the first bar has no gap."""
    before = b.lag("close")
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def atr(length: int = 14) -> Indicator:
    n, name = at_least(length, 1), f"ATRr_{int(length)}"
    tr, y = f"_{name}_tr", f"_{name}_y"
    return Indicator(
        (name,),
        (
            Phase((lambda b: {tr: true_range(b)},), lambda: {y: smooth(tr, n, 1.0 / n, row_rank())}),
            Phase((lambda b: {name: from_rank(n, y, row_rank())},)),
        ),
        pre=1,
    )


def adx(length: int = 14) -> Indicator:
    """Wilder's directional movement: ADX, DI+ and DI-."""
    n = at_least(length, 1)
    out, plus, minus = f"ADX_{n}", f"DMP_{n}", f"DMN_{n}"
    tr, up, down, first, qt, qu, qd, dx, y = (
        f"_{out}_{p}" for p in ("tr", "up", "down", "first", "qt", "qu", "qd", "dx", "y")
    )

    def moves(b: Blocks) -> dict[str, Column]:
        rise, fall = F.col("high") - b.lag("high"), b.lag("low") - F.col("low")
        zero = F.when(rise.isNotNull() & fall.isNotNull(), 0.0)
        return {
            tr: F.when(rise.isNotNull(), true_range(b)),
            up: F.when((rise > fall) & (rise > 0), rise).otherwise(zero),
            down: F.when((fall > rise) & (fall > 0), fall).otherwise(zero),
        }

    # DX is null only until the first directional move, whose row is carried along.
    rank = f"(i + 1 - greatest({n}, {first}))"
    share = f"try_divide(100 * abs({plus} - {minus}), {plus} + {minus})"
    return Indicator(
        (out, plus, minus),
        (
            Phase(
                (moves,),
                lambda: {
                    first: Recurrence(f"CASE WHEN {up} + {down} > 0 THEN i END", keep="least"),
                    **{q: smooth(x, n, 1.0 / n, row_rank(1)) for q, x in ((qt, tr), (qu, up), (qd, down))},
                },
            ),
            Phase(
                (
                    lambda b: {
                        plus: from_rank(n, f"try_divide(100 * {qu}, {qt})", row_rank(1)),
                        minus: from_rank(n, f"try_divide(100 * {qd}, {qt})", row_rank(1)),
                    },
                    lambda b: {dx: F.expr(share)},
                ),
                lambda: {y: smooth(dx, n, 1.0 / n, rank, gaps=True)},
            ),
            Phase((lambda b: {out: from_rank(n, f"CASE WHEN {dx} IS NOT NULL THEN {y} END", rank)},)),
        ),
        pre=1,
    )


def _chain(name: str, n: int, depth: int, x: str) -> tuple[list[str], Phase]:
    """EMA(n) of EMA(n) of ... x in one scan; level k is valid from row ``k*(n-1)`` on."""
    alpha, levels = ema_alpha(n), [f"_{name}_e{k}" for k in range(1, depth + 1)]

    def running() -> dict[str, Recurrence]:
        out = {levels[0]: smooth(x, n, alpha, row_rank())}
        for k in range(1, depth):
            out[levels[k]] = smooth_of({levels[k - 1]: 1.0}, n, alpha, row_rank(k * (n - 1)))
        return out

    return levels, Phase((), running)


def _combined(name: str, n: int, depth: int, column: str, formula: str) -> Indicator:
    """Combine chained EMAs; ``formula`` names them e1, e2, ..."""
    levels, chained = _chain(name, n, depth, source_sql(column))
    for k, level in enumerate(levels, 1):
        formula = formula.replace(f"e{k}", level)
    last = Phase((lambda b: {name: from_rank(1, formula, row_rank(depth * (n - 1)))},))
    return Indicator((name,), (chained, last))


def dema(length: int = 10, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _combined(f"DEMA_{n}", n, 2, column, "2 * e1 - e2")


def tema(length: int = 10, column: str = "close") -> Indicator:
    n = at_least(length, 1)
    return _combined(f"TEMA_{n}", n, 3, column, "3 * e1 - 3 * e2 + e3")


def zema(length: int = 10, column: str = "close") -> Indicator:
    """Zero-lag EMA: the EMA plus its distance from its own EMA."""
    n = at_least(length, 1)
    return _combined(f"ZEMA_{n}", n, 2, column, "e1 + (e1 - e2)")


def trix(length: int = 15, signal: int = 9, column: str = "close") -> Indicator:
    n, g = at_least(length, 1), at_least(signal, 1)
    name, line_signal = f"TRIX_{n}_{g}", f"TRIXs_{n}_{g}"
    levels, chained = _chain(name, n, 3, source_sql(column))
    smooth3 = f"_{name}_smooth"

    def line(b: Blocks) -> dict[str, Column]:
        before = b.lag(smooth3)
        return {name: F.try_divide(100 * (F.col(smooth3) - before), before)}

    last = Phase(
        (
            lambda b: {smooth3: from_rank(1, levels[2], row_rank(3 * (n - 1)))},
            line,
            lambda b: {line_signal: b.full(F.avg(name), name, g)},
        )
    )
    return Indicator((name, line_signal), (chained, last), post=g + 1)


def vidya(length: int = 14, column: str = "close") -> Indicator:
    """EMA whose factor is scaled by |CMO|; starts at the price of the first full CMO window."""
    n = at_least(length, 1)
    while n > 80:
        n = int(n * 0.33)
    name, price, alpha = f"VIDYA_{n}", source_sql(column), ema_alpha(n)
    x = F.expr(price)
    change, k, y = f"_{name}_change", f"_{name}_k", f"_{name}_y"

    def momentum(b: Blocks) -> dict[str, Column]:
        net, way = b.full(F.sum(change), change, n), b.full(F.sum(F.abs(F.col(change))), change, n)
        # A window without moves has no momentum and leaves the value as it is.
        return {k: F.coalesce(F.abs(F.try_divide(net, way)), F.lit(0.0))}

    return Indicator(
        (name,),
        (
            Phase(
                (lambda b: {change: x - b.lag(x)}, momentum),
                lambda: {
                    y: Recurrence(
                        a=f"CASE WHEN i > {n} THEN 1 - {alpha!r}D * {k} END",
                        b=f"CASE WHEN i > {n} THEN {alpha!r}D * {k} * {price} WHEN i = {n} THEN {price} END",
                        least=1.0 - alpha,
                    )
                },
            ),
            Phase((lambda b: {name: from_rank(n, y, "i")},)),
        ),
        pre=n + 1,
    )


def kama(length: int = 10, fast: int = 2, slow: int = 30, column: str = "close") -> Indicator:
    """Kaufman's adaptive average, seeded with the mean of the first n prices."""
    n, fast, slow = at_least(length, 1), at_least(fast, 1, "fast"), at_least(slow, 1, "slow")
    name, price, quick, lazy = f"KAMA_{n}_{fast}_{slow}", source_sql(column), ema_alpha(fast), ema_alpha(slow)
    x = F.expr(price)
    step, rate, y = f"_{name}_step", f"_{name}_rate", f"_{name}_y"

    def factor(b: Blocks) -> dict[str, Column]:
        way = b.full(F.sum(step), step, n)
        share = F.coalesce(F.try_divide(F.abs(x - b.lag(x, n)), way), F.lit(0.0))
        return {rate: F.pow(share * (quick - lazy) + lazy, F.lit(2.0))}

    return Indicator(
        (name,),
        (
            Phase(
                (lambda b: {step: F.abs(x - b.lag(x))}, factor),
                lambda: {
                    y: Recurrence(
                        a=f"CASE WHEN i >= {n} THEN 1 - {rate} END",
                        b=f"CASE WHEN i >= {n} THEN {rate} * {price} ELSE {price} / {n} END",
                        least=1.0 - max(quick, lazy) ** 2,
                    )
                },
            ),
            Phase((lambda b: {name: from_rank(n, y, row_rank())},)),
        ),
        pre=n + 1,
    )


def hwma(na: float = 0.2, nb: float = 0.1, nc: float = 0.1, column: str = "close") -> Indicator:
    """Holt-Winters average: level, trend and acceleration as one vector; starts at the first price, without trend."""
    name, x = f"HWMA_{na}_{nb}_{nc}", source_sql(column)
    level, trend, bend = (f"_{name}_{p}" for p in ("level", "trend", "bend"))
    running = {
        level: Recurrence(
            f"CASE WHEN i > 0 THEN {na!r}D * {x} ELSE {x} END", a=f"{1 - na!r}D", prev={trend: f"{1 - na!r}D", bend: f"{(1 - na) / 2!r}D"}
        ),
        trend: Recurrence(
            a=f"{1 - nb!r}D", of={level: f"CASE WHEN i > 0 THEN {nb!r}D ELSE 0D END"}, prev={level: f"{-nb!r}D", bend: f"{1 - nb!r}D"}
        ),
        bend: Recurrence(a=f"{1 - nc!r}D", of={trend: f"{nc!r}D"}, prev={trend: f"{-nc!r}D"}),
    }
    return Indicator((name,), (Phase((), lambda: running), Phase((lambda b: {name: F.expr(f"`{level}` + `{trend}` + `{bend}` / 2")},))))


def ssf(length: int = 10, column: str = "close") -> Indicator:
    """Two-pole super smoother, a vector of its last two values; the first two are the prices."""
    n, x = at_least(length, 1), source_sql(column)
    a = math.exp(-math.sqrt(2) * math.pi / n)
    b = 2 * a * math.cos(math.sqrt(2) * math.pi / n)
    name = f"SSF_{n}"
    y, before = f"_{name}_y", f"_{name}_before"
    running = {
        y: Recurrence(
            f"CASE WHEN i > 1 THEN {1 - b + a * a!r}D * {x} ELSE {x} END",
            a=f"CASE WHEN i > 1 THEN {b!r}D ELSE 0D END",
            prev={before: f"CASE WHEN i > 1 THEN {-a * a!r}D ELSE 0D END"},
        ),
        before: Recurrence(a="0D", prev={y: "1D"}),
    }
    return Indicator((name,), (Phase((), lambda: running), Phase((lambda b: {name: F.col(y)},))))


def obv() -> Indicator:
    """Running volume, signed by the change of the close."""
    flow, y = "_OBV_flow", "_OBV_y"
    return Indicator(
        ("OBV",),
        (
            Phase(
                (
                    lambda b: {
                        flow: F.when(F.col("i") == 0, F.col("volume")).otherwise(
                            F.signum(F.col("close") - b.lag("close")) * F.col("volume")
                        )
                    },
                ),
                lambda: {y: Recurrence(flow)},
            ),
            Phase((lambda b: {"OBV": F.col(y)},)),
        ),
        pre=1,
    )
