"""Shape of an indicator: which columns and running values it needs, in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tickloom.operators.series import Blocks, Recurrence

Layer = Callable[[Blocks], Mapping[str, Column]]


@dataclass(frozen=True)
class Phase:
    """Column layers (a later layer may read an earlier one), then running values."""

    layers: tuple[Layer, ...] = ()
    running: Callable[[], Mapping[str, Recurrence]] | None = None


@dataclass(frozen=True)
class Indicator:
    """``pre``: rows of look-back before the first running value; ``post``: after it."""

    outputs: tuple[str, ...]
    phases: tuple[Phase, ...]
    pre: int = 0
    post: int = 0


# Price sources.
SOURCES = {"hl2": "((high + low) / 2)", "hlc3": "((high + low + close) / 3)"}


def source_sql(column: str) -> str:
    """Price source as SQL: close, open, high, low, hl2 or hlc3."""
    if column in ("close", "open", "high", "low"):
        return column
    if column not in SOURCES:
        raise ValueError(f"unknown price source {column!r}")
    return SOURCES[column]


def source(column: str) -> Column:
    return F.expr(source_sql(column))


def at_least(n: int, least: int, name: str = "length") -> int:
    n = int(n)
    if n < least:
        raise ValueError(f"{name} must be at least {least}, not {n}")
    return n


def ref(name: str) -> Column:
    """Column by exact name (names may hold a dot)."""
    return F.col(f"`{name}`")


def windowed(outputs: tuple[str, ...], pre: int, *layers: Layer) -> Indicator:
    return Indicator(outputs, (Phase(layers),), pre=pre)
