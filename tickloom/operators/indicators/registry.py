"""Compute a configured list of indicators over many series at once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.indicators import recurrent, stateful, windowed
from tickloom.operators.indicators.spec import Indicator, Phase, ref
from tickloom.operators.indicators.stateful import Stateful, add_stateful
from tickloom.operators.series import BLOCK, SERIES, in_blocks, index_bars


def _bollinger(length: int = 20, nbdevup: float = 2, nbdevdn: float | None = None, std: float | None = None, **_: Any) -> Indicator:
    width = nbdevup if std is None else std
    if std is None and nbdevdn not in (None, nbdevup):
        raise ValueError("bands of different width are not supported")
    return windowed.bbands(length, width)


Cut = Callable[[DataFrame], DataFrame]

BUILDERS: dict[str, Callable[..., Indicator | Stateful]] = {
    "sma": windowed.sma,
    "wma": windowed.wma,
    "stoch": windowed.stoch,
    "cci": windowed.cci,
    "roc": windowed.roc,
    "bollinger_bands": _bollinger,
    "bbands": _bollinger,
    "mfi": windowed.mfi,
    "willr": windowed.willr,
    "vwma": windowed.vwma,
    "vwap": windowed.vwap,
    "sinwma": windowed.sinwma,
    "alma": windowed.alma,
    "hma": windowed.hma,
    "linreg": windowed.linreg,
    "swma": windowed.swma,
    "trima": windowed.trima,
    "fwma": windowed.fwma,
    "hilo": windowed.hilo,
    "ema": recurrent.ema,
    "rma": recurrent.rma,
    "macd": recurrent.macd,
    "rsi": recurrent.rsi,
    "rsi_14": recurrent.rsi,
    "rsi_21": recurrent.rsi,
    "atr": recurrent.atr,
    "adx": recurrent.adx,
    "trix": recurrent.trix,
    "dema": recurrent.dema,
    "tema": recurrent.tema,
    "zema": recurrent.zema,
    "vidya": recurrent.vidya,
    "kama": recurrent.kama,
    "obv": recurrent.obv,
    "hwma": recurrent.hwma,
    "ssf": recurrent.ssf,
    "sar": stateful.psar,
    "psar": stateful.psar,
    "mcgd": stateful.mcgd,
    "mama": stateful.mama,
    "fama": stateful.mama,
}

# The indicator list the service runs, with its parameters.
CATALOGUE: list[dict[str, Any]] = [
    {"name": "ema", "params": {"length": 20}},
    {"name": "macd", "params": {}},
    {"name": "rsi_14", "params": {"length": 14}},
    {"name": "rsi_21", "params": {"length": 21}},
    {"name": "sma", "params": {"length": 50}},
    {"name": "wma", "params": {"length": 30}},
    {"name": "stoch", "params": {"fastk_period": 14, "slowk_period": 3, "slowd_period": 3}},
    {"name": "adx", "params": {"length": 14}},
    {"name": "atr", "params": {"length": 14}},
    {"name": "cci", "params": {"length": 20}},
    {"name": "roc", "params": {"length": 12}},
    {"name": "bollinger_bands", "params": {"length": 20, "nbdevup": 2, "nbdevdn": 2}},
    {"name": "mfi", "params": {"length": 14}},
    {"name": "trix", "params": {"length": 15}},
    {"name": "obv", "params": {}},
    {"name": "sar", "params": {"acceleration": 0.02, "maximum": 0.2}},
    {"name": "willr", "params": {"length": 14}},
]


def build(name: str, params: Mapping[str, Any] | None = None) -> Indicator | Stateful:
    if name not in BUILDERS:
        raise ValueError(f"unknown indicator {name!r}")
    return BUILDERS[name](**(params or {}))


def build_all(config: Sequence[Mapping[str, Any]]) -> tuple[list[Indicator | Stateful], dict[str, str]]:
    """Build the configured indicators; a failing one is reported by name and left out."""
    built, failed = [], {}
    for entry in config:
        try:
            built.append(build(entry["name"], entry.get("params")))
        except (TypeError, ValueError) as error:
            failed[entry["name"]] = str(error)
    return built, failed


def check_unique(columns: Sequence[str]) -> None:
    """Reject output columns that occur twice."""
    twice = sorted(name for name, n in Counter(columns).items() if n > 1)
    if twice:
        raise ValueError(f"duplicate column names: {twice}")


def in_passes(indicators: Sequence[Indicator | Stateful]) -> tuple[list[list[Indicator]], list[Stateful]]:
    """Block-wise indicators by the scans they share, and the sequential ones.

    A second scan repeats the look-back windows of the first, so chained scans get a pass without the others.
    """
    plain = [x for x in indicators if isinstance(x, Indicator)]
    chained = [x for x in plain if sum(p.running is not None for p in x.phases) > 1]
    single = [x for x in plain if x not in chained]
    return [x for x in (single, chained) if x], [x for x in indicators if isinstance(x, Stateful)]


def _one_pass(
    indexed: DataFrame, indicators: Sequence[Indicator], keys: Sequence[str], size: int, origin: str, carried: DataFrame | None, cut: Cut | None
) -> tuple[DataFrame, DataFrame | None]:
    """Add block-wise indicators: equal phases run in the same projections and the same scan.

    With ``cut`` also (keys, carries): the running values that a later run of these indicators starts from.
    """
    pre, post = max(x.pre for x in indicators), max(x.post for x in indicators)
    blocks = in_blocks(indexed, pre, post, keys, size, origin=origin, carried=carried)
    names: list[str] = []
    for step in range(max(len(x.phases) for x in indicators)):
        phases = [x.phases[step] if step < len(x.phases) else Phase() for x in indicators]
        for layer in range(max(len(p.layers) for p in phases)):
            blocks = blocks.with_columns(
                {n: c for p in phases if layer < len(p.layers) for n, c in p.layers[layer](blocks).items()}
            )
        running = {n: r for p in phases if p.running for n, r in p.running().items()}
        blocks, names = blocks.scan(running), [*names, *running]
    done = [*indexed.columns, *[name for x in indicators for name in x.outputs]]
    if cut is None:
        return blocks.rows().select(*[ref(c) for c in done]), None
    # The next run's first block starts ``post`` rows before its first new bar.
    before_next = F.col("i") == F.col("n_bars") - (post + 1)
    wide = cut(blocks.df.withColumn("_own", blocks.own()).where(F.col("_own") | before_next))
    pairs = [F.struct(F.lit(n), ref(n).cast("double")) for n in names]
    held = F.map_from_entries(F.array(*pairs)) if names else F.create_map().cast("map<string,double>")
    carries = wide.where(before_next).groupBy(*keys).agg(F.first(held).alias("carries"))
    return wide.where("_own").select(*[ref(c) for c in done]), carries


def compute(
    indexed: DataFrame,
    indicators: Sequence[Indicator | Stateful],
    keys: Sequence[str] = SERIES,
    size: int = BLOCK,
    origin: str = "0",
    carried: DataFrame | None = None,
    folds: tuple[str, str] | None = None,
    cut: Cut | None = None,
) -> tuple[DataFrame, list[DataFrame]]:
    """Outputs of all indicators for the indexed bars from row ``origin`` on, and with ``cut`` the carries of each pass.

    ``carried`` holds stored carries, ``folds`` the columns of stored and of new states of the sequential
    indicators. ``cut`` is applied to what both results are made from (a staged table, say).
    """
    passes, sequential = in_passes(indicators)
    result, carries = indexed.where(f"i >= {origin}") if origin != "0" else indexed, []
    fresh = result
    for k, some in enumerate(passes):
        frame, held = _one_pass(indexed, some, keys, size, origin, carried, cut)
        result = frame if k == 0 else result.join(frame.select(*keys, "i", *[ref(n) for x in some for n in x.outputs]), [*keys, "i"])
        carries += [] if held is None else [held]
    stored, left = folds or (None, None)
    if sequential and passes:
        # Only what they read and give goes through Python, not the outputs of the others.
        folded = add_stateful(fresh, sequential, keys, stored, left)
        given = [*[n for x in sequential for n in x.outputs], *([left] if left else [])]
        result = result.join(folded.select(*keys, "i", *[ref(n) for n in given]), [*keys, "i"])
    else:
        result = add_stateful(result, sequential, keys, stored, left)
    return result, carries


def add_indicators(
    bars: DataFrame,
    indicators: Sequence[Indicator | Stateful],
    keys: Sequence[str] = SERIES,
    size: int = BLOCK,
) -> DataFrame:
    """Bars with the outputs of all indicators, for every series in the frame.

    Works on bars with ``open, high, low, close`` and ``volume`` (or ``qty``). The block-wise
    indicators share their passes. Bars should be a table: a scan reads its input twice, for the
    borders and for the rows. Bars without a price have no indicators and do not count as rows of a
    look-back.
    """
    bars = with_volume(bars)
    outputs = [name for x in indicators for name in x.outputs]
    check_unique([*bars.columns, *outputs])
    indexed = bars if "n_bars" in bars.columns else index_bars(bars.where(PRICED), keys)
    table, _ = compute(indexed, indicators, keys, size)
    out = table.select(*[ref(c) for c in bars.columns if c != "n_bars"], *[ref(c) for c in outputs])
    if "n_bars" in bars.columns:
        return out
    return out.unionByName(bars.where(f"NOT ({PRICED})"), allowMissingColumns=True)


PRICED = "open IS NOT NULL AND close IS NOT NULL"


def with_volume(bars: DataFrame) -> DataFrame:
    return bars.withColumnRenamed("qty", "volume") if "volume" not in bars.columns else bars


def indicator_table(
    bars: DataFrame,
    config: Sequence[Mapping[str, Any]] = CATALOGUE,
    keys: Sequence[str] = SERIES,
    size: int = BLOCK,
) -> tuple[DataFrame, dict[str, str]]:
    """Run a configured list over all series; returns the table and the failures by name."""
    built, failed = build_all(config)
    return add_indicators(bars, built, keys, size), failed


