"""Ordered series in bounded blocks: bar index, rolling windows, running recurrences.

A window over a whole series would put all its rows into one task. Here a series is cut into blocks
of a fixed number of rows, each with the few preceding rows its look-back needs (the halo), and
everything runs per ``(series, block)``. What crosses a block border is one row per block and
series. That table is calendar-bounded: a year of one-minute bars, the finest timeframe, is 525 600
rows and so at most 1 027 blocks of 512.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.schema import TIMEFRAMES

SERIES = ("symbol", "timeframe")
BLOCK = 512
#: From this factor on a running product over a block stays a normal double.
LEAST_FACTOR = 1 / 3
INDEX_BUCKET = 4096


def bar_width_ms(timeframe: str | Column = "timeframe") -> Column:
    """Bar width in ms looked up from a timeframe column; an unknown timeframe fails the job."""
    name = F.col(timeframe) if isinstance(timeframe, str) else timeframe
    out = F.raise_error(F.concat(F.lit("unsupported timeframe "), F.coalesce(name, F.lit("null")))).cast("bigint")
    for known, seconds in TIMEFRAMES.items():
        out = F.when(name == known, F.lit(seconds * 1000)).otherwise(out)
    return out


def index_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: Column, name: str = "i", count: str | None = None
) -> DataFrame:
    """Number rows 0.. per key in ``order`` without a window over the whole key.

    ``bucket`` must not decrease along ``order``. Rows are numbered per ``(key, bucket)`` and shifted
    by the number of rows in earlier buckets. Those numbers come from a count of their own, combined
    map-side over the key columns alone: one row per bucket. ``count`` also adds the rows per key. Rows
    with a null key or bucket keep a null number.
    """
    keys = list(keys)
    cut = df.withColumn("_bucket", bucket)
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    sizes = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    cut = cut.withColumn("_rank", F.row_number().over(within).cast("bigint"))
    per_key = Window.partitionBy(*keys)
    offsets = sizes.select(
        *keys,
        "_bucket",
        F.coalesce(
            F.sum("_size").over(per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_size").over(per_key).alias("_total"),
    )
    out = cut.join(offsets, [*keys, "_bucket"], "left").withColumn(name, F.col("_before") + F.col("_rank") - 1)
    if count:
        out = out.withColumn(count, F.col("_total"))
    return out.drop("_bucket", "_rank", "_before", "_total")


def index_bars(bars: DataFrame, keys: Sequence[str] = SERIES, time: str = "time_rounded") -> DataFrame:
    """Add the bar index ``i`` and the series length ``n_bars``.

    A bucket spans 4096 bar widths and bar times are multiples of the width, so it holds at most
    4096 bars.
    """
    bucket = F.floor(F.unix_millis(F.col(time)) / (bar_width_ms() * INDEX_BUCKET))
    return index_in_order(bars, keys, [time], bucket, "i", "n_bars")


@dataclass(frozen=True)
class Recurrence:
    """One running value ``y = a*y_prev + b + sum(w*other) + sum(u*other_prev)``, all SQL expressions over the row.

    ``a`` None means 1; a null ``a`` or ``b`` leaves the value as it is. ``of`` holds the weights of
    other running values of the same scan, so chained smoothings need one scan; ``prev`` those of the
    others' values on the row before, so that a value may be a vector. ``least`` is what ``a`` never falls
    below. ``keep`` replaces the sum: ``"last"`` carries the last non-null ``b`` forward, ``"least"`` the smallest.
    """

    b: str | None = None
    a: str | None = None
    of: Mapping[str, str] = field(default_factory=dict)
    keep: str | None = None
    prev: Mapping[str, str] = field(default_factory=dict)
    least: float = 1.0

    @property
    def composed(self) -> bool:
        """Whether a running product of ``a`` over a block cannot serve."""
        return bool(self.prev) or self.least < LEAST_FACTOR


def linked(running: Mapping[str, Recurrence]) -> list[list[str]]:
    """Running values that refer to each other, directly or by way of others, in the order given."""
    home = {n: n for n in running}

    def root(n: str) -> str:
        while home[n] != n:
            n = home[n]
        return n

    for n, r in running.items():
        for other in (*r.of, *r.prev):
            if other not in running:
                raise ValueError(f"running value {n!r} refers to an unknown one: {other!r}")
            home[root(other)] = root(n)
    sets: dict[str, list[str]] = {}
    for n in running:
        sets.setdefault(root(n), []).append(n)
    return list(sets.values())


@dataclass(frozen=True)
class Blocks:
    """An indexed series cut into blocks of ``size`` rows with ``pre + post`` rows of halo.

    Values with a look-back of up to ``pre`` rows are right from ``post`` rows before the block on;
    running values start there, and a further look-back of ``post`` rows is right on the block's own
    rows. Blocks are counted from row ``origin`` of each series, an SQL expression; running values that
    were ``carried`` up to the start of block 0 come as rows of (keys, carries: map of name to value).
    """

    df: DataFrame
    keys: tuple[str, ...]
    pre: int
    post: int
    size: int
    origin: str = "0"
    carried: DataFrame | None = None

    @property
    def start(self) -> str:
        """First row of a block on which running values are right."""
        return f"({self.origin} + _block * {self.size} - {self.post})"

    def _ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_block").orderBy("i")

    def last(self, n: int) -> WindowSpec:
        """Window of the newest ``n`` rows."""
        return self._ordered().rowsBetween(1 - n, 0)

    def lag(self, c: str | Column, n: int = 1) -> Column:
        return F.lag(c, n).over(self._ordered())

    def full(self, value: Column, c: str | Column, n: int) -> Column:
        """``value`` aggregated over the newest ``n`` rows, null until ``c`` has n non-null rows."""
        return F.when(F.count(c).over(self.last(n)) == n, value.over(self.last(n)))

    def with_columns(self, columns: Mapping[str, Column]) -> Blocks:
        return replace(self, df=self.df.withColumns(dict(columns))) if columns else self

    def scan(self, running: Mapping[str, Recurrence]) -> Blocks:
        """Add running values over the whole series.

        Inside a block a value is affine in the values carried into the block. With ``P`` the running
        product of ``a``, ``y = P*carry + P*sum(b/P)``: two window aggregates, and one more per value
        it is chained to. Where that product could leave the normal doubles, or values depend on each
        other's last row, the affine steps of the rows are composed instead (:meth:`_composed`). The carry
        of each block is folded from the block borders.
        """
        if not running:
            return self
        start = self.start
        order = f"PARTITION BY {', '.join(self.keys)}, _block ORDER BY i"
        ahead = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        tag = {name: f"_r{k}" for k, name in enumerate(running)}
        vectors = [names for names in linked(running) if any(running[n].composed for n in names)]
        scalar = {n: r for n, r in running.items() if not any(n in names for names in vectors)}

        # The rows before the start have served the look-back windows. Equal factors share a product.
        factors = {a: f"_p{k}" for k, a in enumerate(dict.fromkeys(r.a for r in scalar.values() if r.a))}
        window = self._ordered().rowsBetween(Window.unboundedPreceding, 0)
        products = {p: F.coalesce(F.product(F.expr(a)).over(window), F.lit(1.0)) for a, p in factors.items()}
        df = self.df.where(f"i >= {start}").withColumns(products)

        # parts[name] maps each carried value (or "0" for the constant part) to its expression.
        parts: dict[str, dict[str, str]] = {}
        while len(parts) < len(scalar):
            level = [n for n, r in scalar.items() if n not in parts and all(o in parts for o in r.of)]
            if not level:
                raise ValueError("running values refer to each other in a circle")
            sums = []
            for name in level:
                r, t = running[name], tag[name]
                if r.keep:
                    kept = f"last({r.b}, true)" if r.keep == "last" else f"min({r.b})"
                    sums.append(f"double({kept} OVER {ahead}) AS {t}_0")
                    parts[name] = {"0": f"{t}_0"}
                    continue
                p = factors[r.a] if r.a else "1D"
                flows: dict[str, list[str]] = {"0": [f"({r.b})"] if r.b else []}
                for other, weight in r.of.items():
                    for carried, part in parts[other].items():
                        flows.setdefault(carried, []).append(f"({weight}) * ({part})")
                parts[name] = {t: p}
                for carried, terms in flows.items():
                    column = f"{t}_of{carried}"
                    term = " + ".join(terms) or "0D"
                    term = f"({term}) / {p}" if r.a else term
                    sums.append(f"coalesce(sum({term}) OVER {ahead}, 0D) AS {column}")
                    parts[name][carried] = f"{p} * {column}" if r.a else column
            df = df.selectExpr("*", *sums)
        if vectors:
            df, composed = self._composed(df, running, vectors, tag)
            parts |= composed

        values = {(n, c): f"{tag[n]}_v{c}" for n, ps in parts.items() for c in ps}
        border = df.where(f"i = {start} + {self.size - 1}").selectExpr(
            *self.keys, "_block", *[f"{parts[n][c]} AS {v}" for (n, c), v in values.items()]
        )
        if self.carried is not None:
            # A border before block 0 that hands on what was stored, whatever came before it.
            stored = [f"carries['{n}'] AS {v}" if c == "0" else f"0D AS {v}" for (n, c), v in values.items()]
            border = border.unionByName(self.carried.selectExpr(*self.keys, "-1L AS _block", *stored))

        def carried_on(name: str, part: Callable[[str], str], carry: Callable[[str], str]) -> str:
            own, keep = tag[name], running[name].keep
            if keep:
                kept = (part("0"), carry(own))
                return f"coalesce({', '.join(kept)})" if keep == "last" else f"least({', '.join(kept)})"
            terms = [f"({part(c)}) * coalesce({carry(c)}, 0D)" for c in parts[name] if c != "0"]
            return " + ".join([part("0"), *terms])

        steps = {
            tag[n]: carried_on(n, lambda c, n=n: f"x.{values[n, c]}", lambda t: f"get(done, size(done) - 1).{t}_c")
            for n in running
        }
        df = df.join(_fold_borders(border, self.keys, list(values.values()), steps), [*self.keys, "_block"], "left")
        kept = [f"`{c}`" for c in self.df.columns if c not in running]
        out = [f"{carried_on(n, parts[n].__getitem__, lambda t: f'{t}_c')} AS `{n}`" for n in running]
        return replace(self, df=df.selectExpr(*kept, *out))

    def _composed(
        self, df: DataFrame, running: Mapping[str, Recurrence], vectors: Sequence[Sequence[str]], tag: Mapping[str, str]
    ) -> tuple[DataFrame, dict[str, dict[str, str]]]:
        """Affine steps ``y = A*y_prev + v`` of whole vectors, composed over the rows of a block up to each row.

        After the pass with shift s a row holds the composition of the 2s steps that end with it, so
        the passes are as many as the doublings of a block. Nothing is divided: a factor of 0 simply
        forgets, and no factor is too small. All passes share the one partitioning and order.
        """
        at = f"(PARTITION BY {', '.join(self.keys)}, _block ORDER BY i)"
        parts: dict[str, dict[str, str]] = {}
        entries: dict[tuple[str, str], str] = {}
        for names in vectors:
            ready: list[str] = []
            while len(ready) < len(names):
                level = [n for n in names if n not in ready and all(o in ready for o in running[n].of)]
                if not level:
                    raise ValueError("running values refer to each other in a circle")
                made = []
                for n in level:
                    r, t = running[n], tag[n]
                    flows: dict[str, list[str]] = {n: [f"coalesce({r.a}, 1D)" if r.a else "1D"]}
                    for other, u in r.prev.items():
                        flows.setdefault(other, []).append(f"({u})")
                    constant = [f"coalesce({r.b}, 0D)"] if r.b else []
                    for other, w in r.of.items():
                        constant.append(f"({w}) * {parts[other]['0']}")
                        for carried in names:
                            if tag[carried] in parts[other]:
                                flows.setdefault(carried, []).append(f"({w}) * {parts[other][tag[carried]]}")
                    parts[n] = {"0": f"{t}_0"}
                    made.append(f"double({' + '.join(constant) or '0D'}) AS {t}_0")
                    for carried, terms in flows.items():
                        column = entries[n, carried] = parts[n][tag[carried]] = f"{t}_of{tag[carried]}"
                        made.append(f"double({' + '.join(terms)}) AS {column}")
                df = df.selectExpr("*", *made)
                ready += level
            reach = True
            while reach:  # entries that come to be by composing
                reach = [(n, c) for n in names for k in names for c in names if (n, k) in entries and (k, c) in entries and (n, c) not in entries]
                for n, c in dict.fromkeys(reach):
                    entries[n, c] = parts[n][tag[c]] = f"{tag[n]}_of{tag[c]}"
                    df = df.withColumn(entries[n, c], F.lit(0.0))
        columns = [c for p in parts.values() for c in p.values()]
        others = [f"`{c}`" for c in df.columns if c not in columns]
        shift = 1
        while shift < self.size + self.post:
            df = df.selectExpr("*", *[f"lag({c}, {shift}) OVER {at} AS {c}_before" for c in columns])
            step = []
            for names in vectors:
                for n in names:
                    for c in ("0", *names):
                        own = parts[n]["0"] if c == "0" else entries.get((n, c))
                        if own is None:
                            continue
                        terms = [own] if c == "0" else []
                        for k in names:
                            before = parts[k]["0"] if c == "0" else entries.get((k, c))
                            if (n, k) in entries and before:
                                terms.append(f"{entries[n, k]} * {before}_before")
                        step.append(f"CASE WHEN i >= {self.start} + {shift} AND i >= {shift} THEN {' + '.join(terms)} ELSE {own} END AS {own}")
            df = df.selectExpr(*others, *step)
            shift *= 2
        return df, parts

    def own(self) -> Column:
        """Whether a row lies in the block itself, not in its halo."""
        return F.expr(f"i >= {self.origin} + _block * {self.size}")

    def rows(self) -> DataFrame:
        """The rows of the series, each once, without the halo."""
        return self.df.where(self.own()).drop("_block")


def _fold_borders(border: DataFrame, keys: Sequence[str], values: Sequence[str], steps: Mapping[str, str]) -> DataFrame:
    """Carry into each block, folded over the border rows ``x`` of all earlier blocks of the series."""
    fields = ", ".join(["_block: bigint", *[f"{t}_c: double" for t in steps]])
    after = ", ".join(["x._block + 1 AS _block", *[f"{step} AS {t}_c" for t, step in steps.items()]])
    fold = (
        f"inline(aggregate(array_sort(collect_list(struct(_block, {', '.join(values)}))), "
        f"cast(array() AS array<struct<{fields}>>), (done, x) -> concat(done, array(struct({after})))))"
    )
    return border.groupBy(*keys).agg(F.expr(fold))


def in_blocks(
    indexed: DataFrame,
    pre: int = 0,
    post: int = 0,
    keys: Sequence[str] = SERIES,
    size: int = BLOCK,
    length: str = "n_bars",
    origin: str = "0",
    carried: DataFrame | None = None,
) -> Blocks:
    """Cut an indexed series into blocks; the halo rows are copied into the blocks that look back on them.

    Rows before ``origin`` serve as halo only; the rows just before it must be there as far as they exist.
    """
    halo = pre + post
    block, after = (F.floor(F.expr(f"(i - {origin} + {k}) / {size}")) for k in (0, halo))
    # A long look-back spans several blocks; their length stays, since running values divide by a product over a block.
    last = F.least(after, F.floor(F.expr(f"({length} - 1 - {origin}) / {size}")))
    homes = F.sequence(F.greatest(block, F.lit(0)), F.greatest(block, last, F.lit(0)))
    placed = indexed.withColumn("_block", F.explode(homes))
    if origin != "0":
        placed = placed.where((F.col("_block") > 0) | F.expr(f"i >= {origin} - {halo}"))
    return Blocks(placed, tuple(keys), pre, post, size, origin, carried)


def running_total(indexed: DataFrame, totals: Mapping[str, str], keys: Sequence[str] = SERIES, size: int = BLOCK) -> DataFrame:
    """Add cumulative sums along each series."""
    return in_blocks(indexed, keys=keys, size=size).scan({k: Recurrence(c) for k, c in totals.items()}).rows()
