"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

from tickloom.schema import timeframe_ms


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ms(ms: str | Column, timeframe: str) -> Column:
    """Start of the epoch-aligned bar holding an epoch-ms time (weeks start on Thursday)."""
    ms = col(ms)
    return ms - F.pmod(ms, F.lit(timeframe_ms(timeframe)))


def trade_order(time_ms: str | Column, trade_id: str | Column, timeframe: str, wide_ids: bool = False) -> Column:
    """Key that orders the trades of one bar by (time, id).

    A struct key would force a sort-based aggregate, since its buffer has no fixed width. Inside a
    bar the time offset is below the bar width, so offset and id share one bigint and the bar
    aggregate stays hash-based with map-side combine. Ids that do not fit (2**63 / width: 1.5e10 for
    one week, 1.5e14 for one minute) fail the job; ``wide_ids`` takes any bigint by the struct key.
    """
    time_ms, trade_id = col(time_ms), col(trade_id)
    if wide_ids:
        return F.struct(time_ms, trade_id)
    width = timeframe_ms(timeframe)
    room = (2**63 - 1) // width
    number = F.coalesce(trade_id, F.lit(0))
    checked = F.when(number.between(0, room - 1), number).otherwise(
        F.raise_error(F.lit(f"trade id outside 0..{room - 1}; pass wide_ids=True")).cast("bigint")
    )
    return F.pmod(time_ms, F.lit(width)) * F.lit(room) + checked


def round_to_tick(price: str | Column, symbol: str | Column, decimals: Mapping[str, int]) -> Column:
    """Round half up to the decimals of the symbol; symbols without an entry stay unrounded."""
    price, symbol = col(price), col(symbol)
    by_decimals: dict[int, list[str]] = {}
    for name, places in decimals.items():
        by_decimals.setdefault(places, []).append(name)
    out = price
    for places, names in sorted(by_decimals.items()):
        out = F.when(symbol.isin(sorted(names)), F.round(price, places)).otherwise(out)
    return out


#: Decimals that a tick may have; a negative number rounds to tens, hundreds, ...
DECIMALS = range(-12, 19)


def round_to(price: str | Column, decimals: str | Column) -> Column:
    """Round half up to a per-row number of decimals (Spark's round wants a literal scale).

    Null decimals leave the price unrounded; a number outside ``DECIMALS`` fails the job.
    """
    price, decimals = col(price), col(decimals)
    wrong = F.raise_error(F.concat(F.lit("tick decimals out of range: "), decimals.cast("string"))).cast("double")
    out = F.when(decimals.isNull(), price)
    for places in DECIMALS:
        out = out.when(decimals == places, F.round(price, places))
    return out.otherwise(wrong)


def side_flag(c: str | Column) -> Column:
    """Aggressor flag given as boolean or as 'true'/'false' text, else null."""
    return F.lower(F.trim(col(c).cast("string"))).try_cast("boolean")


def weighted_sum(values: Column, weights: Sequence[float]) -> Column:
    """Dot product of an array column (oldest first) with fixed weights."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(F.zip_with(values, w, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


#: An opening brace or a run of closing ones, and in front of it quoted texts and what else is no brace; possessive, so neither length
#: nor failure costs stack or retries. A quote that is never closed is passed over.
_TOKEN = r'(?:"(?:[^"\\]++|\\.)*+"|[^{}"]++|")*+(?:\{|\}++)?+'
#: Tokens that are folded at a time: a fold copies its state, which grows with them, for each.
_BLOCK = 64
#: What is put behind each object to split them again, and what stands for it (with a or b behind) in texts that hold it.
_END, _ESCAPE = "\x01", "\x02"


def outermost_objects(text: str | Column) -> Column:
    """The JSON objects of a text that lie in no other, in order, whatever their depth and length.

    One pass over the tokens with a running depth of braces: an object begins where the depth leaves 0 and ends
    where it is 0 again. Braces inside quoted values do not count. An object that is never closed, with all
    that follows it, is left out, and so is a closing brace without an open one. A fold over all tokens would copy what it
    has found for each of them, so they are taken in blocks: first how each block changes the depth, then its depth from
    those before, then its text without what lies outside of objects and with a mark behind each.
    """
    safe = F.replace(F.replace(col(text), F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_END), F.lit(_ESCAPE + "a"))
    tokens = F.regexp_extract_all(safe, F.lit(f"({_TOKEN})"), F.lit(1))
    blocks = _bound(tokens, lambda t: F.transform(F.sequence(F.lit(0), F.floor((F.size(t) - 1) / _BLOCK).cast("int")), lambda k: F.slice(t, k * _BLOCK + 1, _BLOCK)))
    joined = _bound(blocks, lambda b: F.array_join(F.zip_with(b, _depths(F.transform(b, _change)), _inside), ""))
    found = F.regexp_extract_all(joined, F.lit(f"([^{_END}]*+){_END}"), F.lit(1))
    return F.transform(found, lambda o: F.replace(F.replace(o, F.lit(_ESCAPE + "a"), F.lit(_END)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once: what a function over an array names would be evaluated for each element."""
    return F.transform(F.array(value), use)[0]


def _closing(token: Column) -> Column:
    return F.length(token) - F.length(F.rtrim(token, F.lit("}")))


def _change(tokens: Column) -> Column:
    """What a block makes of a depth d before it: the greater of d + ``up`` and ``least``."""

    def step(state: Column, token: Column) -> Column:
        shift = F.when(token.endswith("{"), 1).when(token.endswith("}"), -_closing(token)).otherwise(0)
        return F.struct((state["up"] + shift).alias("up"), F.greatest(state["least"] + shift, F.lit(0)).alias("least"))

    return F.aggregate(tokens, F.struct(F.lit(0).alias("up"), F.lit(0).alias("least")), step)


def _depths(changes: Column) -> Column:
    """The depth before each block: changes of up to 8 blocks, 1, 8, 64, ... apart, are put together. Before the first it is 0."""
    for k in range(9):
        changes = _bound(changes, lambda c: _put_together(c, 8**k))
    return _bound(changes, lambda c: F.transform(c, lambda _, i: F.coalesce(F.greatest(F.get(c, i - 1)["up"], F.get(c, i - 1)["least"]), F.lit(0))))


def _put_together(changes: Column, apart: int) -> Column:
    def both(change: Column, i: Column) -> Column:
        up, least = change["up"], change["least"]
        for j in range(1, 8):
            before = F.get(changes, i - j * apart)
            least, up = F.greatest(least, F.coalesce(before["least"], F.lit(0)) + up), up + F.coalesce(before["up"], F.lit(0))
        return F.struct(up.alias("up"), least.alias("least"))

    return F.when(F.size(changes) > apart, F.transform(changes, both)).otherwise(changes)


def _inside(tokens: Column, depth: Column) -> Column:
    """The text of a block that lies in objects, from the depth before it; an opening or closing brace with what precedes it is a token."""

    def step(state: Column, token: Column) -> Column:
        depth, opens, closes = state["depth"], token.endswith("{"), token.endswith("}") & (state["depth"] > 0)
        done = closes & (_closing(token) >= depth)
        more = F.when(depth == 0, F.when(opens, "{").otherwise("")).when(done, F.concat(F.rtrim(token, F.lit("}")), F.repeat(F.lit("}"), depth), F.lit(_END)))
        return F.struct(
            F.when(opens, depth + 1).when(done, 0).when(closes, depth - _closing(token)).otherwise(depth).alias("depth"),
            F.concat(state["text"], more.otherwise(token)).alias("text"),
        )

    return F.aggregate(tokens, F.struct(depth.alias("depth"), F.lit("").alias("text")), step, lambda state: state["text"])


def concatenated_json_array(text: str | Column, schema: T.StructType) -> Column:
    """Parse ``{..}{..}`` or ``{..},{..}`` text into an array of structs, one for each outermost object.

    Text without objects gives an empty array.
    """
    objects = F.coalesce(outermost_objects(text), F.array().cast("array<string>"))
    return F.transform(objects, lambda o: F.from_json(o, schema))


def exact_sum(c: str | Column) -> Column:
    """Sum of quantities that does not depend on the order of the rows or on their partitions.

    Quantities count in units of 1e-8, as exchanges do: whole numbers and the units behind them are added apart
    as bigints, which a hash aggregate does in place, and put together as the nearest double. A quantity or a
    sum of 9.2e18 or more, and what is not a number, fail the job; decimals behind the eighth are rounded.
    """
    whole = col(c).cast("bigint")
    units = F.rint((col(c) - whole) * F.lit(1e8)).cast("bigint")
    return (F.sum(whole).cast("decimal(28,8)") + F.sum(units).cast("decimal(28,8)") / F.lit(100_000_000)).cast("double")
