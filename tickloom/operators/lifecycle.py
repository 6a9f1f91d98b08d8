"""Keeping tables in order: resume, backfill, merge, dedupe, archive and purge."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.prepare import before_midnight
from tickloom.operators.series import SERIES, bar_width_ms

TRADE_KEY = ("symbol", "agg_trade_id")


def newest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """One row per key, the last by ``newest``.

    Written as an aggregate instead of ``row_number``: copies of one key are reduced in the map
    tasks, so a key repeated over a large share of the rows does not pile up in one task.
    """
    rank = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{n}") for n, c in enumerate(newest)])
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), rank).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def append_and_dedupe(
    existing: DataFrame, new: DataFrame, keys: Sequence[str] = TRADE_KEY, order: Sequence[str] = ()
) -> DataFrame:
    """Union of both sides with one row per key: the new side wins, then the largest of ``order``.

    A null in a key identifies nothing: such rows are merged only where they agree in every column, so
    rows without an id stay apart and a repeated delivery still changes nothing.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    merged = newest_per_key(both.where(known), keys, ["_new", *order]).drop("_new")
    return merged.unionByName(both.where(~known).drop("_new").distinct())


def replace_keys(stored: DataFrame, new: DataFrame, keys: Sequence[str] = TRADE_KEY, order: Sequence[str] = ()) -> DataFrame:
    """Stored rows whose keys ``new`` does not have, and one new row per key: the last by ``order``.

    ``stored`` must hold each key once, as every table does that only this has written. Its rows
    then need no grouping: an anti join with the new keys filters them, and only the new side is
    aggregated. Rows with a null key are taken out of ``stored`` only where a new one agrees in every column.
    """
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    fresh = new.where(~unknown)
    fresh = newest_per_key(fresh, keys, [*order] or [F.lit(0)])
    kept = stored.where(~unknown).join(new.where(~unknown).select(*keys).distinct(), list(keys), "left_anti")
    merged = kept.unionByName(fresh, allowMissingColumns=True)
    loose = stored.where(unknown).unionByName(new.where(unknown), allowMissingColumns=True)
    once = loose.groupBy(*loose.columns).agg(F.count("*").alias("_times")).drop("_times")  # distinct() takes no maps
    return merged.unionByName(once)


def merge_day_into_month(month: DataFrame, day: DataFrame, keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    return append_and_dedupe(month, day, keys)


def canonical_json(doc: str | Column) -> Column:
    """JSON text with sorted keys at every level and without blanks outside of values; other text as it is."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.to_json(F.try_parse_json(doc)), doc)  # a variant keeps its fields in the order of their names


def absent_documents(existing: DataFrame, new: DataFrame, keys: Sequence[str] = ("task", "day"), doc: str = "doc") -> DataFrame:
    """New documents not stored yet for their task and day; equal new documents come once.

    Compared by a 256-bit hash of the canonical text, so only hashes are shuffled for the old side.
    """
    hashed = new.withColumn("_hash", F.sha2(canonical_json(doc), 256))
    once = hashed.dropDuplicates([*keys, "_hash"])
    known = existing.select(*keys, F.sha2(canonical_json(doc), 256).alias("_hash")).distinct()
    return once.join(known, [*keys, "_hash"], "left_anti").drop("_hash")


def pending(requested: DataFrame, completed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested work without a completion record."""
    return requested.join(completed.select(*keys).distinct(), list(keys), "left_anti")


def existing_keys(wanted: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(table.select(*keys).distinct(), list(keys), "left_semi")


def is_present(df: DataFrame) -> bool:
    """True if there is any row."""
    return not df.isEmpty()


def check_dates(start: str, end: str, today: date | None = None) -> tuple[date, date]:
    """Parse two ``YYYY-MM-DD`` dates; the start must not be after the end or in the future."""
    out = []
    for text in (start, end):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
            raise ValueError(f"date {text!r} is not YYYY-MM-DD")
        out.append(datetime.strptime(text, "%Y-%m-%d").date())
    if out[0] > out[1]:
        raise ValueError("start date is after the end date")
    if today is not None and out[0] > today:
        raise ValueError("start date is in the future")
    return out[0], out[1]


def requested_days(symbols: DataFrame, start: str, end: str) -> DataFrame:
    """Every ``(symbol, date)`` of the days ``start..end``, both included, on the real calendar."""
    check_dates(start, end)
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return symbols.select("symbol", F.explode(days).alias("date"))


def backfill_plan(symbols: DataFrame, existing: DataFrame, start: Column, as_of: Column) -> DataFrame:
    """Files to fetch: closed months as a whole, the current month by day up to the day before.

    ``existing`` holds ``(symbol, period)`` of months that are complete; those are skipped. The
    current month is always planned again.
    """
    months = F.sequence(F.trunc(start, "month"), F.trunc(as_of, "month"), F.expr("interval 1 month"))
    planned = symbols.select("symbol", F.explode(months).alias("month"))
    current = F.col("month") == F.trunc(as_of, "month")
    closed = planned.where(~current).select(
        "symbol", F.lit("month").alias("kind"), F.date_format("month", "yyyy-MM").alias("period")
    )
    days = F.filter(
        F.sequence(F.col("month"), F.greatest(F.date_sub(as_of, 1), F.col("month"))), lambda d: d < as_of
    )
    daily = planned.where(current).select("symbol", F.explode(days).alias("day"))
    daily = daily.select("symbol", F.lit("day").alias("kind"), F.date_format("day", "yyyy-MM-dd").alias("period"))
    return pending(closed, existing, ["symbol", "period"]).select("symbol", "kind", "period").unionByName(daily)


def daily_fallback(monthly: DataFrame, daily: DataFrame, keys: Sequence[str] = ("symbol", "month")) -> DataFrame:
    """Monthly rows, and daily rows of those months that have no monthly rows."""
    have = monthly.select(*keys).distinct()
    return monthly.unionByName(daily.join(have, list(keys), "left_anti"), allowMissingColumns=True)


def split_archive(trades: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Rows before midnight UTC of ``as_of`` (to archive) and the others (to keep)."""
    old = before_midnight("transact_time", as_of)
    return trades.where(old), trades.where(~F.coalesce(old, F.lit(False)))


def not_archived(trades: DataFrame, archived: DataFrame, keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    """Rows that are not in the archive: what a purge keeps."""
    return trades.join(archived.select(*keys).distinct(), list(keys), "left_anti")


def coverage(source: DataFrame, target: DataFrame, keys: Sequence[str] = SERIES, look_back: int = 200) -> DataFrame:
    """State of each target series against its source: missing, incomplete or complete.

    ``recompute_from`` is the bar from which an extension has to read, ``look_back`` bars before the
    last one present (null: from the beginning).
    """
    have = target.groupBy(*keys).agg(F.max("time_rounded").alias("target_last"))
    want = source.groupBy(*keys).agg(F.max("time_rounded").alias("source_last"))
    joined = want.join(have, list(keys), "left")
    state = (
        F.when(F.col("target_last").isNull(), "missing")
        .when(F.col("target_last") < F.col("source_last"), "incomplete")
        .otherwise("complete")
    )
    resume_ms = F.unix_millis("target_last") - bar_width_ms() * look_back
    return joined.withColumns(
        {
            "state": state,
            "recompute_from": F.when(state == "incomplete", F.timestamp_millis(resume_ms)),
        }
    )


def key_mismatches(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, and keys repeated in ``actual``; empty when both sides agree one to one."""
    left = expected.select(*keys).join(actual.select(*keys), list(keys), "left_anti").withColumn("problem", F.lit("absent"))
    right = actual.select(*keys).join(expected.select(*keys), list(keys), "left_anti").withColumn("problem", F.lit("extra"))
    twice = actual.groupBy(*keys).count().where("count > 1").select(*keys, F.lit("repeated").alias("problem"))
    return left.unionByName(right).unionByName(twice)
