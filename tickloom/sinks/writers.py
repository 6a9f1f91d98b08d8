"""Writers for bars, landed trades, archives and indicator tables."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tickloom.operators.lifecycle import TRADE_KEY, absent_documents, replace_keys, split_archive
from tickloom.operators.prepare import before_midnight, with_minute_parts
from tickloom.sinks import files
from tickloom.sources.readers import FORMATS, MINUTE_PARTS, read_partitioned


@contextmanager
def open_partitions(spark: SparkSession, most: int = 8) -> Iterator[None]:
    """Tasks that write partitions inside keep the files of up to ``most`` of them open, so their rows need no sort.

    The memory of a task is then that of its open files, whatever the rows; those of further partitions are sorted.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_partitions(df: DataFrame, path: str, parts: Sequence[str], order: Sequence[str] = ()) -> None:
    """Overwrite exactly the partitions present in ``df``.

    ``rebalance`` gathers the rows of a partition without forcing a hot one into a single task:
    adaptive execution splits large ones and merges small ones.
    """
    placed = df.hint("rebalance", *[F.col(p) for p in parts])
    if order:
        placed = placed.sortWithinPartitions(*parts, *order)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


BAR_PARTS = ("symbol", "timeframe", "date")


BAR_KEY = ("symbol", "timeframe", "time_rounded")


def write_bars(bars: DataFrame, path: str, whole_days: bool = False) -> None:
    """Replace the bars that ``bars`` has, by symbol, timeframe and start; all others stay, those of the same day too.

    A bar belongs to the day it starts on; only the days of the new bars are read and rewritten. With ``whole_days``
    the input holds all bars of its days, which are then overwritten unread (a bar that is no longer there goes).
    """
    dated = bars.withColumn("date", F.col("time_rounded").cast("date"))
    if whole_days:
        write_partitions(dated, path, BAR_PARTS, ["time_rounded"])
    else:
        upsert_partitions(dated, path, BAR_PARTS, "date", BAR_KEY)


def stored_partitions(new: DataFrame, path: str, parts: Sequence[str], dates: str) -> DataFrame | None:
    """Stored rows of the partitions ``new`` has rows for, with all stored columns; None if there are none.

    Folders down to ``dates`` are named from the new rows (as many as they have symbols and dates), so
    neither the rest of the tree nor its files are listed; the semi join then keeps the touched partitions.
    """
    spark, upto = new.sparkSession, list(parts[: list(parts).index(dates) + 1])
    wanted = [files.partition_folder(spark, path, row.asDict()) for row in new.select(*upto).distinct().collect()]
    there = [folder for folder in wanted if files.exists(spark, folder)]
    if not there:
        return None
    types = dict(new.dtypes)
    stored = read_partitioned(spark, path, parts, there)
    stored = stored.withColumns({p: F.col(p).cast(types[p]) for p in parts})
    return stored.join(new.select(*parts).distinct(), list(parts), "left_semi")


def upsert_partitions(
    new: DataFrame,
    path: str,
    parts: Sequence[str],
    dates: str,
    keys: Sequence[str] = TRADE_KEY,
    order: Sequence[str] = (),
) -> None:
    """Merge rows into their partitions: one row per key, the new row wins; other partitions stay.

    Stored columns that the new rows lack are kept, and null in the new rows; rows with a null key are
    never merged with different ones. The new rows are evaluated once.
    """
    new = new.persist()
    try:
        stored = stored_partitions(new, path, parts, dates)
        merged = replace_keys(new.limit(0) if stored is None else stored, new, keys, order)
        write_partitions(merged, path, parts, [c for c in ("transact_time", "time_rounded") if c in new.columns])
    finally:
        new.unpersist()


def upsert_minutes(trades: DataFrame, path: str, keys: Sequence[str] = TRADE_KEY, parts: Sequence[str] = MINUTE_PARTS) -> None:
    """Merge landed trades into their minute partitions, or with fewer ``parts`` into those of hours or days."""
    cut = [c for c in MINUTE_PARTS if c not in parts]
    upsert_partitions(with_minute_parts(trades).drop(*cut), path, parts, "day", keys)


def append_minutes(trades: DataFrame, path: str) -> None:
    with_minute_parts(trades).write.mode("append").partitionBy(*MINUTE_PARTS).parquet(path)


def merge_day(day: DataFrame, path: str, keys: Sequence[str] = TRADE_KEY) -> None:
    """Merge a day's trades into the month partition of a tape partitioned by ``symbol, month``."""
    month = F.substring(F.timestamp_millis("transact_time").cast("date").cast("string"), 1, 7)
    upsert_partitions(day.withColumn("month", month), path, ["symbol", "month"], "month", keys)


def write_csv_archive(df: DataFrame, base: str, at: datetime) -> str:
    """CSV archive under a timestamped folder; returns its path."""
    path = f"{base}/archive_{at:%Y%m%d_%H%M%S}"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def write_symbol_csv(df: DataFrame, path: str) -> None:
    """Consolidated CSV per symbol and exchange."""
    placed = df.hint("rebalance", F.col("symbol"), F.col("exchange"))
    placed.write.mode("overwrite").option("header", True).partitionBy("symbol", "exchange").csv(path)


def append_documents(docs: DataFrame, path: str) -> None:
    """Append JSON snapshots not stored yet."""
    spark = docs.sparkSession
    if files.exists(spark, path):
        docs = absent_documents(spark.read.schema(docs.schema).parquet(path), docs)
    else:
        docs = absent_documents(docs.limit(0), docs)
    docs.write.mode("append").parquet(path)


def write_range_named(table: DataFrame, base: str, name: str, time: str = "time_rounded") -> str:
    """Write ``base/name_<first>_<last>`` and then drop the older ranges of exactly that name.

    The new range is complete before an old one goes. Where the range is the same, the old table is set
    aside before the new one takes its name, and dropped afterwards.
    """
    spark = table.sparkSession
    first, last = table.agg(F.date_format(F.min(time), "yyyyMMddHHmm"), F.date_format(F.max(time), "yyyyMMddHHmm")).first()
    if first is None:
        raise ValueError("nothing to write")
    target = f"{name}_{first}_{last}"
    staging = f"{base}/_next_{target}"
    table.write.mode("overwrite").parquet(staging)
    old = [c for c in files.children(spark, base) if re.fullmatch(rf"{re.escape(name)}_\d{{12}}_\d{{12}}", c)]
    aside = f"{base}/_old_{target}"
    if target in old:
        files.rename(spark, f"{base}/{target}", aside)
    files.rename(spark, staging, f"{base}/{target}")
    files.delete(spark, aside)
    for child in old:
        if child != target:
            files.delete(spark, f"{base}/{child}")
    return f"{base}/{target}"


def write_data(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options: Any) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; known: {FORMATS}")
    df.write.format(fmt).mode(mode).options(**options).save(path)


#: Partition columns that name the day or month (UTC) of their rows, and the length of their values.
DATED_PARTS = {"day": 10, "date": 10, "month": 7}


def may_be_old(parts: Sequence[str], as_of: datetime) -> Column:
    """Partitions that can hold rows older than midnight UTC of ``as_of``, by the day or month they are named after."""
    midnight = as_of.astimezone(timezone.utc).date().isoformat()
    out = F.lit(True)
    for part in parts:
        if part in DATED_PARTS:
            last = F.lit(midnight[: DATED_PARTS[part]])
            out &= F.col(part) <= last if part == "month" else F.col(part) < last
    return out


def _pending(archive: str, table: str) -> str:
    return f"{archive}/_pending_{zlib.crc32(table.encode()):08x}_"


def _unpurged(spark: SparkSession, table: str, archive: str) -> list[str]:
    """Whole archives whose rows were not purged from ``table`` yet; unfinished ones are dropped."""
    mark = _pending(archive, table)
    out = []
    for name in files.children(spark, archive):
        if f"{archive}/{name}".startswith(mark):
            stored = f"{archive}/{f'{archive}/{name}'[len(mark) :]}"
            if files.exists(spark, f"{stored}/_SUCCESS"):
                out.append(stored)
            else:
                files.delete(spark, stored)
                files.delete(spark, f"{archive}/{name}")
    return out


def _stored_rows(spark: SparkSession, table: str) -> tuple[DataFrame, list[str]]:
    parts = files.partition_names(spark, table)
    return (read_partitioned(spark, table, parts) if parts else spark.read.parquet(table)), parts


def _archived_rows(spark: SparkSession, rows: DataFrame, archives: Sequence[str]) -> DataFrame:
    return spark.read.schema(rows.schema).option("header", True).csv(list(archives)) if archives else rows.limit(0)


def archive_old(spark: SparkSession, table: str, archive: str, as_of: datetime) -> list[str]:
    """Archive the rows older than midnight UTC of ``as_of`` as CSV; returns the archives that wait for their purge.

    Only partitions that may hold such rows are read, once, and the rows are counted on their way. The archive is read
    back and counted. A mark beside it stays until ``purge_archived``: if the job ends in between, the next
    run archives only rows (compared in all columns, with their number) that the waiting archives lack.
    """
    waiting = _unpurged(spark, table, archive)
    rows, parts = _stored_rows(spark, table)
    old, _ = split_archive(rows.where(may_be_old(parts, as_of)), F.timestamp_seconds(F.lit(int(as_of.timestamp()))))
    if waiting:
        old = old.exceptAll(_archived_rows(spark, rows, waiting))
    taken = {c for c in files.children(spark, archive)}
    name = first = f"archive_{as_of:%Y%m%d_%H%M%S}"
    again = 1
    while name in taken:
        again += 1
        name = f"{first}_{again}"
    mark, stored, seen = f"{_pending(archive, table)}{name}", f"{archive}/{name}", Observation()
    files.touch(spark, mark)
    old.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").option("header", True).csv(stored)
    archived, expected = _archived_rows(spark, rows, [stored]).count(), seen.get["n"]
    if archived != expected:
        raise RuntimeError(f"archived {archived} of {expected} old rows; table unchanged")
    if not archived:  # nothing to keep an empty folder for
        files.delete(spark, stored)
        files.delete(spark, mark)
        return waiting
    return [*waiting, stored]


def purge_archived(spark: SparkSession, table: str, archive: str, archives: Sequence[str], as_of: datetime) -> tuple[int, int]:
    """Remove from ``table`` the rows older than midnight UTC of ``as_of``, all of which ``archives`` hold; returns (archived, kept).

    A partitioned table keeps its layout: of partitions that may hold old rows the times alone are read; those without old
    rows are not touched, those with nothing else are dropped, and the few that hold both are rewritten. A table without
    partitions is written next to itself and swapped.
    """
    rows, parts = _stored_rows(spark, table)
    _, keep = split_archive(rows, F.timestamp_seconds(F.lit(int(as_of.timestamp()))))
    archived, total = _archived_rows(spark, rows, archives).count(), rows.count()
    if parts:
        _purge_partitions(spark, table, rows.where(may_be_old(parts, as_of)), keep, parts, as_of, archived)
        kept = _stored_rows(spark, table)[0].count() if files.partition_names(spark, table) else 0
    else:
        following, previous = f"{table}_next", f"{table}_previous"
        keep.write.mode("overwrite").parquet(following)
        kept = spark.read.parquet(following).count()
        if total - kept > archived:
            raise RuntimeError(f"archived {archived} + kept {kept} rows, expected {total}; table unchanged")
        files.rename(spark, table, previous)
        files.rename(spark, following, table)
        files.delete(spark, previous)
    for path in archives:
        files.delete(spark, f"{_pending(archive, table)}{path.rsplit('/', 1)[1]}")
    return archived, kept


def archive_and_purge(spark: SparkSession, table: str, archive: str, as_of: datetime) -> tuple[int, int]:
    """Move rows older than midnight UTC of ``as_of`` to a CSV archive; returns (archived, kept).

    Nothing is removed before the archive was read back and counted. A run that ended in between is taken up: its
    archive is completed, not repeated, and counts as archived. The table must not be written to meanwhile.
    """
    previous, following = f"{table}_previous", f"{table}_next"
    if files.exists(spark, previous):  # a swap that was cut short: the next table was whole before it began
        if not files.exists(spark, table):
            files.rename(spark, following, table)
        files.delete(spark, previous)
    return purge_archived(spark, table, archive, archive_old(spark, table, archive, as_of), as_of)


def _purge_partitions(spark: SparkSession, table: str, rows: DataFrame, keep: DataFrame, parts: Sequence[str], as_of: datetime, archived: int) -> None:
    old = F.coalesce(before_midnight("transact_time", F.timestamp_seconds(F.lit(int(as_of.timestamp())))), F.lit(False))
    counts = rows.groupBy(*parts).agg(F.count_if(old).alias("old"), F.count_if(~old).alias("others"))
    touched = counts.where("old > 0").select(*parts, "old", (F.col("others") == 0).alias("whole")).persist()
    found = touched.agg(F.coalesce(F.sum("old"), F.lit(0))).first()[0]
    if found > archived:
        raise RuntimeError(f"{found} old rows, of which {archived} are archived; table unchanged")
    mixed = touched.where("NOT whole")
    folders = [files.partition_folder(spark, table, {p: row[p] for p in parts}) for row in touched.where("whole").toLocalIterator()]
    if not mixed.isEmpty():
        staging = f"{table}_next_{uuid.uuid4().hex}"
        named = mixed.select(*[F.col(p).alias(f"_{p}") for p in parts])
        same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts])
        rest = keep.join(named, same, "left_semi")
        rest.write.parquet(staging)
        write_partitions(spark.read.schema(rest.schema).parquet(staging), table, parts)
        files.delete(spark, staging)
    for folder in folders:
        files.delete(spark, folder)
    touched.unpersist()
