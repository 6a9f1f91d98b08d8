"""Batch readers for trade files, market datasets and consolidated folders."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from functools import reduce
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from tickloom.operators.lifecycle import check_dates
from tickloom.operators.prepare import canonical_trades, canonical_types, drop_header_rows, in_calendar_range, rename_by_position
from tickloom.schema import AGG_TRADES, DATASETS, KLINES, TAPE
from tickloom.sinks import files

FORMATS = ("parquet", "csv", "json")
MINUTE_PARTS = ("symbol", "day", "hour", "minute")


def read_daily_trades(spark: SparkSession, base: str, symbols: Sequence[str], start: str, end: str) -> DataFrame:
    """Trades of a tape partitioned by ``symbol, date``; only the wanted partitions are listed."""
    check_dates(start, end)
    tape = spark.read.schema(T.StructType([*TAPE.fields, T.StructField("date", T.DateType())])).parquet(base)
    return in_calendar_range(tape.where(F.col("symbol").isin(list(symbols))), start, end)


def read_monthly_trades(
    spark: SparkSession, base: str, symbols: Sequence[str], first: tuple[int, int], last: tuple[int, int]
) -> DataFrame:
    """Trades of the older layout partitioned by ``symbol, year, month``; both months included."""
    parts = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
    tape = spark.read.schema(T.StructType([*TAPE.fields, *parts])).parquet(base)
    number = F.col("year") * 12 + F.col("month")
    wanted = number.between(first[0] * 12 + first[1], last[0] * 12 + last[1])
    return tape.where(F.col("symbol").isin(list(symbols)) & wanted)


def read_partitioned(spark: SparkSession, path: str, parts: Sequence[str], below: Sequence[str] | None = None) -> DataFrame:
    """A partitioned table with the columns of all its files; partition values are text, as they were written.

    ``below`` names the folders to read; the others are not listed.
    """
    reader = spark.read.option("basePath", path)
    folders = [path] if below is None else list(below)
    found = reader.option("mergeSchema", True).parquet(*folders)
    columns = [f for f in found.schema.fields if f.name not in parts]
    schema = T.StructType([*columns, *[T.StructField(p, T.StringType()) for p in parts]])
    return reader.schema(schema).parquet(*folders)


def read_latest_minutes(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Landed trades of the ``n`` newest minutes that have any, over all symbols.

    The minutes are found by the names of folders, newest day and hour first; only their files are read.
    """

    def values(folders: Sequence[str], name: str) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for folder in folders:
            for child in files.children(spark, folder):
                if child.startswith(f"{name}="):
                    out.setdefault(child.split("=", 1)[1], []).append(f"{folder}/{child}")
        return dict(sorted(out.items(), reverse=True))

    symbols = [f for found in values([path], "symbol").values() for f in found]
    wanted: list[list[str]] = []
    for days in values(symbols, "day").values():
        for hours in values(days, "hour").values():
            wanted += values(hours, "minute").values()
            if len(wanted) >= n:
                return read_partitioned(spark, path, MINUTE_PARTS, [f for found in wanted[:n] for f in found])
    if not wanted:
        raise FileNotFoundError(f"no minutes below {path}")
    return read_partitioned(spark, path, MINUTE_PARTS, [f for found in wanted for f in found])


def unreadable_files(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> list[str]:
    """Those of the files that exist but whose schema cannot be read."""
    bad = []
    for path in paths:
        try:
            if files.exists(spark, path):
                spark.read.format(fmt).load(path)
        except (PySparkException, Py4JJavaError):
            bad.append(path)
    return bad


def read_existing_files(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    skip_unreadable: bool = False,
) -> DataFrame:
    """Read those of the files that exist; an error only if none does.

    A file that cannot be read fails the job. With ``skip_unreadable`` such files are left out and named in
    a warning. The list is handed over as one glob, whose absent members simply do not match.
    """
    bad = unreadable_files(spark, paths, fmt) if skip_unreadable else []
    if bad:
        warnings.warn(f"skipped unreadable files: {bad}", stacklevel=2)
        paths = [p for p in paths if p not in bad]
    if not paths:
        raise FileNotFoundError("no input files")
    stem = paths[0].rsplit("/", 1)[0] + "/"
    while not all(p.startswith(stem) for p in paths):
        stem = stem.rstrip("/").rsplit("/", 1)[0] + "/"
    glob = stem + "{" + ",".join(p[len(stem) :] for p in paths) + "}"
    reader = spark.read.option("ignoreMissingFiles", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.format(fmt).load(glob)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"none of {len(paths)} input files exists below {stem}") from error
        raise


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones as null, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def union_aligned(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    return reduce(DataFrame.unionByName, [align_columns(df, schema) for df in frames])


def union_periods(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def read_headerless_trades(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Trades of CSV files read by position; header lines among the data are dropped."""
    raw = spark.read.schema(_strings(AGG_TRADES)).csv(paths if isinstance(paths, str) else list(paths), header=False)
    return canonical_types(drop_header_rows(raw))


def _named_csv(reader: DataFrameReader, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with a header, matched by name and typed as declared.

    The header of the first file names the columns; a file with another header, or a column that no file has,
    is an error.
    """
    reader = reader.option("header", True)
    names = reader.csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in [c.strip() for c in names]]
    if missing:
        raise ValueError(f"{path}: columns missing: {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = reader.schema(text).option("enforceSchema", False).csv(path)
    return raw.toDF(*[c.strip() for c in names])


def read_trades_csv(spark: SparkSession, path: str, schema: T.StructType = AGG_TRADES) -> DataFrame:
    """Trades of CSV files with a header and a declared schema, whatever the order of their columns."""
    return align_columns(_named_csv(spark.read, path, schema), schema)


def read_dataset(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """One of the exchange's datasets, by name, typed as declared.

    Columns are matched by name, with stray blanks trimmed; an absent column is an error.
    """
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}")
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    raw = reader.format(fmt).load(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    missing = [f.name for f in DATASETS[name].fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{name}: columns missing: {missing}")
    return align_columns(raw, DATASETS[name])


def read_klines(spark: SparkSession, path: str) -> DataFrame:
    """Exchange bars by position, with or without a header line."""
    raw = rename_by_position(spark.read.csv(path, header=False), KLINES.fieldNames())
    return align_columns(drop_header_rows(raw, "open_time"), KLINES)


def klines_as_bars(klines: DataFrame, symbol: str, timeframe: str) -> DataFrame:
    """Exchange bars as the bar frame the indicators read."""
    return klines.select(
        F.lit(symbol).alias("symbol"),
        F.lit(timeframe).alias("timeframe"),
        F.timestamp_millis("open_time").alias("time_rounded"),
        "open",
        "close",
        "high",
        "low",
        "volume",
    )


def symbols_in_paths(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Distinct ``key=value`` folder names of the files behind a frame; only names are listed, no rows are read."""
    found = {m[1] for f in df.inputFiles() if (m := re.search(rf"/{re.escape(key)}=([^/]+)/", f))}
    return df.sparkSession.createDataFrame([(unquote(x),) for x in sorted(found)], f"{key} string")


def list_files(spark: SparkSession, base: str, suffix: str = "") -> DataFrame:
    """Path, size and time of the files below ``base``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(base).select("path", "length", "modificationTime")


def file_accounting(files: DataFrame, key: str = "symbol") -> DataFrame:
    """Files and bytes per ``key=value`` folder."""
    value = F.regexp_extract("path", rf"/{key}=([^/]+)/", 1).alias(key)
    return files.groupBy(value).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def read_data(spark: SparkSession, path: str, fmt: str = "parquet", **options: Any) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; known: {FORMATS}")
    return spark.read.format(fmt).options(**options).load(path)


def read_symbol_csvs(spark: SparkSession, base: str, schema: T.StructType = AGG_TRADES) -> DataFrame:
    """CSV files laid out as ``exchange/timeframe/SYMBOL__*.csv``, tagged from their paths.

    Files whose path does not follow the layout are skipped.
    """
    layout = r"/([^/]+)/([^/]+)/([^/_]+)__[^/]*$"
    raw = _named_csv(spark.read.option("recursiveFileLookup", True), base, schema).select(*schema.fieldNames())
    path = F.input_file_name()
    tagged = raw.withColumns(
        {
            "exchange": F.regexp_extract(path, layout, 1),
            "timeframe": F.regexp_extract(path, layout, 2),
            "symbol": F.regexp_extract(path, layout, 3),
        }
    )
    return canonical_trades(tagged.where(F.col("symbol") != ""))
