"""Cut a plan with a written table in a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickloom.sinks import files

_OWN = f"tickloom-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """This process's folder below ``spark.checkpoint.dir``, or where that is unset below the warehouse.

    Both are shared by the driver and the executors of a cluster, so the same code runs in every mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/{_OWN}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    Series operators read their input several times (bar index, block borders, main path). When the
    input is a fold of the tape, staging it keeps that to a single pass over the trades, survives the
    loss of executors and leaves a columnar table to prune. ``clean`` drops the tables.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Drop everything that this process staged, once its results have been used."""
    files.delete(spark, shared_folder(spark))
