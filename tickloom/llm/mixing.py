"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import binary, fresh, numbered, slices, staged
from tickloom.llm.words import Words

#: Bits of the hash that one level of histograms resolves; together 63.
LEVELS = (13, 13, 13, 12, 12)
#: Sources up to which the thresholds are broadcast (some 60 bytes each).
BROADCAST_SOURCES = 100_000


def _hash() -> Column:
    """63 bits of the document: its id and text, so that rows that agree in both share their fate."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)


def _sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and hash of every document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counts = Words(binary(part.column("text"))).counts
                yield pa.RecordBatch.from_arrays([*part.select(["doc_id", "source", "h"]).columns, pa.array(counts)], names=["doc_id", "source", "h", "size"])

    return docs.select("doc_id", "source", "text", _hash().alias("h")).mapInArrow(run, "doc_id bigint, source string, h bigint, size bigint")


def _targets(sources: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """Add ``target``: ``share`` of all sizes dealt by weight, no source above ``most`` times its size, the excess dealt again.

    Each round is one aggregate over the sources; the level rises until no further source is capped.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("w", weight)
    level, cap = 0.0, most * F.col("source_size")
    while True:
        full = cap <= level * F.col("w")
        row = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("w"))).alias("open")
        ).first()
        if not row["all"] or not row["open"]:
            break
        raised = (share * row["all"] - (row["capped"] or 0.0)) / row["open"]
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("w")))


def _joined(df: DataFrame, cuts: DataFrame, sources: int) -> DataFrame:
    """Join a row for each source; few sources are broadcast, many are left to the planner, which splits a hot one."""
    return df.join(F.broadcast(cuts) if sources <= BROADCAST_SOURCES else cuts, df["source"].eqNullSafe(cuts["of"])).drop("of")


def mix_plan(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame, int]:
    """Sizes of the documents, the mix's cut for each source, and the number of sources.

    Sizes are counted once and written. A source takes every document ``passes`` times and those with a
    hash below ``cut`` once more. The cut is found from token histograms of hash buckets, level by
    level: only the bucket in which the budget ends is split further, so no row is sorted. What is
    left is one hash value, which goes in if that brings the source nearer to its target.
    """
    docs = docs.select("doc_id", "source", "text")
    sizes = staged(_sizes(docs))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(_targets(staged(numbered(sources, F.asc_nulls_last("source"), "k")), weights, share, most))
    count = sources.count()
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    cuts = sources.select(F.col("source").alias("of"), "source_size", "target", passes.alias("passes")).withColumns(
        {"rest": F.col("target") - F.col("passes") * F.col("source_size"), "below": F.lit(0).cast("bigint"), "prefix": F.lit(0).cast("bigint"), "last": F.lit(0).cast("bigint")}
    )
    done = 0
    for bits in LEVELS:
        here = _joined(sizes, cuts.where("rest > 0").select("of", "prefix"), count).where(F.shiftright("h", 63 - done) == F.col("prefix"))
        bucket = F.shiftright("h", 63 - done - bits)
        histogram = here.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        ends = _joined(histogram.withColumn("upto", upto), cuts.select("of", "rest", "below"), count).where(F.col("below") + F.col("upto") > F.col("rest"))
        first = ends.groupBy("source").agg(F.min_by(F.struct("bucket", "upto", "n"), "bucket").alias("b"))
        cuts = cuts.drop("prefix", "last").join(first, cuts["of"].eqNullSafe(first["source"]), "left")
        cuts = staged(
            cuts.select(
                "of", "source_size", "target", "passes", "rest", (F.col("below") + F.coalesce(F.col("b.upto") - F.col("b.n"), F.lit(0))).alias("below"),
                F.coalesce(F.col("b.bucket"), F.lit(0)).alias("prefix"), F.coalesce(F.col("b.n"), F.lit(0)).alias("last"),
            )
        )
        done += bits
    nearer = F.col("rest") - F.col("below") > F.col("last") / 2
    cut = F.when(F.col("rest") > 0, F.col("prefix") + F.when(nearer, 1).otherwise(0)).otherwise(0)
    return sizes, cuts.select("of", "source_size", "target", "passes", cut.cast("bigint").alias("cut")), count


def mix(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every document.

    Sources are weighted in turn in the order of their names by code point, a null source last; the
    targets share ``share`` of all words. Whole documents are taken. A null or empty text has size 0
    and takes nothing; rows with equal id and text are taken alike; an empty table gives no rows.
    """
    sizes, cuts, count = mix_plan(docs, weights, share, most)
    again = F.col("passes") + (F.col("h") < F.col("cut")).cast("int")
    return _joined(sizes, cuts, count).select("doc_id", "size", "source_size", "target", (F.col("size") * again).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken. Documents without words go once."""
    _, cuts, count = mix_plan(docs, weights, share, most)
    names = {c: fresh(c, docs) for c in ("passes", "cut", "of", "times", "h")}
    cuts = cuts.select(*[F.col(c).alias(names[c]) for c in ("of", "passes", "cut")])
    cuts = F.broadcast(cuts) if count <= BROADCAST_SOURCES else cuts
    joined = docs.withColumn(names["h"], _hash()).join(cuts, docs["source"].eqNullSafe(cuts[names["of"]]))
    times = F.col(names["passes"]) + (F.col(names["h"]) < F.col(names["cut"])).cast("int")
    times = F.when(F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\f\r", "     ")) == "", 1).otherwise(times)
    return joined.withColumn(names["times"], F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(0))))).where(times > 0).select(*docs.columns)
