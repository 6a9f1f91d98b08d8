"""Exact dedup over content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import BLANKS, fresh, staged

#: A chunk ends at the first of these characters behind ``LEAST`` characters, at most after ``MOST``.
ENDS = ".!?;:,|"
LEAST, MOST = 256, 2048
CHUNK = rf"(?s).{{{LEAST},{MOST - 1}}}?[{ENDS}]|.{{1,{MOST}}}"


def normalised(column: str = "text") -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), f"[{BLANKS}]+", "")


def chunks(text: Column) -> Column:
    """Content-defined parts that joined give ``text``: equal texts have equal chunks, and an edit changes those near it."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_id(chunk: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), chunk).alias("a"), F.xxhash64(F.lit(2 * seed + 1), chunk).alias("b"))


def _verified(norm: DataFrame, seed: int) -> bool:
    """Whether no two different chunks of the table share an identifier. Each distinct chunk of a task moves once."""
    distinct = norm.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(chunk_id(F.col("chunk"), seed).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").count().where("count > 1").isEmpty()


def recipes(docs: DataFrame, seeds: int = 4) -> DataFrame:
    """doc_id, n_points (code points of the text), text_sha256, recipe (ordered chunk identifiers) and row of every document.

    Identifiers are 128 hashed bits that were proven free of collisions on this very table, chunk
    text against chunk text, so two documents are equal if and only if their recipes are; from there
    on no text moves. Should a collision show, the next seed is taken.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = docs.select("doc_id", F.char_length(text).alias("n_points"), normalised().alias("norm"))
    for seed in range(seeds):
        if _verified(norm, seed):
            recipe = F.transform(chunks(F.col("norm")), lambda c: chunk_id(c, seed))
            digest = norm.select("doc_id", "n_points", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe"))
            return staged(digest.withColumn("row", F.monotonically_increasing_id()))
    raise ValueError(f"chunk identifiers collide for {seeds} seeds")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs`` (doc_id, text).

    Texts are equal when they are identical without white space; null counts as empty, and empty texts
    are equal to each other. The row with the most code points stays, then the smallest doc_id; a
    null doc_id comes last. Of rows that agree in all this, one stays. Groups are folded in every
    task before they are shuffled, and joining their rows is left to adaptive splitting, so a group
    may hold any share of the table. An empty table gives no rows.
    """
    digest = recipes(docs)
    best = F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("back"), (-F.col("row")).alias("row"))).alias("best")
    sets = staged(digest.groupBy("recipe").agg(F.count("*").alias("n"), best).where("n > 1"))  # a side of its own, so that the join can split a hot recipe
    joined = digest.join(sets.withColumnRenamed("recipe", "set"), F.col("recipe") == F.col("set"), "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.bitwise_not("best.back")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (-F.col("best.row") == digest["row"])).alias("kept"),
        "text_sha256",
        "n_points",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by doc_id, length and digest; only where those repeat are equal rows counted off.
    """
    names = {c: fresh(c, docs) for c in ("stay_id", "stay_points", "stay_sha")}
    stay = staged(exact_groups(docs).where("kept")).select(F.col("doc_id").alias(names["stay_id"]), F.col("n_points").alias(names["stay_points"]), F.col("text_sha256").alias(names["stay_sha"]))
    text = F.coalesce(docs["text"], F.lit(""))
    on = docs["doc_id"].eqNullSafe(stay[names["stay_id"]]) & (F.char_length(text) == stay[names["stay_points"]]) & (F.sha2(normalised(), 256) == stay[names["stay_sha"]])
    repeated = not docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    if not repeated:
        return docs.join(stay.select(names["stay_id"]), docs["doc_id"].eqNullSafe(stay[names["stay_id"]]), "left_semi")
    points = docs.withColumns({names["stay_points"]: F.char_length(text), names["stay_sha"]: F.sha2(normalised(), 256)})
    once = points.dropDuplicates(["doc_id", names["stay_points"], names["stay_sha"]]).select(*docs.columns)
    return once.join(stay, on, "left_semi")


ORACLE = rf"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[{BLANKS}]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER same = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)"""
