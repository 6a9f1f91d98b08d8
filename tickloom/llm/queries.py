"""The registered queries of the operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import ball_tree, exact, filter_audit, least_squares_packing, mixing, near, neighbours, packing, scoring, substrings, token_counts, token_files, toxicity
from tickloom.llm.common import documents, shared_folder
from tickloom.llm.tokens import public_vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    token_files.write_token_files(documents(spark, sf_dir), folder, public_vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), public_vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir)).drop("n_points")


ORACLES["op9_exact_dedup"] = exact.ORACLE


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_vocabulary("piece_bpe_32k.model"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_shingles")


@query
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(documents(spark, sf_dir))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLES["op12_filter_audit"] = filter_audit.ORACLE


@query
def op11_least_squares_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = least_squares_packing.pack_by_least_squares(documents(spark, sf_dir), public_vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLES["op13_ball_tree_search"] = ball_tree.ORACLE
