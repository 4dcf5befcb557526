"""The registered queries over the corpus tables: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm import (collocations, decontamination, forest, language, licences, lines, maxscore, packing, quality, repair, repeats,
                          sharding, sql, vectors)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op6_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, folder, "documents"), shards=40)


@query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"))
    return packing.pack(pieces).selectExpr(
        "id as doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op4_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_classes(table(spark, folder, "documents")).selectExpr(
        "id as doc_id", "no as line_no", "first_id as first_doc_id", "first_no as first_line_no", "kept")


@query
def op8_licence_notices(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licence_notices(table(spark, folder, "documents"))


SQL["op8_licence_notices"] = sql.LICENCES


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, folder, "labels")))


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit_languages(docs))


@query
def op2_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"), cosine=0.98)


SQL["op2_near_vectors"] = sql.VECTORS


@query
def op5_similar_texts(spark: SparkSession, folder: str) -> DataFrame:
    return forest.similar_texts(table(spark, folder, "documents"))


@query
def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents"), length=100)


@query
def op11_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.top_by_inner_product(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


SQL["op11_top_vectors"] = sql.TOP_VECTORS


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=30, top=2000)


SQL["op12_collocations"] = sql.COLLOCATIONS


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repairs_after_damage(table(spark, folder, "conversations"))
