"""The stages keep what they should, in their order, and each hands on the columns of documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tillwork.llm import registry


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "similar", "benchmark", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    junk = spark.createDataFrame([(10_001, "123 $$$"), (10_002, None), (10_003, "")], "doc_id long, text string")
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(1).select(F.lit(10_004).cast("long").alias("doc_id"), "text")
    copy = docs.where("length(text) > 500").limit(1).select(F.lit(10_005).cast("long").alias("doc_id"), "text")
    docs = docs.unionByName(junk.unionByName(leak).unionByName(copy), allowMissingColumns=True).withColumn("row", F.lit(7))
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = {r[0] for r in docs.select("doc_id").collect()}
    assert not kept["language"] & {10_001, 10_002, 10_003} and 10_004 in kept["language"]
    assert 10_005 not in kept["lines"]
    assert kept["benchmark"] <= kept["similar"] <= kept["lines"] <= kept["language"] and 10_004 not in kept["benchmark"]
    leaks = registry.QUERIES["op9_benchmark_leaks"](spark, SMALL).select("doc_id").distinct().count()
    assert len(kept["similar"]) - len(kept["benchmark"]) <= leaks + 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r[0] for r in packed.select("doc_id").collect()} == kept["benchmark"]


@pytest.mark.parametrize("rows", [0, 3])
def test_stages_of_odd_tables(spark, rows):
    docs = spark.createDataFrame([(None, None, None), (1, "", "x"), (1, "plain words here", None)][:rows], "doc_id long, text string, lang string")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() <= max(rows, 0)


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(out.columns) and out.count() > 50
