"""The pipeline on the smallest tables, stage by stage, against plain rules."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import near_texts
from roadpulse.session import cut_lineage


@pytest.fixture(scope="module")
def outputs(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut_lineage(stage(spark, docs, data))
    return out


def test_columns(outputs):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert outputs[name].dtypes == outputs["documents"].dtypes


def test_rejects_bad_and_keeps_good(outputs, spark, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    kept = outputs["quality"].select("doc_id").withColumn("kept", F.lit(1))
    known = outputs["documents"].join(labels, "doc_id").join(kept, "doc_id", "left")
    rates = {r["quality"]: r["rate"] for r in known.groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("rate")).collect()}
    assert rates[1] > 0.97 and rates[0] < 0.1


def test_one_of_each_text(outputs):
    before = defaultdict(list)
    for r in outputs["quality"].collect():
        before[r["text"]].append(tuple(r))
    after = [tuple(r) for r in outputs["exact_dedup"].collect()]
    assert sorted(after) == sorted(max(rows) for rows in before.values())


def test_one_of_each_near_group(outputs):
    groups = near_texts.near_groups(outputs["exact_dedup"]).collect()
    want = {r["component_id"] for r in groups}
    assert sorted(r["doc_id"] for r in outputs["near_dedup"].collect()) == sorted(want)


def test_mixture_is_balanced(outputs):
    rows, mixed = outputs["near_dedup"].count(), outputs["mixing"]
    shares = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert all(abs(n - rows / len(shares)) < 6 * (rows / len(shares)) ** 0.5 for n in shares.values())
    assert mixed.join(outputs["near_dedup"], mixed.columns, "left_anti").isEmpty()


def test_run_packs_every_token(outputs, spark, data):
    pieces = corpus_pipeline.run(spark, data)
    got = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert all(r["n"] % r["doc_tokens"] == 0 for r in got)
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in outputs["mixing"].select("doc_id").distinct().collect()}
    assert pieces.count() == outputs["packing"].count()
