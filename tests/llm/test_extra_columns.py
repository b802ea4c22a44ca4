"""Columns named like the operators' working names keep name, type and values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotwise.llm import decontamination, edit_prints, mixing, quality, sharding, simhash
from tests.llm.test_operators import SF

WORKING = ["stop", "first", "room", "moves", "before", "ahead", "n", "at", "cell", "_cell", "_copies", "_rank", "_move", "plan", "_plan", "_times", "_nth", "_size", "_s", "_d", "_z",
           "size", "nth", "taken", "target", "weight", "h", "part", "words", "_text", "text_", "fingerprint", "_file", "_at", "fp", "root", "who", "no_id", "spans", "items", "n_words",
           "contaminated", "n_hit", "score", "predicted", "row", "copies", "component_id", "__own_0", "a b", "x.y"]


def stages(spark):
    bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    return {"quality": lambda d: quality.filter_good(d, labels), "near copies": simhash.near_duplicates, "benchmark": lambda d: decontamination.decontaminate(d, bench),
            "mix": mixing.mixed, "shards": lambda d: sharding.shard(d, ["doc_id", "text"], 3, vnodes=4).drop("shard", "slot")}


@pytest.mark.parametrize("name", ["quality", "near copies", "benchmark", "mix", "shards"])
def test_extra_columns_stay(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = docs.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in WORKING], (F.col("doc_id") % 3).cast("short").alias("times"))
    out = stages(spark)[name](extra)
    assert out.columns == extra.columns and out.dtypes == extra.dtypes
    rows = out.collect()
    assert rows and {tuple(r) for r in rows} <= {tuple(r) for r in extra.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stages(spark)[name](docs).collect())


def test_an_empty_corpus_and_an_empty_benchmark(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage_name, stage in stages(spark).items():
        assert stage(docs.where("false")).count() == 0, stage_name
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").where("false")
    assert decontamination.decontaminate(docs, bench).count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality" and edit_prints.edit_prints(docs.where("false")).count() == 0
