"""From raw documents to shards: quality, near copies, benchmark passages, source weights, shards.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns
of docs.  A stage works on all rows it is given:

* quality: documents that the line field predicts bad go;
* near_copies: of each group of near copies the smallest id stays; near are fingerprints of op3 (runs of
  three words) that differ in at most 3 of 64 bits, which is less than all texts that are 0.8 similar;
* benchmark: contaminated documents go (at least a twentieth of the words inside benchmark windows);
* mix: each document stands as often as the mix takes it, 0 to 3 times, to the nearest whole;
* shards: every row gets one of 40 shards and a gapless slot in it.

``run`` writes each stage to the shared folder and reads it back, so a lost executor costs the
stage at hand at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import decontamination, mixing, quality, sharding, simhash
from lotwise.llm.base import landed, table

SHARDS = 40


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_good(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, ["doc_id", "text"], SHARDS)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("mix", mixed_sources),
    ("shards", sharded),
]

#: Neither the line field nor the fingerprints' hash can be said in DuckDB.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
