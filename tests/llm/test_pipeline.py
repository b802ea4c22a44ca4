"""The pipeline, stage by stage, against plain versions on small tables."""

import collections
import zlib

import pytest

import corpus_pipeline
from lotwise.llm import decontamination, quality
from tests.llm.test_operators import brute_hits, brute_prints

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((name, before, docs))
    return out


def test_order_and_columns(steps):
    assert [n for n, _, _ in steps] == ["quality", "near_copies", "benchmark", "mix", "shards"]
    assert all(after.columns == before.columns for _, before, after in steps[:-1])
    assert steps[-1][2].columns == steps[-1][1].columns + ["shard", "slot"]


def test_rejected_documents_go(spark, steps):
    _, before, after = steps[0]
    field = quality.learn(before, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = before.collect()
    good = {r.doc_id for r, s in zip(rows, field.documents([(r.text or "").encode() for r in rows])) if s >= quality.GOOD}
    assert {r.doc_id for r in after.collect()} == good


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    prints = brute_prints([t for _, t in rows])
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    assert sorted(r.doc_id for r in after.collect()) == sorted({rows[g][0] for g in group})


def test_contaminated_documents_go(spark, steps):
    _, before, after = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, *_, bad in brute_hits([(r.doc_id, r.text) for r in before.collect()], items) if not bad}
    assert {str(r.doc_id) for r in after.collect()} == clean
    assert decontamination.WINDOW == 13


def test_the_mix_takes_effect(steps):
    _, before, after = steps[3]
    times = collections.Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in before.collect()}


def test_shards(steps):
    _, before, after = steps[4]
    rows = after.collect()
    sizes = collections.Counter(r.shard for r in rows)
    assert len(rows) == before.count() and max(sizes.values()) - min(sizes[s] for s in range(corpus_pipeline.SHARDS)) <= 1
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in before.collect())


def test_run_gives_the_same_rows(spark, steps):
    def digest(rows):
        return collections.Counter((r.doc_id, zlib.crc32((r.text or "").encode()), r.shard) for r in rows)
    assert digest(corpus_pipeline.run(spark, SF).collect()) == digest(steps[-1][2].collect())
