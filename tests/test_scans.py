"""Texts of nested fields by language preference at any depth."""

import json

import pytest
from pyspark.sql import functions as F

from lotwise.sources import ted

RANK = {k: i for i, k in enumerate(ted.LANGUAGE_KEYS)}


def plain(v):
    if isinstance(v, dict):
        return [t for k in sorted(v, key=lambda k: (RANK.get(k, 9), k)) for t in plain(v[k])]
    if isinstance(v, list):
        return [t for x in v for t in plain(x)]
    return [] if v is None or not str(v).strip() else [v if isinstance(v, str) else json.dumps(v)]


def buried(depth):
    v = {"eng": "E", "deu": ["D", " "], "aaa": 1}
    for i in range(depth):
        v = {"zzz": f"z{i}", "value": [v, f"v{i}"], "bbb": {"text": f"t{i}", "deu": f'd"[{{{i}'}} if i % 2 else [f"l{i}", v]
    return v


@pytest.mark.parametrize("depth", [0, 1, 4, 9])
def test_language_order_at_any_depth(spark, depth):
    values = [buried(depth), "x", ["a", None, " ", ["b"]], None, {}, [], 7]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    fields = rows.select(F.parse_json("j").alias("v"), F.parse_json(F.to_json(F.struct("i"))).alias("w"))
    got = ted.texts_of(fields).collect()
    assert {int(r.w[0]): r.v for r in got} == {i: plain(v) for i, v in enumerate(values)}
    assert fields.agg(F.max(ted.nesting(F.col("v")))).first()[0] >= depth + 1


def test_each_field_is_opened_as_deep_as_it_lies(spark, monkeypatch):
    fields = spark.createDataFrame([('"x"', '[["a"], ["b"]]', '["c"]'), ("5", None, '[{"deu": "d", "eng": ["e"]}]')], "a string, b string, c string").select(
        *[F.parse_json(c).alias(c) for c in "abc"])
    opened, children = [], ted._children
    monkeypatch.setattr(ted, "_children", lambda v: opened.append(v) or children(v))
    got = [tuple(r) for r in ted.texts_of(fields).collect()]
    assert got == [(["x"], ["a", "b"], ["c"]), (["5"], [], ["d", "e"])]
    assert len(opened) == 0 + 2 + 3
