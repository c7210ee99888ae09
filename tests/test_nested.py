"""Nested clean-up against a plain recursion over the values."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from alertweave.functions import nested

UNSAFE = ("@", " ", "\\")
SCHEMA = (
    "id int, v struct<name:string, `@type`:string, n:int, "
    "tags:array<map<string,array<string>>>, "
    "deep:struct<` odd`:int, more:map<string,struct<`\\\\x`:string, t:string, when:date>>>, "
    "only:struct<`@a`:int>>, words:array<string>, plain:map<string,string>, number:double"
)
VALUES = [
    (
        1,
        (
            "a\x00b",
            "\x00",
            1,
            [{"k": ["x\x00", None, ""], "@k": ["y"]}, {}, None, {" s": [], "s ": ["\x00\x00"]}],
            (5, {"\\m": None, "m": ("u", "t\x00", None), "@": ("u", "t", None)}),
            (3,),
        ),
        ["\x00", None, "w"],
        {"@type": "x", "": "\x00", "ok": None},
        1.5,
    ),
    (2, None, None, None, None),
    (3, (None, None, None, None, None, None), [], {}, 0.0),
    (4, ("é\x00", "@", 2, [], (None, None), (None,)), ["ok"], {"a@": "b"}, -1.0),
]


def stripped(value, kind):
    if value is None:
        return None
    if isinstance(value, str):
        return value.replace("\x00", "")
    if isinstance(kind, T.ArrayType):
        return [stripped(x, kind.elementType) for x in value]
    if isinstance(kind, T.MapType):
        return {k: stripped(x, kind.valueType) for k, x in value.items()}
    if isinstance(kind, T.StructType):
        return {f.name: stripped(value[f.name], f.dataType) for f in kind}
    return value


def safe(value, kind):
    if value is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [safe(x, kind.elementType) for x in value]
    if isinstance(kind, T.MapType):
        return {k: safe(x, kind.valueType) for k, x in value.items() if not k.startswith(UNSAFE)}
    if isinstance(kind, T.StructType):
        kept = [f for f in kind if not f.name.startswith(UNSAFE)]
        return {f.name: safe(value[f.name], f.dataType) for f in kept} or {"_empty": None}
    return value


def plain(value):
    if isinstance(value, T.Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return value


@pytest.mark.parametrize(
    ("rewrite", "expected"),
    [(nested.strip_nul_deep, stripped), (nested.drop_unsafe_keys_deep, safe)],
)
def test_every_depth_is_rewritten(spark, rewrite, expected):
    df = spark.createDataFrame(VALUES, SCHEMA)
    fields = df.schema.fields[1:]
    got = df.select("id", *[rewrite(df[f.name], f.dataType).alias(f.name) for f in fields])
    before = {r.id: r for r in df.collect()}
    after = {r.id: plain(r) for r in got.collect()}
    assert set(after) == {1, 2, 3, 4}
    for key, row in before.items():
        for f in fields:
            assert after[key][f.name] == expected(row[f.name], f.dataType), (key, f.name)


def test_values_without_texts_or_names_are_left_as_they_are(spark):
    df = spark.createDataFrame([([1, 2],)], "a array<int>")
    for rewrite in (nested.strip_nul_deep, nested.drop_unsafe_keys_deep):
        same = df.select(rewrite(df["a"], df.schema["a"].dataType).alias("a"))
        assert same.first().a == [1, 2]
        assert "transform" not in same._jdf.queryExecution().optimizedPlan().toString()
