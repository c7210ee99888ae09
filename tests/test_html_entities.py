"""Entities decoded by Spark's own functions, compared with Python's decoder."""

from __future__ import annotations

import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from alertweave import plans
from alertweave.functions import scalars

FOLDER = "/root/testdata/sf0.001"


def texts():
    rng = random.Random(5)
    names = sorted(html5)
    out = [None, "", "&", "&&", "a & b", "&;", "&#;", "&#x;", "&#X4a", "&notit;", "&am", "&amp;lt;", "\n&lt\n", "é&copyé"]
    out += [f"&{n}" for n in names] + [f"x&{n}y&{n};z" for n in names]
    numbers = [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFEFF, 0xFFFE, 0xFFFF]
    numbers += [0x1FFFE, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 10**9, 10**12, 16**8, 16**12, 128512]
    out += [f.format(n) for n in numbers for f in ("&#{};", "&#000{}x", "&#x{:x};", "&#X00{:X} ")]
    parts = ["&", "#", "x", "X", ";", "0", "9", "f", " ", "\t", "\n", "<", "é", "😀", "amp", "lt", "notin", "gt;", "quot", "\\1", "$1"]
    out += ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(4_000)]
    return out


def test_entities_are_those_of_python(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: r.u for r in df.select("i", scalars.html_unescape(F.col("t")).alias("u")).collect()}
    assert [(t, got[i]) for i, t in rows if got[i] != (None if t is None else html.unescape(t))] == []


@pytest.mark.parametrize("name", ["e10_extract", "e12_html_unescape", "e14_extraction_outcomes"])
def test_no_row_goes_to_python(spark, name):
    plan = plans.load()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
