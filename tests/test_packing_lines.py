"""Packing lines that are rows: the same for every cut."""

import random

import pytest

from textkiln.operators import packing_lines


def plain(lines, most):
    out, first, n = [], 0, 0
    for i, (w, start) in enumerate(lines):
        if (start and i > first) or n > most:
            first, n = i, 0
        n += w or 0
        out.append(first)
    return out


@pytest.mark.parametrize("segment", [1, 3, 16, 1024])
def test_every_cut_packs_alike(spark, segment):
    rng = random.Random(segment)
    docs = {d: [(rng.choice([0, 1, 3, 7, None, 30, 200]), rng.choice([True, None] + [False] * 8)) for _ in range(rng.randrange(1, 60))] for d in [*range(12), None]}
    rows = [(d, i, *x) for d, lines in docs.items() for i, x in enumerate(lines)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc long, line int, words int, starts boolean")
    for most in (1, 20, 100):
        got = {}
        for r in packing_lines.pack_lines(df, most, segment).collect():
            got.setdefault(r["doc"], []).append((r["line"], r["chunk"]))
        assert {d: [c for _, c in sorted(x)] for d, x in got.items()} == {d: plain(lines, most) for d, lines in docs.items()}


def test_one_document_is_many_tasks(spark):
    df = spark.range(20_000).selectExpr("'big' AS doc", "id AS line", "CAST(id % 9 AS INT) AS words", "id % 1000 = 0 AS starts")
    got = [r["chunk"] for r in packing_lines.pack_lines(df, 50, 256).orderBy("line").collect()]
    assert got == plain([(i % 9, i % 1000 == 0) for i in range(20_000)], 50)


def test_no_lines(spark):
    assert packing_lines.pack_lines(spark.createDataFrame([], "doc long, line long, words int, starts boolean"), 10).collect() == []
