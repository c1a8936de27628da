"""Partners drawn by order statistics; joins by place and by hot keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from textkiln.operators import joins, merge, schedule

CHUNKS = "doc_id long, chapter_num string, echelon string, para_id string"


def chunks(n, chapters=("1", "1", "1", "2", None)):
    names = ["bct", "division", None, "corps"]
    return [(i, chapters[i % len(chapters)], names[(i // 5) % 4], None if i % 17 == 0 else f"p{i % 6}") for i in range(n)]


def eligible(rows, row):
    return {b[0] for b in rows if b[1] == row[1] and b[2] != row[2] and b[3] != row[3]}


def test_partners_are_eligible_and_there_where_they_can_be(spark):
    rows = [*chunks(300), (900, "9", "bct", "a"), (901, "9", "bct", "b"), (902, "8", "bct", "a"), (903, "8", "corps", "a"), (904, "8", "corps", None)]
    got = {r["doc_id"]: r["partner_id"] for r in schedule.contrastive_pairs(spark.createDataFrame(rows, CHUNKS)).collect()}
    assert len(got) == len(rows)
    for row in rows:
        able = eligible(rows, row)
        assert (got[row[0]] in able) if able else got[row[0]] is None
    assert got[900] is None and got[902] == 904


def test_every_eligible_partner_is_drawn_about_as_often(spark):
    rows = chunks(60, chapters=("1",))
    df = spark.createDataFrame(rows, CHUNKS)
    draws = Counter()
    for seed in range(12):
        for r in schedule.contrastive_pairs(df, seed=seed).collect():
            draws[r["doc_id"], r["partner_id"]] += 1
    # chi-square of each partner's draws against those that its askers give it evenly
    want, got = Counter(), Counter()
    for row in rows:
        able = eligible(rows, row)
        for b in able:
            want[b] += 12 / len(able)
    for (_, b), n in draws.items():
        got[b] += n
    chi = sum((got[b] - w) ** 2 / w for b, w in want.items())
    assert len(want) == 60 and chi < 101  # 59 degrees of freedom: 0.999 of the cases
    assert len({b for a, b in draws if a == 7}) > 6  # not a few champions


def test_one_chapter_and_one_partner_for_nearly_all(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    rows = [(i, "1", "bct", f"p{i}") for i in range(400)] + [(1000, "1", "corps", "q")]
    got = {r["doc_id"]: r["partner_id"] for r in schedule.contrastive_pairs(spark.createDataFrame(rows, CHUNKS)).collect()}
    assert {got[i] for i in range(400)} == {1000} and got[1000] in range(400)


def test_partners_of_an_empty_table(spark):
    assert schedule.contrastive_pairs(spark.createDataFrame([], CHUNKS)).collect() == []
    assert schedule.schedule(spark.createDataFrame([], CHUNKS), 10).collect() == []
    assert schedule.schedule(spark.createDataFrame(chunks(5), CHUNKS), 0).collect() == []


def test_hot_keys_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    out = joins.join_per_key(rows, per_key, ["k"], "n", 5000)
    assert out.columns == ["k", "id", "last"] and out.count() == 5000
    assert out.where("k = -1 AND last = 4998").count() == 2500


def test_join_by_place_needs_as_many_rows(spark):
    a, b = spark.range(5).withColumnRenamed("id", "a"), spark.range(6).withColumnRenamed("id", "b")
    with pytest.raises(ValueError, match="5 rows on the left, 6 on the right"):
        merge.join_by_place(a, b, ["a"], ["b"])
    assert [tuple(r) for r in merge.join_by_place(a, b.where("b > 0"), ["a"], ["b"]).orderBy("place").collect()] == [(i + 1, i, i + 1) for i in range(5)]
