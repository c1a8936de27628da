"""The table function, scalar functions in SQL, and counted stages."""

import random

import pytest
from pyspark.sql import functions as F

from textkiln.functions import udtf
from textkiln.operators import observed


def packed(sizes, most):
    out, first, n = [], None, 0
    for i, w in enumerate(sizes):
        first = i if first is None else first
        n += w or 0
        if n > most:
            out.append((len(out), first, i, n))
            first, n = None, 0
    return out + ([(len(out), first, len(sizes) - 1, n)] if first is not None else [])


def test_documents_are_packed_by_themselves_and_in_order(spark):
    udtf.register(spark)
    rng = random.Random(2)
    docs = {d: [rng.choice([0, 3, 9, None, 40]) for _ in range(rng.randrange(1, 30))] for d in range(30)}
    rows = [(d, i, w) for d, sizes in docs.items() for i, w in enumerate(sizes)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "d long, i int, w int").repartition(5).createOrReplaceTempView("some_lines")
    got = spark.sql("SELECT * FROM pack_lines(TABLE(some_lines), 'd', 'i', 'w', 20)")
    assert got.columns == ["d", "chunk_no", "first_line", "last_line", "n_words"]
    by = {}
    for r in got.orderBy("d", "chunk_no").collect():
        by.setdefault(r["d"], []).append(tuple(r)[1:])
    assert by == {d: packed(sizes, 20) for d, sizes in docs.items()}


@pytest.mark.parametrize(("call", "said"), [("'d', 'x', 'w', 20", "name a column"), ("'d', 'i', 'w', 0", "max_words")])
def test_a_wrong_call_says_what_is_wrong(spark, call, said):
    udtf.register(spark)
    spark.createDataFrame([(1, 1, 1)], "d long, i int, w int").createOrReplaceTempView("one_line")
    with pytest.raises(Exception, match=said):
        spark.sql(f"SELECT * FROM pack_lines(TABLE(one_line), {call})").collect()


def test_scalar_functions(spark):
    udtf.register(spark)
    row = spark.sql("SELECT word_count(' a  b\\u2003c ') AS n, chapter_title('5') AS t, chapter_weight('5') AS w, chapter_weight('x') AS d").first()
    assert (row["n"], row["w"], row["d"]) == (3, 2.5, 1.5) and row["t"].startswith("Step 3")


def test_stages_are_counted_by_their_writes(spark, tmp_path):
    log = observed.StageLog(spark)
    read = spark.sparkContext.accumulator(0)
    rows = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    first = log.write("all", rows, str(tmp_path / "a"), n_even=F.count_if("even"))
    log.write("even", first.where("even"), str(tmp_path / "b"))
    assert log.counts("all") == {"n_rows": 100, "n_even": 50} and read.value == 0
    report = log.report().orderBy("place").collect()
    assert [(r["stage"], r["n_rows"], r["percent"]) for r in report] == [("all", 100, 100), ("even", 50, 50)]
    assert all(0 < r["seconds"] < 60 for r in report)
    assert observed.StageLog(spark).report().count() == 0
    assert observed.clock(3725.9) == "1h 02m 05s"
