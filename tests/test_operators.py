import pytest
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.operators import chunking, enrich, merge, prefs, ranking, reports, schedule, score, split, validate


def para(n, head="3-1. "):
    return head + " ".join(["w"] * (n - 1))


def chunks(spark, text, **options):
    return chunking.chunk(spark.createDataFrame([(1, text)], "doc_id long, text string"), **options).collect()


def test_chunk_sizes(spark):
    assert chunks(spark, para(19)) == []
    assert [r["word_count"] for r in chunks(spark, para(20))] == [20]
    long = "\n".join([para(300), " ".join(["x"] * 250), " ".join(["y"] * 30)])
    assert [(r["word_count"], r["para_id"]) for r in chunks(spark, long)] == [(550, "3-1"), (30, "3-1")]
    lost = "\n".join([para(300), " ".join(["x"] * 250), " ".join(["y"] * 10)])
    assert [r["word_count"] for r in chunks(spark, lost)] == [550]


def test_chunk_chapters_and_preamble(spark):
    text = "\n".join(["before", para(25, "9-1. "), para(25, "A-2. "), para(25, "08-3. ")])
    assert [(r["para_id"], r["chapter_num"]) for r in chunks(spark, text)] == [("A-2", "A"), ("08-3", "8")]


def test_sections(spark):
    text = "\n".join(["HEADING ONE", para(25), "HEADING TWO", para(25, "3-2. ")])
    assert [r["section"] for r in chunks(spark, text)] == ["HEADING TWO", "HEADING TWO"]
    far = "\n".join(["HEADING ONE", *["x"] * 25, para(25)])
    assert [r["section"] for r in chunks(spark, far)] == ["General"]
    near = "\n".join(["HEADING ONE", *["x"] * 24, para(25)])
    assert [r["section"] for r in chunks(spark, near)] == ["HEADING ONE"]


def test_empty_and_null_texts_have_no_chunks(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert chunking.chunk(docs).count() == 0


@pytest.mark.parametrize(
    ("line", "para_id", "chapter"),
    [("3-24. The unit", "3-24", "3"), ("A-1. Text", "A-1", "A"), ("3-24.", None, None), ("E-1. Text", None, None), ("9-1. Text", "9-1", None), (" 3-1. Text", None, None)],
)
def test_para_start(spark, line, para_id, chapter):
    row = spark.createDataFrame([(line,)], "v string").select(chunking.para_id(F.col("v")).alias("p"), chunking.chapter_of_prefix(chunking.para_prefix(F.col("v"))).alias("c")).first()
    assert (row["p"], row["c"]) == (para_id, chapter)


def test_dense_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = ranking.dense_row_number(df, [F.col("k")], "n", start=0).collect()
    assert all(r["k"] == r["n"] for r in got) and len(got) == 1000


def test_over_provision():
    assert [schedule.over_provision(n) for n in (5000, 1, 0)] == [6500, 1, 0]


@pytest.mark.parametrize(("value", "want"), [(" BCT ", "bct"), ("squad", "general"), (None, "general"), ("5", "general")])
def test_clamp(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(enrich.clamp(F.col("v"), *S.VOCABULARY["echelon"]).alias("r")).first()["r"] == want


def test_keyword_rules(spark):
    df = spark.createDataFrame([("repair the bridge",), ("cyberspace",), ("corps and division",)], "t string")
    rows = df.select(enrich.classify(F.col("t"), F.lit("7")).alias("m")).select("m.*").collect()
    assert [r["domain"] for r in rows] == ["air", "cyber", "general"]
    assert rows[2]["echelon"] == "corps" and rows[0]["ipb_step"] is None and rows[0]["doctrinal_weight"] == 3.0


def test_copies_round_half_to_even(spark):
    df = spark.createDataFrame([(1.5,), (2.0,), (2.5,), (3.0,), (0.4,)], "w double")
    assert [r["c"] for r in df.select(schedule.copies(F.col("w")).alias("c")).collect()] == [2, 2, 2, 3, 1]


@pytest.mark.parametrize(("spec", "want"), [("2,3,D", ["2", "3", "D"]), ("a, ,b", ["A", "B"]), ("", [])])
def test_chapter_filter(spec, want):
    assert enrich.chapters_in_filter(spec) == want


def test_contrastive_partner(spark):
    rows = [(1, "1", "bct", "1-1"), (2, "1", None, "1-2"), (3, "2", "bct", "2-1"), (4, "2", "bct", "2-2")]
    df = spark.createDataFrame(rows, "doc_id long, chapter_num string, echelon string, para_id string")
    got = {r["doc_id"]: r["partner_id"] for r in schedule.contrastive_pairs(df).collect()}
    assert got == {1: 2, 2: 1, 3: None, 4: None}


def test_schedule_is_prefix_stable(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, S.CHAPTERS)), (F.col("id") % 12 + 1).cast("int")).alias("chapter_num"))
    few = [tuple(r) for r in schedule.schedule(df, 30).collect()]
    many = [tuple(r) for r in schedule.schedule(df, 200).collect()]
    assert sorted(few, key=lambda r: r[-1]) == sorted(many, key=lambda r: r[-1])[:30] and len(many) == 200
    assert {r[4] for r in many} <= set(S.QUESTION_TYPES)


def words(n, tail=""):
    return " ".join(["w"] * n) + tail


CITE = " [Reference: ATP 2-01.3, para 3-1]"


@pytest.mark.parametrize(
    ("profile", "q", "a", "t", "want"),
    [
        ("base", words(19), words(60, CITE), "para 3-1", "question too short"),
        ("base", "", words(60, CITE), "para 3-1", "empty question"),
        ("base", words(20), " ", "para 3-1", "empty answer"),
        ("base", words(20), words(40), "para 3-1", "answer too short"),
        ("base", words(20), words(60, CITE), words(500, " para 3-1"), "trace too long"),
        ("base", words(20), "  according to atp " + words(60, CITE), "para 3-1", "bad opening"),
        ("base", words(20), words(60), "para 3-1", "missing citation"),
        ("base", words(20), words(60, CITE + " more"), "para 3-1", "ok"),
        ("base", words(20), words(60, CITE), "para A-1", "trace without paragraph"),
        ("appendix", words(20), words(60, CITE), "para A-1", "ok"),
        ("base", words(20, " resource allocation"), words(60, CITE), "para 3-1", "prompt leak"),
        ("base", words(5), words(60), "", "question too short"),
        ("strict", words(20), words(60, CITE), "para 3-1", "trace too short"),
    ],
)
def test_validation(spark, profile, q, a, t, want):
    df = spark.createDataFrame([(q, a, t)], "q string, a string, t string")
    assert df.select(validate.reason(profile, F.col("q"), F.col("a"), F.col("t")).alias("r")).first()["r"] == want


def test_merge_keeps_first_and_is_idempotent(spark):
    rows = [(["A", "B"], "t", "mac", 1, "m"), (["A", "B"], "t", "spark", 1, "s"), (["B", "A"], "t", "spark", 2, "x")]
    df = spark.createDataFrame(rows, "source_chunks array<string>, question_type string, file string, line int, v string")
    key, order = ["source_chunks", "question_type"], ["file", "line"]
    out = merge.merge([df], key, order)
    assert sorted((r["v"], r["qa_id"]) for r in out.collect()) == [("m", "qa_00001"), ("x", "qa_00002")]
    again = merge.merge([out.drop("qa_id"), out.drop("qa_id")], key, order)
    assert sorted((r["v"], r["qa_id"]) for r in again.collect()) == [("m", "qa_00001"), ("x", "qa_00002")]
    given = {r["file"]: (r["n_read"], r["n_unique"], r["n_removed"]) for r in merge.contribution(df, key, "file", order).collect()}
    assert given == {"mac": (1, 1, 0), "spark": (2, 1, 1)}


@pytest.mark.parametrize(("n", "val"), [(0, 0), (1, 1), (10, 1), (19, 1), (20, 2)])
def test_split(spark, n, val):
    parts = [r["part"] for r in split.train_val_split(spark.range(n), "id").collect()]
    assert len(parts) == n and parts.count("val") == val


@pytest.mark.parametrize(
    ("kws", "text", "score_", "weak"),
    [(list("abcdefghij"), "abcdef " + "xyz", 0.5, False), (["aa", "bb"], "aa [Reference: ATP 2-01.3]", 0.5, False), ([], "x", 0.0, True)],
)
def test_scores(spark, kws, text, score_, weak):
    df = spark.createDataFrame([(kws, text)], "k array<string>, t string")
    row = score.scored(df, "t", "k").first()
    assert row["score"] == pytest.approx(score_) and row["needs_dpo"] is weak


def test_coverage_rounds_half_to_even(spark):
    df = spark.createDataFrame([([chr(97 + i) * 3 for i in range(16)], "aaa")], "k array<string>, t string")
    assert df.select(score.coverage(F.col("t"), F.col("k")).alias("r")).first()["r"] == 0.062


def test_preference_pairs(spark):
    rows = [("1", "q", "a", words(9)), ("2", "q", "a", ""), ("3", "q", "a", words(10)), ("4", "", "a", "x")]
    df = spark.createDataFrame(rows, "key string, question string, answer string, r string")
    got = {r["key"]: r["rejected"] for r in prefs.preference_pairs(df, "r", "key").collect()}
    assert got == {"1": S.FIXED_REJECTED, "2": S.FIXED_REJECTED, "3": words(10)}


def test_unknown_weak_ids_use_all_seeds(spark):
    seeds = spark.createDataFrame([("1", "factual"), ("2", "contrastive")], "key string, question_type string")
    ids = lambda *w: prefs.weak_types(spark.createDataFrame([(x,) for x in w], "id string"))
    assert prefs.matching_seeds(seeds, ids("ZZ-1")).count() == 2
    assert prefs.matching_seeds(seeds, ids("MD-1")).count() == 2
    assert [r["key"] for r in prefs.matching_seeds(seeds, ids("F-1", "ZZ-2")).collect()] == ["1"]


def test_progress(spark):
    df = spark.createDataFrame([(2, 3), (1, 0)], "n long, m long")
    assert [r["p"] for r in df.select(reports.progress(F.col("n"), F.col("m")).alias("p")).collect()] == [66, 100]


def test_stage_gating():
    assert reports.stages_to_run() == ["chunk", "enrich", "generate", "format", "train", "eval"]
    assert reports.stages_to_run("format", "eval", skip=("train",)) == ["format", "eval"]
    assert reports.stages_to_run("eval", with_dpo=True) == ["eval", "dpo"]


def test_rejected_is_the_models_weakest_answer(spark):
    seeds = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "question string")
    answers = spark.createDataFrame([("q1", "bad", 0.1), ("q1", "worse", 0.0), ("q2", "good", 0.9)], "question string, response string, score double")
    got = {r["question"]: r["rejected"] for r in prefs.rejected_from_answers(seeds, answers).collect()}
    assert got == {"q1": "worse", "q2": None, "q3": None}
