import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textkiln.functions import chat, ladders, rouge
from textkiln.functions import text as T


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text", ["a b  c", " x y\tz\n", "", "one", "é ß q"])
def test_words_and_strip_are_those_of_python(spark, text):
    assert one(spark, text, T.word_count) == len(text.split())
    assert one(spark, text, T.strip) == text.strip()


@pytest.mark.parametrize(("line", "heading"), [("ABCDE", False), ("ABCDEF", True), ("ATP 2-01 XYZ", False), ("123456", False), ("ABC 123", True), ("Abcdef", False)])
def test_heading(spark, line, heading):
    assert one(spark, line, T.is_heading) is heading


def test_references_and_figures(spark):
    assert one(spark, "See paragraphs 3-4 and 3-5; paragraph 4-1", T.cross_references) == ["3-4", "4-1"]
    assert one(spark, "Figure 3-1 shows", T.has_figure)
    assert not one(spark, "figures 3-1", T.has_figure)


def test_noise(spark):
    text = "a\nFigure 3-1. Caption\nb (See figure 3-1.)\n\n\n\nIntentionally LEFT blank\nc ATP 2-01.3 1 March 2019 "
    clean = one(spark, text, T.strip_noise)
    assert "Figure" not in clean and "figure" not in clean and "2019" not in clean and "blank" not in clean and "\n\n\n\n" not in clean


@pytest.mark.parametrize(
    ("text", "want"),
    [("<think>a</think>b", ("a", "b")), ("x<channel|>y<channel|>z", ("x<channel|>y", "z")), ("plain", ("", "plain")), ("<think>1</think>m<think>2</think>", ("1\n2", "m"))],
)
def test_parse_thinking(spark, text, want):
    assert tuple(one(spark, text, T.parse_thinking)) == want


def test_labelled_qa(spark):
    good = "**QUESTION:** one two three four five\nmore\n**ANSWER:** a b c d e f g h i j"
    assert tuple(one(spark, good, T.parse_labelled_qa)) == ("one two three four five", "a b c d e f g h i j")
    assert one(spark, "QUESTION: short ANSWER: a b c d e f g h i j", T.parse_labelled_qa) is None
    assert one(spark, "no labels", T.parse_labelled_qa) is None


@pytest.mark.parametrize(
    ("text", "flat", "longest"),
    [
        ('{"k": 1}', '{"k": 1}', '{"k": 1}'),
        ('x ```json\n{"k": 1}\n``` y', '{"k": 1}', '{"k": 1}'),
        ('prose {"k": 1} more', '{"k": 1}', '{"k": 1}'),
        ('p {"a": {"k": 1}} q', '{"k": 1}', '{"a": {"k": 1}}'),
        ('{"k": 1} and {bad and much longer}', '{"k": 1}', '{"k": 1}'),
        ("nothing", None, None),
        (None, None, None),
    ],
)
def test_ladders(spark, text, flat, longest):
    assert one(spark, text, ladders.first_json) == flat
    assert one(spark, text, ladders.longest_json) == longest


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=14))
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert rouge.lcs_length(a, b) == table[-1][-1]


@pytest.mark.parametrize(
    ("word", "want"),
    [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"),
     ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("conditional", "condit"), ("vietnamization", "vietnam"), ("triplicate", "triplic"),
     ("hopefulness", "hope"), ("adjustable", "adjust"), ("adoption", "adopt"), ("controlling", "control"), ("rate", "rate"), ("probate", "probat")],
)
def test_stems(word, want):
    assert rouge.stem(word) == want


def test_rouge(spark):
    rows = [("the cat sat", "the cat sat", 1.0), ("a b", "c d", 0.0), ("x", "", 0.0), ("the cat sat", "the cat", 0.8)]
    df = spark.createDataFrame(rows, "r string, p string, want double")
    for kind in (rouge.rouge_l(F.col("r"), F.col("p"), False), rouge.rouge_l_native(F.col("r"), F.col("p"))):
        for row in df.select("want", kind.alias("got")).collect():
            assert row["got"] == pytest.approx(row["want"])


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([("q one?", "", "answer"), ("q", "why <|end|> so", "a\nb"), ("", "t", "a")], "q string, t string, a string")
    text = chat.render(F.col("q"), F.col("t"), F.col("a"), F.lit("system"))
    got = rows.select("a", text.alias("x"), chat.parse(text).alias("p")).collect()
    assert got[0]["p"]["question"] == "q one?" and got[0]["p"]["answer"] == "answer" and "<|channel>" not in got[0]["x"]
    assert got[1]["p"]["answer"] == "a\nb"
    assert got[2]["x"] is None
