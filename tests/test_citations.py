"""Answers against the paragraphs they cite."""

import random
import re

import pytest

from textkiln.operators import citations, joins


def grams(text, n):
    w = re.findall(r"[^\W_]+", text or "")
    return {" ".join(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def plain(answers, paragraphs, share, n):
    held = {}
    for p, t in paragraphs:
        if p is not None:
            held.setdefault(p, set()).update(grams(t, n))
    out = {}
    for key, cited, text in answers:
        a = grams(text, n)
        both = len(a & held.get(cited, set()))
        ok = bool(a) and both >= share * len(a) - 1e-9
        out[key] = (cited in held, len(a), both if ok else None, ok)
    return out


@pytest.mark.parametrize(("share", "n"), [(0.8, 2), (0.5, 1), (1.0, 3), (0.1, 2)])
def test_against_comparing_all(spark, monkeypatch, share, n):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    rng = random.Random(n)
    words = ["alpha", "beta", "gamma", "delta", "é1", "of", "the", "x"]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    paragraphs = [(f"p{i % 9}", say(rng.randrange(0, 40))) for i in range(20)] + [("hot", "the same old words"), (None, "the same"), ("empty", None)]
    answers = [(i, rng.choice(["p1", "p2", "p3", "p8", "none", None, "empty"]), say(rng.randrange(0, 12))) for i in range(80)]
    answers += [(100 + i, "hot", "the same old words" if i % 2 else "the same new words") for i in range(60)]
    answers += [(200 + i, p, t) for i, (p, t) in enumerate(paragraphs)]
    got = citations.supported(spark.createDataFrame(answers, "key long, cited string, text string"), spark.createDataFrame(paragraphs, "para_id string, text string"), share, n).collect()
    assert {r["key"]: (r["found"], r["n_shingles"], r["n_shared"], r["supported"]) for r in got} == plain(answers, paragraphs, share, n)


def test_no_answers(spark):
    none = spark.createDataFrame([], "key long, cited string, text string")
    assert citations.supported(none, spark.createDataFrame([("a", "b")], "para_id string, text string")).collect() == []
