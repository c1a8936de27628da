import random

import corpus_pipeline
from textkiln.llm import line_dedup, packing, quality_rules
from textkiln.llm.shingles import shingle_set


def make(n=90, seed=3):
    rng = random.Random(seed)
    shared = [f"this passage {i} is found in many of the documents of the table" for i in range(3)]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(55, 120))]
        if i % 9 == 8:  # near copy of an earlier one
            words = rows[i - 3][1].split("\n")[0].split()
            words[4] = "changed"
        text = " ".join(words) + ("\n" + rng.choice(shared) if i % 2 else "")
        if i % 13 == 12:
            text = "*** ### " * 40
        rows.append((i, text, "en", "big" if i % 3 else f"s{i % 2}", len(text)))
    return [*rows, (900, None, "en", "big", 0), (901, "", None, None, 0), (2, rows[2][1], "en", "big", 1)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def through(spark, rows, tmp_path):
    """The stages as a runner drives them: written and read again."""
    docs, out = spark.createDataFrame(rows, SCHEMA), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, tmp_path):
    rows = make()
    stages = through(spark, rows, tmp_path)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(s.columns == columns for s in stages[:-1])

    def passes(text):
        t = quality_rules.Text(text)
        return not quality_rules.base_failed(len(t), t.repeat_words()) and quality_rules.first_failure(t, quality_rules.RULES) is None

    good = [r for r in rows if passes(r[1])]
    assert sorted(r["doc_id"] for r in stages[0].collect()) == sorted(r[0] for r in good)
    holders = {}
    for d, text, *_ in good:
        for x in text.split("\n"):
            holders.setdefault(line_dedup.line_key(x), set()).add(d)
    stay = lambda d, x: len(x.strip()) < 40 or len(h := holders[line_dedup.line_key(x)]) < 5 or d == max(h)
    cut = [(d, "\n".join(x for x in t.split("\n") if stay(d, x))) for d, t, *_ in good]
    got = stages[1].collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(cut)
    assert all(r["n_chars"] == len(r["text"]) for r in got if r["n_chars"] != 1)
    sets, left = {}, []
    for d, t in sorted(set(cut)):
        sets[d] = set(shingle_set(t, 5).tolist())
        if not any(100 * len(sets[d] & sets[o]) >= 80 * len(sets[d] | sets[o]) for o in left):
            left.append(d)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == left
    assert {r["doc_id"] for r in stages[3].collect()} == set(left)
    pieces = stages[4].collect()
    assert sum(r["length"] for r in pieces) == sum(len(packing.encode(r["text"])) + 1 for r in stages[3].collect())


def test_run_and_empty_table(spark, tmp_path):
    spark.createDataFrame(make(30), SCHEMA).write.parquet(str(tmp_path / "a/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "b/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).collect() == []


def test_all_rows_rejected(spark, tmp_path):
    stages = through(spark, [(1, "too short", "en", "s", 9)], tmp_path)
    assert [s.count() for s in stages] == [0] * 5
