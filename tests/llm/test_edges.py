"""Names that clash, very long texts and extreme values, for each operator."""

import numpy as np
from pyspark.sql import functions as F

from textkiln.llm import components, embedding_dedup, frames, line_dedup, mixing, neardup, packing, quality_rules, secret_scan, url_filter

NAMES = "__id __n __gone __key __source __kept id place lost hot c0 row n key grp node".split()


def table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for i, name in enumerate(NAMES):
        docs = docs.withColumn(name, F.lit(i))
    return docs


def extra_columns_are_kept(out, docs):
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[name] == i for r in rows for i, name in enumerate(NAMES))
    return sorted((r["doc_id"] for r in rows), key=lambda d: (d is None, d))


def test_names_never_clash(spark):
    line = "a line of more than forty code points, shared by several"
    rows = [(i, f"{line}\n" + " ".join(f"own{i}x{j}" for j in range(12)), "s", "en") for i in range(6)] + [(9, "a b c d e f g h", "s", "en"), (9, "a b c d e f g h", None, None), (None, None, None, None), (8, "A b c d e f g h", "t", "en")]
    docs = table(spark, rows)
    assert extra_columns_are_kept(neardup.keep_one(docs), docs) == [0, 1, 2, 3, 4, 5, 8, None]
    dropped = line_dedup.dedup_lines(docs)
    assert extra_columns_are_kept(dropped, docs) == [0, 1, 2, 3, 4, 5, 8, 9, 9, None]
    assert sum(line in (r["text"] or "") for r in dropped.collect()) == 1
    assert set(extra_columns_are_kept(mixing.mix(docs), docs)) == {0, 1, 2, 3, 4, 5, 8, 9, None}
    assert extra_columns_are_kept(quality_rules.keep_good(docs), docs) == []
    assert secret_scan.scan(docs).count() == len(rows) and packing.pack(docs).count() == len(rows)


def test_very_long_texts(spark):
    long = "word%d " * 4 % (1, 2, 3, 4) + " ".join(f"w{i}" for i in range(700_000))
    docs = table(spark, [(1, long, "s", "en"), (2, long + " end", "s", "en"), (3, "short", "s", "en")])
    assert sorted(r["doc_id"] for r in neardup.keep_one(docs).collect()) == [1, 3]
    assert line_dedup.dedup_lines(docs).count() == 3
    assert [r["doc_id"] for r in quality_rules.keep_good(docs).collect()] == [1, 2]
    assert mixing.mix(docs).count() == 3
    pieces = packing.pack(docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("k")).collect()
    assert all(r["k"] == -(-r["n"] // 1024) for r in pieces)
    assert secret_scan.scan(docs).where("spans = ''").count() == 3


def test_extreme_vectors_and_text_labels(spark):
    rows = [(1, "a", [1e200, 1e200]), (2, "a", [1e200, 1e200]), (3, "a", [1e-200, 1e-200]), (4, "b", [1.0, 1.0]), (5, "a", [1.0, -1.0]), (6, None, [1.0, 1.0]), (7, "a", [0.0, -0.0]), (8, "a", [float("nan"), 1.0]), (9, "a", [1.0, None]), (10, "a", None), (11, "a", [])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), **{i: (0, i) for i in range(4, 12)}}


def test_cosine_at_the_threshold_is_decided_alike():
    a = np.array([[1.0, 0.0], [0.6, 0.8], [0.8, 0.6]])
    both = embedding_dedup.near(a, a, 0.6)
    assert both.all() and (embedding_dedup.near(a, a, 0.96) == np.array([[1, 0, 0], [0, 1, 1], [0, 1, 1]], bool)).all()


def test_many_letters_in_rules(spark):
    letters = [chr(0x4E00 + i) for i in range(300)]
    globs = tuple(("block", f"*{c}/**") for c in letters)
    got = url_filter.judge([f"http://x{letters[299]}/a", "http://y/a", "http://" + "z" * 100_000 + letters[7] + "/"], (), globs)
    assert [g[3] for g in got] == ["block", "allow", "block"]
    automaton = url_filter.build((), globs)
    texts = [f".a{c}/b" for c in letters]
    assert (automaton.matches(texts) == automaton.matches(texts, cells=100)).all()


def test_a_hot_key_is_joined_where_it_lies(spark):
    big = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    per_key = big.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    joined = frames.join_counted(big, per_key, "k", 60_000)
    assert joined.columns == ["k", "id", "n", "last"] and joined.count() == 60_000
    assert joined.where("k = -1 AND n = 30000 AND last = 59998").count() == 30_000


def test_a_large_star_is_one_component(spark):
    links = spark.range(1, 200_000).select((F.col("id") * 7 % 200_003 + 1).alias("a"), F.lit(0).cast("long").alias("b"))
    got = components.connected_components(links.repartition(20))
    assert got.where("component = 0").count() == links.select("a").distinct().count() + 1
