import random

import numpy as np
import pytest

from textkiln.llm import components, neardup, superminhash
from textkiln.llm.shingles import shingle_set


def brute(rows, words, percent):
    """Component of each row, by comparing all pairs of word shingle sets."""

    def shingles(text):
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            if linked or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [len(s) for s in sets], [least.get(find(i)) for i in range(len(rows))]


def corpus(seed=5, groups=40):
    """Groups of near copies with changes of every size, around the threshold."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(2, 90))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((0, " ".join(copy)))
    rng.shuffle(rows)
    return [(i * 3, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("words", [2, 5])
def test_components_are_exact(spark, words):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes, comps = brute(rows, words, 80)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df, words, 80).collect()}
    assert [got[d]["n_shingles"] for d, _ in rows] == sizes
    assert [got[d]["component_id"] for d, _ in rows] == comps
    assert all(got[d]["kept"] == (d == c) for (d, _), c in zip(rows, comps))


def test_edge_rows(spark):
    same = "a b c d e f"
    rows = [(5, same), (4, "A B c\td\ne  f"), (4, "A B c\td\ne  f"), (7, None), (8, ""), (9, " \n"), (10, "one"), (11, "ONE"), (None, same), (12, "q " * 30000), (13, "q " * 30000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, keys int, n_shingles string")
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()))
    assert got == sorted([(5, 5, 4, False), (4, 5, 4, True), (4, 5, 4, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 1, 10, True), (11, 1, 10, False), (0, 5, 4, False), (12, 1, 12, True), (13, 1, 12, False)])


def test_texts_of_one_document_are_linked(spark):
    a, b, c = ("a b c d e f", "g h i j k l", "m n o p q r")
    rows = [(3, a), (5, a), (5, b), (6, b), (7, c), (7, ""), (5, None), (8, c), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect())
    assert got == sorted((d, x, d == x) for (d, _), x in zip(rows, brute(rows, 2, 80)[1]))
    assert sorted(r["doc_id"] for r in neardup.keep_one(df, 2).collect()) == [3, 7, 9]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(df).collect() == [] and neardup.keep_one(df).collect() == []


def test_keep_one_keeps_columns_and_one_row_a_group(spark):
    rows = [(1, "a b c d e f g", "s"), (2, "a b c d e f g", "t"), (1, "a b c d e f g", "s"), (3, "other words stand here now ok", "u"), (None, "x", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = neardup.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["source"]) for r in out.collect()) == [(0, "v"), (1, "s"), (3, "u")]


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df).collect()}
    assert [got[i] for i in range(60)] == brute(rows, 2, 80)[1]


def test_unrelated_members_of_a_bucket_part_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PARTED_ROWS", 3)
    monkeypatch.setattr(neardup, "MEMBER_ROWS", 4)
    rng = np.random.default_rng(2)
    sig = [rng.integers(0, 256, neardup.SLOTS, dtype=np.uint8) for _ in range(20)]
    sig[15] = sig[12].copy()  # behind twelve unrelated members
    sig[16] = np.where(np.arange(neardup.SLOTS) >= 80, sig[7], sig[16])  # two thirds of 7
    sig[18] = np.where(np.arange(neardup.SLOTS) >= 150, sig[7], sig[18])  # a third of 7
    sig[9] = sig[5].copy()  # one component already
    reps = spark.createDataFrame([(i, bytearray(s.tobytes()), [77, 1000 + i]) for i, s in enumerate(sig)], "rep long, sig binary, keys array<long>")
    near = spark.createDataFrame([(5, 5), (9, 5)], "node long, component long")
    alike = neardup._alike(neardup._stars(reps), near, reps, 0.6)
    got = {r["node"]: r["component"] for r in components.connected_components(alike).collect()}
    assert got == {7: 7, 16: 7, 12: 12, 15: 12}


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    sig = superminhash.signatures([np.unique(a), np.unique(b)], 997)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.06
    one = superminhash.signatures([a[:1]], 11)[0] >> np.uint64(32)
    assert sorted(one.tolist()) == list(range(11))  # one element's ranks are a permutation


def test_empty_set_and_short_texts():
    assert len(shingle_set(None, 2)) == len(shingle_set(" \t", 2)) == 0
    assert len(shingle_set("one", 2)) == 1 and len(shingle_set("a b a b", 2)) == 2


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    good = [(a, b) for a, b in links if a is not None and a != b]
    nodes, roots = components.union_find(*map(np.array, zip(*good)))
    assert got == dict(zip(nodes.tolist(), roots.tolist()))


def test_few_rows_take_few_jobs_and_tasks(spark):
    """However many partitions a shuffle has: the driver keeps a record of every
    task, and that broke its memory over 211 partitions."""
    rows, sc = corpus(), spark.sparkContext
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("near-dup", "few jobs")
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("near-dup")]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    tasks = sum(s.numCompletedTasks for s in stages if s)
    assert [got[d] for d, _ in rows] == brute(rows, 2, 80)[1]
    assert len(jobs) < 150 and tasks < 4500, (len(jobs), tasks)
