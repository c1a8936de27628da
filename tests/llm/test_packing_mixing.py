import random
import zlib

import numpy as np
import pytest

from textkiln.llm import mixing, packing


def docs(spark, rows):
    return spark.createDataFrame([(*r, 5, "b") for r in rows], "doc_id long, text string, source string, uid int, bin string")


def test_packing_is_a_round_trip(spark):
    rng = random.Random(1)
    words = "alpha beta gamma Delta é ß 123 \n x".split(" ")
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([3, 50, 400, 2500]))), "s") for i in range(50)]
    rows += [(90, None, "s"), (91, "", "s"), (7, rows[7][1], "s"), (None, "no id", None), (92, "hello <|endoftext|> x", "s"), (93, "<|endoftext|><|endoftext|>  b \n", "s")]
    out = packing.pack(docs(spark, rows)).collect()
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))
    want = []
    for doc_id, text, _ in rows:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or min(len(ids), 1024)
        starts = [0, *range(first, len(ids), 1024)]
        want += [(doc_id or 0, p, s, e - s, zlib.crc32(ids[s:e].tobytes())) for p, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    small = np.array([w[3] for w in want if w[3] < 1024])
    full = sum(w[3] == 1024 for w in want)
    assert len(bins) - full == packing.lower_bound(small)


def test_special_tokens_and_very_long_words_and_blanks():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))
    word = "".join(random.Random(3).choices("abcdef", k=20_000))
    assert packing.encode("hello <|endoftext|> x") == [31373, 220, 50256, 2124]
    for text in (f"x {word} y", "a" + " " * 1990 + "b", "a" + " \n" * 200_000 + "b<|endoftext|>", " <|endoftext|>  x", "é" * 9000, "<|endoftext|", ""):
        assert packing.encode(text) == coder.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 2500])
def test_cuts(n):
    got = packing.cuts(n)
    assert got[0][0] == 0 and sum(length for _, length in got) == n and all(length == 1024 for _, length in got[1:])


def test_bounds_and_fit():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(1, 1025, rng.integers(1, 300))
        bins, offset = packing.best_fit_decreasing(sizes)
        fill = np.bincount(bins, sizes)
        assert fill.max() <= 1024 and packing.lower_bound(sizes) <= bins.max() + 1 <= packing.lower_bound(sizes) * 1.25 + 1
    assert packing.lower_bound(np.array([600] * 7)) == 7 and packing.lower_bound(np.array([], int)) == 0
    assert packing.lower_bound(np.array([400] * 6)) == 3


def test_exchange_closes_gaps_between_partitions(spark):
    rows = [(i, 520 if i % 2 else 504) for i in range(200)]
    df = spark.createDataFrame(rows, "uid long, length long")
    alone = packing.pack_pieces(df, part_items=10**6).select("bin").distinct().count()
    parts = packing.pack_pieces(df, part_items=40).select("bin").distinct().count()
    assert alone == 100 and parts == 100 and packing.pack_pieces(df, part_items=40).count() == 200


def test_empty_tables(spark):
    assert packing.pack(docs(spark, [])).collect() == [] and mixing.mix(docs(spark, [])).collect() == []


def mixed(spark, **options):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), "big" if i % 3 else f"s{i % 4}") for i in range(600)] + [(700, None, None), (701, "", None), (5, "same", "big"), (5, "same", "big")]
    return rows, mixing.realise(docs(spark, rows), **options).collect()


def test_mixture_against_brute_force(spark):
    rows, used = mixed(spark, max_epochs=2.5)
    tokens = {}
    for _, text, source in rows:
        tokens[source] = tokens.get(source, 0) + len((text or "").split()) + 1
    weights = {r["__source"]: r["__weight"] for r in used}
    assert sum(weights.values()) == pytest.approx(1)
    names = {s or mixing.NO_SOURCE: t for s, t in tokens.items()}
    ratio = {s: weights[s] / names[s] for s in names}
    assert max(ratio.values()) / min(ratio.values()) == pytest.approx(2.5, rel=1e-6)
    got = {}
    for r in used:
        got[r["__source"]] = got.get(r["__source"], 0) + len((r["text"] or "").split()) + 1
    budget = max(names[s] / weights[s] for s in names)
    for s in names:  # short of the budget by less than one document (or its equals)
        assert 0 <= budget * weights[s] - got[s] + 1e-6 <= 62
    whole = {(r["doc_id"], r["text"]) for r in used if r["__epoch"] == 0}
    assert whole == {(d, t) for d, t, _ in rows}  # nothing is lost
    per_epoch = {}
    for r in used:
        key = (r["__epoch"], r["doc_id"], r["text"])
        per_epoch[key] = per_epoch.get(key, 0) + 1
    assert max(per_epoch.values()) == 2 and [k for k, v in per_epoch.items() if v == 2 and k[0] == 0] == [(0, 5, "same")]


def test_target_entropy_and_budget(spark):
    tokens = {"a": 900.0, "b": 90.0, "c": 10.0}
    x = mixing.bisect_exponent(tokens, target_entropy=0.9)
    assert mixing.entropy(mixing.shares_to(x, tokens)) == pytest.approx(0.9, abs=1e-6)
    assert mixing.bisect_exponent({"a": 5.0}) == 0.0 and mixing.bisect_exponent({}) == 0.0
    _, used = mixed(spark, max_epochs=4, budget=2000)
    assert sum(len((r["text"] or "").split()) + 1 for r in used) <= 2000


def test_mix_keeps_columns_and_is_stable(spark):
    rows = [(i, f"t {i}", "a" if i % 5 else "b") for i in range(100)]
    df = docs(spark, rows)
    a, b = mixing.mix(df), mixing.mix(df.repartition(7))
    assert a.columns == df.columns
    assert sorted(r["doc_id"] for r in a.collect()) == sorted(r["doc_id"] for r in b.collect())
