import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from textkiln.llm import embedding_dedup, quality_model, toxicity, url_filter


def labelled(spark, make, label, n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        y = i % 3 == 0
        rows.append((i, make(rng, y), "en", 1.0))
        labels.append((i, int(y)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, f"doc_id long, {label} int")


WORDS = ["".join(random.Random(i).choices("aeioulmnrst", k=5)) for i in range(300)]


def prose(rng, good):
    words = rng.choices(WORDS, k=rng.randrange(30, 90))
    return " ".join(words if good else [w + "***" for w in words])


def check_scores(out, parts, rest):
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == rest)


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark, prose, "quality")
    out = quality_model.score(docs, quality_model.fit(docs, labels)).collect()
    check_scores(out, 5, 0)
    held = [r for r in out if r["held_out"]]
    assert held and all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held)


def test_quality_does_not_learn_held_out_labels(spark):
    docs, labels = labelled(spark, prose, "quality", 120)
    held = quality_model.held_out(labels["doc_id"], 5, 0)
    wrong = labels.withColumn("quality", quality_model.F.when(held, 1 - labels["quality"]).otherwise(labels["quality"]))
    a, b = (quality_model.fit(docs, x) for x in (labels, wrong))
    assert np.array_equal(a.table, b.table) and a.bias == b.bias


def insult(rng, bad):
    words = rng.choices(WORDS, k=rng.randrange(30, 90))
    if bad:
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(["grobbelknar", "grobbelzan", "snivelwort"])
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark, insult, "toxic")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    check_scores(out, 4, 2)
    held = [r for r in out if r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held)
    assert right >= 0.95 * len(held)


@pytest.mark.parametrize(("module", "label"), [(quality_model, "quality"), (toxicity, "toxic")])
def test_edges(spark, module, label):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é" * 9), (4, "w " * 50000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, label string, b int")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    odd = spark.createDataFrame([(3, 1), (3, None), (None, 0), (2, 0), (99, 5)], f"doc_id long, {label} int")
    for labels in (none, odd):
        out = module.score(docs, module.fit(docs, labels)).collect()
        assert len(out) == 6 and all(math.isfinite(r["score"]) for r in out)
        by = {}
        for r in out:
            by.setdefault(r["doc_id"], set()).add(r["score"])
        assert len(by[3]) == 1
    empty = docs.limit(0)
    assert module.score(empty, module.fit(empty, none)).collect() == []


# --- vectors -----------------------------------------------------------------


def brute_vectors(rows, cosine=0.93):
    def usable(label, v):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            (a, la, u), (b, lb, v) = rows[i], rows[j]
            if la == lb and usable(la, u) and usable(lb, v) and len(u) == len(v):
                u, v = np.array(u), np.array(v)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return links, [least[find(i)] for i in range(n)]


def vector_rows(seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(25):
        base = rng.normal(size=12)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((0, int(g % 4), [float(np.float32(x)) for x in base + rng.normal(size=12) * rng.choice([0.0, 0.02, 0.25])]))
    rows += [(0, None, [1.0] * 12), (0, 1, None), (0, 1, []), (0, 1, [0.0] * 12), (0, 1, [math.nan] * 12), (0, 1, [math.inf] + [0.0] * 11), (0, 1, [1.0, None]), (0, 2, [1.0, 2.0]), (0, 2, [2.0, 4.0])]
    return [(3 * i, la, v) for i, (_, la, v) in enumerate(rows)]


def test_vectors_against_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, rep int").repartition(4)
    links, comps = brute_vectors(rows)
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df).collect()}
    assert [got[r[0]]["n_links"] for r in rows] == links
    assert [got[r[0]]["component_id"] for r in rows] == comps
    assert all(got[r[0]]["kept"] == (r[0] == c) for r, c in zip(rows, comps))


def test_many_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SQUARE", 5)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 128)
    rows = vector_rows(3) + [(5000 + i, 0, [1.0] * 12) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    links, comps = brute_vectors(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    assert [got[r[0]] for r in rows] == list(zip(links, comps))


def test_repeated_and_missing_vectors(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (None, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert embedding_dedup.near_vectors(df.limit(0)).collect() == []


def planted_pairs(n, pairs, mean, dim=64, seed=5):
    """Vectors of one direction in common and, for the first ones, a pair each at cosine 0.935."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    v = unit(np.sqrt(mean) * np.eye(1, dim) + np.sqrt(1 - mean) * unit(rng.normal(size=(n - pairs, dim))))
    off = rng.normal(size=(pairs, dim))
    off = unit(off - (off * v[:pairs]).sum(axis=1, keepdims=True) * v[:pairs])
    return np.vstack([v, 0.935 * v[:pairs] + math.sqrt(1 - 0.935**2) * off])


def linked_in(spark, v):
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(v.tolist())], "vec_id long, label int, embedding array<double>")
    return {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_vectors(df).collect()}


def compared_whole_is_an_error(monkeypatch):
    """The derived passes have to find the pairs."""

    def refuse(*_):
        def fn(block):
            raise AssertionError("a label was compared whole")

        return fn

    monkeypatch.setattr(embedding_dedup, "_pairs", refuse)


def test_passes_over_a_large_label_find_the_pairs(spark, monkeypatch):
    compared_whole_is_an_error(monkeypatch)
    n, pairs = 50_000, 400
    got = linked_in(spark, planted_pairs(n, pairs, 0.3))
    assert sum(got[n - pairs + i] == i for i in range(pairs)) >= 0.99 * pairs
    assert len(set(got.values())) >= n - pairs


def test_a_label_that_no_passes_search_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAST_TRIED", 3)
    n, pairs = 3000, 100
    got = linked_in(spark, planted_pairs(n, pairs, 0.7))
    assert [got[n - pairs + i] for i in range(pairs)] == list(range(pairs))


def test_passes_follow_from_size_and_direction(spark, monkeypatch):
    n, pairs = 6000, 300
    v = planted_pairs(n, pairs, 0.5)
    sample = v[:: n // 500]
    few, many = (embedding_dedup.passes_needed(sample, k, window=64)[0] for k in (n, 100 * n))
    raw = embedding_dedup.passes_needed(planted_pairs(n, pairs, 0.0)[:: n // 500], n, window=64)[0]
    assert raw < few < many
    assert embedding_dedup.passes_needed(sample, n, window=64, most=few - 1)[0] is None
    compared_whole_is_an_error(monkeypatch)
    got = linked_in(spark, v)
    assert sum(got[n - pairs + i] == i for i in range(pairs)) >= 0.99 * pairs


# --- urls ---------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://net/x", "http://a.net", "http://a.net/", "http://a.net?x/", "https://www.EXAMPLE.net/en/1?q#f", "http://example.net/en", "http://badexample.net/en/1",
    "http://x.example.com/de/9#t", "http://example.com/dee", "http://a.org/fr/1", "http://org/fr/", "http://spam-farm.example.org/en/1", "http://a.example.org/x/casino/1", "http://ok.example.org/ads/x",
    "ftp://h:80/p://x", "http:///path", "http://é.org/fr/é" + "x" * 3000, "http://a.org/fr\n/x", "http://a.org/x.net/y",
]


def test_urls_against_sql(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.net/"), (3, "http://net/x")]
    df = spark.createDataFrame([(*r, "h", "r") for r in rows], "page_id long, url string, html string, rule string")
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    want = sorted(map(str, db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.oracle_sql()})").fetchall()))
    assert sorted(str(tuple(r)) for r in url_filter.filter_urls(df).collect()) == want
    assert url_filter.filter_urls(df.limit(0)).collect() == []


def test_automaton_against_regular_expressions():
    import re

    rng = random.Random(4)
    globs = tuple("".join(rng.choices(["a", "b", "/", "*", "**", "?", "ab", "ba/"], k=rng.randrange(1, 7))) for _ in range(60))
    texts = ["".join(rng.choices("ab/c", k=rng.randrange(0, 12))) for _ in range(300)]
    hits = url_filter.Automaton(globs).matches(texts)
    assert url_filter.Automaton(globs).words > 1
    for g, glob in enumerate(globs):
        pattern = re.compile("(?s:" + re.sub(r"\*\*|\*|\?", lambda m: {"**": ".*", "*": "[^/]*", "?": "[^/]"}[m[0]], glob) + r")\Z")
        for t, text in enumerate(texts):
            assert hits[t, g] == bool(pattern.match(text)), (glob, text)


def test_quality_scores_against_a_plain_softmax(spark):
    import xxhash

    rng = random.Random(4)
    model = quality_model.Model(np.random.default_rng(1).normal(size=quality_model.BUCKETS).astype(np.float32), 0.3, 1.7, -0.2)
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def plain(text):
        words = [xxhash.xxh3_64_intdigest(w) for w in text.encode().split()]
        made = [w + quality_model._WORD for w in words]
        made += [mix(a + quality_model._PAIR & mask) + b for a, b in zip(words, words[1:])]
        for n in (3, 4, 5):
            for i in range(len(text) - n + 1):
                h = n
                for c in text[i : i + n]:
                    h = mix(h + ord(c) & mask)
                made.append(h)
        parts = [float(model.table[mix(h & mask) >> (64 - 17)]) for h in made]
        z = 1.7 * ((sum(parts) / len(parts) if parts else 0) + 0.3) - 0.2
        return math.exp(z) / (math.exp(0) + math.exp(z))

    texts = ["", "a", "é ü Жук жук", "one one two", "w " * 50_000, " \n", *(prose(rng, i % 2) for i in range(10))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_model.score(df, model).collect()}
    assert all(got[i] == pytest.approx(plain(t), abs=1e-5) for i, t in enumerate(texts))


def test_toxicity_scores_against_plain_compression(spark):
    import zstandard

    docs, labels = labelled(spark, insult, "toxic")
    model = toxicity.fit(docs, labels)
    assert model.toxic and b"zstd" not in model.toxic

    def size(dictionary, data):
        how = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=19, chain_log=16, hash_log=16, search_log=4, target_length=16, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(data))

    def plain(text):
        w = text.lower().split()
        cut = [" " + " ".join(w[i : i + 8]) + " " for i in range(0, len(w), 4) if i == 0 or i + 4 < len(w)]
        gains = [size(model.ordinary, model.ordinary[-40:] + c.encode()) - size(model.toxic + model.ordinary, model.ordinary[-40:] + c.encode()) for c in cut]
        best = sorted([0, 0, *gains])[::-1]
        z = model.weights[0] * best[0] + model.weights[1] * best[1] + model.weights[2] * (sum(gains) / len(gains) if gains else 0) + model.bias
        return 1 / (1 + math.exp(-z))

    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for r in docs.limit(40).collect():
        assert got[r["doc_id"]] == pytest.approx(plain(r["text"]), abs=1e-6)
