"""The filter audit against running every order."""

import itertools
import random
import re

from textkiln.llm import filter_audit


def plain(rows, labels):
    """Every order run document by document."""
    good, toxic = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}

    def fails(f, d, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and any(o is not None and o < d and (t or "") == text for o, t, _ in rows),
        }[f]

    failed = [(s or "", d, {f for f in "ABCDE" if fails(f, d, t or "")}) for d, t, s in rows]
    out = {}
    for part in {p for p, _, _ in failed}:
        for order in itertools.permutations("ABCDE"):
            left = [(d, f) for p, d, f in failed if p == part]
            alone = {x: sum(f == {x} for _, f in left) for x in "ABCDE"}
            every = {x: sum(x in f for _, f in left) for x in "ABCDE"}
            for step, x in enumerate(order, 1):
                gone = [d for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                out[part, "".join(order), step] = [len(left), len(gone), every[x] - len(gone), alone[x], sum(d in good for d in gone), sum(d in toxic for d in gone)]
        for x in "ABCDE":
            cells = [k for k in out if k[0] == part and k[1][k[2] - 1] == x]
            total = sum(out[k][1] for k in cells)
            for k in cells:
                out[k].append(total)
    return out


def collected(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in rows}
    assert len(out) == len(rows)
    return out


def make(n=150):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        words = [rng.choice(["one", "Two", "THREE", "four", "$5", "Six", "seven\t", "é\x1cx", "nine\n"][: rng.choice([1, 4, 9])]) + str(rng.randrange(rng.choice([2, 90]))) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(words), rng.choice(["a", "b", None, ""])))
    rows += [(1000 + i, rows[i % 5][1], "a") for i in range(40)] + [rows[3], (3, "other", "b"), (None, rows[1][1], "b"), (None, None, None), (2000, None, "a"), (2001, "", "b")]
    return rows, [(i, i % 2, i % 3 == 0) for i in range(0, 1100, 2)] + [(4, 0, 1), (None, 1, 1), (-9, 1, 1), (6, None, None)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, source string, part int, k1 int")
    return docs, spark.createDataFrame([(d, q, int(t) if t is not None else None) for d, q, t in labels], "doc_id long, quality int, toxic int")


def test_audit_against_running_every_order(spark):
    rows, labels = make()
    assert collected(filter_audit.audit_documents(*frames(spark, rows, labels))) == plain(rows, labels)


def test_many_groups_of_copies_are_not_broadcast(spark, monkeypatch):
    rows, labels = make(60)
    whole = collected(filter_audit.audit_documents(*frames(spark, rows, labels)))
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", 2)
    for share, hot in ((1000, 10), (1000, 10_000)):
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        monkeypatch.setattr(filter_audit, "HOT_ROWS", hot)
        assert collected(filter_audit.audit_documents(*frames(spark, rows, labels))) == whole


def test_more_parts_than_a_task_holds(spark, monkeypatch):
    rows = [(i, f"text {i % 7}", f"part{i % 90}") for i in range(400)]
    whole = plain([r for r in rows], [])
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 8)
    assert collected(filter_audit.audit_documents(*frames(spark, rows, [(1, 1, 0)]))).keys() == whole.keys()


def test_empty_tables_and_very_long_texts(spark):
    assert filter_audit.audit_documents(*frames(spark, [], [])).collect() == []
    got = collected(filter_audit.audit_documents(*frames(spark, [(1, "word " * 700_000 + "é", "s")], [])))
    assert got["s", "ABCDE", 2][:2] == [0, 1] and got["s", "ABCDE", 1][:2] == [1, 0]


def test_the_table_names_the_first_failure():
    table = filter_audit.first_failures()
    assert table.shape == (32, 120)
    for mask in range(32):
        failing = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        for o, order in enumerate(filter_audit.ORDERS):
            assert table[mask, o] == next((i for i, f in enumerate(order) if f in failing), 5)
