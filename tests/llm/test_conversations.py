"""Conversation repair and reply trees against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from textkiln.llm import chat_trees, conversation_repair as repair

TURNS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def every_repair(rows):
    """All ways to edit ``(role, text, fault)`` rows, with up to two insertions
    in a gap: the cheapest, then the least letters."""
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    best = None
    for picks in itertools.product(*[("K", "D", "u", "a")] * len(rows)):
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            cost, letters, roles, out = 0, "", "", []
            for i, gap in enumerate(filled):
                cost, letters, roles = cost + 5 * len(gap), letters + "I" * len(gap), roles + "".join(gap)
                out += [({"u": "user", "a": "assistant"}[x], "") for x in gap]
                if i == len(rows):
                    break
                (role, text, fault), pick = rows[i], picks[i]
                if pick == "D":
                    cost, letters = cost + 2, letters + "D"
                    continue
                cost += (fault in ("blank", "duplicate")) * 10**6 + 5 * (fault == "truncated") + (pick != "K")
                letters += "K" if pick == "K" else "R"
                roles += (role[:1] or "?") if pick == "K" else pick
                out.append((role if pick == "K" else {"u": "user", "a": "assistant"}[pick], text))
            if GRAMMAR.match(roles) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if lot == 1:
            text = ""
        if lot == 2:
            text = re.sub("[.!?]", "", text)
        if lot == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    return out


def plain_report(rows):
    """The report by brute force, for tables of short conversations."""
    late = damaged(rows)
    report = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in late if r[0] == conv), key=lambda r: (r[0] is not None, r))
        seen, faults = set(), []
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = every_repair([(r, t, f) for (_, r, t), f in zip(own, faults)])
        report[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return report


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def some_turns(rng, convs, longest):
    texts = ["Yes.", "No!", "cut", " \t", "", None, "Why? ", "é…"]
    roles = ["user", "assistant", "system", "tool", "", None, "used"]
    return [(c, rng.choice([t, t, t, t // 2, None]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts)) for c in convs for t in range(rng.randrange(1, longest + 1))]


def test_repairs_are_the_cheapest(spark):
    rng = random.Random(5)
    rows = some_turns(rng, [*range(60), None], 3)
    rows = [r for r in rows if sum(x[0] == r[0] for x in damaged(rows)) <= 3]
    got = collected(repair.repair(repair.damage(spark.createDataFrame(rows, TURNS))))
    assert got == plain_report(rows)


def test_long_conversations_are_cut_and_the_result_is_the_same(spark):
    rng = random.Random(6)
    rows = some_turns(rng, range(12), 40) + [(None, i, "user" if i % 3 else "assistant", f"t{i % 50}.") for i in range(120)]
    turns = repair.damage(spark.createDataFrame(rows, TURNS))
    whole = collected(repair.repair(turns))
    assert len(whole) == 13
    for cut in (1, 7, 32):
        assert collected(repair.repair(turns, long_rows=cut)) == whole


def test_the_program_over_buckets_is_that_over_single_conversations():
    rng = np.random.default_rng(3)
    codes = [rng.choice(16, size=n) for n in (0, 1, 2, 3, 9, 30, 31, 64)]
    alone = [repair.edits([c])[0] for c in codes]
    for (costs, audit, _), (costs_, audit_, _) in zip(repair.edits(codes), alone):
        assert (costs == costs_).all() and audit == audit_


def test_repair_of_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.repair(repair.damage(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = collected(repair.repair(repair.damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS))))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    clash = spark.createDataFrame([(1, 0, "user", "x. " * 400_000, 1, 2, 3, 4), (1, 1, "assistant", "Yes.", 1, 2, 3, 4)], TURNS + ", key int, n int, place int, fault int")
    assert collected(repair.repair(clash))[1][5:7] == (0, "KK")


# --- reply trees --------------------------------------------------------------

NODES = "tree long, node long, parent long, role string, text string, score double"


def plain_paths(rows, top):
    """Chosen branches by walking up from every leaf."""
    nodes = {}
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        if r[1] is not None:
            nodes.setdefault(r[1], r)
    up = {n: r[2] if r[2] != n and r[2] in nodes and nodes[r[2]][0] == r[0] else None for n, r in nodes.items()}
    branches = {}
    for leaf in set(nodes) - set(up.values()):
        path, n = [], leaf
        while n is not None and n not in path:
            path.append(n)
            n = up[n]
        if n is None:
            mean = sum(nodes[x][5] or 0.0 for x in path) / len(path)
            branches.setdefault(nodes[leaf][0], []).append((-mean, leaf, path[::-1]))
    return {leaf: (tree, i + 1, path) for tree, found in branches.items() for i, (_, leaf, path) in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize("top", [1, 3])
def test_best_paths_against_walking_up(spark, top):
    rng = random.Random(top)
    rows = []
    for tree in [0, 1, 2, None]:
        base = 100 * (tree if tree is not None else 9)
        for i in range(40):
            parent = rng.choice([None, base + i, base + 70, 5, *[base + j for j in range(max(0, i - 6), i)] * 2])
            rows.append((tree, base + i, parent, "user", "x", rng.choice([None, 0.25, 0.5, 1.0])))
    rows += [(3, 301, 302, "a", "", 1.0), (3, 302, 301, "a", "", 1.0), (3, 303, 302, "a", "", 1.0)]  # a circle and what hangs on it
    rows += [rows[5], (4, None, 1, "user", "lost", 1.0)]
    rows += [(5, 500 + i, 499 + i if i else None, "user", f"{i}", 0.5) for i in range(37)] + [(6, 600 + i, 600 if i else None, "user", "", 0.125 * (i % 4)) for i in range(30)]
    got = {}
    for r in chat_trees.best_paths(spark.createDataFrame(rows, NODES), top).collect():
        got.setdefault((r["path"], r["tree"], r["rank"]), []).append((r["position"], r["node"]))
    got = {k[0]: (k[1], k[2], [n for _, n in sorted(v)]) for k, v in got.items()}
    assert got == plain_paths(rows, top)


def test_template_is_reversible():
    pieces = [*chat_trees.CONTROLS, "\\", "<", "[", "|", "x", "\n", "é", "</", "s>", "INST]"]
    rng = random.Random(8)
    for _ in range(5000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(8)))
        made = chat_trees._ESCAPED.sub(lambda m: (m[1] or m[4]) + "\\" + (m[2] or m[5] or "") + (m[3] or m[6]), text)
        assert chat_trees.unescape(made) == text
        assert not any(c in made for c in chat_trees.CONTROLS)


def test_formatted_conversations_are_read_back(spark):
    rng = random.Random(4)
    pieces = [*chat_trees.CONTROLS, "\\", "\n", "so ", "<\\s>", "é"]
    say = lambda: "".join(rng.choice(pieces) for _ in range(6))
    rows = [(c, rng.choice([t, None]), rng.choice(["user", "assistant", None, "a\nb\\n", "<s>"]), rng.choice([say(), None, ""])) for c in [*range(12), None] for t in range(9)]
    rows += [(50, t, "assistant", "word " * 1000) for t in range(40)] + [(51, 0, "user", "very long " * 200_000)]
    for part in (chat_trees.PART_CHARS, 300):
        formatted = chat_trees.format_trees(chat_trees.reply_chains(spark.createDataFrame(rows, TURNS)), part_chars=part)
        got = {r["tree"]: r for r in chat_trees.read_back(formatted).collect()}
        assert set(got) == {r[0] for r in rows}
        for conv, r in got.items():
            own = sorted((x[1:] for x in rows if x[0] == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[1] is not None, x[2] or "", x[2] is not None))
            said = "".join(t or "" for _, role, t in own if role == "assistant")
            turns = "".join(f"{role or ''}\n{t or ''}\n" for _, role, t in own)
            assert (r["n_turns"], r["loss_chars"]) == (len(own), len(said))
            assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest() and r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    lengths = formatted.selectExpr("path", "length(text) AS n", "part").collect()
    assert max(r["part"] for r in lengths) >= 39


def test_trees_of_an_empty_table(spark):
    none = spark.createDataFrame([], TURNS)
    assert chat_trees.read_back(chat_trees.format_trees(chat_trees.reply_chains(none))).collect() == []
