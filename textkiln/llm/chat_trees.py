"""Chat formatting of reply trees.

Messages point at the message that they answer. Iterative self-joins double the
pointers: after round ``k`` each message knows its ancestor ``2**k`` steps up
and the scores on the way, so ``log2`` of the depth rounds reach all roots.
Leaves end branches; a tree's branches are ranked by the mean score of their
messages, and only the chosen ones are enumerated, by the same pointers: with
the ancestors at all distances below ``2**k`` and the pointers of round ``k``
one join gives those below ``2**(k+1)``. A path's messages are then written as
one conversation with a mask over what an assistant says.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.operators.ranking import dense_row_number

from .frames import bound_batches, give_back, join_counted, need_columns, reliable

BEGIN, END = "<|im_start|>", "<|im_end|>"
# Control strings of public chat formats; none may stand unescaped in a text.
CONTROLS = (
    BEGIN, END, "<|endoftext|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]",
)
LEARNED = "assistant"
#: A conversation's text is cut, between turns, into parts of about so many characters.
PART_CHARS = 4 << 20


# --- the template -----------------------------------------------------------


def _slots() -> str:
    """Each control string with any backslashes behind its first character; two
    groups of three, as control strings begin with ``<`` or ``[``."""
    def tails(first):
        return "|".join(re.sub(r"([\[\]|])", r"\\\1", c[1:]) for c in CONTROLS if c[0] == first)

    return rf"(<)(\\*)({tails('<')})|(\[)(\\*)({tails('[')})"


_SLOTS = _slots()
_ESCAPED = re.compile(_SLOTS)


def escape(text: Column) -> Column:
    """One more backslash behind the first character of every control string and
    of everything that has the look of an escaped one: always reversible."""
    return F.regexp_replace(text, _SLOTS, r"$1$4\\$2$5$3$6")


def unescape(text: str) -> str:
    """Take the backslash back."""
    return _ESCAPED.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "\\")[1:] + (m[3] or m[6]), text)


def _role_line(role: Column) -> Column:
    """A role in one line: backslashes and line breaks by their signs."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def format_turn(role: Column, text: Column) -> Column:
    """``STRUCT<text, lead, said>``: a formatted turn, how many of its characters
    stand before what is said, and how many that is."""
    lead, said = F.concat(F.lit(BEGIN), _role_line(role), F.lit("\n")), escape(text)
    return F.struct(F.concat(lead, said, F.lit(f"{END}\n")).alias("text"), F.length(lead).alias("lead"), F.length(said).alias("said"))


def parse(text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of each turn of a formatted text."""
    out, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END, line)
        out.append((_role_of(text[at + len(BEGIN) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return out


# --- trees ------------------------------------------------------------------


def reply_chains(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` rows as trees without forks: each row answers
    the one before it by turn (nulls first), then role, then text."""
    rows = need_columns(conversations, conv_id="long", turn="long", role="string", text="string")
    rows = dense_row_number(rows, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "node")
    before = rows.select((F.col("node") + 1).alias("node"), F.col("conv_id").alias("of"), F.lit(True).alias("there"))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & F.col("there")
    return rows.join(before, "node", "left").select(F.col("conv_id").alias("tree"), "node", F.when(same, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _links(messages: DataFrame) -> DataFrame:
    """``(node, tree, up, score)``: one row a message; ``up`` is there only where
    it is another message of the same tree."""
    score = F.nanvl(F.coalesce("score", F.lit(0.0)), F.lit(0.0))
    rows = messages.where("node IS NOT NULL").select("node", F.struct("tree", "parent", score.alias("score")).alias("own"))
    rows = reliable(rows.groupBy("node").agg(F.min("own").alias("own")).select("node", "own.tree", F.when(F.col("own.parent") != F.col("node"), F.col("own.parent")).alias("up"), "own.score"))
    replies = rows.where("up IS NOT NULL")
    fans = replies.groupBy("up").agg(F.count("*").alias("n"))
    fans = reliable(fans.join(rows.select(F.col("node").alias("up"), F.col("tree").alias("up_tree"), F.lit(True).alias("there")), "up", "left"))
    met = join_counted(replies, fans, "up", rows.count())
    up = F.when(F.col("there") & F.col("tree").eqNullSafe(F.col("up_tree")), F.col("up"))
    return reliable(rows.where("up IS NULL").union(met.select("node", "tree", up.alias("up"), "score")))


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """``(path, tree, rank, score, node, position)``: the messages, root first, of
    the ``top`` branches of each tree. ``path`` is the branch's leaf.

    A message whose ancestors never end (a circle of answers) is on no path.
    """
    links = _links(messages)
    total = links.count()
    # total and steps: over the message itself and what is passed by the pointer
    state = links.select("node", "up", F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"))  # of written rows
    jumps = []
    while total and (1 << len(jumps)) <= 2 * total:
        going = state.where("up IS NOT NULL")
        n = going.count()
        if not n:
            break
        jumps.append(going.select("node", "up"))
        targets = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("t"), F.col("steps").alias("s"))
        per_up = going.groupBy("up").agg(F.count("*").alias("n")).join(targets, "up")
        moved = join_counted(going, per_up, "up", n).select("node", F.col("next").alias("up"), F.col("total") + F.col("t"), F.col("steps") + F.col("s"))
        state = reliable(state.where("up IS NULL").union(moved))
    ends = links.select("node", "tree").join(links.select(F.col("up").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")
    leaves = ends.join(state.where("up IS NULL"), "node").select("node", "tree", (F.col("total") / F.col("steps")).alias("score"), "steps")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = reliable(leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    found = [chosen.select(F.col("node").alias("path"), "node", F.lit(0).cast("long").alias("back"))]
    for k, jump in enumerate(jumps):
        below = found[0]
        for f in found[1:]:
            below = below.union(f)
        found.append(reliable(below.join(jump, "node").select("path", F.col("up").alias("node"), F.col("back") + (1 << k))))
    on_path = found[0]
    for f in found[1:]:
        on_path = on_path.union(f)
    known = chosen.select(F.col("node").alias("path"), "tree", "rank", "score", "steps")
    return join_counted(on_path, known.withColumn("n", F.col("steps")), "path", total * top).select("path", "tree", "rank", "score", "node", (F.col("steps") - 1 - F.col("back")).alias("position"))


_FORMATTED = "path long, tree long, rank int, part int, text string, mask array<long>"


def format_trees(messages: DataFrame, top: int = 1, part_chars: int = PART_CHARS) -> DataFrame:
    """Each tree's ``top`` branches as conversations: ``path, tree, rank, part,
    text, mask``.

    ``messages`` has ``tree, node, parent, role, text, score``; a node's number is
    its own in the whole table. ``mask`` lists starts and ends (code points of
    ``text``, end exclusive) of what assistants say. A text over ``part_chars``
    goes on in the next part, cut between turns; other conversations have part 0
    only. Rows go to the task of their path in order, and a task holds one part.

    Null roles and texts are empty, a null or NaN score is 0, a null tree a tree
    of its own. An answer to a message that is not there, or to one of another
    tree or itself, is a root. Of rows that repeat a node the least counts. Rows
    without a node, and messages in a circle of answers, are on no path. Equal
    branches rank by their leaf's number. Texts of any length are taken whole.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    bound_batches(messages.sparkSession)
    rows = need_columns(messages, tree="long", node="long", parent="long", role="string", text="string", score="double")
    empty = F.lit("")
    turns = rows.where("node IS NOT NULL").select("node", F.coalesce("role", empty).alias("role"), format_turn(F.coalesce("role", empty), F.coalesce("text", empty)).alias("turn"))
    placed = best_paths(rows, top).drop("score").join(turns, "node")
    placed = placed.repartition("path").sortWithinPartitions("path", "position", "role", "turn.text")
    placed = placed.select("path", "tree", "rank", "position", "turn.text", "turn.lead", "turn.said", (F.col("role") == LEARNED).alias("learned"))

    def run(batches):
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        for (path, tree, rank), group in groupby(rows, key=lambda r: r[:3]):
            part, held, mask, n, last = 0, [], [], 0, None
            for _, _, _, position, text, lead, said, learned in group:
                if position == last:  # a repeated node
                    continue
                if held and n + len(text) > part_chars:
                    yield _part(path, tree, rank, part, held, mask)
                    part, held, mask, n = part + 1, [], [], 0
                last = position
                held.append(text)
                if learned:
                    mask += [n + lead, n + lead + said]
                n += len(text)
            yield _part(path, tree, rank, part, held, mask)
        give_back()

    return placed.mapInArrow(run, _FORMATTED)


def _part(path, tree, rank, part, held, mask):
    cols = [pa.array([path], pa.int64()), pa.array([tree], pa.int64()), pa.array([rank], pa.int32()), pa.array([part], pa.int32()), pa.array(["".join(held)]), pa.array([mask], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cols, names=["path", "tree", "rank", "part", "text", "mask"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts of formatted conversations, by their digests:
    ``path, tree, rank, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. A conversation's parts go through its digests one by one."""
    names = ["path", "tree", "rank", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        out = []
        for (path, tree, rank), group in groupby(rows, key=lambda r: r[:3]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, _, _, text, mask in group:
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                    n_turns += 1
                for a, b in zip(mask[::2], mask[1::2]):
                    said = unescape(text[a:b])
                    loss.update(said.encode("utf-8", "replace"))
                    loss_chars += len(said)
                chars += len(text)
            out.append((path, tree, rank, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        give_back()

    dealt = formatted.repartition("path").sortWithinPartitions("path", "part").select("path", "tree", "rank", "text", "mask")
    return dealt.mapInArrow(run, "path long, tree long, rank int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def hostile(spark) -> DataFrame:
    """A conversation that says control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


def oracle_sql() -> str:
    """DuckDB SQL for what is read back of ``conversations`` and ``hostile``."""
    slots = _SLOTS.replace("'", "''")

    def escaped(c):
        return rf"regexp_replace({c}, '{slots}', '\1\4\\\2\5\3\6', 'g')"

    role = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
    marks = len(BEGIN) + len(END) + 2
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) h(turn, role)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum({marks} + length({escaped(role)}) + length({escaped('text')})) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""
