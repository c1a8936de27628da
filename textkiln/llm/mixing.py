"""Temperature mixing of sources, realised as budgeted block permutations.

The weight of a source is its token share to the power of an exponent between
0 (all equal) and 1 (as they are), normalised. The exponent is bisected to the
flattest mixture in which no source is repeated more than a limit, or to a
target entropy.

A source gets its weight's part of the token budget. Its documents are dealt
by hash into blocks; each epoch goes through the blocks in another order and
the budget ends inside one block, so only that block's documents are summed up
one by one. No step orders a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import reliable

#: Most times that a source is gone through.
MAX_EPOCHS = 1.5
#: A source has as many blocks as the root of its documents, so that neither
#: the list of blocks nor a block grows with the whole source; at most this many.
MAX_BLOCKS = 4096
#: Tables of at most so many narrow rows are broadcast.
BROADCAST_ROWS = 200_000
SEED = 17
NO_SOURCE = "\x00none"


def shares_to(exponent: float, tokens: dict[str, float]) -> dict[str, float]:
    total = sum(tokens.values())
    raw = {s: (t / total) ** exponent if t else 0.0 for s, t in tokens.items()}
    norm = sum(raw.values())
    return {s: w / norm for s, w in raw.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def full_budget(weights: dict[str, float], tokens: dict[str, float]) -> float:
    """Least budget under which every document is used at least once."""
    return max((tokens[s] / w for s, w in weights.items() if w > 0), default=0.0)


def epochs(weights: dict[str, float], tokens: dict[str, float], budget: float | None = None) -> dict[str, float]:
    budget = full_budget(weights, tokens) if budget is None else budget
    return {s: budget * w / tokens[s] if tokens[s] else 0.0 for s, w in weights.items()}


def bisect_exponent(tokens: dict[str, float], max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None, budget: float | None = None, steps: int = 60) -> float:
    """The least exponent (flattest mixture) within the repetition limit, or the
    one whose entropy is the target. Both fall as the exponent grows."""

    def too_flat(x: float) -> bool:
        weights = shares_to(x, tokens)
        if target_entropy is not None:
            return entropy(weights) > target_entropy
        return max(epochs(weights, tokens, budget).values(), default=0.0) > max_epochs

    if not any(tokens.values()) or not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    if too_flat(high):
        return 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def token_count(text):
    """Tokens of a text, as a column: its words, and one for the end."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", 1).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+")) + 1).cast("long")


def _keyed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The columns of ``docs`` by number, so that no name can clash, and the key
    by which a document is dealt: a hash of its id and text. Also the text."""
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*at.values())
    source = F.coalesce(F.col(at["source"]).cast("string"), F.lit(NO_SOURCE))
    return rows.withColumn("__source", source).withColumn("__key", F.xxhash64(F.lit(SEED), at["doc_id"], at["text"])), F.col(at["text"])


def source_tokens(narrow: DataFrame) -> dict[str, tuple[float, int]]:
    """Tokens and documents by source: as many numbers as there are sources."""
    rows = narrow.groupBy("__source").agg(F.sum("__tokens").alias("t"), F.count("*").alias("n")).collect()
    return {r["__source"]: (float(r["t"]), r["n"]) for r in rows}


def mixture(tokens: dict[str, float], max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None, budget: float | None = None) -> dict:
    """Exponent, weights, budget and epochs for the token totals of sources."""
    x = bisect_exponent(tokens, max_epochs, target_entropy, budget)
    weights = shares_to(x, tokens) if tokens else {}
    total = full_budget(weights, tokens) if budget is None else float(budget)
    return {"exponent": x, "weights": weights, "budget": total, "epochs": epochs(weights, tokens, total)}


def _schedule(narrow: DataFrame, totals: dict[str, tuple[float, int]], mixed: dict) -> tuple[DataFrame, DataFrame]:
    """``dim``: blocks of each source. ``schedule``: for each source, block and
    epoch its place in the epoch and the largest key that is still used."""
    spark = narrow.sparkSession
    rows = []
    for s, (t, n) in totals.items():
        e = mixed["epochs"][s]
        whole = int(math.floor(e + 1e-9))
        rows.append((s, max(1, min(MAX_BLOCKS, math.isqrt(n))), whole, max(0.0, e - whole) * t, mixed["weights"][s]))
    dim = spark.createDataFrame(rows, "__source string, __blocks int, __whole int, __rest double, __weight double")
    dealt = narrow.join(bounded(dim, len(rows)), "__source").withColumn("__block", _block())
    blocks = dealt.groupBy("__source", "__block", "__whole", "__rest").agg(F.sum("__tokens").alias("__t"))
    turns = reliable(blocks.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__whole")))))
    order = Window.partitionBy("__source", "__epoch").orderBy(F.xxhash64(F.lit(SEED), "__epoch", "__source", "__block"), "__block")
    turns = turns.withColumn("__slot", F.row_number().over(order)).withColumn("__before", F.sum("__t").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__t"))
    room = F.when(F.col("__epoch") < F.col("__whole"), F.lit(float("inf"))).otherwise(F.col("__rest") - F.col("__before"))
    turns = turns.withColumn("__room", room).where("__room > 0")
    # one block of a source at most is cut: only its documents are added up one by one
    cut = turns.where("__room < __t").select("__source", "__block", "__room")
    inside = Window.partitionBy("__source", "__block").orderBy("__key").rangeBetween(Window.unboundedPreceding, 0)
    edge = dealt.select("__source", "__block", "__key", "__tokens").join(bounded(cut, len(rows)), ["__source", "__block"])
    edge = edge.withColumn("__upto", F.sum("__tokens").over(inside)).where("__upto <= __room").groupBy("__source", "__block").agg(F.max("__key").alias("__last"))
    turns = turns.join(bounded(edge, len(rows)), ["__source", "__block"], "left")
    last = F.when(F.col("__room") >= F.col("__t"), F.lit(2**63 - 1)).otherwise(F.col("__last"))
    return dim, reliable(turns.select("__source", "__block", "__epoch", "__slot", last.alias("__last")).where("__last IS NOT NULL"))


def _block():
    return F.pmod(F.col("__key"), F.col("__blocks")).cast("int")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only a table known to have few rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def realise(docs: DataFrame, max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """The mixture's rows: the columns of ``docs``, then ``__source``,
    ``__weight``, ``__epoch`` (from 0) and ``__slot`` (the block's place in its
    epoch). Sorting a source's rows by epoch, slot and key gives its sequence."""
    rows, text = _keyed(docs)
    narrow = reliable(rows.select("__source", "__key", token_count(text).alias("__tokens")))
    totals = source_tokens(narrow)
    if not totals:
        return docs.select("*", *[F.lit(None).cast(k).alias(c) for c, k in (("__source", "string"), ("__weight", "double"), ("__epoch", "int"), ("__slot", "int"))])
    mixed = mixture({s: t for s, (t, _) in totals.items()}, max_epochs, target_entropy, budget)
    dim, schedule = _schedule(narrow, totals, mixed)
    rows = rows.join(bounded(dim, len(totals)), "__source").withColumn("__block", _block())
    # a source has at most MAX_BLOCKS blocks, each in few epochs
    size = sum(min(MAX_BLOCKS, math.isqrt(n) + 1) * (int(mixed["epochs"][s]) + 1) for s, (_, n) in totals.items())
    used = rows.join(bounded(schedule, size), ["__source", "__block"]).where("__key <= __last")
    return used.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], "__source", "__weight", "__epoch", "__slot")


def mix(docs: DataFrame, max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """The rows of ``docs`` as the mixture uses them: same columns, each row as
    often as its source's epochs say.

    Without a ``budget`` the budget is the least one that uses every document,
    so nothing is lost: sources are repeated in whole epochs and a last part of
    an epoch. Null sources are one source of their own. Null and empty texts
    count one token, for the end. Repeated rows are rows of their own and are
    used alike. Of documents with equal keys (equal id and text) all or none are
    used in a cut epoch. Texts of any length count whole. An empty table gives
    no rows. Other columns stay as they are, whatever their names.
    """
    names = docs.columns
    used = realise(docs, max_epochs, target_entropy, budget)
    # by place: a column may be named as one of the mixture's
    return used.toDF(*[f"c{i}" for i in range(len(used.columns))]).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
