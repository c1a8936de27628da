"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import HOT_ROWS, HOT_SHARE, counted, few, join_counted, reliable

_PAIR = "hi long, lo long"
#: Links of a task, about.
TASK_LINKS = 100_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links ``a - b`` and the least node of each one's component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    half = len(a)
    for x, y in zip(flat[:half].tolist(), flat[half:].tolist()):
        x, y = root(x), root(y)
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y
    return nodes, nodes[[root(i) for i in range(len(nodes))]]


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root``, the least place each place is joined to, with links added."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def spanning(rep: np.ndarray, root: np.ndarray) -> pa.Table | None:
    """Links ``(a, b)`` from the ids of joined places to those of their least ones."""
    far = np.flatnonzero(root != np.arange(len(root)))
    return pa.table({"a": rep[root[far]], "b": rep[far]}) if len(far) else None


def _contract(batches):
    """Links become stars around the roots of their local components, so many
    links of a task at a time as a bound allows."""
    held, n = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        n += batch.num_rows
        if n >= TASK_LINKS:
            yield _stars(held)
            held, n = [], 0
    if n:
        yield _stars(held)


def _stars(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    nodes, roots = union_find(*map(np.concatenate, zip(*held)))
    far = nodes != roots
    return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], names=["hi", "lo"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link to another node.

    ``component`` is the least node reachable. Links are first contracted by a
    union-find inside each task, then alternating large-star and small-star
    rounds join what lies in different tasks. They end when every node is a least
    one or has one link, to a lesser one: the first step of a round counts the
    others. Aggregates are combined before their shuffle and joins broadcast the
    few nodes that hold many links, so a node with many links is no hot key. Links
    with a null end and self links are ignored; no links give no rows.
    """
    pairs = links.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))
    )
    now, seen = counted(pairs.mapInArrow(_contract, _PAIR).distinct())
    for _ in range(max_rounds):
        n = seen["rows"]
        now = few(now, n, TASK_LINKS)
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        ends = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("far"), F.count("*").alias("n"))
        loose = F.expr("count_if(m < u AND (far > u OR n > 1))")
        least, found = counted(few(ends, 2 * n, TASK_LINKS), loose=loose, most=F.max("n"))
        if not found["loose"]:
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        least, most = least.select("u", F.least("u", "m").alias("m"), "n"), found["most"]
        large = few(join_counted(both.where("v > u"), least, "u", 2 * n, most), n, TASK_LINKS).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = few(large.distinct(), n, TASK_LINKS)
        if most > max(HOT_ROWS, n // HOT_SHARE):  # else read by a short plan
            large = reliable(large)
        # no node has more lesser neighbours now than it had neighbours
        floor = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
        small = few(join_counted(large, floor, "hi", n, most), n, TASK_LINKS)
        kept, moved = F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = F.explode(F.when(F.col("lo") > F.col("m"), F.array(kept, moved)).otherwise(F.array(kept)))
        now, seen = counted(few(small.select(after.alias("p")).select("p.*").distinct(), 2 * n, TASK_LINKS))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
