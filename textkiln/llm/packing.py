"""Best-fit packing of tokenized documents, with certified bin counts.

Documents are tokenized where they lie; from there on only piece lengths move.
Pieces of full length are sequences already. The rest is dealt over partitions
of bounded size, each packed best-fit decreasing. Lower bounds from
dual-feasible functions certify a partition whose bins they meet, and the whole
packing where the sum of the bins meets the bound of all lengths together. As
long as there is a gap, the unfilled bins of partitions with gaps (of all
partitions, where each is certified but not the whole) are dealt anew so that
documents of different partitions meet, and are packed again, in several orders
near the decreasing one; a new packing is taken only where it needs fewer
sequences. Exchanges end with the gap, or when several in turn gained nothing:
the least number itself is a hard problem.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_groups, map_texts, need_columns, reliable

CAPACITY = 1024
END_ID = 2
#: Items of a partition, about; exchanges without a gain that end the packing;
#: and orders in which a partition with a gap is packed.
PART_ITEMS, PATIENCE, ORDERS = 50_000, 3, 6

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Runs of blanks over which the ranks' coder runs out of stack.
_BLANK_RUN = re.compile(r"\s{2000}")


@lru_cache(maxsize=2)
def _file_coder(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(f"{name}.json"))


@lru_cache(maxsize=2)
def _rank_coder(name: str):
    """The same vocabulary and special tokens, several times faster."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    special = {t.content: i for i, t in _file_coder(name).get_added_tokens_decoder().items()}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(text: str, name: str = "byte_bpe_50k") -> list[int]:
    """Token ids of a text, those of the tokenizer file without added ones; the
    string of a special token in a text is that token.

    The ranks' coder gives the same ids. It cannot take very long runs of
    blanks; texts with such a run take the file's coder.
    """
    if _BLANK_RUN.search(text):
        return _file_coder(name).encode(text, add_special_tokens=False).ids
    return _rank_coder(name).encode(text, allowed_special="all")


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _tokenize(name: str, capacity: int):
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = array("I", encode(text or "", name))
            ids.append(END_ID)
            view = memoryview(ids).cast("B")
            width = ids.itemsize
            for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                rows.append((doc_id, piece, start, length, zlib.crc32(view[start * width : (start + length) * width])))
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return fn


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. Bins are found by their room: a bit mask of
    the rooms in use gives the tightest fit in constant time."""
    order = np.argsort(-sizes, kind="stable") if order is None else order
    bins = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0
    for i in order.tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offset[i] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offset


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins possible for the sizes."""
    return bound_of_counts(np.bincount(sizes, minlength=capacity + 1)[: capacity + 1], capacity) if len(sizes) else 0


def bound_of_counts(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """The same from how often each size occurs, by two families of
    dual-feasible functions.

    Each function turns sizes into weights of which no bin can hold more than
    ``capacity``: the thresholds of Martello and Toth, and the steps of Fekete
    and Schepers.
    """
    count = count.astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    total = int((count * x).sum())
    best = -(-total // capacity)
    mass = np.cumsum(count * x)
    many = np.cumsum(count)
    for low in range(0, capacity // 2 + 1):
        # over capacity - low: a whole bin; under low: nothing
        large = int(many[capacity] - many[capacity - low])
        middle = int(mass[capacity - low] - (mass[low - 1] if low else 0))
        best = max(best, -(-(large * capacity + middle) // capacity))
    for k in range(1, 60):
        scaled = (k + 1) * x
        weight = np.where(scaled % capacity == 0, k * x, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    return best


_PACKED = "uid long, length long, bin long, offset long, fill long, gap long"


def fewest(sizes: np.ndarray, capacity: int, orders: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bins, offsets and bound of the best of several packings; the first is
    best-fit decreasing, the others let sizes that are near change places."""
    bound = lower_bound(sizes, capacity)
    rng = np.random.default_rng(seed)
    bins, offset = best_fit_decreasing(sizes, capacity)
    for i in range(1, orders):
        if bins.max() + 1 <= bound:
            break
        shaken = sizes * (1 + 0.03 * i * rng.random(len(sizes)))
        other = best_fit_decreasing(sizes, capacity, np.argsort(-shaken, kind="stable"))
        if other[0].max() < bins.max():
            bins, offset = other
    return bins, offset, bound


def _pack(capacity: int, orders: int, seed: int):
    """Pack one partition; the bin's name is the least uid that it holds."""

    def fn(group: pa.Table) -> pa.Table:
        uid, sizes = group.column("uid").to_numpy(), group.column("length").to_numpy()
        order = np.argsort(uid, kind="stable")
        uid, sizes = uid[order], sizes[order]
        bins, offset, bound = fewest(sizes, capacity, orders, seed)
        made = int(bins.max()) + 1
        old = len(np.unique(group.column("bin").to_numpy())) if "bin" in group.column_names else None
        if old is not None and old <= made:
            index = {c: group.column(c).to_numpy()[order] for c in ("bin", "offset", "fill")}
            name, offset, fill, made = index["bin"], index["offset"], index["fill"], old
        else:
            name = np.full(made, np.iinfo(np.int64).max)
            np.minimum.at(name, bins, uid)
            fill = np.bincount(bins, sizes, made).astype(np.int64)[bins]
            name = name[bins]
        return pa.table({"uid": uid, "length": sizes, "bin": name, "offset": offset, "fill": fill, "gap": np.full(len(uid), made - bound)})

    return fn


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, part_items: int = PART_ITEMS, patience: int = PATIENCE, orders: int = ORDERS) -> DataFrame:
    """``(uid, bin, offset)`` for rows ``(uid, length)``, each shorter than a sequence.

    In an exchange full bins stay, and so do those of certified partitions
    while others have gaps. The rest is dealt again, whole bins together and
    with as many full ones, into as few partitions as the bound on a
    partition's items allows.
    """
    items = pieces.select("uid", "length")
    # at most as many rows as there are lengths
    count = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").agg(F.count("*").alias("n")).collect():
        count[r["length"]] = r["n"]
    bound = bound_of_counts(count, capacity)
    parts = max(1, -(-int(count.sum()) // part_items))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)))
    done, best, idle, turn, made = None, None, 0, 0, 0
    while True:
        packed = reliable(map_groups(dealt, ["part"], _pack(capacity, orders, turn), _PACKED, parts=min(parts, 10_000)))
        bins = packed.groupBy("bin").agg(F.first("fill").alias("fill"), F.first("gap").alias("gap"))
        seen = bins.agg(F.count("*").alias("n"), F.count_if(F.col("gap") > 0).alias("gap"), F.count_if(F.col("fill") < capacity).alias("open")).first()
        now = made + seen["n"]
        idle = 0 if best is None or now < best else idle + 1
        best = now
        ended = now <= bound or idle > patience or not seen["open"]
        if ended:
            stays = F.lit(True)
        else:
            # full bins that go along, about as many as are not full, lend their items
            lent = F.pmod(F.xxhash64("bin", F.lit(-turn)), F.lit(max(1, seen["n"] // max(seen["open"], 1)))) == 0
            stays = (F.col("fill") == capacity) & ~lent
            if seen["gap"]:
                stays = stays | (F.col("gap") <= 0)
        rows = packed.where(stays).select("uid", "bin", "offset")
        done = rows if done is None else done.union(rows)
        if ended:
            return done
        made += bins.where(stays).count()
        left = packed.where(~stays)
        turn += 1
        parts = max(1, -(-left.count() // part_items))
        dealt = left.select("uid", "length", "bin", "offset", "fill", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(parts)).alias("part"))


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary_name: str = "byte_bpe_50k") -> DataFrame:
    """One row per piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    A document is its token ids and an end id. Only one longer than a sequence
    is cut, into full pieces but for the first, which takes the rest. Null and
    empty texts are the end id alone. Every row is packed, repeated rows and
    ids too; a null ``doc_id`` stays null. An empty table gives no rows; other
    columns are ignored.
    """
    texts = need_columns(docs, doc_id="long", text="string")
    made = reliable(map_texts(texts, "text", _tokenize(vocabulary_name, capacity), _PIECES))
    pieces = made.withColumn("uid", F.monotonically_increasing_id())  # of files that no longer change
    packed = pack_pieces(pieces.where(F.col("length") < capacity), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(*columns, F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity).join(packed, "uid").select(*columns, F.col("bin").alias("sequence_id"), "offset")
    return full.union(rest)
