"""Near-duplicate vectors by sorted projection passes.

Every pass gives each vector a key of concatenated random hashes, the signs of
its products with random directions, and orders the vectors of a label by that
key: near vectors share long prefixes and come to stand close together. Each
vector is compared with the next ones in the order, a bounded window of them,
and the verified pairs of all passes are united.

A label of no more vectors than a window is compared whole by one pass. For any
other, the passes that find a pair at the threshold with probability ``RECALL``
are derived from its size and a sample of it, after its centre is taken off
(vectors that share a direction have like signs). Only a label that no number of
passes up to its tiles would search so well, because its vectors crowd about the
threshold, is compared whole instead, in tiles: the exact way for the rest.

The order is cut into blocks of equal length that overlap by one window, so no
pair of neighbours is lost at a cut and no task grows with the table. Equal
vectors are one row, with a count, through all passes.

What a window leaves out inside a group is made good exactly: the links of
each vector are counted against its whole component, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .components import connected_components, spanning, unite
from .frames import join_counted, map_groups, need_columns, reliable, shuffle_width

COSINE = 0.93
BITS, WINDOW = 48, 64
#: Chance that the passes over a label find a pair at the threshold.
RECALL = 0.999
#: Rows of a block of the order, of a block of a component and of a tile.
BLOCK, SQUARE, TILE = 4096, 1024, 2048
#: Rows of a label's sample, and passes that may be tried at least.
SAMPLE, LEAST_TRIED = 512, 200


def directions(dim: int, turn: int, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng([turn, dim]).normal(size=(dim, bits))


def sort_keys(units: np.ndarray, turn: int, bits: int = BITS) -> np.ndarray:
    """The signs of a pass as one number, first hash highest."""
    signs = (units @ directions(units.shape[1], turn, bits)) > 0
    return signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _units(blobs, kind: str) -> np.ndarray:
    """Vectors of length 1 in double precision, from blobs of floats or doubles.
    They are scaled by their largest component first: no square overflows."""
    v = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def near(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``a`` and ``b``, of length 1, have at least the cosine. A
    product so near to it that its rounding counts is summed exactly, so all
    callers decide a pair alike."""
    product = a @ b.T
    out = product >= cosine
    for x, y in np.argwhere(np.abs(product - cosine) < 1e-12):
        out[x, y] = math.fsum(a[x] * b[y]) >= cosine
    return out


_KEYED = "rep long, label string, dim int, vec binary, turn int, key long"
_ROWS = "vec_id long, label string, dim int, h1 long, h2 long, vec binary"


def _read(kind: str):
    """Vectors that can be linked get a hash; the others none."""

    def run(batches):
        for batch in batches:
            dims, h1, h2, blobs = [], [], [], []
            vectors = batch.column(2)
            flat = vectors.values
            known = np.asarray(flat.is_valid())
            numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # no negative zero: it equals zero
            known &= np.isfinite(numbers)
            ends = vectors.offsets.to_numpy()
            usable = np.asarray(vectors.is_valid()) & np.asarray(batch.column(1).is_valid())
            for i, ok in enumerate(usable):
                lo, hi = ends[i], ends[i + 1]
                blob = numbers[lo:hi].tobytes() if ok and known[lo:hi].all() and numbers[lo:hi].any() else None
                digest = np.frombuffer(xxh3_128_digest(blob), ">i8") if blob else (None, None)
                dims.append(int(hi - lo) if blob else None)
                h1.append(None if blob is None else int(digest[0]))
                h2.append(None if blob is None else int(digest[1]))
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(blobs, pa.binary())],
                names=["vec_id", "label", "dim", "h1", "h2", "vec"],
            )

    return run


def passes_needed(units: np.ndarray, n: int, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL, most: int = 1 << 20) -> tuple[int | None, np.ndarray]:
    """Passes over a label of ``n`` vectors, and its centre, from a sample.

    A pair at the threshold agrees in a sign with chance ``p``, by its angle
    seen from the centre. It stands in one window when it agrees in so many
    signs that few others do, which the angles of the sample tell. Others that
    are linked to a vector do not crowd it out, as they share its component.
    None where more than ``most`` passes are needed.
    """
    centre = units.mean(axis=0)
    off = units - centre
    far = np.linalg.norm(off, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = 1 - np.arccos(np.clip(np.nan_to_num(1 - (1 - cosine) / far**2, neginf=-1), -1, 1)) / np.pi
        like = 1 - np.arccos(np.clip(np.nan_to_num(off @ off.T / np.outer(far, far)), -1, 1)) / np.pi
    like[units @ units.T >= cosine] = 0
    hit, share = np.zeros(len(units)), np.ones_like(like)
    for bits in range(BITS + 1):
        crowd = n * share.sum(axis=1) / max(len(units) - 1, 1)
        hit = np.where((hit == 0) & (crowd <= window / 2), p**bits, hit)
        share *= like
    found = lambda passes: (1 - (1 - hit) ** passes).mean()
    if found(most) < recall:
        return None, centre
    low, high = 0, most
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if found(mid) >= recall else (mid, high)
    return high, centre


_PLAN = "label string, dim int, n long, tiles int, passes int, centre binary"


def _planned(cosine: float, window: int, recall: float, kind: str):
    def fn(sample: pa.Table) -> pa.Table:
        n = sample.column("n")[0].as_py()
        tiles = -(-n // TILE)
        passes, centre = passes_needed(_units(sample.column("vec").to_pylist(), kind), n, cosine, window, recall, most=max(LEAST_TRIED, tiles))
        return pa.table({
            "label": sample.column("label")[:1], "dim": sample.column("dim")[:1], "n": sample.column("n")[:1],
            "tiles": pa.array([0 if passes else tiles], pa.int32()), "passes": pa.array([passes or 0], pa.int32()),
            "centre": pa.array([centre.tobytes() if passes else None], pa.binary()),
        })

    return fn


def _keyed(kind: str):
    """One row for each pass over a vector's label."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                units = _units(some.column(3).to_pylist(), kind)
                passes = some.column(4).to_numpy()
                centres = some.column(5).to_pylist()
                for centre in {c for c in centres if c is not None}:
                    units[[c == centre for c in centres]] -= np.frombuffer(centre, np.float64)
                for turn in range(passes.max()):
                    at = np.flatnonzero(passes > turn)
                    out = some.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(out.column(i) for i in range(4)), pa.array(np.full(len(at), turn, np.int32)), pa.array(sort_keys(units[at], turn))], names=["rep", "label", "dim", "vec", "turn", "key"])

    return run


def _numbered(batches):
    """The place of each row in its sorted partition."""
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        size = batch.num_rows
        cols = [batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(size, part, np.int32)), pa.array(np.arange(n, n + size))], names=[*batch.schema.names, "part", "idx"])
        n += size


def _neighbours(window: int, cosine: float, kind: str, rows: int = 256):
    def fn(block: pa.Table) -> pa.Table | None:
        block = block.sort_by("pos")
        own = block.column("own").to_numpy(zero_copy_only=False)
        rep, group = block.column("rep").to_numpy(), np.stack([block.column(c).to_numpy() for c in ("turn", "label", "dim")], axis=1)
        blobs = block.column("vec").to_pylist()
        root = np.arange(len(rep))
        # runs of one pass, label and dimension
        cuts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1), True])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            u = _units(blobs[lo:hi], kind)
            for start in range(0, hi - lo, rows):
                x, y = np.nonzero(near(u[start : start + rows], u[start : start + rows + window], cosine))
                close = (y > x) & (y - x <= window) & own[lo + start + x]
                root = unite(root, lo + start + x[close], lo + start + y[close])
        return spanning(rep, root)

    return fn


def _pairs(cosine: float, kind: str, rows: int = 256):
    """All pairs of a tile, or of two tiles of one label."""

    def fn(block: pa.Table) -> pa.Table | None:
        i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        rep, own = (block.column(c).to_numpy() for c in ("rep", "own"))
        u = _units(block.column("vec").to_pylist(), kind)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        root = np.arange(len(rep))
        for start in range(0, len(left), rows):
            some = left[start : start + rows]
            x, y = np.nonzero(near(u[some], u[right], cosine))
            root = unite(root, some[x], right[y])
        return spanning(rep, root)

    return fn


def _count_links(cosine: float, kind: str):
    def fn(block: pa.Table) -> pa.Table:
        i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        rep, own, mult = (block.column(c).to_numpy() for c in ("rep", "own", "mult"))
        u = _units(block.column("vec").to_pylist(), kind)
        if i == j:
            link = near(u, u, cosine)
            np.fill_diagonal(link, False)
            return pa.table({"rep": rep, "n": link @ mult})
        x, y = own == i, own == j
        link = near(u[x], u[y], cosine)
        return pa.table({"rep": np.concatenate([rep[x], rep[y]]), "n": np.concatenate([link @ mult[y], link.T @ mult[x]])})

    return fn


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, window: int = WINDOW) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two rows are linked when their labels are equal and not null and their
    cosine is at least ``cosine``. Null and zero vectors, and those that hold
    null or non-finite components or have no label, are linked with nothing;
    vectors of different lengths are not linked. Equal vectors are always
    linked. A repeated row is a vector of its own with the same ``vec_id``. A
    null ``vec_id`` names no vector: such a row takes the component of its
    equals, or null. A cosine of just ``cosine`` links. Labels are compared as
    text; vectors of any length and size of components are taken. An empty
    table gives no rows; other columns are ignored, whatever their names.
    """
    single = dict(vectors.dtypes).get("embedding") == "array<float>"
    kind = "<f4" if single else "<f8"  # as they came: all passes move them
    given = need_columns(vectors, vec_id="long", label="string", embedding="array<float>" if single else "array<double>")
    rows = reliable(given.mapInArrow(_read(kind), _ROWS))
    same = ["label", "dim", "h1", "h2"]
    reps = reliable(rows.where("vec IS NOT NULL").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("vec").alias("vec")).where("rep IS NOT NULL"))
    comps = connected_components(_links(reps, cosine, recall, window, kind))
    counts = _counted(reps, comps, cosine, kind)
    named = (
        reps.drop("vec")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts.withColumnRenamed("n", "others"), "rep", "left")
        .select(*same, F.col("mult").alias("n"), F.coalesce("component", "rep").alias("comp"), (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("links"))
    )
    named = reliable(named)
    # equal vectors may be very many: their class says how many
    found = join_counted(rows.where("vec IS NOT NULL").drop("vec"), named, same, rows.count()).select("vec_id", "comp", "links")
    lone = rows.drop("vec").join(named.select(*same), same, "left_anti").select("vec_id", F.lit(None).cast("long").alias("comp"), F.lit(None).cast("long").alias("links"))
    out = found.union(lone)
    component = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _plan(reps: DataFrame, cosine: float, recall: float, window: int, kind: str) -> DataFrame:
    """How each label is searched: a row for each, with how many vectors it has."""
    sizes = reliable(reps.groupBy("label", "dim").agg(F.count("*").alias("n")))
    short = sizes.where(F.col("n") <= window + 1).select("label", "dim", "n", F.lit(0).alias("tiles"), F.lit(1).alias("passes"), F.lit(None).cast("binary").alias("centre"))
    asked = sizes.where(F.col("n") > window + 1)
    sample = join_counted(reps.select("rep", "label", "dim", "vec"), asked, ["label", "dim"], reps.count())
    sample = sample.where(F.pmod(F.xxhash64("rep", F.lit("sample")), F.col("n")) < SAMPLE)
    planned = map_groups(sample.select("label", "dim", "n", "vec"), ["label", "dim"], _planned(cosine, window, recall, kind), _PLAN)
    return reliable(short.union(planned))


def _links(reps: DataFrame, cosine: float, recall: float, window: int, kind: str) -> DataFrame:
    plan = _plan(reps, cosine, recall, window, kind)
    rows = join_counted(reps.select("rep", "label", "dim", "vec"), plan, ["label", "dim"], reps.count()).drop("n")
    tiled = (
        rows.where("tiles > 0")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("label", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "vec")
    )
    whole = map_groups(tiled, ["label", "dim", "i", "j"], _pairs(cosine, kind), "a long, b long")
    return whole.union(_passed(rows.where("tiles = 0").select("rep", "label", "dim", "vec", "passes", "centre"), cosine, window, kind))


def _passed(rows: DataFrame, cosine: float, window: int, kind: str) -> DataFrame:
    spark = rows.sparkSession
    order = ["turn", "label", "dim", "key", "rep"]
    keyed = rows.mapInArrow(_keyed(kind), _KEYED)
    dealt = keyed.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    placed = reliable(dealt.mapInArrow(_numbered, f"{_KEYED}, part int, idx long"))
    # one number for each partition, not for each row
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    start = spark.createDataFrame(before or [(0, 0)], "part int, before long")
    placed = placed.join(F.broadcast(start), "part").withColumn("pos", F.col("before") + F.col("idx"))
    size = max(BLOCK, window)
    block = F.floor(F.col("pos") / size)
    mine = placed.withColumn("block", block).withColumn("own", F.lit(True))
    # the first window of a block is compared with the end of the one before
    head = placed.where(F.pmod("pos", F.lit(size)) < window).withColumn("block", block - 1).withColumn("own", F.lit(False)).where("block >= 0")
    cols = ["block", "own", "pos", "turn", "label", "dim", "rep", "vec"]
    return map_groups(mine.select(cols).union(head.select(cols)), ["block"], _neighbours(window, cosine, kind), "a long, b long")


def _counted(reps: DataFrame, comps: DataFrame, cosine: float, kind: str) -> DataFrame:
    """Links of each representative inside its component, copies counted."""
    members = comps.join(reps, comps.node == reps.rep).select("rep", "component", "mult", "vec")
    blocks = comps.groupBy("component").agg(F.count("*").alias("n")).withColumn("nb", F.ceil(F.col("n") / SQUARE).cast("int"))
    spread = (
        join_counted(members, blocks, "component", comps.count())
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "mult", "vec")
    )
    part = map_groups(spread, ["component", "i", "j"], _count_links(cosine, kind), "rep long, n long")
    return part.groupBy("rep").agg(F.sum("n").alias("n"))
