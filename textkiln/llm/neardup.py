"""Near-duplicate documents by SuperMinHash, banding and exact verification.

1. Each document becomes its set of word shingles; equal sets form one class,
   so exact copies cost one row from here on, however many there are.
2. Class representatives get a SuperMinHash signature, cut into bands. A bucket
   is a band with equal values. Every bucket pairs its members with its least
   member only: links grow with rows, not with squares.
3. Star pairs whose signatures are alike are verified on the full sets; what
   they link is one component and needs no further comparison.
4. A bucket whose other members are of several components is open. There every
   member outside the main component is compared, by signature and in blocks,
   with the members of other components. Those that are alike form groups.
5. Inside a group all pairs are verified on the full sets, in blocks of bounded
   weight: a group of any size is spread over block pairs, and a block pair
   returns only the spanning links of what it found.
6. Union-find over the verified links gives the components.

With 36 bands of 6 slots, a pair of similarity 0.8 shares no band with
probability (1 - 0.8**6)**36 = 2e-5, one of 0.85 with 4e-8. A verified pair is
one whose signatures agree in a share of ``percent`` less ``MARGIN``, which is
six standard deviations of the estimate or more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .components import TASK_LINKS, connected_components, spanning, unite
from .frames import bound_batches, counted, few, give_back, join_counted, map_groups, map_texts, need_columns, reliable, shuffle_width, small, unused
from .shingles import shingle_set
from .superminhash import band_keys, signatures

SLOTS, BANDS, ROWS = 223, 36, 6
#: How far an estimate may lie below the wanted similarity.
MARGIN = 0.2
#: Links of a bucket's or class's least member that are verified in one task.
STAR_ROWS = 2048
#: Sets of a task, about.
SET_ROWS = 2000
#: Most members and most shingles of a block, about.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 500_000
#: Members outside the main component and other members of an open bucket that
#: are compared at once.
PARTED_ROWS, MEMBER_ROWS = 512, 2048

_FEATURES = "doc_id long, n_shingles long, h1 long, h2 long, sig binary, keys array<long>"


def _features(words: int):
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        sets = [shingle_set(t, words) for t in texts]
        sig = signatures(sets, SLOTS)
        keys = band_keys(sig, BANDS, ROWS)
        low = (sig & np.uint64(0xFF)).astype(np.uint8)
        digests = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), ">i8").astype(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
                pa.array([r.tobytes() for r in low], pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
            ],
            names=["doc_id", "n_shingles", "h1", "h2", "sig", "keys"],
        )

    return fn


def _estimates(batches):
    for batch in batches:
        a, b, sa, sb = (batch.column(i) for i in range(4))
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(batch.num_rows, SLOTS) for s in (sa, sb))
        yield pa.RecordBatch.from_arrays([a, b, pa.array((x == y).mean(axis=1))], names=["a", "b", "likeness"])


def _sets(words: int):
    """The set of each row's text whose digest is that of the row's class."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, blobs = [], []
        for doc_id, text, *digest in zip(*(c.to_pylist() for c in batch.columns)):
            blob = shingle_set(text, words).tobytes()
            if _digest(blob) == digest:
                ids.append((doc_id, *digest))
                blobs.append(blob)
        cols = [pa.array(c, pa.int64()) for c in (zip(*ids) if ids else [()] * 3)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(blobs, pa.large_binary()).cast(pa.binary())], names=["node", "h1", "h2", "shingles"])

    return fn


def _digest(blob: bytes) -> list[int]:
    return np.frombuffer(xxh3_128_digest(blob), ">i8").tolist()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct arrays are at least ``percent`` alike."""
    if not len(a) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _against_first(percent: int):
    """Rows come sorted by star and side: its centre, then the others. Only the
    centre's set is held (or sets, of a document of several texts)."""

    def run(batches):
        star, centres = None, []
        for batch in batches:
            a, b = [], []
            for hub, part, side, node, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if star != (hub, part):
                    star, centres = (hub, part), []
                shingles = np.frombuffer(blob, np.uint64)
                if side == 0:
                    centres.append(shingles)
                elif any(similar(c, shingles, percent) for c in centres):
                    a.append(hub)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        give_back()

    return run


def linked_pairs(sets: list[np.ndarray], percent: int, chunk: int = 1 << 21) -> np.ndarray:
    """Matrix of the pairs with ``100 * intersection >= percent * union``.

    Counts come from products of 0/1 matrices over slices of the vocabulary,
    each of about ``chunk`` cells, so memory is bounded.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    words, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), sizes)
    shared = np.bincount(col, minlength=len(words)) > 1
    col = (np.cumsum(shared) - 1)[col][shared[col]], row[shared[col]]
    order = np.argsort(col[0], kind="stable")
    cols, rows = col[0][order], col[1][order]
    both = np.zeros((n, n), np.float64)
    width = max(1, chunk // max(n, 1))
    total = int(shared.sum())
    for start in range(0, total, width):
        lo, hi = np.searchsorted(cols, [start, start + width])
        part = np.zeros((n, min(width, total - start)), np.float32)
        part[rows[lo:hi], cols[lo:hi] - start] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    return 100 * both >= percent * union


def _verify(percent: int):
    def fn(group: pa.Table) -> pa.Table | None:
        ids = group.column("node").to_numpy()
        if len(ids) < 2:
            return None
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        link = linked_pairs(sets, percent)
        best = ids.copy()
        link |= ids[:, None] == ids[None, :]  # texts of one document
        while True:
            least = np.where(link, best[None, :], best[:, None]).min(axis=1)
            if (least == best).all():
                break
            best = least
        far = best != ids
        return pa.table({"a": best[far], "b": ids[far]})

    return fn


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for
    their sets of ``words``-word shingles; ``component_id`` is the least
    ``doc_id`` reachable and ``kept`` marks that document. ``percent`` is 80 or
    more: the bands are made for that.

    Null, empty and blank texts have no shingles, are linked with nothing and
    kept. A text of fewer words is one shingle; a text of any length is taken
    whole. A pair exactly at ``percent`` is linked. Rows repeating a ``doc_id``
    are one document that has the links of all its rows. A null ``doc_id`` names
    no document: such a row takes the component of its text's class, or null.
    An empty table gives no rows; other columns are ignored, whatever their names.
    """
    if percent < 80:
        raise ValueError("percent must be 80 or more")
    texts = need_columns(docs, doc_id="long", text="string")
    feats, seen = counted(map_texts(texts, "text", _features(words), _FEATURES), nameless=F.expr("count_if(doc_id IS NULL)"))
    n = seen["rows"]
    classes = (
        feats.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
        .where("rep IS NOT NULL")
    )
    reps, found = counted(few(classes, n), most=F.max("rows"))
    firsts, same_id = _several_texts(feats, reps, n)
    links = _links(texts, reps, found["rows"], words, percent)
    comps = connected_components(links if same_id is None else links.union(same_id))
    named = reps.select("h1", "h2", "rep", F.col("rows").alias("n")).join(comps, F.col("rep") == F.col("node"), "left").select("h1", "h2", "n", F.coalesce("component", "rep").alias("comp"))
    with_set = feats.where("n_shingles > 0").select("doc_id", "n_shingles", "h1", "h2")
    out = join_counted(with_set, named, ["h1", "h2"], n, found["most"]).select("doc_id", "n_shingles", "comp")
    if seen["nameless"]:  # a class without an id holds null ids only
        lone = feats.where("n_shingles > 0 AND doc_id IS NULL").join(reps.select("h1", "h2"), ["h1", "h2"], "left_anti")
        out = out.union(lone.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("comp")))
    blank = feats.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("comp"))
    if firsts is not None:  # a row without shingles goes with the other texts of its document
        others = firsts.join(comps, F.col("first") == F.col("node"), "left").select("doc_id", F.coalesce("component", "first").alias("comp"))
        blank = blank.drop("comp").join(others, "doc_id", "left").select("doc_id", "n_shingles", "comp")
    component = F.coalesce("comp", "doc_id")
    return out.union(blank).select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _several_texts(feats: DataFrame, reps: DataFrame, n: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Documents whose rows differ in text: ``(doc_id, first)``, one class of
    each, and the links from it to its other classes; nothing where none do."""
    ends = [f(c).alias(f"{k}_{c}") for c in ("h1", "h2") for k, f in (("min", F.min), ("max", F.max))]
    differ = feats.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*ends).where("min_h1 <> max_h1 OR min_h2 <> max_h2").select("doc_id")
    several, seen = counted(few(differ, n, TASK_LINKS))
    if not seen["rows"]:
        return None, None
    mine = feats.where("n_shingles > 0").join(small(several, n=seen["rows"]), "doc_id").select("doc_id", "h1", "h2").distinct()
    classes = reliable(few(mine.join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select("doc_id", "rep"), n))
    firsts = classes.groupBy("doc_id").agg(F.min("rep").alias("first"))
    return firsts, classes.join(firsts, "doc_id").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))


def _links(texts: DataFrame, reps: DataFrame, n: int, words: int, percent: int) -> DataFrame:
    """Verified links ``(a, b)`` that join all similar ones of ``n`` representatives."""
    likely = percent / 100 - MARGIN
    star, seen = counted(_stars(reps, n))
    stars = seen["rows"]
    scored = _scored(star, stars, reps)
    pairs, seen = counted(scored.where(F.col("likeness") >= likely).select("a", "b").distinct())
    p = seen["rows"]
    pairs = few(pairs, p, TASK_LINKS)
    nodes = _wanted(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), reps, n)
    sets = _sets_of(texts, nodes, words)
    near = connected_components(_verified_stars(pairs, p, sets, percent))
    links = near.select(F.col("component").alias("a"), F.col("node").alias("b"))
    alike = _alike(star, near, reps, likely, stars)
    if alike is None:
        return links
    alike, seen = counted(alike)
    if not seen["rows"]:
        return links
    groups = connected_components(alike)
    more = _wanted(groups.select("node").join(nodes[0].select("node"), "node", "left_anti"), reps, n)
    if more[1]:
        sets = sets.union(_sets_of(texts, more, words))
    return links.union(_verified_groups(groups, sets, reps, n, percent))


def _stars(reps: DataFrame, n: int | None = None) -> DataFrame:
    """``(key, b, a)``: each member of a bucket but the least, which is ``a``."""
    total = BANDS * (reps.count() if n is None else n)
    rows = reps.select(F.col("rep").alias("b"), F.explode("keys").alias("key"))
    least, seen = counted(few(rows.groupBy("key").agg(F.min("b").alias("a"), F.count("*").alias("n")).where("n > 1"), total, TASK_LINKS), most=F.max("n"))
    return few(join_counted(rows, least, "key", total, seen["most"]).where("a <> b").select("key", "a", "b"), total, TASK_LINKS)


def _scored(star: DataFrame, stars: int, reps: DataFrame) -> DataFrame:
    """Estimated likeness of the stars' pairs, each pair once."""
    pairs, seen = counted(few(star.select("a", "b").distinct(), stars, TASK_LINKS))
    p = seen["rows"]
    left = pairs.join(reps.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
    sizes, seen = counted(few(pairs.groupBy("a").agg(F.count("*").alias("n")), p, TASK_LINKS), most=F.max("n"))
    hubs = sizes.join(reps.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
    both = join_counted(left, hubs, "a", p, seen["most"]).select("a", "b", "sa", "sb")
    bound_batches(star.sparkSession)
    return few(both, p).mapInArrow(_estimates, "a long, b long, likeness double")


def _wanted(nodes: DataFrame, reps: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``nodes`` with the digests of their classes, and how many rows these are."""
    rows, seen = counted(few(nodes.join(reps.select(F.col("rep").alias("node"), "h1", "h2"), "node"), n, TASK_LINKS))
    return rows, seen["rows"]


def _sets_of(texts: DataFrame, wanted: tuple[DataFrame, int], words: int) -> DataFrame:
    """``(node, shingles)``: the set of each wanted representative. Only their
    texts leave their place where they are too many to be broadcast."""
    nodes, n = wanted
    some = texts.join(small(nodes, n=n), texts.doc_id == nodes.node).select("doc_id", "text", "h1", "h2")
    made = map_texts(some, "text", _sets(words), "node long, h1 long, h2 long, shingles binary")
    made = made.groupBy("node", "h1", "h2").agg(F.first("shingles").alias("shingles"))  # of equal rows one
    return reliable(few(made.select("node", "shingles"), n, SET_ROWS))


def _verified_stars(pairs: DataFrame, p: int, sets: DataFrame, percent: int) -> DataFrame:
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / STAR_ROWS).cast("int"))
    parts, seen = counted(few(sizes, p, TASK_LINKS), most=F.max("n"))
    centres = parts.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"))
    others = join_counted(pairs, parts, "a", p, seen["most"]).select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"))
    rows = few(centres.union(others).join(sets, "node").select("a", "part", "side", "node", "shingles"), 2 * p, SET_ROWS)
    bound_batches(pairs.sparkSession)
    dealt = rows.repartition(shuffle_width(pairs.sparkSession), "a", "part").sortWithinPartitions("a", "part", "side")
    # a star's rows stay together where partitions follow each other in a task
    return few(dealt, 2 * p, SET_ROWS).mapInArrow(_against_first(percent), "a long, b long")


def _alike(star: DataFrame, near: DataFrame, reps: DataFrame, likely: float, stars: int | None = None) -> DataFrame | None:
    """Spanning links of the pairs of open buckets that are alike by signature
    and of different components; nothing where no bucket is open. A bucket's least
    member is compared already. ``star`` has ``stars`` rows."""
    stars = star.count() if stars is None else stars
    named = reliable(few(star.join(near.withColumnRenamed("node", "b"), "b", "left").select("key", "b", F.coalesce("component", "b").alias("comp")), stars, TASK_LINKS))
    sizes = named.groupBy("key", "comp").agg(F.count("*").alias("k"))
    sizes = sizes.groupBy("key").agg(F.sum("k").alias("n"), F.count("*").alias("comps"), F.max(F.struct("k", "comp")).alias("main")).where("comps > 1")
    blocks = lambda rows, most: F.ceil(rows / most).cast("int")
    sizes = sizes.select("key", "n", F.col("main.comp").alias("main"), blocks(F.col("n") - F.col("main.k"), PARTED_ROWS).alias("ni"), blocks(F.col("n"), MEMBER_ROWS).alias("nj"))
    sizes, seen = counted(few(sizes, stars, TASK_LINKS), most=F.max("n"), all=F.sum("n"))
    if not seen["rows"]:
        return None
    rows = reliable(few(join_counted(named, sizes, "key", stars, seen["most"]), seen["all"], TASK_LINKS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("b"), F.col(n)).cast("int")
    left = rows.where("comp <> main").select("key", own("ni").alias("i"), every("nj").alias("j"), "b", "comp", F.lit(True).alias("parted"))
    right = rows.select("key", every("ni").alias("i"), own("nj").alias("j"), "b", "comp", F.lit(False).alias("parted"))
    both = left.union(right).join(reps.select(F.col("rep").alias("b"), "sig"), "b")
    return map_groups(both.select("key", "i", "j", "b", "comp", "parted", "sig"), ["key", "i", "j"], _likely(likely), "a long, b long").distinct()


def _likely(least: float):
    def fn(block: pa.Table) -> pa.Table | None:
        rep, comp, sides = block.column("b").to_numpy(), block.column("comp").to_numpy(), block.column("parted").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(sides), np.flatnonzero(~sides)
        if not len(left) or not len(right):
            return None
        sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(-1, SLOTS)
        ids, at = np.unique(rep, return_inverse=True)
        root = np.arange(len(ids))
        step = max(1, (1 << 22) // (len(right) * SLOTS))
        for start in range(0, len(left), step):
            some = left[start : start + step]
            x, y = np.nonzero((sig[some][:, None] == sig[right]).mean(axis=2) >= least)
            apart = comp[some[x]] != comp[right[y]]
            root = unite(root, at[some[x[apart]]], at[right[y[apart]]])
        return spanning(ids, root)

    return fn


def _verified_groups(groups: DataFrame, sets: DataFrame, reps: DataFrame, n: int, percent: int) -> DataFrame:
    """Spanning links of the truly similar pairs inside each group."""
    sizes = groups.join(reps.select(F.col("rep").alias("node"), F.col("n").alias("size")), "node")
    members, seen = counted(few(sizes.groupBy("node", F.col("component").alias("grp")).agg(F.sum("size").alias("size")), n, TASK_LINKS))
    m = seen["rows"]
    weight = members.groupBy("grp").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    weight = weight.select("grp", "n", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    blocks, seen = counted(few(weight, m, TASK_LINKS), most=F.max("n"))
    spread = (
        join_counted(members, blocks, "grp", m, seen["most"])
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")
        .join(sets, "node")
    )
    return map_groups(spread.select("grp", "i", "j", "node", "shingles"), ["grp", "i", "j"], _verify(percent), "a long, b long")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one of least
    ``doc_id``; all columns as they came, whatever their names.

    Of rows that repeat a kept ``doc_id`` one stays, the first by hash of its
    text and, of equal texts, any. Rows without a ``doc_id`` name no document
    and all stay. Null, empty and blank texts are like nothing and stay; texts
    of any length are taken whole. An empty table gives no rows.
    """
    found = near_duplicates(docs, words, percent).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept"))
    found, seen = counted(found, apart=F.expr("count_if(NOT kept OR n > 1)"), repeated=F.expr("count_if(kept AND n > 1)"))
    rid, place = unused(docs, "id"), unused(docs, "place")
    rows = docs.withColumn(rid, F.col("doc_id").cast("long"))
    # most texts stay where they are: only ids to look at are moved
    apart = reliable(few(found.where("NOT kept OR n > 1").select(F.col("doc_id").alias(rid)), seen["apart"], TASK_LINKS))
    single = rows.join(small(apart, n=seen["apart"]), rid, "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not seen["repeated"]:
        return single.select(columns)
    repeated = reliable(few(found.where("kept AND n > 1").select(F.col("doc_id").alias(rid)), seen["repeated"], TASK_LINKS))
    first = Window.partitionBy(rid).orderBy(F.xxhash64("text"))
    several = rows.join(small(repeated, n=seen["repeated"]), rid, "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return single.select(columns).union(several.select(columns))
