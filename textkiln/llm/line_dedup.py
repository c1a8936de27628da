"""Line deduplication over levelled sorted runs of line hashes.

A run is a table, bucketed and sorted by line key, of in how many documents a
key was met, the largest of their ids, and whether this was the first run to
hold it. A new batch of documents is dealt and sorted once, like the runs, and
merge-anti-joined against each of them where it lies: the keys that none holds
are the batch's new lines, the others update the counts of known ones. Both make
a run of the batch's own at level 0; when a level is full its runs are merged,
bucket by bucket, into one of the next level. A run is never dealt or sorted
again: both joins read its buckets as they lie.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.sources.folders import remove, scratch

from .frames import BROADCAST_ROWS, join_counted, need_columns, reliable, shuffle_width, small, unused

BLANKS = " \t\n\v\f\r"
MIN_CHARS = 40
MIN_DOCS = 5
#: Batches that a whole table is fed in, and runs that fill a level.
BATCHES, FANOUT = 4, 2

_KEY = ["k1", "k2"]


def line_key(line: str) -> bytes:
    """Blanks stripped at both ends and A-Z lower-cased, as UTF-8."""
    return line.strip(BLANKS).encode("utf-8", "replace").lower()


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, body, line, k1, k2)``: a row for each long line of a row that
    has an id. ``body`` is a hash of the whole text and ``line`` a place in it,
    so that rows repeating a ``doc_id`` are told apart by what they say."""
    texts = need_columns(docs, doc_id="long", text="string").where("doc_id IS NOT NULL AND text IS NOT NULL")
    lines = texts.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(_lines(F.col("text"))).alias("line", "said"))
    bare = lines.withColumn("said", F.trim("said", F.lit(BLANKS))).where(F.length("said") >= min_chars)
    upper, lower = ("".join(map(chr, range(a, a + 26))) for a in (65, 97))
    bare = bare.withColumn("said", F.translate("said", upper, lower))
    return bare.select("doc_id", "body", "line", F.xxhash64("said").alias("k1"), F.xxhash64(F.lit(1), "said").alias("k2"))


class LineRuns:
    """The runs, by level: tables of the session over files in the shared folder,
    that go with ``drop``."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets or shuffle_width(spark)
        self.levels: list[list[str]] = []
        self.stem, self.made = f"textkiln_lines_{uuid.uuid4().hex}", 0
        self.folder = scratch(spark, "lines")

    @contextmanager
    def _sorted_scans(self):
        """Let scans of a bucket tell that they are sorted, as each is one file."""
        name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, "true")
        try:
            yield
        finally:
            self.spark.conf.set(name, before) if before is not None else self.spark.conf.unset(name)

    def _write(self, counts: DataFrame) -> str:
        """One file a bucket: ``counts`` lies in as many tasks as buckets."""
        name, self.made = f"{self.stem}_{self.made}", self.made + 1
        rows = counts.select(*_KEY, "n_docs", "last_doc", "fresh")
        with self._sorted_scans():
            rows.write.format("parquet").option("path", f"{self.folder}/{name}").bucketBy(self.buckets, *_KEY).sortBy(*_KEY).saveAsTable(name)
        return name

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, f"{self.folder}/{name}")

    def drop(self) -> None:
        self._forget([n for level in self.levels for n in level])
        self.levels = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def merged(self) -> DataFrame:
        """All keys with their totals, after a last compaction of all runs."""
        if not self.levels:
            return self.spark.createDataFrame([], "k1 long, k2 long, n_docs long, last_doc long, fresh boolean")
        runs = [n for level in self.levels for n in level]
        self.levels = [[] for _ in self.levels[1:]] + [[self._compact(runs)]]
        return self.spark.table(self.levels[-1][0])

    def _compact(self, names: list[str]) -> str:
        """Merge runs into one, the lower levels first. A full outer join of two
        is the merge of their sorted buckets. (A union of bucketed tables would
        be planned as bucketed, too, but Spark 4.1 mixes its buckets up.)"""
        while len(names) > 1:
            a, b = (self.spark.table(n).select(*_KEY, F.struct("n_docs", "last_doc", "fresh").alias(side)) for n, side in zip(names, "ab"))
            both = a.join(b.hint("merge"), _KEY, "full_outer")
            n_docs = F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))
            fresh = F.coalesce("a.fresh", F.lit(False)) | F.coalesce("b.fresh", F.lit(False))
            with self._sorted_scans():
                merged = self._write(both.select(*_KEY, n_docs.alias("n_docs"), F.greatest("a.last_doc", "b.last_doc").alias("last_doc"), fresh.alias("fresh")))
            self._forget(names[:2])
            names = [merged, *names[2:]]
        return names[0]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` that no run holds: a batch's new lines. A batch that
        is written like the runs does not move, either."""
        for run in self.runs():
            keys = keys.join(run.where("fresh").select(*_KEY).hint("merge"), _KEY, "left_anti")
        return keys

    def marked(self, keys: DataFrame) -> DataFrame:
        """The same anti-joins in one pass that keeps the rows that a run holds:
        ``keys`` with ``fresh``, true where no run does."""
        fresh = F.lit(True)
        for i, run in enumerate(self.runs()):
            met = run.where("fresh").select(*_KEY, F.lit(True).alias(f"met{i}"))
            keys = keys.join(met.hint("merge"), _KEY, "left")
            fresh = fresh & F.col(f"met{i}").isNull()
        return keys.withColumn("fresh", fresh)

    def add(self, keys: DataFrame) -> None:
        """Count a batch of ``(doc_id, k1, k2)`` rows into a run of its own: the
        keys that no run holds as new ones, the others as count updates.

        A document must not be spread over batches.
        """
        counts = keys.where("doc_id IS NOT NULL").groupBy(*_KEY).agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        batch = self._write(counts.repartition(self.buckets, *_KEY).withColumn("fresh", F.lit(True)))
        if not self.levels:
            return self._push(0, batch)
        with self._sorted_scans():
            run = self._write(self.marked(self.spark.table(batch).drop("fresh")))
        self._forget([batch])
        self._push(0, run)

    def _push(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._compact(full))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``(doc_id, body, gone)``: the places of the lines that a text loses."""
    spark = docs.sparkSession
    keys = reliable(line_keys(docs, min_chars))
    runs = LineRuns(spark)
    for i in range(batches):
        runs.add(keys.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    often = reliable(runs.merged().where(F.col("n_docs") >= min_docs).select(*_KEY, "last_doc", F.col("n_docs").alias("n")))
    runs.drop()
    lost = keys.join(F.broadcast(often), _KEY) if often.count() <= BROADCAST_ROWS else join_counted(keys, often, _KEY, keys.count())
    return lost.where("doc_id <> last_doc").groupBy("doc_id", "body").agg(F.collect_set("line").alias("gone"))


def _with_gone(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, str]:
    """The columns of ``docs`` in their order, then the places that a row loses.

    Where all those places are few they are broadcast; where the documents that
    lose some are few, only these leave their place to meet them.
    """
    gone = reliable(dropped_lines(docs, min_chars, min_docs))
    rid, body, lost = (unused(docs, c) for c in ("id", "body", "lost"))
    rows = docs.withColumns({rid: F.col("doc_id").cast("long"), body: F.xxhash64(F.col("text").cast("string"))})
    gone = gone.select(F.col("doc_id").alias(rid), F.col("body").alias(body), F.col("gone").alias(lost))
    n = gone.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size(lost)), F.lit(0)).alias("places")).first()
    columns = [*[F.col(f"`{c}`") for c in docs.columns], F.col(lost)]
    on = [rid, body]
    if n["places"] <= BROADCAST_ROWS:
        return rows.join(F.broadcast(gone), on, "left").select(columns), lost
    if n["docs"] <= BROADCAST_ROWS:
        ids = small(gone.select(on))
        whole = rows.join(ids, on, "left_anti").withColumn(lost, F.lit(None).cast("array<int>"))
        return whole.select(columns).union(rows.join(ids, on, "left_semi").join(gone, on).select(columns)), lost
    return rows.join(gone, on, "left").select(columns), lost


def _kept(text: Column, gone: Column) -> Column:
    """The text without the lines at ``gone``. The lines are a field of a lambda's
    argument, so that the text is split once, not once a line."""
    bound = F.array(F.struct(_lines(text).alias("lines"), gone.alias("gone")))

    def without(x):
        places = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"])
        return F.array_join(F.transform(places, lambda i: F.get(x["lines"], i)), "\n")

    return F.transform(bound, without)[0]


def dedup_digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` for every row of ``docs``.

    A key of ``min_chars`` code points or more that ``min_docs`` documents or
    more hold loses all its lines but those of the largest ``doc_id`` holding
    it. A null or empty text is one empty line. Rows repeating a ``doc_id``
    count as one document and lose the same keys. A null ``doc_id`` names no
    document: it adds to no count and loses nothing. Texts of any length are
    taken whole. An empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    texts = need_columns(docs, doc_id="long", text="string")
    rows, lost = _with_gone(texts, min_chars, min_docs)
    text, gone = F.coalesce("text", F.lit("")), F.col(lost)
    kept = F.when(gone.isNull(), text).otherwise(_kept(text, gone))
    return rows.select(
        "doc_id", F.size(_lines(text)).cast("long").alias("n_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; other columns stay,
    whatever their names.

    ``n_chars``, where there is one, is counted anew. A row that loses nothing
    keeps its text as it was, null included. Rows repeating a ``doc_id`` count
    as one document and lose the same keys; a null ``doc_id`` loses nothing.
    Texts of any length are taken whole. An empty table gives no rows.
    """
    rows, lost = _with_gone(docs, min_chars, min_docs)
    kinds, gone = dict(docs.dtypes), F.col(lost)
    rows = rows.withColumn("text", F.when(gone.isNull(), F.col("text")).otherwise(_kept(F.col("text"), gone).cast(kinds["text"])))
    if "n_chars" in kinds:
        rows = rows.withColumn("n_chars", F.when(gone.isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kinds["n_chars"])))
    return rows.select([F.col(f"`{c}`") for c in docs.columns])


def oracle_sql(min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> str:
    """DuckDB SQL for the rows of ``dedup_digest`` over ``documents``."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
j AS (SELECT k.*, coalesce(k.doc_id <> o.last_doc, false) AS gone FROM k LEFT JOIN often o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id"""
