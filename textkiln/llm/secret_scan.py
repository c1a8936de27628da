"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by patterns in every whole text. Each candidate's value is
hashed, and hashes are aggregated over the corpus by distinct repositories and
owners. A value that several owners or many repositories hold has been copied
from documentation or a tutorial: an example. One that few of them hold and that looks generated is a
live-looking credential of theirs. Base spans are reported either way, with
their class beside them; unnamed random tokens are added as spans of the kind
``live`` only where ownership says that they are not copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import join_counted, reliable

KINDS = ("assign", "access", "hex", "live")
#: Owners, or repositories of any owners, that make a value widely copied.
COPIED_OWNERS, COPIED_REPOS = 3, 6
#: Distinct characters that a live-looking value has at least.
LIVE_VARIETY = 8


def _either(word: str) -> str:
    """A pattern for a word's letters in either case, without folding others."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed patterns. Length limits that no shorter match could change are part of
# them; that of an assignment's value is tested after matching.
NAMES = "|".join([_either("password"), _either("passwd"), _either("secret"), _either("token"), _either("api") + "_?" + _either("key")])
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RANDOM = r"[A-Za-z0-9_-]{20,}"
MIN_VALUE = 8

#: Of a value only its hash and looks are kept: no secret is written anywhere.
_SPAN = "array<struct<start:int,kind:int,end:int,hash:string,varied:boolean>>"


def _spans(text: Column, kind: int, pattern: str, keep=None, group: int = 0) -> Column:
    """Leftmost matches that do not overlap, with code point offsets.

    A match begins behind all text between matches and all matches before it:
    ``split`` gives the former, ``regexp_extract_all`` the latter.
    """
    p = F.lit(pattern)
    hits, gaps = F.regexp_extract_all(text, p, F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, p, F.lit(group)) if group else hits
    parts = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"), values.alias("value"))
    parts = F.transform(parts, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.when(keep(x["value"]) if keep else F.lit(True), F.struct(F.sha2(x["value"], 256).alias("hash"), (_variety(x["value"]) >= LIVE_VARIETY).alias("varied"))).alias("value")))

    def add(state, x):
        start = state["at"] + x["gap"]
        end = start + x["hit"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"]["hash"].alias("hash"), x["value"]["varied"].alias("varied"))
        out = F.when(x["value"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span)))
        return F.struct(end.alias("at"), out.alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    found = F.aggregate(parts, empty, add, lambda s: s["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _variety(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, "")))


def _random(value: Column) -> Column:
    """Upper case, lower case and digits mixed, as generated tokens are."""
    return value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9].*[0-9]") & (_variety(value) >= LIVE_VARIETY)


def find_spans(text: Column) -> tuple[Column, Column]:
    """Base spans, and the random tokens that lie outside of them."""
    assign = _spans(text, 0, ASSIGN, keep=lambda v: F.length(v) >= MIN_VALUE, group=2)
    base = F.array_sort(F.concat(assign, _spans(text, 1, ACCESS), _spans(text, 2, HEX)))
    return base, _spans(text, 3, RANDOM, keep=_random)


def ownership(candidates: DataFrame) -> DataFrame:
    """``(hash, n_rows, n_repos, n_owners)`` from ``(hash, repo, owner)`` rows.

    Rows are first reduced to one per hash, repository and owner, so one value
    in a third of all documents is no hot key. Null owners count as one owner.
    """
    owner, repo = (F.coalesce(c, F.lit("")) for c in ("owner", "repo"))
    seen = candidates.groupBy("hash", repo.alias("repo"), owner.alias("owner")).agg(F.count("*").alias("n"))
    by_owner = seen.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    # a repository belongs to one owner: its name is taken together with the owner's
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_rows"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """Per row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, then
    ``n_live`` and ``n_copied``: the spans whose value looks live or is copied.

    The owner of a document is its ``source`` and its repository the part of the
    source in its ``lang``, unless given. A null or empty text has no spans; its
    digest is that of the empty string; texts of any length are scanned whole.
    Repeated rows are scanned each, and a value counts its owners and
    repositories, not its rows. Spans that begin together come by kind. A null
    ``doc_id`` stays null. An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    columns = docs.columns
    owner = owner if owner is not None else (F.col("source") if "source" in columns else F.lit(""))
    repo = repo if repo is not None else (F.col("lang") if "lang" in columns else F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base, random = find_spans(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    rows = rows.select("doc_id", "owner", "repo", base.alias("base"), random.alias("random"))
    # the texts are done with: only rows with their few spans go on
    rows = reliable(rows.withColumn("row", F.monotonically_increasing_id()))
    outside = F.filter("random", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    every = rows.where((F.size("base") > 0) | (F.size("random") > 0)).withColumn("span", F.explode(F.concat("base", outside)))
    every = every.select("row", "repo", "owner", "span", F.col("span.hash").alias("hash"))
    freq = reliable(ownership(every.select("hash", "repo", "owner")).withColumnRenamed("n_rows", "n"))
    total = freq.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    copied = (F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repos") >= COPIED_REPOS)
    live = ~copied & F.col("span.varied")
    judged = join_counted(every, freq, "hash", total).where((F.col("span.kind") < 3) | live).select("row", "span", copied.alias("copied"), live.alias("live"))
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list("span")).alias("all"), F.count_if("live").alias("n_live"), F.count_if("copied").alias("n_copied")
    )
    out = rows.select("row", "doc_id", "base").join(per_row, "row", "left")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``scan`` over ``documents``."""

    def quoted(p: str) -> str:
        return p.replace("'", "''")

    def spans(kind: int, pattern: str, group: int = 0) -> str:
        p = quoted(pattern)
        begin = "list_sum([length(g) FOR g IN string_split_regex(t, '{p}')[1:i]]) + coalesce(list_sum([length(h) FOR h IN regexp_extract_all(t, '{p}')[1:i-1]]), 0)".format(p=p)
        return (
            f"SELECT r, {kind} AS kind, i, regexp_extract_all(t, '{p}')[i] AS hit, regexp_extract_all(t, '{p}', {group})[i] AS val, "
            f"CAST({begin} AS BIGINT) AS s FROM (SELECT r, t, unnest(range(1, len(regexp_extract_all(t, '{p}')) + 1)) AS i FROM d WHERE regexp_matches(t, '{p}'))"
        )

    variety = "len(list_distinct(string_split(val, '')))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS o, coalesce(lang, '') AS p FROM documents),
raw AS ({spans(0, ASSIGN, 2)} UNION ALL {spans(1, ACCESS)} UNION ALL {spans(2, HEX)} UNION ALL {spans(3, RANDOM)}),
found AS (SELECT r, kind, s, s + length(hit) AS e, val FROM raw
  WHERE (kind = 0 AND length(val) >= {MIN_VALUE}) OR kind IN (1, 2)
     OR (kind = 3 AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[0-9].*[0-9]') AND {variety} >= {LIVE_VARIETY})),
outside AS (SELECT * FROM found f WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM found b WHERE b.r = f.r AND b.kind < 3 AND b.s < f.e AND f.s < b.e)),
owned AS (SELECT f.*, d.o, d.p FROM outside f JOIN d USING (r)),
freq AS (SELECT val, count(DISTINCT o) >= {COPIED_OWNERS} OR count(DISTINCT {{'o': o, 'p': p}}) >= {COPIED_REPOS} AS copied FROM owned GROUP BY val),
judged AS (SELECT r, kind, s, e, copied, NOT copied AND {variety} >= {LIVE_VARIETY} AS live FROM owned JOIN freq USING (val)),
kept AS (SELECT *, list_extract(['{"', '".join(KINDS)}'], kind + 1) || ':' || s || ':' || e AS span FROM judged WHERE kind < 3 OR live),
agg AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied FROM kept GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_copied, 0) AS BIGINT) AS n_copied
FROM d LEFT JOIN agg USING (r)"""
