"""Queries over text parsing, segmentation and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from textkiln import schemas as S
from textkiln.functions import ladders, prompts
from textkiln.functions import text as T
from textkiln.operators import chunking, enrich, schedule
from textkiln.operators.reports import distribution
from textkiln.sources import jsonl
from textkiln.sources.folders import scratch
from textkiln.sources.jsonl import tolerant_parse

from . import inputs as I

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


HEADING = (
    f"(length({I.sql_strip('line')}) > 5 AND NOT regexp_matches({I.sql_strip('line')}, '\\p{{Ll}}') AND {I.sql_strip('line')} <> lower({I.sql_strip('line')})"
    f" AND NOT regexp_matches({I.sql_strip('line')}, '^ATP\\s+2-01') AND NOT regexp_matches({I.sql_strip('line')}, '^\\d+$'))"
)

FOLD = f"""WITH RECURSIVE {I.SQL_LINES},
w AS (SELECT doc_id, CAST(i AS INT) AS i, line, {I.sql_words('line')} AS wc, i % {I.LINES_PER_PARAGRAPH} = 0 AS start,
  CASE WHEN {HEADING} THEN {I.sql_strip('line')} END AS heading, max(i) OVER (PARTITION BY doc_id) AS last_i FROM lines),
f AS (
  SELECT doc_id, i, wc AS acc, i AS frm, i AS begin, last_i FROM w WHERE i = 0
  UNION ALL
  SELECT w.doc_id, w.i, CASE WHEN w.start OR f.acc > {I.MAX_WORDS} THEN w.wc ELSE f.acc + w.wc END,
    CASE WHEN w.start OR f.acc > {I.MAX_WORDS} THEN w.i ELSE f.frm END, CASE WHEN w.start THEN w.i ELSE f.begin END, w.last_i
  FROM f JOIN w ON w.doc_id = f.doc_id AND w.i = f.i + 1),
ends AS (SELECT * FROM f WHERE (acc > {I.MAX_WORDS} OR i = last_i OR (i + 1) % {I.LINES_PER_PARAGRAPH} = 0) AND acc >= {I.MIN_WORDS}),
pieces AS (SELECT e.doc_id, {I.sql_pick(I.NAMES, 'e.doc_id')} AS chapter_num, e.begin, e.frm AS from_line, e.i AS to_line, e.acc AS word_count,
  coalesce(arg_max(w.heading, w.i) FILTER (w.heading IS NOT NULL), 'General') AS section
  FROM ends e LEFT JOIN w ON w.doc_id = e.doc_id AND w.i BETWEEN e.begin - {S.LOOKBACK_LINES} AND e.i GROUP BY ALL)"""


def _chunks(spark, sf_dir):
    return _chunked(I.table(spark, sf_dir, "documents").select("doc_id", "text"))


def _chunked(docs):
    """Chunks of the documents; every third line begins a paragraph."""

    def start(_, i):
        name = F.concat_ws("-", I.chapter(F.col("doc_id")), (F.floor(i / I.LINES_PER_PARAGRAPH) + 1).cast("string"))
        return i % I.LINES_PER_PARAGRAPH == 0, name, I.chapter(F.col("doc_id"))

    return chunking.chunk(docs, start=start, max_words=I.MAX_WORDS, min_words=I.MIN_WORDS)


@query(f"""{FOLD}
SELECT doc_id, chapter_num || '-' || (begin // {I.LINES_PER_PARAGRAPH} + 1) AS para_id, chapter_num, section, from_line, to_line, CAST(word_count AS INT) AS word_count FROM pieces""")
def chunk_greedy_fold(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", "para_id", "chapter_num", "section", "from_line", "to_line", "word_count")


@query(f"""{FOLD}
SELECT count(*) AS n_chunks, CAST(coalesce(sum(word_count), 0) AS BIGINT) AS n_words, CAST(coalesce(sum(word_count), 0) // greatest(count(*), 1) AS BIGINT) AS avg_words,
  CAST(0 AS BIGINT) AS n_figures FROM pieces""")
def chunk_report(spark, sf_dir):
    return chunking.chunk_report(_chunks(spark, sf_dir))


@query(f"{FOLD} SELECT chapter_num, count(*) AS n FROM pieces GROUP BY chapter_num ORDER BY length(chapter_num), chapter_num")
def chapter_counts(spark, sf_dir):
    from textkiln.operators.reports import natural_order

    return distribution(_chunks(spark, sf_dir), "chapter_num").orderBy(*natural_order("chapter_num"))


@query(f"{FOLD} SELECT row_number() OVER (ORDER BY doc_id, from_line) - 1 AS chunk_id, doc_id, from_line FROM pieces")
def chunk_ids(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).select("doc_id", "from_line")
    return chunking.number_chunks(chunks, "doc_id", "from_line").select("chunk_id", "doc_id", "from_line")


# decorations that the noise rules must take out again
_NOISE = ["ATP 2-01.3 1 March 2019", "1 March 2019 ATP 2-01.3", "Figure 3-1. A caption here", "Table 2-4. Another", "(See figure 3-1.)", "(See table 1-1.)", "Intentionally Left Blank"]


def _sql_noise(c: str) -> str:
    for p in S.NOISE_PATTERNS:
        flags = "g"
        for mark, flag in (("(?m)", "m"), ("(?i)", "i")):
            if p.startswith(mark):
                p, flags = p[len(mark) :], flags + flag
        p = "(?m)" + p if "m" in flags else p
        c = f"regexp_replace({c}, '{p}', '', '{flags.replace('m', '')}')"
    return I.sql_strip(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"""WITH d AS (SELECT 'd' || doc_id AS id, text || chr(10) || {I.sql_pick(_NOISE, 'doc_id')} || chr(10) || chr(10) || chr(10) || 'end ' AS t FROM documents
  UNION ALL SELECT 'p' || page_id, html || {I.sql_pick(_NOISE, 'page_id')} FROM pages)
SELECT id, md5({_sql_noise('t')}) AS clean_md5, CAST(length(t) - length({_sql_noise('t')}) AS INT) AS removed FROM d""")
def strip_noise(spark, sf_dir):
    nl = F.lit("\n")
    d = I.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.concat("text", nl, I.pick(_NOISE, F.col("doc_id")), nl, nl, nl, F.lit("end ")).alias("t"))
    p = I.table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.concat("html", I.pick(_NOISE, F.col("page_id"))).alias("t"))
    rows = d.unionByName(p).withColumn("clean", T.strip_noise(F.col("t")))
    return rows.select("id", F.md5("clean").alias("clean_md5"), (F.length("t") - F.length("clean")).alias("removed"))


_STARTS = ["3-24. ", "A-1. ", "3-24.", "E-1. ", "9-1. ", " 3-1. ", "08-2. ", "D-12.  "]


@query(f"""WITH {I.SQL_LINES}, l AS (SELECT doc_id, i, {I.sql_pick(_STARTS, 'doc_id + i')} || line AS line FROM lines),
p AS (SELECT doc_id, i, nullif(regexp_extract(line, '{S.PARA_START_PATTERN}', 1), '') AS n1, nullif(regexp_extract(line, '{S.APPENDIX_START_PATTERN}', 1), '') AS a1,
  regexp_extract(line, '{S.PARA_START_PATTERN}', 2) AS n2, regexp_extract(line, '{S.APPENDIX_START_PATTERN}', 2) AS a2 FROM l)
SELECT doc_id, CAST(i AS INT) AS line_no, coalesce(n1 || '-' || n2, a1 || '-' || a2) AS para_id,
  CASE WHEN a1 IS NOT NULL THEN a1 WHEN list_contains({I.sql_list(I.NAMES)}, regexp_replace(n1, '^0+([0-9])', '\\1')) THEN regexp_replace(n1, '^0+([0-9])', '\\1') END AS chapter_num
FROM p WHERE n1 IS NOT NULL OR a1 IS NOT NULL""")
def para_starts(spark, sf_dir):
    lines = I.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.withColumn("line", F.concat(I.pick(_STARTS, F.col("doc_id") + F.col("line_no")), "line"))
    prefix = chunking.para_prefix(F.col("line"))
    return lines.where(prefix.isNotNull()).select("doc_id", "line_no", chunking.para_id(F.col("line")).alias("para_id"), chunking.chapter_of_prefix(prefix).alias("chapter_num"))


_ASOF = f"""WITH {I.SQL_LINES}, h AS (SELECT doc_id, CAST(i AS INT) AS line_no, CASE WHEN {HEADING} THEN {I.sql_strip('line')} END AS heading FROM lines)"""


def _headings(spark, sf_dir):
    lines = I.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", F.when(T.is_heading(F.col("line")), T.strip(F.col("line"))).alias("heading"))


@query(f"{_ASOF} SELECT doc_id, line_no, coalesce(last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no), 'General') AS section FROM h")
def section_asof(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return _headings(spark, sf_dir).select("doc_id", "line_no", F.coalesce(F.last("heading", True).over(w), F.lit("General")).alias("section"))


@query(f"""{_ASOF} SELECT doc_id, line_no, coalesce(last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN {S.LOOKBACK_LINES} PRECEDING AND 1 PRECEDING), 'General') AS section FROM h""")
def section_lookback(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(-S.LOOKBACK_LINES, -1)
    return _headings(spark, sf_dir).select("doc_id", "line_no", F.coalesce(F.last("heading", True).over(w), F.lit("General")).alias("section"))


_REFS = [" See paragraphs 3-4 and 3-5; paragraph 4-1", " Figure 3-1 shows", " figures 3-1", " PARAGRAPH 12-7.", " none"]


@query(f"""WITH d AS (SELECT doc_id, text || {I.sql_pick(_REFS, 'doc_id')} AS t FROM documents)
SELECT doc_id, array_to_string(regexp_extract_all(t, '{S.CROSS_REFERENCE_PATTERN}', 1), ',') AS refs, regexp_matches(t, '{S.FIGURE_PATTERN}') AS has_figure FROM d""")
def cross_refs(spark, sf_dir):
    t = F.concat("text", I.pick(_REFS, F.col("doc_id")))
    return I.table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.cross_references(t), ",").alias("refs"), T.has_figure(t).alias("has_figure"))


@query(f"SELECT doc_id, {I.sql_words('text')} AS n_words FROM documents")
def word_counts(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


_MARKED = "CASE WHEN i % 4 = 1 THEN " + I.sql_pick(["3-24. ", "A-1. ", "12-3. "], "i // 4") + " || line ELSE line END"


@query(f"""WITH {I.SQL_LINES}, t AS (SELECT doc_id, string_agg({_MARKED}, chr(10) ORDER BY i) AS t FROM lines GROUP BY doc_id),
p AS (SELECT doc_id, string_split(regexp_replace(t, '(?m)^((?:\\d+-\\d+|[A-D]-\\d+)\\.\\s)', chr(1) || '\\1', 'g'), chr(1)) AS ps FROM t),
u AS (SELECT doc_id, unnest(list_filter(list_transform(ps, lambda x: {I.sql_strip('x')}), lambda x: {I.sql_words('x')} >= 10)) AS part,
  generate_subscripts(list_filter(list_transform(ps, lambda x: {I.sql_strip('x')}), lambda x: {I.sql_words('x')} >= 10), 1) - 1 AS n FROM p),
q AS (SELECT *, nullif(regexp_extract(part, '^(\\d+-\\d+|[A-D]-\\d+)\\.\\s+', 1), '') AS found, nullif(regexp_extract(part, '^(\\d+)-\\d+\\.\\s+', 1), '') AS number FROM u)
SELECT doc_id, printf('chunk_%04d', n) AS chunk_id, coalesce(found, 'unk-' || n) AS para_id, CAST(number AS INT) AS chapter_num,
  CASE WHEN number IS NULL THEN 'Appendix' ELSE coalesce({I.sql_map('number', {k: v for k, v in I.TITLES.items() if k.isdigit()}, 'VARCHAR')}, 'Chapter ' || number) END AS chapter_title,
  {I.sql_words('part')} AS word_count, md5(part) AS part_md5 FROM q""")
def split_lookahead(spark, sf_dir):
    marks = lambda x, i: F.when(i % 4 == 1, F.concat(I.pick(["3-24. ", "A-1. ", "12-3. "], F.floor(i / 4)), x)).otherwise(x)
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n", -1), marks), "\n").alias("text"))
    return chunking.split_lookahead(docs)


@query(f"""WITH {I.SQL_DOCUMENTS} SELECT doc_id, chapter_num, {I.sql_map('chapter_num', I.STEPS, 'INT')} AS ipb_step, coalesce({I.sql_map('chapter_num', I.WEIGHTS, 'DOUBLE')}, 1.5) AS weight,
  {I.sql_map('chapter_num', I.TITLES, 'VARCHAR')} AS chapter_title FROM docs""")
def enrich_lookup(spark, sf_dir):
    c = F.col("chapter_num")
    return I.documents(spark, sf_dir).select("doc_id", "chapter_num", enrich.step_of(c).alias("ipb_step"), enrich.weight_of(c).alias("weight"), enrich.title_of(c).alias("chapter_title"))


def _sql_clamp(c: str, name: str) -> str:
    allowed, default = S.VOCABULARY[name]
    v = f"lower({I.sql_strip(c)})"
    return f"CASE WHEN list_contains({I.sql_list(allowed)}, {v}) THEN {v} ELSE '{default}' END"


_VALUES = [" BCT ", "squad", "corps", "Air", "hybrid", "product", "LSCO ", "none"]


@query(f"""WITH v AS (SELECT event_id, CASE WHEN event_id % 9 <> 8 THEN {I.sql_pick(_VALUES, 'event_id')} END AS v, event_type FROM events)
SELECT event_id, {', '.join(f"{_sql_clamp('v', n)} AS {n}" for n in S.VOCABULARY)}, CASE WHEN lower(trim(event_type)) IN ('click', 'view') THEN lower(trim(event_type)) ELSE 'other' END AS event_kind FROM v""")
def enum_clamp(spark, sf_dir):
    e = I.table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("event_id") % 9 != 8, I.pick(_VALUES, F.col("event_id"))).alias("v"))
    return e.select("event_id", *[enrich.clamp(F.col("v"), *S.VOCABULARY[n]).alias(n) for n in S.VOCABULARY], enrich.clamp(F.col("event_type"), ("click", "view"), "other").alias("event_kind"))


_HINTS = [" the corps and division", " repair the bridge", " Cyberspace crisis", " a brigade combat team", " by sea, in armed conflict", " competition"]


def _sql_keyword(c: str, name: str) -> str:
    whens = " ".join(f"WHEN contains(lower({c}), '{w}') THEN '{v}'" for w, v in S.KEYWORDS[name])
    return f"CASE {whens} ELSE 'general' END"


@query(f"""WITH d AS (SELECT doc_id, text || {I.sql_pick(_HINTS, 'doc_id')} AS t FROM documents)
SELECT doc_id, {', '.join(f"{_sql_keyword('t', n)} AS {n}" for n in S.KEYWORDS)} FROM d""")
def heuristic_classify(spark, sf_dir):
    d = I.documents(spark, sf_dir)
    meta = enrich.classify(F.concat("text", I.pick(_HINTS, F.col("doc_id"))), F.col("chapter_num"))
    return d.select("doc_id", meta.alias("m")).select("doc_id", *[F.col(f"m.{n}").alias(n) for n in S.KEYWORDS])


_REPLIES = ['{"echelon": "BCT", "domain": "air"}', '```json\n{"echelon": "corps"}\n```', 'so: {"domain": "sea", "environment": "x"} ok', "{}", "no json", '{"echelon": 5']
_ROW = "CASE doc_id % 6 WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN {c} ELSE NULL END"


@query(f"""WITH d AS (SELECT doc_id, {I.sql_pick(I.NAMES, 'doc_id')} AS chapter_num, lower(text) AS t FROM documents)
SELECT doc_id, doc_id % 6 < 3 AS from_reply,
  CASE doc_id % 6 WHEN 0 THEN 'bct' WHEN 1 THEN 'corps' WHEN 2 THEN 'general' ELSE {_sql_keyword('t', 'echelon')} END AS echelon,
  CASE doc_id % 6 WHEN 0 THEN 'air' WHEN 1 THEN 'general' WHEN 2 THEN 'sea' ELSE {_sql_keyword('t', 'domain')} END AS domain,
  CASE WHEN doc_id % 6 < 3 THEN 'general' ELSE {_sql_keyword('t', 'environment')} END AS environment,
  {I.sql_map('chapter_num', I.STEPS, 'INT')} AS ipb_step, {I.sql_map('chapter_num', I.WEIGHTS, 'DOUBLE')} AS doctrinal_weight FROM d""")
def enrich_fallback(spark, sf_dir):
    d = I.documents(spark, sf_dir).withColumn("reply", I.pick(_REPLIES, F.col("doc_id")))
    out = enrich.enrich(d, "reply")
    return out.select("doc_id", "from_reply", *[F.col(f"metadata.{n}").alias(n) for n in ("echelon", "domain", "environment", "ipb_step", "doctrinal_weight")])


@query(f"WITH {I.SQL_DOCUMENTS} SELECT doc_id, chapter_num FROM docs WHERE chapter_num IN ('2', '3', 'D')")
def chapter_filter(spark, sf_dir):
    return enrich.filter_chapters(I.documents(spark, sf_dir), "2, 3,,d").select("doc_id", "chapter_num")


@query(f"""WITH {I.SQL_DOCUMENTS}, g AS (SELECT doc_id, chapter_num, {I.sql_map('chapter_num', I.STEPS, 'INT')} AS step, {I.sql_pick(['definition', 'process', 'other'], 'doc_id')} AS ct,
  CAST(doc_id % 5 AS DOUBLE) AS weight FROM docs)
SELECT doc_id, (CASE chapter_num WHEN '3' THEN 1 WHEN '4' THEN 2 WHEN '5' THEN 3 WHEN '6' THEN 4 END IS NULL OR step IS NOT DISTINCT FROM CASE chapter_num WHEN '3' THEN 1 WHEN '4' THEN 2 WHEN '5' THEN 3 WHEN '6' THEN 4 END)
  AND ct IN ('definition', 'process') AND weight BETWEEN 1 AND 3 AS accepted FROM g""")
def metadata_gate(spark, sf_dir):
    d, n = I.documents(spark, sf_dir), F.col("doc_id")
    ok = enrich.metadata_accepted(F.col("chapter_num"), enrich.step_of(F.col("chapter_num")), I.pick(["definition", "process", "other"], n), (n % 5).cast("double"), ("definition", "process"))
    return d.select("doc_id", ok.alias("accepted"))


_TASK = I.sql_map("question_type", prompts.INSTRUCTIONS, "VARCHAR")


@query(f"""WITH {I.SQL_DOCUMENTS}, q AS (SELECT *, {I.sql_draw('doc_id')} AS question_type, {I.sql_map('chapter_num', I.TITLES, 'VARCHAR')} AS title FROM docs)
SELECT doc_id, question_type, md5('SOURCE TEXT (Chapter ' || chapter_num || ': ' || title || ', Para ' || para_id || ', Echelon: ' || coalesce(echelon, 'general') || '):' || chr(10)
  || left(text, 800) || chr(10) || chr(10) || 'TASK: ' || {_TASK} || chr(10)) AS prompt_md5 FROM q""")
def prompt_build(spark, sf_dir):
    d = I.documents(spark, sf_dir).withColumn("question_type", schedule.draw_type(F.col("doc_id"))).withColumn("chapter_title", enrich.title_of(F.col("chapter_num")))
    made = prompts.single({c: F.col(c) for c in d.columns}, F.col("question_type"))
    return d.select("doc_id", "question_type", F.md5(made).alias("prompt_md5"))


_WRAPS = ["%s", "so ```json\n%s\n``` done", "prose %s more", '<think>{"k": -1}</think>%s', "{bad %s"]


@query("""WITH e AS (SELECT event_id, props, event_id % 5 AS m FROM events)
SELECT event_id, CASE WHEN m IN (0, 1, 2, 4) THEN CAST(props->>'k' AS BIGINT) WHEN m = 3 THEN -1 END AS flat_k, CASE WHEN TRUE THEN CAST(props->>'k' AS BIGINT) END AS deep_k FROM e""")
def json_ladder(spark, sf_dir):
    e = I.table(spark, sf_dir, "events").select("event_id", "props")
    text = F.replace(I.pick(_WRAPS, F.col("event_id")), F.lit("%s"), F.col("props"))
    read = lambda c: F.get_json_object(c, "$.k").cast("long")
    return e.select("event_id", read(ladders.first_json(text)).alias("flat_k"), read(ladders.longest_json(text)).alias("deep_k"))


def _lines(spark, sf_dir):
    """One line an event; of every seven, one is no JSON and one no object."""
    n = F.col("event_id") % 7
    line = F.when(n == 2, F.concat(F.lit("not json "), "props")).when(n == 5, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    return I.table(spark, sf_dir, "events").select("event_id", line.alias("line"))


@query("""SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events WHERE event_id % 7 NOT IN (2, 5)""")
def tolerant_scan(spark, sf_dir):
    return tolerant_parse(_lines(spark, sf_dir), "line", "k BIGINT")


@query("SELECT CAST(props->>'k' AS BIGINT) AS k FROM events WHERE event_id % 7 NOT IN (2, 5)")
def tolerant_scan_files(spark, sf_dir):
    """The same by the reader, from files of lines."""
    path = scratch(spark, "lines")
    _lines(spark, sf_dir).select("line").write.mode("overwrite").text(path)
    return jsonl.tolerant_scan(spark, path, "k BIGINT")


@query("""SELECT doc_id, text AS listed, CAST(to_json(struct_pack(doc_id := doc_id, lang := lang)) AS VARCHAR) AS nested, CAST(doc_id AS VARCHAR) AS plain FROM documents""")
def coerce_text(spark, sf_dir):
    """Values of three kinds as text: a list, a struct and a number."""
    d = I.table(spark, sf_dir, "documents")
    made = {"listed": (F.split("text", " "), "array<string>"), "nested": (F.struct("doc_id", "lang"), "struct"), "plain": (F.col("doc_id"), "bigint")}
    return d.select("doc_id", *[T.coerce_string(c, kind).alias(name) for name, (c, kind) in made.items()])


_BUILDS = ["", "-bnb-4bit", "-unsloth-bnb-4bit"]


@query("SELECT doc_id, source || '-it' AS model FROM documents")
def model_names(spark, sf_dir):
    built = F.concat("source", F.lit("-it"), I.pick(_BUILDS, F.col("doc_id")))
    return I.table(spark, sf_dir, "documents").select("doc_id", T.resolve_model_name(built).alias("model"))


@query("""WITH d AS (SELECT doc_id, source || '-it' AS name, CASE WHEN doc_id % 3 = 0 THEN 'local-' || (doc_id % 5) END AS override, doc_id % 3 <> 0 AS built FROM documents),
n AS (SELECT doc_id, override, name, name || (CASE doc_id % 3 WHEN 1 THEN '-bnb-4bit' WHEN 2 THEN '-unsloth-bnb-4bit' ELSE '' END) AS base FROM d)
SELECT doc_id, array_to_string(list_filter([override, name, CASE WHEN base <> name THEN base END], lambda x: x IS NOT NULL), ',') AS candidates FROM n""")
def model_candidates(spark, sf_dir):
    """Where a model's full-precision base is looked for."""
    base = F.concat("source", F.lit("-it"), I.pick(_BUILDS, F.col("doc_id")))
    override = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("local-"), (F.col("doc_id") % 5).cast("string")))
    return I.table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.model_candidates(base, override), ",").alias("candidates"))


_FIGURES = FOLD.replace("FROM documents", "FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'see Figure 3-' || doc_id || ' ' ELSE '' END || text AS text FROM documents)")


@query(f"""{_FIGURES}
SELECT count(*) AS n_chunks, CAST(coalesce(sum(word_count), 0) AS BIGINT) AS n_words, CAST(coalesce(sum(word_count), 0) // greatest(count(*), 1) AS BIGINT) AS avg_words,
  count(*) FILTER (from_line = 0 AND doc_id % 4 = 0) AS n_figures FROM pieces""")
def figure_report(spark, sf_dir):
    """The report over documents of which a fourth name a figure in their first
    line."""
    named = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("see Figure 3-"), F.col("doc_id").cast("string"), F.lit(" "))).otherwise(F.lit(""))
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.concat(named, "text").alias("text"))
    return chunking.chunk_report(_chunked(docs))
