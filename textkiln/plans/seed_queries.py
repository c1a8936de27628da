"""Queries over scheduling, validation, merging, rendering and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import chat, prompts
from textkiln.functions import text as T
from textkiln.operators import citations, enrich, merge, prefs, reports, schedule, split, validate
from textkiln.operators.ranking import numbered
from textkiln.sources import providers
from textkiln.sources.jsonl import text_projection

from . import inputs as I

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf_dir):
    return schedule.pending(I.table(spark, sf_dir, "documents").select("doc_id"), I.table(spark, sf_dir, "labels"), ["doc_id"])


@query(f"WITH {I.SQL_SEEDS} SELECT key, para_id, question_type FROM seeds s WHERE NOT EXISTS (SELECT 1 FROM seeds d WHERE d.turn % 4 = 1 AND d.para_id = s.para_id AND d.question_type = s.question_type)")
def resume_anti_composite(spark, sf_dir):
    tasks = I.seeds(spark, sf_dir).select("key", "turn", F.array("para_id").alias("source_chunks"), "question_type")
    left = schedule.pending(tasks, tasks.where("turn % 4 = 1"), ["source_chunks", "question_type"])
    return left.select("key", F.array_join("source_chunks", ",").alias("para_id"), "question_type")


_WEIGHT = f"coalesce({I.sql_map('chapter_num', I.WEIGHTS, 'DOUBLE')}, 1.5)"
_POOL = f"pool AS (SELECT doc_id, chapter_num, unnest(range(1, CAST(greatest(1, round_even({_WEIGHT}, 0)) AS INT) + 1)) AS copy FROM docs)"


@query(f"WITH {I.SQL_DOCUMENTS}, {_POOL} SELECT doc_id, chapter_num, CAST(copy AS INT) AS copy FROM pool")
def weighted_pool(spark, sf_dir):
    return schedule.weighted_pool(I.documents(spark, sf_dir)).select("doc_id", "chapter_num", "copy")


@query(f"""WITH {I.SQL_DOCUMENTS}, {_POOL}, r AS (SELECT *, unnest([1, 2, 3]) AS round FROM pool),
o AS (SELECT *, row_number() OVER (ORDER BY round, md5('42|' || doc_id || '|' || copy), doc_id, copy) AS task_no FROM r)
SELECT doc_id, chapter_num, CAST(copy AS INT) AS copy, CAST(round AS INT) AS round, {I.sql_draw("(doc_id || '|' || copy || '|' || round)")} AS question_type, task_no
FROM o WHERE task_no <= (SELECT 5 * count(*) // 2 FROM pool)""")
def task_schedule(spark, sf_dir):
    docs = I.documents(spark, sf_dir).select("doc_id", "chapter_num")
    return schedule.schedule(docs, 5 * schedule.weighted_pool(docs).count() // 2)


@query(f"""WITH {I.SQL_DOCUMENTS}, j AS (SELECT a.doc_id, a.chapter_num, a.echelon, a.para_id, list(b.doc_id ORDER BY b.echelon NULLS FIRST, b.para_id, md5('42|' || b.doc_id), b.doc_id) FILTER (b.doc_id IS NOT NULL) AS able
  FROM docs a LEFT JOIN docs b ON a.chapter_num = b.chapter_num AND a.echelon IS DISTINCT FROM b.echelon AND a.para_id <> b.para_id GROUP BY ALL)
SELECT doc_id, chapter_num, echelon, para_id, able[CAST('0x' || substr(md5('42|partner|' || doc_id), 1, 15) AS BIGINT) % len(able) + 1] AS partner_id FROM j""")
def contrastive_pairs(spark, sf_dir):
    return schedule.contrastive_pairs(I.documents(spark, sf_dir))


@query(f"""WITH {I.SQL_DOCUMENTS}, w AS (SELECT chapter_num, count(*) AS n, coalesce({I.sql_map('chapter_num', I.WEIGHTS, 'DOUBLE')}, 1.0) AS weight FROM docs GROUP BY chapter_num),
q AS (SELECT chapter_num, greatest(3, least(CAST(floor(8000 * (weight / (SELECT sum(n * weight) FROM w)) / n) AS INT), 12)) AS quota FROM w)
SELECT doc_id, chapter_num, CAST(quota AS INT) AS quota FROM docs JOIN q USING (chapter_num)""")
def quota_per_chunk(spark, sf_dir):
    return schedule.quota_per_chunk(I.documents(spark, sf_dir), 8000).select("doc_id", "chapter_num", "quota")


@query(f"""WITH {I.SQL_SEEDS} SELECT key AS qa_id, para_id AS source_chunks, question_type, {I.sql_strip('question')} AS question, {I.sql_strip('trace')} AS thinking_trace, {I.sql_strip('answer_c')} AS answer,
  {I.sql_map('chapter_num', I.STEPS, 'INT')} AS ipb_step, 'doctrine' AS content_type, coalesce(echelon, 'general') AS echelon, domain, 'general' AS environment, 'intermediate' AS difficulty FROM seeds""")
def seed_project(spark, sf_dir):
    s = I.seeds(spark, sf_dir)
    clean = lambda c: T.strip(F.coalesce(F.col(c), F.lit("")))
    meta = F.struct(
        enrich.step_of(F.col("chapter_num")).alias("ipb_step"), F.lit("doctrine").alias("content_type"), F.coalesce("echelon", F.lit("general")).alias("echelon"), "domain",
        F.lit("general").alias("environment"), F.lit("intermediate").alias("difficulty"), F.array("para_id").alias("citation_paragraphs"),
    )
    rows = s.select(F.col("key").alias("qa_id"), F.array("para_id").alias("source_chunks"), "question_type", clean("question").alias("question"), clean("trace").alias("thinking_trace"), clean("answer_c").alias("answer"), meta.alias("metadata"))
    return rows.select("qa_id", F.array_join("source_chunks", ",").alias("source_chunks"), "question_type", "question", "thinking_trace", "answer", "metadata.ipb_step", "metadata.content_type", "metadata.echelon", "metadata.domain", "metadata.environment", "metadata.difficulty")


_Q, _A, _T = (f"{I.sql_strip(c)}" for c in ("question", "answer_c", "trace"))
_SQL_RULES = {
    "empty question": f"{_Q} = ''",
    "empty answer": f"{_A} = ''",
    "question too short": f"{I.sql_words(_Q)} < {S.MIN_QUESTION_WORDS}",
    "answer too short": f"{I.sql_words(_A)} < {S.MIN_ANSWER_WORDS}",
    "trace too long": f"{I.sql_words(_T)} > {S.MAX_TRACE_WORDS}",
    "bad opening": f"regexp_matches({_A}, '{S.BAD_OPENING_PATTERN}')",
    "missing citation": f"NOT regexp_matches({_A}, '{S.CITATION_PATTERN}')",
    "trace without paragraph": f"NOT regexp_matches({_T}, '{S.PARA_REFERENCE_PATTERN}')",
    "prompt leak": f"contains(lower({_Q}), 'source text') OR contains(lower({_Q}), 'source a')",
}
_STRICT_SQL = {
    "question too short": _SQL_RULES["question too short"],
    "answer too short": _SQL_RULES["answer too short"],
    "trace too short": f"{I.sql_words(_T)} < 30",
    "missing citation": f"NOT contains({_A}, '[Reference:')",
    "bad opening": f"starts_with({_A}, 'According to')",
    "trace without paragraph": f"NOT regexp_matches({_T}, 'para\\s+\\d+-\\d+')",
    "trace too long": f"{I.sql_words(_T)} > 400",
    "bad citation id": "NOT regexp_matches(para_id, '^[A-D]?-?\\d+-?\\d+$')",
}


def _sql_reason(rules: dict) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in rules.items()) + " ELSE 'ok' END"


_APPENDIX_SQL = {k: v for k, v in _SQL_RULES.items() if k != "trace without paragraph"}


def _judged(spark, sf_dir, profile: str):
    s = I.seeds(spark, sf_dir)
    return s.withColumn("reason", validate.reason(profile, F.col("question"), F.col("answer_c"), F.col("trace"), F.array("para_id")))


@query(f"WITH {I.SQL_SEEDS} SELECT key, {_sql_reason(_SQL_RULES)} AS reason FROM seeds")
def validate_qa(spark, sf_dir):
    return _judged(spark, sf_dir, "base").select("key", "reason")


@query(f"WITH {I.SQL_SEEDS} SELECT key, {_sql_reason(_APPENDIX_SQL)} AS reason FROM seeds")
def validate_qa_appendix(spark, sf_dir):
    return _judged(spark, sf_dir, "appendix").select("key", "reason")


@query(f"WITH {I.SQL_SEEDS} SELECT key, {_sql_reason(_STRICT_SQL)} AS reason FROM seeds")
def validate_qa_strict(spark, sf_dir):
    return _judged(spark, sf_dir, "strict").select("key", "reason")


@query(f"WITH {I.SQL_SEEDS} SELECT {_sql_reason(_SQL_RULES)} AS reason, count(*) AS n FROM seeds GROUP BY 1")
def reject_reasons(spark, sf_dir):
    return validate.reject_reasons(_judged(spark, sf_dir, "base"))


@query(f"WITH {I.SQL_SEEDS} SELECT key, md5('42|' || key) AS place FROM seeds WHERE {_sql_reason(_SQL_RULES)} = 'ok' ORDER BY place, key LIMIT 50")
def target_cutoff(spark, sf_dir):
    ok = _judged(spark, sf_dir, "base").where("reason = 'ok'").select("key", schedule.shuffle_key(F.col("key")).alias("place"))
    return schedule.take_valid(ok, 50, "place", "key")


@query(f"""WITH {I.SQL_SEEDS}, o AS (SELECT key, row_number() OVER (ORDER BY md5('42|' || key), key) AS task_no, {_sql_reason(_SQL_RULES)} AS reason FROM seeds)
SELECT key, task_no FROM o WHERE reason = 'ok' ORDER BY task_no LIMIT (SELECT count(*) // 4 FROM seeds)""")
def target_adaptive(spark, sf_dir):
    """Tasks judged in rounds until a quarter of their number is valid."""
    seeds = I.seeds(spark, sf_dir)
    tasks, n = numbered(seeds, [schedule.shuffle_key(F.col("key")), F.col("key")], "task_no")

    def judge(rows):
        reason = validate.reason("base", F.col("question"), F.col("answer_c"), F.col("trace"), F.array("para_id"))
        return rows.select("key", "task_no", (reason == "ok").alias("ok"))

    return schedule.generate_until(tasks, n // 4, judge).rows.select("key", "task_no")


@query(f"WITH {I.SQL_SEEDS} SELECT key, md5('exam|' || question) AS reply FROM seeds")
def generate_replies(spark, sf_dir):
    """A reply to each question from a stand-in provider, many calls at once."""
    asked = I.seeds(spark, sf_dir).select("key", F.col("question").alias("prompt"))
    return providers.generate(asked, providers.provider("stub"), system="exam").select("key", "reply")


_MARKS = ["<think>a\nb</think>", "x<channel|>y<channel|>", "", "Thinking...hm done thinking. ", "<think>1</think>m<think>2</think>", "<|channel>thought\nq<channel|>"]
_DECORATED = f"d AS (SELECT conv_id, turn, {I.sql_pick(_MARKS, 'conv_id + turn')} || text AS t FROM conversations)"


def _decorated(spark, sf_dir):
    return I.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(I.pick(_MARKS, F.col("conv_id") + F.col("turn")), "text").alias("t"))


@query(f"""WITH {_DECORATED} SELECT conv_id, turn,
  {I.sql_strip("regexp_replace(regexp_replace(t, '(?s)<think>.*?</think>', '', 'g'), '(?s)Thinking[.][.][.].*?done thinking[.]', '', 'g')")} AS answer,
  {I.sql_strip("regexp_replace(t, '(?s)<[|]channel>thought.*?<channel[|]>', '', 'g')")} AS response FROM d""")
def strip_thinking(spark, sf_dir):
    return _decorated(spark, sf_dir).select("conv_id", "turn", T.strip_thinking(F.col("t")).alias("answer"), T.strip_channel(F.col("t")).alias("response"))


@query(f"""WITH {_DECORATED}, p AS (SELECT *, regexp_extract_all(t, '(?s)<think>(.*?)</think>', 1) AS parts, string_split(t, '<channel|>') AS segs FROM d)
SELECT conv_id, turn, {I.sql_strip("CASE WHEN len(parts) > 0 THEN array_to_string(parts, chr(10)) WHEN len(segs) > 1 THEN array_to_string(segs[1:len(segs) - 1], '<channel|>') ELSE '' END")} AS thinking,
  {I.sql_strip("CASE WHEN len(parts) > 0 THEN regexp_replace(t, '(?s)<think>.*?</think>', '', 'g') ELSE segs[len(segs)] END")} AS content FROM p""")
def parse_thinking(spark, sf_dir):
    return _decorated(spark, sf_dir).select("conv_id", "turn", T.parse_thinking(F.col("t")).alias("p")).select("conv_id", "turn", "p.thinking", "p.content")


@query(f"""WITH {I.SQL_SEEDS}, d AS (SELECT key, CASE WHEN conv_id % 3 = 0 THEN '**QUESTION:** ' || question || chr(10) || 'more' || chr(10) || '**ANSWER:** ' || answer
  WHEN conv_id % 3 = 1 THEN 'question : ' || question || ' answer: ' || answer ELSE question END AS t FROM seeds),
p AS (SELECT key, regexp_replace(t, '\\*+', '', 'g') AS t FROM d),
q AS (SELECT key, {I.sql_strip(f"split_part({I.sql_strip('''regexp_extract(t, '(?is)QUESTION\\s*:\\s*(.+?)(?:ANSWER\\s*:|$)', 1)''')}, chr(10), 1)")} AS question,
  {I.sql_strip("regexp_extract(t, '(?is)ANSWER\\s*:\\s*(.+)', 1)")} AS answer FROM p WHERE regexp_matches(t, '(?is)QUESTION\\s*:\\s*.+') AND regexp_matches(t, '(?is)ANSWER\\s*:\\s*.+'))
SELECT * FROM q WHERE {I.sql_words('question')} >= 5 AND {I.sql_words('answer')} >= 10""")
def parse_labelled_qa(spark, sf_dir):
    s = I.seeds(spark, sf_dir)
    first = F.concat(F.lit("**QUESTION:** "), "question", F.lit("\nmore\n**ANSWER:** "), "answer")
    second = F.concat(F.lit("question : "), "question", F.lit(" answer: "), "answer")
    t = F.when(F.col("conv_id") % 3 == 0, first).when(F.col("conv_id") % 3 == 1, second).otherwise(F.col("question"))
    return s.select("key", T.parse_labelled_qa(t).alias("p")).where("p IS NOT NULL").select("key", "p.question", "p.answer")


_KEY, _ORDER = ["para_id", "question_type"], ["shard", "conv_id", "turn"]
_FIRST = "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY para_id, question_type ORDER BY shard, conv_id, turn) AS rn FROM seeds) WHERE rn = 1)"


def _shards(spark, sf_dir):
    return I.seeds(spark, sf_dir).select(*_KEY, *_ORDER, "key")


@query(f"WITH {I.SQL_SEEDS}, {_FIRST} SELECT para_id, question_type, shard, conv_id, turn, key FROM f")
def merge_dedup(spark, sf_dir):
    return merge.keep_first(_shards(spark, sf_dir), _KEY, _ORDER)


@query(f"WITH {I.SQL_SEEDS}, {_FIRST} SELECT key, printf('qa_%05d', row_number() OVER (ORDER BY shard, conv_id, turn)) AS qa_id FROM f")
def merge_renumber(spark, sf_dir):
    rows = _shards(spark, sf_dir)
    return merge.merge([rows.where(F.col("shard") == i) for i in range(5)], _KEY, _ORDER).select("key", "qa_id")


@query(f"""WITH {I.SQL_SEEDS}, {_FIRST}, r AS (SELECT shard, count(*) AS n_read FROM seeds GROUP BY shard), u AS (SELECT shard, count(*) AS n_unique FROM f GROUP BY shard)
SELECT shard, n_read, coalesce(n_unique, 0) AS n_unique, n_read - coalesce(n_unique, 0) AS n_removed FROM r LEFT JOIN u USING (shard)""")
def merge_contribution(spark, sf_dir):
    return merge.contribution(_shards(spark, sf_dir), _KEY, "shard", _ORDER)


def _system(spark_side: bool = True):
    return chat.system_prompt(enrich.step_of(F.col("chapter_num")), F.col("echelon"), F.col("domain"))


def _sql_title(c: str) -> str:
    return f"array_to_string(list_transform(string_split(replace({c}, '_', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"


_SYSTEM = "'Answer from the manual only. Context: ' || coalesce({}, '{}') || '. Echelon: ' || {} || '. Domain: ' || {} || '. Cite paragraphs at the end.'".format(
    I.sql_map(I.sql_map("chapter_num", I.STEPS, "INT"), S.STEP_LABELS, "VARCHAR"), S.NO_STEP_LABEL, _sql_title("echelon"), _sql_title("domain")
)
_NL = "chr(10)"
_CHAT = f"""chat AS (SELECT *, '<bos><|system|>' || {_NL} || {_SYSTEM} || {_NL} || '<|end|>' || {_NL} || '<|user|>' || {_NL} || {_Q} || {_NL} || '<|end|>' || {_NL} || '<|assistant|>' || {_NL}
  || CASE WHEN turn % 3 <> 0 THEN '<|channel>thought' || {_NL} || {_T} || {_NL} || '<channel|>' || {_NL} || {_A} ELSE {_A} END || {_NL} || '<|end|>' AS text FROM seeds WHERE {_Q} <> '' AND {_A} <> '')"""


def _rendered(spark, sf_dir):
    s = I.seeds(spark, sf_dir)
    trace = F.when(F.col("turn") % 3 != 0, F.col("trace"))
    return s.withColumn("text", chat.render(F.col("question"), trace, F.col("answer_c"), _system())).where("text IS NOT NULL")


@query(f"WITH {I.SQL_SEEDS}, {_CHAT} SELECT key, question_type, text FROM chat")
def render_chat(spark, sf_dir):
    return _rendered(spark, sf_dir).select("key", "question_type", "text")


_TURN = f"'<start_of_turn>user' || {_NL} || 'Answer from the manual only and cite paragraphs at the end.' || {_NL} || {_NL} || {_Q} || '<end_of_turn>' || {_NL} || '<start_of_turn>model' || {_NL} || {_A} || '<end_of_turn>'"


@query(f"WITH {I.SQL_SEEDS} SELECT key, {_TURN} AS text FROM seeds WHERE {_Q} <> '' AND {_A} <> ''")
def render_turns(spark, sf_dir):
    return I.seeds(spark, sf_dir).select("key", chat.render_turns(F.col("question"), F.col("answer_c")).alias("text")).where("text IS NOT NULL")


@query(f"WITH {I.SQL_SEEDS} SELECT key, {_Q} AS question, {_A} AS answer, {_Q} AS turn_question, {_A} AS turn_answer FROM seeds WHERE {_Q} <> '' AND {_A} <> ''")
def template_parse(spark, sf_dir):
    """Rendering and reading back gives question and answer again."""
    turns = chat.render_turns(F.col("question"), F.col("answer_c"))
    rows = _rendered(spark, sf_dir).select("key", chat.parse(F.col("text")).alias("a"), chat.parse_turns(turns).alias("b"))
    return rows.select("key", "a.question", "a.answer", F.col("b.question").alias("turn_question"), F.col("b.answer").alias("turn_answer"))


@query(f"""WITH {I.SQL_SEEDS}, n AS (SELECT count(*) AS n, greatest(1, CAST(floor(count(*) * 0.1) AS INT)) AS v FROM seeds),
o AS (SELECT key, row_number() OVER (ORDER BY md5('42|' || key), key) AS place FROM seeds)
SELECT key, place, CASE WHEN place > n - v THEN 'val' ELSE 'train' END AS part FROM o, n""")
def train_val_split(spark, sf_dir):
    return split.train_val_split(I.seeds(spark, sf_dir).select("key"), "key").select("key", "place", "part")


@query(f"WITH {I.SQL_DOCUMENTS} SELECT doc_id, {I.sql_words('text')} AS n_words FROM docs WHERE {I.sql_words('text')} >= 30")
def long_enough(spark, sf_dir):
    """Minimum length before generation."""
    rows = schedule.long_enough(I.documents(spark, sf_dir))
    return rows.select("doc_id", T.word_count(F.col("text")).alias("n_words"))


@query(f"SELECT doc_id, partner_id, CASE WHEN partner_id IS NULL THEN 'echelon_specific' ELSE 'contrastive' END AS question_type FROM ({ORACLES['contrastive_pairs']})")
def contrastive_fallback(spark, sf_dir):
    """Contrastive tasks, of another type where a chunk has no partner."""
    tasks = schedule.contrastive_pairs(I.documents(spark, sf_dir)).withColumn("question_type", F.lit("contrastive"))
    return schedule.retype_without_partner(tasks).select("doc_id", "partner_id", "question_type")


@query(f"""WITH {I.SQL_SEEDS}, a AS (SELECT key, question_type, row_number() OVER (ORDER BY key) AS place FROM seeds),
b AS (SELECT key AS result_key, length(answer) AS n_chars, row_number() OVER (ORDER BY md5('42|' || key), key) AS place FROM seeds)
SELECT place, key, question_type, result_key, n_chars FROM a JOIN b USING (place)""")
def positional_join(spark, sf_dir):
    """Validation rows beside result rows, by place in their own order."""
    seeds = I.seeds(spark, sf_dir)
    results = seeds.select(F.col("key").alias("result_key"), F.length("answer").cast("long").alias("n_chars"), schedule.shuffle_key(F.col("key")).alias("drawn"))
    return merge.join_by_place(seeds.select("key", "question_type"), results, ["key"], ["drawn", "result_key"]).select("place", "key", "question_type", "result_key", "n_chars")


@query(f"WITH {I.SQL_SEEDS} SELECT question_type, count(*) AS n FROM seeds GROUP BY 1 ORDER BY n DESC, question_type")
def type_distribution(spark, sf_dir):
    return reports.distribution(I.seeds(spark, sf_dir), "question_type").orderBy(F.desc("n"), "question_type")


@query(f"WITH {I.SQL_DOCUMENTS} SELECT {I.sql_map('chapter_num', I.STEPS, 'INT')} AS ipb_step, count(*) AS n FROM docs GROUP BY 1")
def step_distribution(spark, sf_dir):
    d = I.documents(spark, sf_dir).select(enrich.step_of(F.col("chapter_num")).alias("ipb_step"))
    return reports.distribution(d, "ipb_step").orderBy(F.asc_nulls_first("ipb_step"))


_TARGETS = ", ".join(f"('{k}', {v[1]})" for k, v in S.QUESTION_TYPES.items())


@query(f"""WITH {I.SQL_SEEDS}, w(question_type, target) AS (VALUES {_TARGETS}), c AS (SELECT question_type, count(*) AS n FROM seeds GROUP BY 1),
j AS (SELECT w.question_type, coalesce(n, 0) AS n, CAST(target AS INT) AS target, round_even(CAST(100.0 AS DOUBLE) * coalesce(n, 0) / (SELECT greatest(count(*), 1) FROM seeds), 4) AS share FROM w LEFT JOIN c USING (question_type))
SELECT question_type, n, target, share, round_even(share - target, 4) AS gap FROM j""")
def type_gap(spark, sf_dir):
    return reports.type_gap(I.seeds(spark, sf_dir))


@query(f"""WITH {I.SQL_SEEDS}, {_CHAT} SELECT count(*) AS n, count(*) FILTER (contains(text, '<|channel>')) AS n_channel, count(*) FILTER (contains(text, '[Reference:')) AS n_citation,
  bool_and(contains(text, '<|end|>')) AS all_end FROM chat""")
def sanity_flags(spark, sf_dir):
    has = lambda mark: F.contains("text", F.lit(mark))
    return _rendered(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(has("<|channel>")).alias("n_channel"), F.count_if(has("[Reference:")).alias("n_citation"), F.bool_and(has(chat.END)).alias("all_end"))


@query(f"WITH {I.SQL_SEEDS}, {_CHAT} SELECT text FROM chat")
def train_text_projection(spark, sf_dir):
    return text_projection(_rendered(spark, sf_dir))


@query(f"""WITH {I.SQL_SEEDS}, r AS (SELECT key, question, answer, CASE WHEN turn % 2 = 0 THEN left(answer, 200) ELSE left(answer, 20) END AS rejected FROM seeds ORDER BY md5('42|' || key), key LIMIT 200)
SELECT key, {I.sql_strip('question')} AS prompt, {I.sql_strip('answer')} AS chosen, CASE WHEN {I.sql_words('rejected')} < 10 THEN '{S.FIXED_REJECTED.replace("'", "''")}' ELSE rejected END AS rejected
FROM r WHERE {I.sql_strip('question')} <> '' AND {I.sql_strip('answer')} <> ''""")
def dpo_pairs(spark, sf_dir):
    s = I.seeds(spark, sf_dir)
    rejected = F.when(F.col("turn") % 2 == 0, F.left("answer", F.lit(200))).otherwise(F.left("answer", F.lit(20)))
    return prefs.preference_pairs(s.withColumn("rejected", rejected), "rejected", "key")


@query(f"""WITH p AS ({ORACLES['dpo_pairs']}), o AS (SELECT key, row_number() OVER (ORDER BY md5('42|' || key), key) AS place FROM p)
SELECT key, place, CASE WHEN place > (SELECT count(*) - CAST(ceil(count(*) * 0.1) AS BIGINT) FROM p) THEN 'val' ELSE 'train' END AS part FROM o""")
def dpo_split(spark, sf_dir):
    """Preference pairs, a tenth of them held for validation."""
    pairs = dpo_pairs(spark, sf_dir)
    return split.train_val_split(pairs.select("key"), "key", held=split.pair_validation_rows).select("key", "place", "part")


@query(f"WITH {I.SQL_SEEDS} SELECT count(*) AS n, count(*) FILTER (contains(answer_c, '[Reference: ATP')) AS n_cited, CAST(floor(100.0 * count(*) FILTER (contains(answer_c, '[Reference: ATP')) / greatest(count(*), 1)) AS INT) AS percent FROM seeds")
def citation_coverage(spark, sf_dir):
    n, cited = F.count("*"), F.count_if(F.contains("answer_c", F.lit("[Reference: ATP")))
    return I.seeds(spark, sf_dir).agg(n.alias("n"), cited.alias("n_cited"), reports.progress(cited, n).alias("percent"))


@query(f"WITH {I.SQL_SEEDS}, {I.SQL_DOCUMENTS} SELECT key, para_id IN (SELECT para_id FROM docs) AS found FROM seeds")
def citation_exists(spark, sf_dir):
    known = I.documents(spark, sf_dir).select(F.col("para_id").alias("known")).distinct()
    cited = I.seeds(spark, sf_dir).select("key", F.explode(F.array("para_id")).alias("cited"))
    return cited.join(known, F.col("cited") == F.col("known"), "left").select("key", F.col("known").isNotNull().alias("found"))


_CLAIMS = f"""claims AS (SELECT a.doc_id AS key, CASE WHEN a.doc_id % 3 = 0 THEN {I.sql_pick(I.NAMES, 'a.doc_id + 1')} || '-' || (a.doc_id % 50 + 1) WHEN a.doc_id % 7 = 0 THEN 'Z-1' ELSE a.para_id END AS cited,
  left(a.text, 300) || CASE WHEN a.doc_id % 2 = 0 THEN ' and so it was said of all ' || a.doc_id ELSE '' END AS text FROM docs a)"""


def _sql_shingles(c: str) -> str:
    words = f"regexp_extract_all(coalesce({c}, ''), '[\\p{{L}}\\p{{N}}]+')"
    return f"list_transform([{words}], lambda w: list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(greatest(len(w) - 2, 0) + 1), lambda i: array_to_string(w[i + 1:i + 2], ' ')) END))[1]"


@query(f"""WITH {I.SQL_DOCUMENTS}, {_CLAIMS}, a AS (SELECT key, cited, {_sql_shingles('text')} AS s FROM claims),
p AS (SELECT DISTINCT para_id, unnest({_sql_shingles('text')}) AS h FROM docs), u AS (SELECT key, cited, unnest(s) AS h FROM a),
m AS (SELECT key, count(*) AS n_shared FROM u JOIN p ON p.para_id = u.cited AND p.h = u.h GROUP BY key),
r AS (SELECT a.key, cited, cited IN (SELECT para_id FROM docs) AS found, CAST(len(s) AS BIGINT) AS n_shingles, n_shared, coalesce(n_shared >= ceil(len(s) * 0.8 - 1e-9), false) AND len(s) > 0 AS supported FROM a LEFT JOIN m USING (key))
SELECT key, cited, found, n_shingles, CASE WHEN supported THEN n_shared END AS n_shared, supported FROM r""")
def citation_text(spark, sf_dir):
    """Claims from the beginning of a document, some with words of their own or
    citing a wrong paragraph, against the paragraph they cite."""
    d = I.documents(spark, sf_dir)
    number = F.col("doc_id")
    wrong = F.concat_ws("-", I.chapter(number + 1), (number % 50 + 1).cast("string"))
    cited = F.when(number % 3 == 0, wrong).when(number % 7 == 0, F.lit("Z-1")).otherwise(F.col("para_id"))
    own = F.when(number % 2 == 0, F.concat(F.lit(" and so it was said of all "), number.cast("string"))).otherwise(F.lit(""))
    claims = d.select(number.alias("key"), cited.alias("cited"), F.concat(F.left("text", F.lit(300)), own).alias("text"))
    return citations.supported(claims, d.select("para_id", "text"))


@query(f"""WITH {I.SQL_SEEDS} SELECT key, CASE WHEN question_type IN ('applied_reasoning', 'contrastive') THEN 1 ELSE 2 END AS priority FROM seeds
WHERE question_type IN ('applied_reasoning', 'contrastive') OR (question_type IN ('factual', 'procedural') AND CAST('0x' || substr(md5('42|' || key), 1, 8) AS BIGINT) % 100 < 20)""")
def review_queue(spark, sf_dir):
    first = F.col("question_type").isin("applied_reasoning", "contrastive")
    drawn = F.conv(F.substring(schedule.shuffle_key(F.col("key")), 1, 8), 16, 10).cast("long") % 100 < 20
    rows = I.seeds(spark, sf_dir).where(first | (F.col("question_type").isin("factual", "procedural") & drawn))
    return rows.select("key", F.when(first, 1).otherwise(2).alias("priority"))


@query(f"WITH {I.SQL_SEEDS} SELECT chapter_num, question_type, count(*) AS n FROM seeds GROUP BY ROLLUP (chapter_num, question_type)")
def rollup_chapter_type(spark, sf_dir):
    """Beyond the surveyed operators: counts by chapter and type with totals."""
    return I.seeds(spark, sf_dir).rollup("chapter_num", "question_type").agg(F.count("*").alias("n"))


def _sql_source(name: str, row: str) -> str:
    echelon = f"coalesce({row}.echelon, 'general')"
    return f"'SOURCE {name} (Chapter ' || {row}.chapter_num || ': ' || {row}.title || ', Para ' || {row}.para_id || ', Echelon: ' || {echelon} || '):' || chr(10) || left({row}.text, 600) || chr(10) || chr(10)"


@query(f"""WITH {I.SQL_DOCUMENTS}, q AS (SELECT *, {I.sql_map('chapter_num', I.TITLES, 'VARCHAR')} AS title FROM docs), p AS ({ORACLES['contrastive_pairs']})
SELECT a.doc_id, b.doc_id AS partner_id, md5({_sql_source('A', 'a')} || {_sql_source('B', 'b')} || 'TASK: {prompts.INSTRUCTIONS['contrastive']}' || chr(10)) AS prompt_md5
FROM p JOIN q a ON a.doc_id = p.doc_id JOIN q b ON b.doc_id = p.partner_id""")
def prompt_pair(spark, sf_dir):
    """The prompts of contrastive tasks that have a partner. Only the part of a
    text that its prompt shows is moved."""
    fields = ["chapter_num", "chapter_title", "para_id", "echelon", "text"]
    d = I.documents(spark, sf_dir).withColumn("chapter_title", enrich.title_of(F.col("chapter_num")))
    pairs = schedule.contrastive_pairs(d).where("partner_id IS NOT NULL").select("doc_id", "partner_id")
    shown = d.withColumn("text", F.left("text", F.lit(prompts.CHAPTERS.pair_chars)))
    a, b = (shown.select(F.col("doc_id").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in fields]) for side, key in (("a", "doc_id"), ("b", "partner_id")))
    of = lambda side: {c: F.col(f"{side}_{c}") for c in fields}
    return pairs.join(a, "doc_id").join(b, "partner_id").select("doc_id", "partner_id", F.md5(prompts.contrastive(of("a"), of("b"))).alias("prompt_md5"))
