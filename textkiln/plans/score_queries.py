"""Queries over scoring, reports and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import rouge
from textkiln.operators import prefs, reports, score
from textkiln.operators.ranking import dense_row_number

from . import inputs as I

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


_TOKENS = "regexp_extract_all(lower(text), '[a-z]{5,}')"
#: Keyword bank from the benchmark; every document answers one of its items.
_SCORED = f"""n AS (SELECT count(*) AS n FROM benchmark), bank AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS place, item_id, list_filter({_TOKENS}, lambda x, i: list_position({_TOKENS}, x) = i)[1:8] AS kws FROM benchmark),
r AS (SELECT item_id, doc_id, kws, text || CASE WHEN doc_id % 3 = 0 THEN ' [Reference: ATP 2-01.3, para 1-1]' ELSE '' END AS t, (doc_id // 64) % 2 AS model FROM documents, n JOIN bank ON place = doc_id % n.n),
k AS (SELECT *, CASE WHEN len(kws) > 0 THEN round_even(CAST(len(list_filter(kws, lambda x: contains(lower(t), x))) AS DOUBLE) / len(kws), 3) ELSE 0 END AS kw_score,
  regexp_matches(t, '{S.CITATION_PATTERN}') AS has_citation, NOT regexp_matches(t, '{S.BAD_OPENING_LOOSE_PATTERN}') AS ok_opening FROM r),
x AS (SELECT *, CASE WHEN has_citation THEN kw_score ELSE greatest(CAST(0 AS DOUBLE), kw_score - CAST(0.1 AS DOUBLE)) END AS y FROM k),
z AS (SELECT *, CASE WHEN ok_opening THEN y ELSE greatest(CAST(0 AS DOUBLE), y - CAST(0.1 AS DOUBLE)) END AS exact FROM x),
scored AS (SELECT item_id, doc_id, model, kw_score, has_citation, ok_opening, round_even(exact, 3) AS score, exact < 0.5 AS needs_dpo FROM z)"""


def _scored(spark, sf_dir):
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))
    bank = I.table(spark, sf_dir, "benchmark").select("item_id", F.slice(F.array_distinct(found), 1, 8).alias("kws"))
    n = bank.count()  # the question bank is a short list
    bank = dense_row_number(bank, [F.col("item_id")], "place", start=0)
    answer = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" [Reference: ATP 2-01.3, para 1-1]")).otherwise(F.lit("")))
    docs = I.table(spark, sf_dir, "documents").select("doc_id", answer.alias("t"), (F.floor(F.col("doc_id") / 64) % 2).alias("model"), (F.col("doc_id") % max(n, 1)).alias("place"))
    return score.scored(docs.join(bank, "place"), "t", "kws").select("item_id", "doc_id", "model", "kw_score", "has_citation", "ok_opening", "score", "needs_dpo")


@query(f"WITH {_SCORED} SELECT * FROM scored")
def keyword_score(spark, sf_dir):
    return _scored(spark, sf_dir)


#: The questions' results of two models: the mean over a model's answers.
_MODELS = "m AS (SELECT item_id, model, round_even(avg(score), 6) AS score, round_even(avg(score), 6) < 0.5 AS needs_dpo FROM scored GROUP BY ALL)"


def _models(spark, sf_dir):
    mean = F.bround(F.avg("score"), 6)
    rows = _scored(spark, sf_dir).groupBy(F.col("item_id").alias("id"), "model").agg(mean.alias("score"))
    rows = rows.withColumn("needs_dpo", F.col("score") < S.WEAK_SCORE)
    return rows.where("model = 0").drop("model"), rows.where("model = 1").drop("model")


@query(f"""WITH {_SCORED}, {_MODELS}, j AS (SELECT b.item_id AS id, b.score AS base_score, f.score AS ft_score, round_even(f.score - b.score, 4) AS delta FROM m b JOIN m f ON b.item_id = f.item_id AND b.model = 0 AND f.model = 1)
SELECT *, CASE WHEN delta > 0.05 THEN '↑' WHEN delta < -0.05 THEN '↓' ELSE '=' END AS marker FROM j""")
def base_vs_ft(spark, sf_dir):
    return score.compare(*_models(spark, sf_dir))


@query(f"""WITH {_SCORED}, {_MODELS}, f AS (SELECT avg(score) AS ft, string_agg(item_id, ',' ORDER BY item_id) FILTER (needs_dpo) AS ids, count(*) AS n FROM m WHERE model = 1), b AS (SELECT avg(score) AS base FROM m WHERE model = 0)
SELECT round_even(ft, 4) AS ft_avg, round_even(base, 4) AS base_avg, round_even(ft - base, 4) AS delta, CAST(0.5 AS DOUBLE) AS dpo_threshold, coalesce(ids, '') AS dpo_ids, n FROM f, b""")
def eval_run_summary(spark, sf_dir):
    return score.run_summary(*_models(spark, sf_dir))


_PREFIXES = {prefix: name for name, (_, _, prefix) in S.QUESTION_TYPES.items()}


@query(f"""WITH {I.SQL_SEEDS}, weak AS (SELECT DISTINCT {I.sql_pick(_PREFIXES.values(), 'id')} AS question_type FROM ({ORACLES['base_vs_ft']}) WHERE marker = '↓')
SELECT key, question_type FROM seeds s WHERE question_type IN (SELECT question_type FROM weak) OR NOT EXISTS (SELECT 1 FROM seeds JOIN weak USING (question_type))""")
def dpo_semi(spark, sf_dir):
    """Seeds of the types of questions that the tuned model lost ground on; a
    question's id begins with the sign of its type."""
    lost = base_vs_ft(spark, sf_dir).where("marker = '↓'")
    weak = lost.select(F.concat_ws("-", I.pick(list(_PREFIXES), F.col("id")), F.col("id").cast("string")).alias("id"))
    return prefs.matching_seeds(I.seeds(spark, sf_dir).select("key", "question_type"), prefs.weak_types(weak)).select("key", "question_type")


@query(f"""WITH {_SCORED}, {_MODELS}, a AS (SELECT item_id AS id, score FROM m WHERE model = 1)
SELECT 'weak' AS side, id, score FROM a WHERE score < 0.5 UNION ALL SELECT * FROM (SELECT 'strong' AS side, id, score FROM a WHERE score >= 0.5 ORDER BY score DESC, id LIMIT 3)""")
def weak_strong_topk(spark, sf_dir):
    return reports.weak_and_strong(_models(spark, sf_dir)[1])


def _sql_lcs(a: str, b: str) -> str:
    cell = f"lambda done, k: list_append(done, CASE WHEN {a}[k] = y THEN (CASE WHEN k > 1 THEN prev[k - 1] ELSE 0 END) + 1 ELSE greatest(coalesce(done[k - 1], 0), prev[k]) END)"
    row = f"lambda prev, y: list_reduce(range(1, len({a}) + 1), {cell}, CAST([] AS BIGINT[]))"
    return f"list_reduce({b}, {row}, list_transform({a}, lambda x: CAST(0 AS BIGINT)))"


#: An answer against the user's words and against itself without its first ones.
_PAIRS = f"""pairs AS (SELECT key, question_type, regexp_extract_all(lower(answer), '[a-z0-9]+') AS r, regexp_extract_all(lower(question), '[a-z0-9]+') AS b,
  regexp_extract_all(lower(substr(answer, 40)), '[a-z0-9]+') AS f FROM seeds)"""


def _rouge(spark, sf_dir, stemmed=False):
    s = I.seeds(spark, sf_dir).select("key", "question_type", "question", "answer", F.expr("substring(answer, 40)").alias("tail"))
    rows = s.select("key", "question_type", rouge.rouge_l(F.col("answer"), F.col("question"), stemmed).alias("base_rouge"), rouge.rouge_l(F.col("answer"), F.col("tail"), stemmed).alias("ft_rouge"))
    return rows


_SQL_ROUGE = """lcs AS (SELECT key, question_type, len(r) AS nr, len(b) AS nb, len(f) AS nf, CASE WHEN len(r) > 0 AND len(b) > 0 THEN list_last({}) ELSE 0 END AS lb, CASE WHEN len(r) > 0 AND len(f) > 0 THEN list_last({}) ELSE 0 END AS lf FROM pairs),
rouge AS (SELECT key, question_type, CASE WHEN lb > 0 THEN 2 * (lb / nb) * (lb / nr) / (lb / nb + lb / nr) ELSE 0 END AS base_rouge, CASE WHEN lf > 0 THEN 2 * (lf / nf) * (lf / nr) / (lf / nf + lf / nr) ELSE 0 END AS ft_rouge FROM lcs)""".format(_sql_lcs("r", "b"), _sql_lcs("r", "f"))


@query(f"""WITH {I.SQL_SEEDS}, {_PAIRS}, {_SQL_ROUGE}
SELECT row_number() OVER (ORDER BY key) AS example, key, round_even(base_rouge, 6) AS base_rougeL, round_even(ft_rouge, 6) AS ft_rougeL, round_even(ft_rouge - base_rouge, 6) AS delta FROM rouge""")
def rouge_rows(spark, sf_dir):
    rows = dense_row_number(_rouge(spark, sf_dir), [F.col("key")], "example")
    b, f = F.col("base_rouge"), F.col("ft_rouge")
    return rows.select("example", "key", F.bround(b, 6).alias("base_rougeL"), F.bround(f, 6).alias("ft_rougeL"), F.bround(f - b, 6).alias("delta"))


@query()
def rouge_rows_stemmed(spark, sf_dir):
    """Porter's stemmer has no SQL form; unit tests hold it against known pairs."""
    rows = _rouge(spark, sf_dir, stemmed=True)
    return rows.select("key", F.bround("base_rouge", 6).alias("base_rougeL"), F.bround("ft_rouge", 6).alias("ft_rougeL"))


@query(f"""WITH {I.SQL_SEEDS}, {_PAIRS}, {_SQL_ROUGE}
SELECT question_type, round_even(avg(base_rouge), 6) AS base_avg, round_even(avg(ft_rouge), 6) AS ft_avg, count(*) AS n FROM rouge GROUP BY question_type""")
def rouge_by_type(spark, sf_dir):
    rows = _rouge(spark, sf_dir).groupBy("question_type").agg(F.bround(F.avg("base_rouge"), 6).alias("base_avg"), F.bround(F.avg("ft_rouge"), 6).alias("ft_avg"), F.count("*").alias("n"))
    order = F.array_position(F.array(*map(F.lit, S.QUESTION_TYPES)), F.col("question_type"))
    return rows.orderBy(F.when(order > 0, order).asc_nulls_last(), "question_type")


@query(f"""WITH {I.SQL_SEEDS}, {_PAIRS}, {_SQL_ROUGE}, t AS (SELECT avg(base_rouge) AS b, avg(ft_rouge) AS f FROM rouge GROUP BY question_type), ma AS (SELECT avg(b) AS mb, avg(f) AS mf FROM t),
mi AS (SELECT avg(base_rouge) AS b, avg(ft_rouge) AS f, count(*) FILTER (ft_rouge > base_rouge) AS n_improved, count(*) AS n FROM rouge)
SELECT round_even(b, 6) AS micro_base, round_even(f, 6) AS micro_ft, round_even(mb, 6) AS macro_base, round_even(mf, 6) AS macro_ft,
  round_even((f - b) / greatest(b, 1e-9) * 100, 3) AS micro_change, round_even((mf - mb) / greatest(mb, 1e-9) * 100, 3) AS macro_change, n_improved, n FROM mi, ma""")
def macro_micro(spark, sf_dir):
    return score.rouge_report(_rouge(spark, sf_dir))


_STAGES = ("documents", "labels", "conversations", "benchmark", "pages", "embeddings")


@query(
    "WITH s AS (" + " UNION ALL ".join(f"SELECT '{t}' AS stage, count(*) AS n FROM {t}" for t in _STAGES) + ") SELECT stage, n, CAST(floor(100 * n / greatest((SELECT count(*) FROM documents), 1)) AS INT) AS percent FROM s"
)
def stage_counts(spark, sf_dir):
    rows = None
    for t in _STAGES:
        one = I.table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("stage"), "n")
        rows = one if rows is None else rows.unionByName(one)
    total = I.table(spark, sf_dir, "documents").agg(F.count("*").alias("m"))
    return rows.crossJoin(total).select("stage", "n", reports.progress(F.col("n"), F.col("m")).alias("percent"))


@query("""SELECT user_id, arg_max(value, event_id) FILTER (event_type <> 'purchase') AS last_loss, arg_max(value, event_id) FILTER (event_type = 'purchase') AS last_eval_loss FROM events GROUP BY user_id""")
def last_loss(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    return reports.last_loss(e, "user_id", F.col("value"), F.col("event_id"), F.col("event_type") == "purchase")
