"""The queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_trees, conversation_repair, embedding_dedup, filter_audit, line_dedup, mixing, packing, quality_model, quality_rules, secret_scan, toxicity, url_filter
from .neardup import near_duplicates

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule rejected depends on the measured order; the verdict does not
    return quality_rules.assess(table(spark, sf_dir, "documents")).drop("failed_rule")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture as (doc_id, source, weight, epoch, slot): which documents are
    used in which epoch of their source, and the place of their block in it."""
    used = mixing.realise(table(spark, sf_dir, "documents"))
    return used.selectExpr("doc_id", "source", "__weight AS weight", "__epoch AS epoch", "__slot AS slot")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


@query
def op12_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is a tree of one branch; one more says control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(chat_trees.hostile(spark))
    read = chat_trees.read_back(chat_trees.format_trees(chat_trees.reply_chains(turns)))
    return read.withColumnRenamed("tree", "conv_id").drop("path", "rank")


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op1_secret_scan"] = secret_scan.oracle_sql()
ORACLES["op5_url_filters"] = url_filter.oracle_sql()
ORACLES["op8_line_dedup"] = line_dedup.oracle_sql()
ORACLES["op9_quality_rules"] = quality_rules.oracle_sql()
ORACLES["op11_conversation_repair"] = conversation_repair.oracle_sql()
ORACLES["op12_chat_trees"] = chat_trees.oracle_sql()
ORACLES["op13_filter_audit"] = filter_audit.oracle_sql()
