"""Driver queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run as run_pipeline

from . import decontaminate as decon
from . import exact_dedup as exact
from . import cross_polytope, langid, lexical, line_dedup, mixing, negatives, quality, simhash
from . import token_blocks as blocks
from . import token_counts as counts
from . import url_filter as urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"), urls.RULES)


@_query
def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.round_trip(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


@_query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return out.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


@_query
def op3_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.passage_dedup(_table(spark, sf_dir, "documents"))
    return out.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


@_query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


@_query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).drop("mixture")


@_query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


@_query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


@_query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decon.digest(decon.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                            keep_text=False))


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents"))


@_query
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.driver_query(_table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = run_pipeline
ORACLES["op8_mix_sources"] = mixing.ORACLE_SQL
ORACLES["op9_decontaminate"] = decon.ORACLE_SQL
ORACLES["op10_exact_dedup"] = exact.ORACLE_SQL
ORACLES["op12_lexical_search"] = lexical.ORACLE_SQL
ORACLES["op13_hard_negatives"] = negatives.ORACLE_SQL
ORACLES["op11_near_vectors"] = cross_polytope.ORACLE_SQL
