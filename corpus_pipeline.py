"""The corpus pipeline: documents that are worth training on, mixed and written as token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; what it returns
is written as Parquet and read again as the next one's ``docs``.  All stages but the last return the columns of ``documents``.

Rows with a null or repeated doc_id are scored, judged, deduplicated and mixed like others.  No stage minds how further columns are named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestfold.llm import decontaminate, mixing, quality, simhash, token_blocks
from guestfold.llm.common import Scratch, columns_as

#: SimHash contract: words a shingle, and most differing bits.
SHINGLE, MAX_BITS = 4, 4
#: A document goes when this share of its words, or more, stands in benchmark windows (any hit at all).
MAX_COVERAGE = 0.0
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (operator 5)."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_of(docs["text"], model, spark) >= quality.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one document, the one of least id (operator 7)."""
    return simhash.one_of_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window (operator 9)."""
    columns_as(docs, text="text")  # bounds the batches
    judged = decontaminate.judged(docs, _table(spark, sf_dir, "benchmark"))
    return judged.filter(F.col("j.n_hit") <= MAX_COVERAGE * F.col("j.n_words")).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with calibrated source, language and topic weights (operator 8)."""
    return mixing.sampled(docs).filter("kept").select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in range-coded blocks, and per document what is read back from them (operator 2)."""
    import public_tokenizers
    return token_blocks.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-id binary output", token_stage),
]

#: Nearest-neighbour scores, SimHash and coded blocks can't be expressed in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    scratch = Scratch(spark)
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        kept = scratch.table(stage(spark, docs, sf_dir))
        if k:
            scratch.drop(docs)
        docs = kept
    return docs
