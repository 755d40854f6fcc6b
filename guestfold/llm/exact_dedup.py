"""Exact dedup by skew-safe combining.

1. *Local*: every task reduces its own rows to one per text (the partial
   aggregation of step 2; the salt is the task's partition, so a task sends one
   row per text however many copies it read).
2. *Salted*: rows of one (digest, salt) merge; a text that a third of all tasks
   hold is spread over ``salts`` reducers.
3. *Global*: the at most ``salts`` winners of a digest merge.

Every step groups by the digest **and** the full normalised text, so a digest
collision never merges different texts.  Only (id, digest) rows, never texts,
are joined back to the winners, and those of large groups are salted too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, Scratch, ascii_lower, columns_as, join_groups



def text_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct ``norm`` of (id, digest, norm): digest, keep_id, group_size,
    n_texts (texts with that digest) and, only where a digest collides, the text."""
    key = [F.col("digest"), F.col("norm")]
    salted = (rows.withColumn("salt", F.spark_partition_id() % salts)
              .groupBy("digest", "salt", "norm")
              .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    merged = (salted.repartition("digest").groupBy(*key)
              .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    n_texts = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return merged.withColumn("n_texts", n_texts).select(
        "digest", "keep_id", "group_size", "n_texts", F.when(F.col("n_texts") > 1, F.col("norm")).alias("norm"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the
    largest id stays.  Null text: an empty text.  Null id: smaller than any other; a group of null ids
    has a null keep_id.  Repeated rows (same id and text): one of them is kept.  Empty table:
    no rows.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows = columns_as(df, id=id_col, text=text_col).select("id", ascii_lower(F.col("text")).alias("norm"))
    rows = rows.select("id", F.sha2("norm", 256).alias("digest"), "norm")
    groups = scratch.table(text_groups(rows, salts).filter((F.col("group_size") > 1) | (F.col("n_texts") > 1)))
    single = groups.filter(F.col("n_texts") == 1).select("digest", "keep_id", "group_size")
    collided = groups.filter(F.col("n_texts") > 1)
    if collided.isEmpty():
        out = join_groups(rows.select("id", "digest"), single, ["digest"], F.xxhash64("id"), salts)
    else:  # the texts decide where a digest doesn't
        clash = collided.select("digest").distinct()
        out = join_groups(rows.join(clash, "digest", "left_anti").select("id", "digest"), single, ["digest"], F.xxhash64("id"), salts)
        out = out.unionByName(join_groups(rows.join(clash, "digest", "left_semi"),
                                          collided.select("digest", "norm", "keep_id", "group_size"),
                                          ["digest", "norm"], F.xxhash64("id"), salts).drop("norm"))
    of_id = Window.partitionBy("digest", "salt", "id").orderBy(F.lit(1))
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return out.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("id").eqNullSafe(keep) & (F.row_number().over(of_id) == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"))


ORACLE_SQL = """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW g AS (PARTITION BY norm)"""
