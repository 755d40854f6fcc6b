"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The letters that contracts call "A-Z" (no other letter is lower-cased).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that one Python batch should hold (see :func:`text_batches`).
BATCH_BYTES = 8 * 1024 * 1024

#: Tasks over which the rows of one large group are spread.
SALTS = 32
#: A group is large when it holds this share of all grouped rows (so 1/share groups at most
#: are, which bounds the broadcast list of them) and at least LARGE_GROUP rows.
LARGE_SHARE, LARGE_GROUP = 1e-3, 2000


class Scratch:
    """Intermediate tables of one operator call, written under ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor costs no recomputation of
    what came before, and shuffle files of the writing query can go."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return a reader of what was written."""
        self.n += 1
        path = f"{self.root}/t{self.n}"
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(key, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; a null counts as empty."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def columns_as(df: DataFrame, **names: str) -> DataFrame:
    """Only the named input columns, under internal names: ``columns_as(df, id="doc_id")``.

    What else the input carries can't clash with an operator's own columns.  Batches that go to Python are
    bounded by bytes from here on, as a few thousand long texts would not fit a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * BATCH_BYTES))
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in names.items()])


def text_ids(rows: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` with ``id`` as text, and the type to cast it back to: as numbers, ids beside nulls would
    reach pandas as floats and lose digits."""
    return rows.withColumn("id", F.col("id").cast("string")), rows.schema["id"].dataType.simpleString()


def held_out(id_: Column) -> Column:
    """Whether a row's crc32(doc_id as text) mod 5 is 0 (a null id is held out, so never learnt from)."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def text_batches(frames, column: str = "text", most: int = BATCH_BYTES):
    """Cut pandas frames so that a piece holds about ``most`` bytes of text (one text at least)."""
    for f in frames:
        start, size = 0, 0
        for i, n in enumerate(f[column].str.len().fillna(0)):
            if size and size + n > most:
                yield f.iloc[start:i]
                start, size = i, 0
            size += n
        if start < len(f):
            yield f.iloc[start:]


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], salt: Column, salts: int = SALTS) -> DataFrame:
    """``rows`` left-joined to ``groups`` (one row a group, with its group_size; a written table).  A
    large group is repeated per salt and its rows are dealt over the salts.  Adds ``salt``."""
    least = max(LARGE_GROUP, int(LARGE_SHARE * (groups.select(F.sum("group_size")).first()[0] or 0)))
    large = F.col("group_size") >= least
    all_salts = F.sequence(F.lit(0), F.when(large, F.lit(salts - 1)).otherwise(F.lit(0)))
    marks = F.broadcast(groups.filter(large).select(*on, F.lit(salts).alias("n_salts")))
    rows = (rows.join(marks, on, "left")
            .withColumn("salt", F.pmod(salt, F.coalesce("n_salts", F.lit(1))).cast("int")).drop("n_salts"))
    return rows.join(groups.withColumn("salt", F.explode(all_salts)), [*on, "salt"], "left")
