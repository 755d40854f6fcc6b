"""Write, audit, publish: a set of tables whose current versions one manifest names.

Every write makes a new version folder that nobody reads yet.  Publishing writes the next manifest, a small JSON file
with the version folders of *all* tables, under a hidden name and renames it, so readers see either all
changes of a step or none.  A step that fails before leaves the old versions as they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class AuditError(RuntimeError):
    """The counts of a step don't agree; nothing was published."""


class TableSet:
    """Versioned Parquet tables under ``root`` (any file system that Spark writes to)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        folder = self._Path(f"{self.root}/_manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict[str, list[str]]:
        """Version folders by table, of the newest manifest or of an older one."""
        known = self._versions()
        if not known:
            return {}
        stream = self._fs.open(self._Path(f"{self.root}/_manifests/{known[-1] if version is None else version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        folders = self.manifest(version)[name]
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def write(self, name: str, df: DataFrame) -> tuple[str, int]:
        """Write a version folder that is not published yet; the folder and the rows that the write itself counted."""
        folder, seen = f"{name}/{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/{folder}")
        return folder, seen.get["n"]

    def discard(self, *folders: str) -> None:
        for f in folders:
            self._fs.delete(self._Path(f"{self.root}/{f}"), True)

    def publish(self, changes: Mapping[str, Sequence[str]], base: int | None = None) -> int:
        """Name new version folders for some tables, all in one step; the new version's number.

        With ``base`` (the version that the step read) a step that somebody else overtook raises an error."""
        known = self._versions()
        newest = known[-1] if known else 0
        if base is not None and base != newest:
            raise AuditError(f"version {newest} was published since version {base} was read")
        body = json.dumps({**self.manifest(), **{k: list(v) for k, v in changes.items()}}).encode()
        hidden = self._Path(f"{self.root}/_manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        stream.write(bytearray(body))
        stream.close()
        final = self._Path(f"{self.root}/_manifests/{newest + 1:08d}.json")
        if self._fs.exists(final) or not self._fs.rename(hidden, final):
            self._fs.delete(hidden, False)
            raise AuditError(f"version {newest + 1} was published by somebody else")
        return newest + 1

    def version(self) -> int:
        known = self._versions()
        return known[-1] if known else 0


def archive_batch(tables: TableSet, batch_id: str, as_of: str, change_type: str, change_source: str, work: str = "work",
                  history: str = "history", batch_col: str = "_batch_id") -> DataFrame:
    """Move all rows of a batch from the work table to the history (B9), or change nothing.

    History rows and the work table without the batch are written as new versions, each of which counts its rows while it is
    written.  As many rows must have left the work table as came to the history, else :class:`AuditError`; only then
    both are published at once.  One row: batch_id, rows_archived, rows_deleted, finished_at.  A blank
    batch id is an error.  A batch without rows archives nothing and publishes nothing."""
    from ..operators.batch import archive
    base, before = tables.version(), Observation()
    old = tables.read(work)
    hist, _ = archive(old, batch_id, as_of, change_type, change_source, batch_col)
    _, rest = archive(old.observe(before, F.count(F.lit(1)).alias("n")), batch_id, as_of, change_type, change_source, batch_col)
    staged = []
    try:
        folder, archived = tables.write(history, hist)
        staged.append(folder)
        left_folder, left = tables.write(work, rest)
        staged.append(left_folder)
        deleted = before.get["n"] - left
        if archived != deleted:
            raise AuditError(f"batch {batch_id}: {archived} rows archived, {deleted} deleted; both old versions stay")
        if archived:
            tables.publish({history: [*tables.manifest().get(history, []), folder], work: [left_folder]}, base)
        else:
            tables.discard(*staged)
    except Exception:
        tables.discard(*staged)
        raise
    return tables.spark.range(1).select(
        F.lit(batch_id).alias("batch_id"), F.lit(archived).cast("bigint").alias("rows_archived"),
        F.lit(deleted).cast("bigint").alias("rows_deleted"), F.to_timestamp_ntz(F.lit(as_of)).alias("finished_at"))
