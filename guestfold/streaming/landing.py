"""Incremental landing of extract files (S5/S6 as a file stream)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir


def land_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                fmt: str = "json", transform: Callable[[DataFrame], DataFrame] | None = None,
                partition_by: Sequence[str] = (), name: str = "landing",
                checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Land new files from ``source_dir`` into parquet at ``target_dir``.

    The schema is declared (never inferred).  The stream's checkpoint lives in
    the shared ``spark.checkpoint.dir`` unless given, so a restarted job (or a
    lost executor) resumes exactly where the last committed batch ended; the
    parquet file sink is idempotent per batch.  Only row-wise operators make
    sense as ``transform`` here (cleaning, mapping, flags); keyed operators run
    as batch jobs over the landed table."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/guestfold-streams/{name}"
    w = (stream.writeStream.format("parquet").option("path", target_dir).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()
