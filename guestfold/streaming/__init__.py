"""Incremental runs of the landing step with Structured Streaming.

The reference has no streaming operators: every job is a one-shot batch.  What
it does repeatedly is *land* new extract files and process them (S5, S6).  At
scale that is an incremental file stream: :func:`land_stream` picks up only the
files that arrived since the last run (the file source keeps its log in the
checkpoint), applies any ``df -> df`` operator of this package, and appends the
result as parquet.  ``availableNow`` processes everything pending and stops, so
the same code serves scheduled batch runs.
"""

from .landing import land_stream  # noqa: F401
