"""Line dedup over content-defined chunks of lines.

A rolling hash over the last few line hashes cuts a document into chunks, so equal
passages get equal cuts wherever they stand.  Chunks of several lines that occur
before (in order of document id, then position) are removed.

1. Chunks are grouped by digest **and** bytes; copies combine in their own task before anything is shuffled.
2. Digests whose group has one byte string only are proven copies; the others are left alone.
3. The chunk list, without texts, is joined to the repeated digests; large groups are salted.
4. Each document loses the chunks that are not the first of their group.

:func:`passage_dedup` has no cuts: it compares every pair of neighbouring lines, so it finds all repeated line runs,
wherever they start and end.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, columns_as, join_groups, text_batches, text_ids

#: Lines under the rolling hash; a cut where the hash is 0 modulo CUT; fewest and most lines of a chunk.
WINDOW, CUT, LEAST, MOST = 3, 3, 2, 32
#: A line of more words than this is a passage by itself.
LONG_WORDS = 50
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_LEAVES = pow(_BASE, WINDOW, 1 << 64)


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """[start, end) line ranges; a cut depends on the last WINDOW lines and on the cut before."""
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    out, start, rolling = [], 0, 0
    for i, h in enumerate(hashes):
        rolling = (rolling * _BASE + h - (hashes[i - WINDOW] * _LEAVES if i >= WINDOW else 0)) & _MASK
        n = i + 1 - start
        if n >= MOST or n >= LEAST and (rolling >> 32) % CUT == 0:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def _split(text: bytes | None) -> list[bytes]:
    return text.split(b"\n") if text else []


def chunk_rows(rows: DataFrame, bodies: bool) -> DataFrame:
    """(id, k1, k2, n, digest[, body]) of the chunks that can be removed: several lines, not all blank."""
    rows, kind = text_ids(rows)

    def cut(frames):
        for f in text_batches(frames):
            out = []
            for i, k1, k2, text in zip(f["id"].tolist(), f["k1"].tolist(), f["k2"].tolist(), f["text"]):
                lines = _split(text)
                for n, (a, b) in enumerate(chunks(lines)):
                    if b - a >= LEAST and (body := b"\n".join(lines[a:b])).strip():
                        out.append((i, k1, k2, n, xxhash.xxh3_128_digest(body)) + (body,) * bodies)
            yield pd.DataFrame(out, columns=["id", "k1", "k2", "n", "digest"] + ["body"] * bodies)

    out = rows.mapInPandas(cut, "id string, k1 bigint, k2 bigint, n int, digest binary" + ", body binary" * bodies)
    return out.withColumn("id", F.col("id").cast(kind))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_lines, n_chunks, n_removed (chunks), n_removed_lines, clean_text.

    Of equal chunks the one in the row of least id (null first; equal ids by a hash of the text), and there the first,
    stays.  Null text: no lines, clean_text null; empty text: no lines, clean_text empty.  Chunks of one line
    (a document's last) and blank chunks stay.  Repeated rows (same id and text) count as one document and
    get the same result.  Empty table: no rows.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows = columns_as(df, id=id_col, text=text_col)
    rows = rows.select("id", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "id").alias("k2"),
                       F.col("text").cast("binary").alias("text"))
    where = F.struct("id", "k1", "k2", "n")
    same = (chunk_rows(rows, True).groupBy("digest", "body")
            .agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("first")))
    groups = (same.groupBy("digest").agg(F.count(F.lit(1)).alias("n_bodies"), F.sum("n").alias("group_size"), F.min("first").alias("first"))
              .filter((F.col("group_size") > 1) & (F.col("n_bodies") == 1)))
    groups = scratch.table(groups.select("digest", "group_size", "first"))
    listed = chunk_rows(rows, False).withColumn("at", where)
    removed = (join_groups(listed, groups, ["digest"], F.xxhash64("k1", "n")).filter("first is not null and not (first <=> at)")
               .groupBy("k1", "k2").agg(F.array_sort(F.collect_set("n")).alias("removed")))  # of one document
    removed = scratch.table(removed)
    rows, kind = text_ids(rows)

    def clean(frames):
        for f in text_batches(frames):
            out = []
            for text, gone in zip(f["text"], f["removed"]):
                lines = _split(text)
                parts = chunks(lines)
                gone = set() if gone is None else set(map(int, gone))
                kept = [x for n, (a, b) in enumerate(parts) if n not in gone for x in lines[a:b]]
                out.append((len(lines), len(parts), len(gone), len(lines) - len(kept),
                            None if text is None else b"\n".join(kept).decode()))
            o = pd.DataFrame(out, columns=["n_lines", "n_chunks", "n_removed", "n_removed_lines", "clean_text"])
            o.insert(0, "id", f["id"].array)
            yield o

    # the same join at every size: a small list would be broadcast, which says nothing of a large one
    out = rows.join(removed.hint("merge"), ["k1", "k2"], "left").select("id", "text", "removed").mapInPandas(
        clean, "id string, n_lines bigint, n_chunks bigint, n_removed bigint, n_removed_lines bigint, clean_text string")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def units(lines: list[bytes]) -> list[tuple[int, int]]:
    """[start, end) line ranges that are compared: two neighbouring lines that aren't blank, with the blank lines
    between them, and single lines of over LONG_WORDS words."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return [(a, b + 1) for a, b in zip(full, full[1:])] + [(i, i + 1) for i in full if len(lines[i].split()) > LONG_WORDS]


def passage_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_lines, n_removed_lines, clean_text.

    A unit (see :func:`units`) whose lines stand equally before (in order of id, null first, equal ids by a hash of the text,
    then position) goes, with the blank lines inside it; how many those are doesn't count for equality.  So of a run of lines
    that occurs again all lines go, and the first occurrence of every line stays.  Lines are equal by digest, after all lines of a
    digest were compared by their bytes; lines of a digest that has several byte strings stay.

    Null text: no lines, clean_text null; empty text: no lines, clean_text empty.  Repeated rows (same id and text) count as
    one document and get the same result.  Empty table: no rows.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows = columns_as(df, id=id_col, text=text_col)
    rows = rows.select("id", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "id").alias("k2"),
                       F.col("text").cast("binary").alias("text"))
    rows, kind = text_ids(rows)

    def bodies(frames):
        for f in text_batches(frames):
            seen = {x for text in f["text"] for x in _split(text) if x.strip()}
            yield pd.DataFrame([(xxhash.xxh3_128_digest(x), x) for x in seen], columns=["digest", "body"])

    known = rows.select("text").mapInPandas(bodies, "digest binary, body binary").distinct()
    unproven = scratch.table(known.groupBy("digest").count().filter("count > 1").select("digest"))  # 128 bits: none is expected

    def cut(frames):
        for f in text_batches(frames):
            out = []
            for i, k1, k2, text in zip(f["id"].tolist(), f["k1"].tolist(), f["k2"].tolist(), f["text"]):
                lines = _split(text)
                digests = [xxhash.xxh3_128_digest(x) for x in lines]
                for a, b in units(lines):
                    ends = (digests[a],) if b - a == 1 else (digests[a], digests[b - 1])
                    out.append((i, k1, k2, a, b, b"".join(ends)))
            yield pd.DataFrame(out, columns=["id", "k1", "k2", "a", "b", "digest"])

    listed = rows.mapInPandas(cut, "id string, k1 bigint, k2 bigint, a int, b int, digest binary").withColumn("id", F.col("id").cast(kind))
    if not unproven.isEmpty():
        for start in (1, 17):  # the digests of a unit's first and last line; a single line has the first only
            bad = unproven.select(F.col("digest").alias("line"))
            listed = listed.join(bad, F.substring("digest", start, 16) == bad["line"], "left_anti")
    listed = listed.withColumn("at", F.struct("id", "k1", "k2", "a"))
    groups = scratch.table(listed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min("at").alias("first")).filter("group_size > 1"))
    again = join_groups(listed, groups, ["digest"], F.xxhash64("k1", "a")).filter("first is not null and not (first <=> at)")
    span = F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")
    removed = scratch.table(again.groupBy("k1", "k2").agg(F.collect_set(span).alias("removed")))  # of one document

    def clean(frames):
        for f in text_batches(frames):
            out = []
            for text, spans in zip(f["text"], f["removed"]):
                lines = _split(text)
                gone = {x for s in ([] if spans is None else map(int, spans)) for x in range(s >> 32, s & 0xFFFFFFFF)}
                kept = [x for i, x in enumerate(lines) if i not in gone]
                out.append((len(lines), len(gone), None if text is None else b"\n".join(kept).decode()))
            o = pd.DataFrame(out, columns=["n_lines", "n_removed_lines", "clean_text"])
            o.insert(0, "id", f["id"].array)
            yield o

    out = rows.join(removed.hint("merge"), ["k1", "k2"], "left").select("id", "text", "removed").mapInPandas(
        clean, "id string, n_lines bigint, n_removed_lines bigint, clean_text string")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
