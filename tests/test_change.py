"""UPDATE / DELETE / upsert transforms keep row counts and NULL semantics."""

import pytest
from pyspark.sql import functions as F

from guestfold.operators import change as C
from guestfold.sources import files as IO


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_update_where_null_condition_leaves_row(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, True, "b"), (3, False, "c")], "k int, c boolean, v string")
    out = C.update_where(df, F.col("c"), {"v": F.lit("x")})
    assert rows(out, "k", "v") == [(1, "a"), (2, "x"), (3, "c")]


def test_update_from_multi_match_keeps_count(spark):
    t = spark.createDataFrame([(1, None), (2, None), (3, "old")], "k int, v string")
    s = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (3, "c", 1)], "k int, v string, prio int")
    out = C.update_from(t, s, ["k"], {"v": "src_v"}, order=["prio"])
    assert out.count() == 3
    assert rows(out, "k", "v") == [(1, "b"), (2, None), (3, "c")]


def test_fill_from_only_missing(spark):
    t = spark.createDataFrame([(1, None), (2, "keep")], "k int, v string")
    s = spark.createDataFrame([(1, "new"), (2, "other")], "k int, v string")
    assert rows(C.fill_from(t, s, ["k"], ["v"]), "k", "v") == [(1, "new"), (2, "keep")]


def test_upsert_edge_rows(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", 4), (6, "f", 6)],
                              "k int, x string, y int")
    n = spark.createDataFrame([(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", None), (5, "e", 5)],
                              "k int, x string, y int")
    out = C.upsert(t, n, ["k"], ["x", "y"], "2024-01-01")
    got = {r.k: (r.x, r.y, r.action, r.is_changed) for r in out.collect()}
    assert got == {1: ("a", 1, "unchanged", 0), 2: ("B", 2, "updated", 1), 3: ("c", 3, "updated", 1),
                   4: ("d", None, "updated", 1), 5: ("e", 5, "created", 0), 6: ("f", 6, "kept", 0)}
    counts = C.change_counts(t, n, ["k"], ["x", "y"]).first()
    assert (counts.changed_x, counts.changed_y, counts.changed_rows) == (1, 2, 3)
    pairs = C.version_pairs(t, n, ["k"], ["x", "y"])
    assert pairs.count() == 6


def test_upsert_keeps_what_it_does_not_compare(spark):
    t = spark.createDataFrame([(1, "a", "n1", "2020-01-01", 1), (2, "b", "n2", "2020-01-02", 0), (3, "c", "n3", None, 1)],
                              "k int, x string, note string, updated_at string, is_changed int").withColumn("updated_at", F.to_timestamp_ntz("updated_at"))
    n = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (4, "d")], "k int, x string")
    got = {r.k: (r.x, r.note, str(r.updated_at)[:10], r.is_changed, r.action) for r in C.upsert(t, n, ["k"], ["x"], "2024-01-01").collect()}
    assert got == {1: ("a", "n1", "2020-01-01", 1, "unchanged"), 2: ("B", "n2", "2024-01-01", 1, "updated"),
                   3: ("c", "n3", "None", 1, "kept"), 4: ("d", None, "2024-01-01", 0, "created")}
    two = n.union(spark.createDataFrame([(4, "e")], "k int, x string"))
    with pytest.raises(Exception, match="several rows for one key"):
        C.upsert(t, two, ["k"], ["x"], "2024-01-01").collect()


def test_update_from_refuses_two_source_rows(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        C.update_from(t, s, ["k"], {"v": "src_v"}).collect()
    assert C.update_from(t, s, ["k"], {"v": "src_v"}, order=["v"]).first().v == "x"


def test_replace_slice_null_condition_kept(spark):
    t = spark.createDataFrame([(1, "P"), (2, None), (3, "F")], "k int, s string")
    new = spark.createDataFrame([(9, "P")], "k int, s string")
    out = C.replace_slice(t, new, F.col("s") == "P")
    assert rows(out, "k") == [(2,), (3,), (9,)]


def test_insert_ignore_skips_existing(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    n = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string")
    assert rows(C.insert_ignore(t, n, ["k"]), "k", "v") == [(1, "a"), (2, "b")]


def test_flag_exists_no_multiplication(spark):
    t = spark.createDataFrame([(1,), (2,)], "k int")
    s = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    out = C.flag_exists(t, s, ["k"], "hit")
    assert rows(out, "k", "hit") == [(1, 1), (2, 0)]


def test_upsert_partitions_rewrites_changed_partitions_only(spark):
    import glob
    import os
    path = IO.scratch_dir(spark, "test-buckets") + "/t"
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 2, None), ("c", 1, "x"), ("d", 9, "z")], "src string, k int, v string")
    old = old.withColumns({"updated_at": F.lit(None).cast("timestamp_ntz"), "is_changed": F.lit(0)})
    old.write.partitionBy("src").parquet(path)
    files = lambda s: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/src={s}/*.parquet")}
    before = {s: files(s) for s in "abcd"}
    new = spark.createDataFrame([("a", 1, "new"), ("a", 3, "created"), ("b", 2, None), ("c", 1, "x"), ("e", 5, "first")], "src string, k int, v string")
    got = C.upsert_partitions(path, new, ["src", "k"], ["v"], "2024-01-01 00:00:00", "src")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 1, 1), ("e", 1, 0, 0)]
    assert {s: files(s) == before[s] for s in "abcd"} == {"a": False, "b": True, "c": True, "d": True}
    rows = sorted(((r.src, r.k, r.v, r.is_changed) for r in spark.read.parquet(path).collect()), key=str)
    assert rows == sorted([("a", 1, "new", 1), ("a", 2, "y", 0), ("a", 3, "created", 0), ("b", 1, "x", 0), ("b", 2, None, 0), ("c", 1, "x", 0),
                           ("d", 9, "z", 0), ("e", 5, "first", 0)], key=str)
    again = C.upsert_partitions(path, new, ["src", "k"], ["v"], "2024-01-02 00:00:00", "src")
    assert again.collect() == []  # nothing differs any more
