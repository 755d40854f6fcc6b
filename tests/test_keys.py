"""Per-key operators on tiny frames: ties, NULL keys, hot keys, numbering."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from guestfold.operators import keys as K


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_pick_one_orders_and_null_key(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 5, "b"), (1, 5, "c"), (None, 1, "n1"), (None, 2, "n2"), (2, 1, "z")],
                               "k int, v int, id string")
    out = K.pick_one(df, ["k"], [F.col("v").desc(), "id"])
    assert rows(out, "k", "id") == sorted([(1, "b"), (None, "n2"), (2, "z")], key=repr)


def test_flag_duplicates_with_a_hot_key(spark):
    data = [(k % 3, i, f"r{i}") for k in range(60) for i in range(k % 7 + 1)] + [(0, 999, "hot")] * 3
    df = spark.createDataFrame(data, "k int, v int, id string").withColumn("u", F.monotonically_increasing_id())
    df = K._ckpt(df)  # fix the generated ids before they are used twice
    order = [F.col("v").desc(), "id", "u"]
    flagged = K.flag_duplicates(df, ["k"], order)
    ref = df.withColumn("is_duplicate", F.when(
        F.row_number().over(Window.partitionBy("k").orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])) == 1,
        0).otherwise(1))
    cols = ["k", "v", "id", "u", "is_duplicate"]
    assert rows(flagged, *cols) == rows(ref, *cols)
    assert flagged.where("is_duplicate = 0").count() == 3


def test_flag_duplicates_has_one_winner_among_fully_repeated_rows(spark):
    rows = [(1, 5, "a"), (1, 5, "a"), (1, 5, "a"), (1, 6, "b"), (2, 1, "c"), (None, 3, None), (None, 3, None), (3, 1, "d"), (3, 2, "e"), (3, 2, "e")]
    got = sorted((str(r.k), r.v, r.is_duplicate) for r in K.flag_duplicates(spark.createDataFrame(rows, "k int, v int, x string"), ["k"], ["v"]).collect())
    assert got == [("1", 5, 0), ("1", 5, 1), ("1", 5, 1), ("1", 6, 1), ("2", 1, 0), ("3", 1, 0), ("3", 2, 1), ("3", 2, 1), ("None", 3, 0), ("None", 3, 1)]


def test_flag_duplicates_gives_copies_back_in_shares_and_compares_maps(spark, monkeypatch):
    monkeypatch.setattr(K, "COPIES", 7)
    rows = [("k", 1, {"a": 1, "b": 2})] * 20 + [("k", 2, {"a": 1}), ("l", 1, {})]
    df = spark.createDataFrame(rows, "k string, v int, m map<string,int>")
    got = [(r.k, r.v, r.m, r.is_duplicate) for r in K.flag_duplicates(df, ["k"], ["v"]).collect()]
    assert len(got) == 22 and [g for g in got if g[3] == 0 and g[0] == "k"] == [("k", 1, {"a": 1, "b": 2}, 0)]
    assert sum(g[:2] == ("k", 1) and g[3] == 1 for g in got) == 19 and ("l", 1, {}, 0) in got and ("k", 2, {"a": 1}, 1) in got
    assert K.flag_duplicates(df.where("false"), ["k"], ["v"]).collect() == []


def test_flag_duplicates_splits_a_key_with_most_rows(spark):
    hot = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 10 < 9, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
                                              F.sha2(F.col("id").cast("string"), 512).alias("load"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        out = K.flag_duplicates(hot, ["k"], ["v"])
        assert out.where("is_duplicate = 0").count() == 6001
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)


def test_drop_all_duplicated_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (None, "m")], "k int, x string")
    assert rows(K.drop_all_duplicated(df, ["k"]), "x") == sorted([("c",), ("m",), ("n",)], key=repr)


def test_with_group_size_null_safe(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,)], "k int")
    out = K.with_group_size(df, ["k"])
    assert rows(out, "k", "group_size") == sorted([(1, 2), (1, 2), (None, 3), (None, 3), (None, 3)], key=repr)


def test_assign_sequence_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    seq = K.assign_sequence(df, ["a", "b"], start=10, partitions=7)
    ref = df.withColumn("seq", F.row_number().over(Window.orderBy("a", "b")) + 9)
    assert rows(seq, "a", "b", "seq") == rows(ref, "a", "b", "seq")
    assert seq.count() == 5000


def test_assign_sequence_only_null_keeps_existing(spark):
    df = spark.createDataFrame([(1, 100), (2, None), (3, None), (4, 7)], "k int, row_id long")
    out = K.assign_sequence(df, ["k"], start=500, only_null="row_id")
    assert rows(out, "k", "row_id") == [(1, 100), (2, 500), (3, 501), (4, 7)]


def test_assign_batches(spark):
    df = spark.range(1, 12).withColumnRenamed("id", "seq")
    out = K.assign_batches(df, "seq", 5)
    assert [r.batch_no for r in out.orderBy("seq").collect()] == [1] * 5 + [2] * 5 + [3]


def test_dominant_ties_and_thresholds(spark):
    df = spark.createDataFrame([("anna", "F")] * 9 + [("anna", "M")] + [("kim", "F")] * 2 + [("kim", "M")] * 2,
                               "name string, g string")
    out = K.dominant(df, "name", "g", min_n=2, min_ratio=0.5)
    assert rows(out, "name", "g", "n_val", "n_key") == [("anna", "F", 9, 10), ("kim", "F", 2, 4)]
    # the threshold is on all values of the name, not on the dominant one alone
    assert rows(K.dominant(df, "name", "g", min_n=10, min_ratio=0.5), "name") == [("anna",)]
    assert rows(K.dominant(df, "name", "g", min_n=4, min_ratio=0.5), "name") == [("anna",), ("kim",)]
    assert K.dominant(df, "name", "g", min_n=2, min_ratio=0.9).count() == 1


def test_share_no_single_partition_window(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "t string")
    out = K.share(df, ["t"])
    assert rows(out, "t", "n", "pct") == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_rollup_levels(spark):
    df = spark.createDataFrame([("x", "am", 1), ("x", "pm", 2), ("y", "am", 1)], "t string, p string, u int")
    out = K.rollup_counts(df, [("t", "p"), ("t",), ()], {"n": F.count(F.lit(1)), "users": F.count_distinct("u")})
    got = rows(out, "level", "t", "p", "n", "users")
    assert (2, None, None, 3, 2) in got and (1, "x", None, 2, 2) in got and (0, "y", "am", 1, 1) in got
    assert len(got) == 6


def test_collation_fidelity_mode(spark):
    from guestfold.operators import joins as J
    from guestfold.operators.change import flag_exists
    a = spark.createDataFrame([("ANNA", 1), ("Jörg", 2), ("anna", 3)], "name string, id int")
    b = spark.createDataFrame([("anna",), ("jorg",)], "name string")
    assert J.keep_matching(a, b, ["name"]).count() == 1                              # intent mode: binary
    assert J.keep_matching(a, b, ["name"], collation="UTF8_LCASE").count() == 2      # case-insensitive
    assert J.keep_matching(a, b, ["name"], collation="UNICODE_CI_AI").count() == 3   # and accent-insensitive
    assert J.keep_missing(a, b, ["name"], collation="UNICODE_CI_AI").count() == 0
    assert K.drop_all_duplicated(a, ["name"], collation="UTF8_LCASE").count() == 1
    assert K.pick_one(a, ["name"], ["id"], collation="UTF8_LCASE").count() == 2
    sizes = {r.id: r.group_size for r in K.with_group_size(a, ["name"], collation="UTF8_LCASE").collect()}
    assert sizes == {1: 2, 2: 1, 3: 2}
    got = {r.id: r.hit for r in flag_exists(a, b, ["name"], "hit", collation="UTF8_LCASE").collect()}
    assert got == {1: 1, 2: 0, 3: 1}
    j = J.join_on(a, b.withColumn("x", F.lit(1)), ["name"], "left", collation="UTF8_LCASE")
    assert sorted(j.columns) == ["id", "name", "x"] and j.count() == 3


def test_numbering_leaves_no_checkpoint_behind(spark):
    import gc
    import os
    import time

    from guestfold.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if "rdd-" in d}

    before = files()
    out = K.assign_sequence(spark.range(100).toDF("v"), ["v"])
    own = files() - before
    gc.collect()
    spark._jvm.System.gc()
    assert own and out.agg(F.max("seq")).first()[0] == 100
    del out
    for _ in range(20):
        gc.collect()
        spark._jvm.System.gc()
        if not own & files():
            break
        time.sleep(1)
    assert not own & files()
