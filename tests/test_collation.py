"""Operators under a collation: text that differs in letter case (or accents) only is equal, as in the original tables."""

import pytest
from pyspark.sql import functions as F

from guestfold.operators import change as C
from guestfold.operators import consent as CS
from guestfold.operators import identity as I

LC, CI_AI = "UTF8_LCASE", "UNICODE_CI_AI"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("Ann", None), ("bob", "old"), ("cy", None), (None, None)], "k string, v string")


def test_update_and_fill(spark, target):
    src = spark.createDataFrame([("ANN", "a", 2), ("ann", "b", 1), ("BOB", "c", 1), (None, "n", 1)], "k string, v string, prio int")
    assert rows(C.update_from(target, src, ["k"], {"v": "src_v"}, order=["prio"], collation=LC), "k", "v") == [
        ("Ann", "b"), ("bob", "c"), ("cy", None), (None, None)]
    assert rows(C.fill_from(target, src, ["k"], ["v"], order=["prio"], collation=LC), "k", "v") == [
        ("Ann", "b"), ("bob", "old"), ("cy", None), (None, None)]
    assert rows(C.update_from(target, src, ["k"], {"v": "src_v"}, order=["prio"]), "k", "v") == [
        ("Ann", None), ("bob", "old"), ("cy", None), (None, None)]


def test_two_spellings_of_a_key_must_agree(spark, target):
    same = spark.createDataFrame([("ANN", "a"), ("ann", "a")], "k string, v string")
    assert rows(C.update_from(target, same, ["k"], {"v": "src_v"}, collation=LC), "k", "v")[0] == ("Ann", "a")
    assert rows(C.unique_or_raise(same, ["k"], collation=LC), "k", "v") == [("ANN", "a")]
    assert rows(C.unique_or_raise(same.select("k"), ["k"], collation=LC), "k") == [("ANN",)]
    other = spark.createDataFrame([("ANN", "a"), ("ann", "b")], "k string, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        C.update_from(target, other, ["k"], {"v": "src_v"}, collation=LC).collect()


def test_upsert_compares_keys_and_values(spark):
    t = spark.createDataFrame([("a1", "Rose"), ("a2", "José"), ("a3", "Max")], "k string, v string")
    new = spark.createDataFrame([("A1", "ROSE"), ("A2", "jose"), ("A3", "Moritz"), ("A4", "New")], "k string, v string")
    want = [("A4", "New", "created"), ("a1", "Rose", "unchanged"), ("a2", "José", "unchanged"), ("a3", "Moritz", "updated")]
    assert rows(C.upsert(t, new, ["k"], ["v"], "2024-01-01 00:00:00", collation=CI_AI), "k", "v", "action") == want
    lower = C.upsert(t, new, ["k"], ["v"], "2024-01-01 00:00:00", collation=LC)
    assert rows(lower, "k", "action")[2] == ("a2", "updated")
    assert lower.schema["k"].dataType.simpleString() == "string"
    plain = C.upsert(t, new, ["k"], ["v"], "2024-01-01 00:00:00")
    assert rows(plain.groupBy("action").count(), "action", "count") == [("created", 4), ("kept", 3)]


def test_insert_ignore_and_delete(spark):
    t = spark.createDataFrame([("Ann", 1)], "k string, v int")
    new = spark.createDataFrame([("ANN", 2), ("Bob", 4), ("BOB", 3), ("Cy", 5), ("cy", 5)], "k string, v int")
    assert rows(C.insert_ignore(t, new, ["k"], collation=LC), "k", "v") == [("Ann", 1), ("BOB", 3), ("Cy", 5)]
    assert rows(C.insert_ignore(t, new, ["k"]).groupBy().count(), "count") == [(6,)]
    assert rows(C.delete_matching(new, t, ["k"], collation=LC), "k") == [("BOB",), ("Bob",), ("Cy",), ("cy",)]


def test_match_rules(spark):
    a = spark.createDataFrame([(1, "X@m", "d1"), (2, "y@m", "D2"), (3, None, "d3")], "id int, mail string, day string")
    b = spark.createDataFrame([(10, "x@M", "q"), (9, "X@m", "q"), (12, "w", "d2"), (13, None, "q")], "bid int, mail string, day string")
    rules = [(["mail"], ["mail"]), (["day"], ["day"])]
    assert rows(I.match_rules(a, b, "id", "bid", rules, collation=LC), "id", "match_key", "rule") == [(1, 9, 1), (2, 12, 2)]
    assert rows(I.match_rules(a, b, "id", "bid", rules), "id", "match_key", "rule") == [(1, 9, 1)]


def test_backfill_where_all_spellings_agree(spark):
    df = spark.createDataFrame([("K1", None), ("k2", None), ("k3", "own")], "k string, v string")
    links = spark.createDataFrame([("k1", "a"), ("K1", "A"), ("K2", "a"), ("k2", "b"), ("K3", "c"), ("k1", None)], "k string, v string")
    assert rows(I.backfill_unique(df, links, "k", "v", "v", collation=LC), "k", "v") == [("K1", "a"), ("k2", None), ("k3", "own")]
    assert rows(I.backfill_unique(df, links, ("k", "k"), "v", "v"), "k", "v") == [("K1", "A"), ("k2", "b"), ("k3", "own")]


def test_attach_and_classify(spark):
    df = spark.createDataFrame([(1, "A@x", "Ann"), (2, "b@x", "Bob"), (3, "c@x", "Cy")], "id int, mail string, name string")
    acc = spark.createDataFrame([("a@X", "001B", "ANN"), ("A@X", "001A", "ann"), ("B@x", "001C", "Robert")], "email string, account_id string, name2 string")
    got = I.attach_ids(df, acc, ("mail", "email"), ["account_id"], "account_id", collation=LC)
    assert rows(got, "id", "account_id") == [(1, "001A"), (2, "001C"), (3, None)]
    got = I.classify_import(df, acc, ("mail", "email"), ("name", "name2"), collation=LC)
    assert rows(got, "id", "operation") == [(1, "update"), (2, "none"), (3, "create")]
    assert rows(I.classify_import(df, acc, ("mail", "email"), ("name", "name2")), "id", "operation") == [
        (1, "create"), (2, "create"), (3, "create")]


def test_optouts(spark):
    gone = spark.createDataFrame([("A@x",), ("a@X",), (None,)], "mail string")
    con = spark.createDataFrame([("c1", "a@x", "Central", "optin"), ("c2", "b@x", "central", "OptIn"), ("c3", None, "central", "OptIn")],
                                "id string, address string, name string, status string")
    args = ("mail", "address", "id", "name", "status", "central", "2024-01-01")
    assert rows(CS.optouts(gone, con, *args, collation=LC), "id") == [("c1",)]
    assert rows(CS.optouts(gone, con, *args), "id") == []


def test_a_collated_update_multiplies_nothing(spark):
    t = spark.range(1000).select(F.concat(F.lit("User"), F.col("id") % 50).alias("k"), F.lit(0).alias("v"))
    s = spark.range(50).select(F.concat(F.lit("USER"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    out = C.update_from(t, s, ["k"], {"v": "src_v"}, collation=LC)
    assert out.count() == 1000 and out.agg(F.sum("v")).first()[0] == 20 * sum(range(50))
