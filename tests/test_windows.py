"""Rows in time windows by bins against brute force, and the statements on consents, matches and property ids on hand-written rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from guestfold.operators import consent as CS
from guestfold.operators import identity as I
from guestfold.operators import joins as J
from guestfold.operators import stays as S


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "bigint"])
def test_flag_in_window_equals_brute_force(spark, kind):
    rng = random.Random(kind)
    start = {"date": dt.date(1965, 1, 1), "timestamp_ntz": dt.datetime(1969, 12, 31), "bigint": -50}[kind]
    step = {"date": dt.timedelta(1), "timestamp_ntz": dt.timedelta(seconds=977), "bigint": 1}[kind]
    at = lambda n: start + step * n
    rows = [(i, rng.choice("abcd") if rng.random() < 0.95 else None, at(rng.randrange(4000)) if rng.random() < 0.95 else None) for i in range(400)]
    windows = []
    for _ in range(60):
        a = rng.randrange(4000)
        b = a + rng.choice([-1, 0, 0, 1, 2, 6, 7, 8, 9, 63, 64, 65, 700])
        windows.append((rng.choice("abc"), at(a), None if rng.random() < 0.02 else at(b)))
    windows += [(None, at(0), None), ("d", None, at(9)), ("d", at(3990), None), ("d", at(3995), None)]
    df = spark.createDataFrame(rows, f"id int, k string, t {kind}").withColumn("bin", F.lit("clash")).withColumn("since", F.lit(1))
    w = spark.createDataFrame(windows, f"k string, lo {kind}, hi {kind}")
    got = {r["id"]: r["hit"] for r in J.flag_in_window(df, w, "k", "t", "lo", "hi", "hit").collect()}
    inside = lambda k, t: any(k == x and lo is not None and t is not None and t >= lo and (hi is None or t <= hi) for x, lo, hi in windows)
    assert got == {i: int(k is not None and inside(k, t)) for i, k, t in rows}
    assert 20 < sum(got.values()) < 380
    since = {r["id"]: r["hit"] for r in J.flag_in_window(df, w, "k", "t", "lo", None, "hit").collect()}
    assert since == {i: int(any(k == x and k and lo is not None and t is not None and t >= lo for x, lo, _ in windows)) for i, k, t in rows}


def test_windows_of_a_hot_key_are_not_gathered(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("t"))
    w = df.select("k", F.col("t").alias("lo"), F.date_add("t", 3).alias("hi"))
    plan = J.flag_in_window(df, w, "k", "t", "lo", "hi", "hit")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    bins, _, levels = J.window_levels(w, "k", "lo", "hi")
    assert levels == [0] and bins.count() == 103


def test_property_consents(spark):
    opt = [("FSV", "a@x.at", 1), ("FSV", "a@x.at", 1), ("FJE", "a@x.at", 1), ("FBZ", "b@x.at", 0), ("FBZ", None, 1), ("FMP", "c@OWN.example", 1),
           ("XXX", "a@x.at", 1), ("FMP", "no point", 1)]
    o = spark.createDataFrame(opt, "property_code string, email string, newsletter int")
    p = spark.createDataFrame([("FSV", "s1"), ("FJE", "s2"), ("FBZ", "s3"), ("FMP", "s4")], "code string, sf_property_id string")
    cp = spark.createDataFrame([(1, "a@x.at"), (2, "a@x.at"), (3, "b@x.at"), (4, "c@OWN.example")], "cpe_id int, email string")
    con = spark.createDataFrame([("a@x.at", "s2"), ("b@x.at", "s1"), ("a@x.at", None)], "email string, sf_property_id string")
    got = sorted(map(tuple, CS.property_consents(o, p, cp, con, "list", "own.example").collect()), key=str)
    assert got == sorted([(1, "list", "s1", "marketing_property_Velden"), (2, "list", "s1", "marketing_property_Velden"),
                          (1, "list", None, None), (2, "list", None, None)], key=str)


def test_central_consents(spark):
    o = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "email string")
    cp = spark.createDataFrame([(1, "a", "003x"), (2, "b", "001x"), (3, "c", "003y"), (4, "a", "003z"), (5, None, "003")], "cpe_id int, email string, party_id string")
    con = spark.createDataFrame([(3, "marketing_central"), (1, "marketing_hotel")], "cpe_id int, name string")
    assert sorted(tuple(r) for r in CS.central_consents(o, cp, con, "list").collect()) == [("list", 1), ("list", 4)]


def res(spark, rows):
    names = "reservation_id, email, data_quality_bucket, sf_person_contact_id, sf_reservation_id, sf_property_id"
    return spark.createDataFrame([(*r, None) for r in rows], ", ".join(n + " string" for n in names.split(", ")) + ", _excluded int, sf_person_account_id string")


def test_match_by_list(spark):
    good = "2_has_lastname_and_email"
    r = res(spark, [("r1", "a", good, None, None, "p", 0), ("r2", "a", "1", None, None, "p", 0), ("r3", "a", good, "c", None, "p", 0), ("r4", "a", good, None, "s", "p", 0),
                    ("r5", "a", good, None, None, None, 0), ("r6", "a", good, None, None, "p", 1), ("r7", "z", good, None, None, "p", 0), ("r8", "a", good, None, None, "p", 0),
                    ("r9", None, good, None, None, "p", 0)])
    lists = spark.createDataFrame([(f"r{i}", 1, 0) for i in range(1, 10) if i != 8] + [("r1", 2, 0), ("r8", 1, 1)], "pms_reservation_id string, list_id int, is_duplicate int")
    prof = spark.createDataFrame([(1, "a", "c2", "A2"), (1, "a", "c1", "A1"), (1, "a", None, "A0"), (2, "b", "c0", "A9"), (1, None, "c3", "A3")],
                                 "list_id int, email string, sf_contact_id string, sf_account_id string")
    got = I.match_by_list(r, lists, prof)
    assert [(x.reservation_id, x.sf_person_contact_id, x.sf_person_account_id) for x in got.collect()] == [("r1", "c1", "A1")]


def test_match_by_cluster(spark):
    r = res(spark, [("r1", None, None, "old", None, None, 0), ("r2", None, None, None, "s", None, 0), ("r3", None, None, None, None, None, 1), ("r4", None, None, None, None, None, 0)])
    acc = spark.createDataFrame([("r1", 7), ("r2", 7), ("r3", 7), ("r4", None)], "source_id string, cluster_id int")
    t = spark.createDataFrame([(7, "c9", "A9"), (7, "c1", "A1"), (None, "c0", "A0")], "cluster_id int, sf_contact_id string, sf_account_id string")
    assert [(x.reservation_id, x.sf_person_contact_id, x.sf_person_account_id) for x in I.match_by_cluster(r, acc, t).collect()] == [("r1", "c1", "A1")]


def test_target_property_ids(spark):
    rows = [(1, "protel", 10, None, None), (2, "protel", 10, "FSV", "keep"), (3, "protel", 99, "FSV", None), (4, "apaleo", None, "FSV", "old"), (5, "apaleo", 10, "NEW", "old"),
            (6, "other", 10, "FSV", None), (7, None, 10, "FSV", "x")]
    df = spark.createDataFrame(rows, "id int, source string, property_pms_id int, property_id string, sf_property_id string")
    attrs = spark.createDataFrame([(10, "FJE"), (11, "FSV"), (None, "FSV")], "pms_id int, code string")
    ids = spark.createDataFrame([("FJE", "t1"), ("FSV", "t2")], "code string, sf_id string")
    got = {r["id"]: r["sf_property_id"] for r in S.target_property_ids(df, attrs, ids).collect()}
    assert got == {1: "t1", 2: "keep", 3: None, 4: "t2", 5: "old", 6: None, 7: "x"}


def test_incomplete_pages_raise_and_new_fields_appear(spark, tmp_path):
    import json

    from guestfold.sources import objects as OBJ
    page = lambda total, done, *records: json.dumps({"totalSize": total, "done": done, "records": list(records)})
    a, b, c = {"attributes": {"type": "A"}, "Id": "1"}, {"Id": "2", "New__c": 5, "Deep": {"x": [1]}}, {"Id": "3", "New__c": None}
    write = lambda name, *pages: ((tmp_path / name).write_text("\n".join(pages)), str(tmp_path / name))[1]
    got = OBJ.read_all_fields(spark, write("whole.json", page(3, False, a, b), page(3, True, c)))
    assert got.columns == ["Deep", "Id", "New__c"] and {t for _, t in got.dtypes} == {"string"}
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [(None, "1", None), ('{"x":[1]}', "2", "5"), (None, "3", None)]
    for name, pages in {"missing": [page(3, False, a, b)], "twice": [page(3, True, c), page(3, False, a, b), page(3, True, c)], "grown": [page(3, False, a, b), page(4, True, c)],
                        "no_end": [page(3, False, a, b), page(3, False, c)]}.items():
        with pytest.raises(ValueError, match="records"):
            OBJ.read_all_fields(spark, write(f"{name}.json", *pages))
    assert OBJ.read_all_fields(spark, write("empty.json", page(0, True))).collect() == []


def test_reservation_view(spark):
    from guestfold.sources import views as V
    day = lambda n: dt.date(2026, 1, n)
    res = spark.createDataFrame([("r1", "d1", "P1", day(5), 2, " at "), ("r2", "d2", "P1", day(1), 2, None), ("r3", "d3", "P2", day(9), None, "DE"), ("r4", "d4", "P1", day(6), 1, "x"),
                                 ("r5", "d5", "P1", day(7), 1, "x"), ("r6", "d6", None, day(7), 1, "x")],
                                "id string, row_id string, property__id string, created date, adults int, primary_guest__address__country_code string")
    props = spark.createDataFrame([("P1", "o1", day(3)), ("P2", "o2", None)], "code string, own_id string, switch_from date")
    kids = spark.createDataFrame([("d1",), ("d1",)], "parent_id string")
    cl = spark.createDataFrame([("r1", 1), ("r2", 1), ("r3", 2), ("r5", None), ("r6", 2)] + [("r4", 3)] * 5 + [("r1", 4)] * 10, "reservation_id string, cluster_id int")
    got = V.reservation_view(res, props, kids, cl)
    assert len(got.columns) == 49 and got.select("pg_email").distinct().collect()[0][0] is None
    rows = sorted(tuple(r) for r in got.select("reservation_id", "property_own_id", "mk_country", "adults_num", "children_num", "cluster_id", "guest_role").collect())
    # r2 came before the switch, r3's property never switched, r4's cluster has 5 members
    assert rows == [("r1", "o1", "at", 2, 2, 1, "PRIMARY")] + [("r1", "o1", "at", 2, 2, 4, "PRIMARY")] * 10


def test_filters_on_the_view_reach_the_scan(spark, sf_dir):
    from guestfold.plans import QUERIES
    plan = QUERIES["reservation_view"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
