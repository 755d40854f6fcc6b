"""Identity, consent, stays and report operators on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from guestfold.operators import consent as CS
from guestfold.operators import identity as I
from guestfold.operators import keys as K
from guestfold.operators import report as REP
from guestfold.operators import stays as S


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_match_rules_first_rule_wins(spark):
    a = spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2"), (3, "z", "d3")], "id int, ext string, day string")
    b = spark.createDataFrame([(10, "x", "d9"), (11, "q", "d1"), (12, "q", "d2"), (13, "w", "d2")],
                              "bid int, ext string, day string")
    got = {r.id: (r.match_key, r.rule) for r in
           I.match_rules(a, b, "id", "bid", [(["ext"], ["ext"]), (["day"], ["day"])]).collect()}
    assert got == {1: (10, 1), 2: (12, 2)}


def test_backfill_only_when_all_agree(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "keep")], "k int, v string")
    links = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "c"), (1, None)], "k int, v string")
    got = {r.k: r.v for r in I.backfill_unique(df, links, "k", "v", "v").collect()}
    assert got == {1: "a", 2: None, 3: "keep"}


def test_loyalty_pick_null_dates_last(spark):
    df = spark.createDataFrame([(1, None, 5.0, 1), (1, ts("2024-01-02"), 1.0, 2), (2, None, 1.0, 3), (2, None, 9.0, 4)],
                               "m int, t timestamp_ntz, v double, id int")
    got = {r.m: r.id for r in I.loyalty_pick(df, "m", "t", "v", "id").collect()}
    assert got == {1: 2, 2: 4}


def test_classify_import(spark):
    df = spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, "Cy")], "k int, name string")
    df = df.union(spark.createDataFrame([(4, None), (5, "Di"), (6, "Eve"), (None, "X")], "k int, name string"))
    tgt = spark.createDataFrame([(1, "Ann"), (2, "Robert"), (4, "Fay"), (5, "Di"), (5, "Dia"), (6, None), (None, "Y")], "tk int, tname string")
    got = {r.k: (r.operation, r.conflict_reason) for r in
           I.classify_import(df, tgt, ("k", "tk"), ("name", "tname")).collect()}
    assert got == {1: ("update", None), 2: ("none", "name_conflict"), 3: ("create", None),
                   4: ("update", None), 5: ("none", "name_conflict"), 6: ("update", None), None: ("create", None)}


def test_attach_ids_person_accounts_only(spark):
    df = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (3, "c@x")], "k int, e string")
    acc = spark.createDataFrame([("a@x", "001A", "s1"), ("b@x", "003B", "s2"), ("a@x", "001Z", "s9")],
                                "email string, account_id string, sso string")
    got = {r.k: (r.account_id, r.sso) for r in
           I.attach_ids(df, acc, ("e", "email"), ["account_id", "sso"], "account_id").collect()}
    assert got == {1: ("001A", "s1"), 2: (None, None), 3: (None, None)}


def test_optouts_take_the_current_status(spark):
    unsub = spark.createDataFrame([("a@x",), ("a@x",), ("b@x",), (None,)], "mail string")
    con = spark.createDataFrame([("c1", "a@x", "central", "OptIn"), ("c2", "a@x", "other", "OptIn"), ("c3", "b@x", "central", "OptOut"),
                                 ("c4", "d@x", "central", "OptIn"), ("c5", None, "central", "OptIn"), ("c6", "a@x", "central", "OptIn")],
                                "id string, address string, name string, status string")
    got = sorted((r.id, str(r.effective_to), r.status) for r in
                 CS.optouts(unsub, con, "mail", "address", "id", "name", "status", "central", "2024-01-01").collect())
    assert got == [("c1", "2024-01-01", "OptOut"), ("c6", "2024-01-01", "OptOut")]


def test_missing_consents_two_key_anti_join(spark):
    optin = spark.createDataFrame([("a@x", "News A"), ("a@x", "News B"), ("z@x", "News A")], "email string, name string")
    cpe = spark.createDataFrame([("a@x", "cp1")], "addr string, id string")
    have = spark.createDataFrame([("cp1", "News A")], "cp string, nm string")
    got = [tuple(r) for r in CS.missing_consents(optin, cpe, have, "email", "addr", "id", "cp", "nm", "name")
           .select("email", "name", "id").collect()]
    assert got == [("a@x", "News B", "cp1")]


def test_folio_revenue_classes_and_allowances(spark):
    charges = spark.createDataFrame([(1, 1, "room", 100.0), (1, 2, "fnb", 20.0), (2, 1, "room", 50.0)],
                                    "r int, c int, cls string, amount double")
    alw = spark.createDataFrame([(1, 1, 10.0), (1, 1, 5.0)], "r int, c int, amount double")
    out = {r.r: r for r in S.folio_revenue(charges, alw, ["r", "c"], "r", F.col("cls")).collect()}
    assert float(out[1].revenue_room) == 85.0 and float(out[1].revenue_fnb) == 20.0
    assert out[1].revenue_extra is None and float(out[1].revenue_total) == 105.0
    assert float(out[2].revenue_total) == 50.0


def test_fold_events_both_precedences(spark):
    df = spark.createDataFrame([(1, ts("2024-01-05")), (2, None)], "k int, checkin timestamp_ntz")
    ev = spark.createDataFrame([(1, ts("2024-01-03")), (1, ts("2024-01-04")), (2, ts("2024-01-09"))],
                               "k int, t timestamp_ntz")
    cols = {"checkin": ("t", "min")}
    ev_first = {r.k: r.checkin for r in S.fold_events(df, ev, "k", cols, "event").collect()}
    old_first = {r.k: r.checkin for r in S.fold_events(df, ev, "k", cols, "existing").collect()}
    assert ev_first == {1: ts("2024-01-03"), 2: ts("2024-01-09")}
    assert old_first == {1: ts("2024-01-05"), 2: ts("2024-01-09")}


def test_exclude_keeps_first_reason(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "legacy", 50), (3, None, 50)], "k int, exclude_reason string, v int")
    out = {r.k: (r.exclude_reason, r.excluded) for r in
           S.exclude(df, [("small", F.col("v") < 10), ("big", F.col("v") > 40)]).collect()}
    assert out == {1: ("small", 1), 2: ("legacy", 1), 3: ("big", 1)}


def test_preference_tags_one_pass_distinct(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 0)], "c int, kids int")
    out = S.preference_tags(df, "c", [("Family", "Family", "P3", F.col("kids") > 0),
                                      ("Family", "Family", "P4", F.col("kids") > 0)], "src")
    assert sorted((r.c, r.external_id) for r in out.collect()) == [(1, "P3"), (1, "P4")]


def test_children_and_room_nights(spark):
    df = spark.createDataFrame([(1,), (2,)], "r int")
    kids = spark.createDataFrame([(1,), (1,)], "r int")
    got = {r.r: r.children_num for r in S.child_counts(df, kids, "r").collect()}
    assert got == {1: 2, 2: 0}
    #        status, room category, room no, account, sharer, room type, nights
    cases = [((1, 1, 12, 7, 7, 1, 3), 3), ((1, 1, 12, 7, None, 1, 3), 3), ((3, 1, 12, 7, 7, 1, 3), 0), ((-1, 1, 12, 7, 7, 1, 3), 0),
             ((1, 0, 12, 7, 7, 1, 3), 0), ((1, 1, 0, 7, 7, 1, 3), 0), ((1, 1, 12, 7, 8, 1, 3), 0), ((1, 1, 12, 7, 7, 4, 3), 0),
             ((1, 1, 12, 7, 7, 1, None), 0), ((None, 1, 12, 7, 7, 1, 3), 0), ((1, 1, 12, None, 8, 1, 3), 0)]
    rn = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, s int, c int, n int, a int, sh int, t int, x int")
    got = {r.i: r.v for r in rn.select("i", S.room_nights("s", "c", "n", "a", "sh", "t", "x").alias("v")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_report_helpers(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None)], "k int, v string")
    got = {r.k: r.s for r in df.groupBy("k").agg(REP.string_agg("v", ",").alias("s")).collect()}
    assert got == {1: "a,b", 2: ""}
    fr = {r.field: (r.filled, r.total, r.pct) for r in REP.fill_rates(df, ["v"]).collect()}
    assert fr == {"v": (3, 4, 75.0)}
    lp = REP.length_profile(spark.createDataFrame([("ab",), ("äbc",)], "t string"), {"t": [2]}).first()
    assert (lp.max_len, lp.max_bytes, lp.over_2) == (3, 4, 1)


def test_flag_duplicates_hot_null_key(spark):
    rows = [(None, i) for i in range(40)] + [(1, 1), (1, 2), (2, 1)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = K.flag_duplicates(df, ["k"], ["v"])
    winners = sorted((r.k, r.v) for r in out.where("is_duplicate = 0").collect() if r.k is not None)
    assert winners == [(1, 1), (2, 1)]
    nulls = out.where("k IS NULL")
    assert nulls.where("is_duplicate = 0").count() == 1 and nulls.where("is_duplicate = 0").first().v == 0


def test_citizenship_and_enrolment_fallback(spark):
    from guestfold.functions.cleaning import normalise_citizenship
    df = spark.createDataFrame([("Austrian",), ("HR",), ("Bri",)], "citizenship string")
    tbl = spark.createDataFrame([("Austrian", "AT", 1), ("Bri", "GB", 2), ("Bri", "BR", 3)],
                                "variant string, code string, rank int")
    got = sorted(r.citizenship for r in normalise_citizenship(df, tbl).collect())
    assert got == ["AT", "GB", "HR"]
    d = spark.createDataFrame([(None, "2024-01-03", "2023-05-01")], "s string, t string, c string")
    assert str(d.select(I.enrolment_date("s", "t", "c").alias("e")).first().e) == "2024-01-03"


def test_citizenship_list(spark):
    from guestfold.functions.cleaning import citizenship_rules, normalise_citizenship
    want = {"Swi": "CH", " schweiz ": "CH", "Österreich": "AT", "Aus": "AT", "Uni": "US", "Chi": "CN", "Cro": "HR", "UK": "GB", "Bri": "GB",
            "CS": "CZ", "El": "SV", "KV": "XK", " XK ": "XK", "Gro": "GL", "Gue": "GG", "CIS": None, "Unk": None, "XX": None, "0": None,
            " DE ": "DE", "de": "de", "ZZ": "ZZ", " ZZ ": " ZZ ", "Atlantis": "Atlantis", "": "", None: None}
    df = spark.createDataFrame([(x,) for x in want], "citizenship string")
    assert {r.citizenship: r.o for r in normalise_citizenship(df, out="o").collect()} == want
    assert len({v for v, _, _ in citizenship_rules()}) == 367
    assert normalise_citizenship(df).count() == len(want)


def test_survivors_priority(spark):
    rows = [(1, "apaleo", "a1", 4, 1, "A", "B", "e"), (1, "gms", "g1", 2, 0, "A", "B", "e"),
            (2, "protel", "p1", 3, 0, "A", "B", "e"), (2, "apaleo", "a2", 3, 1, "A", "B", "e"),
            (3, "gms", "g3", 5, 2, "A", "B", "e"), (3, "other", "o3", 1, 1, "A", "B", "e"),
            (4, "gms", "g4", 5, 1, None, "B", "e"), (None, "gms", "gx", 9, 1, "A", "B", "e")]
    df = spark.createDataFrame(rows, "cluster_id long, source string, source_id string, complete_fields int, "
                                     "_rule_bin int, cluster_first_name string, cluster_last_name string, cluster_email string")
    got = {r.cluster_id: r.source_id for r in I.survivors(df).collect()}
    assert got == {1: "g1", 2: "a2", 3: "o3"}


def test_exclude_keeps_a_flag_without_reason(spark):
    df = spark.createDataFrame([(1, 1, None, 20), (2, 0, None, 20), (3, None, None, 5)], "k int, excluded int, exclude_reason string, v int")
    out = {r.k: (r.excluded, r.exclude_reason) for r in S.exclude(df, [("small", F.col("v") < 10)]).collect()}
    assert out == {1: (1, None), 2: (0, None), 3: (1, "small")}


def test_exclude_reservations(spark):
    """One row per statement and per order between two statements."""
    base = dict(source="apaleo", property_code="c", rate_plan_code="BAR", reservation_status="Confirmed", sf_reservation_id=None,
                sf_property_id="p", _overlapped=False, _excluded=0, exclude_reason=None)
    cases = [({}, (0, None)),
             ({"source": "protel", "property_code": None}, (1, None)),
             ({"rate_plan_code": "APPET"}, (1, "apartment owner")),
             ({"rate_plan_code": "OWN", "_excluded": 1}, (1, None)),
             ({"reservation_status": "Optional"}, (1, "optional status")),
             ({"reservation_status": "Optional", "rate_plan_code": "APP"}, (1, "optional status")),
             ({"reservation_status": "Optional", "sf_reservation_id": "a0", "_excluded": 1, "exclude_reason": "old"}, (0, None)),
             ({"sf_property_id": None, "sf_reservation_id": "a0", "exclude_reason": "old"}, (1, "inactive property")),
             ({"sf_property_id": None}, (1, "inactive property")),
             ({"sf_property_id": None, "rate_plan_code": "OWN"}, (1, "apartment owner")),
             ({"source": "protel", "_overlapped": True}, (1, "overlapped")),
             ({"source": "apaleo", "_overlapped": True}, (0, None)),
             ({"reservation_status": "NoShow"}, (1, "cancelled")),
             ({"reservation_status": "Cancelled", "sf_reservation_id": "a0"}, (0, None)),
             ({"reservation_status": "Cancelled", "exclude_reason": "old"}, (1, "old")),
             ({"reservation_status": None, "_overlapped": None}, (0, None))]
    df = spark.createDataFrame([(i, *{**base, **c}.values()) for i, (c, _) in enumerate(cases)],
                               "k int, source string, property_code string, rate_plan_code string, reservation_status string, "
                               "sf_reservation_id string, sf_property_id string, _overlapped boolean, _excluded int, exclude_reason string")
    got = {r.k: (r._excluded, r.exclude_reason) for r in S.exclude_reservations(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_import_sets(spark):
    base = dict(cluster="c1", reservation_status="CheckedOut", sf_person_contact_id="p", sf_property_id="h", is_investor=0,
                market_segment="OTA", email="a@x", booking_id="b", arrival_at="2026-05-01", last_updated_at="2026-01-01", _excluded=0)
    open_ = {"sf_person_contact_id": None, "reservation_status": "Confirmed"}
    cases = [({}, {"history"}), ({"reservation_status": "Optional"}, {"future"}), ({"reservation_status": "NoShow"}, set()),
             ({"is_investor": 1}, set()), ({"cluster": "c2"}, set()), ({"cluster": "c9"}, set()), ({"cluster": None}, set()),
             ({"sf_property_id": None}, set()), ({"last_updated_at": "2026-05-04"}, {"history", "changed_since"}),
             ({"last_updated_at": "2026-05-05", "_excluded": 1}, {"history"}),
             (open_, {"future_unmatched"}), ({**open_, "market_segment": "FIT"}, set()), ({**open_, "email": None}, set()),
             ({**open_, "email": "bulk@x"}, set()), ({**open_, "booking_id": None}, set()), ({**open_, "arrival_at": "2026-04-16"}, set()),
             ({**open_, "reservation_status": "Cancelled"}, set()), ({**open_, "reservation_status": None}, set())]
    df = spark.createDataFrame([(i, *{**base, **c}.values()) for i, (c, _) in enumerate(cases)],
                               "k int, cluster string, reservation_status string, sf_person_contact_id string, sf_property_id string, is_investor int, "
                               "market_segment string, email string, booking_id string, arrival_at string, last_updated_at string, _excluded int")
    df = df.withColumns({c: F.to_timestamp_ntz(c) for c in ("arrival_at", "last_updated_at")})
    persons = spark.createDataFrame([("c1", 0), ("c2", 1)], "cluster string, is_investor int")
    got = {i: set() for i in range(len(cases))}
    for r in S.import_sets(df, persons, "k", "cluster", "2026-05-04", "2026-04-16", ["bulk@x"]).collect():
        got[r.k].add(r.import_set)
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_reservation_preference_rules(spark):
    df = spark.createDataFrame([(1, "FCZ", 0, "X"), (1, "FSV", 2, "J3C"), (2, "FEW", 0, "A")],
                               "cluster_id int, property_id string, children_num int, unit_group_code string")
    got = sorted((r.cluster_id, r.external_id) for r in
                 S.preference_tags(df, "cluster_id", S.reservation_preference_rules(), "apaleo").collect())
    assert got == [(1, "PREF001"), (1, "PREF003"), (1, "PREF004"), (1, "PREF006"), (1, "PREF007"),
                   (2, "PREF002"), (2, "PREF005")]


def test_normalise_reservation(spark):
    rows = [(1, "apaleo", "Canceled", None, None, None, "2024-01-01", "Agent/FIT", "Repeater"),
            (2, "protel", "Confirmed", "2024-01-02", None, None, "2024-01-05", "OTHER", None),
            (3, "protel", None, "2024-01-02", None, None, "2024-01-05", None, "FMTG"),
            (4, "protel", "Confirmed", None, "2024-01-03", None, "2024-01-05", None, None),
            (5, "protel", None, None, None, None, "2024-01-05", None, None),
            (6, "protel", None, None, None, None, "2030-01-05", None, None)]
    df = spark.createDataFrame(rows, "k int, source string, reservation_status string, cancelled_at string, "
                                     "noshow_at string, checkout_at string, departure_at string, market_segment string, "
                                     "travel_purpose string")
    for c in ["cancelled_at", "noshow_at", "checkout_at", "departure_at"]:
        df = df.withColumn(c, F.to_timestamp_ntz(c))
    got = {r.k: (r.reservation_status, r.market_segment, r.travel_purpose)
           for r in S.normalise_reservation(df, "2026-02-28").collect()}
    assert got == {1: ("Cancelled", "FIT", "Leisure"), 2: ("Cancelled", "OTHERS", "Other"), 3: (None, None, None),
                   4: ("NoShow", None, "Other"), 5: ("CheckedOut", None, "Other"), 6: (None, None, "Other")}
