"""Target records, selections and hotel reports on small hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from guestfold.operators import fieldmaps as M
from guestfold.operators import hotel as H


def record(df, name, params=None):
    return M.target_records(df, name, params).first().asDict()


def test_reservation_record(spark):
    row = spark.sql("""select 'r1' reservation_id, 'b1' booking_id, 0 central_consent, timestamp_ntz'2026-05-04 14:00:00' arrival_at,
        date'1980-02-29' birth_date, 'a@b@x' email, 1 is_email_invalid, repeat('x', 50) city, 3 room_nights, cast(null as string) phone""")
    r = record(row, "reservation")
    assert (r["ReservationID__c"], r["BookingID__c"], r["ConsentCentral__c"], r["ConsentProperty__c"], r["LoyaltyPointsAwarded__c"]) == (
        "r1", "b1", "False", "True", "True")
    assert (r["Arrival__c"], r["ProfileBirthdate__c"]) == ("2026-05-04T14:00:00Z", "1980-02-29T00:00:00Z")
    assert (r["ProfileEmail__c"], r["ProfileEmailRaw__c"], r["ProfileMailingCity__c"]) == ("", "a@b@x", "x" * 40)
    assert (r["RoomNights__c"], r["ProfileMobilePhone__c"], r["Departure__c"], r["MarketSegmentCode__c"]) == ("3", "", "", "")
    assert len(r) == 49 and None not in r.values()
    for missing in ("cast(null as string)", "''"):
        with pytest.raises(Exception, match="Missing ReservationID__c"):
            M.target_records(spark.sql(f"select {missing} reservation_id"), "reservation").collect()


def test_other_records_leave_nulls_out(spark):
    c = record(spark.sql("select 7 cluster_id, 'crm' source, 'Ann' clean_first_name, date'1990-01-02' birth_date"), "contact", {"record_type": "rt"})
    assert (c["ClusterID__c"], c["ClusterID__pc"], c["RecordTypeId"], c["SourceSystem__c"], c["SourceSystem__pc"]) == (7, 7, "rt", "crm", "crm")
    assert (c["FirstName"], c["Birthdate"], c["LastName"], c["PersonEmail"]) == ("Ann", "1990-01-02T00:00:00Z", None, None)
    u = record(spark.sql("select '001' sf_account_id, date'1990-01-02' birth_date, 0 invest_customer"), "contact_update")
    assert (u["Id"], u["PersonBirthdate"], u["InvestCustomer__pc"], u["InvestmentStatus__pc"]) == ("001", "1990-01-02", False, None)
    assert record(spark.sql("select cast(null as int) invest_customer"), "contact_update")["InvestCustomer__pc"] is None
    assert record(spark.sql("select 'c' cpc_id"), "optout", {"today": "T"}) == {"Id": "c", "PrivacyConsentStatus": "OptOut", "EffectiveTo": "T"}
    assert record(spark.sql("select 'M1' member_number_new, 'gold' member_tier"), "member") == {
        "MembershipNumber": "M1", "LegacyMemberId__c": None, "LegacyTier__c": "gold"}
    assert record(spark.sql("select 'n' preference_name, 5 contact_id"), "preference")["IsActive__c"] is True


def test_selections(spark):
    p = spark.createDataFrame([(1, 1, "f"), (2, 0, "f"), (3, 1, None)], "k int, is_active int, form_id string")
    assert [r.k for r in M.active_properties(p).collect()] == [1]
    rc = spark.createDataFrame([("A", None), ("B", "Plan")], "rate_code string, plan_name string")
    assert [r.name for r in M.rate_codes(rc).collect()] == ["A", "Plan"]
    res = spark.createDataFrame([(1, "Confirmed", None, "2026-05-03", 0), (2, "Confirmed", "s", "2026-05-03", 0), (3, "Optional", None, "2026-05-03", 0),
                                 (4, "Confirmed", None, "2026-05-02", 0), (5, "Confirmed", None, "2026-05-03", 1)],
                                "k int, reservation_status string, sf_reservation_id string, d string, _excluded int").withColumn("departure_at", F.to_timestamp_ntz("d"))
    assert [r.k for r in M.open_reservations(res, "2026-05-03").collect()] == [1]
    acc = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "k int, has_active_loyalty int")
    ids = spark.createDataFrame([(1, "c1"), (2, "c2")], "cluster int, contact string")
    assert [(r.k, r.contact, str(r.enrollment_date)) for r in M.loyal_accounts(acc, ids, "k", "cluster", "2026-01-01").collect()] == [(1, "c1", "2026-01-01")]


def test_occupancy_from_history(spark):
    d = dt.date(2025, 2, 1)
    rows = [(d, 1, 10, 1, 1, 1, 2, 1, 0, 0, 0), (d, 1, 10, 2, 1, 1, 1, 0, 0, 0, 0), (d, 1, 10, 3, 1, 1, 9, 9, 9, 9, 9), (d, 1, 10, 1, 4, 1, 9, 9, 9, 9, 9),
            (d, 1, 11, 1, 1, 1, 9, 9, 9, 9, 9), (dt.date(2025, 3, 1), 1, 10, 1, 1, 1, 9, 9, 9, 9, 9), (d, 9, 10, 1, 1, 1, 9, 9, 9, 9, 9),
            (d, 2, 10, 1, 1, None, 3, 1, 0, 0, None)]
    daily = spark.createDataFrame(rows, "day date, pms_id int, account int, status int, room_type int, room_nights int, adults int, children_1 int, "
                                        "children_2 int, children_3 int, children_4 int")
    never = dt.date(1900, 1, 1)
    book = spark.createDataFrame([(10, 0, 1, never), (10, 0, 1, never), (11, 1, 1, never), (11, 0, 0, never), (11, 0, 1, d)],
                                 "account int, share_kind int, is_room int, cancelled_on date")
    props = spark.createDataFrame([(1, "P1", "One"), (2, "P2", "Two")], "pms_id int, property_id string, name string")
    got = sorted(tuple(r) for r in H.occupancy_from_history(daily, book, props, "2025-02-01", "2025-03-01").collect())
    assert got == [(d, 1, "P1", "One", 2, 4, 3, 1), (d, 2, "P2", "Two", 0, 0, 3, 0)]


def test_occupancy_from_slices_and_day_kpis(spark):
    d = dt.date(2025, 2, 1)
    sl = spark.createDataFrame([("a", d, 1), ("a", dt.date(2025, 2, 2), 1), ("b", d, 1), ("c", d, 1), ("a", d, 2), ("e", d, 1)], "parent_id string, day date, unit_group int")
    res = spark.createDataFrame([("a", "P1", "Confirmed", 2), ("b", "P1", "NoShow", 2), ("c", "P1", "InHouse", None), ("e", "P1", None, 5)],
                                "res_id string, property_id string, status string, adults int")
    props = spark.createDataFrame([(1, "P1", "One")], "pms_id int, property_id string, name string")
    units = spark.createDataFrame([(1, "BedRoom"), (2, "ParkingLot")], "unit_group int, type string")
    kids = spark.createDataFrame([("a",), ("a",), ("c",)], "parent_id string")
    occ = H.occupancy_from_slices(sl, res, props, units, kids, "2025-02-01", "2025-03-01")
    assert sorted(tuple(r) for r in occ.collect()) == [(d, 1, "P1", "One", 2, 5, 2, 3), (dt.date(2025, 2, 2), 1, "P1", "One", 1, 4, 2, 2)]
    day = dt.date(2025, 2, 2)
    got = sorted(tuple(r) for r in H.day_kpis({"s": occ}, "2025-02-02").collect())
    assert got == [("P1_BEDNIGHT1", 4, day, "s", 1, "One"), ("P1_OPEN1", 1, day, "s", 1, "One"), ("P1_ROOMNIGHT1", 1, day, "s", 1, "One")]
    none = occ.withColumns({"room_nights": F.lit(0).cast("bigint"), "bed_nights": F.lit(0).cast("bigint")})
    assert [r.value for r in H.day_kpis({"s": none}, "2025-02-02").where("kpi = 'P1_OPEN1'").collect()] == [0]


def test_reservation_revenue(spark):
    fol = spark.createDataFrame([(1, "r1", "Guest", "ClosedWithInvoice"), (2, "r1", "Guest", "ClosedWithInvoice"), (3, "r2", "Guest", "Open"),
                                 (4, "r3", "House", "ClosedWithInvoice")], "folio_id int, reservation_id string, type string, status string")
    ch = [(1, 1, "Accommodation", "100", 1, None, None), (1, 2, "NoShow", "10", 1, None, None), (1, 3, "CityTax", "5", 1, None, None),
          (1, 4, "Other", "7", 0, None, None), (1, 5, "Other", "7", 1, "x", None), (1, 6, "Other", "7", 1, None, "x"), (1, 7, None, "7", 1, None, None),
          (1, 8, "Parking", "3", 1, None, None), (2, 1, "FoodAndBeverages", "20", 1, None, None), (3, 1, "Other", "9", 1, None, None), (4, 1, "Other", "9", 1, None, None)]
    chg = spark.createDataFrame(ch, "folio_id int, charge_id int, service_type string, amount string, is_posted int, routed_to string, moved_to string")
    alw = spark.createDataFrame([(1, 1, "30", None), (1, 1, "5", None), (1, 1, "50", "x"), (2, 2, "1", None)], "folio_id int, charge_id int, amount string, moved_to string")
    got = [tuple(r) for r in H.reservation_revenue(fol, chg, alw).collect()]
    assert got == [("r1", Decimal("75.0000"), Decimal("20.0000"), None, Decimal("98.0000"))]


def test_commercial_units(spark):
    fact = spark.createDataFrame([(dt.date(2025, 2, 1), "P1", "x", "1.005", None, 1, 2), (dt.date(2025, 2, 9), "P1", "x", None, "2", None, 1),
                                  (dt.date(2025, 3, 1), "P1", "y", "1", "1", 1, 1)],
                                 "rev_date date, property_id string, segment_group string, t string, r string, room_nights int, bed_nights int")
    fact = fact.withColumns({"revenue_total": F.col("t").cast("decimal(18,4)"), "revenue_room": F.col("r").cast("decimal(18,4)")})
    seg = spark.createDataFrame([("x", "Leisure")], "segment_group string, report_segment string")
    got = sorted(tuple(r) for r in H.commercial_units({"s": fact}, {"s": seg}, ["property_id"]).collect())
    assert got == [("2025-02", "P1", "x", "Leisure", Decimal("1.010"), Decimal("2.000"), 1, 3, "s"),
                   ("2025-03", "P1", "y", None, Decimal("1.000"), Decimal("1.000"), 1, 1, "s")]


def test_select_import_and_member_export(spark):
    from guestfold.operators import identity as I
    cols = "list_id int, missing_name int, exclude_email int, current_opt_in string, member_tier string, sf_contact_id string, is_investor int, cell_phone string, home_phone string"
    rows = [(1, 0, 0, "Yes", None, None, 0, None, "h"), (2, 0, 0, "No", "gold", None, 0, "c", "h"), (3, 0, 0, "No", None, None, 0, "c", "h"),
            (4, 1, 0, "Yes", None, None, 1, "c", "h"), (5, 0, 1, "Yes", None, None, 1, "c", "h"), (6, 0, 0, "Yes", None, "x", 1, "c", "h"),
            (7, 0, 0, None, None, None, 0, "c", "h")]
    p = spark.createDataFrame(rows, cols)
    got = {r.source_id: (r.phone, r.source, r.birth_place, r.clean_first_name) for r in I.select_import(p).collect()}
    assert got == {1: ("h", "gms", None, None), 2: ("c", "gms", None, None)}
    assert [r.source_id for r in I.select_import(p, investors=True).collect()] == [5]
    a = spark.createDataFrame([(1, "A", "B", "e", "M1", "gold", "c1"), (2, "A", "B", "e", "M2", None, "c2"), (3, "A", "B", "e", "M3", "gold", None)],
                              "cluster_id int, clean_first_name string, clean_last_name string, clean_email string, member_number_new string, "
                              "member_tier string, sf_contact_id string")
    assert [tuple(r) for r in I.member_export(a).collect()] == [(1, "A", "B", "e", "M1")]


def test_split_property_and_rates(spark):
    from guestfold.operators import change as C
    r = spark.createDataFrame([(1, 14, "AVA", "X"), (2, 14, "ZZZ", "X"), (3, 15, "AVA", "X"), (4, 14, None, "X")],
                              "k int, property_pms_id int, unit_group_code string, property_id string")
    got = {x.k: (x.property_pms_id, x.property_id) for x in C.split_property(r, 14, ["AVA"], {"property_id": "N", "property_pms_id": 100}).collect()}
    assert got == {1: (100, "N"), 2: (14, "X"), 3: (15, "X"), 4: (14, "X")}
    rates = spark.createDataFrame([("CZK", 2026, 4, 1.0), ("CZK", 2026, 5, 1.0), ("CZK", 2026, 9, 1.0), ("CZK", 2025, 9, 1.0), ("RSD", 2026, 9, 1.0), (None, 2026, 9, 1.0)],
                                  "cur string, y int, m int, rate double")
    fix = spark.createDataFrame([("CZK", 2026, 5, 24.0), ("CZK", 2026, 8, 25.0)], "cur string, y int, from_month int, rate double")
    got = sorted((str(x.cur), x.y, x.m, x.rate) for x in C.correct_rates(rates, fix, "cur", "y", "m", "rate").collect())
    assert got == [("CZK", 2025, 9, 1.0), ("CZK", 2026, 4, 1.0), ("CZK", 2026, 5, 24.0), ("CZK", 2026, 9, 25.0), ("None", 2026, 9, 1.0), ("RSD", 2026, 9, 1.0)]
