"""Cleaning report, import assembly and star join on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from guestfold.operators import identity as I
from guestfold.operators import report as R

PEOPLE = [(1, "ANNA", "Muster", "a@b.example"), (2, "anna", "von Berg", " x@y.example"), (3, "Jo3", "Ok", "No-At"), (4, "J", "Öz", "a..b@c.example"),
          (5, "Test", "O'Neil-Smith Jr.", "A@b.example"), (6, None, None, None), (7, "Ana", " ", ""), (8, "Ivo", "Bär*", "a b@c.example"), (9, "É", "Sure", "x@y")]


def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, fname string, lname string, email string")


def test_findings_by_rule(spark):
    got = {}
    for r in R.finding_rows(people(spark), ["id"], R.contact_findings()).collect():
        got.setdefault(r.finding, []).append(r.id)
    assert {k: sorted(v) for k, v in got.items()} == {
        "all_caps": [1], "all_lower": [2], "digits": [3], "odd_characters": [3, 8], "one_character": [4],
        "placeholder": [5], "email_format": [2, 3, 4, 7, 8, 9], "email_outer_blanks": [2], "email_case": [3, 5]}


def test_report_counts_missing_fields_in_scope_and_findings_everywhere(spark):
    df = people(spark)
    got = {r["check"]: r.n for r in R.contact_report(df, ["fname", "lname"], R.contact_findings(), scope=F.col("id") >= 5).collect()}
    assert (got["total"], got["fname_missing"], got["lname_missing"]) == (5, 1, 2)
    assert (got["null_email"], got["blank_email"], got["has_email"]) == (1, 1, 3)
    assert got["email_format"] == 6 and got["all_caps"] == 1
    none = {r["check"]: r.n for r in R.contact_report(df.where("false"), ["fname"], R.contact_findings()).collect()}
    assert set(none.values()) == {0}


def frames(spark):
    st = spark.createDataFrame([("u1", "Ann", "a@x"), ("u1", "Ann", "a@x"), ("u2", "Bob", "b@x"), ("u3", "Cy", "c@x"), ("u4", "Di", "d@x"),
                                (None, "Ann", "a@x"), ("u6", None, "a@x"), ("u7", "Ann", None), ("u8", "ann", "A@x")], "uid string, fname string, email string")
    cp = spark.createDataFrame([("p1", "a@x", "003A"), ("p2", "b@x", "001B"), ("p3", "c@x", "003C"), ("p4", "d@x", "003D"), ("p5", None, "003E")],
                               "Id string, EmailAddress string, PartyID__c string")
    ac = spark.createDataFrame([("ac1", "003A", "a@x", "Ann"), ("ac2", "001B", "b@x", "Bob"), ("ac3", "003C", "c@x", "Other"), ("ac4", "003D", "other@x", "Di")],
                               "Id string, PersonContactId string, PersonEmail string, FirstName string")
    me = spark.createDataFrame([("m1", "003A"), ("m2", "003A"), ("m3", "003C"), ("m4", None)], "Id string, ContactId string")
    return st, cp, ac, me


def test_import_assembly(spark):
    def run(**more):
        out = I.assemble_import(*frames(spark), {"first_name": F.col("fname")}, "uid", "b1", "src", **more)
        return sorted((str(r.external_id), r.sf_account_id, r.sf_person_contact_id, r.sf_loyalty_member_id, r.sf_cp_email_id, r.first_name) for r in out.collect())

    ann = [("ac1", "003A", m, "p1", "Ann") for m in ("m1", "m2")]
    # repeated staging rows give one row a member; other party kinds, names and e-mails give none
    assert run() == [("None", *x) for x in ann] + [("u1", *x) for x in ann]
    assert run(skip=["u9"]) == [("u1", *x) for x in ann]  # NOT IN drops the row without an id
    assert run(skip=["u1"]) == []
    assert [x[0] for x in run(skip=["u1"], collation="UTF8_LCASE")] == ["u8", "u8"]
    with pytest.raises(ValueError):
        I.assemble_import(*frames(spark), {}, "uid", " ", "src")


def test_star_takes_any_frames_and_a_dimension_twice(spark):
    fact = spark.createDataFrame([(1, 10, 20), (2, 10, None), (3, 99, 20)], "id int, a int, b int")
    dim = spark.createDataFrame([(10, "x", 7), (20, "y", 8)], "k int, name string, up int")
    top = spark.createDataFrame([(7, "t7"), (8, "t8")], "k int, label string")
    dims = [(dim, "a", "k", {"name": "a_name", "up": "a_up"}), (dim, "b", "k", {"name": "b_name"}), (top, "a_up", "k", {"label": "top"})]
    assert [(r.id, r.a_name, r.b_name, r.top) for r in R.star(fact, dims).collect()] == [(1, "x", "y", "t7")]
    left = {r.id: (r.a_name, r.b_name, r.top) for r in R.star(fact, dims, "left").collect()}
    assert left == {1: ("x", "y", "t7"), 2: ("x", None, "t7"), 3: (None, "y", None)}
    with pytest.raises(ValueError):
        R.star(fact, [(dim, "a", "k", {"name": "b"})])
