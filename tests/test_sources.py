"""Sources, object pages, incremental landing, strict lookups, consent assembly."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestfold.operators import consent as CS
from guestfold.operators import joins as J
from guestfold.operators import report as REP
from guestfold.operators import stays as S
from guestfold.sources import files as IO
from guestfold.sources import objects as OBJ
from guestfold.streaming import land_stream


def test_read_delimited_keeps_blanks(spark):
    d = IO.scratch_dir(spark, "t-csv")
    df = spark.createDataFrame([("1", None, " a "), ("2", "", "b;c")], "`Key Id` string, `E-Mail` string, `Name!` string")
    (df.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(d))
    out = IO.clean_columns(IO.read_delimited(spark, d, sep=";"))
    assert out.columns == ["key_id", "email", "name"]
    assert sorted(tuple(r) for r in out.collect()) == [("1", "", " a "), ("2", "", "b;c")]


def test_cast_on_load_dates(spark):
    df = spark.createDataFrame([("2024-01-05T10:00:00+01:00", "x"), ("bad", "y")], "CreatedDate string, Name string")
    out = IO.cast_on_load(df, ["CreatedDate"]).withColumn("c", F.col("CreatedDate").cast("timestamp_ntz"))
    got = [str(r.c) for r in out.collect()]
    assert got == ["2024-01-05 09:00:00", "None"]


def test_normalise_values(spark):
    df = spark.createDataFrame([(float("nan"), (1, "a")), (1.5, None)], "v double, s struct<k:int,t:string>")
    got = IO.normalise_values(df).collect()
    assert got[0].v is None and got[0].s == '{"k":1,"t":"a"}' and got[1].v == 1.5 and got[1].s is None
    assert IO.target_schema(df) == [("v", "DOUBLE"), ("s", "VARCHAR(255)")]


def test_flatten_object_pages(spark):
    d = IO.scratch_dir(spark, "t-pages")
    spark.createDataFrame([
        ('{"totalSize": 3, "done": false, "records": [{"attributes": {"type": "Lead"}, "Id": "1", "IsDeleted": false},'
         ' {"attributes": {"type": "Lead"}, "Id": "2", "IsDeleted": true}]}',),
        ('{"totalSize": 3, "done": true, "records": [{"attributes": {"type": "Lead"}, "Id": "3", "IsDeleted": false}]}',)],
        "value string").write.text(d)
    rec = T.StructType([T.StructField("Id", T.StringType()), T.StructField("IsDeleted", T.BooleanType())])
    flat = OBJ.flatten_object_pages(OBJ.read_object_pages(spark, d, rec))
    assert "attributes" not in flat.columns
    live = OBJ.select_spec(flat, "Lead", columns=["Id", "total_size"])
    assert sorted(tuple(r) for r in live.collect()) == [("1", 3), ("3", 3)]


def test_land_stream_incremental(spark):
    base = IO.scratch_dir(spark, "t-stream")
    src, dst = f"{base}/in", f"{base}/out"
    schema = T.StructType([T.StructField("Id", T.StringType()), T.StructField("Email", T.StringType())])
    spark.createDataFrame([("1", " A@X.ORG ")], schema).write.json(f"{src}/b1")
    clean = lambda df: df.withColumn("Email", F.lower(F.trim("Email")))
    land_stream(spark, f"{src}/*", schema, dst, transform=clean, checkpoint=f"{base}/ckpt").awaitTermination()
    spark.createDataFrame([("2", "b@y.org")], schema).write.json(f"{src}/b2")
    land_stream(spark, f"{src}/*", schema, dst, transform=clean, checkpoint=f"{base}/ckpt").awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(dst).collect()) == [("1", "a@x.org"), ("2", "b@y.org")]


def test_lookup_strict_raises_on_unknown(spark):
    df = spark.createDataFrame([("A",), (None,)], "code string")
    dim = spark.createDataFrame([("A", "Alpha")], "code string, label string")
    assert sorted(J.lookup_strict(df, dim, "code", "label").collect(), key=str)[0].label == "Alpha"
    with pytest.raises(Exception):
        J.lookup_strict(spark.createDataFrame([("B",)], "code string"), dim, "code", "label").collect()


def test_build_consent_party_type_and_merge(spark):
    cpc = spark.createDataFrame([("c1", "e1", "003x", "2024-01-01"), ("c2", None, "00Qy", None)],
                                "Id string, ContactPointId string, PartyID__c string, CaptureDate string")
    cpe = spark.createDataFrame([("e1", "a@x.org")], "Id string, EmailAddress string")
    acc = spark.createDataFrame([("003x", "001a")], "PersonContactId string, AccountId string")
    out = {r.Id: r for r in CS.build_consent(cpc, cpe, acc, ["CaptureDate"]).collect()}
    assert out["c1"].EmailAddress == "a@x.org" and out["c1"].AccountId == "001a" and out["c1"].PartyType == "Contact"
    assert out["c2"].PartyType == "Lead" and out["c2"].Id_cpe is None


def test_occupancy_kpis_one_day(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = li.select(F.to_date("l_shipdate").alias("d")).first().d.isoformat()
    out = REP.occupancy_kpis(li, spark.read.parquet(f"{sf_dir}/orders.parquet"),
                             spark.read.parquet(f"{sf_dir}/events.parquet"), day)
    assert {r.day.isoformat() for r in out.collect()} <= {day}


def test_segment_and_purpose_maps(spark):
    df = spark.createDataFrame([("Agent/FIT", "Repeater"), ("Account", None), ("odd", "Other")], "s string, p string")
    got = [(r.a, r.b) for r in df.select(S.normalise_segment("s").alias("a"), S.normalise_purpose("p").alias("b")).collect()]
    assert got == [("FIT", "Leisure"), ("OTHERS", "Other"), ("odd", None)]


def test_standardise_and_attach_property(spark):
    raw = spark.createDataFrame(
        [("r1", "P1", "b1", "G", "2024-01-01 00:00:00", "2024-01-04 10:00:00", 0, "BedRoom"),
         ("r2", "P2", "b2", None, "2024-01-05 00:00:00", "2024-01-04 00:00:00", 9, "BedRoom"),
         ("r3", "P1", "b3", None, "2024-01-05 00:00:00", None, 0, "Parking")],
        "id string, property__id string, booking_id string, group_name string, arrival string, departure string, "
        "company__id int, unit_group__type string") \
        .withColumn("arrival", F.to_timestamp_ntz("arrival")).withColumn("departure", F.to_timestamp_ntz("departure"))
    comp = spark.createDataFrame([(0, "ACME")], "id int, code string")
    std = S.standardise_reservations(raw, comp, "pms")
    got = {r.reservation_id: (r.group_name, r.room_nights, r.booker_company_id) for r in std.collect()}
    assert got == {"r1": ("b1 | G", 3, "ACME"), "r2": (None, 0, None)}
    props = spark.createDataFrame([("P1", "F1", 7, "a01", True), ("P2", "F2", 8, "a02", False)],
                                  "code string, group_code string, pms_id long, target_id string, is_active boolean")
    att = {r.reservation_id: (r.property_code, r.property_pms_id, r.sf_property_id)
           for r in S.attach_property(std, props).collect()}
    assert att == {"r1": ("F1", 7, "a01"), "r2": (None, None, None)}


def test_recover_email_fills_missing_addresses(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "own@mail.org"), (5, None), (6, None)], "k int, email string")
    raw = spark.createDataFrame([(1, "x@guest.Booking.com"), (2, "real@mail.org"), (3, "y@m.expediapartnercentral.com"), (3, "a@hrs.de"),
                                 (4, "z@hrs.de"), (5, "w@hrs.de"), (5, "v@hrs.de"), (6, None)], "k int, email string")
    got = {r.k: r.email for r in S.recover_email(df, raw, "k", "email").collect()}
    assert got == {1: "x@guest.Booking.com", 2: None, 3: "y@m.expediapartnercentral.com", 4: "own@mail.org", 5: "v@hrs.de", 6: None}


def test_infer_from_name(spark):
    from guestfold.functions.cleaning import infer_from_name
    rows = [(i, "Anna", "Female") for i in range(9)] + [(9, "Anna", "Male"), (10, " anna ", None), (11, "Kim", None)]
    df = spark.createDataFrame(rows, "id int, fname string, gender string")
    got = {r.id: r.gender for r in infer_from_name(df, "fname", "gender", 5, 0.8).collect()}
    assert got[10] == "Female" and got[11] is None and got[9] == "Male"


def test_flag_in_window_overlapping_windows(spark):
    df = spark.createDataFrame([(1, 5), (1, 50), (2, 7), (3, 1)], "k int, ts int")
    w = spark.createDataFrame([(1, 0, 10), (1, 3, 8), (2, 8, None)], "k int, lo int, hi int")
    got = sorted(tuple(r) for r in J.flag_in_window(df, w, "k", "ts", "lo", "hi", "inside").collect())
    assert got == [(1, 5, 1), (1, 50, 0), (2, 7, 0), (3, 1, 0)]


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    from guestfold.operators.change import upsert
    from guestfold.plans.tables import orders_new, table
    cols = ["o_custkey", "o_orderstatus", "o_totalprice"]
    t = IO.write_bucketed(table(spark, sf_dir, "orders").select("o_orderkey", *cols), "wk_orders_old", ["o_orderkey"], 8)
    n = IO.write_bucketed(orders_new(spark, sf_dir).select("o_orderkey", *cols), "wk_orders_new", ["o_orderkey"], 8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert(t, n, ["o_orderkey"], cols, "2024-01-01")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert out.count() >= t.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_read_query_binds_values_and_frames(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b'; DROP"), (3, "c")], "k int, v string")
    codes = IO.values_df(spark, [("a", "Alpha"), ("c", "Gamma")], "code string, label string")
    out = IO.read_query(spark, "SELECT t.k, m.label FROM {t} t JOIN {m} m ON m.code = t.v WHERE t.k >= :lo",
                        {"lo": 2}, t=df, m=codes)
    assert [tuple(r) for r in out.collect()] == [(3, "Gamma")]
    # a value is bound, never pasted into the SQL text
    hit = IO.read_query(spark, "SELECT k FROM {t} WHERE v = :v", {"v": "b'; DROP"}, t=df)
    assert [r.k for r in hit.collect()] == [2]


def test_land_materialise_and_insert_select(spark):
    base = IO.scratch_dir(spark, "t-land")
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    landed = IO.materialise(df, f"{base}/landed")
    assert landed.count() == 2 and IO.read_landed(spark, f"{base}/landed").columns == ["k", "v", "w"]
    extra = spark.createDataFrame([(3, "c")], "k int, v string")
    ins = IO.insert_select(landed, extra, ["k", "v"])
    assert sorted(tuple(r) for r in ins.collect()) == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]


def test_a_batch_of_rejects_is_one_file(spark):
    import os

    path = IO.scratch_dir(spark, "rejects-files").removeprefix("file:")
    df = spark.range(2000).repartition(8).select((F.col("id") % 20).alias("batch_no"), F.col("id").alias("k"))
    IO.write_rejects(df, path)
    files = [n for d, _, names in os.walk(path) for n in names if n.startswith("part-")]
    assert len(files) == 20
    assert spark.read.schema("k long, batch_no long").json(path).agg(F.count("*"), F.sum("k")).first() == (2000, 1999 * 1000)
