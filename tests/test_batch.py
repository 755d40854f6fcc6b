"""Load-batch lifecycle: lines per batch, payloads, outcomes, guards, writes."""

import pytest
from pyspark.sql import functions as F

from guestfold.operators import batch as B
from guestfold.operators import keys
from guestfold.sources import files as IO
from guestfold.sources.publish import AuditError, TableSet, archive_batch


def test_bulk_csv_lines_header_per_batch(spark):
    df = spark.createDataFrame(
        [(1, "Ann", None, True, 1, 1), (2, None, None, None, 2, 1), (3, "Bo, Jr", 'say "hi"', False, 3, 2),
         (4, "", None, None, 4, 2)],
        "Id long, Name string, Note string, Vip boolean, seq long, batch_no long")
    lines = {(r.batch_no, r.line_no): r.line for r in B.bulk_csv_lines(df, "Id", "batch_no", "seq", 2).collect()}
    assert lines[(1, 0)] == "Id,Name,Vip"          # Note never set in batch 1
    assert lines[(1, 1)] == "1,Ann,True"
    assert lines[(1, 2)] == "2,,"                   # missing and clear both render empty
    assert lines[(2, 0)] == "Id,Name,Note,Vip"
    assert lines[(2, 1)] == '3,"Bo, Jr","say ""hi""",False'
    assert lines[(2, 2)] == "4,,,"


def test_request_json_drops_nulls(spark):
    df = spark.createDataFrame([(7, "Ann", None)], "k long, fname string, lname string")
    p = B.request_json(df, "k", {"FirstName": "fname", "LastName": "lname"}, "Account").first().payload
    assert p == '{"attributes":{"type":"Account","referenceId":"ref7"},"FirstName":"Ann"}'


def test_outcome_aborted_batch_fails(spark):
    sent = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 3)], "id int, batch_no int")
    failed = spark.createDataFrame([(2,)], "id int")
    states = spark.createDataFrame([(1, "JobComplete"), (2, "Aborted"), (3, "Failed")], "batch_no int, state string")
    got = {r.id: (r.outcome, r.failure_reason) for r in B.outcome(sent, failed, states, "id", "batch_no").collect()}
    assert got == {1: ("ok", None), 2: ("failed", "record_failed"), 3: ("failed", "batch_failed"),
                   4: ("failed", "batch_failed")}


def test_outcome_by_values_first_n(spark):
    sent = spark.createDataFrame([(1, "m", 10, 1), (2, "m", 10, 1), (3, "m", 10, 1), (4, "m", 10, 2)],
                                 "pos int, member string, points int, batch_no int")
    fails = spark.createDataFrame([("m", 10, 1, 2)], "member string, points int, batch_no int, n_failed long")
    got = {r.pos: r.outcome for r in B.outcome_by_values(sent, fails, ["member", "points"], "batch_no", ["pos"]).collect()}
    assert got == {1: "failed", 2: "failed", 3: "ok", 4: "ok"}


def test_require_raises(spark):
    df = spark.createDataFrame([(1, None)], "k int, id string")
    with pytest.raises(Exception):
        B.require(df, "id").collect()


def test_write_table_modes(spark):
    path = IO.scratch_dir(spark, "test-modes") + "/t"
    df = spark.range(5)
    assert IO.write_table(df, path, "fail") == 5
    with pytest.raises(Exception):
        IO.write_table(df, path, "fail")
    assert IO.write_table(df, path, "append") == 5
    assert spark.read.parquet(path).count() == 10
    assert IO.write_table(df, path, "replace") == 5
    with pytest.raises(ValueError):
        IO.write_table(df.limit(0), path, "replace")


def test_clean_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`E-Mail` int, `email ` int")
    with pytest.raises(ValueError):
        IO.clean_columns(df)
    names = {"  First  Name ": "first_name", "E-Mail": "email", "_a__b_": "a_b", "A - B": "a_b", "Größe (cm)": "gre_cm", "%": "", "Nr.1": "nr1"}
    assert {n: IO.standard_name(n) for n in names} == names


def test_write_batch_files(spark):
    df = spark.createDataFrame([(1, "a", 1, 1), (2, None, 2, 1), (3, "c", 3, 2)],
                               "Id long, Name string, seq long, batch_no long")
    lines = B.bulk_csv_lines(df, "Id", "batch_no", "seq", 2)
    path = IO.scratch_dir(spark, "t-batches")
    B.write_batch_files(lines, path)
    b1 = [r.value for r in spark.read.text(f"{path}/batch_no=1").collect()]
    assert b1 == ["Id,Name", "1,a", "2,"]


def test_outcome_by_values_takes_failed_batches(spark):
    sent = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, "a", 2), (5, None, 1)], "seq int, v string, batch_no int")
    fails = spark.createDataFrame([("a", 1, 1)], "v string, batch_no int, n_failed int")
    states = spark.createDataFrame([(1, "JobComplete"), (2, "Failed")], "batch_no int, state string")
    got = {r.seq: r.outcome for r in B.outcome_by_values(sent, fails, ["v"], "batch_no", ["seq"], states=states).collect()}
    assert got == {1: "failed", 2: "ok", 3: "ok", 4: "failed", 5: "ok"}


def work_rows(spark):
    rows = [(1, "B1", "2024-01-01"), (2, "B1", None), (3, "B2", "2024-01-01"), (4, None, None), (5, "B1", "2024-01-02")]
    return spark.createDataFrame(rows, "row_id int, _batch_id string, p string").select("row_id", "_batch_id", F.to_timestamp_ntz("p").alias("_processed_at"))


def published(spark):
    tables = TableSet(spark, IO.scratch_dir(spark, "test-publish"))
    old_history = work_rows(spark).where("row_id = 3").withColumns(
        {"change_type": F.lit("x"), "change_source": F.lit("y"), "version_at": F.to_timestamp_ntz(F.lit("2023-01-01"))})
    w, n = tables.write("work", work_rows(spark))
    h, m = tables.write("history", old_history)
    assert (n, m) == (5, 1)
    tables.publish({"work": [w], "history": [h]})
    return tables


def ids(df):
    return sorted(r["row_id"] for r in df.collect())


def test_a_whole_batch_is_archived_processed_or_not(spark):
    tables = published(spark)
    got = archive_batch(tables, "B1", "2024-02-01 00:00:00", "sf_push", "job").collect()
    assert [tuple(r)[:3] for r in got] == [("B1", 3, 3)]
    assert ids(tables.read("work")) == [3, 4] and ids(tables.read("history")) == [1, 2, 3, 5]
    assert tables.read("history").where("change_type = 'sf_push' and change_source = 'job'").count() == 3
    assert ids(tables.read("work", 1)) == [1, 2, 3, 4, 5]  # the version before can still be read
    assert [tuple(r)[1:3] for r in archive_batch(tables, "none", "2024-02-01", "t", "s").collect()] == [(0, 0)] and tables.version() == 2


def test_a_blank_batch_id_is_an_error(spark):
    for blank in (None, "", "  "):
        with pytest.raises(ValueError):
            B.archive(work_rows(spark), blank, "2024-02-01", "t", "s")


def test_counts_that_disagree_leave_both_old_versions(spark, monkeypatch):
    tables = published(spark)
    whole = TableSet.write
    monkeypatch.setattr(TableSet, "write", lambda self, name, df: whole(self, name, df.where("row_id <> 2") if name == "history" else df))
    with pytest.raises(AuditError, match="2 rows archived, 3 deleted"):
        archive_batch(tables, "B1", "2024-02-01", "t", "s")
    assert tables.version() == 1 and ids(tables.read("work")) == [1, 2, 3, 4, 5] and ids(tables.read("history")) == [3]


def test_a_step_that_was_overtaken_is_not_published(spark):
    tables = published(spark)
    base = tables.version()
    tables.publish({"other": []})
    with pytest.raises(AuditError):
        tables.publish({"work": []}, base)
    assert ids(tables.read("work")) == [1, 2, 3, 4, 5]


def test_batches_are_bounded_by_rows_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(keys, "RUNNING_SLICE", 13)
    df = spark.range(500).select("id", ((F.col("id") * 7919) % 60).alias("n"))
    got = [tuple(r) for r in B.sized_batches(df, ["id"], "id", F.col("n"), 20, 400, partitions=7).orderBy("id").collect()]
    before, want, last, no = 0, [], None, 0
    for i, n, _ in got:
        part = (i // 20, before // (400 - 59))
        no, last = (no + 1, part) if part != last else (no, last)
        want.append(no)
        before += n
    assert [r[2] for r in got] == want
    for b in set(want):
        own = [r[1] for r in got if r[2] == b]
        assert len(own) <= 20 and sum(own) <= 400
    with pytest.raises(ValueError):
        B.sized_batches(df, ["id"], "id", F.col("n"), 20, 100)
    assert B.sized_batches(df.limit(0), ["id"], "id", F.col("n"), 20, 400).collect() == []


def test_percent_encoding_is_that_of_rfc_3986(spark):
    from urllib.parse import quote
    texts = ["SELECT Id FROM A WHERE x = 'a b'", "a*b~c-d_e.f+g/h?i&j", "Größe 日本", "%"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", B.percent_encoded(F.col("t")).alias("e"))
    assert {r["t"]: r["e"] for r in df.collect()} == {t: quote(t, safe="") for t in texts}


def test_a_consent_chain_is_valid_json_with_a_varying_number_of_parts(spark):
    import json
    df = spark.createDataFrame([("001a'b", True, False), ("001c", False, False), (None, True, True), ("001d", True, True)], "account string, c boolean, h boolean")
    df = df.withColumn("prop", F.lit(None).cast("string"))
    got = {r["account"]: json.loads(r["payload"]) for r in B.consent_chain(df, "account", F.lit("p1"), F.lit("p2"), "prop", "2024-05-01", "s", F.col("c"), F.col("h")).collect()}
    refs = {k: [p["referenceId"] for p in v["compositeRequest"]] for k, v in got.items()}
    base = ["refAccount", "refIndividual", "refCPE"]
    assert refs == {"001a'b": [*base, "refConsentCentral"], "001c": base, "001d": [*base, "refConsentCentral", "refConsentHotel"]}
    assert got["001c"]["allOrNone"] is True and "body" not in got["001c"]["compositeRequest"][0]
    assert "Id%20%3D%20%27001c%27%20LIMIT%201" in got["001c"]["compositeRequest"][0]["url"]
    assert got["001d"]["compositeRequest"][2]["body"]["ParentId"] == "@{refIndividual.id}"
    assert "Property__c" not in got["001d"]["compositeRequest"][4]["body"]  # NULL fields are left out


def test_failure_files_give_ids_batches_and_a_quarantine(spark):
    path = IO.scratch_dir(spark, "test-failures")
    lines = [(1, '{"sf__Id": "a", "Id": "x", "sf__Error": "E1"}'), (1, '{"sf__Id": "", "Id": "b"}'), (2, '{"Id": "c"'), (2, ""), (2, '{"Email": "d"}')]
    spark.createDataFrame(lines, "batch_no int, value string").write.mode("overwrite").partitionBy("batch_no").text(path)
    good, bad = IO.read_failures(spark, path)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", "E1"), (1, "b", None), (2, None, None)], key=str)
    assert [tuple(r) for r in bad.collect()] == [(2, '{"Id": "c"')]


def test_typed_write_splits_long_texts_off(spark):
    df = spark.createDataFrame([(1, "ab", 1.5, [1]), (2, "abc", float("nan"), None), (3, None, None, [1, 2, 3])], "k int, t string, d double, a array<int>")
    out = IO.typed_write(df, IO.scratch_dir(spark, "test-typed") + "/t", {"t": 2, "a": 5})
    assert dict(out.dtypes) == {"k": "bigint", "t": "string", "d": "double", "a": "string", "_reason": "string", "_rejected": "boolean"}
    assert sorted(tuple(r) for r in out.collect()) == [(1, "ab", 1.5, "[1]", None, False), (2, "abc", None, None, "t", True), (3, None, None, "[1,2,3]", "a", True)]
