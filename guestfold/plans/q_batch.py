"""Driver queries for the load-batch lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batch as B
from ..operators.keys import assign_batches, assign_sequence
from ..sources import files as IO
from ..sources.publish import TableSet, archive_batch
from .registry import register
from .tables import AS_OF_ORDERS, dirty, oracle_with, table

LOAD_BATCH = 500
OUTCOME_BATCH = 100

LOAD_FIELDS_SQL = {
    "FirstName": "fname", "LastName": "lname", "PersonEmail": "lower(trim(email))", "Salutation": "salutation",
    "Phone": "cell_phone",
    "Investor__c": "CASE WHEN c_custkey < 600 AND c_custkey % 7 = 0 THEN true END",
    "Note__c": "CASE WHEN c_custkey % 11 = 0 THEN concat('a,\"b\" ', c_custkey) END",
}


def _esc(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '[,"\\r\\n]') THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


def _text(name: str) -> str:
    if name == "Investor__c":
        return f"CASE WHEN {name} THEN 'True' WHEN NOT {name} THEN 'False' END"
    return f"CAST({name} AS VARCHAR)"


def _bulk_sql() -> str:
    names = sorted(LOAD_FIELDS_SQL)
    sel = ", ".join(f"{v} AS {k}" for k, v in LOAD_FIELDS_SQL.items())
    pres = ", ".join(f"bool_or({k} IS NOT NULL) AS p_{k}" for k in names)
    head = ", ".join(f"CASE WHEN p_{k} THEN '{k}' END" for k in names)
    body = ", ".join(f"CASE WHEN p_{k} THEN coalesce({_esc(_text(k))}, '') END" for k in names)
    return oracle_with("dirty") + f"""
, m AS (SELECT c_custkey AS ExternalKey__c, {sel}, row_number() OVER (ORDER BY c_custkey) AS seq FROM dirty),
b AS (SELECT *, CAST(floor((seq - 1) / {LOAD_BATCH}) + 1 AS BIGINT) AS batch_no FROM m),
p AS (SELECT batch_no, {pres} FROM b GROUP BY batch_no)
SELECT batch_no, CAST(0 AS BIGINT) AS line_no, concat_ws(',', 'ExternalKey__c', {head}) AS line FROM p
UNION ALL
SELECT batch_no, CAST(seq - (batch_no - 1) * {LOAD_BATCH} AS BIGINT) AS line_no,
  concat_ws(',', CAST(ExternalKey__c AS VARCHAR), {body}) AS line
FROM b JOIN p USING (batch_no)"""


@register("bulk_csv_lines", _bulk_sql())
def bulk_csv_lines(spark, sf):
    d = dirty(spark, sf)
    fields = {k: F.expr(v) for k, v in LOAD_FIELDS_SQL.items()}
    m = B.map_fields(d, {"ExternalKey__c": "c_custkey", **fields})
    m = assign_sequence(m, ["ExternalKey__c"], start=1, out="seq", key="ExternalKey__c")
    m = assign_batches(m, "seq", LOAD_BATCH)
    return B.bulk_csv_lines(m, "ExternalKey__c", "batch_no", "seq", LOAD_BATCH)


PAYLOAD_FIELDS_SQL = [("FirstName", "fname"), ("LastName", "lname"), ("PersonEmail", "lower(trim(email))"),
                      ("Salutation", "salutation"), ("ListId", "list_id")]


@register("payload_json", oracle_with("dirty") + """
SELECT c_custkey, '{' || concat_ws(',',
  '"attributes":{"type":"Account","referenceId":' || to_json(concat('ref', c_custkey)) || '}', """ + ", ".join(
    f"CASE WHEN {v} IS NOT NULL THEN '\"{k}\":' || to_json({v}) END" for k, v in PAYLOAD_FIELDS_SQL) + """) || '}'
  AS payload
FROM dirty""")
def payload_json(spark, sf):
    d = dirty(spark, sf)
    return B.request_json(d, "c_custkey", {k: F.expr(v) for k, v in PAYLOAD_FIELDS_SQL}, "Account")


OUTCOME_SQL = f"""WITH s AS (SELECT c_custkey,
    CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / {OUTCOME_BATCH}) + 1 AS BIGINT) AS batch_no FROM customer),
st AS (SELECT DISTINCT batch_no, CASE WHEN batch_no % 4 = 0 THEN 'Failed' WHEN batch_no % 5 = 0 THEN 'Aborted'
       ELSE 'JobComplete' END AS state FROM s),
r AS (SELECT s.c_custkey, s.batch_no, st.state,
        CASE WHEN NOT coalesce(st.state IN ('JobComplete'), false) THEN 'batch_failed'
             WHEN s.c_custkey % 23 = 0 THEN 'record_failed' END AS failure_reason
      FROM s LEFT JOIN st USING (batch_no))"""


def _outcomes(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    s = assign_batches(assign_sequence(c, ["c_custkey"], start=1, out="seq"), "seq", OUTCOME_BATCH).drop("seq")
    s = IO.materialise(s, IO.scratch_dir(spark, "batches"))  # numbered once; states and failures come from it
    failed = s.where(F.col("c_custkey") % 23 == 0).select("c_custkey")
    b = F.col("batch_no")
    states = s.select("batch_no").distinct().withColumn(
        "state", F.when(b % 4 == 0, "Failed").when(b % 5 == 0, "Aborted").otherwise("JobComplete"))
    return B.outcome(s, failed, states, "c_custkey", "batch_no")


@register("batch_outcome", OUTCOME_SQL + """
SELECT c_custkey, batch_no, state, failure_reason, CASE WHEN failure_reason IS NULL THEN 'ok' ELSE 'failed' END AS outcome
FROM r""")
def batch_outcome(spark, sf):
    return _outcomes(spark, sf).select("c_custkey", "batch_no", "state", "failure_reason", "outcome")


@register("batch_summary", OUTCOME_SQL + """
SELECT batch_no, count(*) AS n_sent, count(*) FILTER (WHERE failure_reason IS NULL) AS n_ok,
  count(*) FILTER (WHERE failure_reason IS NOT NULL) AS n_failed FROM r GROUP BY batch_no""")
def batch_summary(spark, sf):
    return B.batch_summary(_outcomes(spark, sf), "batch_no")


@register("failure_files", """
SELECT c_custkey % 7 AS batch_no, count(*) FILTER (WHERE c_custkey % 50 <> 0) AS n_failed, count(*) FILTER (WHERE c_custkey % 50 = 0) AS n_broken
FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 50 = 0 GROUP BY 1""")
def failure_files(spark, sf):
    """Failure records landed per batch, some lines broken, read back and counted with the batch of their path."""
    k = F.col("c_custkey")
    record = F.to_json(F.struct(F.when(k % 2 == 0, k.cast("string")).alias("sf__Id"), k.cast("string").alias("Id"), F.lit("DUPLICATE").alias("sf__Error")))
    lines = table(spark, sf, "customer").where((k % 3 == 0) | (k % 50 == 0)).select(
        (k % 7).alias("batch_no"), F.when(k % 50 == 0, F.concat(F.lit('{"sf__Id": '), k.cast("string"))).otherwise(record).alias("value"))
    path = IO.scratch_dir(spark, "failures")
    lines.write.mode("overwrite").partitionBy("batch_no").text(path)
    good, bad = IO.read_failures(spark, path)
    seen = good.select("batch_no", F.col("id").isNull().alias("broken")).unionByName(bad.select("batch_no", F.lit(True).alias("broken")))
    return seen.groupBy("batch_no").agg(F.count_if(~F.col("broken")).alias("n_failed"), F.count_if("broken").alias("n_broken"))


@register("outcome_by_values", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_orderkey % 3 + 1 AS batch_no
            FROM lineitem),
f AS (SELECT l_orderkey, l_quantity, batch_no, count(*) AS n FROM li
      WHERE l_orderkey % 13 = 0 AND l_linenumber <= 2 GROUP BY ALL)
SELECT li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey,
  CASE WHEN row_number() OVER (PARTITION BY li.l_orderkey, li.l_quantity, li.batch_no
                               ORDER BY li.l_linenumber, li.l_partkey, li.l_suppkey) <= coalesce(f.n, 0)
       THEN 'failed' ELSE 'ok' END AS outcome
FROM li LEFT JOIN f ON f.l_orderkey = li.l_orderkey AND f.l_quantity = li.l_quantity AND f.batch_no = li.batch_no""")
def outcome_by_values(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             (F.col("l_orderkey") % 3 + 1).alias("batch_no"))
    failures = (li.where((F.col("l_orderkey") % 13 == 0) & (F.col("l_linenumber") <= 2))
                .groupBy("l_orderkey", "l_quantity", "batch_no").agg(F.count(F.lit(1)).alias("n_failed")))
    out = B.outcome_by_values(li, failures, ["l_orderkey", "l_quantity"], "batch_no",
                              ["l_linenumber", "l_partkey", "l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "outcome")


WORK_SQL = """SELECT o_orderkey AS row_id, concat('B', o_orderkey % 4) AS _batch_id,
  CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'create' ELSE 'none' END AS _operation,
  CASE WHEN o_totalprice < 20000 THEN 1 ELSE 0 END AS _excluded,
  CASE WHEN o_orderkey % 9 = 0 THEN TIMESTAMP '1998-01-01' END AS _processed_at,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('003', o_orderkey) END AS sf_contact_id
FROM orders"""


def work_table(spark, sf):
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        k.alias("row_id"), F.concat(F.lit("B"), k % 4).alias("_batch_id"),
        F.when(st == "F", "update").when(st == "O", "create").otherwise("none").alias("_operation"),
        F.when(F.col("o_totalprice") < 20000, 1).otherwise(0).alias("_excluded"),
        F.when(k % 9 == 0, F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))).alias("_processed_at"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("003"), k)).alias("sf_contact_id"))


@register("claim_mark_archive", f"""
WITH w AS ({WORK_SQL}),
c AS (SELECT row_id FROM w WHERE _batch_id = 'B1' AND _operation = 'update' AND coalesce(_excluded, 0) = 0
      AND _processed_at IS NULL AND sf_contact_id IS NOT NULL),
ok AS (SELECT row_id FROM c WHERE row_id % 7 <> 0),
w2 AS (SELECT w.row_id, w._batch_id,
         CASE WHEN ok.row_id IS NOT NULL AND w._processed_at IS NULL THEN TIMESTAMP '{AS_OF_ORDERS}'
              ELSE w._processed_at END AS _processed_at FROM w LEFT JOIN ok ON ok.row_id = w.row_id)
SELECT row_id, _processed_at, 'update' AS change_type, 'bulk' AS change_source, TIMESTAMP '{AS_OF_ORDERS}' AS version_at
FROM w2 WHERE _batch_id = 'B1'""")
def claim_mark_archive(spark, sf):
    work = work_table(spark, sf)
    claimed = B.claim(work, "B1", "update", "sf_contact_id")
    ok = claimed.where(F.col("row_id") % 7 != 0)
    work2 = B.mark_processed(work, ok, "row_id", AS_OF_ORDERS)
    hist, _rest = B.archive(work2, "B1", AS_OF_ORDERS, "update", "bulk")
    return hist.select("row_id", "_processed_at", "change_type", "change_source", "version_at")


@register("archive_counts", f"""
WITH w AS ({WORK_SQL})
SELECT 'B1' AS batch_id, count(*) FILTER (WHERE _batch_id = 'B1') AS rows_archived, count(*) FILTER (WHERE _batch_id = 'B1') AS rows_deleted,
  TIMESTAMP '{AS_OF_ORDERS}' AS finished_at FROM w""")
def archive_counts(spark, sf):
    tables = _archived(spark, sf)[0]
    # what was published, counted from the tables before and after the step
    old, new, hist = tables.read("work", 1), tables.read("work"), tables.read("history")
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    return n(hist, "rows_archived").join(n(old, "n_old")).join(n(new, "n_new")).select(
        F.lit("B1").alias("batch_id"), "rows_archived", (F.col("n_old") - F.col("n_new")).alias("rows_deleted"),
        F.to_timestamp_ntz(F.lit(AS_OF_ORDERS)).alias("finished_at"))


def _archived(spark, sf):
    """The work table, published, and batch B1 moved to the history."""
    tables = TableSet(spark, IO.scratch_dir(spark, "archive"))
    folder, _ = tables.write("work", work_table(spark, sf))
    tables.publish({"work": [folder]})
    return tables, archive_batch(tables, "B1", AS_OF_ORDERS, "update", "bulk")


@register("archive_swap", f"""
WITH w AS ({WORK_SQL})
SELECT row_id, _batch_id, _operation, _processed_at, CASE WHEN _batch_id = 'B1' THEN 'history' ELSE 'work' END AS stands_in,
  CASE WHEN _batch_id = 'B1' THEN 'bulk' END AS change_source FROM w""")
def archive_swap(spark, sf):
    tables, _ = _archived(spark, sf)
    cols = ["row_id", "_batch_id", "_operation", "_processed_at"]
    work = tables.read("work").select(*cols, F.lit("work").alias("stands_in"), F.lit(None).cast("string").alias("change_source"))
    return work.unionByName(tables.read("history").select(*cols, F.lit("history").alias("stands_in"), "change_source"))


@register("sized_batches", """
WITH s AS (SELECT o_orderkey, CAST(octet_length(encode(o_comment_like)) AS BIGINT) AS n FROM (
  SELECT o_orderkey, concat(o_orderpriority, '|', o_orderstatus, '|', o_custkey) AS o_comment_like FROM orders)),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq, sum(n) OVER (ORDER BY o_orderkey) - n AS before, max(n) OVER () AS most FROM s),
p AS (SELECT o_orderkey, (seq - 1) // 500 AS a, CAST(before // (8000 - most) AS BIGINT) AS b FROM r)
SELECT o_orderkey, dense_rank() OVER (ORDER BY a, b) AS batch_no FROM p""")
def sized_batches(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    size = F.octet_length(F.concat("o_orderpriority", F.lit("|"), "o_orderstatus", F.lit("|"), F.col("o_custkey").cast("string")))
    return B.sized_batches(o, ["o_orderkey"], "o_orderkey", size, 500, 8000).select("o_orderkey", "batch_no")


def _quoted(text: str) -> str:
    from urllib.parse import quote
    return quote(text, safe="")


_CHAIN_URL = f"{B.API}/query?q={_quoted(B.ACCOUNT_QUERY[0])}"


@register("composite_chain", f"""
WITH a AS (SELECT o_orderkey, concat('001', o_orderkey) AS account, concat('P', o_custkey % 5) AS prop, o_orderstatus = 'O' AS c, o_orderkey % 3 = 0 AS h FROM orders)
SELECT account, '{{"allOrNone":true,"compositeRequest":[{{"method":"GET","url":"{_CHAIN_URL}' || account || '{_quoted(B.ACCOUNT_QUERY[1])}","referenceId":"refAccount"}}'
 || ',{{"method":"POST","url":"{B.API}/sobjects/Individual","referenceId":"refIndividual","body":{{"FirstName":"@{{refAccount.records[0].FirstName}}",'
 || '"LastName":"@{{refAccount.records[0].LastName}}","Contact__c":"@{{refAccount.records[0].PersonContactId}}","SourceSystem__c":"tpch"}}}}'
 || ',{{"method":"POST","url":"{B.API}/sobjects/ContactPointEmail","referenceId":"refCPE","body":{{"ParentId":"@{{refIndividual.id}}",'
 || '"Contact__c":"@{{refAccount.records[0].PersonContactId}}","EmailAddress":"@{{refAccount.records[0].PersonEmail}}",'
 || '"ActiveFromDate":"1998-08-02T00:00:00.000Z","SourceSystem__c":"tpch"}}}}'
 || CASE WHEN c THEN ',{{"method":"POST","url":"{B.API}/sobjects/ContactPointConsent","referenceId":"refConsentCentral","body":{{"Name":"marketing_central",'
 || '"ContactPointId":"@{{refCPE.id}}","CaptureDate":"1998-08-02T00:00:00.000Z","CaptureSource":"migration","PrivacyConsentStatus":"OptIn",'
 || '"DataUsePurposeId":"p1","EffectiveFrom":"1998-08-02T00:00:00.000Z","SourceSystem__c":"tpch"}}}}' ELSE '' END
 || CASE WHEN h THEN ',{{"method":"POST","url":"{B.API}/sobjects/ContactPointConsent","referenceId":"refConsentHotel","body":{{"Name":"marketing_hotel",'
 || '"ContactPointId":"@{{refCPE.id}}","CaptureDate":"1998-08-02T00:00:00.000Z","CaptureSource":"migration","PrivacyConsentStatus":"OptIn",'
 || '"DataUsePurposeId":"p2","Property__c":"' || prop || '","EffectiveFrom":"1998-08-02T00:00:00.000Z","SourceSystem__c":"tpch"}}}}' ELSE '' END || ']}}' AS payload
FROM a""")
def composite_chain(spark, sf):
    a = table(spark, sf, "orders").select(
        F.concat(F.lit("001"), "o_orderkey").alias("account"), F.concat(F.lit("P"), F.col("o_custkey") % 5).alias("prop"),
        (F.col("o_orderstatus") == "O").alias("c"), (F.col("o_orderkey") % 3 == 0).alias("h"))
    return B.consent_chain(a, "account", F.lit("p1"), F.lit("p2"), "prop", AS_OF_ORDERS, "tpch", F.col("c"), F.col("h"))


PREF_URL = "/services/data/v60.0/sobjects/Preferences__c"


@register("composite_payload", """
WITH f AS (SELECT o.o_custkey, o.o_orderpriority, o.o_totalprice, l.max_qty FROM orders o
           JOIN (SELECT l_orderkey, max(l_quantity) AS max_qty FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey),
t AS (SELECT DISTINCT o_custkey, 'Urgent Booker' AS preference_name, 'Booking Style' AS preference_category,
        'PREF001' AS external_id FROM f WHERE o_orderpriority = '1-URGENT'
      UNION SELECT DISTINCT o_custkey, 'Large Party', 'Family', 'PREF002' FROM f WHERE max_qty >= 45)
SELECT concat(o_custkey, '-', external_id) AS pref_key,
  '{"allOrNone":true,"compositeRequest":[{"method":"POST","url":' || to_json('""" + PREF_URL + """')
  || ',"referenceId":"refPreferences","body":{"Name":' || to_json(preference_name)
  || ',"Category__c":' || to_json(preference_category) || ',"Contact__c":' || to_json(concat('003', o_custkey))
  || ',"ExternalID__c":' || to_json(external_id) || ',"IsActive__c":true,"SourceSystem__c":"tpch"}}]}' AS payload
FROM t""")
def composite_payload(spark, sf):
    from ..operators.stays import preference_tags
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("max_qty"))
    f = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    tags = preference_tags(f, "o_custkey", [("Urgent Booker", "Booking Style", "PREF001", F.col("o_orderpriority") == "1-URGENT"),
                                            ("Large Party", "Family", "PREF002", F.col("max_qty") >= 45)], "tpch")
    tags = tags.withColumn("pref_key", F.concat_ws("-", "o_custkey", "external_id"))
    body = {"Name": "preference_name", "Category__c": "preference_category",
            "Contact__c": F.concat(F.lit("003"), F.col("o_custkey")), "ExternalID__c": "external_id",
            "IsActive__c": F.lit(True), "SourceSystem__c": "source_system"}
    return B.composite_request(tags, "pref_key", [("POST", PREF_URL, "refPreferences", body)])
