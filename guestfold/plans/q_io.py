"""Driver queries for sources and sinks (S2-S19): each writes to a fresh
folder under the shared ``spark.checkpoint.dir``, reads the result back and
returns what was read, so the round trip itself is what gets checked."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import utc_wall_clock
from ..operators import batch as B
from ..sources import files as IO
from ..sources import objects as OBJ
from .q_batch import OUTCOME_SQL, _outcomes
from .q_joins import PARTY_ID_SQL, party_id
from .registry import register
from .tables import dirty, oracle_with, table


@register("backup_copy", """
WITH c AS (SELECT c_custkey, c_name, c_nationkey FROM customer)
SELECT 'landed' AS object, * FROM c UNION ALL SELECT 'backup', * FROM c
UNION ALL SELECT 'insert_select', * FROM c UNION ALL SELECT 'insert_select', c_custkey, c_name, NULL FROM c WHERE c_custkey % 10 = 0""")
def backup_copy(spark, sf):
    """The rows of a landed table, of its backup, and of the backup after an insert of some columns, as they were written."""
    d = IO.scratch_dir(spark, "backup")
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    landed = IO.materialise(cust, f"{d}/landed")
    copy = IO.backup(landed, f"{d}/backup")
    extra = table(spark, sf, "customer").where(F.col("c_custkey") % 10 == 0).select("c_custkey", "c_name")
    ins = IO.insert_select(copy, extra, ["c_custkey", "c_name"])
    tagged = [df.select(F.lit(n).alias("object"), "*") for n, df in (("landed", landed), ("backup", copy), ("insert_select", ins))]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@register("all_fields_extract", """
SELECT CAST(c_custkey AS VARCHAR) AS "Id", c_name AS "Name", CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS "Added__c",
  '{"city":"' || c_nationkey || '"}' AS "Address" FROM customer""")
def all_fields_extract(spark, sf):
    """Pages of 20 records, landed and audited; one field occurs in some records only, one is nested."""
    d, k = IO.scratch_dir(spark, "all-fields"), F.col("c_custkey")
    c = table(spark, sf, "customer")
    rec = F.to_json(F.struct(F.struct(F.lit("Account").alias("type")).alias("attributes"), k.cast("string").alias("Id"), F.col("c_name").alias("Name"),
                             F.when(k % 3 == 0, F.col("c_nationkey").cast("string")).alias("Added__c"),
                             F.struct(F.col("c_nationkey").cast("string").alias("city")).alias("Address")))
    total = c.select(F.count(F.lit(1)).alias("n"), F.max(F.floor(k / 20)).alias("last"))
    # a page holds at most 20 records: the grouping key bounds every group
    pages = c.groupBy(F.floor(k / 20).alias("page")).agg(F.collect_list(rec).alias("r")).join(total)
    lines = pages.select(F.concat(F.lit('{"totalSize":'), F.col("n"), F.lit(',"done":'), (F.col("page") == F.col("last")).cast("string"),
                                  F.lit(',"records":['), F.array_join("r", ","), F.lit("]}")).alias("value"))
    lines.write.mode("overwrite").text(f"{d}/pages")
    return OBJ.read_all_fields(spark, f"{d}/pages")


@register("rejects_and_maps", OUTCOME_SQL + f"""
, ids AS (SELECT c_custkey, {PARTY_ID_SQL} AS account_id FROM customer)
SELECT r.batch_no, r.c_custkey, r.failure_reason, ids.account_id
FROM r JOIN ids ON ids.c_custkey = r.c_custkey WHERE r.failure_reason IS NOT NULL""")
def rejects_and_maps(spark, sf):
    d = IO.scratch_dir(spark, "rejects")
    out = _outcomes(spark, sf)
    IO.write_rejects(out.where(F.col("outcome") == "failed").select("batch_no", "c_custkey", "failure_reason"),
                     f"{d}/rejects")
    IO.write_map(table(spark, sf, "customer").select("c_custkey", party_id().alias("account_id")),
                 "c_custkey", "account_id", f"{d}/map")
    rej = spark.read.schema("c_custkey long, failure_reason string, batch_no long").json(f"{d}/rejects")
    ids = spark.read.schema("c_custkey long, account_id string").json(f"{d}/map")
    return rej.join(ids, "c_custkey").select("batch_no", "c_custkey", "failure_reason", "account_id")


MODIFIED_SQL = "concat('2024-01-', lpad(concat('', c_custkey % 28 + 1), 2, '0'), 'T10:00:00Z')"


@register("csv_load", oracle_with("dirty") + f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_key, coalesce(fname, '') AS first_name, coalesce(email, '') AS email,
  CAST(CAST({MODIFIED_SQL} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS modified
FROM dirty""")
def csv_load(spark, sf):
    d = IO.scratch_dir(spark, "csv")
    src = dirty(spark, sf).select(
        F.col("c_custkey").cast("string").alias("Customer Key"), F.col("fname").alias(" First  Name "),
        F.col("email").alias("E-Mail"), F.expr(MODIFIED_SQL).alias("Modified"))
    (src.write.mode("overwrite").option("header", True).option("sep", ";").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{d}/in"))
    df = IO.clean_columns(IO.read_delimited(spark, f"{d}/in", sep=";"))
    df = IO.cast_on_load(df, ["modified"])
    return df.withColumn("modified", utc_wall_clock("modified"))


@register("object_pages", """
SELECT CAST(c_custkey AS VARCHAR) AS Id, c_name AS Name, CAST(c_nationkey AS VARCHAR) AS NationId,
  (SELECT count(*) FROM customer) AS total_size
FROM customer WHERE c_custkey % 10 <> 9""")
def object_pages(spark, sf):
    """Customers landed as object-API pages of 10 records (the shape a paging
    client writes: ``totalSize``, ``done``, ``records`` with ``attributes``),
    read back with a declared schema, flattened and filtered by the extract
    spec (deleted records dropped)."""
    d = IO.scratch_dir(spark, "pages")
    c = table(spark, sf, "customer")
    rec = F.struct(F.struct(F.lit("Account").alias("type"),
                            F.concat(F.lit("/obj/"), F.col("c_custkey")).alias("url")).alias("attributes"),
                   F.col("c_custkey").cast("string").alias("Id"), F.col("c_name").alias("Name"),
                   F.col("c_nationkey").cast("string").alias("NationId"),
                   (F.col("c_custkey") % 10 == 9).alias("IsDeleted"))
    total = c.select(F.count(F.lit(1))).scalar()
    # a page holds at most 10 records: the grouping key bounds every group
    pages = c.groupBy(F.floor(F.col("c_custkey") / 10).alias("page")).agg(
        F.collect_list(rec).alias("records")).select(total.alias("totalSize"), F.lit(True).alias("done"), "records")
    pages.write.mode("overwrite").json(f"{d}/pages")
    record = T.StructType([T.StructField(n, t) for n, t in [("Id", T.StringType()), ("Name", T.StringType()),
                                                            ("NationId", T.StringType()), ("IsDeleted", T.BooleanType())]])
    flat = OBJ.flatten_object_pages(OBJ.read_object_pages(spark, f"{d}/pages", record))
    return OBJ.select_spec(flat, "Account", columns=["Id", "Name", "NationId", "total_size"])


@register("object_extract", """
SELECT concat('lm', c_custkey) AS "Id", concat('M', c_custkey) AS "MembershipNumber", NULL::VARCHAR AS "ExternalMemberId__c",
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Active' END AS "MemberStatus", NULL::VARCHAR AS "ContactId", NULL::VARCHAR AS "ProgramId",
  NULL::VARCHAR AS "LegacyMemberId__c", c_mktsegment AS "LegacyTier__c", NULL::VARCHAR AS "TierName__c", NULL::VARCHAR AS "LastActivityDate",
  NULL::VARCHAR AS "EntraID__c", '2024-01-02T03:04:05.000+0000' AS "CreatedDate" FROM customer WHERE c_custkey % 7 <> 0""")
def object_extract(spark, sf):
    """Membership records landed as pages and read back by their own extract columns."""
    d = IO.scratch_dir(spark, "extract")
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    fields = {"Id": F.concat(F.lit("lm"), k), "MembershipNumber": F.concat(F.lit("M"), k), "MemberStatus": F.when(k % 3 != 0, "Active"),
              "LegacyTier__c": F.col("c_mktsegment"), "CreatedDate": F.lit("2024-01-02T03:04:05.000+0000"), "IsDeleted": k % 7 == 0}
    rec = F.struct(F.struct(F.lit("LoyaltyProgramMember").alias("type"), F.lit("/o").alias("url")).alias("attributes"), *[v.alias(n) for n, v in fields.items()])
    pages = c.groupBy(F.floor(k / 10).alias("page")).agg(F.collect_list(rec).alias("records")).select(
        F.lit(0).cast("bigint").alias("totalSize"), F.lit(True).alias("done"), "records")  # at most 10 records a page
    pages.write.mode("overwrite").json(f"{d}/pages")
    record = T.StructType([T.StructField(n, T.BooleanType() if n == "IsDeleted" else T.StringType()) for n in fields])
    return OBJ.select_spec(OBJ.flatten_object_pages(OBJ.read_object_pages(spark, f"{d}/pages", record)), "LoyaltyProgramMember")


@register("save_modes", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT 'appended' AS after, event_id, value, 2 AS copies FROM e UNION ALL SELECT 'replaced', event_id, value, 1 FROM e""")
def save_modes(spark, sf):
    """The rows that stand in a table after a first write, a refused one and an append, and after a replacement."""
    ev = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.from_json("props", "k int").alias("props"))
    norm, path = IO.normalise_values(ev), IO.scratch_dir(spark, "modes") + "/events"
    IO.write_table(norm, path, "fail")
    try:
        IO.write_table(norm, path, "fail")
    except Exception:  # noqa: BLE001 - the table exists: mode fail refuses, so the copies below stay two
        pass
    IO.write_table(norm, path, "append")
    back = lambda after: (spark.read.parquet(path).groupBy("event_id", "value").agg(F.count(F.lit(1)).cast("int").alias("copies"))
                          .select(F.lit(after).alias("after"), "event_id", "value", "copies"))
    appended = IO.materialise(back("appended"), IO.scratch_dir(spark, "modes-seen") + "/appended")
    IO.write_table(norm, path, "replace")
    return appended.unionByName(back("replaced"))
