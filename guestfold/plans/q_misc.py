"""Driver queries for the remaining scalar, projection and SQL-surface operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import batch as B
from ..sources.files import read_query
from .registry import register
from .tables import table

ISO_SQL = """strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({c}, '%f') = '000000' THEN ''
  ELSE '.' || strftime({c}, '%f') END || 'Z'"""


@register("iso_dates", f"""
SELECT 'events' AS src, event_id AS id, {ISO_SQL.format(c='ts')} AS iso_ts, strftime(ts, '%Y-%m-%d') AS iso_day,
  CAST(CAST(value > 50 AS INTEGER) AS BOOLEAN) AS high_value,
  CASE WHEN length(concat('u', user_id, '@example.org')) > 0 THEN concat('u', user_id, '@example.org', '.inactive') END
    AS email_off
FROM events
UNION ALL
SELECT 'orders', o_orderkey, {ISO_SQL.format(c='o_orderdate')}, strftime(o_orderdate, '%Y-%m-%d'),
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END, NULL
FROM orders""")
def iso_dates(spark, sf):
    ev = table(spark, sf, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), X.iso_utc("ts").alias("iso_ts"),
        X.iso_date("ts").alias("iso_day"), X.flag((F.col("value") > 50).cast("int")).alias("high_value"),
        X.neutralise_email(F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.org"))).alias("email_off"))
    st = F.col("o_orderstatus")
    od = table(spark, sf, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderkey").alias("id"), X.iso_utc("o_orderdate").alias("iso_ts"),
        X.iso_date("o_orderdate").alias("iso_day"),
        X.flag(F.when(st == "F", 1).when(st == "O", 0)).alias("high_value"),
        X.neutralise_email(F.lit(None).cast("string")).alias("email_off"))
    return ev.unionByName(od)


@register("projection", """
SELECT DISTINCT c_mktsegment AS Segment__c, CAST(c_nationkey AS BIGINT) AS NationId__c, 'tpch' AS Source__c,
  '' AS Phone, 'PersonAccount' AS RecordType
FROM customer""")
def projection(spark, sf):
    c = table(spark, sf, "customer")
    m = B.map_fields(c, {"Segment__c": "c_mktsegment", "NationId__c": F.col("c_nationkey").cast("bigint"),
                         "Source__c": F.lit("tpch"), "Phone": F.lit(None).cast("string"),
                         "RecordType": F.lit("PersonAccount")})
    return B.blank_nulls(m, ["Phone"]).distinct()


PARAM_SQL = """SELECT v.o_orderkey, v.c_name, m.label
FROM {v} v JOIN (VALUES ('1-URGENT', 'Urgent'), ('2-HIGH', 'High')) AS m(code, label) ON m.code = v.o_orderpriority
WHERE v.o_totalprice > :min_price AND v.c_mktsegment = :segment"""


def reservation_view(spark, sf):
    """Reusable view (S15): orders with their customer."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return o.join(c, "o_custkey")


@register("parameterised_query", """
WITH v AS (SELECT o_orderkey, c_name, o_orderpriority, o_totalprice, c_mktsegment
           FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT v.o_orderkey, v.c_name, m.label
FROM v JOIN (VALUES ('1-URGENT', 'Urgent'), ('2-HIGH', 'High')) AS m(code, label) ON m.code = v.o_orderpriority
WHERE v.o_totalprice > 400000 AND v.c_mktsegment = 'BUILDING'""")
def parameterised_query(spark, sf):
    return read_query(spark, PARAM_SQL, {"min_price": 400000, "segment": "BUILDING"}, v=reservation_view(spark, sf))


@register("agg_kinds", """
WITH g AS (SELECT o_custkey, count(*) AS n_orders, count(nullif(o_orderpriority, '5-LOW')) AS n_priority_set,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, min(o_totalprice) AS min_price,
    max(o_totalprice) AS max_price, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
    count(DISTINCT concat(o_orderstatus, '|', o_orderpriority)) AS n_status_priority,
    first(o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS latest_priority
  FROM orders GROUP BY o_custkey),
s AS (SELECT o_custkey, count(*) AS n_statuses FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) d
      GROUP BY o_custkey)
SELECT g.*, n_orders - n_priority_set AS n_priority_missing, s.n_statuses FROM g JOIN s USING (o_custkey)""")
def agg_kinds(spark, sf):
    """G2 sum/min/max, G4 COUNT(DISTINCT expr), G8 COUNT(col) vs COUNT(*),
    G13 group-by as distinct, G14 a deterministic pick (``max_by`` on a total
    order) instead of an arbitrary un-aggregated column."""
    o = table(spark, sf, "orders")
    g = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("n_priority_set"),
        X.money_sum("o_totalprice", 2).cast("double").alias("sum_price"),
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
        F.count_distinct(F.concat_ws("|", "o_orderstatus", "o_orderpriority")).alias("n_status_priority"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("latest_priority"))
    s = o.select("o_custkey", "o_orderstatus").dropDuplicates().groupBy("o_custkey") \
        .agg(F.count(F.lit(1)).alias("n_statuses"))
    return g.join(s, "o_custkey").withColumn("n_priority_missing", F.col("n_orders") - F.col("n_priority_set"))


SCALAR_AS_OF = "1998-08-02"


@register("scalar_dates", f"""
WITH s AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1)
SELECT o_orderkey,
  CAST(CASE WHEN first_ship > o_orderdate THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(first_ship AS DATE))
       ELSE 0 END AS INTEGER) AS nights,
  CAST(o_orderdate AS DATE) AS order_day,
  first_ship >= CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AND first_ship < CAST(o_orderdate AS DATE) + INTERVAL 2 DAY
    AS shipped_next_day,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{SCALAR_AS_OF}') AS INTEGER) AS days_to_as_of,
  CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 1.1, 2) AS DOUBLE) AS price_plus_10pct,
  o_orderkey + 100000 AS key_offset, CAST(o_orderkey AS VARCHAR) AS key_text,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no,
  CAST(floor(o_totalprice) AS BIGINT) AS price_whole
FROM orders LEFT JOIN s ON s.l_orderkey = o_orderkey""")
def scalar_dates(spark, sf):
    """F13 guarded day difference, F14 date part, F18 half-open next-day
    window, F19 explicit ``as_of`` instead of ``CURDATE()``, F20 rounding and
    constant offsets, F21 casts (text to number with ``try_cast``)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    s = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    j = o.join(s, o["o_orderkey"] == s["l_orderkey"], "left")
    day = F.to_date("o_orderdate")
    next_day = day.cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return j.select(
        "o_orderkey", X.nights("o_orderdate", "first_ship").cast("int").alias("nights"), day.alias("order_day"),
        X.in_day("first_ship", next_day).alias("shipped_next_day"),
        F.datediff(F.lit(SCALAR_AS_OF).cast("date"), day).alias("days_to_as_of"),
        F.round(F.col("o_totalprice").cast("decimal(18,2)") * F.lit(1.1).cast("decimal(2,1)"), 2).cast("double")
        .alias("price_plus_10pct"),
        (F.col("o_orderkey") + 100000).alias("key_offset"), F.col("o_orderkey").cast("string").alias("key_text"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_no"),
        F.floor("o_totalprice").cast("bigint").alias("price_whole"))
