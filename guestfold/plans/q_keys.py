"""Driver queries for the per-key operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keys as K
from ..operators.report import string_agg
from .registry import register
from .tables import AS_OF_EVENTS, AS_OF_ORDERS, dirty, oracle_with, table

PRIORITY_RANK = """CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END"""


def priority_rank():
    p = F.col("o_orderpriority")
    return F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).otherwise(3)


@register("survivor_per_key", f"""
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
     ORDER BY {PRIORITY_RANK}, o_totalprice DESC, o_orderkey) AS rn FROM orders) t
WHERE rn = 1""")
def survivor_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return K.pick_one(o, ["o_custkey"], [priority_rank(), F.col("o_totalprice").desc(), "o_orderkey"])


@register("latest_before", f"""
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate <= TIMESTAMP '{AS_OF_ORDERS}') t
WHERE rn = 1""")
def latest_before(spark, sf):
    from ..operators.identity import latest_before as lb
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return lb(o, "o_custkey", "o_orderdate", AS_OF_ORDERS, tie="o_orderkey")


LINE_ORDER_SQL = "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@register("flag_duplicates", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1
       THEN 0 ELSE 1 END AS is_duplicate
FROM lineitem""")
def flag_duplicates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_shipdate", "l_quantity", "l_extendedprice")
    out = K.flag_duplicates(li, ["l_orderkey", "l_linenumber"],
                            [F.col("l_shipdate").desc(), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return out.drop("l_quantity", "l_extendedprice")


@register("drop_all_duplicated", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) t
WHERE n = 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def drop_all_duplicated(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return K.drop_all_duplicated(li, ["l_orderkey", "l_linenumber"])


DOM_MIN_N, DOM_MIN_RATIO = 50, 0.35


@register("dominant_value", f"""
WITH v AS (SELECT l_suppkey, l_returnflag, count(*) AS n_val FROM lineitem
           WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2),
k AS (SELECT l_suppkey, sum(n_val) AS n_key FROM v GROUP BY 1),
top AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n_val DESC, l_returnflag) AS rn FROM v)
SELECT top.l_suppkey, l_returnflag, n_val, CAST(n_key AS BIGINT) AS n_key,
       round(n_val / n_key, 4) AS ratio
FROM top JOIN k USING (l_suppkey)
WHERE rn = 1 AND n_key >= {DOM_MIN_N} AND round(n_val / n_key, 4) >= {DOM_MIN_RATIO}""")
def dominant_value(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag")
    return K.dominant(li, "l_suppkey", "l_returnflag", DOM_MIN_N, DOM_MIN_RATIO)


SEQ_START = 100000


@register("assign_sequence", f"""
SELECT o_orderkey, o_orderdate,
  CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) + {SEQ_START} - 1 AS BIGINT) AS seq
FROM orders""")
def assign_sequence(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return K.assign_sequence(o, ["o_orderdate", "o_orderkey"], start=SEQ_START)


BATCH_SIZE = 5000


@register("assign_batches", f"""
SELECT o_orderkey, seq, CAST(floor((seq - 1) / {BATCH_SIZE}) + 1 AS BIGINT) AS batch_no FROM (
  SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS seq FROM orders) t""")
def assign_batches(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    s = K.assign_sequence(o, ["o_orderdate", "o_orderkey"], start=1)
    return K.assign_batches(s, "seq", BATCH_SIZE).select("o_orderkey", "seq", "batch_no")


@register("group_size_band", """
SELECT l_orderkey, l_linenumber, l_partkey, group_size FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS group_size
  FROM lineitem) t
WHERE group_size BETWEEN 1 AND 3 OR group_size >= 10""")
def group_size_band(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return K.where_group_size(li, ["l_orderkey"], [(1, 3), (10, None)])


@register("share_of_total", """
SELECT event_type, n, round(CAST(n AS DOUBLE) * 100.0 / sum(n) OVER (), 2) AS pct FROM (
  SELECT event_type, count(*) AS n FROM events GROUP BY event_type) t""")
def share_of_total(spark, sf):
    ev = table(spark, sf, "events").select("event_type")
    return K.share(ev, ["event_type"])


@register("domain_share", oracle_with("dirty") + """
SELECT domain, n, round(CAST(n AS DOUBLE) * 100.0 / sum(n) OVER (), 2) AS pct FROM (
  SELECT split_part(lower(trim(email)), '@', -1) AS domain, count(*) AS n
  FROM dirty WHERE email LIKE '%@%' GROUP BY 1) t""")
def domain_share(spark, sf):
    d = dirty(spark, sf).where(F.col("email").like("%@%")) \
        .select(F.substring_index(F.lower(F.trim("email")), "@", -1).alias("domain"))
    return K.share(d, ["domain"])


@register("top_groups", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10""")
def top_groups(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey")
    # top-k is the feature here; TakeOrderedAndProject keeps k rows per task
    return K.key_counts(o, ["o_custkey"]).orderBy(F.col("n").desc(), "o_custkey").limit(10)


OFFSET_N = 5


@register("offset_rows", f"""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey OFFSET {OFFSET_N}""")
def offset_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    # distributed numbering instead of a single-partition OFFSET
    s = K.assign_sequence(o, ["o_orderdate", "o_orderkey"], start=1, out="__seq")
    return s.where(F.col("__seq") > OFFSET_N).drop("__seq")


@register("string_agg", """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities,
       count(DISTINCT o_orderpriority) AS n_priorities
FROM orders GROUP BY o_custkey""")
def string_agg_q(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    return o.groupBy("o_custkey").agg(string_agg("o_orderpriority", ",", distinct=True).alias("priorities"),
                                      F.count_distinct("o_orderpriority").alias("n_priorities"))


@register("shared_identity", oracle_with("dirty") + """
SELECT lower(trim(email)) AS email_key, birth_text, count(*) AS n_profiles,
  count(DISTINCT concat(coalesce(fname, ''), ' ', coalesce(lname, ''))) AS n_names,
  string_agg(DISTINCT concat(coalesce(fname, ''), ' ', coalesce(lname, '')), '|'
             ORDER BY concat(coalesce(fname, ''), ' ', coalesce(lname, ''))) AS names
FROM dirty WHERE email IS NOT NULL AND trim(email) <> '' AND birth_text IS NOT NULL
GROUP BY 1, 2
HAVING count(DISTINCT concat(coalesce(fname, ''), ' ', coalesce(lname, ''))) > 1""")
def shared_identity(spark, sf):
    from ..operators.identity import shared_identity as si
    return si(dirty(spark, sf), "email", "birth_text", ["fname", "lname"])


@register("level_totals", """
SELECT CASE grouping(event_type, day_part) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS level,
  event_type, day_part, count(*) AS n, count(DISTINCT user_id) AS n_users
FROM (SELECT event_type, user_id, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS day_part FROM events) t
GROUP BY GROUPING SETS ((event_type, day_part), (event_type), ())""")
def level_totals(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_type", "user_id", F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("day_part"))
    return K.rollup_counts(ev, [("event_type", "day_part"), ("event_type",), ()],
                           {"n": F.count(F.lit(1)), "n_users": F.count_distinct("user_id")})


@register("loyalty_pick", f"""
SELECT user_id, event_id, last_ts, value, event_type, CAST(user_id + 900000 AS BIGINT) AS member_number FROM (
  SELECT user_id, event_id, coalesce(ts, TIMESTAMP '1900-01-01') AS last_ts, value, event_type,
    row_number() OVER (PARTITION BY user_id
      ORDER BY coalesce(ts, TIMESTAMP '1900-01-01') DESC, coalesce(value, 0) DESC, event_id DESC) AS rn
  FROM events WHERE event_type IN ('purchase', 'signup') AND ts <= TIMESTAMP '{AS_OF_EVENTS} 23:59:59') t
WHERE rn = 1""")
def loyalty_pick(spark, sf):
    from ..operators.identity import loyalty_pick as lp, member_number
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type")
    ev = ev.where(F.col("event_type").isin("purchase", "signup")
                  & (F.col("ts") <= F.to_timestamp_ntz(F.lit(f"{AS_OF_EVENTS} 23:59:59"))))
    picked = lp(ev, "user_id", "ts", "value", "event_id")
    return picked.withColumn("member_number", member_number("user_id", 900000)) \
        .select("user_id", "event_id", "last_ts", "value", "event_type", "member_number")
