"""Driver queries for the join forms (J1-J21) and the identity joins built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.change import flag_exists as flag_exists_op, update_from
from ..operators.identity import backfill_unique as backfill_op, match_rules as match_op, party_type
from ..operators.keys import key_counts
from .registry import register
from .tables import allowances, oracle_with, orders_new, table

AS_OF_EARLY = "2024-01-03"


@register("flag_exists", """
SELECT c_custkey, c_name,
  CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
       THEN 1 ELSE 0 END AS has_urgent
FROM customer c""")
def flag_exists(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders")
    return flag_exists_op(c, o, [("c_custkey", "o_custkey")], "has_urgent",
                          src_filter=F.col("o_orderpriority") == "1-URGENT")


GROUP_MIN = 12


@register("in_subquery", f"""
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
WHERE (c_nationkey, c_mktsegment) IN (
  SELECT c_nationkey, c_mktsegment FROM customer GROUP BY 1, 2 HAVING count(*) > {GROUP_MIN})""")
def in_subquery(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    groups = key_counts(c, ["c_nationkey", "c_mktsegment"]).where(F.col("n") > GROUP_MIN)
    return J.keep_matching(c, groups, ["c_nationkey", "c_mktsegment"])


@register("anti_missing", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def anti_missing(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return J.keep_missing(o, table(spark, sf, "lineitem"), [("o_orderkey", "l_orderkey")])


@register("anti_multi_key", f"""
SELECT DISTINCT user_id, event_type FROM events e
WHERE ts >= TIMESTAMP '{AS_OF_EARLY}'
  AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = e.event_type
                  AND p.ts < TIMESTAMP '{AS_OF_EARLY}')""")
def anti_multi_key(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    cut = F.to_timestamp_ntz(F.lit(AS_OF_EARLY + " 00:00:00"))
    new = ev.where(F.col("ts") >= cut).select("user_id", "event_type").distinct()
    return J.keep_missing(new, ev, ["user_id", "event_type"], b_filter=F.col("ts") < cut)


@register("semi_of_anti", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders o
                    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))""")
def semi_of_anti(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lonely = J.keep_missing(o, table(spark, sf, "lineitem"), [("o_orderkey", "l_orderkey")])
    return J.keep_matching(c, lonely, [("c_custkey", "o_custkey")])


WINDOWS_SQL = """SELECT n_nationkey AS w_nationkey, DATE '1996-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS w_from,
  CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE DATE '1996-01-01' + CAST(n_nationkey * 30 + 365 AS INTEGER) END AS w_to
FROM nation"""


def nation_windows(spark, sf):
    n = table(spark, sf, "nation")
    start = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("n_nationkey") * 30).cast("int"))
    end = F.when(F.col("n_nationkey") % 3 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit("1996-01-01").cast("date"), (F.col("n_nationkey") * 30 + 365).cast("int")))
    return n.select(F.col("n_nationkey").alias("w_nationkey"), start.alias("w_from"), end.alias("w_to"))


@register("interval_exclusion", f"""
WITH w AS ({WINDOWS_SQL}),
oc AS (SELECT o_orderkey, c_nationkey, CAST(o_orderdate AS DATE) AS o_day
       FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT o_orderkey, c_nationkey,
  CASE WHEN EXISTS (SELECT 1 FROM w WHERE w_nationkey = c_nationkey AND o_day >= w_from
                    AND (w_to IS NULL OR o_day <= w_to)) THEN 1 ELSE 0 END AS excluded
FROM oc""")
def interval_exclusion(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", "c_nationkey", F.to_date("o_orderdate").alias("o_day"))
    out = J.flag_in_window(oc, nation_windows(spark, sf), ("c_nationkey", "w_nationkey"), "o_day",
                           "w_from", "w_to", "excluded")
    return out.drop("o_day")


@register("conflict_pairs", oracle_with("orders_new") + """
SELECT o.o_orderkey, o.o_orderstatus AS old_status, n.o_orderstatus AS new_status
FROM orders o JOIN orders_new n ON n.o_orderkey = o.o_orderkey AND o.o_orderstatus <> n.o_orderstatus""")
def conflict_pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").alias("o")
    n = orders_new(spark, sf).select("o_orderkey", "o_orderstatus").alias("n")
    j = J.join_on(o, n, ["o_orderkey"], extra=F.col("o.o_orderstatus") != F.col("n.o_orderstatus"))
    return j.select(F.col("o.o_orderkey"), F.col("o.o_orderstatus").alias("old_status"),
                    F.col("n.o_orderstatus").alias("new_status"))


@register("match_rules", oracle_with("orders_new") + """
, cand AS (
  SELECT o.o_orderkey, n.o_orderkey AS match_key, 1 AS rule FROM orders o JOIN orders_new n ON n.o_orderkey = o.o_orderkey
  UNION ALL
  SELECT o.o_orderkey, n.o_orderkey, 2 FROM orders o JOIN orders_new n
    ON n.o_custkey = o.o_custkey AND CAST(n.o_orderdate AS DATE) = CAST(o.o_orderdate AS DATE)
   AND n.o_orderpriority = o.o_orderpriority)
SELECT o_orderkey, match_key, rule FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY rule, match_key) AS rn FROM cand) t
WHERE rn = 1""")
def match_rules(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority") \
        .withColumn("o_day", F.to_date("o_orderdate"))
    n = orders_new(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority") \
        .withColumn("o_day", F.to_date("o_orderdate"))
    rules = [(["o_orderkey"], ["o_orderkey"]),
             (["o_custkey", "o_day", "o_orderpriority"], ["o_custkey", "o_day", "o_orderpriority"])]
    return match_op(o, n, "o_orderkey", "o_orderkey", rules, match_col="match_key")


@register("backfill_unique", """
WITH s AS (SELECT l_orderkey, max(l_linestatus) AS v, count(DISTINCT l_linestatus) AS n
           FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN s.n = 1 THEN s.v END AS line_status
FROM orders LEFT JOIN s ON s.l_orderkey = o_orderkey""")
def backfill_unique(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey").withColumn("line_status", F.lit(None).cast("string"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus")
    return backfill_op(o, li, ("o_orderkey", "l_orderkey"), "l_linestatus", "line_status")


@register("lookup_one", """
SELECT c_custkey, c_name, o_orderkey FROM customer c JOIN (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
  FROM orders) o ON o.o_custkey = c.c_custkey AND rn = 1""")
def lookup_one(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    return J.lookup_one(c, o, "c_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]) \
        .drop("o_orderdate")


PARTY_ID_SQL = """concat(CASE c_custkey % 4 WHEN 0 THEN '001' WHEN 1 THEN '003' WHEN 2 THEN '00Q' ELSE '00X' END,
  lpad(CAST(c_custkey AS VARCHAR), 12, '0'))"""


def party_id(c="c_custkey"):
    k = F.col(c)
    pref = F.when(k % 4 == 0, "001").when(k % 4 == 1, "003").when(k % 4 == 2, "00Q").otherwise("00X")
    return F.concat(pref, F.lpad(k.cast("string"), 12, "0"))


@register("consent_merge", f"""
SELECT o.o_orderkey, o.o_custkey, c.c_name, n.n_name, {PARTY_ID_SQL.replace('c_custkey', 'o.o_custkey')} AS party_id,
  CASE substr({PARTY_ID_SQL.replace('c_custkey', 'o.o_custkey')}, 1, 3) WHEN '001' THEN 'Account'
    WHEN '003' THEN 'Contact' WHEN '00Q' THEN 'Lead' END AS party_type
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def consent_merge(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    m = J.left_merge(o, c, "o_custkey", "c_custkey")
    m = J.left_merge(m, n, "c_nationkey", "n_nationkey")
    m = m.withColumn("party_id", party_id("o_custkey"))
    return m.select("o_orderkey", "o_custkey", "c_name", "n_name", "party_id",
                    party_type("party_id").alias("party_type"))


@register("join_kinds", oracle_with("allowances") + """
, alw AS (SELECT l_orderkey, l_linenumber, sum(amount) AS amount FROM allowances GROUP BY 1, 2),
per_line AS (SELECT l.l_orderkey, count(*) AS n_lines, sum(coalesce(a.amount, 0)) AS allowance
             FROM lineitem l LEFT JOIN alw a ON a.l_orderkey = l.l_orderkey AND a.l_linenumber = l.l_linenumber
             GROUP BY l.l_orderkey)
SELECT o.o_orderkey, coalesce(p.n_lines, 0) AS n_lines, CAST(coalesce(p.allowance, 0) AS DOUBLE) AS allowance,
  (SELECT count(*) FROM orders) AS n_orders_total, (SELECT count(*) FROM lineitem) AS n_lines_total
FROM orders o LEFT JOIN per_line p ON p.l_orderkey = o.o_orderkey
WHERE p.l_orderkey = o.o_orderkey OR p.l_orderkey IS NULL""")
def join_kinds(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf, "orders").select("o_orderkey")
    alw = allowances(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(F.sum("amount").alias("amount"))
    per_line = (J.join_on(li, alw, ["l_orderkey", "l_linenumber"], "left")
                .groupBy("l_orderkey")
                .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.coalesce("amount", F.lit(0))).alias("allowance")))
    j = o.join(per_line, o["o_orderkey"] == per_line["l_orderkey"], "left") \
        .where((per_line["l_orderkey"] == o["o_orderkey"]) | per_line["l_orderkey"].isNull())
    n_orders = table(spark, sf, "orders").select(F.count(F.lit(1))).scalar()
    n_lines = table(spark, sf, "lineitem").select(F.count(F.lit(1))).scalar()
    return j.select("o_orderkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                    F.coalesce("allowance", F.lit(0)).cast("double").alias("allowance"),
                    n_orders.alias("n_orders_total"), n_lines.alias("n_lines_total"))


@register("star_join", """
SELECT l.l_orderkey, l.l_linenumber, c.c_name, cn.n_name AS cust_nation, r.r_name AS cust_region,
  p.p_name, s.s_name, sn.n_name AS supp_nation
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation cn ON cn.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = cn.n_regionkey
JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation sn ON sn.n_nationkey = s.s_nationkey""")
def star_join(spark, sf):
    from ..operators.report import star_join as star
    t = {n: table(spark, sf, n) for n in ["lineitem", "orders", "customer", "nation", "region", "part", "supplier"]}
    return star(t)


@register("unmapped_amounts", """
SELECT l.l_partkey, count(*) AS n_lines,
  CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem l LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) p ON p.p_partkey = l.l_partkey
WHERE p.p_partkey IS NULL GROUP BY l.l_partkey""")
def unmapped_amounts(spark, sf):
    from ..operators.report import unmapped
    li = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    dim = table(spark, sf, "part").where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("l_partkey"))
    return unmapped(li, dim, "l_partkey", "l_extendedprice")


@register("required_guard", """
SELECT o_custkey, count(*) AS n_orders FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') GROUP BY o_custkey""")
def required_guard(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey")
    dim = table(spark, sf, "customer").where(F.col("c_mktsegment") != "AUTOMOBILE").select("c_custkey")
    missing = J.keep_missing(o, dim, [("o_custkey", "c_custkey")])
    return key_counts(missing, ["o_custkey"], "n_orders")


@register("relate", f"""
SELECT o_orderkey, {PARTY_ID_SQL} AS account_id FROM orders JOIN customer ON c_custkey = o_custkey""")
def relate(spark, sf):
    from ..operators.identity import relate as rel
    ids = table(spark, sf, "customer").select("c_custkey", party_id().alias("account_id"))
    return rel(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ids, ("o_custkey", "c_custkey"),
               "account_id").select("o_orderkey", "account_id")


@register("propagate_keys", """
WITH c AS (SELECT c_custkey, n_regionkey AS region_key FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)
SELECT o_orderkey, o_custkey, c.region_key FROM orders LEFT JOIN c ON c.c_custkey = o_custkey""")
def propagate_keys(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey") \
        .withColumn("region_key", F.lit(None).cast("int"))
    c = update_from(c, n, ["c_nationkey"], {"region_key": "src_n_regionkey"})
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey").withColumn("region_key", F.lit(None).cast("int"))
    src = c.select(F.col("c_custkey").alias("o_custkey"), "region_key")
    return update_from(o, src, ["o_custkey"], {"region_key": "src_region_key"})


@register("delete_matching", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW')""")
def delete_matching(spark, sf):
    from ..operators.change import delete_matching as dm
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    lst = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))
    return dm(c, lst, [("c_custkey", "o_custkey")])


@register("update_from", """
SELECT c_custkey, c_nationkey, CASE WHEN n_regionkey <> 0 THEN n_name END AS nation_name
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def update_from_q(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey") \
        .withColumn("nation_name", F.lit(None).cast("string"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return update_from(c, n, ["c_nationkey"], {"nation_name": "src_n_name"}, where=F.col("src_n_regionkey") != 0)


@register("fill_from", oracle_with("dirty") + """
, src AS (SELECT c_custkey, concat('Guest ', c_custkey) AS fname, 'DE' AS country FROM customer WHERE c_custkey % 2 = 0)
SELECT d.c_custkey, coalesce(d.fname, s.fname) AS fname, coalesce(d.country, s.country) AS country
FROM dirty d LEFT JOIN src s ON s.c_custkey = d.c_custkey""")
def fill_from_q(spark, sf):
    from ..operators.change import fill_from
    from .tables import dirty
    d = dirty(spark, sf).select("c_custkey", "fname", "country")
    src = table(spark, sf, "customer").where(F.col("c_custkey") % 2 == 0).select(
        "c_custkey", F.concat(F.lit("Guest "), F.col("c_custkey")).alias("fname"), F.lit("DE").alias("country"))
    return fill_from(d, src, ["c_custkey"], ["fname", "country"])


@register("anti_events_users", f"""
SELECT DISTINCT user_id FROM events e WHERE event_type = 'purchase'
  AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '{AS_OF_EARLY}')""")
def anti_events_users(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    buyers = ev.where(F.col("event_type") == "purchase").select("user_id").distinct()
    errs = ev.where((F.col("event_type") == "error")
                    & (F.col("ts") < F.to_timestamp_ntz(F.lit(AS_OF_EARLY + " 00:00:00"))))
    return J.keep_missing(buyers, errs, ["user_id"])
