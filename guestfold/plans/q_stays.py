"""Driver queries for reservations, revenue, occupancy and reporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import report as REP
from ..operators import stays as S
from .registry import register
from .tables import AS_OF_ORDERS, allowances, oracle_with, orders_new, table

CLASS_SQL = "CASE l_returnflag WHEN 'A' THEN 'room' WHEN 'N' THEN 'fnb' WHEN 'R' THEN 'extra' END"


@register("folio_revenue", oracle_with("allowances") + f"""
, alw AS (SELECT l_orderkey, l_linenumber, sum(amount) AS alw FROM allowances GROUP BY 1, 2),
net AS (SELECT l.l_orderkey, {CLASS_SQL} AS cls,
          CAST(l.l_extendedprice AS DECIMAL(18,4)) - coalesce(a.alw, 0) AS net
        FROM lineitem l LEFT JOIN alw a ON a.l_orderkey = l.l_orderkey AND a.l_linenumber = l.l_linenumber)
SELECT l_orderkey,
  CAST(sum(CASE WHEN cls = 'room' THEN net END) AS DOUBLE) AS revenue_room,
  CAST(sum(CASE WHEN cls = 'fnb' THEN net END) AS DOUBLE) AS revenue_fnb,
  CAST(sum(CASE WHEN cls = 'extra' THEN net END) AS DOUBLE) AS revenue_extra,
  CAST(sum(net) AS DOUBLE) AS revenue_total
FROM net GROUP BY l_orderkey""")
def folio_revenue(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                             F.col("l_extendedprice").alias("amount"))
    alw = allowances(spark, sf)
    rf = F.col("l_returnflag")
    cls = F.when(rf == "A", "room").when(rf == "N", "fnb").when(rf == "R", "extra")
    out = S.folio_revenue(li, alw, ["l_orderkey", "l_linenumber"], "l_orderkey", cls)
    return out.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in
                                      ["revenue_room", "revenue_fnb", "revenue_extra", "revenue_total"]])


FOLD_SQL = """WITH base AS (
  SELECT user_id, CASE WHEN user_id % 3 = 0 THEN min(ts) END AS checkin_at, CAST(NULL AS TIMESTAMP) AS checkout_at
  FROM events WHERE event_type = 'signup' GROUP BY user_id),
ev AS (SELECT user_id, min(CASE WHEN event_type = 'click' THEN ts END) AS first_click,
              max(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase FROM events GROUP BY user_id)
SELECT b.user_id, coalesce(ev.first_click, b.checkin_at) AS checkin_at,
  coalesce(ev.last_purchase, b.checkout_at) AS checkout_at,
  coalesce(b.checkin_at, ev.first_click) AS checkin_existing_first
FROM base b LEFT JOIN ev ON ev.user_id = b.user_id"""


@register("fold_events", FOLD_SQL)
def fold_events(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    base = ev.where(F.col("event_type") == "signup").groupBy("user_id").agg(
        F.when(F.col("user_id") % 3 == 0, F.min("ts")).alias("checkin_at"),
        F.lit(None).cast("timestamp_ntz").alias("checkout_at"))
    shaped = ev.select("user_id", F.when(F.col("event_type") == "click", F.col("ts")).alias("click_ts"),
                       F.when(F.col("event_type") == "purchase", F.col("ts")).alias("purchase_ts"))
    cols = {"checkin_at": ("click_ts", "min"), "checkout_at": ("purchase_ts", "max")}
    out = S.fold_events(base, shaped, "user_id", cols, "both")
    return out.select("user_id", "checkin_at", "checkout_at", "checkin_at_existing_first").withColumnRenamed(
        "checkin_at_existing_first", "checkin_existing_first")


@register("exclusion_reasons", f"""
SELECT o_orderkey,
  coalesce(CASE WHEN o_orderkey % 97 = 0 THEN 'legacy' END,
    CASE WHEN o_orderdate > TIMESTAMP '{AS_OF_ORDERS}' THEN 'future_stay'
         WHEN o_orderstatus = 'P' THEN 'pending'
         WHEN o_totalprice < 5000 THEN 'low_value'
         WHEN o_custkey % 50 = 0 THEN 'test_customer' END) AS exclude_reason,
  CASE WHEN coalesce(CASE WHEN o_orderkey % 97 = 0 THEN 'legacy' END,
    CASE WHEN o_orderdate > TIMESTAMP '{AS_OF_ORDERS}' THEN 'future_stay' WHEN o_orderstatus = 'P' THEN 'pending'
         WHEN o_totalprice < 5000 THEN 'low_value' WHEN o_custkey % 50 = 0 THEN 'test_customer' END) IS NULL
       THEN 0 ELSE 1 END AS excluded
FROM orders""")
def exclusion_reasons(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    o = o.withColumn("exclude_reason", F.when(F.col("o_orderkey") % 97 == 0, F.lit("legacy")))
    rules = [("future_stay", F.col("o_orderdate") > F.to_timestamp_ntz(F.lit(AS_OF_ORDERS))),
             ("pending", F.col("o_orderstatus") == "P"),
             ("low_value", F.col("o_totalprice") < 5000),
             ("test_customer", F.col("o_custkey") % 50 == 0)]
    return S.exclude(o, rules).select("o_orderkey", "exclude_reason", "excluded")


TAG_RULES_SQL = [
    ("Urgent Booker", "Booking Style", "PREF001", "o_orderpriority = '1-URGENT'"),
    ("Large Party", "Family", "PREF002", "max_qty >= 45"),
    ("Large Party", "Family", "PREF003", "max_qty >= 45"),
    ("High Spender", "Value", "PREF004", "o_totalprice > 450000"),
    ("Returner", "Value", "PREF005", "o_orderstatus = 'F' AND n_lines >= 6"),
]


@register("preference_tags", """
WITH f AS (SELECT o.o_custkey, o.o_orderpriority, o.o_totalprice, o.o_orderstatus, l.max_qty, l.n_lines
           FROM orders o JOIN (SELECT l_orderkey, max(l_quantity) AS max_qty, count(*) AS n_lines FROM lineitem
                               GROUP BY 1) l ON l.l_orderkey = o.o_orderkey)
""" + "\nUNION\n".join(
    f"SELECT DISTINCT o_custkey, '{n}' AS preference_name, '{c}' AS preference_category, '{e}' AS external_id, "
    f"'tpch' AS source_system FROM f WHERE {cond}" for n, c, e, cond in TAG_RULES_SQL))
def preference_tags(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("max_qty"),
                                                                F.count(F.lit(1)).alias("n_lines"))
    f = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    rules = [(n, c, e, F.expr(cond)) for n, c, e, cond in TAG_RULES_SQL]
    return S.preference_tags(f, "o_custkey", rules, "tpch")


IMPORT_RES_SQL = """SELECT o_orderkey, o_custkey AS cluster_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'CheckedOut' WHEN 1 THEN 'Confirmed' WHEN 2 THEN 'Optional' WHEN 3 THEN 'Cancelled' END AS reservation_status,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('p', o_custkey) END AS sf_person_contact_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'prop' END AS sf_property_id,
  CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS is_investor,
  CASE o_orderkey % 4 WHEN 0 THEN 'OTA' WHEN 1 THEN 'INDIVIDUAL' ELSE 'FIT' END AS market_segment,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'bulk@example.org' ELSE 'a@example.org' END AS email,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE concat('b', o_orderkey) END AS booking_id,
  o_orderdate AS arrival_at, o_orderdate AS last_updated_at, CAST(o_orderkey % 2 AS INT) AS _excluded FROM {orders}"""


@register("import_sets", f"""
WITH r AS ({IMPORT_RES_SQL.format(orders='orders')}), p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS inv FROM customer),
h AS (SELECT r.* FROM r JOIN p ON r.cluster_id = p.c_custkey WHERE sf_person_contact_id IS NOT NULL AND sf_property_id IS NOT NULL
      AND reservation_status = 'CheckedOut' AND is_investor = 0 AND inv = 0),
f AS (SELECT r.* FROM r JOIN p ON r.cluster_id = p.c_custkey WHERE sf_person_contact_id IS NOT NULL AND sf_property_id IS NOT NULL
      AND reservation_status IN ('Confirmed', 'InHouse', 'Optional') AND is_investor = 0 AND inv = 0)
SELECT o_orderkey, 'history' AS import_set FROM h UNION ALL SELECT o_orderkey, 'future' FROM f
UNION ALL SELECT o_orderkey, 'future_unmatched' FROM r WHERE reservation_status NOT IN ('CheckedOut', 'Cancelled')
  AND market_segment IN ('INDIVIDUAL', 'OTA') AND email IS NOT NULL AND email NOT IN ('bulk@example.org') AND sf_property_id IS NOT NULL
  AND sf_person_contact_id IS NULL AND is_investor = 0 AND booking_id IS NOT NULL AND arrival_at > TIMESTAMP '1996-01-01'
  AND o_orderkey NOT IN (SELECT o_orderkey FROM h) AND o_orderkey NOT IN (SELECT o_orderkey FROM f)
UNION ALL SELECT o_orderkey, 'changed_since' FROM r WHERE last_updated_at >= TIMESTAMP '{AS_OF_ORDERS}' AND _excluded = 0""")
def import_sets(spark, sf):
    r = spark.sql(IMPORT_RES_SQL, orders=table(spark, sf, "orders"))
    p = table(spark, sf, "customer").select(F.col("c_custkey").alias("cluster_id"),
                                            F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0).alias("is_investor"))
    return S.import_sets(r, p, "o_orderkey", "cluster_id", AS_OF_ORDERS, "1996-01-01", ["bulk@example.org"])


RES_SQL = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 THEN 'protel' ELSE 'apaleo' END AS source,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'c' END AS property_code,
  CASE o_orderkey % 29 WHEN 0 THEN 'OWN' WHEN 1 THEN 'APPET' ELSE 'BAR' END AS rate_plan_code,
  CASE o_orderkey % 7 WHEN 0 THEN 'Optional' WHEN 1 THEN 'Cancelled' WHEN 2 THEN 'NoShow' WHEN 3 THEN NULL ELSE 'Confirmed' END AS reservation_status,
  CASE WHEN o_orderkey % 5 < 2 THEN concat('sf', o_orderkey) END AS sf_reservation_id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'prop' END AS sf_property_id,
  o_orderkey % 19 = 0 AS _overlapped,
  CAST(CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS INT) AS _excluded,
  CASE WHEN o_orderkey % 74 = 0 THEN 'legacy' END AS exclude_reason FROM {orders}"""


@register("reservation_exclusions", f"""
WITH r0 AS ({RES_SQL.format(orders='orders')}),
r1 AS (SELECT * REPLACE (CASE WHEN source = 'protel' AND property_code IS NULL THEN 1 ELSE _excluded END AS _excluded) FROM r0),
r2 AS (SELECT * REPLACE (CASE WHEN c THEN 1 ELSE _excluded END AS _excluded, CASE WHEN c THEN 'apartment owner' ELSE exclude_reason END AS exclude_reason)
       FROM (SELECT *, rate_plan_code IN ('OWN', 'APP', 'APPET') AND _excluded = 0 AS c FROM r1)),
r3 AS (SELECT * REPLACE (CASE WHEN c THEN 1 ELSE _excluded END AS _excluded, CASE WHEN c THEN 'optional status' ELSE exclude_reason END AS exclude_reason,
         coalesce(reservation_status = 'Optional', false) AND sf_reservation_id IS NULL AS c)
       FROM (SELECT * REPLACE (coalesce(reservation_status = 'Optional', false) AND sf_reservation_id IS NULL AS c) FROM r2)),
r4 AS (SELECT * REPLACE (CASE WHEN c THEN 0 ELSE _excluded END AS _excluded, CASE WHEN c THEN NULL ELSE exclude_reason END AS exclude_reason)
       FROM (SELECT * REPLACE (coalesce(reservation_status = 'Optional', false) AND _excluded = 1 AND sf_reservation_id IS NOT NULL AS c) FROM r3)),
r5 AS (SELECT * REPLACE (CASE WHEN c THEN 1 ELSE _excluded END AS _excluded, CASE WHEN c THEN 'inactive property' ELSE exclude_reason END AS exclude_reason)
       FROM (SELECT * REPLACE (sf_property_id IS NULL AND sf_reservation_id IS NOT NULL AS c) FROM r4)),
r6 AS (SELECT * REPLACE (CASE WHEN c THEN 1 ELSE _excluded END AS _excluded, CASE WHEN c THEN 'overlapped' ELSE exclude_reason END AS exclude_reason)
       FROM (SELECT * REPLACE (source = 'protel' AND _excluded = 0 AND _overlapped AS c) FROM r5)),
r7 AS (SELECT * REPLACE (CASE WHEN c THEN 1 ELSE _excluded END AS _excluded, CASE WHEN c THEN 'cancelled' ELSE exclude_reason END AS exclude_reason)
       FROM (SELECT * REPLACE (coalesce(reservation_status IN ('Cancelled', 'NoShow'), false) AND sf_reservation_id IS NULL AND exclude_reason IS NULL AS c) FROM r6)),
r8 AS (SELECT * REPLACE (CASE WHEN coalesce(reservation_status IN ('Cancelled', 'NoShow'), false) AND _excluded = 0 AND sf_reservation_id IS NULL
         THEN 1 ELSE _excluded END AS _excluded) FROM r7)
SELECT o_orderkey, CAST(CASE WHEN sf_property_id IS NULL AND exclude_reason IS NULL THEN 1 ELSE _excluded END AS INT) AS _excluded,
  CASE WHEN sf_property_id IS NULL AND exclude_reason IS NULL THEN 'inactive property' ELSE exclude_reason END AS exclude_reason FROM r8""")
def reservation_exclusions(spark, sf):
    return S.exclude_reservations(spark.sql(RES_SQL, orders=table(spark, sf, "orders"))).select("o_orderkey", "_excluded", "exclude_reason")


@register("conditional_nights", """
WITH l AS (SELECT l_orderkey, count(*) FILTER (WHERE l_quantity < 5) AS kids, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
b AS (SELECT o.o_orderkey, coalesce(l.kids, 0) AS children_num,
        CASE WHEN l.last_ship > o.o_orderdate THEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.last_ship AS DATE))
             ELSE 0 END AS nights,
        CASE o.o_orderstatus WHEN 'P' THEN 3 ELSE 1 END AS status,
        CASE WHEN o.o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS category,
        o.o_orderkey % 6 AS room_no, o.o_orderkey % 10 AS account,
        CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE o.o_custkey % 10 END AS sharer,
        CASE WHEN o.o_orderkey % 9 = 0 THEN 4 ELSE 1 END AS room_type
      FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey)
SELECT o_orderkey, CAST(children_num AS BIGINT) AS children_num, CAST(nights AS INTEGER) AS nights,
  CAST(CASE WHEN status NOT IN (3, -1) AND category = 1 AND room_no > 0 AND (account = sharer OR sharer IS NULL)
       AND room_type NOT IN (4) THEN coalesce(nights, 0) ELSE 0 END AS INTEGER) AS room_nights
FROM b""")
def conditional_nights(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    kids = li.where(F.col("l_quantity") < 5).select("l_orderkey")
    last = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    b = S.child_counts(o.withColumnRenamed("o_orderkey", "l_orderkey"), kids, "l_orderkey")
    b = b.join(last, "l_orderkey", "left").withColumnRenamed("l_orderkey", "o_orderkey")
    nights = X.nights("o_orderdate", F.coalesce("last_ship", "o_orderdate")).cast("int")
    status = F.when(F.col("o_orderstatus") == "P", 3).otherwise(1)
    cat = F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1)
    k = F.col("o_orderkey")
    sharer = F.when(k % 4 != 0, F.col("o_custkey") % 10)
    rtype = F.when(k % 9 == 0, 4).otherwise(1)
    return b.select("o_orderkey", "children_num", nights.alias("nights"),
                    S.room_nights(status, cat, k % 6, k % 10, sharer, rtype, nights).cast("int").alias("room_nights"))


REVENUE_SQL = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@register("commercial_report", f"""
WITH f AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'system_a' ELSE 'system_b' END AS source,
             strftime(o_orderdate, '%Y-%m') AS month, n_name, c_mktsegment, {REVENUE_SQL} AS rev
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey)
SELECT source, month, n_name, c_mktsegment, CAST(sum(rev) AS DOUBLE) AS revenue, count(*) AS n_lines
FROM f GROUP BY 1, 2, 3, 4""")
def commercial_report(spark, sf):
    t = {n: table(spark, sf, n) for n in ["lineitem", "orders", "customer", "nation"]}
    fact = REP.revenue_fact(t["lineitem"], t["orders"], t["customer"], t["nation"])
    # proxy for two systems: the two halves of the orders, tagged in one pass
    fact = fact.withColumn("source", F.when(F.col("o_orderkey") % 2 == 0, "system_a").otherwise("system_b"))
    return REP.commercial_report(fact, "o_orderdate", ["n_name", "c_mktsegment"])


OCC_SQL = """SELECT 'pms' AS source, CAST(l_shipdate AS DATE) AS day, count(*) AS room_nights,
    CAST(sum(l_quantity) AS BIGINT) AS bed_nights, count(DISTINCT l_orderkey) AS adults,
    count(*) FILTER (WHERE l_quantity < 5) AS children
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2
UNION ALL
SELECT 'web', CAST(ts AS DATE), count(*) FILTER (WHERE event_type = 'purchase'), count(*), count(DISTINCT user_id),
    count(*) FILTER (WHERE event_type = 'signup')
  FROM events GROUP BY 1, 2"""


@register("occupancy_daily", OCC_SQL)
def occupancy_daily(spark, sf):
    return REP.occupancy_daily(table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "events"))


@register("kpi_long", f"""
WITH occ AS ({OCC_SQL})
SELECT source, day, concat(source, '_', kpi) AS kpi, CAST(value AS BIGINT) AS value FROM occ
UNPIVOT (value FOR kpi IN (room_nights, bed_nights, adults, children))""")
def kpi_long(spark, sf):
    occ = REP.occupancy_daily(table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "events"))
    return REP.kpi_long(occ, ["source", "day"], ["room_nights", "bed_nights", "adults", "children"],
                        name_prefix_col="source")


KPI_DAY = "1996-05-17"


@register("occupancy_kpis", f"""
WITH occ AS ({OCC_SQL})
SELECT source, day, concat(source, '_', kpi) AS kpi, CAST(value AS BIGINT) AS value
FROM (SELECT * FROM occ WHERE day = DATE '{KPI_DAY}') UNPIVOT (value FOR kpi IN (room_nights, bed_nights, adults, children))""")
def occupancy_kpis(spark, sf):
    return REP.occupancy_kpis(table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "events"), KPI_DAY)


HV_MIN = 1500000


@register("high_value", f"""
SELECT o_custkey AS c_custkey, c_nationkey AS currency, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY 1, 2 HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > {HV_MIN}""")
def high_value(spark, sf):
    from ..operators.identity import high_value as hv
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("currency"))
    active = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    out = hv(o.join(c, "o_custkey"), active, "o_custkey", "currency", "o_totalprice", HV_MIN)
    return out.select(F.col("o_custkey").alias("c_custkey"), "currency", "revenue")


@register("two_system_codes", """
SELECT l_partkey, count(DISTINCT l_linestatus) AS n_systems FROM lineitem GROUP BY l_partkey
HAVING count(DISTINCT l_linestatus) > 1""")
def two_system_codes(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_linestatus")
    return li.groupBy("l_partkey").agg(F.count_distinct("l_linestatus").alias("n_systems")) \
        .where(F.col("n_systems") > 1)


@register("ratio_by_period", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
  round(CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) * 100.0 / count(*), 2) AS pct_finished
FROM orders GROUP BY 1""")
def ratio_by_period(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), REP.ratio_pct(F.col("o_orderstatus") == "F").alias("pct_finished"))


@register("year_month_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
FROM orders GROUP BY 1, 2""")
def year_month_counts(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("object_counts", """
SELECT 'customer' AS object, count(*) AS n FROM customer UNION SELECT 'orders', count(*) FROM orders
UNION SELECT 'lineitem', count(*) FROM lineitem UNION SELECT 'part', count(*) FROM part""")
def object_counts(spark, sf):
    return REP.object_counts({n: table(spark, sf, n) for n in ["customer", "orders", "lineitem", "part"]})


@register("fill_rates", oracle_with("dirty") + """
SELECT field, filled, total, round(CAST(filled AS DOUBLE) * 100.0 / total, 2) AS pct FROM (
  SELECT count(*) AS total,
    count(*) FILTER (WHERE fname IS NOT NULL AND trim(fname) <> '') AS fname,
    count(*) FILTER (WHERE lname IS NOT NULL AND trim(lname) <> '') AS lname,
    count(*) FILTER (WHERE email IS NOT NULL AND trim(email) <> '') AS email,
    count(*) FILTER (WHERE cell_phone IS NOT NULL AND trim(cell_phone) <> '') AS cell_phone,
    count(*) FILTER (WHERE birth_text IS NOT NULL AND trim(birth_text) <> '') AS birth_text,
    count(*) FILTER (WHERE country IS NOT NULL AND trim(country) <> '') AS country
  FROM dirty) t
UNPIVOT (filled FOR field IN (fname, lname, email, cell_phone, birth_text, country))""")
def fill_rates(spark, sf):
    from .tables import dirty
    return REP.fill_rates(dirty(spark, sf), ["fname", "lname", "email", "cell_phone", "birth_text", "country"])


@register("length_profile", """
SELECT 'p_name' AS "column", CAST(max(length(p_name)) AS BIGINT) AS max_len,
  CAST(max(strlen(p_name)) AS BIGINT) AS max_bytes, count(*) FILTER (WHERE length(p_name) > 10) AS over_10,
  CAST(NULL AS BIGINT) AS over_255, CAST(NULL AS BIGINT) AS over_1000 FROM part
UNION ALL
SELECT 'text', CAST(max(length(text)) AS BIGINT), CAST(max(strlen(text)) AS BIGINT), count(*) FILTER (WHERE length(text) > 10),
  count(*) FILTER (WHERE length(text) > 255),
  count(*) FILTER (WHERE length(text) > 1000) FROM documents""")
def length_profile(spark, sf):
    p = REP.length_profile(table(spark, sf, "part"), {"p_name": [10]})
    d = REP.length_profile(table(spark, sf, "documents"), {"text": [10, 255, 1000]})
    return p.select("column", "max_len", "max_bytes", "over_10", F.lit(None).cast("bigint").alias("over_255"),
                    F.lit(None).cast("bigint").alias("over_1000")).unionByName(d)


RAW_SQL = """WITH l AS (SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_lines FROM lineitem GROUP BY 1),
raw AS (SELECT concat('R', o_orderkey) AS id, concat('P', c_nationkey) AS property__id, concat('B', o_custkey) AS booking_id,
    o_orderstatus AS status, CASE WHEN o_orderkey % 10 = 0 THEN concat('Group ', o_custkey) END AS group_name,
    o_orderdate AS arrival, l.last_ship AS departure, c_nationkey % 5 AS company__id,
    CAST(coalesce(l.n_lines, 0) AS BIGINT) AS adults, c_mktsegment AS market_segment__code,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Parking' ELSE 'BedRoom' END AS unit_group__type
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN l ON l.l_orderkey = o_orderkey),
props AS (SELECT concat('P', n_nationkey) AS code, concat('F', n_nationkey) AS group_code, CAST(n_nationkey * 7 AS BIGINT) AS protel,
    n_regionkey <> 4 AS active FROM nation)"""
STD_PROPERTIES = [f"P{i}" for i in range(20)]


@register("standardise_reservations", RAW_SQL + f"""
SELECT id AS reservation_id, 'pms' AS source, property__id AS property_id, booking_id, status AS reservation_status,
  CASE WHEN group_name IS NOT NULL THEN concat(booking_id, ' | ', group_name) END AS group_name,
  arrival AS arrival_at, departure AS departure_at, r_name AS booker_company_id, adults AS adults_num,
  CAST(CASE WHEN departure > arrival THEN date_diff('day', CAST(arrival AS DATE), CAST(departure AS DATE)) ELSE 0 END
       AS BIGINT) AS room_nights,
  market_segment__code AS market_segment, 'PRIMARY' AS guest_role, 'reservation' AS _ptable,
  CASE WHEN p.active THEN p.group_code END AS property_code, CASE WHEN p.active THEN p.protel END AS property_pms_id
FROM raw LEFT JOIN region ON r_regionkey = company__id LEFT JOIN props p ON p.code = property__id
WHERE unit_group__type = 'BedRoom' AND property__id IN ({", ".join(f"'{p}'" for p in STD_PROPERTIES)})""")
def standardise_reservations(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("departure"),
                                                                   F.count(F.lit(1)).alias("n_lines"))
    k = F.col("o_orderkey")
    raw = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(lines, k == F.col("l_orderkey"), "left")
           .select(F.concat(F.lit("R"), k).alias("id"), F.concat(F.lit("P"), F.col("c_nationkey")).alias("property__id"),
                   F.concat(F.lit("B"), F.col("o_custkey")).alias("booking_id"), F.col("o_orderstatus").alias("status"),
                   F.when(k % 10 == 0, F.concat(F.lit("Group "), F.col("o_custkey"))).alias("group_name"),
                   F.col("o_orderdate").alias("arrival"), "departure", (F.col("c_nationkey") % 5).alias("company__id"),
                   F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("adults"),
                   F.col("c_mktsegment").alias("market_segment__code"),
                   F.when(F.col("o_orderpriority") == "5-LOW", "Parking").otherwise("BedRoom").alias("unit_group__type")))
    companies = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"))
    std = S.standardise_reservations(raw, companies, "pms", STD_PROPERTIES)
    n = table(spark, sf, "nation")
    props = n.select(F.concat(F.lit("P"), F.col("n_nationkey")).alias("code"),
                     F.concat(F.lit("F"), F.col("n_nationkey")).alias("group_code"),
                     (F.col("n_nationkey") * 7).cast("bigint").alias("pms_id"),
                     F.lit(None).cast("string").alias("target_id"), (F.col("n_regionkey") != 4).alias("is_active"))
    std = S.attach_property(std, props)
    return std.select("reservation_id", "source", "property_id", "booking_id", "reservation_status", "group_name",
                      "arrival_at", "departure_at", "booker_company_id", "adults_num", "room_nights", "market_segment",
                      "guest_role", "_ptable", "property_code", "property_pms_id")


RAW_ADDRESS_SQL = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN concat('h', c_custkey, '@m.expediapartnercentral.com')
    WHEN 1 THEN concat('g', c_custkey, '@guest.Booking.com') WHEN 2 THEN concat('x', c_custkey, '@hrs.de')
    WHEN 3 THEN concat('sample.', c_custkey, '@example.org') END AS email FROM {customer} WHERE c_custkey % 11 <> 0"""


@register("recover_email", oracle_with("dirty") + f"""
, raw AS ({RAW_ADDRESS_SQL.format(customer='customer')})
SELECT d.c_custkey, CASE WHEN d.email IS NULL AND (raw.email ILIKE '%booking.com' OR raw.email ILIKE '%m.expediapartnercentral.com'
                           OR raw.email ILIKE '%hrs.de') THEN raw.email ELSE d.email END AS email
FROM dirty d LEFT JOIN raw ON raw.c_custkey = d.c_custkey""")
def recover_email(spark, sf):
    from .tables import dirty
    raw = spark.sql(RAW_ADDRESS_SQL, customer=table(spark, sf, "customer"))
    return S.recover_email(dirty(spark, sf).select("c_custkey", "email"), raw, "c_custkey", "email")
