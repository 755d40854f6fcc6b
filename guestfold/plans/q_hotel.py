"""Driver queries for the hotel reports (K1, K3, K4, R2): driver tables are mapped to the operators' columns here only."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hotel as H
from ..sources import views as V
from .registry import ORACLES, register
from .tables import table

#: Day, property, account and guests from lines and orders, as one SQL text for Spark and the oracle.
HISTORY_SQL = """SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey % 20 AS pms_id, l_orderkey AS account,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS status, CASE WHEN l_linenumber = 7 THEN 4 ELSE 1 END AS room_type,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE 1 END AS room_nights, CAST(l_quantity AS INT) % 4 AS adults, CAST(l_quantity AS INT) % 3 AS children_1,
  CAST(0 AS INT) AS children_2, CAST(l_quantity AS INT) % 2 AS children_3, CASE WHEN l_suppkey % 20 = 4 THEN NULL ELSE 0 END AS children_4 FROM {lineitem}"""
BOOKING_SQL = """SELECT o_orderkey AS account, CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS share_kind,
  CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1 END AS is_room,
  CASE WHEN o_orderstatus = 'P' THEN DATE '1996-01-01' ELSE DATE '1900-01-01' END AS cancelled_on FROM {orders}"""
PROPERTY_SQL = """SELECT CAST(n_nationkey AS BIGINT) AS pms_id, concat('P', n_nationkey) AS property_id, n_name AS name FROM {nation} WHERE n_nationkey % 7 <> 6"""
SLICE_SQL = "SELECT l_orderkey AS parent_id, CAST(l_shipdate AS DATE) AS day, l_linenumber AS unit_group FROM {lineitem}"
RES_SQL = """SELECT o_orderkey AS res_id, concat('P', o_custkey % 25) AS property_id, CASE o_orderstatus WHEN 'P' THEN 'NoShow' ELSE 'Confirmed' END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 2 END AS adults FROM {orders}"""
CHILD_SQL = "SELECT l_orderkey AS parent_id FROM {lineitem} WHERE l_quantity < 9"
START, END = "1996-02-01", "1996-08-01"

NAMES = {n: n for n in ("lineitem", "orders", "nation")}
OCC_CTE = f"""h AS ({HISTORY_SQL.format(**NAMES)}), b AS ({BOOKING_SQL.format(**NAMES)}), p AS ({PROPERTY_SQL.format(**NAMES)}),
ts AS ({SLICE_SQL.format(**NAMES)}), rs AS ({RES_SQL.format(**NAMES)}), ch AS ({CHILD_SQL.format(**NAMES)}),
occ AS (
SELECT 'history' AS source, day, h.pms_id, property_id, name, CAST(coalesce(sum(room_nights), 0) AS BIGINT) AS room_nights,
  CAST(coalesce(sum(adults) + sum(children_1) + sum(children_2) + sum(children_3) + sum(children_4), 0) AS BIGINT) AS bed_nights,
  CAST(coalesce(sum(adults), 0) AS BIGINT) AS adults_num,
  CAST(coalesce(sum(children_1) + sum(children_2) + sum(children_3) + sum(children_4), 0) AS BIGINT) AS children_num
FROM h JOIN p ON p.pms_id = h.pms_id
WHERE day >= DATE '{START}' AND day < DATE '{END}' AND status IN (1, 2) AND room_type <> 4
  AND EXISTS (SELECT 1 FROM b WHERE b.account = h.account AND share_kind = 0 AND is_room = 1 AND cancelled_on = DATE '1900-01-01')
GROUP BY day, h.pms_id, property_id, name
UNION ALL
SELECT 'slices', day, pms_id, rs.property_id, name, count(*), CAST(sum(coalesce(adults, 0) + coalesce(n, 0)) AS BIGINT),
  CAST(sum(coalesce(adults, 0)) AS BIGINT), CAST(sum(coalesce(n, 0)) AS BIGINT)
FROM ts JOIN rs ON rs.res_id = ts.parent_id JOIN p ON p.property_id = rs.property_id
LEFT JOIN (SELECT parent_id, count(*) AS n FROM ch GROUP BY 1) k ON k.parent_id = rs.res_id
WHERE day >= DATE '{START}' AND day < DATE '{END}' AND status NOT IN ('Canceled', 'NoShow') AND unit_group <= 4
GROUP BY day, pms_id, rs.property_id, name)"""


def _parts(spark, sf):
    t = {n: table(spark, sf, n) for n in NAMES}
    view = lambda sql: spark.sql(sql, **{n: t[n] for n in NAMES if "{" + n + "}" in sql})
    props = view(PROPERTY_SQL)
    units = t["lineitem"].select(F.col("l_linenumber").alias("unit_group")).distinct().withColumn(
        "type", F.when(F.col("unit_group") <= 4, "BedRoom").otherwise("MeetingRoom"))
    return {"history": H.occupancy_from_history(view(HISTORY_SQL), view(BOOKING_SQL), props, START, END),
            "slices": H.occupancy_from_slices(view(SLICE_SQL), view(RES_SQL), props, units, view(CHILD_SQL), START, END)}


@register("hotel_occupancy", f"WITH {OCC_CTE} SELECT * FROM occ")
def hotel_occupancy(spark, sf):
    return H.occupancy(_parts(spark, sf))


@register("hotel_day_kpis", f"""WITH {OCC_CTE},
base AS (SELECT source AS source_system, day AS rev_date, pms_id, property_id, name, room_nights, bed_nights FROM occ WHERE day = DATE '1996-05-17')
SELECT concat(property_id, '_ROOMNIGHT1') AS kpi, CAST(room_nights AS BIGINT) AS value, rev_date, source_system, pms_id, name FROM base
UNION ALL SELECT concat(property_id, '_BEDNIGHT1'), CAST(bed_nights AS BIGINT), rev_date, source_system, pms_id, name FROM base
UNION ALL SELECT concat(property_id, '_OPEN1'), CAST(CASE WHEN room_nights + bed_nights > 0 THEN 1 ELSE 0 END AS BIGINT), rev_date, source_system,
  pms_id, name FROM base""")
def hotel_day_kpis(spark, sf):
    return H.day_kpis(_parts(spark, sf), "1996-05-17")


@register("day_kpis_function", ORACLES["hotel_day_kpis"].replace("1996-05-17", "1996-05-18"))
def day_kpis_function(spark, sf):
    """The one-day KPIs called from SQL as a table function."""
    V.register_day_kpis(spark, _parts(spark, sf))
    return spark.sql("SELECT * FROM day_kpis(DATE '1996-05-18')")


RAW_RES_SQL = """SELECT o_orderkey AS id, concat('d', o_orderkey) AS row_id, concat('P', o_custkey % 9) AS property__id, o_orderdate AS created, o_orderstatus AS status,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END AS adults, concat(' ', o_orderpriority) AS primary_guest__address__country_code FROM {orders}"""
SWITCH_SQL = """SELECT concat('P', n_nationkey) AS code, concat('own', n_nationkey) AS own_id,
  CASE WHEN n_nationkey % 4 <> 0 THEN make_date(CAST(1993 + n_nationkey % 5 AS INT), 1, 1) END AS switch_from FROM {nation}"""
KIDS_SQL = "SELECT concat('d', l_orderkey) AS parent_id FROM {lineitem} WHERE l_linenumber > 3"
CLUSTER_SQL = "SELECT o_orderkey AS reservation_id, o_custkey AS cluster_id FROM {orders}"


@register("reservation_view", f"""
WITH r AS ({RAW_RES_SQL.format(orders='orders')}), p AS ({SWITCH_SQL.format(nation='nation')}), k AS ({KIDS_SQL.format(lineitem='lineitem')}),
cl AS ({CLUSTER_SQL.format(orders='orders')}), n AS (SELECT parent_id, count(*) AS n FROM k GROUP BY 1),
g AS (SELECT cluster_id FROM cl GROUP BY 1 HAVING count(*) BETWEEN 1 AND 3 OR count(*) BETWEEN 10 AND 50)
SELECT id AS reservation_id, property__id AS property_id, own_id AS property_own_id, status AS reservation_status, created AS booking_at,
  substr(trim(primary_guest__address__country_code), 1, 2) AS mk_country, CAST(coalesce(adults, 0) AS INTEGER) AS adults_num,
  CAST(coalesce(n.n, 0) AS INTEGER) AS children_num, cl.cluster_id, 'PRIMARY' AS guest_role
FROM r JOIN p ON p.code = property__id AND switch_from IS NOT NULL AND created >= switch_from
JOIN cl ON cl.reservation_id = r.id JOIN g ON g.cluster_id = cl.cluster_id LEFT JOIN n ON n.parent_id = row_id
WHERE created >= DATE '1996-01-01' AND property__id IN ('P1', 'P2', 'P3', 'P6')""")
def reservation_view(spark, sf):
    """The reservation view, filtered in SQL; the filters reach the scan of orders."""
    t = {n: spark.sql(q, **{d: table(spark, sf, d)}) for n, q, d in (
        ("r", RAW_RES_SQL, "orders"), ("p", SWITCH_SQL, "nation"), ("k", KIDS_SQL, "lineitem"), ("c", CLUSTER_SQL, "orders"))}
    V.register_views(spark, reservation_view=V.reservation_view(t["r"], t["p"], t["k"], t["c"]))
    return spark.sql("""SELECT reservation_id, property_id, property_own_id, reservation_status, booking_at, mk_country, adults_num, children_num, cluster_id, guest_role
FROM reservation_view WHERE booking_at >= DATE '1996-01-01' AND property_id IN ('P1', 'P2', 'P3', 'P6')""")


FACT_SQL = """SELECT o_orderdate AS rev_date, o_orderpriority AS property_id, o_orderstatus AS market_channel, o_custkey % 5 AS segment_group,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,4)) END AS revenue_total, CAST(o_totalprice / 2 AS DECIMAL(18,4)) AS revenue_room,
  CAST(o_orderkey % 3 AS INT) AS room_nights, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 2 END AS bed_nights FROM {orders} WHERE o_orderkey % 2 = """


def _commercial(system: str, odd: int) -> str:
    return f"""SELECT strftime(rev_date, '%Y-%m') AS month, property_id, market_channel, segment_group,
  CASE WHEN segment_group <> 3 THEN concat('{system}', segment_group) END AS report_segment,
  CAST(round(sum(coalesce(revenue_total, 0)), 2) AS DECIMAL(38,3)) AS revenue_total, CAST(round(sum(coalesce(revenue_room, 0)), 2) AS DECIMAL(38,3)) AS revenue_room,
  CAST(sum(coalesce(room_nights, 0)) AS BIGINT) AS room_nights, CAST(sum(coalesce(bed_nights, 0)) AS BIGINT) AS bed_nights, '{system}' AS pms_name
FROM ({FACT_SQL.format(orders='orders')}{odd}) GROUP BY ALL"""


@register("hotel_commercial", _commercial("a", 0) + " UNION ALL " + _commercial("b", 1))
def hotel_commercial(spark, sf):
    o = table(spark, sf, "orders")
    facts = {s: spark.sql(FACT_SQL + str(k), orders=o) for s, k in (("a", 0), ("b", 1))}
    groups = o.select((F.col("o_custkey") % 5).alias("segment_group")).distinct().where("segment_group <> 3")
    segs = {s: groups.withColumn("report_segment", F.concat(F.lit(s), "segment_group")) for s in facts}
    return H.commercial_units(facts, segs, ["property_id", "market_channel"])


CHARGE_SQL = """SELECT l_orderkey AS folio_id, l_linenumber AS charge_id,
  CASE l_linenumber WHEN 1 THEN 'Accommodation' WHEN 2 THEN 'FoodAndBeverages' WHEN 3 THEN 'Other' WHEN 4 THEN 'CityTax' WHEN 5 THEN 'NoShow' WHEN 6 THEN NULL
    ELSE 'Parking' END AS service_type, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount, CASE WHEN l_suppkey % 11 = 0 THEN 0 ELSE 1 END AS is_posted,
  CASE WHEN l_suppkey % 13 = 0 THEN 'r' END AS routed_to, CASE WHEN l_suppkey % 17 = 0 THEN 'm' END AS moved_to FROM {lineitem}"""
ALLOWANCE_SQL = """SELECT l_orderkey AS folio_id, l_linenumber AS charge_id, CAST(l_tax * 100 AS DECIMAL(18,4)) AS amount,
  CASE WHEN l_partkey % 3 = 0 THEN 'm' END AS moved_to FROM {lineitem} WHERE l_discount > 0.05
  UNION ALL SELECT l_orderkey, l_linenumber, CAST(1 AS DECIMAL(18,4)), NULL FROM {lineitem} WHERE l_discount > 0.08"""
FOLIO_SQL = """SELECT o_orderkey AS folio_id, o_custkey AS reservation_id, CASE WHEN o_orderkey % 6 = 0 THEN 'House' ELSE 'Guest' END AS type,
  CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'ClosedWithInvoice' END AS status FROM {orders}"""


@register("reservation_revenue", f"""
WITH chg AS ({CHARGE_SQL.format(**NAMES)}), al AS ({ALLOWANCE_SQL.format(**NAMES)}), fol AS ({FOLIO_SQL.format(**NAMES)}),
alw AS (SELECT folio_id, charge_id, sum(amount) AS amount FROM al WHERE moved_to IS NULL GROUP BY 1, 2)
SELECT reservation_id,
  CAST(sum(CASE WHEN service_type IN ('Accommodation', 'NoShow') THEN chg.amount - coalesce(alw.amount, 0) END) AS DECIMAL(18,4)) AS revenue_room,
  CAST(sum(CASE WHEN service_type = 'FoodAndBeverages' THEN chg.amount - coalesce(alw.amount, 0) END) AS DECIMAL(18,4)) AS revenue_fnb,
  CAST(sum(CASE WHEN service_type = 'Other' THEN chg.amount - coalesce(alw.amount, 0) END) AS DECIMAL(18,4)) AS revenue_extra,
  CAST(sum(chg.amount - coalesce(alw.amount, 0)) AS DECIMAL(18,4)) AS revenue_total
FROM fol LEFT JOIN chg ON chg.folio_id = fol.folio_id
LEFT JOIN alw ON alw.charge_id = chg.charge_id AND alw.folio_id = chg.folio_id
WHERE chg.is_posted = 1 AND chg.routed_to IS NULL AND chg.moved_to IS NULL AND chg.service_type NOT IN ('CityTax', 'SecondCityTax')
  AND fol.type = 'Guest' AND fol.status = 'ClosedWithInvoice' GROUP BY reservation_id""")
def reservation_revenue(spark, sf):
    li = table(spark, sf, "lineitem")
    return H.reservation_revenue(spark.sql(FOLIO_SQL, orders=table(spark, sf, "orders")), spark.sql(CHARGE_SQL, lineitem=li),
                                 spark.sql(ALLOWANCE_SQL, lineitem=li))
