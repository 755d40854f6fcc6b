"""Hotel reports on named columns: occupancy per day from two systems (K1, K3), the monthly
commercial report (K4) and revenue per reservation from folio charges (R2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money_sum, year_month
from .report import union_tagged

OCCUPANCY = ["room_nights", "bed_nights", "adults_num", "children_num"]
#: History statuses of stays, the room type of no room, "not cancelled", room units, statuses of no stay.
STAY_STATUS, NO_ROOM_TYPE, NOT_CANCELLED = [1, 2], 4, "1900-01-01"
ROOM_UNIT, NO_STAY = "BedRoom", ["Canceled", "NoShow"]
#: Service types by revenue class, types that never count, and the folios that count.
SERVICE_CLASSES = {"Accommodation": "room", "NoShow": "room", "FoodAndBeverages": "fnb", "Other": "extra"}
NO_SERVICE, FOLIO_TYPE, FOLIO_STATUS = ["CityTax", "SecondCityTax"], "Guest", "ClosedWithInvoice"


def _days(c: str, start: str, end: str) -> Column:
    return (F.col(c) >= F.lit(start).cast("date")) & (F.col(c) < F.lit(end).cast("date"))


def occupancy_from_history(daily: DataFrame, bookings: DataFrame, properties: DataFrame, start: str, end: str) -> DataFrame:
    """Occupancy per day and property from a guest history (K1).

    ``daily``: day, pms_id, account, status, room_type, room_nights, adults, children_1 to children_4;
    ``bookings``: account, share_kind, is_room, cancelled_on; ``properties``: pms_id, property_id, name.
    Days of stays that happened, of rooms, whose account has an uncancelled, unshared room booking (semi join).
    A sum of which a part has no value at all is 0, as the original's ``IFNULL`` around the sum of sums."""
    ok = bookings.where((F.col("share_kind") == 0) & (F.col("is_room") == 1) & (F.col("cancelled_on") == F.lit(NOT_CANCELLED).cast("date")))
    rows = daily.where(_days("day", start, end) & F.col("status").isin(STAY_STATUS) & (F.col("room_type") != NO_ROOM_TYPE))
    kids = sum((F.sum(f"children_{k}") for k in (2, 3, 4)), F.sum("children_1"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return (rows.join(ok.select("account"), "account", "left_semi").join(properties.select("pms_id", "property_id", "name"), "pms_id")
            .groupBy("day", "pms_id", "property_id", "name")
            .agg(zero(F.sum("room_nights")).alias("room_nights"), zero(F.sum("adults") + kids).alias("bed_nights"),
                 zero(F.sum("adults")).alias("adults_num"), zero(kids).alias("children_num")))


def occupancy_from_slices(slices: DataFrame, reservations: DataFrame, properties: DataFrame, unit_groups: DataFrame,
                          children: DataFrame, start: str, end: str) -> DataFrame:
    """Occupancy per day and property from reservation time slices (K1).

    ``slices``: parent_id, day, unit_group; ``reservations``: res_id, property_id, status, adults; ``properties``: as
    above; ``unit_groups``: unit_group, type; ``children``: parent_id, a row per child.  A slice of a room unit is one
    room night; children are counted per reservation first, so the joins never multiply slices."""
    kids = children.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_children"))
    res = reservations.where(~F.col("status").isin(NO_STAY)).withColumnRenamed("res_id", "parent_id")
    rooms = unit_groups.where(F.col("type") == ROOM_UNIT).select("unit_group")
    j = (slices.where(_days("day", start, end)).join(rooms, "unit_group").join(res, "parent_id")
         .join(properties.select("pms_id", "property_id", "name"), "property_id").join(kids, "parent_id", "left"))
    adults, n_kids = F.coalesce("adults", F.lit(0)), F.coalesce("n_children", F.lit(0))
    return j.groupBy("day", "pms_id", "property_id", "name").agg(
        F.count(F.lit(1)).alias("room_nights"), F.sum(adults + n_kids).cast("bigint").alias("bed_nights"),
        F.sum(adults).cast("bigint").alias("adults_num"), F.sum(n_kids).cast("bigint").alias("children_num"))


def occupancy(parts: Mapping[str, DataFrame]) -> DataFrame:
    """The systems' occupancy in one table, tagged."""
    return union_tagged(parts).select("source", "day", "pms_id", "property_id", "name", *OCCUPANCY)


def day_kpis(parts: Mapping[str, DataFrame], day: str) -> DataFrame:
    """One day's KPIs (K3): per system and property its room nights (``<property>_ROOMNIGHT1``), bed nights (``_BEDNIGHT1``) and
    whether there were any (``_OPEN1``: 1 or 0): kpi, value, rev_date, source_system, pms_id, name.  The day reaches the parts' scans."""
    occ = occupancy({k: v.where(F.col("day") == F.lit(day).cast("date")) for k, v in parts.items()})
    busy = F.when(F.col("room_nights") + F.col("bed_nights") > 0, 1).otherwise(0).cast("bigint")
    kpis = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in (
        ("_ROOMNIGHT1", F.col("room_nights")), ("_BEDNIGHT1", F.col("bed_nights")), ("_OPEN1", busy))])
    return occ.select("*", F.explode(kpis).alias("x")).select(
        F.concat("property_id", "x.k").alias("kpi"), F.col("x.v").alias("value"), F.col("day").alias("rev_date"),
        F.col("source").alias("source_system"), "pms_id", "name")


def commercial_units(facts: Mapping[str, DataFrame], segments: Mapping[str, DataFrame], dims: Sequence[str],
                     date_col: str = "rev_date", segment_col: str = "segment_group",
                     money: Sequence[str] = ("revenue_total", "revenue_room"), nights: Sequence[str] = ("room_nights", "bed_nights")) -> DataFrame:
    """Monthly commercial report of several systems (K4): ``month``, ``dims``, the system's report
    segment (``segments[system]``: segment_group, report_segment; unmapped ones NULL), ``money`` rounded to cents and
    ``nights``, tagged ``pms_name``.  Each system is aggregated before its segments are joined, which map one
    to one; NULL measures count as 0."""
    out = []
    for system, fact in facts.items():
        agg = fact.groupBy(year_month(date_col).alias("month"), *dims, segment_col).agg(
            *[money_sum(F.coalesce(m, F.lit(0)), 4).alias(m) for m in money],
            *[F.sum(F.coalesce(n, F.lit(0))).cast("bigint").alias(n) for n in nights])
        seg = segments[system].groupBy(segment_col).agg(F.min("report_segment").alias("report_segment"))
        j = agg.join(seg, segment_col, "left").withColumn("pms_name", F.lit(system))
        out.append(j.select("month", *dims, segment_col, "report_segment", *[F.round(m, 2).cast("decimal(38,3)").alias(m) for m in money],
                            *nights, "pms_name"))
    total = out[0]
    for o in out[1:]:
        total = total.unionByName(o)
    return total


def reservation_revenue(folios: DataFrame, charges: DataFrame, allowances: DataFrame) -> DataFrame:
    """Revenue per reservation from posted folio charges net of allowances (R2).

    ``folios``: folio_id, reservation_id, type, status; ``charges``: folio_id, charge_id, service_type, amount,
    is_posted, routed_to, moved_to; ``allowances``: folio_id, charge_id, amount, moved_to.  Charges that are posted, not
    routed or moved and no city tax, of guest folios closed with an invoice; allowances that were not moved, summed per charge before
    the join.  A class without charges is NULL; a NULL service type counts nowhere (``NOT IN``)."""
    alw = (allowances.where(F.col("moved_to").isNull()).groupBy("folio_id", "charge_id")
           .agg(money_sum("amount").alias("allowed")))
    live = charges.where((F.col("is_posted") == 1) & F.col("routed_to").isNull() & F.col("moved_to").isNull()
                         & ~F.col("service_type").isin(NO_SERVICE))
    closed = folios.where((F.col("type") == FOLIO_TYPE) & (F.col("status") == FOLIO_STATUS)).select("folio_id", "reservation_id")
    net = (live.join(closed, "folio_id").join(alw, ["folio_id", "charge_id"], "left")
           .withColumn("net", F.col("amount").cast("decimal(18,4)") - F.coalesce("allowed", F.lit(0))))
    cls = F.coalesce(*[F.when(F.col("service_type") == k, F.lit(v)) for k, v in SERVICE_CLASSES.items()])
    return net.withColumn("cls", cls).groupBy("reservation_id").agg(
        *[money_sum(F.when(F.col("cls") == c, F.col("net"))).cast("decimal(18,4)").alias(f"revenue_{c}") for c in ("room", "fnb", "extra")],
        money_sum("net").cast("decimal(18,4)").alias("revenue_total"))
