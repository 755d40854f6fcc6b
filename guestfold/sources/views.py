"""Views and parameterised table functions that SQL users call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The reservation view's columns that are taken over, each with the raw column that it comes from.
RESERVATION_COLUMNS = dict(line.split() for line in """
reservation_id id
booking_id booking_id
reservation_status status
group_name group_name
arrival_at arrival
departure_at departure
booking_at created
checkin_at check_in_time
checkout_at check_out_time
is_pre_checkedin is_pre_checked_in
cancelled_at cancellation_time
noshow_at no_show_time
market_segment market_segment__code
market_channel channel_code
rate_plan_code rate_plan__code
unit_group_code unit_group__code
travel_purpose travel_purpose
pg_gender primary_guest__gender
pg_preferred_language primary_guest__preferred_language
pg_birth_date primary_guest__birth_date
pg_birth_place primary_guest__birth_place
pg_title primary_guest__title
pg_nationality_country_code primary_guest__nationality_country_code
pg_id_number primary_guest__identification_number
pg_id_issue_date primary_guest__identification_issue_date
pg_expiry_date primary_guest__identification_expiry_date
pg_type primary_guest__identification_type
pg_first_name primary_guest__first_name
pg_middle_name primary_guest__middle_initial
pg_last_name primary_guest__last_name
pg_email primary_guest__email
pg_phone primary_guest__phone
pg_mailing_street primary_guest__address__address_line1
pg_mailing_postal_code primary_guest__address__postal_code
pg_mailing_city primary_guest__address__city
pg_mailing_country_code primary_guest__address__country_code
external_code external_code
""".strip().splitlines())
#: Sizes of the guest clusters whose reservations the view shows.
CLUSTER_BANDS = ((1, 3), (10, 50))


def reservation_view(reservations: DataFrame, properties: DataFrame, children: DataFrame, clusters: DataFrame,
                     bands: Sequence[tuple[int, int]] = CLUSTER_BANDS) -> DataFrame:
    """Reservations of switched properties and of guest clusters of the stated sizes, under standard names.

    ``reservations``: the raw columns of :data:`RESERVATION_COLUMNS` (those that the input lacks are NULL text), row_id, property__id
    and adults; ``properties``: code, own_id, switch_from; ``children``: parent_id, a row per child; ``clusters``:
    reservation_id, cluster_id.  A reservation shows when its property has a switch date and it was created since, once
    per cluster of a fitting size that it is in.  Children are counted before the join; cluster sizes are a
    partial aggregate joined back.  Filters on the view's columns reach the reservations' scan."""
    have = {c.lower() for c in reservations.columns}
    raw = lambda c: F.col(f"r.{c}") if c in have else F.lit(None).cast("string")
    sizes = clusters.where(F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    fits = F.lit(False)
    for lo, hi in bands:
        fits = fits | F.col("n").between(lo, hi)
    shown = clusters.join(sizes.where(fits).select("cluster_id"), "cluster_id").select(F.col("reservation_id").alias("c_id"), "cluster_id")
    kids = children.groupBy(F.col("parent_id").alias("k_id")).agg(F.count(F.lit(1)).alias("n_children"))
    switched = properties.where(F.col("switch_from").isNotNull()).select("code", "own_id", "switch_from")
    j = (reservations.alias("r").join(switched, (F.col("r.property__id") == F.col("code")) & (F.col("r.created") >= F.col("switch_from")))
         .join(shown, F.col("r.id") == F.col("c_id")).join(kids, F.col("r.row_id") == F.col("k_id"), "left"))
    empty = {"revenue_room_net_eur": "decimal(18,4)", "revenue_total_net_eur": "decimal(18,4)", "room_nights": "bigint", "bed_nights": "bigint"}
    return j.select(
        F.col("code").alias("property_id"), F.col("own_id").alias("property_own_id"), *[raw(v).alias(k) for k, v in RESERVATION_COLUMNS.items()],
        *[F.lit(None).cast(t).alias(c) for c, t in empty.items()],
        F.substring(F.trim(raw("primary_guest__address__country_code")), 1, 2).alias("mk_country"),
        F.coalesce(F.col("r.adults"), F.lit(0)).cast("int").alias("adults_num"), F.coalesce("n_children", F.lit(0)).cast("int").alias("children_num"),
        F.lit("apaleo").alias("pms_name"), F.lit("PRIMARY").alias("guest_role"), "cluster_id")


def register_views(spark: SparkSession, **views: DataFrame) -> None:
    """Register frames as session views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_day_kpis(spark: SparkSession, parts: Mapping[str, DataFrame], name: str = "day_kpis") -> None:
    """The one-day KPI procedure as an SQL table function ``name(p_date)`` (K3) over the systems' occupancy: kpi, value,
    rev_date, source_system, pms_id, name.  The argument reaches the scans of the occupancy's inputs."""
    from ..operators.hotel import occupancy
    occupancy(parts).createOrReplaceTempView(f"{name}_occupancy")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_date DATE)
RETURNS TABLE (kpi STRING, value BIGINT, rev_date DATE, source_system STRING, pms_id BIGINT, name STRING)
RETURN SELECT concat(property_id, x.k), x.v, day, source, CAST(pms_id AS BIGINT), name FROM (
  SELECT *, explode(array(named_struct('k', '_ROOMNIGHT1', 'v', room_nights), named_struct('k', '_BEDNIGHT1', 'v', bed_nights),
    named_struct('k', '_OPEN1', 'v', CAST(if(room_nights + bed_nights > 0, 1, 0) AS BIGINT)))) AS x
  FROM {name}_occupancy WHERE day = p_date)""")
