"""Reservations and stays (R1-R13): code maps, revenue from folio charges,
event folding, exclusion reasons, import sets and preference tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, first_reason, literal_map, money_sum

# =============================================================================
# Fixed values (must equal the reference's maps for equal results).
# =============================================================================

#: Market segment spellings -> segment code.  The later of the two script
#: versions is used (``Account`` -> ``OTHERS``), see SURVEY §8 Q2.
MARKET_SEGMENT_MAP = {
    "Individual": "INDIVIDUAL", "Agent/FIT": "FIT", "CORP/BUS Indiv": "LCR", "Other": "OTHERS",
    "OTHER": "OTHERS", "Leisure GRP": "LEISUREGR", "MICE/BUS Grp": "MICEGR", "Account": "OTHERS",
    "TIME": "TIME", "Sport": "SPORTSGR", "SPORTGR": "SPORTSGR", "Appartment": "OTHERS",
    "Leisure Indiv": "INDIVIDUAL",
}
#: Travel purpose: kept values; listed values without a purpose become NULL;
#: everything else (NULL included, SURVEY §8 Q3) becomes ``Other``.
TRAVEL_PURPOSE_KEEP = {"Business": "Business", "Leisure": "Leisure", "Repeater": "Leisure"}
TRAVEL_PURPOSE_NULL = [
    "Account", "IT CENTRAL Reservation", "IT CENTRAL Group", "HR CENTRAL Reservation", "HR CENTRAL Group",
    "FMTG", "Concierge", "Recommendation", "Other", "Bonus Card direct/FMTG Website",
    "Bonus Card Agency/Internet", "Search Engine/Internet", "PR/Advertisment", "Catalogue",
    "Promotion/CO-Marketing", "TrustForce",
]
#: Target picklist labels.
MARKET_SEGMENT_LABELS = {
    "INDIVIDUAL": "Individual", "OTA": "Online Travel Agency", "FIT": "Free Independent Traveler",
    "LEISUREGR": "Leisure Group", "SPORTSGR": "Sports Group", "MICEGR": "MICE Group", "HOUSE": "House Use",
    "LCR": "Long-term Contractor Rate", "OTHERS": "Others",
}
RESERVATION_STATUS_LABELS = {
    "CONFIRMED": "Confirmed", "INHOUSE": "InHouse", "CHECKEDOUT": "CheckedOut", "CANCELED": "Canceled",
    "CANCELLED": "Canceled", "NOSHOW": "NoShow", "NO_SHOW": "NoShow",
}


def normalise_segment(c, mapping: Mapping[str, str] = MARKET_SEGMENT_MAP) -> Column:
    """Market segment spelling to code; unknown values are kept."""
    c = col(c)
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c)


def normalise_purpose(c, null_as_other: bool = True) -> Column:
    """Travel purpose clean-up (N21).  Not idempotent: ``Other`` -> NULL on a
    second run (SURVEY §8 Q5); run once."""
    c = col(c)
    out = F.when(c.isin(list(TRAVEL_PURPOSE_KEEP)), F.try_element_at(literal_map(TRAVEL_PURPOSE_KEEP), c)) \
        .when(c.isin(TRAVEL_PURPOSE_NULL), F.lit(None).cast("string"))
    if null_as_other:
        return out.otherwise(F.lit("Other"))
    return out.when(c.isNotNull(), F.lit("Other"))


def normalise_reservation(df: DataFrame, as_of: str) -> DataFrame:
    """Reservation clean-up (N21, M1), step by step as the scripts run it:
    market segment and travel purpose maps; the ``Canceled`` spelling of one
    source; status from event timestamps (cancelled, then no-show); and
    ``CheckedOut`` for past stays of the other source that carry no status
    and no event.  The ``<>`` tests skip NULL statuses, as in SQL (SURVEY §8
    Q4)."""
    from .change import update_where
    st = F.col("reservation_status")
    df = df.withColumns({"market_segment": normalise_segment("market_segment"),
                         "travel_purpose": normalise_purpose("travel_purpose")})
    df = update_where(df, (F.col("source") == "apaleo") & (st == "Canceled"), {"reservation_status": F.lit("Cancelled")})
    df = update_where(df, (st != "Cancelled") & F.col("cancelled_at").isNotNull(), {"reservation_status": F.lit("Cancelled")})
    df = update_where(df, (st != "NoShow") & F.col("noshow_at").isNotNull(), {"reservation_status": F.lit("NoShow")})
    past = (st.isNull() & F.col("checkout_at").isNull() & F.col("noshow_at").isNull() & F.col("cancelled_at").isNull()
            & (F.col("source") == "protel") & (F.col("departure_at") < F.to_timestamp_ntz(F.lit(as_of))))
    return update_where(df, past, {"reservation_status": F.lit("CheckedOut")})


def folio_revenue(charges: DataFrame, allowances: DataFrame, charge_keys: Sequence[str], res_key: str,
                  cls: Column, amount: str = "amount",
                  classes: Mapping[str, str] | None = None, total: str = "revenue_total") -> DataFrame:
    """Revenue per reservation from charges net of allowances, by service
    class (R2, G5, G16).

    Allowances are aggregated to the charge key *before* the join (one charge
    may carry several allowances, so joining raw rows would fan out); then one
    aggregation per reservation with a conditional sum per class.  A class
    without charges stays NULL (``SUM(CASE .. END)`` without ELSE); the total
    is never NULL.  Money is summed as ``decimal(18,4)``."""
    classes = classes or {"room": "revenue_room", "fnb": "revenue_fnb", "extra": "revenue_extra"}
    alw = allowances.groupBy(*charge_keys).agg(money_sum(amount).alias("__alw"))
    net = (charges.join(alw, list(charge_keys), "left")
           .withColumn("__net", F.col(amount).cast("decimal(18,4)") - F.coalesce("__alw", F.lit(0)))
           .withColumn("__cls", cls))
    aggs = [money_sum(F.when(F.col("__cls") == k, F.col("__net"))).cast("decimal(18,4)").alias(v)
            for k, v in classes.items()]
    aggs.append(money_sum("__net").cast("decimal(18,4)").alias(total))
    return net.groupBy(res_key).agg(*aggs)


def fold_events(df: DataFrame, events: DataFrame, key: str | Sequence[str], cols: Mapping[str, tuple[str, str]],
                prefer: str = "event") -> DataFrame:
    """Fold lifecycle events into rows.

    ``cols`` maps a target column to ``(event column, 'min' | 'max')``: several
    events per key reduce to the earliest/latest first (partial aggregation),
    then a left join fills the row.  ``prefer='event'`` lets the event value win,
    ``prefer='existing'`` only fills gaps (the two script versions, §8 Q13);
    ``prefer='both'`` gives the event's precedence, and the other one in ``<column>_existing_first``."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [getattr(F, how)(F.col(ev)).alias(f"__ev_{tgt}") for tgt, (ev, how) in cols.items()]
    ev = events.groupBy(*keys).agg(*aggs)
    j = df.join(ev, keys, "left")
    for tgt in cols:
        e = F.col(f"__ev_{tgt}")
        if prefer == "both":
            j = j.withColumn(f"{tgt}_existing_first", F.coalesce(F.col(tgt), e))
        j = j.withColumn(tgt, F.coalesce(F.col(tgt), e) if prefer == "existing" else F.coalesce(e, F.col(tgt)))
    return j.drop(*[f"__ev_{t}" for t in cols])


def exclude(df: DataFrame, rules: Sequence[tuple[str, Column]], flag_col: str = "excluded",
            reason_col: str = "exclude_reason") -> DataFrame:
    """Exclusion with ordered reasons (R8): an existing reason is kept, else the
    first matching rule's reason is set and the flag with it.  A row that no rule
    fits keeps the flag it has, with or without a reason."""
    reason = F.coalesce(F.col(reason_col), first_reason(rules)) if reason_col in df.columns else first_reason(rules)
    had = F.coalesce(F.col(flag_col).cast("int"), F.lit(0)) if flag_col in df.columns else F.lit(0)
    return df.withColumn(reason_col, reason).withColumn(flag_col, F.when(F.col(reason_col).isNotNull(), 1).otherwise(had))


def preference_tags(df: DataFrame, key: str, rules: Sequence[tuple[str, str, str, Column]],
                    source: str) -> DataFrame:
    """Preference tags from reservation facts.

    The reference scans the table once per rule; here every row builds the
    array of the tags it earns in one pass, ``explode`` flattens it and
    ``distinct`` removes repeats per key."""
    tags = F.array(*[F.when(cond, F.struct(F.lit(name).alias("preference_name"),
                                           F.lit(cat).alias("preference_category"),
                                           F.lit(ext).alias("external_id")))
                     for name, cat, ext, cond in rules])
    out = df.select(F.col(key), F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t"))
    return out.select(key, "t.*", F.lit(source).alias("source_system")).distinct()


def child_counts(df: DataFrame, children: DataFrame, key: str, out: str = "children_num") -> DataFrame:
    """Children per reservation from a child table, missing = 0 (R13: G16 + J4)."""
    c = children.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(c, key, "left").withColumn(out, F.coalesce("__n", F.lit(0)).cast("bigint")).drop("__n")


#: Status codes of stays that did not happen, and the room type of no room.
NO_STAY_STATUS, NO_ROOM_TYPE = [3, -1], 4


def room_nights(status, is_room_category, room_no, account, sharer, room_type, nights) -> Column:
    """Conditional room nights (K5): the booked nights (NULL: 0) of a stay that
    happened, in a category of rooms, with a room number above 0, charged to the
    sharer's own account (or without a sharer), and not of the excluded room type.
    A NULL in any other test counts as failed, as in ``CASE WHEN``."""
    ok = (~col(status).isin(NO_STAY_STATUS) & (col(is_room_category) == 1) & (col(room_no) > 0)
          & ((col(account) == col(sharer)) | col(sharer).isNull()) & ~col(room_type).isin(NO_ROOM_TYPE))
    return F.when(ok, F.coalesce(col(nights), F.lit(0))).otherwise(F.lit(0))


#: Statuses and segments of the import sets.
HISTORY_STATUS = ["CheckedOut"]
FUTURE_STATUS = ["Confirmed", "InHouse", "Optional"]
UNMATCHED_NOT_STATUS = ["CheckedOut", "Cancelled"]
UNMATCHED_SEGMENTS = ["INDIVIDUAL", "OTA"]


def import_sets(df: DataFrame, persons: DataFrame, key: str, cluster: str, since: str, arrival_after: str,
                not_emails: Sequence[str] = ()) -> DataFrame:
    """Import sets of reservations (R10): ``key, import_set``, a row per set.

    * ``history``: checked out, with target contact and property, neither the stay nor the person an investor's;
    * ``future``: confirmed, in house or optional, otherwise the same;
    * ``future_unmatched``: without target contact, with property, booking and an address not in
      ``not_emails``, of the listed segments, not checked out or cancelled, no investor, arriving after
      ``arrival_after``, and in neither of the sets above;
    * ``changed_since``: not excluded and updated at or after ``since``.

    A reservation is joined to ``persons`` (``cluster``, ``is_investor``), one row per cluster, once; the first
    two sets need a match.  A test on NULL fails, as in ``WHERE``."""
    p = persons.groupBy(cluster).agg(F.min("is_investor").alias("__inv"))  # one row that is no investor's is enough
    j = df.join(p, cluster, "left")
    st = F.col("reservation_status")
    has_contact, has_property = F.col("sf_person_contact_id").isNotNull(), F.col("sf_property_id").isNotNull()
    known = has_contact & has_property & (F.col("is_investor") == 0) & (F.col("__inv") == 0)
    history, future = known & st.isin(HISTORY_STATUS), known & st.isin(FUTURE_STATUS)
    address = F.col("email").isNotNull()
    if not_emails:
        address = address & ~F.col("email").isin(list(not_emails))
    unmatched = (~st.isin(UNMATCHED_NOT_STATUS) & F.col("market_segment").isin(UNMATCHED_SEGMENTS) & address & has_property
                 & ~has_contact & (F.col("is_investor") == 0) & F.col("booking_id").isNotNull()
                 & (F.col("arrival_at") > F.to_timestamp_ntz(F.lit(arrival_after))))
    since_ = (F.col("last_updated_at") >= F.to_timestamp_ntz(F.lit(since))) & (F.col("_excluded") == 0)
    sets = F.array(*[F.when(c, F.lit(n)) for n, c in
                     (("history", history), ("future", future), ("future_unmatched", unmatched), ("changed_since", since_))])
    return j.select(key, F.explode(F.filter(sets, lambda x: x.isNotNull())).alias("import_set"))


#: Raw reservation field -> standard reservation column.
RAW_RESERVATION_FIELDS = {
    "id": "reservation_id", "property__id": "property_id", "booking_id": "booking_id",
    "status": "reservation_status", "arrival": "arrival_at", "departure": "departure_at", "created": "booking_at",
    "check_in_time": "checkin_at", "check_out_time": "checkout_at", "cancellation_time": "cancelled_at",
    "no_show_time": "noshow_at", "market_segment__code": "market_segment", "channel_code": "market_channel",
    "rate_plan__code": "rate_plan_code", "adults": "adults_num", "children": "children_num",
    "unit_group__code": "unit_group_code", "travel_purpose": "travel_purpose", "external_code": "external_code",
    "primary_guest__first_name": "first_name", "primary_guest__middle_initial": "middle_name",
    "primary_guest__last_name": "last_name", "primary_guest__email": "email", "primary_guest__title": "salutation",
    "primary_guest__gender": "gender", "primary_guest__preferred_language": "preferred_language",
    "primary_guest__address__address_line1": "address", "primary_guest__address__city": "city",
    "primary_guest__address__postal_code": "postal_code", "primary_guest__address__country_code": "country",
    "primary_guest__phone": "phone", "primary_guest__birth_place": "birth_place",
    "primary_guest__nationality_country_code": "nationality",
}


def standardise_reservations(raw: DataFrame, companies: DataFrame, source: str,
                             properties: Sequence[str] | None = None, unit_type: str = "BedRoom") -> DataFrame:
    """Reservations from a raw PMS extract in the standard shape.

    Only rows of the room unit type (and of the listed properties, when given)
    are taken; the booker company code comes from a left join; the group label
    joins booking id and group name; nights are calendar days, 0 unless the
    departure is after the arrival.  Raw fields that the extract lacks become
    typed NULLs, and the target-only columns start as NULL."""
    from ..functions.columns import nights
    df = raw.where(F.col("unit_group__type") == unit_type)
    if properties is not None:
        df = df.where(F.col("property__id").isin(list(properties)))
    com = companies.select(F.col("id").alias("__cid"), F.col("code").alias("booker_company_id"))
    df = df.join(com, df["company__id"] == com["__cid"], "left")
    present = set(raw.columns)
    cols = [(F.col(r) if r in present else F.lit(None).cast("string")).alias(s)
            for r, s in RAW_RESERVATION_FIELDS.items()]
    out = df.select(*cols, "booker_company_id",
                    F.when(F.col("group_name").isNotNull(),
                           F.concat(F.col("booking_id"), F.lit(" | "), F.col("group_name"))).alias("group_name"),
                    (F.to_date("primary_guest__birth_date") if "primary_guest__birth_date" in present
                     else F.lit(None).cast("date")).alias("birth_date"))
    return out.select(
        "*", F.lit("reservation").alias("_ptable"), F.lit(source).alias("source"), F.lit("PRIMARY").alias("guest_role"),
        nights("arrival_at", "departure_at").cast("long").alias("room_nights"),
        *[F.lit(None).cast(t).alias(c) for c, t in [
            ("row_id", "long"), ("cluster_id", "long"), ("property_code", "string"), ("property_pms_id", "long"),
            ("revenue_room", "decimal(18,4)"), ("revenue_fnb", "decimal(18,4)"), ("revenue_extra", "decimal(18,4)"),
            ("revenue_total", "decimal(18,4)"), ("sf_property_id", "string"), ("_entity_id", "long"), ("_excluded", "int"),
            ("sf_preferred_language", "string"), ("sf_reservation_status", "string"), ("sf_person_contact_id", "string"),
            ("sf_person_account_id", "string")]])


def attach_property(df: DataFrame, props: DataFrame, key: str = "property_id", code_col: str = "code",
                    sets: dict | None = None, active_col: str = "is_active") -> DataFrame:
    """Property attributes and target property id from the property table
    (R5): a keyed update from active properties only (M2).  The property table
    is a dimension (one row per property) and is reduced to one row per code."""
    from .change import update_from
    sets = sets or {"property_code": "group_code", "property_pms_id": "pms_id",
                    "sf_property_id": "target_id"}
    p = props.withColumnRenamed(code_col, key)
    return update_from(df, p, [key], {t: F.col("src_" + s).cast(df.schema[t].dataType) for t, s in sets.items()},
                       where=F.coalesce(F.col("src_" + active_col), F.lit(False)))


def target_property_ids(df: DataFrame, attributes: DataFrame, targets: DataFrame) -> DataFrame:
    """The target property id by two hops or one (R5), by source.

    ``df``: source, property_pms_id, property_id, sf_property_id; ``attributes``: pms_id, code; ``targets``: code, sf_id.
    Rows of the history system go from the system's id over the property's code to the target id, where they have
    none yet; rows of the reservation system, whose property id is the code, get theirs anew.  Rows without a match keep what they
    have.  Both dimensions are reduced to one row per key (least code, least id) before the joins."""
    ids = targets.groupBy("code").agg(F.min("sf_id").alias("__id"))
    by_pms = (attributes.where(F.col("pms_id").isNotNull()).join(ids, "code").groupBy(F.col("pms_id").alias("__pms"))
              .agg(F.min("__id").alias("__two")))
    ids = ids.select(F.col("code").alias("__code"), F.col("__id").alias("__one"))
    j = df.join(by_pms, df["property_pms_id"] == by_pms["__pms"], "left").join(ids, df["property_id"] == ids["__code"], "left")
    new = (F.when(F.col("source") == "protel", F.coalesce("sf_property_id", "__two"))
           .when(F.col("source") == "apaleo", F.coalesce("__one", "sf_property_id")).otherwise(F.col("sf_property_id")))
    return j.withColumn("sf_property_id", new).select(df.columns)


#: Ends of the relay addresses that booking channels give.
RELAY_ENDS = ["booking.com", "m.expediapartnercentral.com", "hrs.de"]


def recover_email(df: DataFrame, raw: DataFrame, keys: str | Sequence[str], email: str,
                  relay_ends: Sequence[str] = RELAY_ENDS) -> DataFrame:
    """Give rows without an address the relay address of the raw copy back.

    Only a NULL address is filled, and only from a raw address that ends like one
    of ``relay_ends`` (any letter case).  Of several raw rows of a key the one whose
    address fits the earliest end counts, then the least address."""
    from .change import update_from
    keys = [keys] if isinstance(keys, str) else list(keys)
    low = F.lower(F.col("__raw_email"))
    rank = F.coalesce(*[F.when(low.endswith(e.lower()), F.lit(k)) for k, e in enumerate(relay_ends)])
    r = raw.select(*keys, F.col(email).alias("__raw_email")).where(rank.isNotNull())
    return update_from(df, r, keys, {email: "src___raw_email"}, where=F.col(email).isNull(), order=[rank, F.col("__raw_email")])


#: Rate plans of apartment owners (not guest stays).
OWNER_RATE_PLANS = ["OWN", "APP", "APPET"]


def exclude_reservations(df: DataFrame, overlap_col: str = "_overlapped", flag: str = "_excluded",
                         reason: str = "exclude_reason") -> DataFrame:
    """The exclusion statements of the deliveries (R8), one after the other, on the
    standard reservation columns (``flag`` 0/1; each statement sees what the ones before did).

    ``overlap_col`` is the migration-overlap flag from ``flag_in_window`` (R9).  A missing property
    excludes existing target reservations in any case, and at the end every row that has
    no reason yet; an optional status that was excluded earlier is given back to existing ones."""
    from .change import update_where
    f, r, st = F.col(flag), F.col(reason), F.col("reservation_status")
    new_res, old_res = F.col("sf_reservation_id").isNull(), F.col("sf_reservation_id").isNotNull()
    no_property = F.col("sf_property_id").isNull()
    cancelled = st.isin("Cancelled", "NoShow") & new_res
    out = lambda why: {flag: F.lit(1), reason: F.lit(why)}
    for cond, sets in [
        ((F.col("source") == "protel") & F.col("property_code").isNull(), {flag: F.lit(1)}),
        (F.col("rate_plan_code").isin(OWNER_RATE_PLANS) & (f == 0), out("apartment owner")),
        ((st == "Optional") & new_res, out("optional status")),
        ((st == "Optional") & (f == 1) & old_res, {flag: F.lit(0), reason: F.lit(None).cast("string")}),
        (no_property & old_res, out("inactive property")),
        ((F.col("source") == "protel") & (f == 0) & F.col(overlap_col).cast("boolean"), out("overlapped")),
        (cancelled & r.isNull(), out("cancelled")),
        (cancelled & (f == 0), {flag: F.lit(1)}),
        (no_property & r.isNull(), out("inactive property")),
    ]:
        df = update_where(df, cond, sets)
    return df


#: Property and unit-group codes of the preference rules.
CAMPSITE_PROPERTIES = ["FCZ", "FGP"]
APARTMENT_PROPERTY = "FEW"
MOUNTAIN_PROPERTY = "FEW"
CAR_PROPERTY = "FCZ"
SUITE_PROPERTY = "FSV"
SUITE_UNIT_GROUPS = ["J3C", "J3D", "S3C", "J3E", "S3E", "S2D", "P4C", "P2D", "P4D"]


def reservation_preference_rules() -> list[tuple[str, str, str, Column]]:
    """The seven preference rules of the reservation view (R12) as
    ``(name, category, external id, condition)`` for :func:`preference_tags`.
    Rules 3 and 4 are identical except for their id, as in the original; the
    misspelt category of rule 7 is written correctly (SURVEY §8 Q15)."""
    prop, kids, unit = F.col("property_id"), F.col("children_num"), F.col("unit_group_code")
    return [
        ("Campsite Booker", "Camping", "PREF001", prop.isin(CAMPSITE_PROPERTIES)),
        ("Apartment", "Room Category Booker", "PREF002", prop == APARTMENT_PROPERTY),
        ("Booker with Children", "Family", "PREF003", kids > 0),
        ("Booker with Children", "Family", "PREF004", kids > 0),
        ("Mountain", "Destination", "PREF005", prop == MOUNTAIN_PROPERTY),
        ("Car", "Travel Preference", "PREF006", prop == CAR_PROPERTY),
        ("Suite", "Room Category Booker", "PREF007", (prop == SUITE_PROPERTY) & unit.isin(SUITE_UNIT_GROUPS)),
    ]
