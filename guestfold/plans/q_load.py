"""Driver queries for target records and their selections (B2, B3), the citizenship list (N8) and rules
that no other query runs (N21, J20, P13, C1, D19, D21, R6, K12, R12, J13, P11, F11, S9, S13, D6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as N
from ..functions import columns as X
from ..operators import change as C
from ..operators import consent as CS
from ..operators import fieldmaps as M
from ..operators import identity as I
from ..operators import joins as J
from ..operators import stays as S
from ..sources import files as IO
from .registry import register
from .tables import AS_OF_ORDERS, dirty, oracle_with, table

NOW, TODAY = "2024-01-15T08:30:00Z", "2024-01-15T00:00:00Z"

CONTACT_SQL = """SELECT c_custkey AS cluster_id, 'crm' AS source, CASE WHEN c_custkey % 4 = 0 THEN 'Active' END AS investor_status,
  CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP_NTZ '2030-06-01 12:30:00' END AS investor_expiration_date,
  fname AS clean_first_name, lname AS clean_last_name, salutation, lower(trim(email)) AS clean_email, cell_phone AS phone,
  CASE WHEN c_custkey % 3 = 0 THEN DATE '1980-02-29' END AS birth_date, country, language_code AS language FROM {dirty}"""


@register("load_contact", oracle_with("dirty") + """
SELECT c_custkey AS "ClusterID__c", 'rt1' AS "RecordTypeId", c_custkey AS "ClusterID__pc", 'crm' AS "SourceSystem__c",
  CASE WHEN c_custkey % 4 = 0 THEN 'Active' END AS "InvestmentStatus__pc",
  CASE WHEN c_custkey % 4 = 0 THEN '2030-06-01T12:30:00Z' END AS "InvestmentExpirationDate__pc",
  fname AS "FirstName", lname AS "LastName", salutation AS "Salutation", lower(trim(email)) AS "PersonEmail", cell_phone AS "PersonMobilePhone",
  CASE WHEN c_custkey % 3 = 0 THEN '1980-02-29T00:00:00Z' END AS "Birthdate", CAST(NULL AS VARCHAR) AS "PersonGenderIdentity",
  CAST(NULL AS VARCHAR) AS "BillingStreet", CAST(NULL AS VARCHAR) AS "BillingCity", CAST(NULL AS VARCHAR) AS "BillingPostalCode",
  country AS "BillingCountryCode__c", cell_phone AS "Phone", CAST(NULL AS VARCHAR) AS "BirthPlace__pc",
  CAST(NULL AS VARCHAR) AS "NationalityCountryCode__pc", language_code AS "PreferredLanguage__pc", 'crm' AS "SourceSystem__pc" FROM dirty""")
def load_contact(spark, sf):
    return M.target_records(spark.sql(CONTACT_SQL, dirty=dirty(spark, sf)), "contact", {"record_type": "rt1"})


@register("load_contact_update", oracle_with("dirty") + """
SELECT concat('001', c_custkey) AS "Id", CAST(NULL AS VARCHAR) AS "ExternalID__pc", 'crm' AS "SourceSystem__pc",
  CASE WHEN c_custkey % 3 = 0 THEN '1980-02-29' END AS "PersonBirthdate",
  CASE c_custkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS "InvestCustomer__pc", CAST(NULL AS VARCHAR) AS "InvestmentStatus__pc",
  CAST(NULL AS VARCHAR) AS "InvestmentExpirationDate__pc" FROM dirty""")
def load_contact_update(spark, sf):
    d = spark.sql(CONTACT_SQL, dirty=dirty(spark, sf)).select(
        "source", "birth_date", F.concat(F.lit("001"), "cluster_id").alias("sf_account_id"),
        F.when(F.col("cluster_id") % 3 == 0, 0).when(F.col("cluster_id") % 3 == 1, 1).alias("invest_customer"))
    return M.target_records(d, "contact_update")


RESERVATION_SQL = """SELECT CAST(o_orderkey AS STRING) AS reservation_id, concat('b', o_custkey) AS booking_id,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Cancelled' ELSE 'Confirmed' END AS reservation_status, 'web' AS source, o_custkey AS cluster_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 0 END AS central_consent, o_orderdate AS arrival_at,
  o_orderdate AS departure_at, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 3 END AS room_nights,
  concat('g', o_custkey, '@example.org') AS email, CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS is_email_invalid,
  CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN repeat('Long', 12) ELSE 'Wien' END AS city,
  CASE WHEN o_orderkey % 9 = 0 THEN 'sf1' END AS sf_reservation_id, CAST(o_orderkey % 2 AS INT) AS _excluded FROM {orders}"""


@register("load_reservation", """
WITH r AS (SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS d FROM orders
  WHERE o_orderkey % 4 <> 0 AND o_orderkey % 9 <> 0 AND o_orderkey % 2 = 0 AND o_orderdate >= TIMESTAMP '1996-01-01')
SELECT CAST(o_orderkey AS VARCHAR) AS "ReservationID__c", concat('b', o_custkey) AS "BookingID__c", 'Confirmed' AS "ReservationStatus__c",
  '' AS "MarketSegmentCode__c", 'web' AS "SourceSystem__c", CAST(o_custkey AS VARCHAR) AS "ClusterID__c",
  CASE WHEN o_orderkey % 3 = 0 THEN 'True' ELSE 'False' END AS "ConsentCentral__c", 'True' AS "ConsentProperty__c", 'True' AS "LoyaltyPointsAwarded__c",
  '' AS "BookingDate__c", d AS "Arrival__c", d AS "Departure__c", CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '3' END AS "RoomNights__c",
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat('g', o_custkey, '@example.org') END AS "ProfileEmail__c",
  concat('g', o_custkey, '@example.org') AS "ProfileEmailRaw__c",
  CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'LongLongLongLongLongLongLongLongLongLong' ELSE 'Wien' END AS "ProfileMailingCity__c",
  49 AS n_fields FROM r""")
def load_reservation(spark, sf):
    """The open reservations' records; of the 49 fields those with a value of their own, and the number of fields."""
    r = M.open_reservations(spark.sql(RESERVATION_SQL, orders=table(spark, sf, "orders")), "1996-01-01")
    out = M.target_records(r, "reservation")
    return out.select("ReservationID__c", "BookingID__c", "ReservationStatus__c", "MarketSegmentCode__c", "SourceSystem__c", "ClusterID__c",
                      "ConsentCentral__c", "ConsentProperty__c", "LoyaltyPointsAwarded__c", "BookingDate__c", "Arrival__c", "Departure__c",
                      "RoomNights__c", "ProfileEmail__c", "ProfileEmailRaw__c", "ProfileMailingCity__c", F.lit(len(out.columns)).alias("n_fields"))


@register("load_member", oracle_with("dirty") + """
SELECT concat('M', c_custkey) AS "MembershipNumber", member_id AS "LegacyMemberId__c", c_mktsegment AS "LegacyTier__c", enrollment_date
FROM (SELECT c.c_custkey, d.member_id, c.c_mktsegment, DATE '2026-01-01' AS enrollment_date FROM customer c JOIN dirty d USING (c_custkey)
      JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') o ON o.o_custkey = c.c_custkey WHERE c.c_custkey % 2 = 0)""")
def load_member(spark, sf):
    acc = table(spark, sf, "customer").join(dirty(spark, sf).select("c_custkey", "member_id"), "c_custkey").select(
        "c_custkey", F.concat(F.lit("M"), "c_custkey").alias("member_number_new"), F.col("member_id").alias("legacy_member_number"),
        F.col("c_mktsegment").alias("member_tier"), (1 - F.col("c_custkey") % 2).alias("has_active_loyalty"))
    ids = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("account")).distinct()
    sel = M.loyal_accounts(acc, ids, "c_custkey", "account", "2026-01-01")
    return sel.select(*[M._field(*f, set(sel.columns), {}) for f in M.FIELD_MAPS["member"]], "enrollment_date")


@register("load_member_update", """SELECT concat('lm', c_custkey) AS "Id", c_mktsegment AS "LegacyTier__c",
  CAST(c_custkey AS VARCHAR) AS "LegacyMemberId__c" FROM customer""")
def load_member_update(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("lm"), "c_custkey").alias("sf_loyalty_member_id"),
                                            F.col("c_mktsegment").alias("loyalty_legacy_tier"), F.col("c_custkey").cast("string").alias("loyalty_legacy_number"))
    return M.target_records(c, "member_update")


@register("load_consent", f"""SELECT 'central' AS "Name", concat('cp', c_custkey) AS "ContactPointId", '{TODAY}' AS "CaptureDate", 'web' AS "CaptureSource",
  'OptIn' AS "PrivacyConsentStatus", CAST(NULL AS VARCHAR) AS "DataUsePurposeId", CAST(NULL AS VARCHAR) AS "Property__c",
  '{TODAY}' AS "EffectiveFrom", 'web' AS "SourceSystem__c" FROM customer""")
def load_consent(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("central").alias("consent_type"), F.concat(F.lit("cp"), "c_custkey").alias("cpe_id"), F.lit("web").alias("source"))
    return M.target_records(c, "consent", {"today": TODAY})


@register("load_optout", f"""SELECT concat('c', c_custkey) AS "Id", 'OptOut' AS "PrivacyConsentStatus", '{TODAY}' AS "EffectiveTo" FROM customer""")
def load_optout(spark, sf):
    return M.target_records(table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("cpc_id")), "optout", {"today": TODAY})


@register("load_journal", f"""SELECT '{NOW}' AS "ActivityDate", 'Pending' AS "Status", concat('lm', c_custkey) AS "MemberId", 'jt' AS "JournalTypeId",
  'js' AS "JournalSubTypeId", 'pr' AS "LoyaltyProgramId", c_nationkey AS "Points__c", 'crm' AS "SourceSystem__c", 'points' AS "Description__c" FROM customer""")
def load_journal(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("lm"), "c_custkey").alias("sf_loyalty_member_id"), F.col("c_nationkey").alias("loyalty_points_balance"))
    return M.target_records(c, "journal", {"now": NOW, "journal_type": "jt", "journal_subtype": "js", "program": "pr", "source_system": "crm", "description": "points"})


@register("load_preference", """SELECT DISTINCT 'Urgent Booker' AS "Name", 'Booking Style' AS "Category__c", o_custkey AS "Contact__c", 'PREF001' AS "ExternalID__c",
  true AS "IsActive__c", 'orders' AS "SourceSystem__c" FROM orders WHERE o_orderpriority = '1-URGENT'""")
def load_preference(spark, sf):
    tags = S.preference_tags(table(spark, sf, "orders"), "o_custkey",
                             [("Urgent Booker", "Booking Style", "PREF001", F.col("o_orderpriority") == "1-URGENT")], "orders")
    return M.target_records(tags.withColumnRenamed("o_custkey", "contact_id"), "preference")


@register("load_property", """SELECT n_nationkey AS "GroupID__c", n_name AS "PropertyCode__c", n_regionkey AS "PmsID__c", 'pms' AS "PMS__c",
  concat('f', n_nationkey) AS "FormID__c" FROM nation WHERE n_regionkey <> 2 AND n_nationkey % 4 <> 0""")
def load_property(spark, sf):
    n = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("group_id"), F.col("n_name").alias("code"), F.col("n_regionkey").alias("pms_id"), F.lit("pms").alias("pms"),
        F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("f"), "n_nationkey")).alias("form_id"),
        F.when(F.col("n_regionkey") != 2, 1).otherwise(0).alias("is_active"))
    return M.target_records(M.active_properties(n), "property")


@register("load_rate_code", """SELECT DISTINCT p_brand AS "RateCode__c", CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS "Name",
  p_name AS "RateCodeCategory__c", CAST(NULL AS VARCHAR) AS "RateType__c", CAST(NULL AS VARCHAR) AS "RateDescription__c" FROM part""")
def load_rate_code(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("rate_code"), F.when(F.col("p_size") % 2 != 0, F.col("p_type")).alias("plan_name"),
                                        F.col("p_name").alias("category"))
    return M.target_records(M.rate_codes(p), "rate_code").distinct()


# ---- rules that no other query runs

@register("normalise_reservations", f"""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'apaleo' ELSE 'protel' END AS source,
  CASE o_orderkey % 5 WHEN 0 THEN 'Canceled' WHEN 1 THEN 'Confirmed' WHEN 2 THEN 'NoShow' WHEN 3 THEN 'Cancelled' END AS st,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate END AS cancelled_at, CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate END AS noshow_at,
  o_orderdate AS departure_at, CASE o_orderkey % 6 WHEN 0 THEN 'Agent/FIT' WHEN 1 THEN 'Account' WHEN 2 THEN 'OTA' END AS seg,
  CASE o_orderkey % 4 WHEN 0 THEN 'Repeater' WHEN 1 THEN 'Concierge' WHEN 2 THEN 'Sightseeing' END AS purpose FROM orders),
a AS (SELECT *, CASE WHEN source = 'apaleo' AND st = 'Canceled' THEN 'Cancelled' ELSE st END AS s1 FROM r),
b AS (SELECT *, CASE WHEN s1 <> 'Cancelled' AND cancelled_at IS NOT NULL THEN 'Cancelled' ELSE s1 END AS s2 FROM a),
c AS (SELECT *, CASE WHEN s2 <> 'NoShow' AND noshow_at IS NOT NULL THEN 'NoShow' ELSE s2 END AS s3 FROM b)
SELECT o_orderkey, CASE WHEN s3 IS NULL AND noshow_at IS NULL AND cancelled_at IS NULL AND source = 'protel'
    AND departure_at < TIMESTAMP '{AS_OF_ORDERS}' THEN 'CheckedOut' ELSE s3 END AS reservation_status,
  CASE seg WHEN 'Agent/FIT' THEN 'FIT' WHEN 'Account' THEN 'OTHERS' ELSE seg END AS market_segment,
  CASE WHEN purpose = 'Repeater' THEN 'Leisure' WHEN purpose = 'Concierge' THEN NULL ELSE 'Other' END AS travel_purpose FROM c""")
def normalise_reservations(spark, sf):
    k = F.col("o_orderkey")
    r = table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 2 == 0, "apaleo").otherwise("protel").alias("source"),
        F.when(k % 5 == 0, "Canceled").when(k % 5 == 1, "Confirmed").when(k % 5 == 2, "NoShow").when(k % 5 == 3, "Cancelled").alias("reservation_status"),
        F.when(k % 7 == 0, F.col("o_orderdate")).alias("cancelled_at"), F.when(k % 11 == 0, F.col("o_orderdate")).alias("noshow_at"),
        F.lit(None).cast("timestamp_ntz").alias("checkout_at"), F.col("o_orderdate").alias("departure_at"),
        F.when(k % 6 == 0, "Agent/FIT").when(k % 6 == 1, "Account").when(k % 6 == 2, "OTA").alias("market_segment"),
        F.when(k % 4 == 0, "Repeater").when(k % 4 == 1, "Concierge").when(k % 4 == 2, "Sightseeing").alias("travel_purpose"))
    return S.normalise_reservation(r, AS_OF_ORDERS).select("o_orderkey", "reservation_status", "market_segment", "travel_purpose")


@register("lookup_strict", "SELECT c_custkey, n_name AS c_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey")
def lookup_strict(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = J.lookup_strict(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), n, "c_nationkey", "n_name")
    return j.select("c_custkey", F.col("n_name").alias("c_nationkey"))


@register("build_consent", """
WITH cpc AS (SELECT concat('cc', c_custkey) AS "Id", concat('cp', c_custkey % 50) AS "ContactPointId",
  CASE WHEN c_custkey % 3 = 0 THEN concat('001', c_custkey) WHEN c_custkey % 3 = 1 THEN concat('00Q', c_custkey) END AS "PartyID__c" FROM customer)
SELECT cpc."Id", cpc."PartyID__c", e."Mail", a."Name",
  CASE WHEN "PartyID__c" LIKE '001%' THEN 'Account' WHEN "PartyID__c" LIKE '00Q%' THEN 'Lead' END AS "PartyType"
FROM cpc LEFT JOIN (SELECT concat('cp', c_custkey) AS cid, concat('m', c_custkey, '@x') AS "Mail" FROM customer WHERE c_custkey % 2 = 0) e
  ON e.cid = cpc."ContactPointId" LEFT JOIN (SELECT concat('001', c_custkey) AS pid, c_name AS "Name" FROM customer) a ON a.pid = cpc."PartyID__c\"""")
def build_consent(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    cpc = c.select(F.concat(F.lit("cc"), k).alias("Id"), F.concat(F.lit("cp"), k % 50).alias("ContactPointId"),
                   F.when(k % 3 == 0, F.concat(F.lit("001"), k)).when(k % 3 == 1, F.concat(F.lit("00Q"), k)).alias("PartyID__c"))
    cpe = c.where(k % 2 == 0).select(F.concat(F.lit("cp"), k).alias("Id"), F.concat(F.lit("m"), k, F.lit("@x")).alias("Mail"))
    acc = c.select(F.concat(F.lit("001"), k).alias("PersonContactId"), F.col("c_name").alias("Name"))
    return CS.build_consent(cpc, cpe, acc).select("Id", "PartyID__c", "Mail", "Name", "PartyType")


@register("citizenship_codes", """
SELECT c_custkey, CASE WHEN c_custkey % 6 = 5 THEN 'AT' WHEN n_regionkey = 3 THEN upper(substr(n_name, 1, 2))
  ELSE n_name END AS citizenship FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def citizenship_codes(spark, sf):
    """Citizenship by a ranked list that Spark derives from the nation table: a name listed twice keeps its first
    code, whatever its letter case; names that the list lacks stay for review; two capital letters pass."""
    n = table(spark, sf, "nation")
    listed = n.where("n_regionkey = 3").select(F.lower("n_name").alias("variant"), F.upper(F.substring("n_name", 1, 2)).alias("code"), F.lit(1).alias("rank"))
    listed = listed.unionByName(listed.select(F.upper("variant").alias("variant"), F.lit("ZZ").alias("code"), F.lit(2).alias("rank")))
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("c_custkey", F.when(F.col("c_custkey") % 6 == 5, "AT").otherwise(F.col("n_name")).alias("citizenship"))
    return N.normalise_citizenship(c, listed)


def _citizenship_sql() -> tuple[list[str], str]:
    """Spellings (all listed ones, in other letter case and with blanks too, and unlisted ones) and the rules in their order as CASE."""
    rules = N.citizenship_rules()
    given = sorted({v for v, _, _ in rules})
    given += [f" {v.swapcase()} " for v in given] + ["ZZ", " ZZ ", "Unlisted", ""]
    whens = []
    for rank in sorted({r for _, _, r in rules}):
        keys = [v for v, _, r in rules if r == rank]
        code = next(c for _, c, r in rules if r == rank)
        then = "trim(x)" if rank == 1 else f"'{code}'" if code else "NULL"
        whens.append("WHEN lower(trim(x)) IN (" + ", ".join(f"'{k.lower()}'" for k in keys) + f") THEN {then}")
    return given, "CASE " + " ".join(whens) + " ELSE x END"


CITIZENSHIPS_GIVEN, CITIZENSHIP_CASE = _citizenship_sql()


@register("citizenship_list", f"""
SELECT c_custkey, {CITIZENSHIP_CASE} AS citizenship FROM (SELECT c_custkey, [{', '.join(f"'{v}'" for v in CITIZENSHIPS_GIVEN)}][CAST(c_custkey % {len(CITIZENSHIPS_GIVEN)} + 1 AS INT)] AS x FROM customer)""")
def citizenship_list(spark, sf):
    """Citizenship by the list of the original statement (N8), on all its spellings."""
    given = F.array(*[F.lit(v) for v in CITIZENSHIPS_GIVEN])
    x = F.element_at(given, (F.col("c_custkey") % len(CITIZENSHIPS_GIVEN) + 1).cast("int"))
    return N.normalise_citizenship(table(spark, sf, "customer").select("c_custkey", x.alias("citizenship")))


PROFILE_SQL = """SELECT c_custkey AS cluster_id, list_id, fname, lname, email, country, language_code, member_id, current_opt_in,
  CASE WHEN lname IS NULL THEN 1 ELSE 0 END AS missing_name, CASE WHEN email IS NULL THEN 1 ELSE 0 END AS exclude_email,
  CASE WHEN c_custkey % 5 = 0 THEN 'gold' END AS member_tier, CASE WHEN c_custkey % 7 = 0 THEN concat('c', c_custkey) END AS sf_contact_id,
  CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS is_investor, CASE WHEN c_custkey % 2 = 0 THEN cell_phone END AS cell_phone,
  CASE WHEN c_custkey % 3 = 0 THEN 'home' END AS home_phone, 'office' AS office_phone FROM {dirty}"""


@register("select_import", oracle_with("dirty") + f"""
, p AS ({PROFILE_SQL.format(dirty='dirty')})
SELECT cluster_id, list_id AS source_id, fname AS clean_first_name, email AS clean_email, country, language_code AS language, member_tier, is_investor,
  'gms' AS source, coalesce(cell_phone, home_phone, office_phone) AS phone, CAST(NULL AS VARCHAR) AS birth_place, 'target' AS list FROM p
WHERE missing_name = 0 AND exclude_email = 0 AND (current_opt_in = 'Yes' OR member_tier IS NOT NULL) AND sf_contact_id IS NULL
UNION ALL
SELECT cluster_id, list_id, fname, email, country, language_code, member_tier, is_investor, 'gms', coalesce(cell_phone, home_phone, office_phone),
  NULL, 'investor' FROM p WHERE missing_name = 0 AND sf_contact_id IS NULL AND is_investor = 1""")
def select_import(spark, sf):
    p = spark.sql(PROFILE_SQL, dirty=dirty(spark, sf))
    both = I.select_import(p).withColumn("list", F.lit("target")).unionByName(I.select_import(p, investors=True).withColumn("list", F.lit("investor")))
    return both.select("cluster_id", "source_id", "clean_first_name", "clean_email", "country", "language", "member_tier", "is_investor", "source", "phone",
                       "birth_place", "list")


@register("member_export", oracle_with("dirty") + f"""
, p AS ({PROFILE_SQL.format(dirty='dirty')})
SELECT cluster_id, fname AS "givenName", lname AS surname, email, concat('M', cluster_id) AS member_number FROM p
WHERE member_tier IS NOT NULL AND sf_contact_id IS NOT NULL""")
def member_export(spark, sf):
    p = spark.sql(PROFILE_SQL, dirty=dirty(spark, sf)).select(
        "cluster_id", "member_tier", "sf_contact_id", F.col("fname").alias("clean_first_name"), F.col("lname").alias("clean_last_name"),
        F.col("email").alias("clean_email"), F.concat(F.lit("M"), "cluster_id").alias("member_number_new"))
    return I.member_export(p)


@register("split_property", """SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 4 AND l_shipmode IN ('1', '3') THEN 100 ELSE l_suppkey % 10 END AS property_pms_id,
  CASE WHEN l_suppkey % 10 = 4 AND l_shipmode IN ('1', '3') THEN 'NEW' ELSE 'OLD' END AS property_id
FROM (SELECT *, CAST(l_linenumber AS VARCHAR) AS l_shipmode FROM lineitem)""")
def split_property(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 10).alias("property_pms_id"),
                                             F.lit("OLD").alias("property_id"), F.col("l_linenumber").cast("string").alias("unit_group_code"))
    return C.split_property(li, 4, ["1", "3"], {"property_pms_id": 100, "property_id": "NEW"}).drop("unit_group_code")


@register("correct_rates", """
WITH r AS (SELECT o_orderkey, o_orderpriority AS code, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(o_totalprice AS DOUBLE) AS rate FROM orders)
SELECT o_orderkey, code, CASE WHEN code = '1-URGENT' AND y = 1996 AND m >= 5 THEN 24.5 WHEN code = '1-URGENT' AND y = 1996 AND m >= 2 THEN 25.0
  WHEN code = '5-LOW' AND y = 1997 AND m >= 7 THEN 117.25 ELSE rate END AS rate FROM r""")
def correct_rates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("code"), F.year("o_orderdate").alias("y"),
                                          F.month("o_orderdate").alias("m"), F.col("o_totalprice").cast("double").alias("rate"))
    fixes = IO.values_df(spark, [("1-URGENT", 1996, 2, 25.0), ("1-URGENT", 1996, 5, 24.5), ("5-LOW", 1997, 7, 117.25)], "code string, y int, from_month int, rate double")
    return C.correct_rates(o, fixes, "code", "y", "m", "rate").select("o_orderkey", "code", "rate")


@register("reservation_preferences", """
WITH r AS (SELECT o_custkey AS cluster_id, CASE o_orderkey % 5 WHEN 0 THEN 'FCZ' WHEN 1 THEN 'FGP' WHEN 2 THEN 'FEW' WHEN 3 THEN 'FSV' END AS p,
  o_orderkey % 3 AS kids, CASE WHEN o_orderkey % 2 = 0 THEN 'J3C' ELSE 'XXX' END AS u FROM orders)
SELECT DISTINCT cluster_id, external_id, 'rules' AS source_system FROM (
  SELECT cluster_id, 'PREF001' AS external_id FROM r WHERE p IN ('FCZ', 'FGP') UNION ALL SELECT cluster_id, 'PREF002' FROM r WHERE p = 'FEW'
  UNION ALL SELECT cluster_id, 'PREF003' FROM r WHERE kids > 0 UNION ALL SELECT cluster_id, 'PREF004' FROM r WHERE kids > 0
  UNION ALL SELECT cluster_id, 'PREF005' FROM r WHERE p = 'FEW' UNION ALL SELECT cluster_id, 'PREF006' FROM r WHERE p = 'FCZ'
  UNION ALL SELECT cluster_id, 'PREF007' FROM r WHERE p = 'FSV' AND u = 'J3C')""")
def reservation_preferences(spark, sf):
    k = F.col("o_orderkey")
    r = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cluster_id"), (k % 3).alias("children_num"), F.when(k % 2 == 0, "J3C").otherwise("XXX").alias("unit_group_code"),
        F.when(k % 5 == 0, "FCZ").when(k % 5 == 1, "FGP").when(k % 5 == 2, "FEW").when(k % 5 == 3, "FSV").alias("property_id"))
    return S.preference_tags(r, "cluster_id", S.reservation_preference_rules(), "rules").select("cluster_id", "external_id", "source_system")


@register("since_switch", """SELECT o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 1 AND o_orderdate >= make_timestamp(1993 + n_nationkey % 5, 1, 1, 0, 0, 0)""")
def since_switch(spark, sf):
    """Orders since their nation's switch date (J13): a range join with a lower bound only."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    w = table(spark, sf, "nation").where("n_regionkey <> 1").select(
        "n_nationkey", "n_name", F.expr("make_timestamp_ntz(cast(1993 + n_nationkey % 5 as int), 1, 1, 0, 0, 0)").alias("lo"))
    return J.interval_join(o, w, ("c_nationkey", "n_nationkey"), "o_orderdate", "lo").select("o_orderkey", "n_name")


@register("inside_window", """SELECT o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 1 AND o_orderdate >= make_timestamp(1993 + n_nationkey % 5, 1, 1, 0, 0, 0)
  AND (n_nationkey % 3 = 0 OR o_orderdate <= make_timestamp(1995 + n_nationkey % 3, 1, 1, 0, 0, 0))""")
def inside_window(spark, sf):
    """Orders inside their nation's window (J12); a NULL end is open."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    w = table(spark, sf, "nation").where("n_regionkey <> 1").select(
        "n_nationkey", "n_name", F.expr("make_timestamp_ntz(cast(1993 + n_nationkey % 5 as int), 1, 1, 0, 0, 0)").alias("lo"),
        F.expr("if(n_nationkey % 3 = 0, null, make_timestamp_ntz(cast(1995 + n_nationkey % 3 as int), 1, 1, 0, 0, 0))").alias("hi"))
    return J.interval_join(o, w, ("c_nationkey", "n_nationkey"), "o_orderdate", "lo", "hi").select("o_orderkey", "n_name")


@register("sparse_records", oracle_with("dirty") + """
SELECT c_custkey, CAST((fname IS NOT NULL)::INT + (lname IS NOT NULL)::INT + (email IS NOT NULL)::INT AS INT) AS n_fields, fname IS NOT NULL AS has_fname FROM dirty""")
def sparse_records(spark, sf):
    """Records as maps without their NULL fields."""
    d = dirty(spark, sf)
    m = X.sparse(F.create_map(*[x for c in ("fname", "lname", "email") for x in (F.lit(c), F.col(c))]))
    return d.select("c_custkey", F.size(m).alias("n_fields"), F.map_contains_key(m, "fname").alias("has_fname"))


@register("recode_names", oracle_with("dirty") + "SELECT c_custkey, lname AS recoded FROM dirty")
def recode_names(spark, sf):
    """UTF-8 names that were read as Latin-1, read again the right way."""
    wrong = F.decode(F.encode("lname", "UTF-8"), "ISO-8859-1")
    return dirty(spark, sf).select("c_custkey", X.recode(wrong).alias("recoded"))


@register("write_types", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, l_shipmode, l_shipinstruct,
  l_shipdate, length(l_shipmode) > 4 OR length(l_shipinstruct) > 14 AS rejected,
  CASE WHEN length(l_shipmode) > 4 THEN 'l_shipmode' WHEN length(l_shipinstruct) > 14 THEN 'l_shipinstruct' END AS reason FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, concat(l_returnflag, repeat('x', CAST(l_linenumber AS INT))) AS l_shipmode,
    concat(l_linestatus, '-', l_suppkey, '-', l_partkey * 1000) AS l_shipinstruct, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate FROM lineitem)""")
def write_types(spark, sf):
    """Line items written with their target types and read back, over-long texts apart."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.concat("l_returnflag", F.repeat(F.lit("x"), F.col("l_linenumber").cast("int"))).alias("l_shipmode"),
        F.concat("l_linestatus", F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"), (F.col("l_partkey") * 1000).cast("string")).alias("l_shipinstruct"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"))
    back = IO.typed_write(li, IO.scratch_dir(spark, "typed") + "/t", {"l_shipmode": 4, "l_shipinstruct": 14})
    return back.withColumnsRenamed({"_rejected": "rejected", "_reason": "reason"})


@register("property_consents", """
WITH o AS (SELECT CASE c_custkey % 6 WHEN 0 THEN 'FSV' WHEN 1 THEN 'FJE' WHEN 2 THEN 'FBZ' WHEN 3 THEN 'FMP' ELSE 'XXX' END AS property_code,
    CASE WHEN c_custkey % 7 <> 0 THEN concat('u', c_custkey % 500, CASE WHEN c_custkey % 11 = 0 THEN '@Own.example' ELSE '@b.example' END) END AS email,
    c_custkey % 3 AS newsletter FROM customer),
p AS (SELECT * FROM (VALUES ('FSV', 's1'), ('FJE', 's2'), ('FBZ', 's3'), ('FMP', 's4')) t(code, sf_property_id)),
cp AS (SELECT s_suppkey AS cpe_id, concat('u', s_suppkey % 500, '@b.example') AS email FROM supplier),
con AS (SELECT concat('u', o_custkey % 500, '@b.example') AS email, concat('s', o_orderkey % 4 + 1) AS sf_property_id FROM orders WHERE o_orderkey % 5 = 0),
a AS (SELECT DISTINCT property_code, email, sf_property_id FROM o LEFT JOIN p ON p.code = property_code
      WHERE email IS NOT NULL AND newsletter = 1 AND NOT lower(email) LIKE '%@own.example')
SELECT cpe_id, 'list' AS source, sf_property_id, CASE property_code WHEN 'FSV' THEN 'marketing_property_Velden' WHEN 'FJE' THEN 'marketing_property_Jesolo'
  WHEN 'FBZ' THEN 'marketing_property_Bozen' WHEN 'FMP' THEN 'marketing_property_Prague' END AS consent_type
FROM a JOIN cp ON cp.email = a.email
WHERE NOT EXISTS (SELECT 1 FROM con WHERE con.email = a.email AND con.sf_property_id = a.sf_property_id)""")
def property_consents(spark, sf):
    k = F.col("c_custkey")
    code = F.when(k % 6 == 0, "FSV").when(k % 6 == 1, "FJE").when(k % 6 == 2, "FBZ").when(k % 6 == 3, "FMP").otherwise("XXX")
    mail = lambda n, end: F.concat(F.lit("u"), (n % 500).cast("string"), end)
    own = F.when(k % 11 == 0, "@Own.example").otherwise("@b.example")
    o = table(spark, sf, "customer").select(code.alias("property_code"), F.when(k % 7 != 0, mail(k, own)).alias("email"), (k % 3).alias("newsletter"))
    p = IO.values_df(spark, [("FSV", "s1"), ("FJE", "s2"), ("FBZ", "s3"), ("FMP", "s4")], "code string, sf_property_id string")
    cp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cpe_id"), mail(F.col("s_suppkey"), F.lit("@b.example")).alias("email"))
    con = table(spark, sf, "orders").where("o_orderkey % 5 = 0").select(
        mail(F.col("o_custkey"), F.lit("@b.example")).alias("email"), F.concat(F.lit("s"), (F.col("o_orderkey") % 4 + 1).cast("string")).alias("sf_property_id"))
    return CS.property_consents(o, p, cp, con, "list", "own.example")


@register("central_consents", """
SELECT 'list' AS source, c_custkey AS cpe_id FROM (SELECT o_custkey AS email FROM orders WHERE o_orderstatus = 'F') o JOIN customer ON c_custkey = email
WHERE c_custkey % 4 <> 0 AND NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = c_custkey AND n.o_orderpriority = '1-URGENT')""")
def central_consents(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("c_custkey")
    cp = table(spark, sf, "customer").select(k.alias("cpe_id"), k.alias("email"), F.when(k % 4 != 0, F.concat(F.lit("003"), k)).otherwise("001").alias("party_id"))
    con = o.select(F.col("o_custkey").alias("cpe_id"), F.when(F.col("o_orderpriority") == "1-URGENT", "marketing_central").otherwise("other").alias("name"))
    return CS.central_consents(o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("email")), cp, con, "list")


RES_SQL = """SELECT o_orderkey AS reservation_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('m', o_custkey % 40) END AS email,
  CASE WHEN o_orderkey % 2 = 0 THEN '2_has_lastname_and_email' ELSE '1_partial' END AS data_quality_bucket,
  CASE WHEN o_orderkey % 10 = 0 THEN 'c' END AS sf_person_contact_id, CASE WHEN o_orderkey % 13 = 0 THEN 'r' END AS sf_reservation_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'p' END AS sf_property_id, CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS _excluded,
  CAST(NULL AS STRING) AS sf_person_account_id FROM {orders}"""
LIST_SQL = "SELECT l_orderkey AS pms_reservation_id, l_suppkey AS list_id, CASE WHEN l_linenumber > 2 THEN 1 ELSE 0 END AS is_duplicate FROM {lineitem}"
LISTED_SQL = """SELECT c_custkey % 60 AS list_id, concat('m', c_custkey % 40) AS email, CASE WHEN c_custkey % 5 <> 0 THEN concat('003', c_custkey) END AS sf_contact_id,
  concat('001', c_custkey) AS sf_account_id FROM {customer}"""


@register("match_by_list", f"""
WITH r AS ({RES_SQL.format(orders='orders')}), l AS ({LIST_SQL.format(lineitem='lineitem')}), p AS ({LISTED_SQL.format(customer='customer')}),
h AS (SELECT reservation_id, sf_contact_id, sf_account_id FROM r JOIN l ON pms_reservation_id = reservation_id JOIN p ON p.list_id = l.list_id AND p.email = r.email
      WHERE sf_person_contact_id IS NULL AND sf_reservation_id IS NULL AND is_duplicate = 0 AND _excluded = 0 AND sf_property_id IS NOT NULL
        AND sf_contact_id IS NOT NULL AND data_quality_bucket = '2_has_lastname_and_email')
SELECT reservation_id, min(sf_contact_id) AS sf_person_contact_id, arg_min(sf_account_id, sf_contact_id) AS sf_person_account_id FROM h GROUP BY reservation_id""")
def match_by_list(spark, sf):
    r, l_, p = (spark.sql(q, **{t: table(spark, sf, t)}) for q, t in ((RES_SQL, "orders"), (LIST_SQL, "lineitem"), (LISTED_SQL, "customer")))
    return I.match_by_list(r, l_, p).select("reservation_id", "sf_person_contact_id", "sf_person_account_id")


@register("match_by_cluster", f"""
WITH r AS ({RES_SQL.format(orders='orders')}), t AS ({LISTED_SQL.format(customer='customer')}),
h AS (SELECT r.reservation_id, sf_contact_id, sf_account_id FROM r JOIN orders ON o_orderkey = r.reservation_id JOIN t ON t.list_id = o_custkey % 60
      WHERE sf_reservation_id IS NULL AND _excluded = 0 AND t.sf_contact_id IS NOT NULL)
SELECT reservation_id, min(sf_contact_id) AS sf_person_contact_id, arg_min(sf_account_id, sf_contact_id) AS sf_person_account_id FROM h GROUP BY reservation_id""")
def match_by_cluster(spark, sf):
    r, t = spark.sql(RES_SQL, orders=table(spark, sf, "orders")), spark.sql(LISTED_SQL, customer=table(spark, sf, "customer"))
    acc = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"), (F.col("o_custkey") % 60).alias("cluster_id"))
    return I.match_by_cluster(r, acc, t.where("sf_contact_id IS NOT NULL").withColumnRenamed("list_id", "cluster_id")).select(
        "reservation_id", "sf_person_contact_id", "sf_person_account_id")


PROPERTY_ROWS_SQL = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'protel' WHEN 1 THEN 'apaleo' ELSE 'other' END AS source, o_custkey % 30 AS property_pms_id,
  concat('n', o_custkey % 35) AS property_id, CASE WHEN o_orderkey % 4 = 0 THEN 'old' END AS sf_property_id FROM {orders}"""
TARGET_SQL = "SELECT concat('n', n_nationkey) AS code, concat('sf', n_nationkey) AS sf_id, n_nationkey AS pms_id FROM {nation} WHERE n_regionkey <> 2"


@register("property_ids", f"""
WITH d AS ({PROPERTY_ROWS_SQL.format(orders='orders')}), t AS ({TARGET_SQL.format(nation='nation')})
SELECT o_orderkey, CASE source WHEN 'protel' THEN coalesce(sf_property_id, a.sf_id) WHEN 'apaleo' THEN coalesce(b.sf_id, sf_property_id) ELSE sf_property_id END AS sf_property_id
FROM d LEFT JOIN t a ON a.pms_id = property_pms_id LEFT JOIN t b ON b.code = property_id""")
def property_ids(spark, sf):
    t = spark.sql(TARGET_SQL, nation=table(spark, sf, "nation"))
    d = spark.sql(PROPERTY_ROWS_SQL, orders=table(spark, sf, "orders"))
    return S.target_property_ids(d, t.select("pms_id", "code"), t.select("code", "sf_id")).select("o_orderkey", "sf_property_id")


@register("enrolment_dates", """SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY END,
  TIMESTAMP '1990-01-01') AS DATE) AS enrollment_date FROM orders""")
def enrolment_dates(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", I.enrolment_date(
        F.when(k % 2 == 0, F.col("o_orderdate")), F.when(k % 3 == 0, F.col("o_orderdate") + F.expr("interval 1 day")),
        F.to_timestamp_ntz(F.lit("1990-01-01"))).alias("enrollment_date"))
