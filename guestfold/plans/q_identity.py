"""Driver queries for identity assembly and consents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as N
from ..functions import columns as X
from ..operators import consent as CS
from ..operators import identity as I
from ..operators.joins import lookup_one
from .q_joins import PARTY_ID_SQL, party_id
from .registry import register
from .tables import AS_OF_EVENTS, dirty, oracle_with, table

#: Some customers have two target rows, of which one carries another name.
TARGET_SQL = """SELECT DISTINCT o_custkey AS t_custkey,
  CASE WHEN o_custkey % 7 = 0 AND o_orderkey % 2 = 0 THEN 'Someone Else' ELSE concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) END
    AS t_name FROM orders WHERE o_orderstatus = 'F'"""


@register("classify_import", f"""
WITH t AS ({TARGET_SQL}),
m AS (SELECT c_custkey, count(t_custkey) AS n, count(*) FILTER (WHERE t_name <> src_name) AS bad
      FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS src_name FROM customer) c
      LEFT JOIN t ON t_custkey = c_custkey GROUP BY c_custkey)
SELECT c_custkey, CASE WHEN n = 0 THEN 'create' WHEN bad > 0 THEN 'none' ELSE 'update' END AS operation,
  CASE WHEN bad > 0 THEN 'name_conflict' END AS conflict_reason FROM m""")
def classify_import(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("src_name"))
    k = F.col("o_custkey")
    own = F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0"))
    tgt = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        k.alias("t_custkey"), F.when((k % 7 == 0) & (F.col("o_orderkey") % 2 == 0), F.lit("Someone Else")).otherwise(own).alias("t_name")).distinct()
    return I.classify_import(c, tgt, ("c_custkey", "t_custkey"), ("src_name", "t_name")).drop("src_name")


@register("attach_sso", oracle_with("dirty") + f"""
, acc AS (SELECT concat('sample.', c_custkey, '@example.org') AS email, {PARTY_ID_SQL} AS account_id,
                 concat('sso-', c_custkey) AS sso_id FROM customer WHERE c_custkey % 2 = 0)
SELECT d.c_custkey, lower(trim(d.email)) AS email_key,
  CASE WHEN substr(a.account_id, 1, 3) = '001' THEN a.account_id END AS account_id,
  CASE WHEN substr(a.account_id, 1, 3) = '001' THEN a.sso_id END AS sso_id,
  (CASE WHEN substr(a.account_id, 1, 3) = '001' THEN a.sso_id END) IS NULL AS missing_sso
FROM dirty d LEFT JOIN acc a ON a.email = lower(trim(d.email))""")
def attach_sso(spark, sf):
    d = dirty(spark, sf).select("c_custkey", F.lower(F.trim("email")).alias("email_key"))
    acc = table(spark, sf, "customer").where(F.col("c_custkey") % 2 == 0).select(
        F.concat(F.lit("sample."), F.col("c_custkey"), F.lit("@example.org")).alias("email"),
        party_id().alias("account_id"), F.concat(F.lit("sso-"), F.col("c_custkey")).alias("sso_id"))
    out = I.attach_ids(d, acc, ("email_key", "email"), ["account_id", "sso_id"], "account_id")
    return out.withColumn("missing_sso", F.col("sso_id").isNull())


def _import_rules_sql():
    from .q_clean import _email_rules_sql
    return _email_rules_sql()


@register("build_import", oracle_with("dirty") + f"""
, sel AS (SELECT * FROM dirty WHERE current_opt_in = 'Yes' AND ({_import_rules_sql()}) IS NULL
            AND NOT (lname IS NULL OR trim(lname) = ''))
, lo AS (SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) t
         WHERE rn = 1)
SELECT s.c_custkey, s.fname, s.lname, lower(trim(s.email)) AS email,
  CAST(try_strptime(s.birth_text, '%d.%m.%Y') AS DATE) AS birth_date, n.n_name, lo.o_orderkey AS last_orderkey,
  c.c_mktsegment, 'PersonAccount' AS record_type, 'gms' AS source
FROM sel s JOIN customer c ON c.c_custkey = s.c_custkey JOIN lo ON lo.o_custkey = s.c_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def build_import(spark, sf):
    d = dirty(spark, sf)
    sel = d.where((F.col("current_opt_in") == "Yes") & X.first_reason(N.email_exclusion_rules("email")).isNull()
                  & ~X.is_blank("lname"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_orderkey"),
                                          "o_orderdate")
    j = sel.join(c, "c_custkey").join(n, "c_nationkey")
    j = lookup_one(j, o, "c_custkey", [F.col("o_orderdate").desc(), F.col("last_orderkey").desc()])
    return j.select("c_custkey", "fname", "lname", F.lower(F.trim("email")).alias("email"),
                    X.parse_date("birth_text", "dd.MM.yyyy").alias("birth_date"), "n_name", "last_orderkey",
                    "c_mktsegment", F.lit("PersonAccount").alias("record_type"), F.lit("gms").alias("source"))


@register("import_assembly", oracle_with("dirty") + """
, cpe AS (SELECT concat('cpe-', c_custkey) AS id, concat('sample.', c_custkey, '@example.org') AS mail,
            concat(CASE WHEN c_custkey % 5 = 0 THEN '001' ELSE '003' END, c_custkey) AS party FROM customer WHERE c_custkey % 7 <> 0)
, acc AS (SELECT concat('acc-', c_custkey) AS id, concat('003', c_custkey) AS party, concat('sample.', c_custkey, '@example.org') AS mail,
            CASE WHEN c_custkey % 2 = 0 THEN 'Anna' ELSE 'Jörg' END AS fname FROM customer)
, loy AS (SELECT concat('loy-', o_orderkey) AS id, concat('003', o_custkey) AS party FROM orders WHERE o_orderstatus = 'F')
SELECT DISTINCT 'update' AS _operation, 'invest-1' AS _batch_id, acc.id AS sf_account_id, acc.party AS sf_person_contact_id,
  loy.id AS sf_loyalty_member_id, cpe.id AS sf_cp_email_id, 'invest' AS source, d.member_id AS external_id, d.fname AS first_name,
  d.lname AS last_name, CAST(try_strptime(d.birth_text, '%d.%m.%Y') AS DATE) AS birth_date, 1 AS invest_customer
FROM dirty d JOIN cpe ON cpe.mail = d.email JOIN acc ON acc.party = cpe.party AND acc.mail = d.email
JOIN loy ON loy.party = cpe.party
WHERE cpe.mail IS NOT NULL AND substr(cpe.party, 1, 3) = '003' AND d.fname = acc.fname AND d.member_id NOT IN ('59', '95')""")
def import_assembly(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    mail = F.concat(F.lit("sample."), k, F.lit("@example.org"))
    cpe = c.where(k % 7 != 0).select(F.concat(F.lit("cpe-"), k).alias("Id"), mail.alias("EmailAddress"),
                                     F.concat(F.when(k % 5 == 0, "001").otherwise("003"), k).alias("PartyID__c"))
    acc = c.select(F.concat(F.lit("acc-"), k).alias("Id"), F.concat(F.lit("003"), k).alias("PersonContactId"), mail.alias("PersonEmail"),
                   F.when(k % 2 == 0, "Anna").otherwise("Jörg").alias("FirstName"))
    loy = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("loy-"), F.col("o_orderkey")).alias("Id"), F.concat(F.lit("003"), F.col("o_custkey")).alias("ContactId"))
    fields = {"first_name": F.col("fname"), "last_name": F.col("lname"), "birth_date": X.parse_date("birth_text", "dd.MM.yyyy"),
              "invest_customer": F.lit(1)}
    return I.assemble_import(dirty(spark, sf), cpe, acc, loy, fields, "member_id", "invest-1", "invest", skip=["59", "95"])


@register("optouts", oracle_with("dirty") + f"""
, con AS (SELECT concat('C', c_custkey) AS consent_id, email, CASE WHEN c_custkey % 4 = 0 THEN 'sms' ELSE 'marketing_central' END AS name,
            CASE WHEN c_custkey % 5 = 0 THEN 'OptOut' WHEN c_custkey % 5 = 1 THEN NULL ELSE 'OptIn' END AS status FROM dirty)
SELECT DISTINCT consent_id, DATE '{AS_OF_EVENTS}' AS effective_to, 'OptOut' AS status FROM con
WHERE name = 'marketing_central' AND status = 'OptIn'
  AND email IN (SELECT email FROM dirty d JOIN orders o ON o.o_custkey = d.c_custkey WHERE o.o_orderstatus = 'P')""")
def optouts(spark, sf):
    d, k = dirty(spark, sf).select("c_custkey", "email"), F.col("c_custkey")
    unsub = d.join(table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    con = d.select(F.concat(F.lit("C"), k).alias("consent_id"), F.col("email").alias("address"),
                   F.when(k % 4 == 0, "sms").otherwise("marketing_central").alias("name"),
                   F.when(k % 5 == 0, "OptOut").when(k % 5 == 1, None).otherwise("OptIn").alias("current"))
    return CS.optouts(unsub, con, "email", "address", "consent_id", "name", "current", "marketing_central", AS_OF_EVENTS)


@register("consent_records", f"""
WITH s AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS captured FROM events GROUP BY 1),
c AS (SELECT user_id, coalesce(captured, TIMESTAMP '{AS_OF_EVENTS}') AS cap FROM s)
SELECT user_id,
  strftime(cap, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(cap, '%f') = '000000' THEN '' ELSE '.' || strftime(cap, '%f') END
    || 'Z' AS CaptureDate,
  strftime(cap, '%Y-%m-%d') AS EffectiveFrom, 'Marketing' AS DataUsePurpose, 'OptIn' AS PrivacyConsentStatus,
  'web' AS CaptureSource
FROM c""")
def consent_records(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    s = ev.groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("captured"))
    return CS.consent_records(s, "user_id", "captured", AS_OF_EVENTS)


@register("missing_consents", oracle_with("dirty") + """
, optin AS (SELECT DISTINCT lower(trim(email)) AS email, CASE list_id % 3 WHEN 0 THEN 'Newsletter Alpine'
              WHEN 1 THEN 'Newsletter Coast' ELSE 'Newsletter City' END AS consent_name
            FROM dirty WHERE current_opt_in = 'Yes' AND email LIKE '%@%'),
cpe AS (SELECT concat('sample.', c_custkey, '@example.org') AS cp_email, concat('cpe-', c_custkey) AS cp_id
        FROM customer WHERE c_custkey % 3 <> 0),
have AS (SELECT concat('cpe-', c_custkey) AS cp, 'Newsletter Coast' AS name FROM customer WHERE c_custkey % 2 = 0)
SELECT o.email, o.consent_name, c.cp_id FROM optin o JOIN cpe c ON c.cp_email = o.email
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.cp = c.cp_id AND h.name = o.consent_name)""")
def missing_consents(spark, sf):
    lid = F.col("list_id") % 3
    optin = dirty(spark, sf).where((F.col("current_opt_in") == "Yes") & F.col("email").like("%@%")).select(
        F.lower(F.trim("email")).alias("email"),
        F.when(lid == 0, "Newsletter Alpine").when(lid == 1, "Newsletter Coast").otherwise("Newsletter City")
         .alias("consent_name")).distinct()
    cust = table(spark, sf, "customer")
    cpe = cust.where(F.col("c_custkey") % 3 != 0).select(
        F.concat(F.lit("sample."), F.col("c_custkey"), F.lit("@example.org")).alias("cp_email"),
        F.concat(F.lit("cpe-"), F.col("c_custkey")).alias("cp_id"))
    have = cust.where(F.col("c_custkey") % 2 == 0).select(F.concat(F.lit("cpe-"), F.col("c_custkey")).alias("cp"),
                                                          F.lit("Newsletter Coast").alias("name"))
    out = CS.missing_consents(optin, cpe, have, "email", "cp_email", "cp_id", "cp", "name", "consent_name")
    return out.select("email", "consent_name", "cp_id")


CANDIDATES_SQL = """SELECT o_custkey AS cluster_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'gms' WHEN 1 THEN 'protel' WHEN 2 THEN 'apaleo' ELSE 'other' END AS source,
  CAST(o_orderkey AS VARCHAR) AS source_id,
  CAST(o_orderkey % 5 AS INTEGER) AS complete_fields, CAST(o_orderkey % 3 AS INTEGER) AS _rule_bin,
  d.fname AS cluster_first_name, d.lname AS cluster_last_name, d.email AS cluster_email
FROM orders JOIN dirty d ON d.c_custkey = o_custkey"""


@register("identity_survivors", oracle_with("dirty") + f"""
, c AS ({CANDIDATES_SQL})
SELECT cluster_id, source, source_id FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY
      CASE source WHEN 'gms' THEN 0 WHEN 'protel' THEN 1 WHEN 'apaleo' THEN 1 ELSE 2 END,
      complete_fields DESC, CASE _rule_bin WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END, source, source_id) AS rn
  FROM c WHERE cluster_id IS NOT NULL AND _rule_bin IN (0, 1) AND cluster_first_name IS NOT NULL
    AND cluster_last_name IS NOT NULL AND cluster_email IS NOT NULL) t
WHERE rn = 1""")
def identity_survivors(spark, sf):
    """D1 with the original priority rules on order-derived candidates."""
    d = dirty(spark, sf).select("c_custkey", F.col("fname").alias("cluster_first_name"),
                                F.col("lname").alias("cluster_last_name"), F.col("email").alias("cluster_email"))
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cluster_id"),
        F.when(k % 4 == 0, "gms").when(k % 4 == 1, "protel").when(k % 4 == 2, "apaleo").otherwise("other").alias("source"),
        k.cast("string").alias("source_id"), (k % 5).cast("int").alias("complete_fields"),
        (k % 3).cast("int").alias("_rule_bin"))
    cand = o.join(d, o["cluster_id"] == d["c_custkey"]).drop("c_custkey")
    return I.survivors(cand).select("cluster_id", "source", "source_id")
