"""Driver queries for cleaning and normalisation (N1-N23, F1-F29) on the ``dirty`` view.

The oracle SQL for the rule tables is generated from the same fixed value
lists (data), with the rule logic written out in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as N
from ..functions import columns as X
from ..operators.stays import RESERVATION_STATUS_LABELS
from .registry import register
from .tables import dirty, oracle_with, table

AS_OF_PEOPLE = "2025-06-30"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# ----------------------------------------------------------------------------- N1 N2 F2 F6

@register("trim_email_domain", oracle_with("dirty") + """
, t AS (SELECT c_custkey, nullif(trim(fname), '') AS fname, nullif(trim(lname), '') AS lname,
               nullif(trim(email), '') AS email FROM dirty)
SELECT c_custkey, fname, lname, lower(trim(email)) AS email, split_part(lower(trim(email)), '@', -1) AS domain FROM t""")
def trim_email_domain(spark, sf):
    d = N.trim_all(dirty(spark, sf).select("c_custkey", "fname", "lname", "email"), ["fname", "lname", "email"])
    return N.normalise_email(d)


# ----------------------------------------------------------------------------- N13 N14

def _email_rules_sql() -> str:
    el = "lower(trim(email))"
    dom = f"split_part({el}, '@', -1)"
    return f"""CASE WHEN email IS NULL OR trim(email) = '' THEN 'no_email'
    WHEN lower(trim(bounce)) IN {in_list(N.BOUNCE_VALUES)} THEN 'bounce'
    WHEN NOT regexp_matches({el}, {q(N.EMAIL_LOOSE)}) OR contains({el}, ' ') OR contains({el}, '..')
         OR NOT contains({el}, '@') THEN 'malformed'
    WHEN lower({dom}) IN {in_list(N.DISPOSABLE_DOMAINS)} THEN 'disposable_domain'
    WHEN lower({dom}) IN {in_list(N.RELAY_DOMAINS)} THEN 'relay_domain'
    WHEN regexp_matches({el}, {q("^(" + "|".join(N.NOREPLY_LOCAL_PARTS) + ")@")}) THEN 'no_reply'
    WHEN contains(lower(fname), 'test') OR contains(lower(fname), 'booking') THEN 'test_marker'
    WHEN regexp_matches(lower(fname), '.temporär') THEN 'temporary_profile'
    WHEN regexp_matches(lname, '[\\p{{Han}}\\p{{Hangul}}\\p{{Arabic}}\\p{{Hebrew}}\\p{{Cyrillic}}\\p{{Armenian}}\\p{{Myanmar}}]') THEN 'non_latin_name'
    WHEN fname IS NULL AND contains(lower(lname), 'travel') THEN 'travel_agency' END"""


#: Hand-written from the flag statement, not from the lists that the Spark rule uses.
INVALID_REASON_SQL = r"""CASE WHEN email IS NOT NULL AND trim(email) <> '' AND (
    NOT regexp_matches(lower(email), '^[a-z0-9._+-]+@[a-z0-9.-]+\.[a-z]{2,}$') OR email LIKE '.%' OR email LIKE '%.@%'
    OR email LIKE '%@.%' OR email LIKE '%..%' OR email LIKE '%@%@%') THEN 'malformed' END"""


@register("email_flags", oracle_with("dirty") + f"""
SELECT c_custkey, email, {_email_rules_sql()} AS exclude_reason,
  ({INVALID_REASON_SQL}) IS NOT NULL AS email_invalid, {INVALID_REASON_SQL} AS invalid_reason
FROM dirty""")
def email_flags(spark, sf):
    d = dirty(spark, sf)
    invalid, reason = N.email_invalid("email")
    return d.select("c_custkey", "email",
                    X.first_reason(N.email_exclusion_rules("email")).alias("exclude_reason"),
                    invalid.alias("email_invalid"), reason.alias("invalid_reason"))


EMAIL_IN_TEXT = N.EMAIL_IN_TEXT


@register("document_emails", f"""
WITH x AS (SELECT doc_id, unnest(regexp_extract_all(text, {q(EMAIL_IN_TEXT)})) AS email FROM documents)
SELECT doc_id, email, {INVALID_REASON_SQL} AS invalid_reason FROM x""")
def document_emails(spark, sf):
    x = N.extract_emails(table(spark, sf, "documents"), "text", keep=["doc_id"])
    _, reason = N.email_invalid("email")
    return x.select("doc_id", "email", reason.alias("invalid_reason"))


# ----------------------------------------------------------------------------- N3

@register("title_case", oracle_with("dirty") + """
SELECT c_custkey,
  array_to_string(list_transform(string_split(regexp_replace(lower(trim(fname)), '([ .''-])', '\\1' || chr(1), 'g'),
    chr(1)), lambda p: upper(p[1]) || p[2:]), '') AS fname_tc,
  array_to_string(list_transform(string_split(regexp_replace(lower(trim(lname)), '([ .''-])', '\\1' || chr(1), 'g'),
    chr(1)), lambda p: upper(p[1]) || p[2:]), '') AS lname_tc
FROM dirty""")
def title_case(spark, sf):
    d = dirty(spark, sf)
    return d.select("c_custkey", X.title_case("fname").alias("fname_tc"), X.title_case("lname").alias("lname_tc"))


# ----------------------------------------------------------------------------- N4 N5

def _salutation_sql(src: str = "salutation") -> str:
    """Nested sub-selects, one per pass, mirroring ``N.SALUTATION_PASSES``."""
    s = "s"
    p1 = "CASE " + " ".join(
        f"WHEN upper(trim(replace({s}, '.', ''))) IN {in_list(keys)} THEN {q(canon)}"
        for canon, keys in N.SALUTATION_PASS1.items()) + \
        f" WHEN upper(trim({s})) IN {in_list(N.SALUTATION_GARBAGE)} THEN NULL ELSE {s} END"
    parts = []
    for result, kind, values in N.SALUTATION_RULES:
        if kind == "in":
            parts.append(f"WHEN lower(trim({s})) IN {in_list(v.lower() for v in values)} THEN {q(result)}")
        else:
            parts.append("WHEN " + " OR ".join(f"starts_with(lower(trim({s})), {q(v.lower())})" for v in values)
                         + f" THEN {q(result)}")
    p2 = "CASE " + " ".join(parts) + f" WHEN upper(trim({s})) IN {in_list(N.SALUTATION_GARBAGE)} THEN NULL ELSE {s} END"
    dear = (f"CASE WHEN NOT ({s} ILIKE 'Dear %') THEN {s} "
            f"WHEN regexp_matches({s}, '(?i)^Dear Mr[s]?\\.?\\s') AND NOT regexp_matches({s}, '(?i)Mrs') THEN 'Mr' "
            + " ".join(f"WHEN regexp_matches({s}, {q('(?i)' + pat)}) THEN {q(res)}" for pat, res in N.SALUTATION_DEAR)
            + " ELSE NULL END")
    ger = (f"CASE WHEN regexp_matches({s}, '(?i)^Sehr geehrter Herr ') THEN 'Mr.' "
           f"WHEN regexp_matches({s}, '(?i)^Sehr geehrte Frau ') THEN 'Mrs.' "
           f"WHEN regexp_matches({s}, '(?i)^Lieber ') THEN 'Mr.' WHEN regexp_matches({s}, '(?i)^Liebe ') THEN 'Mrs.' "
           f"ELSE {s} END")
    redot = (f"CASE WHEN lower({s}) IN {in_list(v.lower() for v in N.SALUTATION_DOTTED)} THEN {s} || '.' "
             f"WHEN lower({s}) = 'sig.na' THEN 'Mrs.' ELSE {s} END")
    sql = f"SELECT c_custkey, {src} AS s FROM dirty"
    for p in (p1, p2, dear, ger, redot):
        sql = f"SELECT c_custkey, {p} AS s FROM ({sql}) t"
    return sql


@register("salutation", oracle_with("dirty") + f"""
SELECT d.c_custkey, d.salutation AS salutation_raw, n.s AS salutation
FROM dirty d JOIN ({_salutation_sql()}) n ON n.c_custkey = d.c_custkey""")
def salutation(spark, sf):
    d = dirty(spark, sf).select("c_custkey", F.col("salutation").alias("salutation_raw"))
    return N.normalise_salutation(d, "salutation_raw", out="salutation")


@register("gender", oracle_with("dirty") + f"""
SELECT c_custkey, s AS salutation,
  CASE WHEN s = 'Mr.' THEN 'Male' WHEN s IN ('Mrs.', 'Ms.', 'Miss.') THEN 'Female' END AS gender
FROM ({_salutation_sql()}) n""")
def gender(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "salutation").withColumn("gender", F.lit(None).cast("string"))
    d = N.normalise_salutation(d, "salutation")
    return N.gender_from_salutation(d)


# ----------------------------------------------------------------------------- N7 N8 N9

def _variants_values() -> str:
    return "VALUES " + ", ".join(f"({q(k)}, {q(v)})" for k, v in N.COUNTRY_VARIANTS.items())


COUNTRY_SQL = f"""SELECT c_custkey, country,
  CASE WHEN v.variant IS NOT NULL THEN v.code WHEN regexp_matches(trim(country), '^[A-Z]{{2}}$') THEN trim(country)
       ELSE country END AS country_iso
FROM dirty LEFT JOIN ({_variants_values()}) v(variant, code) ON lower(v.variant) = lower(trim(dirty.country))"""


@register("country_codes", oracle_with("dirty") + COUNTRY_SQL)
def country_codes(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "country")
    return N.normalise_country(d, "country", out="country_iso")


@register("code_review", oracle_with("dirty") + f"""
SELECT country_iso AS remaining_value, count(*) AS cnt FROM ({COUNTRY_SQL}) t
WHERE country_iso IS NOT NULL AND NOT regexp_matches(country_iso, '^[A-Z]{{2}}$') GROUP BY 1""")
def code_review(spark, sf):
    d = N.normalise_country(dirty(spark, sf).select("c_custkey", "country"), "country", out="country_iso")
    return N.review_codes(d, "country_iso")


# ----------------------------------------------------------------------------- N10

@register("language_default", f"""
SELECT doc_id, lang, CASE WHEN lower(trim(lang)) IN ('hr', 'cz', 'sk', 'nl', 'fr', 'de', 'en') THEN lower(trim(lang))
  ELSE 'en' END AS language FROM documents""")
def language_default(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return docs.withColumn("language", N.normalise_language("lang"))


@register("language_codes", oracle_with("dirty") + """
SELECT c_custkey, CASE WHEN language_code = 'DE' THEN 'de' WHEN language_code = 'CZ' THEN 'cz' ELSE 'en' END AS language,
  CASE c_custkey % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'it' END AS named FROM dirty""")
def language_codes(spark, sf):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, "German").when(k == 1, "ITALIAN").when(k == 2, "Klingon")
    return dirty(spark, sf).select("c_custkey", N.normalise_language("language_code").alias("language"), N.language_from_name(name).alias("named"))


# ----------------------------------------------------------------------------- N11 N12 N15

def _null_ph(c, words):
    return f"CASE WHEN lower(trim({c})) IN {in_list(words)} THEN NULL ELSE {c} END"


@register("name_flags", oracle_with("dirty") + f"""
, t AS (SELECT c_custkey, {_null_ph('fname', N.FNAME_PLACEHOLDERS)} AS f, {_null_ph('lname', N.LNAME_PLACEHOLDERS)} AS l,
               lname FROM dirty)
, r AS (SELECT c_custkey, f AS fname, l AS lname,
  CASE WHEN l IS NULL OR trim(l) = '' THEN 'no_last_name'
       WHEN length(trim(l)) = 1 THEN 'one_char_last_name'
       WHEN (f IS NULL AND contains(lower(l), 'gmbh')) OR contains(lower(l), 'gesmbh') THEN 'company_last_name'
       WHEN contains(l, '_') THEN 'underscore'
       WHEN contains(l, '??') OR contains(l, chr(65533)) THEN 'question_marks'
       WHEN regexp_matches(lower(l), '^[0-9]+[a-z]+$') AND strlen(l) >= 8 THEN 'digits_and_letters'
       WHEN l IN ('..', ',s', '^rudy', '´') THEN 'odd_mark'
       WHEN l IN ('----', chr(173)) THEN 'dash_only'
       WHEN lower(f) LIKE '%_temporär%' OR l = '_temporaryProfile' THEN 'temp_profile'
       WHEN contains(f, '@@') OR contains(l, '@@') THEN 'double_at'
       WHEN contains(f, 'Http://') OR contains(l, 'Http://') THEN 'url' END AS missing_reason,
  regexp_matches(lname, '{"|".join(fr"\p{{{s}}}" for s in N.NON_LATIN_SCRIPTS)}') AS non_latin FROM t)
SELECT c_custkey, fname, lname, missing_reason, CASE WHEN missing_reason IS NULL THEN 0 ELSE 1 END AS missing_name,
  non_latin FROM r""")
def name_flags(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "fname", "lname")
    d = d.select("c_custkey", N.null_placeholders("fname", N.FNAME_PLACEHOLDERS).alias("fname"),
                 N.null_placeholders("lname", N.LNAME_PLACEHOLDERS).alias("lname_clean"),
                 N.has_script("lname").alias("non_latin"))
    reason = X.first_reason(N.missing_name_rules("fname", "lname_clean"))
    return d.select("c_custkey", "fname", F.col("lname_clean").alias("lname"), reason.alias("missing_reason"),
                    F.when(reason.isNull(), 0).otherwise(1).alias("missing_name"), "non_latin")


# ----------------------------------------------------------------------------- N16

@register("phones", oracle_with("dirty") + f"""
, t AS (SELECT c_custkey, cell_phone, nullif(regexp_replace(trim(cell_phone), {q(N.PHONE_DROP_CHARS)}, '', 'g'), '') AS k
        FROM dirty)
SELECT c_custkey, cell_phone,
  CASE WHEN regexp_replace(k, '[^0-9]', '', 'g') IN {in_list(N.PHONE_PLACEHOLDERS)} THEN NULL ELSE k END AS phone
FROM t""")
def phones(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "cell_phone")
    return d.withColumn("phone", N.clean_phone("cell_phone"))


# ----------------------------------------------------------------------------- N18 F16 F17

BIRTH_SQL = f"""SELECT c_custkey, birth_text, CAST(try_strptime(birth_text, '%d.%m.%Y') AS DATE) AS birth_date FROM dirty"""
BOUND_SQL = f"""CASE WHEN birth_date = DATE '1900-01-01' OR birth_date > DATE '{AS_OF_PEOPLE}'
  OR birth_date < DATE '1800-01-01' THEN NULL ELSE birth_date END"""


@register("birth_bounds", oracle_with("dirty") + f"""
SELECT c_custkey, birth_text, birth_date, {BOUND_SQL} AS birth_date_clean FROM ({BIRTH_SQL}) t""")
def birth_bounds(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "birth_text")
    d = d.withColumn("birth_date", X.parse_date("birth_text", "dd.MM.yyyy"))
    return d.withColumn("birth_date_clean", N.bound_birthdate("birth_date", AS_OF_PEOPLE))


@register("age_years", oracle_with("dirty") + f"""
, b AS (SELECT c_custkey, {BOUND_SQL} AS bd FROM ({BIRTH_SQL}) t)
SELECT c_custkey, CAST(year(DATE '{AS_OF_PEOPLE}') - year(bd)
  - CASE WHEN month(DATE '{AS_OF_PEOPLE}') < month(bd)
           OR (month(DATE '{AS_OF_PEOPLE}') = month(bd) AND day(DATE '{AS_OF_PEOPLE}') < day(bd)) THEN 1 ELSE 0 END
  AS INTEGER) AS age
FROM b""")
def age_years(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "birth_text")
    bd = N.bound_birthdate(X.parse_date("birth_text", "dd.MM.yyyy"), AS_OF_PEOPLE)
    return d.select("c_custkey", X.age_years(bd, AS_OF_PEOPLE).alias("age"))


# ----------------------------------------------------------------------------- N20 F11

@register("repair_encoding", oracle_with("dirty") + """
SELECT c_custkey,
  CASE c_custkey % 4 WHEN 0 THEN 'J?' WHEN 1 THEN concat('«', coalesce(lname, ''), '»') WHEN 2 THEN lname ELSE 'Jörg ¶' END AS repaired
FROM dirty""")
def repair_encoding(spark, sf):
    """Names with markers: a box-drawing character has no Latin-1 byte (``?``); quotes around plain
    text are no UTF-8 and stay; a name without a marker stays; UTF-8 bytes that were read as Latin-1 are repaired
    (the marker's own bytes included)."""
    d = dirty(spark, sf).select("c_custkey", "lname")
    k = F.col("c_custkey") % 4
    broken = (F.when(k == 0, F.lit("J├")).when(k == 1, F.concat(F.lit("«"), F.coalesce("lname", F.lit("")), F.lit("»")))
              .when(k == 2, F.col("lname")).otherwise(F.lit("JÃ¶rg Â¶")))
    return d.select("c_custkey", N.repair_encoding(broken, markers=N.MOJIBAKE_MARKERS + "ÃÂ").alias("repaired"))


# ----------------------------------------------------------------------------- N17 N19

@register("strip_suffix_fit", oracle_with("dirty") + """
SELECT c_custkey, regexp_replace(member_id, '\\.0$', '') AS member_id, nullif(left(fname, 4), '') AS fname_fit
FROM dirty""")
def strip_suffix_fit(spark, sf):
    d = dirty(spark, sf)
    return d.select("c_custkey", X.strip_dot_zero("member_id").alias("member_id"), X.fit("fname", 4).alias("fname_fit"))


# ----------------------------------------------------------------------------- D15

@register("name_in_email", oracle_with("dirty") + """
SELECT c_custkey, email, lname FROM dirty
WHERE lname IS NOT NULL AND trim(lname) <> ''
  AND contains(split_part(lower(trim(email)), '@', 1), lower(trim(lname)))""")
def name_in_email(spark, sf):
    from ..operators.identity import name_in_email as nie
    return nie(dirty(spark, sf).select("c_custkey", "email", "lname"), "email", "lname")


# ----------------------------------------------------------------------------- N23 G6 G7

@register("cleaning_report", oracle_with("dirty") + """
SELECT count(*) AS total,
  count(*) FILTER (WHERE fname IS NULL) AS null_fname,
  count(*) FILTER (WHERE lname IS NULL OR trim(lname) = '') AS blank_lname,
  count(*) FILTER (WHERE email IS NULL OR trim(email) = '') AS blank_email,
  count(*) FILTER (WHERE fname = upper(fname) AND fname <> lower(fname)) AS all_caps_fname,
  count(*) FILTER (WHERE lower(trim(bounce)) IN ('1', 'true', 'yes', 'y', 'hard', 'soft', 'bounce')) AS bounced,
  CAST(sum(CAST(current_opt_in = 'Yes' AS INTEGER)) AS BIGINT) AS opted_in,
  count(current_opt_in) AS opt_in_known
FROM dirty""")
def cleaning_report(spark, sf):
    from ..operators.report import cleaning_report as cr
    return cr(dirty(spark, sf))


_FINDINGS_SQL = {
    "all_caps": "(fname = upper(fname) AND regexp_matches(fname, '[A-Z]{2,}')) OR (lname = upper(lname) AND regexp_matches(lname, '[A-Z]{2,}'))",
    "all_lower": "(fname = lower(fname) AND regexp_matches(fname, '[a-z]{2,}')) OR (lname = lower(lname) AND regexp_matches(lname, '[a-z]{2,}'))",
    "digits": "regexp_matches(fname, '[0-9]') OR regexp_matches(lname, '[0-9]')",
    "odd_characters": "regexp_matches(fname, '[^a-zA-ZÀ-ÖØ-öø-ÿ ''\\-.]') OR regexp_matches(lname, '[^a-zA-ZÀ-ÖØ-öø-ÿ ''\\-.]')",
    "one_character": "strlen(trim(fname)) = 1 OR strlen(trim(lname)) = 1",
    "placeholder": "lower(trim(fname)) IN ('test', 'unknown', 'n/a', 'none', 'na', 'null', 'xxx', 'first')"
                   " OR lower(trim(lname)) IN ('test', 'unknown', 'n/a', 'none', 'na', 'null', 'xxx', 'last')",
    "email_format": "NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') OR email LIKE '% %' OR email LIKE '%..%'",
    "email_outer_blanks": "email <> trim(email)",
    "email_case": "email <> lower(email)",
}
_REPORT_FIELDS = ["fname", "lname", "email", "salutation", "cell_phone", "country", "birth_text", "member_id"]
_REPORT_SQL = [("total", "true"), *[(f"{f}_missing", f"{f} IS NULL OR trim({f}) = ''") for f in _REPORT_FIELDS],
               ("null_email", "email IS NULL"), ("blank_email", "trim(email) = ''"), ("has_email", "email IS NOT NULL AND trim(email) <> ''")]


@register("contact_report", oracle_with("dirty") + "\nUNION ALL ".join(
    [f"SELECT '{k}' AS \"check\", count(*) AS n FROM dirty WHERE current_opt_in = 'Yes' AND ({c})" for k, c in _REPORT_SQL]
    + [f"SELECT '{k}' AS \"check\", count(*) AS n FROM dirty WHERE {c}" for k, c in _FINDINGS_SQL.items()]))
def contact_report(spark, sf):
    from ..operators import report as R
    return R.contact_report(dirty(spark, sf), _REPORT_FIELDS, R.contact_findings(), scope=F.col("current_opt_in") == "Yes")


@register("contact_findings", oracle_with("dirty") + "\nUNION ALL ".join(
    f"SELECT c_custkey, fname, lname, email, '{k}' AS finding FROM dirty WHERE {c}" for k, c in _FINDINGS_SQL.items()))
def contact_findings(spark, sf):
    from ..operators import report as R
    return R.finding_rows(dirty(spark, sf), ["c_custkey", "fname", "lname", "email"], R.contact_findings())


# ----------------------------------------------------------------------------- N22

@register("quality_bucket", oracle_with("dirty") + """
SELECT c_custkey, CASE
  WHEN (coalesce(lname, '') = '' OR lower(trim(lname)) = 'deleted') AND coalesce(email, '') = '' AND coalesce(fname, '') = ''
       AND coalesce(cell_phone, '') = '' AND coalesce(country, '') = '' AND coalesce(birth_text, '') = '' THEN '1_no_personal_data'
  WHEN coalesce(lname, '') <> '' AND lower(trim(lname)) <> 'deleted' AND coalesce(email, '') <> '' THEN '2_has_lastname_and_email'
  ELSE '3_partial_data' END AS bucket
FROM dirty""")
def quality_bucket(spark, sf):
    d = dirty(spark, sf)
    return d.select("c_custkey", N.quality_bucket("lname", "email", "fname", "cell_phone", "country", "birth_text").alias("bucket"))


# ----------------------------------------------------------------------------- N21 F12 F26

PRIORITY_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}


def status_code_from_letter(c):
    """Proxy: order status letters as reservation status codes."""
    c = F.col(c)
    return F.when(c == "F", "CHECKEDOUT").when(c == "O", "INHOUSE").when(c == "P", "CONFIRMED")


@register("status_maps", f"""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'CHECKEDOUT' WHEN 'O' THEN 'INHOUSE' WHEN 'P' THEN 'CONFIRMED' END AS status_code,
  CASE CASE o_orderstatus WHEN 'F' THEN 'CHECKEDOUT' WHEN 'O' THEN 'INHOUSE' WHEN 'P' THEN 'CONFIRMED' END
    {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in RESERVATION_STATUS_LABELS.items())} END AS status_label,
  CASE o_orderpriority {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PRIORITY_LABELS.items())} END AS priority_none,
  CASE o_orderpriority {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PRIORITY_LABELS.items())}
    ELSE trim(o_orderpriority) END AS priority_keep
FROM orders""")
def status_maps(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    code = status_code_from_letter("o_orderstatus")
    return o.select("o_orderkey", code.alias("status_code"),
                    X.map_codes(code, RESERVATION_STATUS_LABELS, "none").alias("status_label"),
                    X.map_codes("o_orderpriority", PRIORITY_LABELS, "none").alias("priority_none"),
                    X.map_codes("o_orderpriority", PRIORITY_LABELS, "keep").alias("priority_keep"))


# ----------------------------------------------------------------------------- F1 F3 F4 F5 F7 F9 F10 F29

COUNTRY_NAMES = {"AT": "Austria", "HR": "Croatia", "UK": "United Kingdom"}


@register("scalar_text", oracle_with("dirty") + f"""
SELECT c_custkey, upper(fname) AS fname_upper, lower(lname) AS lname_lower,
  coalesce(fname, lname, 'n/a') AS any_name, concat_ws('', fname, ' ', lname) AS full_name_raw,
  CASE WHEN fname IS NULL OR lname IS NULL THEN NULL ELSE fname || ' ' || lname END AS full_name,
  replace(salutation, '.', '') AS salutation_nodot, replace(lname, chr(160), '') AS lname_nbsp,
  left(email, 5) AS email_head, substring(email, 2, 3) AS email_mid,
  regexp_replace(cell_phone, '[^0-9]', '', 'g') AS phone_digits, hex(fname) AS fname_hex,
  CASE trim(country) {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in COUNTRY_NAMES.items())} END AS country_name
FROM dirty""")
def scalar_text(spark, sf):
    d = dirty(spark, sf)
    return d.select(
        "c_custkey", F.upper("fname").alias("fname_upper"), F.lower("lname").alias("lname_lower"),
        F.coalesce("fname", "lname", F.lit("n/a")).alias("any_name"),
        F.concat_ws("", "fname", F.lit(" "), "lname").alias("full_name_raw"),
        F.concat("fname", F.lit(" "), "lname").alias("full_name"),
        X.remove("salutation", ".").alias("salutation_nodot"), X.remove("lname", "\u00a0").alias("lname_nbsp"),
        F.left("email", F.lit(5)).alias("email_head"), F.substring("email", 2, 3).alias("email_mid"),
        F.regexp_replace("cell_phone", "[^0-9]", "").alias("phone_digits"), F.hex("fname").alias("fname_hex"),
        F.try_element_at(X.literal_map(COUNTRY_NAMES), F.trim("country")).alias("country_name"))


# ----------------------------------------------------------------------------- P3-P8 P10

@register("filters", f"""
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
  AND (o_totalprice > 100000 OR o_custkey < 100)
  AND o_orderdate >= TIMESTAMP '1998-08-02' - INTERVAL 1000 DAY""")
def filters(spark, sf):
    o = table(spark, sf, "orders")
    asof = F.to_timestamp_ntz(F.lit("1998-08-02 00:00:00"))
    cond = (F.col("o_orderdate").between(F.to_timestamp_ntz(F.lit("1996-01-01 00:00:00")),
                                         F.to_timestamp_ntz(F.lit("1996-12-31 00:00:00")))
            & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
            & ((F.col("o_totalprice") > 100000) | (F.col("o_custkey") < 100))
            & (F.col("o_orderdate") >= asof - F.expr("INTERVAL 1000 DAYS")))
    return o.where(cond).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")


@register("filters_text", oracle_with("dirty") + """
SELECT c_custkey, fname, lname, email FROM dirty
WHERE (lname LIKE '%GmbH' OR email LIKE '%\\_%' ESCAPE '\\' OR email LIKE 'u%@%' OR regexp_matches(lname, '^[a-z]+ [a-z]+'))
  AND NOT (fname IS NULL OR trim(fname) = '')""")
def filters_text(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "fname", "lname", "email")
    cond = ((F.col("lname").endswith("GmbH") | F.col("email").contains("_") | F.col("email").like("u%@%")
             | F.col("lname").rlike("^[a-z]+ [a-z]+")) & ~X.is_blank("fname"))
    return d.where(cond)


INFER_MIN_N, INFER_MIN_RATIO = 10, 0.45


@register("infer_gender", oracle_with("dirty") + f"""
, g AS (SELECT n.c_custkey, d.fname,
          CASE WHEN s = 'Mr.' THEN 'Male' WHEN s IN ('Mrs.', 'Ms.', 'Miss.') THEN 'Female' END AS gender
        FROM ({_salutation_sql()}) n JOIN dirty d ON d.c_custkey = n.c_custkey),
known AS (SELECT lower(trim(fname)) AS nm, gender AS val FROM g
          WHERE gender IS NOT NULL AND gender <> '' AND lower(trim(fname)) IS NOT NULL),
v AS (SELECT nm, val, count(*) AS n_val FROM known GROUP BY 1, 2),
k AS (SELECT nm, sum(n_val) AS n_key FROM v GROUP BY 1),
top AS (SELECT v.*, row_number() OVER (PARTITION BY nm ORDER BY n_val DESC, val) AS rn FROM v),
dom AS (SELECT top.nm, top.val AS dom FROM top JOIN k ON k.nm = top.nm
        WHERE rn = 1 AND n_key >= {INFER_MIN_N} AND round(n_val / n_key, 4) >= {INFER_MIN_RATIO})
SELECT g.c_custkey, g.fname, CASE WHEN g.gender IS NULL OR g.gender = '' THEN dom.dom ELSE g.gender END AS gender
FROM g LEFT JOIN dom ON dom.nm = lower(trim(g.fname))""")
def infer_gender(spark, sf):
    d = dirty(spark, sf).select("c_custkey", "fname", "salutation").withColumn("gender", F.lit(None).cast("string"))
    return N.infer_gender(d, min_n=INFER_MIN_N, min_ratio=INFER_MIN_RATIO).select("c_custkey", "fname", "gender")


@register("infer_salutation", oracle_with("dirty") + """
, s AS (SELECT c_custkey, fname, CASE c_custkey % 11 WHEN 0 THEN 'Herr' WHEN 1 THEN NULL WHEN 2 THEN 'Mrs.' ELSE 'Mr.' END AS salutation,
          CASE WHEN c_custkey % 13 = 0 THEN 'Female' END AS gender, CASE WHEN lname IS NULL THEN 1 ELSE 0 END AS missing_name FROM dirty),
v AS (SELECT lower(trim(fname)) AS nm, salutation AS val, count(*) AS n FROM s
      WHERE fname IS NOT NULL AND missing_name = 0 AND salutation IN ('Mr.', 'Mrs.', 'Ms.') GROUP BY 1, 2),
d AS (SELECT nm, val, row_number() OVER (PARTITION BY nm ORDER BY n DESC, val) AS rn,
        sum(n) OVER (PARTITION BY nm) AS total, round(n / sum(n) OVER (PARTITION BY nm), 4) AS ratio FROM v),
w AS (SELECT nm, val, CASE WHEN val = 'Mr.' THEN 'Male' ELSE 'Female' END AS sex FROM d WHERE rn = 1 AND total >= 10 AND ratio >= 0.8),
j AS (SELECT s.*, w.val, w.sex, s.fname IS NOT NULL AND s.missing_name = 0 AND w.val IS NOT NULL AS hit
      FROM s LEFT JOIN w ON w.nm = lower(trim(s.fname)))
SELECT c_custkey, CASE WHEN hit AND salutation = 'Herr' THEN val ELSE salutation END AS salutation,
  CASE WHEN hit AND salutation IS NOT NULL THEN coalesce(gender, sex) ELSE gender END AS gender FROM j""")
def infer_salutation(spark, sf):
    k = F.col("c_custkey")
    d = dirty(spark, sf).select(
        "c_custkey", "fname", F.when(k % 11 == 0, "Herr").when(k % 11 == 1, None).when(k % 11 == 2, "Mrs.").otherwise("Mr.").alias("salutation"),
        F.when(k % 13 == 0, "Female").alias("gender"), F.when(F.col("lname").isNull(), 1).otherwise(0).alias("missing_name"))
    return N.infer_salutation_and_gender(d, min_n=10, min_ratio=0.8).select("c_custkey", "salutation", "gender")
