"""Cleaning and normalisation of people data.

Column-level rules are plain expressions.  Longer code lists are small
DataFrames joined on the value: the built-in lists are broadcast (their size
is fixed by this module), lists passed in as parameters are sized by AQE.

Comparisons use *intent mode*: explicit ``lower(trim())`` and binary equality
(SURVEY §1.4).  The key operators (joins, semi/anti joins, grouping, pick-one,
duplicates, flags) take ``collation="UTF8_LCASE"`` or ``"UNICODE_CI_AI"`` for
the case/accent-insensitive comparison of the original tables instead.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import after_last, any_of, blank_to_null, col, is_blank, let

# =============================================================================
# Fixed values.  These must equal the reference's lists for equal results;
# they are stated here once, in natural order, as data.
# =============================================================================

#: Salutation pass 1: key = upper(trim(value without dots)).
SALUTATION_PASS1 = {
    "Mr.": ["MR", "MISTER", "SR", "SIR"],
    "Mrs.": ["MRS", "MISSUS", "MISSIS"],
    "Ms.": ["MS", "MZ"],
    "Miss": ["MISS"],
    "Dr.": ["DR", "DOCTOR", "DOC"],
    "Prof.": ["PROF", "PROFESSOR"],
    "Rev.": ["REV", "REVEREND", "REVD"],
}
#: Placeholder salutations (compared upper-cased and trimmed) -> NULL.
SALUTATION_GARBAGE = ["N/A", "NA", "NONE", "NULL", "TEST", "XXX", "-", "."]

#: Salutation pass 2, in order: ``(result, kind, values)`` on the trimmed
#: value; ``kind`` "in" = exact match, "prefix" = starts with (``LIKE 'p%'``);
#: ``None`` = NULL.  (One named opener of the original list is left out: it
#: holds a person's name.)
SALUTATION_RULES = [
    ("Mr", "in", ["Mr.", "Mr", "Mister", "Sir", "Sr"]),
    ("Mr", "in", ["Herr", "Herrn", "Herr ", "herrn"]),
    ("Mr", "in", ["Signore", "Signor", "Sig."]),
    ("Mr", "in", ["Gospodin", "Gdin", "gospodine"]),
    ("Mr", "in", ["Pán", "Pan"]),
    ("Mr", "in", ["Monsieur", "M."]),
    ("Mrs", "in", ["Mrs.", "Mrs", "Missus"]),
    ("Mrs", "in", ["Frau", "Frau "]),
    ("Mrs", "in", ["Signora", "Sig.ra"]),
    ("Mrs", "in", ["Gospoda", "Gospođa", "Gđa", "Gđa.", "Gospdja", "Gospodja", "Gda"]),
    ("Mrs", "in", ["Pani"]),
    ("Mrs", "in", ["Madame", "Mme", "Mme."]),
    ("Ms", "in", ["Ms.", "Ms", "Mz"]),
    ("Miss", "in", ["Miss", "Miss."]),
    ("Miss", "in", ["Signorina"]),
    ("Miss", "in", ["Gospodica", "Gospodjica", "Gospođica"]),
    ("Dr", "in", ["Dr.", "Dr", "Doctor", "Dott.", "Dott"]),
    ("Prof", "in", ["Prof.", "Prof", "Professor"]),
    ("Ing", "in", ["Ing.", "Ing", "DI", "D.I.", "Pan Ing."]),
    ("Mag", "in", ["Mag.", "Mag"]),
    ("Family", "in", ["Family", "Familie", "Obitelj", "Famiglia", "Rodina"]),
    ("Family", "prefix", ["Dear Famil"]),
    ("Family", "prefix", ["Gentile Fa"]),
    ("Dr", "in", ["Herr Dr.", "Herr Dr"]),
    ("Dr", "in", ["Frau Dr.", "Frau Dr"]),
    ("Prof", "in", ["Herr Prof.", "Herr Prof"]),
    ("Mag", "in", ["Herr Mag.", "Herr Mag", "Frau Mag.", "Frau Mag"]),
    ("Ing", "in", ["Herr Ing.", "Herr Ing", "Herr DI", "Herr D.I."]),
    (None, "in", ["Ladies and Gentlemen", "Ladies and", "Sirs", "Sehr geehr", "Liebe", "Lieber", "Liebe Anna",
                  "Lieber Max", "Poštovani", "Poštovana", "Egregio Si", "Egregia Si", "Gentile Si", "G.", "CHD"]),
]
#: "Dear ..." pass: (regex, result) in order; last rule turns any other "Dear " into NULL.
SALUTATION_DEAR = [
    (r"^Dear Mrs\.?\s?", "Mrs"),
    (r"^Dear Ms\.?\s?", "Ms"),
    (r"^Dear Miss\.?", "Miss"),
    (r"^Dear Dr\.?\s?", "Dr"),
    (r"^Dear Prof\.?\s?", "Prof"),
    (r"^Dear Famil", "Family"),
]
SALUTATION_DOTTED = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Ing", "Mag"]

#: Name placeholders (lower(trim())) -> NULL.
FNAME_PLACEHOLDERS = ["test", "unknown", "n/a", "none", "na", "null", "xxx",
                      "first", "firstname", "first name", "-", "."]
LNAME_PLACEHOLDERS = ["test", "unknown", "n/a", "none", "na", "null", "xxx",
                      "last", "lastname", "last name", "-", "."]

#: Bounce markers (lower(trim())).
BOUNCE_VALUES = ["1", "true", "yes", "y", "hard", "soft", "bounce"]
BOUNCE_FLAG_VALUES = ["1", "true", "yes", "y", "bounced"]
#: Disposable / throw-away mail domains.
DISPOSABLE_DOMAINS = [
    "mailinator.com", "guerrillamail.com", "tempmail.com", "throwaway.email", "yopmail.com",
    "trashmail.com", "sharklasers.com", "guerrillamailblock.com", "dispostable.com",
    "fakeinbox.com", "maildrop.cc", "spamgourmet.com", "mytemp.email", "temp-mail.org", "throwam.com",
]
#: Last names that are no names.
ODD_LAST_NAMES = ["..", ",s", "^rudy", "´"]
#: Relay domains of booking channels (addresses are not the guest's own).
RELAY_DOMAINS = ["guest.booking.com", "m.expediapartnercentral.com"]
#: Role / no-reply local parts that are suppressed.
NOREPLY_LOCAL_PARTS = ["spam", "noreply", "no-reply", "donotreply", "do-not-reply"]
#: E-mail shapes: the loose one of the cleaning step; in the delivery step that of the check
#: and that of the flag statement.
EMAIL_LOOSE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
EMAIL_CHECK = r"^[^@\s,]+@[^@\s]+\.[^@\s]{2,}$"
EMAIL_FLAG = r"^[a-z0-9._+-]+@[a-z0-9.-]+\.[a-z]{2,}$"

#: Phone: characters kept, and placeholder digit strings.
PHONE_DROP_CHARS = r"[^0-9+\-().\s]"
PHONE_PLACEHOLDERS = ["0000000000", "1111111111", "9999999999", "1234567890", "0123456789"]

#: Scripts whose presence in a name suppresses the e-mail.
NON_LATIN_SCRIPTS = ["Han", "Hangul", "Arabic", "Hebrew", "Cyrillic", "Armenian", "Myanmar"]
#: Characters that betray UTF-8 read as Latin-1/CP437.
MOJIBAKE_MARKERS = "├│┬┐┘╜╗╛»«"

#: Country spellings -> ISO-2 (``None`` = unresolvable).  Default table; the
#: full production list is a parameter (``normalise_country(..., variants=df)``).
COUNTRY_VARIANTS = {
    "D": "DE", "Deutschland": "DE", "Oesterreich": "AT", "Österreich": "AT", "Schweiz": "CH",
    "UK": "GB", "Great Britain and No": "GB", "Croatia": "HR", "Hrvatska": "HR", "Croaria": "HR",
    "Czechia": "CZ", "CS": "CZ", "Serbia": "RS", "SRB": "RS", "YU": None, "UAE": "AE",
    "Kosovo": "XK", "KV": "XK", "XK": "XK", "Montenegro": "ME", "Bosnia": "BA", "România": "RO",
    "Nederland": "NL", "Denmark.": "DK", "Norge": "NO", "Slovak Republic": "SK",
    "Moldova, Republic of": "MD", "Korea (the Republic": "KR", "KOREA NTH": "KR",
    "Syrian Arab Republic": "SY", "CURACAO": "CW", "SAINT MARTIN": "MF", "SAINT BARTHELEMY": "BL",
    "TP": "TL", "RA": "AR", "Salzburg": None, "XX": None, "Q": None, "0": None, "default": None,
    "Auswaehlen": None, "UNKNOWN": None, "en": None, "pravi klik": None, "Other Africa": None,
    "yOther Africa": None, "Other Foreign Countr": None,
}

#: Language codes accepted as is (lower-cased); anything else gets the default.
LANGUAGES_ALLOWED = ["hr", "cz", "sk", "nl", "fr", "de", "en"]

# =============================================================================
# Column rules
# =============================================================================


def _in(c: Column, values: Iterable[str]) -> Column:
    return c.isin(list(values))


def trim_all(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim every listed text column and turn blanks into NULL."""
    cols = list(cols)
    return df.withColumns({c: blank_to_null(c) for c in cols})


def normalise_email(df: DataFrame, email: str = "email", domain: str = "domain") -> DataFrame:
    """Lower-case (and trim) the address and rebuild the domain from it."""
    e = F.lower(F.trim(F.col(email)))
    return df.withColumns({email: e, domain: after_last(e, "@")})


def salutation_pass1(c: Column) -> Column:
    key = F.upper(F.trim(F.replace(c, F.lit("."), F.lit(""))))
    out = F.when(F.lit(False), F.lit(None))
    for canon, keys in SALUTATION_PASS1.items():
        out = out.when(_in(key, keys), F.lit(canon))
    out = out.when(_in(F.upper(F.trim(c)), SALUTATION_GARBAGE), F.lit(None).cast("string"))
    return out.otherwise(c)


def salutation_pass2(c: Column) -> Column:
    t = F.trim(c)
    out = F.when(F.lit(False), F.lit(None))
    for result, kind, values in SALUTATION_RULES:
        low = [v.lower() for v in values]
        hit = _in(F.lower(t), low) if kind == "in" else any_of(F.lower(t).startswith(v) for v in low)
        out = out.when(hit, F.lit(result).cast("string"))
    out = out.when(_in(F.upper(t), SALUTATION_GARBAGE), F.lit(None).cast("string"))
    return out.otherwise(c)


def salutation_dear(c: Column) -> Column:
    out = F.when(~c.ilike("Dear %"), c)
    out = out.when(c.rlike(r"(?i)^Dear Mr[s]?\.?\s") & ~c.rlike("(?i)Mrs"), F.lit("Mr"))
    for pat, res in SALUTATION_DEAR:
        out = out.when(c.rlike("(?i)" + pat), F.lit(res))
    return out.otherwise(F.lit(None).cast("string"))


def salutation_german(c: Column) -> Column:
    return (F.when(c.rlike(r"(?i)^Sehr geehrter Herr "), F.lit("Mr."))
            .when(c.rlike(r"(?i)^Sehr geehrte Frau "), F.lit("Mrs."))
            .when(c.rlike(r"(?i)^Lieber "), F.lit("Mr."))
            .when(c.rlike(r"(?i)^Liebe "), F.lit("Mrs."))
            .otherwise(c))


def salutation_redot(c: Column) -> Column:
    return (F.when(_in(F.lower(c), [x.lower() for x in SALUTATION_DOTTED]), F.concat(c, F.lit(".")))
            .when(F.lower(c) == "sig.na", F.lit("Mrs."))
            .otherwise(c))


SALUTATION_PASSES = [salutation_pass1, salutation_pass2, salutation_dear, salutation_german, salutation_redot]


def normalise_salutation(df: DataFrame, c: str = "salutation", out: str | None = None,
                         per_row: bool = False) -> DataFrame:
    """Salutation canonicaliser (N4): the passes of the cleaning script run in
    order (dot-stripped match, multilingual exact map, "Dear ..." and German
    openers, re-dotting).

    A salutation column holds few distinct values, so by default the rule
    chain runs once per *distinct* value (a partial aggregation of one
    column) and the mapping is joined back on the raw value, NULL-safely; AQE
    broadcasts it after measuring its size.  Per row that is one hash probe
    instead of some thirty string tests (three times faster at sf0.1, and the
    gap grows with the data).  ``per_row=True`` evaluates the chain on every
    row instead, for a column with many distinct values."""
    out = out or c
    if per_row:
        return df.withColumn(out, _salutation_for(df.sparkSession, c))
    vals = df.select(F.col(c).alias("__sal_raw")).distinct()
    mapping = vals.withColumn("__sal_norm", _salutation_for(df.sparkSession, "__sal_raw"))
    j = df.join(mapping, df[c].eqNullSafe(mapping["__sal_raw"]), "left")
    cols = [F.col("__sal_norm").alias(out) if x == out else df[x] for x in df.columns]
    if out not in df.columns:
        cols.append(F.col("__sal_norm").alias(out))
    return j.select(*cols)


_SALUTATION_CACHE: dict = {}


def _salutation_for(spark: SparkSession, name: str) -> Column:
    # building the rule expression costs a few hundred JVM calls; it is a pure
    # expression over one column, so it is built once per context and name
    sc = spark.sparkContext
    hit = _SALUTATION_CACHE.get(name)
    if hit is None or hit[0] is not sc:
        hit = _SALUTATION_CACHE[name] = (sc, salutation_expr(F.col(name)))
    return hit[1]


def salutation_expr(c: Column) -> Column:
    """The salutation passes as one column expression; each pass binds its
    input once (:func:`~guestfold.functions.columns.let`), so the expression
    stays linear in the number of passes however it is inlined later."""
    for p in SALUTATION_PASSES:
        c = let(c, p)
    return c


def gender_from_salutation(df: DataFrame, salutation: str = "salutation", gender: str = "gender") -> DataFrame:
    """Fill an empty gender from a canonical salutation."""
    s, g = F.col(salutation), F.col(gender)
    derived = F.when(s == "Mr.", F.lit("Male")).when(s.isin("Mrs.", "Ms.", "Miss."), F.lit("Female"))
    return df.withColumn(gender, F.when((g.isNull() | (g == "")) & derived.isNotNull(), derived).otherwise(g))


def null_placeholders(c: ColumnOrName, words: Iterable[str]) -> Column:
    """Placeholder names to NULL."""
    c = col(c)
    return F.when(_in(F.lower(F.trim(c)), words), F.lit(None).cast("string")).otherwise(c)


def has_script(c: ColumnOrName, scripts: Iterable[str] = NON_LATIN_SCRIPTS) -> Column:
    """True when the text holds a character of one of the scripts."""
    pat = "|".join(rf"\p{{Is{s}}}" for s in scripts)
    return col(c).rlike(pat)


def missing_name_rules(fname: ColumnOrName = "fname", lname: ColumnOrName = "lname") -> list[tuple[str, Column]]:
    """Ordered reasons that make a name unusable for a person record."""
    f, l_ = col(fname), col(lname)
    lf, ll = F.lower(f), F.lower(l_)
    return [
        ("no_last_name", is_blank(l_)),
        ("one_char_last_name", F.char_length(F.trim(l_)) == 1),
        ("company_last_name", (f.isNull() & ll.contains("gmbh")) | ll.contains("gesmbh")),
        ("underscore", l_.contains("_")),
        ("question_marks", l_.contains("??") | l_.contains("\ufffd")),
        ("digits_and_letters", ll.rlike("^[0-9]+[a-z]+$") & (F.octet_length(l_) >= 8)),
        ("odd_mark", l_.isin(ODD_LAST_NAMES)),
        ("dash_only", l_.isin("----", "­")),
        ("temp_profile", lf.like("%_temporär%") | (l_ == "_temporaryProfile")),
        ("double_at", f.contains("@@") | l_.contains("@@")),
        ("url", f.contains("Http://") | l_.contains("Http://")),
    ]


def email_exclusion_rules(email: ColumnOrName = "email", domain: ColumnOrName | None = None,
                          bounce: ColumnOrName | None = "bounce",
                          fname: ColumnOrName | None = "fname",
                          lname: ColumnOrName | None = "lname",
                          bounce_flag: ColumnOrName | None = None,
                          own_names: Iterable[str] = ()) -> list[tuple[str, Column]]:
    """Ordered suppression reasons for an e-mail address.

    ``bounce_flag``: a second bounce column with its own markers.  ``own_names``: lower-case parts of
    last names that mark the company's own profiles."""
    e = col(email)
    el = F.lower(F.trim(e))
    d = col(domain) if domain is not None else F.substring_index(el, "@", -1)
    rules: list[tuple[str, Column]] = [("no_email", is_blank(e))]
    if bounce is not None:
        rules.append(("bounce", _in(F.lower(F.trim(col(bounce))), BOUNCE_VALUES)))
    if bounce_flag is not None:
        rules.append(("bounce_flag", _in(F.lower(F.trim(col(bounce_flag))), BOUNCE_FLAG_VALUES)))
    rules += [
        ("malformed", ~el.rlike(EMAIL_LOOSE) | el.contains(" ") | el.contains("..") | ~el.contains("@")),
        ("disposable_domain", _in(F.lower(d), DISPOSABLE_DOMAINS)),
        ("relay_domain", _in(F.lower(d), RELAY_DOMAINS)),
        ("no_reply", el.rlike("^(" + "|".join(NOREPLY_LOCAL_PARTS) + ")@")),
    ]
    if fname is not None:
        fl = F.lower(col(fname))
        rules.append(("test_marker", fl.contains("test") | fl.contains("booking")))
        rules.append(("temporary_profile", fl.like("%_temporär%")))
    if lname is not None and own_names:
        rules.append(("own_company", any_of(F.lower(col(lname)).contains(x) for x in own_names)))
    if lname is not None:
        rules.append(("non_latin_name", has_script(lname)))
    if lname is not None and fname is not None:
        rules.append(("travel_agency", col(fname).isNull() & F.lower(col(lname)).contains("travel")))
    return rules


#: Fixed value: shape of an e-mail address inside free text.
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def extract_emails(df: DataFrame, text: str, keep: Iterable[str] = (), out: str = "email") -> DataFrame:
    """Every e-mail address in a text column, one row each (whole texts).

    Texts without ``@`` cannot hold an address, so a plain ``contains`` test
    (cheap, no regex engine) filters them out before the regex runs; at sf0.1
    that removes 98 % of the documents and cuts the time tenfold."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(EMAIL_IN_TEXT), 0)).alias(out)
    return df.where(F.col(text).contains("@")).select(*keep, found)


def email_invalid(c: ColumnOrName, level: str = "flag") -> tuple[Column, Column]:
    """E-mail validity (N14): ``(is_invalid, reason)``.

    An address is ``malformed`` when it misses the level's shape (``flag``: the flag statement's, in
    lower case; ``check``: the wider one of the check before it; ``loose``: the cleaning step's), starts
    with a dot, has a dot beside the ``@``, two dots in a row or a second ``@``.  NULL and blank
    input is not judged (false, no reason); other input is judged untrimmed."""
    e = col(c)
    pattern = {"flag": EMAIL_FLAG, "check": EMAIL_CHECK, "loose": EMAIL_LOOSE}[level]
    bad = (~F.lower(e).rlike(pattern) | e.startswith(".") | e.contains(".@") | e.contains("@.") | e.contains("..")
           | e.like("%@%@%"))
    invalid = F.coalesce((F.trim(e) != "") & bad, F.lit(False))
    return invalid, F.when(invalid, F.lit("malformed"))


def clean_phone(c: ColumnOrName) -> Column:
    """Keep digits and ``+-(). `` and blanks; empty and placeholder numbers -> NULL."""
    kept = F.nullif(F.regexp_replace(F.trim(col(c)), PHONE_DROP_CHARS, ""), F.lit(""))
    digits = F.regexp_replace(kept, "[^0-9]", "")
    return F.when(_in(digits, PHONE_PLACEHOLDERS), F.lit(None).cast("string")).otherwise(kept)


def first_phone(*numbers: ColumnOrName) -> Column:
    """The first known number, e.g. of cell, home and office phone."""
    return F.coalesce(*[col(n) for n in numbers])


def bound_birthdate(c: ColumnOrName, as_of: str, oldest: str = "1800-01-01",
                    sentinels: Iterable[str] = ("1900-01-01",)) -> Column:
    """Birth date sanity (N18): sentinel values, dates after ``as_of`` and dates
    before ``oldest`` become NULL."""
    d = col(c)
    bad = (d.isin([F.to_date(F.lit(s)) for s in sentinels]) | (d > F.to_date(F.lit(as_of)))
           | (d < F.to_date(F.lit(oldest))))
    return F.when(bad, F.lit(None).cast("date")).otherwise(d)


def repair_encoding(c: ColumnOrName, markers: str = MOJIBAKE_MARKERS, right: str = "UTF-8") -> Column:
    """Undo a mis-decoding where marker characters betray it.

    Text with a marker is written as Latin-1, where characters that Latin-1 lacks
    become ``?`` as in the statement's conversion, and its bytes are read as
    ``right``.  Bytes that are no valid UTF-8 leave the text as it is."""
    c = col(c)
    raw = F.encode(F.when(c.rlike("[" + markers + "]"), F.regexp_replace(c, r"[^\x00-\xFF]", "?")), "ISO-8859-1")
    fixed = F.when(F.is_valid_utf8(raw), F.decode(raw, right)) if right.upper() in ("UTF-8", "UTF8") \
        else F.decode(raw, right)
    return F.coalesce(fixed, c)


def normalise_language(c: ColumnOrName, allowed: Iterable[str] = LANGUAGES_ALLOWED,
                       default: str = "en") -> Column:
    """Lower-cased code when whitelisted, else the default."""
    lc = F.lower(F.trim(col(c)))
    return F.when(_in(lc, allowed), lc).otherwise(F.lit(default))


#: Language names and their codes.
LANGUAGE_NAMES = {"German": "de", "English": "en", "Italian": "it"}


def language_from_name(c: ColumnOrName) -> Column:
    """Code of a language name, whatever its letter case; unknown names are NULL."""
    return F.coalesce(*[F.when(F.lower(col(c)) == k.lower(), F.lit(v)) for k, v in LANGUAGE_NAMES.items()])


def code_table(spark: SparkSession, mapping: Mapping[str, str | None], key: str = "variant",
               value: str = "code") -> DataFrame:
    """A mapping as a two-column DataFrame (keys unique by construction)."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], f"{key} string, {value} string")


def normalise_country(df: DataFrame, c: str = "country", variants: DataFrame | None = None,
                      out: str | None = None) -> DataFrame:
    """Country to ISO-2 (N7, and N8 with a citizenship table).

    ``variants`` (``variant``, ``code``, optional ``rank``) is joined on the
    trimmed value, whatever its letter case; one row per variant is kept (the lowest ``rank``, i.e. the
    first rule, when given, then the least code), so the join never multiplies rows.  A
    listed variant gives its code (NULL = unresolvable); otherwise a trimmed
    two-letter upper-case value passes; anything else is kept for review.
    """
    out = out or c
    builtin = variants is None
    if builtin:  # its keys are unique in lower case too (a test holds that)
        variants = code_table(df.sparkSession, COUNTRY_VARIANTS).withColumn("variant", F.lower("variant"))
    else:
        from ..operators.keys import pick_one
        rank = ["rank"] if "rank" in variants.columns else []
        variants = pick_one(variants.withColumn("variant", F.lower(F.trim("variant"))), ["variant"], [*rank, "code"])
    v = variants.select(F.col("variant").alias("__v"), F.col("code").alias("__code"), F.lit(True).alias("__hit"))
    # the built-in list has a size fixed by this module: broadcast it; a table
    # passed in is sized by AQE at run time (broadcast only under the threshold)
    t = F.trim(F.col(c))
    j = df.join(F.broadcast(v) if builtin else v, F.lower(t) == F.col("__v"), "left")
    res = (F.when(F.col("__hit"), F.col("__code"))
           .when(t.rlike("^[A-Z]{2}$"), t)
           .otherwise(F.col(c)))
    return j.withColumn(out, res).drop("__v", "__code", "__hit")


def review_codes(df: DataFrame, c: str) -> DataFrame:
    """Values that are still not two upper-case letters, with counts."""
    return (df.where(F.col(c).isNotNull() & ~F.col(c).rlike("^[A-Z]{2}$"))
            .groupBy(F.col(c).alias("remaining_value")).agg(F.count("*").alias("cnt")))


#: A last name that marks a deleted guest, and the bucket labels.
DELETED_NAME = "deleted"
QUALITY_BUCKETS = ("1_no_personal_data", "2_has_lastname_and_email", "3_partial_data")


def quality_bucket(last_name: ColumnOrName, email: ColumnOrName, *others: ColumnOrName) -> Column:
    """Data-quality bucket (N22): no personal data when last name, e-mail and all
    ``others`` (first and middle name, salutation, gender, birth date, phone, address parts, country,
    nationality) are NULL or empty; enough with last name and e-mail; else partial.
    The deleted-guest marker is no last name."""
    empty = lambda x: F.coalesce(col(x).cast("string"), F.lit("")) == ""
    no_name = empty(last_name) | F.coalesce(F.lower(F.trim(col(last_name))) == DELETED_NAME, F.lit(False))
    nothing = no_name & empty(email)
    for x in others:
        nothing = nothing & empty(x)
    none, enough, partial = QUALITY_BUCKETS
    return F.when(nothing, F.lit(none)).when(~no_name & ~empty(email), F.lit(enough)).otherwise(F.lit(partial))


ColumnOrName = Column | str


def infer_from_name(df: DataFrame, name: str, attr: str, min_n: int, min_ratio: float,
                    out: str | None = None, weight: str | None = None) -> DataFrame:
    """Infer an attribute (gender, salutation) from the first name (N6): per
    normalised name the dominant known value with at least ``min_n`` rows and
    ``min_ratio`` share (W4), applied only where the attribute is empty (M2).
    With ``weight`` a row stands for that many."""
    from ..operators.keys import dominant
    out = out or attr
    key = F.lower(F.trim(F.col(name)))
    known = df.select(key.alias("__name"), F.col(attr).alias("__val"), *([F.col(weight).alias("__w")] if weight else [])).where(
        F.col("__val").isNotNull() & (F.col("__val") != ""))
    if weight:
        # both the total and the most frequent value (ties: the least) of a name, by one aggregate
        per_val = known.where(F.col("__name").isNotNull()).groupBy("__name", "__val").agg(F.sum("__w").alias("n_val"))
        best = per_val.groupBy("__name").agg(F.sum("n_val").alias("n_key"), F.min(F.struct((-F.col("n_val")).alias("n"), F.col("__val").alias("v"))).alias("top"))
        dom = best.where((F.col("n_key") >= min_n) & (F.round(-F.col("top.n") / F.col("n_key"), 4) >= min_ratio)).select("__name", F.col("top.v").alias("__dom"))
    else:
        dom = dominant(known, "__name", "__val", min_n, min_ratio).select("__name", F.col("__val").alias("__dom"))
    j = df.join(dom, key == dom["__name"], "left")
    empty = F.col(attr).isNull() | (F.col(attr) == "")
    return j.withColumn(out, F.when(empty, F.col("__dom")).otherwise(F.col(attr))).drop("__name", "__dom")


def infer_gender(df: DataFrame, name: str = "fname", salutation: str = "salutation", gender: str = "gender",
                 min_n: int = 10, min_ratio: float = 0.45) -> DataFrame:
    """Canonical salutation (N4), gender from it (N5) and, where that is empty, from the first name (N6), in one go.

    The answer depends on (name, salutation, gender) alone, so rows are first counted per such triple: all rules run on the
    distinct triples, the dominant gender of a name is found from their counts, and one NULL-safe join gives the answers
    back to the rows.  Equal to :func:`normalise_salutation`, :func:`gender_from_salutation` and :func:`infer_from_name` in a row."""
    keys = [name, salutation, gender]
    raw = df.groupBy(*[F.col(c).alias(f"__r{i}") for i, c in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n"))
    # the rules of a salutation read it many times; it is worked out here, below the exchange of the counts
    seen = raw.select("*", _salutation_for(df.sparkSession, "__r1").alias("__s"), F.col("__r2").alias("__g"))
    seen = gender_from_salutation(seen, "__s", "__g")
    known = infer_from_name(seen, "__r0", "__g", min_n, min_ratio, weight="__n").drop("__n")
    j = df.join(known, [df[c].eqNullSafe(known[f"__r{i}"]) for i, c in enumerate(keys)], "left")
    return j.select(*[F.col("__s").alias(c) if c == salutation else F.col("__g").alias(c) if c == gender else df[c] for c in df.columns])


#: Salutations that names may be learnt from, those that stay, and their gender.
LEARNT_SALUTATIONS = ["Mr.", "Mrs.", "Ms."]
KEPT_SALUTATIONS = ["Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Mx"]
SALUTATION_GENDER = {"Mr.": "Male", "Mrs.": "Female", "Ms.": "Female"}


def infer_salutation_and_gender(df: DataFrame, name: str = "fname", salutation: str = "salutation", gender: str = "gender",
                                missing: ColumnOrName = "missing_name", min_n: int = 50, min_ratio: float = 0.9) -> DataFrame:
    """Salutation and gender from the first name (N6): the dominant salutation of
    a name among complete rows, with at least ``min_n`` rows of that name in all.

    A salutation that is given but not one of ``KEPT_SALUTATIONS`` is replaced, a
    NULL one is not (SQL ``NOT IN``); the gender is filled where it is NULL and the
    salutation is one of the kept ones afterwards.  Rows without a name or marked missing stay."""
    from ..operators.keys import dominant
    key = F.lower(F.trim(F.col(name)))
    usable = F.col(name).isNotNull() & (col(missing) == 0)
    known = df.where(usable & F.col(salutation).isin(LEARNT_SALUTATIONS)).select(key.alias("__name"), F.col(salutation).alias("__val"))
    dom = dominant(known, "__name", "__val", min_n, min_ratio).select("__name", F.col("__val").alias("__dom"))
    j = df.join(dom, key == dom["__name"], "left")
    hit = F.coalesce(usable, F.lit(False)) & F.col("__dom").isNotNull()
    s = F.when(hit & ~F.col(salutation).isin(KEPT_SALUTATIONS), F.col("__dom")).otherwise(F.col(salutation))
    learnt = F.coalesce(*[F.when(F.col("__dom") == k, F.lit(v)) for k, v in SALUTATION_GENDER.items()])
    g = F.when(hit & s.isin(KEPT_SALUTATIONS), F.coalesce(F.col(gender), learnt)).otherwise(F.col(gender))
    return j.withColumns({gender: g, salutation: s}).drop("__name", "__dom")


#: The citizenship list (N8): variant, code (empty: unresolvable) and rank, the number of its rule.
CITIZENSHIPS = Path(__file__).with_name("citizenship.csv")


def citizenship_rules() -> list[tuple[str, str | None, int]]:
    """(variant, code, rank) of :data:`CITIZENSHIPS`; rank 1 holds the codes that pass."""
    with CITIZENSHIPS.open(encoding="utf-8", newline="") as f:
        return [(r["variant"], r["code"] or None, int(r["rank"])) for r in csv.DictReader(f)]


def citizenship_table(spark: SparkSession) -> DataFrame:
    """The citizenship list as a DataFrame (a key may have several ranks)."""
    return spark.createDataFrame(citizenship_rules(), "variant string, code string, rank int")


def normalise_citizenship(df: DataFrame, table: DataFrame | None = None, c: str = "citizenship", out: str | None = None) -> DataFrame:
    """Citizenship to ISO-2 (N8): the country rule with the citizenship code
    list (``variant``, ``code``, ``rank``): the lowest rank per variant wins,
    so a key listed twice keeps its first mapping (SURVEY §8 Q8).  The list is
    a parameter; by default it is :func:`citizenship_table`, whose valid codes come back trimmed in the letter
    case they were given in, and what it lacks (two capital letters too) stays as it is."""
    if table is not None:
        return normalise_country(df, c, variants=table, out=out)
    out = out or c
    passing = [v.lower() for v, _, rank in citizenship_rules() if rank == 1]
    t = F.trim(F.col(c))
    mapped = normalise_country(df.withColumn("__t", t), "__t", variants=citizenship_table(df.sparkSession), out="__mapped")
    listed = F.col("__mapped").isNull() | (F.col("__mapped") != F.col("__t"))
    res = F.when(F.lower(t).isin(passing), t).when(listed, F.col("__mapped")).otherwise(F.col(c))
    return mapped.withColumn(out, res).drop("__t", "__mapped")
