"""Scalar column functions (Column -> Column), all JVM-side built-ins.

Covers the string, date and flag helpers the loaders and SQL scripts use:
blank handling, null-safe equality, ISO renderers for the load files, code-list
lookups and the title-case rule for names.  Nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- blanks

def is_blank(c: ColumnOrName) -> Column:
    """``x IS NULL OR TRIM(x) = ''``."""
    c = col(c)
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(TRIM(x), '')`` (F2)."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def null_to_blank(c: ColumnOrName) -> Column:
    """NULL becomes ``''``: the "clear this field" value of a load file."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def eq_ns(a: ColumnOrName, b: ColumnOrName) -> Column:
    """NULL-safe equality ``a <=> b``."""
    return col(a).eqNullSafe(col(b))


def not_true(cond: Column) -> Column:
    """Rows where ``cond`` is false *or NULL*: the complement used by deletes."""
    return ~F.coalesce(cond, F.lit(False))


# --------------------------------------------------------------------------- text

def remove(c: ColumnOrName, text: str) -> Column:
    """``REPLACE(x, text, '')`` (F5); also used for the non-breaking space."""
    return F.replace(col(c), F.lit(text), F.lit(""))


def before_first(c: ColumnOrName, sep: str) -> Column:
    """``SUBSTRING_INDEX(x, sep, 1)``: the whole string when ``sep`` is absent."""
    return F.substring_index(col(c), sep, 1)


def after_last(c: ColumnOrName, sep: str) -> Column:
    """``SUBSTRING_INDEX(x, sep, -1)``."""
    return F.substring_index(col(c), sep, -1)


def fit(c: ColumnOrName, n: int) -> Column:
    """Cut text to the target field length; an empty result is NULL."""
    return F.nullif(F.left(col(c), F.lit(n)), F.lit(""))


def strip_dot_zero(c: ColumnOrName) -> Column:
    """Drop the ``.0`` a numeric import appends to ids."""
    return F.regexp_replace(col(c), r"\.0$", "")


def title_case(c: ColumnOrName) -> Column:
    """Name title case (N3): lower-case the trimmed text and upper-case the first
    character of the text and of every character that follows a blank, ``-``,
    ``.`` or ``'``.

    ``initcap`` only breaks on blanks, so the text is split *after* each
    separator with a look-behind, each piece gets its first character
    upper-cased and the pieces are joined again.
    """
    parts = F.split(F.lower(F.trim(col(c))), r"(?<=[ .'\-])")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, 2, 1 << 30))),
        "",
    )


def recode(c: ColumnOrName, wrong: str = "ISO-8859-1", right: str = "UTF-8") -> Column:
    """Undo a mis-decoding: encode with the charset that was wrongly applied and
    decode with the right one (F11)."""
    return F.decode(F.encode(col(c), wrong), right)


# --------------------------------------------------------------------------- dates

def nights(arrival: ColumnOrName, departure: ColumnOrName) -> Column:
    """Calendar nights, 0 unless departure is after arrival."""
    a, d = col(arrival), col(departure)
    return F.when(d > a, F.datediff(F.to_date(d), F.to_date(a))).otherwise(F.lit(0))


def parse_date(c: ColumnOrName, fmt: str) -> Column:
    """``STR_TO_DATE``: invalid text gives NULL instead of an error (F16)."""
    return F.try_to_date(col(c), fmt)


def age_years(birth: ColumnOrName, as_of) -> Column:
    """Whole years between ``birth`` and ``as_of`` like ``TIMESTAMPDIFF(YEAR, ..)`` (F17):
    a birthday on 29 Feb counts as reached on 1 Mar in common years."""
    b = F.to_date(col(birth))
    a = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else F.to_date(as_of)
    years = F.year(a) - F.year(b)
    # one year less while the birthday of the as-of year has not come yet
    before_birthday = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return (years - F.when(before_birthday, 1).otherwise(0)).cast("int")


def iso_utc(c: ColumnOrName) -> Column:
    """Timestamp (naive = UTC) or date as ISO-8601 ``...Z`` text.

    Dates render at midnight; the fraction appears only when the microseconds
    are non-zero, as Python's ``isoformat`` does.
    """
    ts = col(c).cast("timestamp_ntz")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None)).otherwise(
        F.concat(base, F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)), F.lit("Z"))
    )


def iso_date(c: ColumnOrName) -> Column:
    """Date-only ISO text ``yyyy-MM-dd``."""
    return F.date_format(col(c).cast("date"), "yyyy-MM-dd")


def year_month(c: ColumnOrName) -> Column:
    """``DATE_FORMAT(x, '%Y-%m')``."""
    return F.date_format(col(c), "yyyy-MM")


def in_day(c: ColumnOrName, day: Column | str) -> Column:
    """Half-open one-day window ``[day, day + 1 day)`` (F18), sargable for pushdown;
    ``day`` is a date text or a timestamp column."""
    d = F.to_timestamp_ntz(F.lit(day)) if isinstance(day, str) else day
    return (col(c) >= d) & (col(c) < d + F.expr("INTERVAL 1 DAY"))


# --------------------------------------------------------------------------- flags / codes

def flag(c: ColumnOrName, null_as: bool | None = None) -> Column:
    """0/1 to boolean; NULL stays NULL unless ``null_as`` is given."""
    b = col(c).cast("boolean")
    return b if null_as is None else F.coalesce(b, F.lit(null_as))


def neutralise_email(c: ColumnOrName, suffix: str = ".inactive") -> Column:
    """Append a suffix so the address cannot receive mail; empty/NULL -> NULL."""
    e = col(c)
    return F.when(F.length(e) > 0, F.concat(e, F.lit(suffix)))


def literal_map(mapping: Mapping[str, str | None]) -> Column:
    """A map literal for a small, code-bounded lookup table."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v).cast("string")]
    return F.create_map(*items)


def map_codes(c: ColumnOrName, mapping: Mapping[str, str], on_unknown: str = "none",
              field: str = "value") -> Column:
    """Code-list mapping (F26).  The lookup is exact: case-sensitive and
    untrimmed.  ``on_unknown``: ``none`` -> NULL, ``keep`` -> trimmed input
    (NULL stays NULL), ``raise`` -> the query fails on the first unknown code.
    """
    c = col(c)
    hit = F.try_element_at(literal_map(mapping), c)
    if on_unknown == "none":
        return hit
    if on_unknown == "keep":
        return F.coalesce(hit, F.trim(c.cast("string")))
    if on_unknown == "raise":
        return F.when(hit.isNotNull() | c.isNull(), hit).otherwise(
            F.raise_error(F.concat(F.lit(f"Unknown code for {field}: "), c.cast("string"))))
    raise ValueError(f"on_unknown must be none, keep or raise, not {on_unknown!r}")


def sparse(m: ColumnOrName) -> Column:
    """Drop NULL-valued entries from a map."""
    return F.map_filter(col(m), lambda k, v: v.isNotNull())


def let(c: ColumnOrName, body) -> Column:
    """Evaluate ``body(x)`` with ``x`` bound to ``c`` once.

    A rule that tests its input many times, applied on top of another such
    rule, makes the expression tree grow multiplicatively when Catalyst inlines
    aliases (e.g. while pushing a filter down through the projections).  Binding
    the input to a lambda variable keeps every stage one reference deep, so a
    chain of stages stays linear in size."""
    return F.element_at(F.transform(F.array(col(c)), body), 1)


def any_of(conds: Iterable[Column]) -> Column:
    out = None
    for cnd in conds:
        cnd = F.coalesce(cnd, F.lit(False))
        out = cnd if out is None else (out | cnd)
    return out if out is not None else F.lit(False)


def first_reason(rules: Iterable[tuple[str, Column]]) -> Column:
    """Ordered rule list -> the first matching reason, NULL when none."""
    return F.coalesce(*[F.when(cond, F.lit(reason)) for reason, cond in rules])


def money_sum(c: ColumnOrName, scale: int = 4) -> Column:
    """Exact sum of money amounts with ``scale`` decimals.

    Amounts are summed as unscaled longs (``amount * 10^scale``), which keeps
    the aggregation buffer a primitive long instead of a wide ``decimal`` (about
    twice as fast), and converted back to ``decimal(38, scale)``.  Overflow
    raises under ANSI mode instead of wrapping."""
    unscaled = (col(c).cast(f"decimal(18,{scale})") * F.lit(10 ** scale)).cast("long")
    return (F.sum(unscaled).cast("decimal(38,0)") / F.lit(10 ** scale)).cast(f"decimal(38,{scale})")


def utc_wall_clock(c: ColumnOrName) -> Column:
    """An instant (``timestamp``) as its UTC wall-clock time (``timestamp_ntz``),
    the same whatever the session time zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col(c).cast("timestamp_ntz"))


def key_col(df, name: str, collation: str | None = None) -> Column:
    """A comparison key of ``df``: the column itself (intent mode), or, for a
    string column, the column under a collation such as ``UTF8_LCASE`` or
    ``UNICODE_CI_AI`` (fidelity mode: case/accent-insensitive equality,
    grouping and joins, SURVEY §1.4)."""
    return collated(df, name, df[name], collation)


def collated(df, name: str, c: Column, collation: str | None) -> Column:
    """``c``, which holds values of ``df``'s column ``name``, as a comparison key (see :func:`key_col`)."""
    from pyspark.sql.types import StringType
    if collation and isinstance(df.schema[name].dataType, StringType):
        return F.collate(c, collation)
    return c
