"""Join forms of the reference re-expressed as DataFrame joins.

Join strategy is left to Catalyst and AQE: with ``spark.sql.adaptive.enabled``
a side whose *measured* shuffle size is under ``autoBroadcastJoinThreshold``
is broadcast at run time, everything else is a sort-merge join whose skewed
partitions AQE splits.  Explicit ``broadcast`` is used only for code-bounded
lookup tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import key_col
from .keys import pick_one


def join_on(a: DataFrame, b: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]], how: str = "inner",
            extra: Column | None = None, collation: str | None = None) -> DataFrame:
    """Equi join on one or more keys, optionally with a residual predicate.

    ``keys`` are shared column names, or ``(left, right)`` pairs for differing
    names.  A residual such as ``a.x <> b.x`` stays a join condition, so the
    physical join is still keyed.  ``collation`` compares string keys
    case/accent-insensitively (shared key columns then come from ``a``)."""
    pairs = list(keys) if keys and isinstance(keys[0], tuple) else None
    if pairs is None and extra is None and collation is None:
        return a.join(b, list(keys), how)
    pairs = pairs or [(k, k) for k in keys]
    cond = [key_col(a, l_, collation) == key_col(b, r, collation) for l_, r in pairs]
    if extra is not None:
        cond.append(extra)
    out = a.join(b, cond, how)
    shared = [r for l_, r in pairs if l_ == r]
    if shared and how not in ("left_semi", "semi", "left_anti", "anti"):
        out = out.select(*[a[c] for c in a.columns], *[b[c] for c in b.columns if c not in shared])
    return out


def keep_matching(a: DataFrame, b: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
                  collation: str | None = None) -> DataFrame:
    """Rows of ``a`` with at least one match in ``b`` (EXISTS / IN, J6 J7): a
    left-semi join, so matches never multiply rows."""
    return join_on(a, b, keys, "left_semi", collation=collation)


def keep_missing(a: DataFrame, b: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
                 b_filter: Column | None = None, collation: str | None = None) -> DataFrame:
    """Rows of ``a`` without a match in ``b`` (NOT EXISTS, LEFT JOIN .. IS NULL,
    J8-J10).  ``b_filter`` restricts the right side first (J10)."""
    if b_filter is not None:
        b = b.where(b_filter)
    return join_on(a, b, keys, "left_anti", collation=collation)


def interval_join(df: DataFrame, windows: DataFrame, key: str | tuple[str, str], ts: str, lo: str,
                  hi: str | None = None, how: str = "inner") -> DataFrame:
    """Event time inside ``[lo, hi]`` of a window with the same key.

    ``hi`` NULL means open-ended; ``hi=None`` gives a lower-bounded join.  The
    equi key drives the physical join, the range is a residual predicate."""
    lk, rk = (key, key) if isinstance(key, str) else key
    cond = [df[lk] == windows[rk], df[ts] >= windows[lo]]
    if hi is not None:
        cond.append(windows[hi].isNull() | (df[ts] <= windows[hi]))
    return df.join(windows, cond, how)


def lookup_one(df: DataFrame, dim: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Per-row lookup taking exactly one match per key and dropping misses.

    The dimension is reduced to one row per key first (deterministic ``order``),
    so the join cannot multiply rows."""
    return df.join(pick_one(dim, [key], order), key, "inner")


def unmatched_keys(df: DataFrame, dim: DataFrame, key: str | tuple[str, str]) -> DataFrame:
    """Distinct keys of ``df`` that are missing from ``dim`` (guard of J20)."""
    lk, rk = (key, key) if isinstance(key, str) else key
    return (df.select(lk).where(F.col(lk).isNotNull()).distinct()
            .join(dim.select(F.col(rk).alias(lk)), lk, "left_anti"))


def lookup_strict(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup where an unknown key is an error.

    The failure happens inside the query with ``raise_error`` on the first
    unknown, non-NULL key; no driver-side check or collect is needed."""
    d = dim.select(F.col(key).alias("__k"), F.col(value).alias("__v"), F.lit(True).alias("__hit"))
    j = df.join(d, df[key] == d["__k"], "left")
    v = F.when(F.col("__hit") | F.col(key).isNull(), F.col("__v")).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.col(key).cast("string"))))
    return j.withColumn(value, v).drop("__k", "__v", "__hit")


def left_merge(a: DataFrame, b: DataFrame, left_on: str, right_on: str, suffix: str = "_r",
               null_keys_match: bool = False) -> DataFrame:
    """Left join that keeps both sides' columns and suffixes the right side's
    clashing names (J18).  ``null_keys_match=True`` follows pandas ``merge``,
    where a NULL key matches a NULL key; two different NULL-keyed rows on
    the right raise an error, as all pairs of them would be emitted."""
    if null_keys_match:
        from .change import unique_or_raise
        null = F.col(right_on).isNull()
        b = b.where(~null).unionByName(unique_or_raise(b.where(null), [right_on], "left_merge: NULL keys"))
    clash = set(a.columns)
    rb = b.select([F.col(c).alias(c + suffix if c in clash else c) for c in b.columns])
    rk = right_on + suffix if right_on in clash else right_on
    cond = a[left_on].eqNullSafe(rb[rk]) if null_keys_match else (a[left_on] == rb[rk])
    return a.join(rb, cond, "left")


def exists_flag(df: DataFrame, src: DataFrame, pairs: Sequence[tuple[str, str]], out: str,
                collation: str | None = None) -> DataFrame:
    """Add a boolean ``out``: does ``src`` have a row with equal keys (``(df column, src column)`` pairs)?

    ``src`` is reduced to its distinct keys and left-joined, so rows never
    multiply, NULL keys never match, and AQE can split the rows of a hot key (an existence join is not split)."""
    k = src.select(*[key_col(src, r, collation).alias(f"__s{i}") for i, (_, r) in enumerate(pairs)]).distinct()
    k = k.withColumn("__hit", F.lit(True))
    cond = [key_col(df, l_, collation) == k[f"__s{i}"] for i, (l_, _) in enumerate(pairs)]
    return df.join(k, cond, "left").select(*[df[f"`{c}`"] for c in df.columns], F.coalesce("__hit", F.lit(False)).alias(out))


#: A window of a length from 8^k to 8^(k+1) ticks is cut into bins of 8^k ticks.
BIN_BASE = 8


def _ticks(c: Column, kind: T.DataType) -> Column:
    """Whole numbers in the order of a date or time: days, or microseconds."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"windows of {kind.simpleString()} are not supported; cast to a date, time or whole number")


def _common_kind(*kinds: T.DataType) -> T.DataType:
    """The type in which different dates and times are compared."""
    for k in (T.TimestampType, T.TimestampNTZType):
        if any(isinstance(x, k) for x in kinds):
            return k()
    return T.LongType() if all(isinstance(x, T.IntegralType) for x in kinds) else kinds[0]


def _bin(t: Column, size: Column) -> Column:
    """Whole-number division, rounding down."""
    return F.call_function("div", t - F.pmod(t, size), size)


def window_levels(windows: DataFrame, key: str, lo: str, hi: str | None) -> tuple[DataFrame, DataFrame, list[int]]:
    """Windows cut for :func:`flag_in_window`: bins (``__wk``, level, bin, whole, since, until), one row per key, level and
    bin; open windows (``__wk``, since), one row per key; and the levels that occur.

    A window is at least as long as its level's bins, so in every bin that it touches it either covers the whole, or
    starts there and goes on, or has come in and ends there.  So of all windows of a key in a bin only the
    earliest start and the latest end matter: a partial aggregate, however many windows a key has."""
    kind = windows.schema[lo].dataType
    end = F.col(hi) if hi is not None else F.lit(None).cast(kind)
    kind = _common_kind(kind, windows.schema[hi].dataType) if hi is not None else kind
    w = windows.select(F.col(key).alias("__wk"), _ticks(F.col(lo).cast(kind), kind).alias("a"), _ticks(end.cast(kind), kind).alias("b"))
    w = w.where(F.col("__wk").isNotNull() & F.col("a").isNotNull())
    open_ = w.where(F.col("b").isNull()).groupBy("__wk").agg(F.min("a").alias("since"))
    # the level of a length: how often it can be divided by BIN_BASE, in whole numbers (a logarithm would round)
    length = F.col("b") - F.col("a") + 1
    level = sum(((length >= F.lit(BIN_BASE ** k)).cast("int") for k in range(1, 21)), F.lit(0))
    cut = w.where(F.col("b") >= F.col("a")).withColumn("level", level)
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level") * 3)  # BIN_BASE ** level
    cut = cut.withColumn("size", size)
    cut = cut.withColumn("bin", F.explode(F.sequence(_bin(F.col("a"), F.col("size")), _bin(F.col("b"), F.col("size")))))
    first, last = F.col("a") > F.col("bin") * F.col("size"), F.col("b") < (F.col("bin") + 1) * F.col("size") - 1
    bins = cut.groupBy("__wk", "level", "bin").agg(
        F.max(~first & ~last).alias("whole"), F.min(F.when(first, F.col("a"))).alias("since"), F.max(F.when(last, F.col("b"))).alias("until"))
    levels = sorted(r[0] for r in cut.select("level").distinct().collect())  # 21 at most
    return bins, open_, levels


def flag_in_window(df: DataFrame, windows: DataFrame, key: str | tuple[str, str], ts: str, lo: str,
                   hi: str | None, out: str) -> DataFrame:
    """``out`` = 1 when the row's time falls inside any window of its key (both ends included),
    else 0 (R9: J12/J13 + M1).  ``hi`` NULL means an open window; ``hi=None`` a lower bound only.

    The windows are cut into time bins (:func:`window_levels`), and the rows are left-joined to the bin of their
    time once per level of lengths that occurs: equi joins on (key, bin) with at most one partner, so rows never multiply, AQE
    splits the rows of a hot key, and a key may have any number of windows."""
    lk, rk = (key, key) if isinstance(key, str) else key
    kinds = [df.schema[ts].dataType, windows.schema[lo].dataType, *([windows.schema[hi].dataType] if hi is not None else [])]
    kind = _common_kind(*kinds)
    if any(type(k) is not type(kind) for k in kinds[1:]) and not isinstance(kind, T.LongType):
        windows = windows.withColumns({c: F.col(c).cast(kind) for c in (lo, hi) if c})
    bins, open_, levels = window_levels(windows, rk, lo, hi)
    j = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("__row"), df[f"`{lk}`"].alias("__k"),
                  _ticks(df[f"`{ts}`"].cast(kind), kind).alias("__t"))
    j = j.join(open_, j["__k"] == open_["__wk"], "left").select(
        "__row", "__k", "__t", F.coalesce(F.col("__t") >= F.col("since"), F.lit(False)).alias("__in"))
    for level in levels:
        b = bins.where(F.col("level") == level).drop("level")
        size = BIN_BASE ** level
        j = j.withColumn("__bin", _bin(F.col("__t"), F.lit(size)))
        hit = F.coalesce(F.col("whole"), F.lit(False)) | F.coalesce(F.col("__t") >= F.col("since"), F.lit(False)) \
            | F.coalesce(F.col("__t") <= F.col("until"), F.lit(False))
        j = j.join(b, (j["__k"] == b["__wk"]) & (j["__bin"] == b["bin"]), "left").select(
            "__row", "__k", "__t", (F.col("__in") | hit).alias("__in"))
    return j.select(*[F.col(f"__row.`{c}`") for c in df.columns], F.col("__in").cast("int").alias(out))
