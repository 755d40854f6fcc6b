"""UPDATE / DELETE / INSERT / upsert re-expressed as pure ``df -> df`` transforms.

Each function returns the new version of the table; writing it is one
separate step (``sources.files.write_table``).  Row counts are preserved by
construction: sources are reduced to one row per key before any join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import collated, eq_ns, key_col, not_true
from .keys import pick_one


def update_where(df: DataFrame, cond: Column, sets: Mapping[str, Column]) -> DataFrame:
    """Conditional ``SET col = expr WHERE cond`` (M1, M13).  Where ``cond`` is
    NULL the row is unchanged, like SQL.  All right-hand sides see the old
    row, as in one UPDATE statement."""
    c = F.coalesce(cond, F.lit(False))
    return df.withColumns({k: F.when(c, v).otherwise(F.col(k)) for k, v in sets.items()})


def unique_or_raise(src: DataFrame, keys: Sequence[str], what: str = "source", collation: str | None = None) -> DataFrame:
    """``src``, whose rows must be unique on ``keys``: equal rows collapse, two
    different rows of one key raise an error (instead of one being picked by
    chance).  One aggregation, so nothing is gathered per key.  Under a ``collation`` keys that it holds equal are
    one key, which is written as the least of them."""
    rest = [c for c in src.columns if c not in keys]
    if collation:
        one = src.groupBy(*[key_col(src, k, collation).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(
            F.min(F.struct(*keys)).alias("__keys"), *([F.min(F.struct(*rest)).alias("__lo"), F.max(F.struct(*rest)).alias("__hi")] if rest else []))
        lo, hi = (F.col("__lo"), F.col("__hi")) if rest else (F.lit(1), F.lit(1))
        row = F.when(lo.eqNullSafe(hi), lo).otherwise(F.raise_error(F.lit(f"{what}: several rows for one key")))
        return one.withColumn("__row", row).select(*[F.col(f"__keys.{c}" if c in keys else f"__row.{c}").alias(c) for c in src.columns])
    one = src.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__lo"), F.max(F.struct(*rest)).alias("__hi")) if rest \
        else src.select(*keys).distinct()
    if not rest:
        return one.select(src.columns)
    same = F.col("__lo").eqNullSafe(F.col("__hi"))
    row = F.when(same, F.col("__lo")).otherwise(F.raise_error(F.lit(f"{what}: several rows for one key")))
    return one.withColumn("__row", row).select(*[F.col(k) if k in keys else F.col(f"__row.{k}").alias(k) for k in src.columns])


def _one_per_key(src: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None, collation: str | None = None) -> DataFrame:
    if order:
        return pick_one(src, keys, order, collation=collation)
    return unique_or_raise(src, keys, collation=collation)


def update_from(df: DataFrame, src: DataFrame, keys: Sequence[str], sets: Mapping[str, Column | str],
                where: Column | None = None, order: Sequence[Column | str] | None = None,
                prefix: str = "src_", collation: str | None = None) -> DataFrame:
    """``UPDATE t JOIN s ON keys SET ...`` (M2).

    ``src`` is first reduced to one row per key (by ``order``; without it the
    source must already be unique), then left-joined, so the row count never
    changes.  In ``sets`` and ``where`` the source columns are named with
    ``prefix``; a row is changed only when it has a match and ``where`` holds.
    ``collation`` compares string keys (see :func:`~guestfold.functions.columns.key_col`), in the reduction too.
    """
    s = _one_per_key(src, keys, order, collation)
    values = [F.col(c).alias(prefix + c) for c in s.columns if c not in keys]
    if collation:
        s = s.select(*[key_col(s, k, collation).alias(f"__k{i}") for i, k in enumerate(keys)], *values, F.lit(True).alias("__matched"))
        j = df.join(s, [key_col(df, k, collation) == s[f"__k{i}"] for i, k in enumerate(keys)], "left")
    else:
        j = df.join(s.select(*keys, *values, F.lit(True).alias("__matched")), list(keys), "left")
    hit = F.coalesce(F.col("__matched"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    upd = {k: F.when(hit, F.col(v) if isinstance(v, str) else v).otherwise(F.col(k)) for k, v in sets.items()}
    return j.withColumns(upd).select(*df.columns)


def fill_from(df: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str] | Mapping[str, str],
              order: Sequence[Column | str] | None = None, where: Column | None = None, collation: str | None = None) -> DataFrame:
    """Fill only missing values from a source (M4): ``coalesce(target, source)``."""
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    sets = {t: F.coalesce(F.col(t), F.col("src_" + s)) for t, s in mapping.items()}
    return update_from(df, src, keys, sets, where=where, order=order, collation=collation)


def flag_exists(df: DataFrame, src: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
                out: str, src_filter: Column | None = None, collation: str | None = None) -> DataFrame:
    """Set ``out`` = 1 when a match exists in ``src``, else 0 (M3, C2): the
    distinct keys of ``src`` are left-joined (:func:`guestfold.operators.joins.exists_flag`)."""
    from .joins import exists_flag
    if src_filter is not None:
        src = src.where(src_filter)
    pairs = list(keys) if keys and isinstance(keys[0], tuple) else [(k, k) for k in keys]
    return exists_flag(df, src, pairs, out, collation).withColumn(out, F.col(out).cast("int"))


def replace_slice(target: DataFrame, new: DataFrame, cond: Column) -> DataFrame:
    """Delete the slice ``cond`` and load the new rows in its place (M5).  Rows
    where ``cond`` is NULL are kept (a DELETE does not touch them)."""
    return target.where(not_true(cond)).unionByName(new, allowMissingColumns=True)


def delete_matching(df: DataFrame, src: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
                    collation: str | None = None) -> DataFrame:
    """``DELETE t FROM t JOIN s`` (M6): an anti join."""
    from .joins import keep_missing
    return keep_missing(df, src, keys, collation=collation)


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], collation: str | None = None) -> DataFrame:
    """``INSERT IGNORE`` (S14): new rows whose key is unseen are appended, one
    per key (the least row by its other columns, so a retry picks the same; under a ``collation`` by its keys as
    they are written after them)."""
    from .joins import keep_missing
    rest = [c for c in new.columns if c not in keys]
    if collation:
        fresh = pick_one(new, keys, [F.col(c) for c in (*rest, *keys)], collation=collation)
    else:
        fresh = pick_one(new, keys, [F.col(c) for c in rest]) if rest else new.distinct()
    fresh = keep_missing(fresh, target.select(*keys), list(keys), collation=collation)
    return target.unionByName(fresh.select(*target.columns))


def changed(cols: Sequence[str], old: str = "t", new: str = "s", like: DataFrame | None = None, collation: str | None = None) -> Column:
    """True when any column differs NULL-safely between two aliased sides (P9).  Under a ``collation``, text
    columns (by their type in ``like``) differ only where it tells them apart."""
    c = F.lit(False)
    for x in cols:
        a, b = F.col(f"{old}.{x}"), F.col(f"{new}.{x}")
        if collation:
            a, b = collated(like, x, a, collation), collated(like, x, b, collation)
        c = c | ~eq_ns(a, b)
    return c


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], as_of: str,
           action_col: str = "action", stamp_col: str = "updated_at", changed_col: str = "is_changed",
           collation: str | None = None) -> DataFrame:
    """Null-safe upsert.

    * key only in ``new``  -> inserted, ``action = 'created'``
    * key in both and any of ``cols`` differs (``<=>``) -> all ``cols`` taken
      from ``new``, stamped with ``as_of``, ``action = 'updated'``
    * key in both, nothing differs -> unchanged, ``action = 'unchanged'``
    * key only in target -> kept, ``action = 'kept'``

    Every other target column stays as it is (and is NULL, or ``new``'s value
    where it has that column, in created rows).  The stamp and the changed flag of
    unchanged and kept rows stay what the target has (NULL and 0 without such
    columns).  One full outer join on the keys; two different ``new`` rows of one
    key raise an error.  ``collation`` compares string keys and the text of ``cols``; a matched row keeps its key
    as the target writes it.
    """
    others = [c for c in target.columns if c not in {*keys, *cols, stamp_col, changed_col}]
    from_new = [c for c in others if c in new.columns]
    new = unique_or_raise(new.select(*keys, *cols, *from_new), keys, "upsert", collation)
    s = new.withColumn("__in_new", F.lit(True)).alias("s")
    t2 = target.withColumn("__in_old", F.lit(True)).alias("t")
    j = t2.join(s, [collated(target, k, F.col(f"t.{k}"), collation) == collated(new, k, F.col(f"s.{k}"), collation) for k in keys], "full")
    in_old = F.coalesce(F.col("t.__in_old"), F.lit(False))
    in_new = F.coalesce(F.col("s.__in_new"), F.lit(False))
    diff = changed(cols, like=new, collation=collation)
    action = (F.when(in_old & in_new & diff, F.lit("updated"))
              .when(in_old & in_new, F.lit("unchanged"))
              .when(in_new, F.lit("created"))
              .otherwise(F.lit("kept")))
    take_new = action.isin("updated", "created")
    out = [F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys]
    out += [F.when(take_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols]
    out += [(F.when(action == "created", F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in from_new
             else F.col(f"t.{c}")).alias(c) for c in others]
    had_stamp = F.col(f"t.{stamp_col}") if stamp_col in target.columns else F.lit(None).cast("timestamp_ntz")
    had_flag = F.coalesce(F.col(f"t.{changed_col}"), F.lit(0)) if changed_col in target.columns else F.lit(0)
    out += [F.when(take_new, F.to_timestamp_ntz(F.lit(as_of))).otherwise(had_stamp).alias(stamp_col),
            F.when(action == "updated", 1).when(action == "created", 0).otherwise(had_flag).cast("int").alias(changed_col),
            action.alias(action_col)]
    return j.select(*out)


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int, out: str = "bucket") -> DataFrame:
    """A bucket number of the keys, for tables that are stored and rewritten by bucket."""
    return df.withColumn(out, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_partitions(path: str, new: DataFrame, keys: Sequence[str], cols: Sequence[str], as_of: str, part: str,
                      stamp_col: str = "updated_at", changed_col: str = "is_changed") -> DataFrame:
    """:func:`upsert` (M8, M9, M5) of a stored table, partitioned by ``part``, that rewrites changed partitions only.

    ``part`` is a column of both sides that the keys decide (a key bucket, see :func:`with_bucket`, or the source of a
    slice that is one of the keys).  A first pass over the keys and ``cols`` of the partitions that ``new`` touches finds those
    with a created or updated row; only they are merged and written, by dynamic partition overwrite, so the files of all others
    stay as they are.  One row per written partition: ``part``, created, updated, kept (unchanged rows included)."""
    spark = new.sparkSession
    target = spark.read.parquet(path)
    touched = [r[0] for r in new.select(part).distinct().collect()]  # as many as the table has partitions at most
    own = target.where(F.col(part).isin(touched)).select(part, *keys, *cols).alias("t")
    s = unique_or_raise(new.select(part, *keys, *cols), keys, "upsert_partitions").alias("s")
    j = s.join(own, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
    fresh = F.col(f"t.{keys[0]}").isNull() | changed(cols)
    written = [r[0] for r in j.where(fresh).select(F.col(f"s.{part}").alias(part)).distinct().collect()]
    merged = upsert(target.where(F.col(part).isin(written)), new.where(F.col(part).isin(written)), keys, [*cols], as_of,
                    stamp_col=stamp_col, changed_col=changed_col)
    seen = Observation()
    counts = [F.count_if(F.col("action") == a).alias(f"n{i}") for i, a in enumerate(("created", "updated"))]
    if written:
        out = merged.observe(seen, *counts).select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns])
        (out.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))
    rows = spark.read.parquet(path).where(F.col(part).isin(written))
    now = F.to_timestamp_ntz(F.lit(as_of))
    stamped = F.coalesce(F.col(stamp_col) == now, F.lit(False))
    if written and seen.get["n0"] + seen.get["n1"] != rows.where(stamped).count():
        raise RuntimeError("upsert_partitions: the stored rows are not those that were counted when they were written")
    return rows.groupBy(part).agg(F.count_if(stamped & (F.col(changed_col) == 0)).alias("created"),
                                  F.count_if(stamped & (F.col(changed_col) == 1)).alias("updated"), F.count_if(~stamped).alias("kept"))


def change_counts(target: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per-column number of changed rows among matched keys, in one pass."""
    j = target.alias("t").join(new.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "inner")
    aggs = [F.count_if(~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))).alias(f"changed_{c}") for c in cols]
    aggs.append(F.count_if(changed(cols)).alias("changed_rows"))
    return j.agg(*aggs)


def version_pairs(target: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str],
                  version_col: str = "version") -> DataFrame:
    """Old and new version of every changed row, one row each (U3): one join,
    then ``explode`` of a two-element array instead of a UNION of two scans."""
    j = target.alias("t").join(new.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "inner") \
        .where(changed(cols))
    old = F.struct(F.lit("old").alias(version_col), *[F.col(f"t.{c}").alias(c) for c in cols])
    nw = F.struct(F.lit("new").alias(version_col), *[F.col(f"s.{c}").alias(c) for c in cols])
    return j.select(*[F.col(f"t.{k}").alias(k) for k in keys], F.explode(F.array(old, nw)).alias("__v")) \
        .select(*keys, "__v.*")


def add_default(df: DataFrame, name: str, value, dtype: str) -> DataFrame:
    """``ALTER TABLE ADD COLUMN .. DEFAULT``."""
    return df.withColumn(name, F.lit(value).cast(dtype))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def cast_col(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Change a column type; text that does not parse becomes NULL (``try_cast``)."""
    return df.withColumn(name, F.col(name).try_cast(dtype))


def split_property(df: DataFrame, pms_id: int, unit_groups: Sequence[str], sets: Mapping[str, object],
                   pms_col: str = "property_pms_id", unit_col: str = "unit_group_code") -> DataFrame:
    """Move a property's reservations of the listed unit groups to another property (R6): ``sets`` gives the other's ids."""
    cond = (F.col(pms_col) == pms_id) & F.col(unit_col).isin(list(unit_groups))
    return update_where(df, cond, {k: F.lit(v).cast(df.schema[k].dataType) for k, v in sets.items()})


def correct_rates(df: DataFrame, corrections: DataFrame, code: str, year: str, month: str, rate: str) -> DataFrame:
    """Correct reference rates by code and period (K12): a correction (``code``, ``year``, ``from_month``, ``rate``)
    holds from its month to the end of its year; of several that fit, the one with the latest month
    counts.  Corrections must be unique by code, year and month.  Rows without one stay.

    They are reduced to one array per code and year, so no row is multiplied."""
    c = unique_or_raise(corrections.select(code, year, "from_month", rate), [code, year, "from_month"], "correct_rates")
    c = c.groupBy(F.col(code).alias("__c"), F.col(year).alias("__y")).agg(
        F.array_sort(F.collect_list(F.struct("from_month", rate))).alias("__fix"))
    j = df.join(c, (df[code] == c["__c"]) & (df[year] == c["__y"]), "left")
    fits = F.filter("__fix", lambda x: x["from_month"] <= F.col(month))
    new = F.when(F.size(fits) > 0, F.element_at(fits, -1)[rate])
    return j.withColumn(rate, F.coalesce(new, F.col(rate))).select(df.columns)
