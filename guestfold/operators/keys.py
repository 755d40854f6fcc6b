"""Generic per-key operators: pick one row per key, flag or drop duplicates,
dominant values, sequence and batch numbers, group-size bands, shares.

Skew policy: a single key may hold a third of all rows.  Counting per key is
always a ``groupBy`` (partial aggregation before the shuffle), joined back to
the rows instead of a window over the whole group, so no task ever buffers a
hot group.  ``pick_one`` uses ``row_number() == 1`` which Spark turns into a
``WindowGroupLimit`` that keeps one row per key *before* the shuffle, and
``flag_duplicates`` joins those winners back.  ``assign_sequence`` numbers rows globally
without a single-partition step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import key_col
from ..session import checkpoint_dir

Order = Sequence[Column | str]


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def pick_one(df: DataFrame, keys: Sequence[str], order: Order, rn_col: str | None = None,
             collation: str | None = None) -> DataFrame:
    """One row per key by a multi-level priority order.

    ``order`` must be total within a key (end it with a unique column) so the
    result is deterministic.  NULL keys form their own group, as in SQL.
    ``collation`` groups string keys case/accent-insensitively."""
    w = Window.partitionBy(*[key_col(df, k, collation) for k in keys]).orderBy(*_cols(order))
    rn = rn_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rn_col else out.drop(rn)


#: Copies of one row that one task gives back at a time.
COPIES = 10_000


def _comparable(df: DataFrame, c: str) -> Column:
    """A column in a form that can be compared: maps as sorted entries."""
    q = F.col(f"`{c}`")
    return F.array_sort(F.map_entries(q)) if isinstance(df.schema[c].dataType, T.MapType) else q


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Order, flag_col: str = "is_duplicate") -> DataFrame:
    """Mark duplicates instead of removing them: the winner gets 0, the others 1.

    ``order`` must be total within a key but for rows that are equal in every column: of those one wins.  NULL keys form
    their own group.  The first two rows of a key (every map task keeps no more) give the winner and whether it is
    repeated; the winners are joined back to the rows, and AQE splits the rows of a hot key in that join.  Copies of a
    repeated winner are equal, so they are counted, not ranked, and given back one with 0 and the rest with 1."""
    rest = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_cols(order))
    two = df.withColumn("__rn", F.row_number().over(w)).where("__rn <= 2")
    row = F.struct(F.lit(1), *[_comparable(df, c) for c in rest])
    win = two.withColumn("__tied", F.lead(row).over(w).eqNullSafe(row)).where("__rn = 1")
    win = win.select(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)], "__tied",
                     *[_comparable(df, c).alias(f"__v{i}") for i, c in enumerate(rest)])
    j = df.join(win, [F.col(k).eqNullSafe(F.col(f"__w{i}")) for i, k in enumerate(keys)], "left")
    first = F.lit(True)
    for i, c in enumerate(rest):
        first = first & _comparable(df, c).eqNullSafe(F.col(f"__v{i}"))
    j = j.select(*[df[f"`{c}`"] for c in df.columns], first.alias("__first"), (first & F.col("__tied")).alias("__copy"))
    single = j.where("not __copy").select(*df.columns, F.when(F.col("__first"), 0).otherwise(1).alias(flag_col))
    row = F.struct(*[F.col(c) for c in df.columns])
    copies = j.where("__copy").groupBy(*keys).agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__n")).select("__row", "__n")
    # the copies of a hot row go out in shares, over several tasks
    shares = copies.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(COPIES).cast("long"))))
    shares = shares.repartition("__from", *[F.col(f"__row.{k}") for k in keys])
    last = F.least(F.col("__n"), F.col("__from") + COPIES) - 1
    copies = shares.select("__row", F.explode(F.sequence(F.col("__from"), last)).alias("__at"))
    copies = copies.select("__row.*", F.when(F.col("__at") == 0, 0).otherwise(1).alias(flag_col))
    return single.unionByName(copies)


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n", collation: str | None = None) -> DataFrame:
    """Rows per key (partial aggregation, skew-safe)."""
    return df.groupBy(*[key_col(df, k, collation).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "group_size",
                    collation: str | None = None) -> DataFrame:
    """Attach the number of rows sharing the key (J16) without a window over the
    group: counts are aggregated first and joined back.  NULL keys are counted
    as one group and joined null-safely."""
    counts = key_counts(df, keys, name, collation)
    cond = [key_col(df, k, collation).eqNullSafe(counts[k]) for k in keys]
    return df.join(counts, cond, "inner").select(df["*"], counts[name])


def drop_all_duplicated(df: DataFrame, keys: Sequence[str], collation: str | None = None) -> DataFrame:
    """Remove *every* row whose key occurs more than once (M7); rows with a
    NULL key part are kept, since NULL never equals NULL."""
    non_null = F.lit(True)
    for k in keys:
        non_null = non_null & F.col(k).isNotNull()
    dup_keys = key_counts(df.where(non_null), keys, collation=collation).where(F.col("n") > 1).select(*keys)
    cond = [key_col(df, k, collation) == dup_keys[k] for k in keys]
    return df.join(dup_keys, cond, "left_anti")


def where_group_size(df: DataFrame, keys: Sequence[str], bands: Sequence[tuple[int, int | None]],
                     name: str = "group_size") -> DataFrame:
    """Keep rows whose key group size falls in one of the bands (W7);
    a band is ``(lo, hi)`` inclusive, ``hi=None`` is open."""
    sized = with_group_size(df, keys, name)
    cond = F.lit(False)
    for lo, hi in bands:
        c = F.col(name) >= lo
        if hi is not None:
            c = c & (F.col(name) <= hi)
        cond = cond | c
    return sized.where(cond)


def dominant(df: DataFrame, key: str, val: str, min_n: int, min_ratio: float,
             tie: str = "asc") -> DataFrame:
    """Dominant value per key with support and ratio.

    Returns ``key, val, n_val, n_key, ratio`` for keys with at least ``min_n``
    non-NULL values in all whose most frequent value has a share (rounded to
    four digits) of at least ``min_ratio`` of them.  Ties on the count go to the smallest
    value.  Both counts are partial aggregates, so a hot key is safe.
    """
    base = df.where(F.col(key).isNotNull() & F.col(val).isNotNull())
    per_val = base.groupBy(key, val).agg(F.count(F.lit(1)).alias("n_val"))
    per_key = per_val.groupBy(key).agg(F.sum("n_val").alias("n_key"))
    order = [F.col("n_val").desc(), F.col(val).asc() if tie == "asc" else F.col(val).desc()]
    top = pick_one(per_val, [key], order)
    out = top.join(per_key, key).withColumn("ratio", F.round(F.col("n_val") / F.col("n_key"), 4))
    return out.where((F.col("n_key") >= min_n) & (F.col("ratio") >= min_ratio)) \
        .select(key, val, "n_val", "n_key", "ratio")


def share(df: DataFrame, keys: Sequence[str], name: str = "pct", scale: int = 2) -> DataFrame:
    """Count per key and its percentage of all rows.

    The total is a scalar subquery over the aggregated counts, so there is no
    single-partition window and no cross join."""
    counts = key_counts(df, keys, "n")
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn(name, F.round(F.col("n").cast("double") * 100.0 / total, scale))


#: Rows of one window of a running total.
RUNNING_SLICE = 100_000


def _ckpt(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def assign_sequence(df: DataFrame, order: Order, start: int = 1, out: str = "seq",
                    only_null: str | None = None, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Global sequence number in a stated total order, starting at ``start``.

    A plain ``row_number().over(Window.orderBy(..))`` moves every row into one
    partition.  Instead rows are range-partitioned on the order, sorted inside
    each partition, numbered locally, and shifted by the number of rows in all
    earlier partitions.  The range-partitioned, numbered data is checkpointed
    to the shared checkpoint folder (``spark.checkpoint.dir``) so a lost
    executor cannot re-run the sampling with a different outcome.  Only the
    per-partition counts (one row per partition) are aggregated globally.

    With ``key`` (a unique, non-NULL column) only it and the plain ``order`` columns are numbered and
    checkpointed; the other columns are joined back on it, so payload never goes through the checkpoint.
    Without ``partitions`` AQE sizes the range partitions by their bytes.

    With ``only_null`` set, rows whose ``only_null`` column is already filled
    keep their value and are left out of the numbering (``out`` then defaults
    to that column).
    """
    order_cols = _cols(order)
    if only_null:
        out = only_null
        todo = df.where(F.col(only_null).isNull())
        done = df.where(F.col(only_null).isNotNull())
    else:
        todo, done = df, None
    if key:
        slim = [c for c in dict.fromkeys([key, *[c for c in order if isinstance(c, str)]])]
        numbered = assign_sequence(todo.select(*slim), order, start, out, None, partitions).select(key, out)
        numbered = todo.drop(out).join(numbered, key)
        return numbered if done is None else done.unionByName(numbered.select(done.columns))
    ranged = todo.repartitionByRange(partitions, *order_cols) if partitions else todo.repartitionByRange(*order_cols)
    ranged = (ranged
              .sortWithinPartitions(*order_cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id()))
    ranged = _ckpt(ranged)
    # monotonically_increasing_id = (partition id << 33) + position in partition
    ranged = ranged.withColumn("__pos", F.col("__local") - F.shiftleft(F.col("__pid").cast("long"), 33))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # running offset over one row per partition: bounded by the partition count
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    numbered = (ranged.join(F.broadcast(offsets), "__pid")
                .withColumn(out, (F.col("__off") + F.col("__pos") + F.lit(start)).cast("long"))
                .drop("__pid", "__local", "__pos", "__off"))
    if done is not None:
        numbered = numbered.unionByName(done)
    return numbered


def running_total(df: DataFrame, order: Order, value: str, before: str, seq: str, partitions: int | None = None) -> DataFrame:
    """``seq`` (from 1) and ``before``, the sum of ``value`` over all earlier rows, along a total order.

    As in :func:`assign_sequence`: ranges are numbered and summed by position, and shifted by the counts and sums of the ranges
    before, of which there is one row each.  A range's rows are summed in slices of consecutive rows (a window per slice), so no task
    holds more than it sorted."""
    cols = _cols(order)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = _ckpt(ranged.sortWithinPartitions(*cols).withColumn("__pid", F.spark_partition_id())
                   .withColumn("__at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("__slice", F.floor((F.col("__at") - F.shiftleft(F.col("__pid").cast("long"), 33)) / RUNNING_SLICE))
    # sums per slice: offsets of the slices inside a range, then of the ranges
    sums = ranged.groupBy("__pid", "__slice").agg(F.sum(value).alias("__s"), F.count(F.lit(1)).alias("__n"))
    inside = Window.partitionBy("__pid").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__pid", "__slice", "__s", "__n", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(o) for c, o in (("__s", "__so"), ("__n", "__no"))])
    ranges = sums.groupBy("__pid").agg(F.sum("__s").alias("__ps"), F.sum("__n").alias("__pn"))
    over = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("__pid", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(o) for c, o in (("__ps", "__pso"), ("__pn", "__pno"))])
    offsets = sums.join(F.broadcast(ranges), "__pid").select(
        "__pid", "__slice", (F.col("__so") + F.col("__pso")).alias("__s0"), (F.col("__no") + F.col("__pno")).alias("__n0"))
    own = Window.partitionBy("__pid", "__slice").orderBy("__at")
    out = (ranged.withColumn("__run", F.sum(value).over(own) - F.col(value)).withColumn("__k", F.row_number().over(own))
           .join(offsets, ["__pid", "__slice"]))
    return (out.withColumn(before, (F.col("__s0") + F.col("__run")).cast("long")).withColumn(seq, (F.col("__n0") + F.col("__k")).cast("long"))
            .select(*df.columns, before, seq))


def assign_batches(df: DataFrame, seq: str, size: int, out: str = "batch_no") -> DataFrame:
    """Batch number of fixed size from a 1-based sequence."""
    return df.withColumn(out, (F.floor((F.col(seq) - 1) / size) + 1).cast("long"))


def rollup_counts(df: DataFrame, levels: Sequence[Sequence[str]], measures: dict[str, Column],
                  level_col: str = "level") -> DataFrame:
    """Several grouping levels and a grand total in one result.

    ``levels`` lists the key sets, finest first; ``()`` is the grand total.
    One scan and one aggregation with ``GROUPING SETS``; every measure is
    computed for every set and ``level`` (the index in ``levels``) tells the
    sets apart, so callers can pick a different measure per level."""
    all_keys: list[str] = []
    for lv in levels:
        for k in lv:
            if k not in all_keys:
                all_keys.append(k)
    gid = F.grouping_id(*all_keys) if all_keys else F.lit(0)
    agg = df.groupingSets([[F.col(k) for k in lv] for lv in levels], *all_keys).agg(
        *[m.alias(name) for name, m in measures.items()], gid.alias("__gid"))
    # grouping_id bit i (from the left) is 1 when key i is *not* in the set
    level = F.lit(None).cast("int")
    for i, lv in reversed(list(enumerate(levels))):
        bits = sum(1 << (len(all_keys) - 1 - j) for j, k in enumerate(all_keys) if k not in lv)
        level = F.when(F.col("__gid") == bits, F.lit(i)).otherwise(level)
    return agg.select(level.alias(level_col), *all_keys, *measures.keys())
