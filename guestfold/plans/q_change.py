"""Driver queries for the change operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import change as C
from ..sources import files as IO
from .registry import register
from .tables import AS_OF_ORDERS, oracle_with, orders_new, table

UPSERT_KEYS = ["o_orderkey"]
UPSERT_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _differs_sql(cols, a="t", b="s"):
    return " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in cols)


def _orders(spark, sf):
    return table(spark, sf, "orders").select(*UPSERT_KEYS, *UPSERT_COLS)


@register("upsert_actions", oracle_with("orders_new") + f"""
, j AS (
  SELECT t.o_orderkey AS t_key, s.o_orderkey AS s_key, t.o_clerk_note, t.updated_at AS t_stamp, t.is_changed AS t_flag,
    {", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in UPSERT_COLS)},
    CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND ({_differs_sql(UPSERT_COLS)}) THEN 'updated'
         WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 'unchanged'
         WHEN s.o_orderkey IS NOT NULL THEN 'created' ELSE 'kept' END AS action
  FROM (SELECT *, concat('note ', o_custkey) AS o_clerk_note, TIMESTAMP '1998-01-01' AS updated_at,
               CAST(o_orderkey % 2 AS INT) AS is_changed FROM orders) t
  FULL OUTER JOIN orders_new s ON s.o_orderkey = t.o_orderkey)
SELECT coalesce(t_key, s_key) AS o_orderkey, o_clerk_note,
  {", ".join(f"CASE WHEN action IN ('updated', 'created') THEN s_{c} ELSE t_{c} END AS {c}" for c in UPSERT_COLS)},
  CASE WHEN action IN ('updated', 'created') THEN TIMESTAMP '{AS_OF_ORDERS}' ELSE t_stamp END AS updated_at,
  CASE WHEN action = 'updated' THEN 1 WHEN action = 'created' THEN 0 ELSE t_flag END AS is_changed, action
FROM j""")
def upsert_actions(spark, sf):
    """A column outside the compared ones, the old stamp and the old flag stay on rows that don't change."""
    old = table(spark, sf, "orders").select(
        *UPSERT_KEYS, *UPSERT_COLS, F.concat(F.lit("note "), "o_custkey").alias("o_clerk_note"),
        F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")).alias("updated_at"), (F.col("o_orderkey") % 2).cast("int").alias("is_changed"))
    return C.upsert(old, orders_new(spark, sf), UPSERT_KEYS, UPSERT_COLS, AS_OF_ORDERS)


@register("upsert_partitioned", oracle_with("orders_new") + f"""
, n AS (SELECT * FROM orders_new WHERE o_orderkey % 4 = 1)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  {", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in UPSERT_COLS)},
  CASE WHEN s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {_differs_sql(UPSERT_COLS)}) THEN TIMESTAMP '{AS_OF_ORDERS}' END AS updated_at
FROM orders t FULL OUTER JOIN n s ON s.o_orderkey = t.o_orderkey""")
def upsert_partitioned(spark, sf):
    """The stored orders, in key buckets, after an upsert that rewrote the changed buckets only."""
    path = IO.scratch_dir(spark, "buckets") + "/orders"
    old = _orders(spark, sf).withColumns({"updated_at": F.lit(None).cast("timestamp_ntz"), "is_changed": F.lit(0)})
    C.with_bucket(old, UPSERT_KEYS, 16).write.partitionBy("bucket").parquet(path)
    new = C.with_bucket(orders_new(spark, sf).where("o_orderkey % 4 = 1"), UPSERT_KEYS, 16)
    C.upsert_partitions(path, new, UPSERT_KEYS, UPSERT_COLS, AS_OF_ORDERS, "bucket")
    return spark.read.parquet(path).select(*UPSERT_KEYS, *UPSERT_COLS, "updated_at")


@register("change_counts", oracle_with("orders_new") + f"""
SELECT {", ".join(f"CAST(count(*) FILTER (WHERE t.{c} IS DISTINCT FROM s.{c}) AS BIGINT) AS changed_{c}" for c in UPSERT_COLS)},
  CAST(count(*) FILTER (WHERE {_differs_sql(UPSERT_COLS)}) AS BIGINT) AS changed_rows
FROM orders t JOIN orders_new s ON s.o_orderkey = t.o_orderkey""")
def change_counts(spark, sf):
    return C.change_counts(_orders(spark, sf), orders_new(spark, sf), UPSERT_KEYS, UPSERT_COLS)


@register("version_pairs", oracle_with("orders_new") + f"""
, ch AS (SELECT t.o_orderkey AS k, {", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in UPSERT_COLS)}
         FROM orders t JOIN orders_new s ON s.o_orderkey = t.o_orderkey WHERE {_differs_sql(UPSERT_COLS)})
SELECT k AS o_orderkey, 'old' AS version, {", ".join(f"t_{c} AS {c}" for c in UPSERT_COLS)} FROM ch
UNION ALL
SELECT k AS o_orderkey, 'new' AS version, {", ".join(f"s_{c} AS {c}" for c in UPSERT_COLS)} FROM ch""")
def version_pairs(spark, sf):
    return C.version_pairs(_orders(spark, sf), orders_new(spark, sf), UPSERT_KEYS, UPSERT_COLS)


NEW_PARTS_SQL = """SELECT CASE WHEN p_partkey % 10 = 0 THEN p_partkey ELSE p_partkey + 1000000 END AS p_partkey,
  concat(p_name, ' v2') AS p_name, p_size FROM part WHERE p_partkey % 5 = 0"""


@register("insert_ignore", f"""
WITH new AS ({NEW_PARTS_SQL})
SELECT p_partkey, p_name, p_size FROM part
UNION ALL
SELECT p_partkey, p_name, p_size FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM part)""")
def insert_ignore(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    k = F.col("p_partkey")
    new = table(spark, sf, "part").where(k % 5 == 0).select(
        F.when(k % 10 == 0, k).otherwise(k + 1000000).alias("p_partkey"),
        F.concat("p_name", F.lit(" v2")).alias("p_name"), "p_size")
    return C.insert_ignore(part, new, ["p_partkey"])


@register("replace_slice", oracle_with("orders_new") + """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders_new WHERE o_orderstatus = 'P'""")
def replace_slice(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    n = orders_new(spark, sf).where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.replace_slice(t, n, F.col("o_orderstatus") == "P")


@register("update_where", f"""
WITH s0 AS (SELECT o_orderkey, o_orderpriority, o_orderdate, 0 AS excluded, CAST(NULL AS VARCHAR) AS exclude_reason,
                   concat('a', o_custkey) AS account_id,
                   CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus = 'P' END AS cond FROM orders),
s1 AS (SELECT o_orderkey, o_orderpriority, o_orderdate,
         CASE WHEN coalesce(cond, false) THEN 1 ELSE excluded END AS excluded,
         CASE WHEN coalesce(cond, false) THEN 'pending' ELSE exclude_reason END AS exclude_reason, account_id FROM s0),
s2 AS (SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE excluded END AS excluded,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE exclude_reason END AS exclude_reason, account_id FROM s1)
SELECT o_orderkey, excluded, exclude_reason,
  CASE WHEN o_orderdate > TIMESTAMP '{AS_OF_ORDERS}' THEN NULL ELSE account_id END AS account_id FROM s2""")
def update_where(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus",
        F.lit(0).alias("excluded"), F.lit(None).cast("string").alias("exclude_reason"),
        F.concat(F.lit("a"), F.col("o_custkey")).alias("account_id"))
    cond = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("boolean")).otherwise(F.col("o_orderstatus") == "P")
    o = C.update_where(o, cond, {"excluded": F.lit(1), "exclude_reason": F.lit("pending")})          # M1
    o = C.update_where(o, F.col("o_orderpriority") == "1-URGENT",                                    # M13 undo
                       {"excluded": F.lit(0), "exclude_reason": F.lit(None).cast("string")})
    o = C.update_where(o, F.col("o_orderdate") > F.to_timestamp_ntz(F.lit(AS_OF_ORDERS)),            # R11 clear ids
                       {"account_id": F.lit(None).cast("string")})
    return o.select("o_orderkey", "excluded", "exclude_reason", "account_id")


@register("add_rename_cast", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS full_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  0 AS is_investor, CAST(NULL AS VARCHAR) AS sf_contact_id
FROM customer""")
def add_rename_cast(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = C.add_default(c, "is_investor", 0, "int")
    c = C.add_default(c, "sf_contact_id", None, "string")
    c = C.rename(c, "c_name", "full_name")
    c = C.cast_col(c, "c_custkey", "string")
    return C.cast_col(c, "c_nationkey", "bigint")
