"""Driver tables and the portable derived views used as proxies.

The derived views (``dirty``, ``orders_new``, ``allowances``) are one SQL text
each, run unchanged by Spark (with DataFrame arguments) and by the DuckDB
oracle (with table names), see FIXTURES.md §3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

#: Reference date for "today" in order-based queries and in event-based ones
#: (inside the data spans: orders 1995-2001, events January 2024).
AS_OF_ORDERS = "1998-08-02"
AS_OF_EVENTS = "2024-01-15"


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` of a scale-factor folder.

    The DataFrame (a plan with its file index, not data) is kept per session
    and path: the input tables are read-only, so listing the files and reading
    the parquet footers once is enough for every query that uses them."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


DIRTY_SQL = """SELECT c_custkey,
  CASE c_custkey % 9 WHEN 0 THEN 'ANNA-MARIA' WHEN 1 THEN ' o''neil ' WHEN 2 THEN 'Test'
    WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 5 THEN 'Jörg' WHEN 6 THEN '-' WHEN 7 THEN 'peter j.'
    ELSE 'Anna' END AS fname,
  CASE c_custkey % 15 WHEN 0 THEN 'MUSTER' WHEN 1 THEN 'von der linden' WHEN 2 THEN 'X'
    WHEN 3 THEN NULL WHEN 4 THEN ' ' WHEN 5 THEN 'Acme GmbH' WHEN 6 THEN 'Иванов'
    WHEN 7 THEN 'abc???' WHEN 8 THEN 'Deleted' WHEN 10 THEN 'ab??' WHEN 11 THEN 'Foo GesmbH'
    WHEN 12 THEN '12345678ab' WHEN 13 THEN '´' ELSE 'Sample' END AS lname,
  CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no-at-sign'
    WHEN 3 THEN concat('User', c_custkey, '@Example.COM') WHEN 4 THEN concat('a..b', c_custkey, '@example.org')
    WHEN 5 THEN concat('noreply@', 'example.net') WHEN 6 THEN concat('u', c_custkey, '@mailinator.com')
    WHEN 7 THEN concat(' u', c_custkey, '@example.net ') WHEN 8 THEN concat('a@b@', c_custkey, '.example')
    ELSE concat('sample.', c_custkey, '@example.org') END AS email,
  CASE c_custkey % 15 WHEN 0 THEN 'Herr' WHEN 13 THEN 'FRAU' WHEN 14 THEN 'dear ms. sample' WHEN 1 THEN 'Frau ' WHEN 2 THEN 'MR' WHEN 3 THEN 'Mrs.'
    WHEN 4 THEN 'Dear Mr. Sample' WHEN 5 THEN 'Dear Ms Sample' WHEN 6 THEN 'Herr Dr.' WHEN 7 THEN 'N/A'
    WHEN 8 THEN 'Familie' WHEN 9 THEN NULL WHEN 10 THEN 'Signora' WHEN 11 THEN 'Sehr geehrter Herr Sample'
    ELSE 'zzz' END AS salutation,
  CASE c_custkey % 9 WHEN 8 THEN 'DEUTSCHLAND' WHEN 0 THEN 'AT' WHEN 1 THEN ' Deutschland' WHEN 2 THEN 'Schweiz' WHEN 3 THEN 'UK'
    WHEN 4 THEN 'XX' WHEN 5 THEN NULL WHEN 6 THEN 'Atlantis' ELSE 'HR' END AS country,
  CASE c_custkey % 6 WHEN 0 THEN concat('+43 (1) ', c_custkey, ' ext') WHEN 1 THEN '0000000000'
    WHEN 2 THEN NULL WHEN 3 THEN 'n/a' WHEN 4 THEN '123-456-7890' ELSE concat('tel:', c_custkey) END AS cell_phone,
  CASE c_custkey % 8 WHEN 7 THEN '05.05.1885' WHEN 0 THEN '07.03.1995' WHEN 1 THEN '31.02.2001' WHEN 2 THEN '01.01.1900'
    WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 5 THEN '29.02.2000' ELSE '24.12.2099' END AS birth_text,
  CASE c_custkey % 4 WHEN 0 THEN concat(c_custkey, '.0') WHEN 1 THEN NULL ELSE concat('', c_custkey) END AS member_id,
  CASE c_custkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN NULL ELSE 'No' END AS current_opt_in,
  CASE c_custkey % 14 WHEN 0 THEN 'hard' WHEN 1 THEN '1' ELSE 'no' END AS bounce,
  CASE c_custkey % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'xx' WHEN 2 THEN 'CZ' WHEN 3 THEN 'it' ELSE NULL END AS language_code,
  CAST(c_nationkey AS BIGINT) AS list_id
FROM {customer}"""

ORDERS_NEW_SQL = """SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey,
  o_custkey,
  CASE WHEN o_orderkey % 7 = 0 THEN 'F' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderkey % 17 <> 0"""

ALLOWANCES_SQL = """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS amount
FROM {lineitem} WHERE l_discount > 0 AND l_partkey % 4 = 0"""

DERIVED = {
    "dirty": (DIRTY_SQL, ["customer"]),
    "orders_new": (ORDERS_NEW_SQL, ["orders"]),
    "allowances": (ALLOWANCES_SQL, ["lineitem"]),
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, deps = DERIVED[name]
    return spark.sql(sql, **{d: table(spark, sf_dir, d) for d in deps})


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "dirty")


def orders_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "orders_new")


def allowances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "allowances")


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining derived views for the DuckDB oracle."""
    parts = []
    for n in names:
        sql, deps = DERIVED[n]
        parts.append(f"{n} AS ({sql.format(**{d: d for d in deps})})")
    return "WITH " + ",\n".join(parts) + "\n"
