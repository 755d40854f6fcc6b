"""Reporting operators: string aggregation, ratios, length profiles, fill rates,
KPI unpivot, occupancy and the commercial report (G9, G15, G17, K1-K13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, money_sum, year_month


def string_agg(c, sep: str = ",", distinct: bool = True) -> Column:
    """``GROUP_CONCAT(DISTINCT c ORDER BY c SEPARATOR sep)``.

    ``collect_set``/``collect_list`` aggregate partially before the shuffle;
    the sorted array gives a total order independent of arrival order."""
    c = col(c)
    arr = F.collect_set(c) if distinct else F.collect_list(c)
    return F.array_join(F.array_sort(arr), sep)


def ratio_pct(cond: Column, scale: int = 2) -> Column:
    """Percent of rows where ``cond`` holds (G15): ``round(100 * count_if / count, scale)``."""
    return F.round(F.count_if(F.coalesce(cond, F.lit(False))).cast("double") * 100.0 / F.count(F.lit(1)), scale)


def length_profile(df: DataFrame, limits: Mapping[str, Sequence[int]]) -> DataFrame:
    """Max length in characters and in bytes (MySQL ``CHAR_LENGTH`` vs
    ``LENGTH``) and over-limit counts per column, one pass (G17, F8).

    Result: one row per column: ``column, max_len, max_bytes, over_<n>...``."""
    aggs = []
    for c, lims in limits.items():
        aggs.append(F.max(F.char_length(c)).alias(f"{c}__max"))
        aggs.append(F.max(F.octet_length(c)).alias(f"{c}__bytes"))
        for n in lims:
            aggs.append(F.count_if(F.char_length(c) > n).alias(f"{c}__over_{n}"))
    wide = df.agg(*aggs)
    all_lims = sorted({n for lims in limits.values() for n in lims})
    rows = []
    for c, lims in limits.items():
        vals = [F.lit(c), F.col(f"{c}__max").cast("bigint"), F.col(f"{c}__bytes").cast("bigint")]
        vals += [F.col(f"{c}__over_{n}").cast("bigint") if n in lims else F.lit(None).cast("bigint") for n in all_lims]
        rows.append(vals)
    names = ["column", "max_len", "max_bytes"] + [f"over_{n}" for n in all_lims]
    return wide.select(F.inline(F.array(*[F.struct(*[v.alias(nm) for v, nm in zip(r, names)]) for r in rows])))


def fill_rates(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """Field fill-rate profile in long form (K7): one aggregate pass over the
    table, then ``unpivot`` of the one-row result (instead of one scan per field)."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    for c in cols:
        filled = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        aggs.append(F.count_if(filled).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot(["__total"], list(cols), "field", "filled")
    return long.select("field", F.col("filled").cast("bigint").alias("filled"),
                       F.col("__total").alias("total"),
                       F.round(F.col("filled").cast("double") * 100.0 / F.col("__total"), scale).alias("pct"))


def kpi_long(df: DataFrame, ids: Sequence[str], kpis: Sequence[str], name_prefix_col: str | None = None,
             kpi_col: str = "kpi", value_col: str = "value") -> DataFrame:
    """KPI unpivot (K2): one row per KPI with a composed name, one scan."""
    long = df.unpivot(list(ids), list(kpis), kpi_col, value_col)
    if name_prefix_col:
        long = long.withColumn(kpi_col, F.concat_ws("_", F.col(name_prefix_col), F.col(kpi_col)))
    return long


def union_tagged(parts: Mapping[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """``UNION ALL`` of aligned sources with a source tag."""
    out = None
    for tag, df in parts.items():
        t = df.withColumn(tag_col, F.lit(tag))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def object_counts(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side as rows."""
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("object"), "n")
        out = c if out is None else out.union(c)
    return out.distinct()


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]], how: str = "inner") -> DataFrame:
    """Star join (J5): ``fact`` with columns of dimensions.  A dimension is (frame, column that refers to it, its key, {its column:
    name in the result}); the referring column may come from a dimension before it, and a frame may stand under several roles.

    AQE broadcasts dimensions whose measured size is below the threshold, the rest sort-merge.  A name that
    is there already is an error."""
    out = fact
    for i, (dim, ref, key, names) in enumerate(dims):
        if taken := set(names.values()) & set(out.columns):
            raise ValueError(f"columns that are there already: {sorted(taken)}")
        d = dim.select(F.col(key).alias(f"__d{i}"), *[F.col(c).alias(n) for c, n in names.items()])
        out = out.join(d, F.col(ref) == F.col(f"__d{i}"), how).drop(f"__d{i}")
    return out


def star_join(t: Mapping[str, DataFrame]) -> DataFrame:
    """Star join of the driver tables: one fact, six dimensions, ``nation`` under two roles."""
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    j = star(li, [(t["orders"], "l_orderkey", "o_orderkey", {"o_custkey": "custkey"}),
                  (t["customer"], "custkey", "c_custkey", {"c_name": "c_name", "c_nationkey": "cust_nationkey"}),
                  (t["nation"], "cust_nationkey", "n_nationkey", {"n_name": "cust_nation", "n_regionkey": "cust_regionkey"}),
                  (t["region"], "cust_regionkey", "r_regionkey", {"r_name": "cust_region"}),
                  (t["part"], "l_partkey", "p_partkey", {"p_name": "p_name"}),
                  (t["supplier"], "l_suppkey", "s_suppkey", {"s_name": "s_name", "s_nationkey": "supp_nationkey"}),
                  (t["nation"], "supp_nationkey", "n_nationkey", {"n_name": "supp_nation"})])
    return j.select("l_orderkey", "l_linenumber", "c_name", "cust_nation", "cust_region", "p_name", "s_name",
                    "supp_nation")


def unmapped(fact: DataFrame, dim: DataFrame, key: str, amount: str, scale: int = 2) -> DataFrame:
    """Fact rows whose key is missing from the dimension, with counts and
    amounts (K6: anti join + aggregation).  Amounts are summed as decimals so
    the result does not depend on the order of addition."""
    miss = fact.join(dim.select(key).distinct(), key, "left_anti")
    return miss.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_lines"),
        money_sum(amount, scale).cast("double").alias("amount"))


def cleaning_report(df: DataFrame) -> DataFrame:
    """Cleaning report in a single aggregate pass."""
    from ..functions.cleaning import BOUNCE_VALUES
    f = F.col("fname")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(f.isNull()).alias("null_fname"),
        F.count_if(F.col("lname").isNull() | (F.trim("lname") == "")).alias("blank_lname"),
        F.count_if(F.col("email").isNull() | (F.trim("email") == "")).alias("blank_email"),
        F.count_if((f == F.upper(f)) & (f != F.lower(f))).alias("all_caps_fname"),
        F.count_if(F.lower(F.trim("bounce")).isin(BOUNCE_VALUES)).alias("bounced"),
        F.sum((F.col("current_opt_in") == "Yes").cast("int")).cast("bigint").alias("opted_in"),
        F.count("current_opt_in").alias("opt_in_known"))


#: Words that stand in place of a first or last name, and the shape of a usable e-mail address.
NAME_PLACEHOLDERS = {"fname": ["test", "unknown", "n/a", "none", "na", "null", "xxx", "first"],
                     "lname": ["test", "unknown", "n/a", "none", "na", "null", "xxx", "last"]}
ODD_NAME = r"[^a-zA-ZÀ-ÖØ-öø-ÿ '\-.]"
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def contact_findings(fname: str = "fname", lname: str = "lname", email: str = "email") -> dict[str, Column]:
    """What the cleaning report looks for in a row (N23): finding -> condition, never NULL.

    Letter case counts here, as it is what the case findings are about."""
    names = {"fname": F.col(fname), "lname": F.col(lname)}
    either = lambda test: F.coalesce(test("fname", names["fname"]), F.lit(False)) | F.coalesce(test("lname", names["lname"]), F.lit(False))
    e = F.col(email)
    found = {
        "all_caps": either(lambda _, c: (c == F.upper(c)) & c.rlike("[A-Z]{2,}")),
        "all_lower": either(lambda _, c: (c == F.lower(c)) & c.rlike("[a-z]{2,}")),
        "digits": either(lambda _, c: c.rlike("[0-9]")),
        "odd_characters": either(lambda _, c: c.rlike(ODD_NAME)),
        "one_character": either(lambda _, c: F.octet_length(F.trim(c)) == 1),
        "placeholder": either(lambda k, c: F.lower(F.trim(c)).isin(NAME_PLACEHOLDERS[k])),
        "email_format": ~e.rlike(EMAIL_SHAPE) | e.contains(" ") | e.contains(".."),
        "email_outer_blanks": e != F.trim(e),
        "email_case": e != F.lower(e),
    }
    return {k: F.coalesce(c, F.lit(False)) for k, c in found.items()}


def contact_report(df: DataFrame, fields: Sequence[str], findings: Mapping[str, Column], email: str = "email",
                   scope: Column | None = None) -> DataFrame:
    """Cleaning report (N23) in long form, one scan: ``check, n``.

    Checks: total, a ``<field>_missing`` (NULL or blank) per field, null_email, blank_email and has_email, all over the rows in
    ``scope`` (all, if not given), and every finding over all rows."""
    inside = F.coalesce(scope, F.lit(False)) if scope is not None else F.lit(True)
    blank = {f: F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "") for f in dict.fromkeys([*fields, email])}
    checks = {"total": F.count_if(inside), **{f"{f}_missing": F.count_if(inside & blank[f]) for f in fields},
              "null_email": F.count_if(inside & F.col(email).isNull()),
              "blank_email": F.count_if(inside & F.col(email).isNotNull() & blank[email]),
              "has_email": F.count_if(inside & ~blank[email]),
              **{k: F.count_if(c) for k, c in findings.items()}}
    wide = df.agg(*[c.cast("bigint").alias(k) for k, c in checks.items()])
    return wide.unpivot([], list(checks), "check", "n")


def finding_rows(df: DataFrame, keep: Sequence[str], findings: Mapping[str, Column]) -> DataFrame:
    """Rows behind the findings (N23): ``keep`` columns and ``finding``, one row per finding of a row."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in findings.items()]))
    return df.select(*keep, F.explode(hits).alias("finding"))


def revenue_fact(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Daily revenue rows with their dimensions (the input of K4): exact decimal
    revenue per line, order date, customer nation and segment."""
    rev = F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (lineitem.select("l_orderkey", rev.alias("rev"))
            .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")))


def commercial_report(fact: DataFrame, date_col: str, dims: Sequence[str], rev_col: str = "rev",
                      source_col: str = "source") -> DataFrame:
    """Monthly commercial report over the source systems.

    ``fact`` holds the revenue rows of all systems, tagged in ``source_col``
    (``union_tagged`` builds it from separate sources).  One aggregation by
    source, month and dimensions: one shuffle of partial aggregates, however
    many systems there are.  Revenue is summed exactly."""
    month = year_month(date_col).alias("month")
    return fact.groupBy(source_col, month, *dims).agg(money_sum(rev_col, 4).cast("double").alias("revenue"),
                                                      F.count(F.lit(1)).alias("n_lines"))


def occupancy_daily(lineitem: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    """Daily occupancy from two systems (K1): room nights, bed nights, adults,
    children per day; stays count only for finished bookings (semi join)."""
    done = orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    pms = (lineitem.join(done, "l_orderkey", "left_semi")
           .groupBy(F.to_date("l_shipdate").alias("day"))
           .agg(F.count(F.lit(1)).alias("room_nights"), F.sum("l_quantity").cast("bigint").alias("bed_nights"),
                F.count_distinct("l_orderkey").alias("adults"), F.count_if(F.col("l_quantity") < 5).alias("children")))
    web = (events.groupBy(F.to_date("ts").alias("day"))
           .agg(F.count_if(F.col("event_type") == "purchase").alias("room_nights"),
                F.count(F.lit(1)).alias("bed_nights"), F.count_distinct("user_id").alias("adults"),
                F.count_if(F.col("event_type") == "signup").alias("children")))
    return union_tagged({"pms": pms, "web": web}).select("source", "day", "room_nights", "bed_nights", "adults",
                                                          "children")


def occupancy_kpis(lineitem: DataFrame, orders: DataFrame, events: DataFrame, day: str) -> DataFrame:
    """Parameterised one-day KPI report (K3): K1 for ``day`` in long form (K2)."""
    occ = occupancy_daily(lineitem.where(F.to_date("l_shipdate") == F.lit(day).cast("date")), orders,
                          events.where(F.to_date("ts") == F.lit(day).cast("date")))
    return kpi_long(occ, ["source", "day"], ["room_nights", "bed_nights", "adults", "children"], "source")
