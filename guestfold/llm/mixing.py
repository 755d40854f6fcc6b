"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) with their tokens.
Raking scales the cells' weights to the target marginals of one dimension after the other,
round after round.  A document is sampled by a hash of its id, with a probability proportional to its cell's weight or,
for a kept share, with the probabilities of a second raking that are bounded by 1.
DataFrame expressions only.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

DIMS = ("source", "lang", "topic")
#: Raking rounds, and how many of them one written table holds; cells that one task rakes.
ROUNDS, ROUNDS_A_TABLE, TASK_CELLS = 8, 4, 200_000
#: Most scalings of all cells to the kept share.
SCALINGS = 20
#: Words: what stands between ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Topics by the first pattern that the whole text matches; the last one is for all other texts.
TOPICS = (("symbols", r"[#$%&*]{3}"), ("table", r" \| "), ("shouting", "[A-Z]{3}!!"), ("legal", "[Ll]icense|rights reserved"),
          ("contact", "[A-Za-z0-9]@[A-Za-z0-9]|[0-9]{5}"), ("prose", ""))
#: Target marginals: a number tempers the natural shares (1: as they are, 0: all alike);
#: a dict gives shares by value, and 0 to what it does not name.
TARGETS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
#: Share of all tokens that a sample keeps.
KEEP = 0.7


def topic_of(text: Column) -> Column:
    out = F.lit(TOPICS[-1][0])
    for name, pattern in reversed(TOPICS[:-1]):
        out = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(out)
    return out


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]], rounds: int, scratch: Scratch) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with weights whose token marginals approach the targets."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    n_cells = cells.count()
    # a small table is raked by one task without a shuffle, a large one by many
    cells = cells.coalesce(1) if n_cells <= TASK_CELLS else cells.repartition(ceil(n_cells / TASK_CELLS))
    for d in DIMS:
        mass = F.sum("tokens").over(Window.partitionBy(d))
        goal = targets[d]
        if isinstance(goal, dict):
            named = F.coalesce(*[F.when(F.col(d) == k, F.lit(float(v))) for k, v in goal.items()], F.lit(0.0))
            present = cells.select(d).distinct().select(F.sum(named)).first()[0]
            cells = cells.withColumn(f"goal_{d}", named / F.lit(present or 1.0) * total)
        else:
            norm = cells.groupBy(d).agg(F.sum("tokens").alias("m")).agg(F.sum(F.when(F.col("m") > 0, F.pow("m", F.lit(float(goal)))))).first()[0]
            cells = cells.withColumn(f"goal_{d}", F.when(mass > 0, F.pow(mass, F.lit(float(goal)))).otherwise(0.0) / F.lit(norm or 1.0) * total)
    cells = cells.withColumn("weight", F.lit(1.0))
    for r in range(1, rounds + 1):
        for d in DIMS:
            have = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(d))
            cells = cells.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"goal_{d}") / have).otherwise(F.col("weight")))
        if r % ROUNDS_A_TABLE == 0 and r < rounds:
            cells = scratch.table(cells)
            cells = cells.coalesce(1) if n_cells <= TASK_CELLS else cells
    return scratch.table(cells.select(*DIMS, "tokens", "weight"))


def bounded(raked: DataFrame, keep: float, rounds: int, scratch: Scratch) -> DataFrame:
    """``raked`` with ``probability``: at most 1, and ``keep`` of all tokens are kept in expectation.

    The goals are ``keep`` x the marginals of the weights.  Cells at probability 1 count as they are and the others of a
    value are scaled to what its goal lacks.  A value that has fewer tokens than its goal is kept whole, and the last scaling,
    of all cells alike, gives what it lacks to the others.  Cells without tokens get ``keep``."""
    n_cells = raked.count()
    total = float(raked.agg(F.sum("tokens")).first()[0] or 0)
    one_task = lambda c: c.coalesce(1) if n_cells <= TASK_CELLS else c
    cells = one_task(raked)
    for d in DIMS:
        cells = cells.withColumn(f"goal_{d}", F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(d)) * F.lit(float(keep)))
    u = F.col("u")
    full, free = F.sum(F.when(u >= 1, F.col("tokens")).otherwise(0.0)), F.sum(F.when(u < 1, F.col("tokens") * u).otherwise(0.0))

    def factor(goal, full, free):  # neither case passes the goal, so rounds approach it from one side
        return F.when(full + free > goal, goal / (full + free)).when((free > 0) & (goal > full), (goal - full) / free).otherwise(1.0)

    cells = cells.withColumn("u", F.col("weight") * F.lit(float(keep)))
    for r in range(1, rounds + 1):
        for d in DIMS:
            by = Window.partitionBy(d)
            # no probability is lost to a value that can't be met: its factor is limited
            cells = cells.withColumn("u", u * F.least(F.lit(10.0), factor(F.col(f"goal_{d}"), full.over(by), free.over(by))))
        if r % ROUNDS_A_TABLE == 0 and r < rounds:
            cells = one_task(scratch.table(cells))
    cells = scratch.table(cells.select(*DIMS, "tokens", "weight", "u"))
    scale = 1.0
    for _ in range(SCALINGS):
        f = cells.withColumn("u", u * F.lit(scale)).agg(factor(F.lit(keep * total), full, free)).first()[0] or 1.0
        scale *= f
        if abs(f - 1) < 1e-9:
            break
    probability = F.when(F.col("tokens") == 0, F.lit(float(keep))).otherwise(F.least(F.lit(1.0), u * F.lit(scale)))
    return scratch.table(cells.select(*DIMS, "tokens", "weight", probability.alias("probability")))


def sampled(df: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang", topic_col: str | None = None, targets: dict | None = None, rounds: int = ROUNDS,
            rate: float | None = None, seed: str = "mix", keep: float | None = KEEP) -> DataFrame:
    """See :func:`mix`: ``row`` (the columns ``carry`` of the input, by default all, so that no name can clash), source, lang, topic, tokens,
    weight, probability, kept.  Texts are scanned once: what was found is written with the carried columns and read again."""
    scratch = Scratch(df.sparkSession)
    text = F.coalesce(df[f"`{text_col}`"], F.lit(""))
    seen = F.md5(F.concat(F.lit(seed), F.coalesce(df[f"`{id_col}`"].cast("string"), F.lit(""))).cast("binary"))
    rows = scratch.table(df.select(
        F.struct(*[df[f"`{c}`"] for c in carry or df.columns]).alias("row"), df[f"`{source_col}`"].alias("source"),
        df[f"`{lang_col}`"].alias("lang"), (df[f"`{topic_col}`"] if topic_col else topic_of(text)).alias("topic"),
        F.regexp_count(text, F.lit(TOKEN)).cast("bigint").alias("tokens"),
        (F.conv(F.substring(seen, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)).alias("draw")))
    cells = scratch.table(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))
    raked = rake(cells, targets or TARGETS, rounds, scratch)
    if rate is None and keep is not None:
        raked = bounded(raked, keep, rounds, scratch)
    else:
        largest = raked.agg(F.max("weight")).first()[0]
        rate = rate if rate is not None else 1 / largest if largest else 1.0
        raked = raked.withColumn("probability", F.least(F.lit(1.0), F.lit(float(rate)) * F.col("weight")))
    right = raked.select(*[F.col(d).alias(f"cell_{d}") for d in DIMS], "weight", "probability")
    on = [F.col(d).eqNullSafe(F.col(f"cell_{d}")) for d in DIMS]
    return rows.join(right, on[0] & on[1] & on[2], "left").select(
        "row", *DIMS, "tokens", "weight", "probability", (F.col("draw") < F.col("probability")).alias("kept"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The input's columns and ``__topic``, ``__tokens``, ``__weight``, ``__probability``, ``__kept``; the options are those of
    :func:`sampled`.  An input column of one of these five names is replaced.

    In expectation ``keep`` of all tokens are kept, with probabilities from :func:`bounded`: shares are the targets as far as
    the tokens of a value go, and rare cells don't lower the others.  (Fewer are kept only if the targets give too many values 0.)
    With a ``rate`` a document's probability is min(1, ``rate`` x weight) instead; with neither (``keep=None``) the rate
    is 1 / the largest weight, so that no probability is cut, and the scarcest cell decides how much is kept.  A document is kept
    if a number from its id's md5 is below its probability: equal ids are kept or dropped together, on every run.

    Null source, language or topic is a value of its own.  Null and empty texts have no tokens; a cell without tokens keeps
    weight 1.  Null ids are drawn as the empty string.  ``topic_col``: a column to use instead of :data:`TOPICS`.  Empty table: no rows."""
    own = {f"__{c}": F.col(c) for c in ("topic", "tokens", "weight", "probability", "kept")}
    carry = options.pop("carry", None) or df.columns
    return sampled(df, carry, **options).select(*[F.col(f"row.`{c}`") for c in carry if c not in own], *[c.alias(n) for n, c in own.items()])


def report(df: DataFrame) -> DataFrame:
    """The driver query: one row per document of ``documents`` with its cell, weight, probability and whether it is kept.
    No probability is cut here (``keep=None``), as in the oracle SQL."""
    return sampled(df, ["doc_id"], keep=None).select(
        "row.doc_id", "source", "lang", "topic", F.col("tokens").alias("n_tokens"),
        F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept")


def oracle_ctes(documents: str = "documents") -> str:
    """DuckDB CTEs that end in ``mixed``: the same fitting as nested windows."""
    topic = "CASE " + " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in TOPICS[:-1]) + f" ELSE '{TOPICS[-1][0]}' END"
    q = [f"d AS (SELECT *, {topic} AS topic, len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) AS n_tokens FROM {documents})",
         "c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL)"]
    goals = []
    for d in DIMS:
        q.append(f"n_{d} AS (SELECT sum(pow(m, {TARGETS[d]})) AS norm FROM (SELECT sum(tokens) AS m FROM c GROUP BY {d}) WHERE m > 0)")
        goals.append(f"CASE WHEN sum(tokens) OVER (PARTITION BY {d}) > 0 THEN pow(sum(tokens) OVER (PARTITION BY {d}), {TARGETS[d]}) ELSE 0 END"
                     f" / (SELECT norm FROM n_{d}) * (SELECT sum(tokens) FROM c) AS goal_{d}")
    q.append(f"w0 AS MATERIALIZED (SELECT *, {', '.join(goals)}, CAST(1 AS DOUBLE) AS weight FROM c)")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            have = f"sum(tokens * weight) OVER (PARTITION BY {d})"
            q.append(f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {have} > 0 THEN weight * goal_{d} / {have} ELSE weight END AS weight) FROM w{k})")
            k += 1
    q.append(f"""mixed AS (SELECT d.*, weight, least(1, (SELECT 1 / max(weight) FROM w{k}) * weight) AS probability,
  CAST(concat('0x', substr(md5(concat('mix', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 8)) AS BIGINT) / 4294967296.0
    < least(1, (SELECT 1 / max(weight) FROM w{k}) * weight) AS kept
FROM d JOIN w{k} AS w ON d.source IS NOT DISTINCT FROM w.source AND d.lang IS NOT DISTINCT FROM w.lang AND d.topic IS NOT DISTINCT FROM w.topic)""")
    return ",\n".join(q)


ORACLE_SQL = ("WITH " + oracle_ctes() + "\nSELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, "
              "round(probability, 6) AS probability, kept FROM mixed")
