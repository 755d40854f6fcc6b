"""URL filter: host and path rules, and gradient-boosted trees for what no rule fits.

URLs that a rule judges are the labelled ones.  A bounded sample of them trains boosted trees
(Spark ML) on lexical features: lengths, depth, digit ratio, entropy, parameter counts and
the labelled block rate of the host's last and last two labels.  Rules, features and scoring are
DataFrame expressions; the rate table has a row per suffix of the sample, so its size is bounded too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch, columns_as

#: Bounds: rules are one expression; labelled URLs are those of least hash.
MAX_RULES, MAX_LABELLED = 500, 20_000
TREES, DEPTH = 12, 4
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "marks", "parameters",
            "rate_1", "rate_2", "seen_1", "seen_2"]


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for a null."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")),
            F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit("")))


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equally long ones the first by text), else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; one expression holds {MAX_RULES}")
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of ``url``, ``host`` and ``path``, and the host's last one and two labels."""
    url, n = F.col("url"), F.greatest(F.length("url"), F.lit(1))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    share = lambda c: (F.length("url") - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0),
                          lambda total, c: total - F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    return df.withColumns({
        "length": F.length("url").cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": count("path", "/"), "labels": count("host", r"\."),
        "digits": count("url", "[0-9]") / n, "entropy": entropy, "marks": count("url", "[-_~%.+,;:@!]") / n,
        "parameters": count("url", "[?&][^=&#]*="), "suffix_1": F.substring_index("host", ".", -1),
        "suffix_2": F.substring_index("host", ".", -2)})


def _with_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds block rate and log count of the two suffixes (0.5 and 0 where the sample has none)."""
    for k in (1, 2):
        own = rates.filter(F.col("kind") == k).select(F.col("suffix").alias(f"suffix_{k}"), F.col("rate").alias(f"rate_{k}"),
                                                      F.col("seen").alias(f"seen_{k}"))
        df = (df.join(F.broadcast(own), f"suffix_{k}", "left")
              .withColumn(f"rate_{k}", F.coalesce(f"rate_{k}", F.lit(0.5))).withColumn(f"seen_{k}", F.coalesce(f"seen_{k}", F.lit(0.0))))
    return df


@dataclass
class Model:
    trees: GBTClassificationModel | None
    rates: DataFrame
    constant: float  # the block probability where fewer than two verdicts were labelled

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``block``, the probability of a block verdict, to rows of (url, host, path)."""
        if self.trees is None:
            return rows.withColumn("block", F.lit(self.constant))
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_rates(lexical(rows), self.rates))
        return (self.trees.transform(ready).withColumn("block", vector_to_array("probability")[1])
                .select(*rows.columns, "block"))


def fit(labelled: DataFrame, scratch: Scratch, max_labelled: int = MAX_LABELLED) -> Model:
    """Trees from (url, host, path, verdict): the ``max_labelled`` distinct URLs of least hash."""
    sample = (labelled.groupBy("url", "host", "path").agg(F.min("verdict").alias("verdict"))
              .orderBy(F.xxhash64("url"), "url").limit(max_labelled))
    sample = scratch.table(lexical(sample).withColumn("label", (F.col("verdict") == "block").cast("double")))
    rate = lambda k: (sample.groupBy(F.col(f"suffix_{k}").alias("suffix"))
                      .agg(((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias("rate"), F.log1p(F.count(F.lit(1)).cast("double")).alias("seen"))
                      .withColumn("kind", F.lit(k)))
    rates = scratch.table(rate(1).unionByName(rate(2)))
    low, high = sample.agg(F.min("label"), F.max("label")).first()
    if low is None or low == high:
        return Model(None, rates, low or 0.0)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_rates(sample, rates)).select("features", "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, checkpointInterval=-1).fit(ready.coalesce(2))
    return Model(trees, rates, 0.0)


def filter_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule (null where none fits), verdict
    (``allow`` or ``block``: the rule's, else the trees') and block_score, the trees' probability of ``block``.

    Null URL or no ``://``: host and path are empty, no rule fits, the trees judge the text as it is.  Repeated rows:
    one result each, trained on once.  Null ids pass through.  Where the rules label fewer than two verdicts, that
    one (``allow`` if none) holds for all other URLs.  Empty table: no rows.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows = columns_as(df, id=id_col, raw=url_col)
    host, path = url_parts(F.col("raw"))
    rows = rows.select("id", F.coalesce("raw", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    text, verdict = rule_of(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": text, "by_rule": verdict})
    labelled = rows.filter(F.col("by_rule").isNotNull()).select("url", "host", "path", F.col("by_rule").alias("verdict"))
    out = fit(labelled, scratch, max_labelled).score(rows)
    learnt = F.when(F.col("block") > 0.5, "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", learnt).alias("verdict"),
                      F.col("block").alias("block_score"))


#: The rules of the driver query.
RULES = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]
