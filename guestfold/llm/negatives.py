"""Hard-negative mining with segment summaries.

A vector's components are scaled and floored to whole numbers, so scores are exact integers.  The vector is cut into
segments, and each segment's mean and deviation (the length of what is left without the mean) are stored beside
it.  For two vectors, the sum over segments of length x mean x mean, plus or minus
deviation x deviation, bounds their score.  The bounds of few long segments come first;
pairs that they can't decide are bounded again by segments half as long, and what is left is scored exactly.

The anchors are dealt into slices of bounded size.  A slice is broadcast and meets every row in blocks, twice: once for the
anchors' positives and, when these are known, once for the negatives of each.  A task keeps
the best rows that it has seen for each anchor, which sharpens its bounds; only those are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, columns_as

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score in hundredths of the positive's: 50 * positive <= 100 * negative <= 95 * positive.
LOW, HIGH = 50, 95
#: Segments of the coarsest level; each next level doubles them, down to two components a segment.
COARSEST = 8
#: Anchors of a broadcast slice; anchors and rows that meet as one block.
SLICE, ANCHOR_BLOCK, ROW_BLOCK = 16384, 512, 4096
#: Pairs are taken out of a block one by one when less than this share of it is undecided.
SPARSE = 0.05
#: Vectors of this scaled length or more take no part, so scores stay below 2^52.
MAX_NORM = float(1 << 26)
_NONE = -(1 << 62)


def summaries(q: np.ndarray) -> np.ndarray:
    """Means, then deviations, of segments of two components (columns) of the whole vectors ``q``."""
    pairs = q.reshape(len(q), -1, 2)
    mean = pairs.mean(axis=2)
    return np.concatenate((mean, np.abs(pairs[:, :, 0] - pairs[:, :, 1]) / np.sqrt(2)), axis=1).astype(np.float32)


class Block:
    """Vectors with their summaries: ``levels`` lists (sqrt(length) x mean, deviation), coarse to fine."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: bytes, summary: bytes, dims: int):
        self.ids, self.labels = ids, labels
        self.q = np.frombuffer(q, np.int32).reshape(len(ids), dims).astype(np.float64)
        flat = np.frombuffer(summary, np.float32).reshape(len(ids), dims).astype(np.float64)
        mean, deviation, length = flat[:, :dims // 2], flat[:, dims // 2:], 2
        self.levels = [(np.sqrt(length) * mean, deviation)]
        while mean.shape[1] >= 2 * COARSEST:
            halves, own = mean.reshape(len(ids), -1, 2), deviation.reshape(len(ids), -1, 2)
            mean = halves.mean(axis=2)
            deviation = np.sqrt((own ** 2).sum(axis=2) + length * ((halves - mean[:, :, None]) ** 2).sum(axis=2))
            length *= 2
            self.levels.insert(0, (np.sqrt(length) * mean, deviation))
        self.norm = np.sqrt((self.q ** 2).sum(axis=1))

    def part(self, at: slice) -> Block:
        out = object.__new__(Block)
        out.ids, out.labels, out.q, out.norm = self.ids[at], self.labels[at], self.q[at], self.norm[at]
        out.levels = [(m[at], d[at]) for m, d in self.levels]
        return out


def undecided(anchors: Block, rows: Block, allowed: np.ndarray, least: np.ndarray, most: np.ndarray | None = None):
    """(anchor, row, score) of all ``allowed`` pairs whose score is at least ``least`` (per anchor) and at most ``most``, and
    of few others: what the bounds of no level rule out."""
    slack = 1e-6 * anchors.norm.max(initial=0) * rows.norm.max(initial=0) + 1e-3  # the summaries are rounded
    alive, pairs = allowed, None
    for (am, ad), (rm, rd) in zip(anchors.levels, rows.levels):
        if pairs is None:
            middle, width = am @ rm.T, ad @ rd.T
            alive = alive & (middle + width + slack >= least[:, None])
            if most is not None:
                alive &= middle - width - slack <= most[:, None]
            if np.count_nonzero(alive) < SPARSE * alive.size:
                pairs = np.nonzero(alive)
        elif len(pairs[0]):
            a, r = pairs
            middle, width = np.einsum("ij,ij->i", am[a], rm[r]), np.einsum("ij,ij->i", ad[a], rd[r])
            good = middle + width + slack >= least[a]
            if most is not None:
                good &= middle - width - slack <= most[a]
            pairs = a[good], r[good]
    if pairs is None:
        a, r = np.nonzero(alive)
        return a, r, (anchors.q @ rows.q.T)[a, r].astype(np.int64)
    a, r = pairs
    return a, r, np.einsum("ij,ij->i", anchors.q[a], rows.q[r]).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each of ``n`` lists, each id once; ``least`` is what enters a full list."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, _NONE, np.int64)
        self.of, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, of: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least[of]
        if not good.any():
            return
        of, ids, scores = (np.concatenate((old, new[good])) for old, new in ((self.of, of), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((-scores, ids, of))
        of, ids, scores = of[order], ids[order], scores[order]
        first = np.concatenate(([True], (of[1:] != of[:-1]) | (ids[1:] != ids[:-1])))
        of, ids, scores = of[first], ids[first], scores[first]
        order = np.lexsort((ids, -scores, of))
        of, ids, scores = of[order], ids[order], scores[order]
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
        self.least[of[rank == self.k - 1]] = scores[rank == self.k - 1]
        keep = rank < self.k
        self.of, self.ids, self.scores = of[keep], ids[keep], scores[keep]


def prepared(df: DataFrame, scratch: Scratch, is_anchor: Column, id_col: str, vec_col: str, label_col: str, scale: int) -> tuple[DataFrame, int]:
    """The rows that take part, (id, label, anchor, q, summary) as a written table, and the vectors' padded dimension."""
    rows = columns_as(df.withColumn("__anchor", is_anchor), id=id_col, vec=vec_col, label=label_col, anchor="__anchor")
    if not isinstance(rows.schema["id"].dataType, T.IntegralType):
        raise TypeError("ids must be whole numbers, as ties go by the smaller one")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = (rows.withColumn("vec", F.col("vec").cast("array<double>"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vec", number))
            .select(F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"),
                    F.coalesce("anchor", F.lit(False)).alias("anchor"), "vec"))
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    dims = max(2, 1 << max(0, longest - 1).bit_length())

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            q = np.zeros((len(f), dims))
            for i, v in enumerate(f["vec"]):
                q[i, :len(v)] = v
            with np.errstate(over="ignore"):
                q = np.floor(scale * q)
                fits = (q ** 2).sum(axis=1) < MAX_NORM ** 2
            q, out = q[fits], f.loc[fits, ["id", "label", "anchor"]]
            yield out.assign(q=[x.tobytes() for x in q.astype(np.int32)], summary=[x.tobytes() for x in summaries(q)])

    return scratch.table(rows.mapInPandas(whole, "id bigint, label string, anchor boolean, q binary, summary binary")), dims


def _blocks(frames: Iterator[pd.DataFrame], dims: int, codes: dict) -> Iterator[Block]:
    for f in frames:
        for at in range(0, len(f), ROW_BLOCK):
            g = f.iloc[at:at + ROW_BLOCK]
            labels = np.array([codes.get(x, -1) for x in g["label"]])
            yield Block(g["id"].to_numpy(), labels, b"".join(g["q"]), b"".join(g["summary"]), dims)


def _anchors(own: list, dims: int) -> tuple[Block, dict]:
    codes = {x: i for i, x in enumerate(dict.fromkeys(r["label"] for r in own))}
    return Block(np.array([r["id"] for r in own], np.int64), np.array([codes[r["label"]] for r in own]),
                 b"".join(bytes(r["q"]) for r in own), b"".join(bytes(r["summary"]) for r in own), dims), codes


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` distinct ids of each list among the tasks' best."""
    one = found.repartition(*by).groupBy(*by, "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _positives(rows: DataFrame, own: list, dims: int, k: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(own)

    def search(frames):
        anchors, codes = _anchors(sent.value, dims)
        best = Best(len(anchors.ids), k)
        for block in _blocks(frames, dims, codes):
            for at in range(0, len(anchors.ids), ANCHOR_BLOCK):
                some = anchors.part(slice(at, at + ANCHOR_BLOCK))
                allowed = (some.labels[:, None] == block.labels) & (some.ids[:, None] != block.ids)
                a, r, score = undecided(some, block, allowed, best.least[at:at + ANCHOR_BLOCK])
                best.add(a + at, block.ids[r], score)
        yield pd.DataFrame({"anchor": anchors.ids[best.of], "id": best.ids, "score": best.scores})

    return _ranked(rows.drop("anchor").mapInPandas(search, "anchor bigint, id bigint, score bigint"), ["anchor"], k)


def _negatives(rows: DataFrame, own: list, wanted: list, dims: int, k: int, low: int, high: int) -> DataFrame:
    """``wanted``: (anchor, positive, its score)."""
    sent = rows.sparkSession.sparkContext.broadcast((own, wanted))

    def search(frames):
        anchors, codes = _anchors(sent.value[0], dims)
        place = {i: n for n, i in enumerate(anchors.ids.tolist())}
        lists = sorted((place[a], p, s) for a, p, s in sent.value[1])
        at_anchor = np.array([x[0] for x in lists], np.int64)
        score = np.array([x[2] for x in lists], np.int64)
        least, most = -(-low * score // 100), high * score // 100
        best, n = Best(len(lists), k), len(anchors.ids)
        ceiling = np.full(n, _NONE, np.int64)
        np.maximum.at(ceiling, at_anchor, most)
        starts = np.searchsorted(at_anchor, np.arange(n + 1))
        for block in _blocks(frames, dims, codes):
            floor_ = np.full(n, -_NONE, np.int64)
            np.minimum.at(floor_, at_anchor, np.maximum(least, best.least))
            for at in range(0, n, ANCHOR_BLOCK):
                own_ = slice(at, at + ANCHOR_BLOCK)
                some = anchors.part(own_)
                allowed = (some.labels[:, None] != block.labels) & (some.ids[:, None] != block.ids)
                a, r, s = undecided(some, block, allowed, floor_[own_], ceiling[own_])
                a = a + at
                for j in range(int(np.diff(starts).max(initial=0))):  # the anchors' j-th positives
                    of = starts[a] + j
                    good = of < starts[a + 1]
                    of, rr, ss = of[good], r[good], s[good]
                    good = (ss >= least[of]) & (ss <= most[of])
                    best.add(of[good], block.ids[rr[good]], ss[good])
        of = best.of
        yield pd.DataFrame({"anchor": anchors.ids[at_anchor[of]], "positive": np.array([x[1] for x in lists], np.int64)[of],
                            "positive_score": score[of], "id": best.ids, "score": best.scores})

    out = rows.drop("anchor").mapInPandas(search, "anchor bigint, positive bigint, positive_score bigint, id bigint, score bigint")
    return _ranked(out, ["anchor", "positive", "positive_score"], k)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each row where ``is_anchor`` holds and each of its first ``positives`` rows of the same label, the first ``negatives``
    rows of another label with low * positive_score <= 100 * negative_score <= high * positive_score:
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    The score is the inner product of the floored vectors (``scale`` times a component); higher scores come first, equal ones by
    the smaller id.  Rows with a null id, label or vector, with a null or non-finite component, or with a scaled length of
    ``MAX_NORM`` or more take no part.  A vector that is shorter than others (an empty one too) counts as filled up
    with zeros.  Rows that share an id count once for each anchor, by their best score, and never for the anchor of that id; of
    several anchor rows with one id the least (label, vector) counts.  An anchor without positives, or a positive without
    negatives, gives no rows; nor does an empty table.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows, dims = prepared(df, scratch, is_anchor, id_col, vec_col, label_col, scale)
    anchors = rows.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "q", "summary")).alias("r")).select("id", "r.*")
    anchors = scratch.table(anchors)
    slices = max(1, ceil(anchors.count() / SLICE * 1.5))
    found = []
    for s in range(slices):
        own = anchors.filter(F.pmod(F.xxhash64("id"), F.lit(slices)) == s).orderBy("id").collect()
        wanted = [(r["anchor"], r["id"], r["score"]) for r in _positives(rows, own, dims, positives).collect()]
        best = _negatives(rows, own, wanted, dims, negatives, low, high)
        found.append(scratch.table(best) if slices > 1 else best)
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                      F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def driver_query(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; where it is divisible by 7, the label first becomes the next of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.withColumn("label", moved), F.col("vec_id") % 50 == 0)


#: DuckDB SQL of the query: all scores of all anchors.
ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""
