"""Near-duplicate vectors by cross-polytope hashing with multiprobe.

*Hash.*  Three rounds of random signs and a fast Hadamard transform rotate a vector pseudo-randomly; its
hash is the nearest of the 2d signed axes, which is the coordinate of greatest size with its sign.  A table joins k such hashes
to one key.  A vector enters each of L tables under ``probes`` keys: its own and those that
the smallest steps to farther axes give.  k grows with the log of the number of vectors, so
that a key stays rare; probes and L are those of least work for which a simulated pair exactly at the threshold shares a key with
probability ``RECALL`` or more (closer pairs more).

*Verification.*  Copies of a vector are one node.  Keys that only one node has are dropped before any
vector is moved.  The nodes of a key meet in blocks: a hot key's nodes are dealt over parts, and each pair of
parts is a block of its own.  A block takes the cosines of all its pairs in double precision.
A pair counts under the first key alone that its two nodes share, so each link counts once, though no list of pairs is ever written: a
block returns how many links each node has, and a forest that connects its linked nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, columns_as
from .components import connected_components

THRESHOLD = 0.9
#: Least probability that a pair at the threshold shares a key.
RECALL = 0.99
#: Axes of one hash that probes may step to.
AXES = 4
#: Vectors are filled up with zeros to a power of two and to this length at least: signs and Hadamard transforms
#: rotate short or sparse vectors poorly.
LEAST_DIMS = 64
#: A key should have this many nodes by chance.
CROWD = 0.25
#: Most nodes of a part of a key; batches of vectors that are hashed at once.
PART, HASH_BATCH = 1024, 4096
#: Blocks of up to so many nodes are verified many at once.
SMALL = 64
SEED = 11


def _sylvester(n: int) -> np.ndarray:
    i = np.arange(n)
    return 1.0 - 2.0 * (np.bitwise_count(i[:, None] & i) & 1)


_STEPS = {n: _sylvester(n) for n in (2, 4, 8)}


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of the rows (length a power of two), eight to one step."""
    n, left = x.shape[1], x.shape[1]
    while left > 1:
        r = min(8, left)
        # the next factor of the transform: along the last axis, which then comes first
        x = (x.reshape(len(x) * n // r, r) @ _STEPS[r]).reshape(len(x), n // r, r).transpose(0, 2, 1).reshape(len(x), n)
        left //= r
    return x / np.sqrt(n)


@dataclass
class Hasher:
    """``signs``: tables x hashes x rounds x d random signs."""
    signs: np.ndarray
    probes: int

    def keys(self, x: np.ndarray) -> np.ndarray:
        """len(x) x (tables * probes) keys, the table in the low bits, so that a key names its table."""
        if not len(x):
            return np.zeros((0, len(self.signs) * self.probes), np.int64)
        return np.concatenate([(self._table(x, s) << np.int64(8)) | np.int64(t) for t, s in enumerate(self.signs)], axis=1)

    def _table(self, x: np.ndarray, signs: np.ndarray) -> np.ndarray:
        d = x.shape[1]
        cost, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for rounds in signs:
            y = x
            for r in rounds:
                y = hadamard(y * r)
            size = np.abs(y)
            axis = np.argpartition(-size, min(AXES, d) - 1, axis=1)[:, :AXES]
            axis = np.take_along_axis(axis, np.argsort(-np.take_along_axis(size, axis, 1), axis=1, kind="stable"), 1)
            near = np.take_along_axis(size, axis, 1)
            axis = axis * 2 + (np.take_along_axis(y, axis, 1) < 0)
            cost = (cost[:, :, None] + ((near[:, :1] - near) ** 2)[:, None, :]).reshape(len(x), -1)
            code = (code[:, :, None] * (2 * d) + axis[:, None, :]).reshape(len(x), -1)
            if cost.shape[1] > self.probes:
                best = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
                cost, code = np.take_along_axis(cost, best, 1), np.take_along_axis(code, best, 1)
        if code.shape[1] < self.probes:  # few axes: the own key again
            code = np.concatenate((code, np.repeat(code[:, :1], self.probes - code.shape[1], axis=1)), axis=1)
        return code


def plan(d: int, n_nodes: int, threshold: float) -> Hasher:
    """Signs for ``n_nodes`` vectors of ``d`` (a power of two) components."""
    rng, best = np.random.default_rng(SEED), None
    pairs = 2000
    a, b = rng.normal(size=(2, pairs, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= a * (a * b).sum(axis=1, keepdims=True)
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = threshold * a + np.sqrt(1 - threshold ** 2) * b
    for probes in (4, 8, 16, 32):
        hashes = min(max(1, ceil(log(max(1, n_nodes * probes / CROWD)) / log(2 * d))), max(1, int(54 / np.log2(2 * d))))
        one = Hasher(rng.choice([-1.0, 1.0], size=(1, hashes, 3, d)), probes)
        left, right = one._table(a, one.signs[0]), one._table(b, one.signs[0])
        share = min(np.mean((left[:, :, None] == right[:, None, :]).any(axis=(1, 2))), 1 - 1e-9)
        if share > 0:
            tables = max(1, ceil(log(1 - RECALL) / log1p(-share)))
            if tables < 256 and (best is None or tables * probes < best[0]):
                best = (tables * probes, tables, hashes, probes)
    _, tables, hashes, probes = best or (0, 255, 1, AXES)
    return Hasher(rng.choice([-1.0, 1.0], size=(tables, hashes, 3, d)), probes)


def unit(packed, d: int) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), np.float64).reshape(-1, d)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(df: DataFrame, id_col: str, vec_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """(id, node) of every row, node null if its vector links with nothing; (node, vec, copies, least_id) of the distinct
    vectors; the padded dimension."""
    rows = columns_as(df, id=id_col, vec=vec_col).withColumn("vec", F.col("vec").cast("array<double>"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(F.forall("vec", number) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vec", F.when(usable, F.col("vec")))
    d = max(LEAST_DIMS, 1 << max(0, (rows.agg(F.max(F.size("vec"))).first()[0] or 0) - 1).bit_length())

    def pack(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            out = np.zeros((len(s), d))
            for i, v in enumerate(s):
                if v is not None:
                    out[i, :len(v)] = v
            yield pd.Series([None if v is None else (x + 0.0).tobytes() for v, x in zip(s, out)])

    rows = rows.select("id", F.pandas_udf(pack, "binary")(F.col("vec")).alias("vec"))
    rows = rows.select("id", "vec", F.sha2("vec", 256).alias("node"))
    nodes = (rows.filter("node is not null").groupBy("node")
             .agg(F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("least_id")))
    return rows.select("id", "node"), scratch.table(nodes), d


def _differ(f: pd.DataFrame) -> np.ndarray:
    """Whether each row but the first belongs to another block than the row before."""
    k = f[["key", "i", "j"]].to_numpy()
    return (k[1:] != k[:-1]).any(axis=1)


def whole_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sorted rows in frames that hold whole blocks."""
    rest: list[pd.DataFrame] = []
    for f in frames:
        cuts = np.flatnonzero(_differ(f)) + 1
        if rest and (f.iloc[0][["key", "i", "j"]] != rest[-1].iloc[-1][["key", "i", "j"]]).any():
            yield pd.concat(rest, ignore_index=True)
            rest = []
        if not len(cuts):
            rest.append(f)
            continue
        yield pd.concat([*rest, f.iloc[:cuts[-1]]], ignore_index=True)
        rest = [f.iloc[cuts[-1]:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def small_links(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray, hasher: Hasher, threshold: float):
    """Links (a, b) of rows inside many small blocks, each under the first key alone that its nodes share."""
    found = [np.zeros((2, 0), np.int64)]
    for size in np.unique(sizes).tolist():
        own = starts[sizes == size]
        step = max(1, (1 << 20) // (size * max(size, x.shape[1])))
        for at in range(0, len(own), step):
            rows = own[at:at + step, None] + np.arange(size)
            y = x[rows]
            g, a, b = np.nonzero(np.triu(y @ y.transpose(0, 2, 1) >= threshold, 1))
            found.append(np.stack((rows[g, a], rows[g, b])))
    a, b = np.concatenate(found, axis=1)
    rows, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    known = np.concatenate([hasher.keys(x[rows[at:at + HASH_BATCH]]) for at in range(0, max(1, len(rows)), HASH_BATCH)])
    first = np.zeros(len(a), bool)
    for at in range(0, len(a), HASH_BATCH):
        some = slice(at, at + HASH_BATCH)
        ka, kb = known[place[:len(a)][some]], known[place[len(a):][some]]
        common = (ka[:, :, None] == kb[:, None, :]).any(axis=2)
        first[some] = np.where(common, ka, np.iinfo(np.int64).max).min(axis=1) == keys[a[some]]
    return a[first], b[first]


def large_links(x: np.ndarray, left: np.ndarray, right: np.ndarray, own: int, hasher: Hasher, threshold: float):
    """The same for the pairs left x right of one block of key ``own`` (left and right are the same or disjoint)."""
    same = len(left) == len(right) and (left == right).all()
    close = x[left] @ x[right].T >= threshold
    if same:
        close = np.triu(close, 1)
    some = np.union1d(left[close.any(axis=1)], right[close.any(axis=0)])  # only these can be linked
    keys = hasher.keys(x[some])
    r, c = np.nonzero(keys < own)
    values, which = np.unique(keys[r, c], return_inverse=True)
    order = np.argsort(which, kind="stable")
    ends = np.cumsum(np.bincount(which, minlength=len(values)))
    place_l, place_r = np.full(len(x), -1), np.full(len(x), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    for start, end in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist()):
        if end - start > 1:  # pairs that share an earlier key too
            group = some[np.unique(r[order[start:end]])]
            at_l, at_r = place_l[group], place_r[group]
            close[np.ix_(at_l[at_l >= 0], at_r[at_r >= 0])] = False
    a, b = np.nonzero(close)
    return left[a], right[b]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the least node that is reachable over the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def vector_links(nodes: DataFrame, d: int, threshold: float, scratch: Scratch) -> DataFrame:
    """(node, n_links, root): per block, a node's links (copies of the other node counted) and a node that it is connected with."""
    n_nodes = nodes.count()
    hasher = plan(d, n_nodes, threshold)
    sent = nodes.sparkSession.sparkContext.broadcast(hasher)

    def keyed(frames):
        for f in frames:
            for at in range(0, len(f), HASH_BATCH):
                own = f.iloc[at:at + HASH_BATCH]
                keys = np.sort(sent.value.keys(unit(own["vec"], d)), axis=1)
                fresh = np.concatenate((np.ones((len(own), 1), bool), keys[:, 1:] != keys[:, :-1]), axis=1)
                nodes_ = np.repeat(own["node"].to_numpy(object), fresh.sum(axis=1))
                yield pd.DataFrame({"node": pd.Series(nodes_, dtype=object), "key": keys[fresh]})

    keys = scratch.table(nodes.select("node", "vec").mapInPandas(keyed, "node string, key bigint"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # a hot key's nodes: part by hash, and a block for each pair of parts
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    met = (keys.join(shared, "key").withColumn("parts", parts)
           .withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .select("node", "key", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")))
    met = met.join(nodes.select("node", "vec", "copies"), "node")

    def verify(frames):
        for f in whole_blocks(frames):
            x, keys = unit(f["vec"], d), f["key"].to_numpy()
            part, i, j = (f[c].to_numpy() for c in ("part", "i", "j"))
            names, copies = f["node"].to_numpy(object), f["copies"].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], _differ(f))))
            sizes = np.diff(np.append(starts, len(f)))
            a, b = small_links(x, starts[(sizes <= SMALL) & (i[starts] == j[starts])], sizes[(sizes <= SMALL) & (i[starts] == j[starts])],
                               keys, sent.value, threshold)
            for start, size in zip(starts.tolist(), sizes.tolist()):
                if size > SMALL or i[start] != j[start]:
                    at = slice(start, start + size)
                    left, right = np.flatnonzero(part[at] == i[start]), np.flatnonzero(part[at] == j[start])
                    la, lb = large_links(x[at], left, right, int(keys[start]), sent.value, threshold)
                    a, b = np.concatenate((a, la + start)), np.concatenate((b, lb + start))
            count = np.bincount(a, copies[b], len(f)) + np.bincount(b, copies[a], len(f))
            root, has = forest(a, b, len(f)), count > 0
            yield pd.DataFrame({"node": pd.Series(names[has], dtype=object), "n_links": count[has].astype(np.int64),
                                "root": pd.Series(names[root[has]], dtype=object)})

    met = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return met.mapInPandas(verify, "node string, n_links bigint, root string")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``id_col``, n_links (other rows linked directly, copies included), component_id (the smallest id
    reachable by links, itself included), kept (whether its id is the component's).

    Rows link when the cosine of their vectors, in double precision, is at least ``threshold`` (above 0) and they
    share a key (see the module); copies of a vector always link.  Vectors that are null, empty, zero or hold a null or non-finite
    component link with nothing: n_links 0, their own id.  Vectors shorter than others count as filled up with zeros.
    Repeated rows are rows of their own and link.  A null id passes through, never names a component that has
    other ids, and is kept only where its component has no id.  Empty table: no rows.  Other columns are neither read nor returned."""
    scratch = Scratch(df.sparkSession)
    rows, nodes, d = nodes_of(df, id_col, vec_col, scratch)
    found = scratch.table(vector_links(nodes, d, threshold, scratch))
    roots = connected_components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    named = (nodes.select("node", "copies", "least_id").join(counts, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = named.join(least, "root").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
    out = rows.join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


#: DuckDB SQL of the query: the cosines of all pairs.
ORACLE_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""
