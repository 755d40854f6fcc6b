"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a value within half the radius of both.
So every distinct fingerprint emits its whole ball of half the radius (2081 values
of 64 bits for a radius of 4), the values are shuffled, and fingerprints that meet
at a value are linked after their distance was verified.

A value is never written out.  The 64 bits fall into k classes, and a value's *group* is
the parity of its bits in each class.  Flipping bits moves a fingerprint's own group by
an offset that depends on the flipped bits only, so its ball lies in 1 + k + k(k-1)/2 groups
(for two flips), and the sender emits (group, fingerprint) once for each: the receiver knows from
the offset which part of the ball is meant and makes those values itself.  It sorts them and links
the fingerprints that meet at a value as a star around one of them, never as all pairs.
k grows with the log of the number of fingerprints, so that a group has about ``GROUP_VALUES`` values.  All 64
bits enter the group, so near copies with different fingerprints fall into different groups;
copies of a text were combined to one fingerprint before.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, columns_as
from .components import connected_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: An odd multiplier: mixing is a bijection of the 64-bit values.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Values that a receiver makes and sorts at once, and about as many as a group has.
GROUP_VALUES = 1 << 20
#: Groups of a receiving task; fingerprints of a sending task (bytes say nothing of the work, so the counts are set).
TASK_GROUPS, TASK_FPS = 4, 8192
#: Most tasks on either side of that shuffle; beyond it a task takes more groups, one after the other, or more fingerprints.
MAX_TASKS = 20_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words between ASCII white space, XXH64 of the space-joined
    shingles; a bit is 1 if set in over half of the hashes.  Fewer words: one shingle; none: 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:n - 1]))
    f, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    ends = (ends[min(shingle, len(words)) - 1:] - 1)
    for at in range(0, n, 1 << 16):
        s, e = starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist()
        h = np.fromiter((f(joined[i:j], SEED) for i, j in zip(s, e)), np.uint64, len(s))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE, *more: str) -> DataFrame:
    """(id, fp) and the columns ``more`` of (id, text); fp is the fingerprint as a signed long."""
    def make(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in s), np.uint64, len(s)).view(np.int64))

    return rows.select("id", *more, F.pandas_udf(make, "bigint")(F.col("text").cast("binary")).alias("fp"))


def ball_masks(radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)], np.uint64)


def group_of(values: np.ndarray, k: int) -> np.ndarray:
    """The parities of the bits b, b + k, b + 2k, ... for each class b, as a number of k bits."""
    out = np.zeros(values.shape, np.int64)
    for c in range(k):
        bits = np.uint64(sum(1 << b for b in range(c, 64, k)))
        out |= (np.bitwise_count(values & bits) & np.uint8(1)).astype(np.int64) << c
    return out


def links(fps: DataFrame, max_bits: int, n_fps: int) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints ``fp``: for fingerprints that meet at a value,
    one link from each to one of them.  Components are those of all pairs within ``max_bits``."""
    masks = ball_masks((max_bits + 1) // 2)
    k = min(40, ceil(log2(max(1, n_fps * len(masks) / GROUP_VALUES))))
    moved = group_of(masks, k)
    parts = {int(o): masks[moved == o] for o in np.unique(moved)}  # what of the ball lies at an offset

    def send(frames):
        offsets = np.array(list(parts), np.int64)
        for f in frames:
            fp = f["fp"].to_numpy()
            g = (group_of(fp.view(np.uint64), k)[:, None] ^ offsets[None, :]).ravel()
            order = np.argsort(g, kind="stable")
            g, who = g[order], fp[order // len(offsets)]
            cuts = np.flatnonzero(np.diff(g)) + 1
            starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(g)]))
            for i in range(0, len(starts), 4096):
                own = slice(i, i + 4096)
                yield pd.DataFrame({"g": g[starts[own]], "fps": [who[s:e].tobytes() for s, e in zip(starts[own].tolist(), stops[own].tolist())]})

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        fp = np.frombuffer(b"".join(f["fps"]), np.uint64)
        offset = group_of(fp, k) ^ int(f["g"].iloc[0])
        total = sum(int((offset == o).sum()) * len(m) for o, m in parts.items())
        slices = ceil(total / (2 * GROUP_VALUES))  # over 1 in an uneven group: its values are made again for each
        found = [np.zeros((0, 2), np.uint64)]
        for s in range(slices):
            values, owners = [], []
            for o in np.unique(offset).tolist():
                own, part = fp[offset == o], parts[o]
                step = max(1, GROUP_VALUES // len(part))
                for at in range(0, len(own), step):
                    v = (own[at:at + step, None] ^ part[None, :]).ravel()
                    w = np.repeat(own[at:at + step], len(part))
                    if slices > 1:
                        keep = (v * MIX >> np.uint64(33)) % np.uint64(slices) == s
                        v, w = v[keep], w[keep]
                    values.append(v), owners.append(w)
            found.append(_stars(np.concatenate(values), np.concatenate(owners), max_bits // 2))
        pairs = np.unique(np.concatenate(found), axis=0)
        pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= max_bits].view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = fps.select("fp").mapInPandas(send, "g bigint, fps binary").repartition(min(MAX_TASKS, max(1, (1 << k) // TASK_GROUPS)), "g")
    return sent.groupBy("g").applyInPandas(meet, "a bigint, b bigint").distinct()


def _stars(values: np.ndarray, owners: np.ndarray, near: int) -> np.ndarray:
    """Distinct (centre, owner) pairs of the owners that share a value; the centre is the least owner within
    ``near`` bits of it.  (For an odd radius some owners are one bit farther: two of those needn't be close.)"""
    s = np.sort(values)
    met = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(met):
        return np.zeros((0, 2), np.uint64)
    own = np.flatnonzero(met[np.minimum(np.searchsorted(met, values), len(met) - 1)] == values)
    value, who = values[own], owners[own]
    far = np.bitwise_count(value ^ who) > near
    order = np.lexsort((who, far, value))
    value, who, far = value[order], who[order], far[order]
    first = np.concatenate(([True], value[1:] != value[:-1]))
    at = np.flatnonzero(first)[np.cumsum(first) - 1]
    return np.unique(np.stack((who[at], who), axis=1)[(who[at] != who) & ~far[at]], axis=0)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``id_col``, fingerprint (16 lowercase hex digits) and component_id, the smallest
    id that is reachable over fingerprints at most ``max_bits`` bits apart.

    Null and wordless texts have fingerprint zero, which links like any other.  Repeated rows: one
    result row each.  Null ids pass through and name a component only when all its ids are null (component_id null).
    Empty table: no rows.  Other columns are neither read nor returned.  ``max_bits`` 0 to 6."""
    scratch = Scratch(df.sparkSession)
    rows = scratch.table(fingerprints(columns_as(df, id=id_col, text=text_col), shingle))
    of_fp = components_of(rows, max_bits, scratch).select("fp", "component_id")
    return rows.join(of_fp, "fp", "left").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def components_of(rows: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """(fp, root, component_id) of the fingerprints of (id, fp): fingerprints of one component share a root."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0 to 6: the ball of half the radius grows as 64^k / k!")
    fps = scratch.table(rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    n_fps = fps.count()
    edges = links(fps.repartition(min(MAX_TASKS, max(1, ceil(n_fps / TASK_FPS))), "fp"), max_bits, n_fps)
    roots = connected_components(edges, scratch)
    named = (fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return named.filter(F.col("root").isNotNull()).join(least, "root").select("fp", "root", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The input's rows, all columns, of which one stays per component: that of least id (null last), then of least md5 of the
    text (null counts as empty); of rows equal in both any one.

    Rows are told apart by id and md5 of the text, so repeated and null ids lose no distinct text.  Only ids and digests are
    judged; the texts are dealt once to meet the decisions, and never sorted.  Empty table: no rows.  Columns may have any names."""
    scratch = Scratch(df.sparkSession)
    digest = lambda c: F.md5(F.coalesce(c, F.lit("")).cast("binary"))
    slim = columns_as(df, id=id_col, text=text_col)
    rows = scratch.table(fingerprints(slim.withColumn("digest", digest(F.col("text"))), shingle, "digest"))
    of_fp = components_of(rows, max_bits, scratch).select("fp", "root")
    keys = rows.groupBy("id", "digest", "fp").agg(F.count("*").alias("n")).join(of_fp, "fp")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest", "n"))
    kept = scratch.table(keys.groupBy("root").agg(first.alias("k")).select("k.id", "k.digest", "k.n"))
    whole = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))  # no name can clash inside
    marked = whole.withColumn("digest", digest(F.col(f"row.`{text_col}`")))
    same = F.col(f"row.`{id_col}`").eqNullSafe(kept["id"]) & (marked["digest"] == kept["digest"])
    met = marked.join(kept.hint("shuffle_hash"), same).select("row", kept["id"], kept["digest"], "n")
    one = met.filter("n = 1").select("row.*")
    if kept.filter("n > 1").isEmpty():
        return one
    order = Window.partitionBy("id", "digest").orderBy(F.xxhash64("row"))
    again = met.filter("n > 1").withColumn("at", F.row_number().over(order)).filter("at = 1")
    return one.unionByName(again.select("row.*"))
