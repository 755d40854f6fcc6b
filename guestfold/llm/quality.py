"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

*Terms* of a text are trigrams of byte classes (letters, capitals, digits, kinds of
marks, ...) and repeats (a word that follows itself, a line that was there before).  A bounded sample
of labelled texts gives the terms' idf and, by truncated SVD of the weighted term
matrix, a latent space.  The projection and the sample's latent vectors (both of a size
fixed by parameters) are broadcast; every document is projected, its exact cosine with every labelled
vector is computed in blocks, and the nearest labelled vectors vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns_as, held_out, text_batches

#: Bound of the labelled sample: the rows of least hash of the id.
MAX_LABELLED = 4096
DIMENSIONS, NEIGHBOURS, POWER, THRESHOLD = 48, 25, 16.0, 0.3
#: Bytes by class; every other byte (ASCII lower case and beyond ASCII) is a letter.
CLASSES = {1: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2: b"0123456789", 3: b" ", 4: b"\t\n\v\f\r", 5: b".", 6: b",;:", 7: b"!", 8: b"?",
           9: b"\"'`", 10: b"()[]{}", 11: b"|", 12: b"#$%&*", 13: b"-_/\\", 14: b"=+~^@", 15: b"<>"}
N_TERMS = 16 ** 3 + 2
_CLASS = np.zeros(256, np.uint16)
for _k, _v in CLASSES.items():
    _CLASS[list(_v)] = _k


def terms(text: bytes | None) -> np.ndarray:
    """Relative term frequencies of a UTF-8 text, square-rooted (length N_TERMS; all zero for an empty text)."""
    out = np.zeros(N_TERMS, np.float32)
    if not text:
        return out
    c = _CLASS[np.frombuffer(text, np.uint8)]
    if len(c) < 3:
        c = np.concatenate((c, np.full(3 - len(c), 4, np.uint16)))
    out[:-2] = np.bincount((c[:-2] << 8) + (c[1:-1] << 4) + c[2:], minlength=16 ** 3) / (len(c) - 2)
    words, lines = text.split(), text.split(b"\n")
    if words:
        out[-2] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    out[-1] = 1 - len(set(lines)) / len(lines)
    return np.sqrt(out)


@dataclass
class Model:
    """What is broadcast: N_TERMS x DIMENSIONS and MAX_LABELLED x DIMENSIONS floats at most."""
    own: np.ndarray         # the terms that the sample has
    projection: np.ndarray  # of the weighted own terms to the latent space
    vectors: np.ndarray     # unit vectors of the labelled sample
    labels: np.ndarray
    prior: float

    def score(self, x: np.ndarray, block: int = 1024) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        out = np.full(len(x), self.prior)
        if not len(self.vectors):
            return out
        z = unit(x[:, self.own] @ self.projection)
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(z), block):
            cosine = z[at:at + block] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            good = total > 1e-12
            out[at:at + block][good] = vote[good] / total[good]
        return np.clip(out, 0, 1)


def unit(z: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(z, axis=1, keepdims=True)
    return np.divide(z, n, out=np.zeros_like(z), where=n > 1e-9)


def fit_model(x: np.ndarray, y: np.ndarray) -> Model:
    """Latent space (truncated SVD by subspace iteration) of the rows of ``x`` with labels ``y``."""
    if not len(y):
        return Model(np.zeros(0, int), np.zeros((0, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    own = np.flatnonzero(x.any(axis=0))
    x = x[:, own]
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    gram = (x * idf).T.astype(np.float64) @ (x * idf)
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(len(own), min(DIMENSIONS, len(own)))))[0]
    for _ in range(12):
        q = np.linalg.qr(gram @ q)[0]
    projection = (idf[:, None] * q).astype(np.float32)
    return Model(own, projection, unit(x @ projection), y.astype(np.float64), float(y.mean()))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the ``max_labelled`` labelled rows of least id hash that are not held out (see
    :func:`guestfold.llm.common.held_out`).  Null labels teach nothing; of several labels of an id the largest counts."""
    known = (columns_as(labels, id=id_col, y=label_col).filter(F.col("y").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    rows = columns_as(df, id=id_col, text=text_col).filter("id is not null").join(F.broadcast(known), "id")

    def sparse(frames):
        for f in text_batches(frames):
            found = [(i, y, t) for i, y, t in zip(f["id"], f["y"], map(terms, f["text"]))]
            yield pd.DataFrame([(str(i), float(y), np.flatnonzero(t).astype(np.uint16).tobytes(), t[t > 0].tobytes())
                                for i, y, t in found], columns=["id", "y", "at", "value"])

    # a repeated id counts once: what comes to the driver stays within the bound
    got = (rows.select("id", "y", F.col("text").cast("binary").alias("text"))
           .mapInPandas(sparse, "id string, y double, at binary, value binary")
           .groupBy("id").agg(F.min(F.struct("y", "at", "value")).alias("r")).select("id", "r.*").collect())
    got.sort(key=lambda r: r["id"])
    x = np.zeros((len(got), N_TERMS), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return fit_model(x, np.array([r["y"] for r in got]))


def score_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """The score of a text column; only the text goes to Python."""
    sent = spark.sparkContext.broadcast(model)

    def apply(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        for s in series:
            scores = [m.score(np.stack([terms(t) for t in s.iloc[at:at + 2048]])) for at in range(0, len(s), 2048)]
            yield pd.Series(np.concatenate(scores) if scores else [], dtype="float64")

    return F.pandas_udf(apply, "double")(text.cast("binary"))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``id_col``, held_out, score (0 to 1, higher: label 1 likelier), predicted
    (1 if score >= ``threshold``).

    Null, empty and one-character texts are scored: without terms they get the sample's share of label 1
    (0.5 if nothing was labelled).  Repeated rows: one result each.  A null id passes through, held out.
    Empty table: no rows.  Other columns are neither read nor returned."""
    rows = columns_as(df, id=id_col, text=text_col)
    out = rows.select("id", score_of(F.col("text"), model, df.sparkSession).alias("score"))
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
