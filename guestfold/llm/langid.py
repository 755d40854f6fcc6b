"""Language ID as inference in a mixture of languages.

A document's byte trigrams are draws from a mixture of the learned languages'
trigram distributions.  Expectation-maximisation estimates the document's language proportions; the
language set grows from the best single language by the language that raises the
likelihood most, as long as the gain exceeds a penalty that grows with the log of
the number of trigrams (as in the Bayesian information criterion).  The prediction is the set's largest part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_as, held_out, text_batches, text_ids

#: Bound of the sample: documents a language, those of least hash of the id, and languages.
MAX_DOCS, MAX_LANGUAGES = 1500, 256
BUCKETS = 1 << 15
#: EM rounds; penalty a language, in units of half the log of the number of trigrams (three trigrams share a byte).
ROUNDS, PENALTY = 12, 3.0
UNKNOWN = "und"
#: Lower-case letters of ASCII and all bytes beyond it stay; what is between words becomes one zero byte.
_KEEP = np.zeros(256, np.uint32)
_KEEP[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[128:] = np.arange(128, 256)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram buckets of a text's lower-cased words, with counts; trigrams of words only."""
    b = _KEEP[np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)]
    b = b[np.concatenate(([True], (b[1:] != 0) | (b[:-1] != 0)))]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    counts = np.bincount((codes * np.uint32(2654435761)) >> np.uint32(17), minlength=BUCKETS)
    own = np.flatnonzero(counts)
    return own, counts[own]


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


@dataclass
class Model:
    """MAX_LANGUAGES x BUCKETS floats at most."""
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_docs: int = MAX_DOCS) -> Model:
    """Trigram distributions (add-1/2 smoothed) of the languages in ``lang_col``, from at most ``max_docs`` documents each that are not held out."""
    rows = columns_as(df, id=id_col, lang=lang_col).filter(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    rows = rows.dropDuplicates(["id", "lang"]).withColumn("n", F.row_number().over(by)).filter(F.col("n") <= max_docs)
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    texts = columns_as(df, id=id_col, lang=lang_col, text=text_col).join(F.broadcast(rows.select("id", "lang")), ["id", "lang"])

    def count(frames):
        sums: dict[str, np.ndarray] = {}
        for f in text_batches(frames):
            for lang, text in zip(f["lang"], f["text"]):
                if has_letter(text):
                    own, n = trigrams(text)
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[own] += n
        for lang, n in sums.items():
            own = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": own, "n": n[own]})

    got = (texts.select("lang", "text").mapInPandas(count, "lang string, bucket bigint, n bigint")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))  # BUCKETS at most
           .collect())
    counts = np.full((BUCKETS, len(names)), 0.5)
    for r in got:
        at = np.array([(x["bucket"], x["n"]) for x in r["counts"]], np.int64)
        counts[at[:, 0], names.index(r["lang"])] += at[:, 1]
    return Model(names, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def mixture(p: np.ndarray, n: np.ndarray, doc: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM over many documents at once: ``p`` likelihoods (entries x languages), ``n`` counts, ``doc`` the
    document of an entry, ``starts`` its first entry.  Returns (documents x languages proportions, log likelihood)."""
    total = np.add.reduceat(n, starts)
    pi = np.full((len(starts), p.shape[1]), 1 / p.shape[1])
    for _ in range(rounds):
        r = pi[doc] * p
        r *= (n / np.maximum(r.sum(axis=1), 1e-300))[:, None]
        pi = np.add.reduceat(r, starts, axis=0) / total[:, None]
    mixed = np.einsum("ij,ij->i", pi[doc], p)
    return pi, np.add.reduceat(n * np.log(np.maximum(mixed, 1e-300)), starts)


def infer(found: list[tuple[np.ndarray, np.ndarray]], m: Model, penalty: float = PENALTY, rounds: int = ROUNDS) -> list[dict[int, float]]:
    """Per document (its trigrams, at least one), the selected languages with their proportions."""
    sizes = np.array([len(own) for own, _ in found])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    doc = np.repeat(np.arange(len(found)), sizes)
    n = np.concatenate([c for _, c in found]).astype(np.float64)
    log_p = m.log_p[np.concatenate([own for own, _ in found])].astype(np.float64)
    top = log_p.max(axis=1, keepdims=True)  # likelihoods relative to the best language: no underflow
    p = np.exp(log_p - top)
    single = np.add.reduceat(n[:, None] * (log_p - top), starts, axis=0)
    best = single.argmax(axis=1)
    _, full = mixture(p, n, doc, starts, rounds)
    cost = penalty * 0.5 * np.log(np.add.reduceat(n, starts) + 1)
    out = []
    for d, b in enumerate(best.tolist()):
        pi, ll, own = np.ones(1), single[d, b], [b]
        while full[d] - ll > cost[d] and len(own) < p.shape[1]:  # no set is likelier than the full one
            rows, tried = slice(starts[d], starts[d] + sizes[d]), []
            for lang in set(range(p.shape[1])) - set(own):
                got, value = mixture(p[rows][:, [*own, lang]], n[rows], np.zeros(sizes[d], int), np.zeros(1, int), 2 * rounds)
                tried.append((value[0], -lang, got[0]))
            value, lang, got = max(tried, key=lambda t: t[:2])
            if value - ll <= cost[d]:
                break
            pi, ll, own = got, value, [*own, -lang]
        out.append(dict(zip(own, pi.tolist())))
    return out


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, held_out, lang_pred, score (the predicted language's share of the
    document, 0 to 1) and mixture (language to share, of the selected set).

    ``und`` with score 0 and an empty mixture where the text is null or has no letter, or nothing was learnt; of languages with
    equal shares the first by name.  Repeated rows: one result each.  A null id passes through, held out.  Empty
    table: no rows.  Other columns are neither read nor returned."""
    rows, kind = text_ids(columns_as(df, id=id_col, text=text_col))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = "id string, lang_pred string, score double, mixture map<string,double>"

    def apply(frames):
        m = sent.value
        for f in text_batches(frames, most=1 << 22):
            found = [trigrams(t) if m.languages and has_letter(t) else ((), ()) for t in f["text"]]
            sets = iter(infer(known, m)) if (known := [x for x in found if len(x[0])]) else iter(())
            out = []
            for own, _ in found:
                share = {m.languages[k]: min(1.0, v) for k, v in next(sets).items()} if len(own) else {}
                lang = min(share, key=lambda k: (-share[k], k), default=UNKNOWN)
                out.append((lang, share.get(lang, 0.0), share))
            o = pd.DataFrame(out, columns=["lang_pred", "score", "mixture"])
            o.insert(0, "id", f["id"].array)
            yield o

    out = rows.mapInPandas(apply, schema).withColumn("id", F.col("id").cast(kind))
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "mixture")
