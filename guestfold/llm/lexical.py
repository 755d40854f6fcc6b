"""Ranked lexical search over K2-treaps of term-document grids.

*Index.*  Every partition of the documents is cut into blocks of bounded size.  A block's grid has a row per
term and a column per document; the point of a term in a document is its *impact*, the part of the score that depends on the
document, and is stored in a K2-treap (:mod:`guestfold.llm.treap`).  Rows stand by falling document
count, so that rare terms share quarters that are mostly empty; columns stand by id, so that equal
scores come in the order of ids.  Building it is a map; a block is one row of a written table.

*Search.*  The items are split into bounded slices, each of which is broadcast.  In every block each item's row paths descend
jointly, best first, over document ranges; a k-th score that a task has reached in one block prunes the next.
The blocks' winners are ranked per item; tasks rank their own first, so few rows are shuffled.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from math import floor, log

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, Scratch, ascii_lower, columns_as, text_batches
from .treap import Treap, build

#: What ends a block: so many documents, or so many distinct (term, document) pairs.
BLOCK_DOCS, BLOCK_POINTS = 8192, 3_000_000
#: Bytes of item texts that are broadcast at once.
SLICE_BYTES = 2_000_000
#: ASCII characters that stand between terms: all but digits and letters.
_BETWEEN = bytes(i for i in range(128) if not chr(i).isalnum())
_TO_TERMS = bytes.maketrans(_BETWEEN + UPPER.encode(), b" " * len(_BETWEEN) + LOWER.encode())
INDEX_TYPE = "docs int, terms binary, dfs binary, grid binary"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order: what stands between ASCII characters that are no letter or digit, A-Z lower-cased."""
    return text.translate(_TO_TERMS).split() if text else []


def impact(tf, m):
    """The document's part of a term's score, in 64-bit integers."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def doc_weight(n: int, n_docs: int, n_terms: int) -> int:
    return 10 + 90 * n * n_docs // n_terms


def term_weight(df: int, n_docs: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def corpus_size(rows: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats) of (text)."""
    def lengths(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series([len(terms(t)) for t in s], dtype="int64")

    n = F.pandas_udf(lengths, "bigint")(F.col("text").cast("binary"))
    got = rows.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    return got[0], got[1]


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict]:
    """The index of all documents as a written table, one row a block, and its facts: n_docs, n_terms, id_type.

    A document without terms has no column.  Ids that are numbers order as numbers, all others as texts."""
    scratch = Scratch(df.sparkSession)
    rows = columns_as(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType
    numeric = isinstance(kind, T.IntegralType)
    n_docs, n_terms = corpus_size(rows)
    key = (lambda i: (i is None, int(i or 0))) if numeric else (lambda i: (i is None, i or ""))

    def block(ids: list, sizes: list[int], found: list[Counter]) -> dict:
        order = sorted(range(len(ids)), key=lambda i: key(ids[i]))
        known: dict[bytes, int] = defaultdict(count().__next__)
        row, tf = array("i"), array("q")
        for i in order:
            row.extend(map(known.__getitem__, found[i]))
            tf.extend(found[i].values())
        row, tf = np.frombuffer(row, np.int32), np.frombuffer(tf, np.int64)
        col = np.repeat(np.arange(len(order)), [len(found[i]) for i in order])
        m = np.array([doc_weight(sizes[i], n_docs, n_terms) for i in order], np.int64)
        dfs = np.bincount(row, minlength=len(known))
        by_df = np.argsort(-dfs, kind="stable")
        rank = np.empty(len(known), np.int64)
        rank[by_df] = np.arange(len(known))
        names = list(known)
        return {"ids": [ids[i] for i in order], "docs": len(order),
                "terms": zstandard.ZstdCompressor(level=1).compress(b" ".join([names[i] for i in by_df.tolist()])),
                "dfs": dfs[by_df].astype(np.uint32).tobytes(), "grid": build(rank[row], col, impact(tf, m[col]), len(known), len(order))}

    def blocks(frames):
        ids, sizes, found, points = [], [], [], 0
        for f in text_batches(frames):
            for i, t in zip(f["id"].tolist(), f["text"]):
                c = Counter(terms(t))
                if not c:
                    continue
                ids.append(i), sizes.append(c.total()), found.append(c)
                points += len(c)
                if points >= BLOCK_POINTS or len(ids) >= BLOCK_DOCS:
                    yield pd.DataFrame([block(ids, sizes, found)])
                    ids, sizes, found, points = [], [], [], 0
        if ids:
            yield pd.DataFrame([block(ids, sizes, found)])

    sent = rows.select(F.col("id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"))
    index = scratch.table(sent.mapInPandas(blocks, f"ids array<string>, {INDEX_TYPE}"))
    return index, {"n_docs": n_docs, "n_terms": n_terms, "id_type": kind.simpleString(), "numeric": numeric}


def _names(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b" ")


def document_counts(index: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """Documents of the whole index that hold each of the ``wanted`` terms (a set of bounded size)."""
    sent = index.sparkSession.sparkContext.broadcast(wanted)

    def own(frames):
        total: Counter = Counter()
        for f in frames:
            for names, dfs in zip(f["terms"], f["dfs"]):
                dfs, names = np.frombuffer(dfs, np.uint32), _names(names)
                for i, t in enumerate(names):
                    if t in sent.value:
                        total[t] += int(dfs[i])
        yield pd.DataFrame({"t": list(total), "n": list(total.values())})

    got = index.select("terms", "dfs").mapInPandas(own, "t binary, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["t"]): r["n"] for r in got}


def search_index(index: DataFrame, facts: dict, items: list[tuple[str | None, list[bytes]]], k: int) -> DataFrame:
    """(item, id, score): each block's best ``k`` documents for each of ``items`` (id as text, distinct terms), as
    far as they can be among the best ``k`` of all."""
    spark = index.sparkSession
    dfs = document_counts(index, {t for _, ts in items for t in ts})
    weighted = [(item, [(t, term_weight(dfs[t], facts["n_docs"])) for t in ts if t in dfs]) for item, ts in items]
    sent = spark.sparkContext.broadcast(weighted)

    def search(frames):
        least: dict[int, list[int]] = defaultdict(list)  # per item the best k scores that this task has seen
        for f in frames:
            for ids, docs, names, grid in zip(f["ids"], f["docs"], f["terms"], f["grid"]):
                wanted = {t for _, ts in sent.value for t, _ in ts}
                place = {t: i for i, t in enumerate(_names(names)) if t in wanted}
                treap, out = Treap(grid), []
                for at, (item, ts) in enumerate(sent.value):
                    own = [(place[t], w) for t, w in ts if t in place]
                    if not own:
                        continue
                    rows, weights = (np.array(x, np.int64) for x in zip(*own))
                    best = least[at]
                    sums, columns = treap.top(rows, weights, int(docs), k, best[-1] if len(best) == k else 1)
                    least[at] = sorted([*best, *sums.tolist()], reverse=True)[:k]
                    out += [(item, ids[c], s) for s, c in zip(sums.tolist(), columns.tolist())]
                yield pd.DataFrame(out, columns=["item", "id", "score"])

    return index.select("ids", "docs", "terms", "grid").mapInPandas(search, "item string, id string, score bigint")


def lexical_search(df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0 (all, if fewer): ``item_col``, rank (from 1),
    ``id_col``, score; equal scores by ascending id.

    Null and termless texts are no documents and match nothing, as items they find nothing.  A null document id is found like
    others and comes last among equal scores.  Repeated document rows are documents of their own.  Repeated rows of an item count
    once (one with a null id too); different texts of one item id are one item with the terms of all.  Empty tables: no rows.
    Other columns are neither read nor returned."""
    index, facts = build_index(df, id_col, text_col)
    asked = columns_as(items, item=item_col, text=item_text_col)
    item_type, scratch = asked.schema["item"].dataType.simpleString(), Scratch(df.sparkSession)
    asked = scratch.table(asked.select(F.col("item").cast("string").alias("item"), ascii_lower(F.col("text")).alias("text")).distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-2 * size // SLICE_BYTES))  # by hash of the item id, twice as many as would do if even
    found = None
    for s in range(slices):
        of_slice = asked.filter(F.pmod(F.xxhash64("item"), F.lit(slices)) == s).collect()
        words: dict = defaultdict(dict)
        for r in sorted(of_slice, key=lambda r: (r["item"] is not None, r["item"], r["text"])):
            words[r["item"]].update(dict.fromkeys(terms(r["text"].encode())))
        best = search_index(index, facts, [(i, list(ts)) for i, ts in words.items()], k)
        best = _ranked(best.withColumn("id", F.col("id").cast(facts["id_type"])), k)
        if slices > 1:
            best = scratch.table(best)
        found = best if found is None else found.unionByName(best)
    return found.select(F.col("item").cast(item_type).alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


#: DuckDB SQL of the query: every document's score for every item over its terms.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
facts AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, facts WHERE term IN (SELECT term FROM asked) GROUP BY term),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN docs USING (doc_id), facts
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
