"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one suffix automaton; document words
stream through it and the longest match that ends at each word is tracked.  A
*window* is ``window`` consecutive words of an item; an item with fewer words is one
window of all its words.  A match of a whole window marks its words as hit.

The items are dealt into shards of bounded size (``SHARD_WORDS``), one for any but a huge benchmark.  Each
shard's automaton is built on the driver and broadcast; documents never leave their task, pass one shard after the
other, and the shards' hits are united.  A word
that occurs in no item sends the automaton back to its root, so only
runs of benchmark words as long as the shortest window are streamed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, columns_as

WINDOW = 10
#: Words of items in one automaton (about 300 bytes a word in each worker).
SHARD_WORDS = 1_000_000
#: A word: letters and digits of ASCII and every character beyond it.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text) -> list[str]:
    return WORD.findall(text.translate(AZ) if text else "")


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word ids.

    ``step`` follows one word; ``windows`` lists the (length, items) of the windows
    that end where a match of length ``n`` in state ``v`` ends."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window, self.vocab = window, {}
        self.next, self.link, self.len = [{}], [-1], [0]
        self.full: dict[int, set[str]] = {}       # state: items with a window of full length
        self.short: dict[int, dict[int, set[str]]] = {}  # state: length: items shorter than a window
        self.shortest = min((min(len(w), window) for _, w in items if w), default=0)
        ids = [(name, [self.vocab.setdefault(x, len(self.vocab) + 1) for x in w]) for name, w in items if w]
        for _, seq in ids:
            last = 0
            for x in seq:
                last = self._extend(last, x)
        for name, seq in ids:
            self._mark(name, seq)

    def _state(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt), self.link.append(link), self.len.append(length)
        return len(self.len) - 1

    def _split(self, p: int, x: int, q: int) -> int:
        """A copy of ``q`` that holds only what ``p`` plus ``x`` reaches."""
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, x: int) -> int:
        if (q := self.next[last].get(x)) is not None:  # an earlier item already has it
            return q if self.len[q] == self.len[last] + 1 else self._split(last, x, q)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, x, q)
        return new

    def at(self, v: int, n: int) -> int:
        """The state of the last ``n`` words of a match in state ``v``."""
        while v and self.len[self.link[v]] >= n:
            v = self.link[v]
        return v

    def _mark(self, name: str, seq: list[int]) -> None:
        v = 0
        for k, x in enumerate(seq, 1):
            v = self.next[v][x]
            if k >= self.window:
                self.full.setdefault(self.at(v, self.window), set()).add(name)
        if len(seq) < self.window:
            self.short.setdefault(v, {}).setdefault(len(seq), set()).add(name)

    def step(self, v: int, n: int, x: int) -> tuple[int, int]:
        while v and x not in self.next[v]:
            v = self.link[v]
            n = self.len[v]
        if x in self.next[v]:
            return self.next[v][x], n + 1
        return 0, 0

    def windows(self, v: int, n: int):
        if n >= self.window:
            yield self.window, self.full.get(self.at(v, self.window), ())
        while v > 0 and self.short:
            for length, items in self.short.get(v, {}).items():
                if length <= n:
                    yield length, items
            v = self.link[v]

    def hits(self, text_words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit word ranges [start, end) of a text and the items whose windows occur."""
        ids = np.fromiter(map(self.vocab.get, text_words, repeat(0)), np.int64, len(text_words))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ids != 0, [0])).astype(np.int8)))
        spans, found = [], set()
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - start < self.shortest:
                continue
            v = n = 0
            for i, x in enumerate(ids[start:end].tolist(), start + 1):
                v, n = self.step(v, n, x)
                if n >= self.shortest:
                    for length, items in self.windows(v, n):
                        if items:
                            found.update(items)
                            while spans and spans[-1][0] >= i - length:
                                spans.pop()
                            if spans and spans[-1][1] >= i - length:
                                spans[-1] = (spans[-1][0], i)
                            else:
                                spans.append((i - length, i))
        return spans, found


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` (and what stands between them)."""
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(text.translate(AZ))]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end:at[a][0]])
        end = at[b - 1][1]
    return "".join([*out, text[end:]])


def shards(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The items (id, text, shard) and the number of shards of ``SHARD_WORDS`` words at most, as far as the hash of
    the items deals them evenly; a benchmark of that size or less is one shard."""
    items = columns_as(benchmark, id=item_col, text=text_col)
    n_words = items.select(F.sum(F.regexp_count(ascii_lower(F.col("text")), F.lit(WORD.pattern)))).first()[0] or 0
    n = 1 if n_words <= SHARD_WORDS else -(-2 * n_words // SHARD_WORDS)
    return items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n))), n


def build(items: DataFrame, shard: int, window: int = WINDOW) -> SuffixAutomaton:
    """The automaton of one shard.  Items with a null id count under the name ``null``; items without words have no window."""
    own = items.filter(F.col("shard") == shard).select("id", "text").collect()
    got = sorted((str(r[0]) if r[0] is not None else "null", r[1] or "") for r in own)
    return SuffixAutomaton([(name, words(t)) for name, t in got], window)


def judge(text: Column, automaton: SuffixAutomaton, spark: SparkSession) -> Column:
    """Struct (n_words, items, spans) of a text column for one shard; only the text goes to Python."""
    sent = spark.sparkContext.broadcast(automaton)

    def apply(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = sent.value
        for s in series:
            out = []
            for t in s:
                w = words(t)
                spans, items = a.hits(w)
                out.append((len(w), sorted(items), [{"start": b, "end": e} for b, e in spans]))
            yield pd.DataFrame(out, columns=["n_words", "items", "spans"])

    return F.pandas_udf(apply, "n_words bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>")(text)


def judged(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """``row`` (the input's columns) and ``j``: struct (n_words, n_hit, items, spans) over all shards."""
    items, n = shards(benchmark, item_col)
    out = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))  # no name can clash inside
    for k in range(n):
        out = out.withColumn(f"j{k}", judge(F.col(f"row.`{text_col}`"), build(items, k, window), df.sparkSession))
    parts = [F.col(f"j{k}") for k in range(n)]
    found = F.array_sort(F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts]))))
    spans = parts[0]["spans"] if n == 1 else united(F.array_sort(F.flatten(F.array(*[p["spans"] for p in parts]))))
    n_hit = F.aggregate("s", F.lit(0).cast("bigint"), lambda t, x: t + x["end"] - x["start"])
    out = out.select("row", parts[0]["n_words"].alias("n"), found.alias("i"), spans.alias("s"))
    return out.select("row", F.struct(F.col("n").alias("n_words"), n_hit.alias("n_hit"), F.col("i").alias("items"), F.col("s").alias("spans")).alias("j"))


def united(spans: Column) -> Column:
    """Sorted [start, end) spans without overlaps; spans that touch become one."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.array_append(F.slice(done, 1, F.size(done) - 1),
                                F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end")))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"]), joined).otherwise(F.array_append(done, x))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans``."""
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else cut_spans(t, [(int(r["start"]), int(r["end"])) for r in rs]) for t, rs in zip(texts, ranges)],
                         dtype=object)

    # only texts with a hit are cut
    return F.when(F.size(spans) > 0, F.pandas_udf(cut, "string")(text, spans)).otherwise(text)


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW, max_coverage: float = 1.0,
                  keep_text: bool = True) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_hit, n_items, items (sorted as strings,
    comma-joined), spans (hit word ranges), with ``keep_text`` clean_text without the hit spans, coverage
    (n_hit / n_words) and over_limit (coverage above ``max_coverage``).

    Null or wordless text: no words, no hits, clean_text unchanged (null stays null).  Empty tables: no
    rows, or no hits.  Repeated rows are judged one by one.  A null id passes through.  Other columns are
    neither read nor returned."""
    rows = columns_as(df, id=id_col, text=text_col)
    out = judged(rows, benchmark, "text", item_col, window)
    if keep_text:
        out = out.withColumn("clean_text", without_spans(F.col("row.text"), F.col("j.spans")))
    coverage = F.when(F.col("n_words") > 0, F.col("n_hit") / F.col("n_words")).otherwise(F.lit(0.0))
    return (out.select(F.col("row.id").alias(id_col), "j.n_words", "j.n_hit", F.size("j.items").cast("bigint").alias("n_items"),
                       F.array_join("j.items", ",").alias("items"), "j.spans", *["clean_text"] * keep_text)
            .withColumn("coverage", coverage).withColumn("over_limit", F.col("coverage") > max_coverage))


def digest(judged: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the contract from :func:`decontaminate`."""
    return judged.select(id_col, "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""WITH
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""
