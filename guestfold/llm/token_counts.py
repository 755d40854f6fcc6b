"""Token counts by prefix dynamic programming.

For every prefix of a word the table holds the last token of its encoding and the
number of tokens, found from shorter prefixes: the last token of a prefix is the one vocabulary
entry that ends there and *follows* the last token of what is left, where ``b`` follows ``a`` if no merge
across their border would come before the merges that make ``a`` and ``b``.  A prefix may also end the
word, with a closing entry (``</w>``).  Counts at every prefix of a text are those of
the words before plus the word's own, so how many tokens a cut text has, and where
to cut it for a budget, is looked up and never encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_as
from .pretokens import Splitter

LIMIT = 2048
#: Words whose tables a worker keeps.
CACHE_WORDS = 600_000


class PrefixCounter:
    """Prefix tables of the words of one byte-level BPE file."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        model = self.split.spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = self.split.word_end or ""
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.made = {a + b: (r, a, b) for r, (a, b) in reversed(list(enumerate(merges)))}
        if any(self.made.get(x, (-1,))[0] >= r for r, pair in enumerate(merges) for x in pair):
            raise ValueError(f"{path}: a merge comes before the merges that make its parts")
        self.spines: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}  # entry: next entry: whether it follows
        self.known: set[str] = {t for t in model["vocab"] if t not in self.made}
        for t, (r, a, b) in sorted(self.made.items(), key=lambda x: x[1][0]):  # entries that encoding can reach
            if a in self.known and b in self.known and not self._crossed(a, b, r):
                self.known.add(t)
        closing = {t for t in self.known if self.end and t.endswith(self.end)}
        self.inner = self.known - closing
        self.closing = {t[:-len(self.end)] for t in closing}
        self.inner_tails, self.closing_tails = ({t[k:] for t in x for k in range(len(t))} for x in (self.inner, self.closing))
        self.words: dict[str, int] = {}

    def _spine(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The parts of a token at its right (left) border, with the rank of the merge that uses each up."""
        got = self.spines.get((token, right))
        if got is None:
            got, used, t = [], inf, token
            while True:
                got.append((t, used))
                if t not in self.made:
                    break
                used, a, b = self.made[t]
                t = b if right else a
            self.spines[(token, right)] = got
        return got

    def _crossed(self, a: str, b: str, before: float = inf) -> bool:
        """Whether a merge over the border of ``a`` and ``b`` comes before they are whole (and before ``before``).
        Of merges of one rank the left one comes first."""
        right = self._spine(b, False)
        for x, x_used in self._spine(a, True):
            for y, y_used in right:
                r = self.rank.get((x, y))
                if r is not None and r < before and r < x_used and r <= y_used:
                    return True
        return False

    def _last(self, w: str, i: int, last: list[str], entries: set[str], tails: set[str], suffix: str) -> tuple[str, int]:
        """The one entry that ends prefix ``i`` and the prefix that is left."""
        found, k = [], i - 1
        while k >= 0 and (t := w[k:i]) in tails:
            if t in entries:
                found.append(k)
            k -= 1
        for k in reversed(found):
            t = w[k:i] + suffix
            if not k:
                return t, 0
            a = last[k]
            known = self.pairs.get(a)
            if known is None:
                if len(self.pairs) > 40_000:
                    self.pairs.clear()
                known = self.pairs[a] = {}
            ok = known.get(t)
            if ok is None:
                ok = known[t] = not self._crossed(a, t)
            if ok:
                return t, k
        raise ValueError(f"no encoding of {w[:i]!r}")

    def table(self, w: str, only_end: bool = False) -> list[int]:
        """Token counts of the prefixes of 0, 1, ... byte characters of a word, each as if the text ended there
        (``only_end``: of the whole word only)."""
        if only_end and w in self.closing:
            return [1]
        last, count, out = [""], [0], [0]
        n = len(w)
        for i in range(1, n + (not self.end)):
            t, k = self._last(w, i, last, self.inner, self.inner_tails, "")
            last.append(t), count.append(count[k] + 1)
        if not self.end:
            return count[-1:] if only_end else count
        for i in range(n if only_end else 1, n + 1):
            out.append(count[self._last(w, i, last, self.closing, self.closing_tails, self.end)[1]] + 1)
        return out[-1:] if only_end else out

    def __getitem__(self, w: str) -> int:
        """Tokens of a raw word."""
        got = self.words.get(w)
        if got is None:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            got = self.words[w] = self.table(self.split.chars(w), True)[0]
        return got

    def word_counts(self, text: str | None) -> list[tuple[list[str], np.ndarray, bool]]:
        """Per piece of a text: its words, their token counts, whether the words are raw."""
        out = []
        for piece, special in self.split.pieces(text) if text else ():
            words, raw = ([piece], True) if special else self.split.words(piece)
            n = (np.ones(1, np.int64) if special else
                 np.fromiter(map(self.__getitem__, words) if raw else (self.table(w, True)[0] for w in words), np.int64, len(words)))
            out.append((words, n, raw))
        return out

    def count(self, text: str | None) -> int:
        return sum(int(n.sum()) for _, n, _ in self.word_counts(text))

    def prefix_counts(self, text: str) -> list[tuple[str, list[int]]]:
        """(word in byte characters, token counts of the text cut after each byte of the word), in order;
        a special string is one word.  The text is the tokenizer's normalised text."""
        out, before = [], 0
        for words, counts, raw in self.word_counts(text):
            for w, n, before in zip(words, counts.tolist(), accumulate(counts.tolist()[:-1], initial=before)):
                if raw and w in self.split.special:
                    out.append((w, [before + n]))
                else:
                    chars = self.split.chars(w) if raw else w
                    out.append((chars, [before + x for x in self._cuts(chars)]))
            before += int(counts[-1]) if len(counts) else 0
        return out

    def _cuts(self, chars: str) -> list[int]:
        cuts = self.table(chars)[1:]
        if chars.lstrip("'") in ("s", "t", "re", "ve", "m", "ll", "d") and chars.startswith("'"):
            # cut short, a contraction is a mark and, after it, letters
            mark = self.table("'")[-1]
            cuts[:-1] = [mark] + [mark + x for x in self.table(chars[1:-1])[1:]]
        return cuts

    def words_within(self, text: str | None, budget: int) -> tuple[int, int]:
        """(whole words that a budget of tokens holds, their tokens)."""
        n = [c for _, c, _ in self.word_counts(text)]
        return _within(np.concatenate(n) if n else np.zeros(0, np.int64), budget)


def _within(n: np.ndarray, budget: int) -> tuple[int, int]:
    total = np.cumsum(n)
    k = int(np.searchsorted(total, budget, side="right"))
    return k, int(total[k - 1]) if k else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a vocabulary file: built once, its word tables kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``), and
    words_within and tokens_within: the whole words (pre-tokens) that ``limit`` tokens hold, and their tokens.

    ``path``: a byte-level BPE file of the tokenizers library, present on every executor.  Special strings inside a text
    count as one token.  Null text: an empty text, 0 tokens.  Repeated rows: one result each.  A null id passes
    through.  Empty table: no rows.  Other columns are neither read nor returned."""
    rows = columns_as(df, id=id_col, text=text_col)

    def count(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for s in series:
            n, k, t = (np.zeros(len(s), np.int64) for _ in range(3))
            for i, text in enumerate(s):
                if text:
                    own = np.concatenate([x for _, x, _ in c.word_counts(text)])
                    n[i], (k[i], t[i]) = own.sum(), _within(own, limit)
            yield pd.DataFrame({"n_tokens": n, "words_within": k, "tokens_within": t})

    counted = F.pandas_udf(count, "n_tokens bigint, words_within bigint, tokens_within bigint")(F.col("text"))
    out = rows.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), counted.alias("c"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"),
                      "c.words_within", "c.tokens_within")


def prefix_tables(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, counts: the token count of the text cut after its first, second, ... byte, an int a
    byte.  Bytes are those of the text's words (pre-tokens) as the tokenizer normalises them, white space left out; a special string
    is one step.  Store it once: :func:`tokens_of` and :func:`steps_within` then answer from it without encoding again.

    Null and empty texts have an empty table.  Repeated rows: one each.  A null id passes through.  Empty table: no rows.
    Other columns are neither read nor returned."""
    rows = columns_as(df, id=id_col, text=text_col)

    def tables(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for s in series:
            yield pd.Series([np.array([n for _, own in c.prefix_counts(t) for n in own] if t else [], np.int32) for t in s])

    return rows.select(F.col("id").alias(id_col), F.pandas_udf(tables, "array<int>")(F.col("text")).alias("counts"))


def tokens_of(counts: Column, n: Column) -> Column:
    """Tokens of the first ``n`` steps of a prefix table (0: none; more than there are: of all)."""
    return F.when((n <= 0) | (F.size(counts) == 0), 0).otherwise(F.element_at(counts, F.least(n, F.size(counts)).cast("int")))


def steps_within(counts: Column, budget: Column) -> Column:
    """The longest prefix, in steps, of at most ``budget`` tokens.  (A longer prefix may have fewer tokens, so the last fit counts.)"""
    fits = F.transform(counts, lambda x, i: F.when(x <= budget, i + 1))
    return F.coalesce(F.array_max(fits), F.lit(0))
