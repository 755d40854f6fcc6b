"""K2-treaps and ranked lexical search against brute force and on odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from guestfold.llm import lexical, treap

from odd_rows import LONG, same_rows


def brute_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k=10):
    docs = [(i, Counter(brute_terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(brute_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_treap_finds_the_best_columns(seed, monkeypatch):
    monkeypatch.setattr(treap, "BATCH", 3)
    rng = np.random.default_rng(seed)
    n_rows, n_cols = int(rng.integers(1, 60)), int(rng.integers(1, 90))
    grid = (rng.random((n_rows, n_cols)) < rng.random()) * rng.integers(1, 6, (n_rows, n_cols))
    r, c = np.nonzero(grid)
    packed = treap.Treap(treap.build(r, c, grid[r, c], n_rows, n_cols))
    for _ in range(5):
        rows = rng.choice(n_rows, int(rng.integers(1, n_rows + 1)), replace=False)
        weights = rng.integers(1, 4, len(rows))
        total = (grid[rows] * weights[:, None]).sum(axis=0)
        want = [j for j in sorted(range(n_cols), key=lambda j: (-total[j], j)) if total[j] > 0][:7]
        sums, cols = packed.top(rows, weights, n_cols, 7)
        assert cols.tolist() == want and sums.tolist() == total[want].tolist()


def test_treap_keeps_every_point_once_and_no_impact_grows_downwards():
    rng = np.random.default_rng(0)
    grid = (rng.random((70, 33)) < 0.2) * rng.integers(1, 1000, (70, 33))
    r, c = np.nonzero(grid)
    t = treap.Treap(treap.build(r, c, grid[r, c], 70, 33))
    assert sum(map(len, t.impact)) == len(r)
    assert sorted(x for level in t.impact for x in level.tolist()) == sorted(grid[r, c].tolist())
    for level in range(len(t.impact) - 1):
        parent = np.repeat(np.arange(len(t.masks[level])), np.bitwise_count(t.masks[level]))
        assert (t.impact[level + 1] <= t.impact[level][parent]).all()
    empty = treap.Treap(treap.build(r[:0], c[:0], r[:0], 0, 0))
    assert len(empty.top(np.array([0]), np.array([1]), 0, 3)[0]) == 0


def test_spread_and_gather_are_inverse():
    x = np.array([0, 1, 2, 5, 2 ** 31, 2 ** 32 - 1], np.uint64)
    assert (treap.gather(treap.spread(x)) == x).all()


@pytest.mark.parametrize("block_docs, slice_bytes", [(8192, 2_000_000), (7, 40)])
def test_search_equals_brute_force(spark, monkeypatch, block_docs, slice_bytes):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lexical, "SLICE_BYTES", slice_bytes)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)] + ["Été", "naïve", "日本"]
    weights = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=weights / weights.sum()))
    docs = [(i, text(int(rng.integers(0, 30)))) for i in range(80)]
    docs += [(100 + i, docs[i][1].upper()) for i in range(30)]  # equal scores
    items = [(f"q{i}", text(6)) for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = lexical.lexical_search(df, spark.createDataFrame(items, "item_id string, text string"))
    same_rows(got.collect(), brute_search(docs, items))


def test_search_on_odd_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [("a", "alpha; BETA, word"), ("b", None), ("c", ""), ("d", "!!! ..."), ("e", "日本語 ß"), (None, "x"), ("a", "alpha; BETA, word"),
             ("a", "zeta"), ("f", "absent"), ("g", LONG)]
    asked = spark.createDataFrame([(*i, 1, "clash") for i in items], "item_id string, text string, rank int, id string")
    want = brute_search(docs, [("a", "alpha beta word zeta"), ("e", "日本語 ß"), (None, "x"), ("g", LONG)])
    # the two rows of document 2 are documents of their own; the null id comes last among equal scores
    same_rows(lexical.lexical_search(odd, asked).collect(), want)
    assert [r[2] for r in want if r[0] == "a"] == [1, 2, 2, None, 7] or [r[2] for r in want if r[0] == "a"][0] == 7
    assert lexical.lexical_search(none, asked).collect() == []
    assert lexical.lexical_search(odd, asked.filter("1 = 0")).collect() == []


def test_ids_of_text_order_as_texts(spark):
    df = spark.createDataFrame([("10", "same"), ("9", "same"), ("a", "same other")], "doc_id string, text string")
    got = lexical.lexical_search(df, spark.createDataFrame([(1, "same")], "item_id int, text string"), k=2)
    assert [(r["item_id"], r["doc_id"]) for r in got.orderBy("rank").collect()] == [(1, "10"), (1, "9")]
