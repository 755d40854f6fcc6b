"""Decontamination against a brute-force window search."""

import random

import pytest

from guestfold.llm import decontaminate as decon

from odd_rows import LONG, same_rows


def brute(text, items, window):
    w, hit, found = decon.words(text), set(), set()
    for name, t in items:
        own = decon.words(t)
        n = min(len(own), window)
        wins = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(name)
    return len(w), len(hit), len(found), ",".join(sorted(found))


@pytest.mark.parametrize("seed", range(30))
def test_automaton_finds_every_window(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("aabbcd") for _ in range(n))
    items = [(str(k), text(rng.choice([0, 1, 2, 3, 4, 6, 9, 15]))) for k in range(rng.randrange(1, 7))]
    automaton = decon.SuffixAutomaton([(n, decon.words(t)) for n, t in items], 4)
    for _ in range(20):
        t = text(rng.randrange(0, 40)) + " zz " + text(rng.randrange(0, 10))
        spans, found = automaton.hits(decon.words(t))
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        assert brute(t, items, 4) == (len(decon.words(t)), sum(b - a for a, b in spans), len(found), ",".join(sorted(found)))


def test_odd_rows_and_tables(spark, odd, none):
    bench = spark.createDataFrame([(1, "beta GAMMA delta"), (2, None), (3, " .. "), (None, "日本語 🎉"), (1, "beta GAMMA delta")],
                                  "item_id bigint, text string")
    got = {(r["doc_id"], r["n_words"]): r for r in decon.decontaminate(odd, bench).collect()}
    assert (got[(1, 5)]["n_hit"], got[(1, 5)]["items"], got[(1, 5)]["clean_text"]) == (3, "1", "Alpha  epsilon")
    assert got[(1, 5)]["coverage"] == pytest.approx(0.6) and not got[(1, 5)]["over_limit"]
    assert got[(8, 6)]["items"] == "null" and got[(8, 6)]["clean_text"] == "ÄÖÜ ß é  <|endoftext|>"
    assert got[(3, 0)]["clean_text"] is None and got[(6, 0)]["clean_text"] == " \t\n "
    assert got[(7, 60_006)]["clean_text"] == LONG
    assert decon.decontaminate(odd, bench, max_coverage=0.0).filter("over_limit").count() == 5
    assert decon.decontaminate(none, bench).collect() == []
    assert decon.decontaminate(odd, bench.filter("1 = 0")).filter("n_hit > 0").count() == 0


def test_a_large_benchmark_is_judged_in_shards(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = [tuple(r) for r in decon.decontaminate(docs, bench, window=4).collect()]
    assert sum(len(r[5]) > 0 for r in whole) > 2
    monkeypatch.setattr(decon, "SHARD_WORDS", 700)
    assert decon.shards(bench)[1] > 3
    same_rows([tuple(map(str, r)) for r in decon.decontaminate(docs, bench, window=4).collect()], [tuple(map(str, r)) for r in whole])
