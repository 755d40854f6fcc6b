"""Exact dedup, SimHash near-dedup and line dedup against brute force and on odd rows."""

import hashlib
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from guestfold.llm import components, exact_dedup, line_dedup, simhash
from guestfold.llm.common import Scratch
from guestfold.llm.queries import QUERIES

from odd_rows import LONG, same_rows


def az_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_on_odd_rows(odd, none):
    got = exact_dedup.exact_dedup(odd).collect()
    alpha, empty = sha("alpha beta gamma delta epsilon"), sha("")
    blank = sha(" \t\n ")
    want = [(1, 2, 4, False, alpha), (2, 2, 4, True, alpha), (2, 2, 4, False, alpha), (None, 2, 4, False, alpha),
            (3, 5, 4, False, empty), (4, 5, 4, False, empty), (5, 5, 4, True, empty), (None, 5, 4, False, empty),
            (6, 6, 1, True, blank), (7, 7, 1, True, sha(LONG)),
            (8, 8, 1, True, sha("ÄÖÜ ß é 日本語 🎉 <|endoftext|>")), (9, 9, 1, True, sha("x"))]
    same_rows(got, want)
    assert exact_dedup.exact_dedup(none).collect() == []


def test_a_digest_collision_does_not_merge_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(F.col(c), 1, 1))
    df = spark.createDataFrame([(1, "aa"), (2, "ab"), (3, "AA"), (4, "b")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


def test_large_groups_are_dealt_over_salts(spark, monkeypatch):
    from guestfold.llm import common
    monkeypatch.setattr(common, "LARGE_GROUP", 50)
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_dedup(df)
    assert got.filter("kept").count() == 101
    assert got.filter("group_size = 200 and keep_id = 199").count() == 200


def brute_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", az_lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def brute_components(fps, bits):
    """{id: smallest id reachable} of {id: fingerprint}."""
    least = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= bits and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_fingerprint_is_the_majority_of_xxhash_bits():
    for t in ("", " ", "One", "one two three", "Ä a B c d É e", "a\x1cb c\x0bd", "x " * 70_000, None):
        assert simhash.fingerprint(t.encode() if t is not None else None) == brute_fingerprint(t, 4)


def test_spark_xxhash64_is_the_same_hash(spark):
    h = spark.sql("select xxhash64('a b c d')").first()[0]
    assert h & (2 ** 64 - 1) == xxhash.xxh64_intdigest("a b c d", 42)


def test_simhash_query_against_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t, 4) for i, t in docs.items()}
    want = brute_components(fps, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in docs}


@pytest.mark.parametrize("bits, values", [(4, 1 << 20), (4, 500), (3, 500), (1, 500), (0, 500)])
def test_links_give_the_components_of_all_close_pairs(spark, monkeypatch, bits, values):
    monkeypatch.setattr(simhash, "GROUP_VALUES", values)
    base, fps = 0x0123456789ABCDEF, set()
    for k in range(60):
        h = xxhash.xxh64_intdigest(str(k), 1)
        fps |= {h, h ^ 1 << k, h ^ 1 << k ^ 1 << 63, h ^ 0b1111 << 8, h ^ 0b11111 << 20}
        base ^= 1 << (k % 64)  # a chain, one bit a step
        fps.add(base)
    fps.add(0)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    edges = simhash.links(df, bits, len(signed))
    assert all((a ^ b).bit_count() <= bits if a * b >= 0 else ((a ^ b) & (2 ** 64 - 1)).bit_count() <= bits for a, b in edges.collect())
    roots = {r["node"]: r["root"] for r in components.connected_components(edges, Scratch(spark)).collect()}
    groups = defaultdict(set)
    for f in signed:
        groups[roots.get(f, f)].add(f & (2 ** 64 - 1))
    want = defaultdict(set)
    for f, c in brute_components({f: f for f in fps}, bits).items():
        want[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_simhash_on_odd_rows(odd, none):
    got = simhash.simhash_components(odd).collect()
    zero = "0" * 16
    assert sorted(((r[0] is not None, r[0]), r[2]) for r in got if r[1] == zero) == [
        ((False, None), 3), ((True, 3), 3), ((True, 4), 3), ((True, 5), 3), ((True, 6), 3)]
    assert {r[2] for r in got if r[0] in (1, 2)} == {1} and len(got) == 12
    assert simhash.simhash_components(none).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1400).select(F.lit(1000).cast("bigint").alias("a"), F.col("id").alias("b"))
    got = components.connected_components(chain.union(star), Scratch(spark))
    assert got.groupBy("root").count().select("count").sort("count").collect() == [(400,), (401,)]
    assert components.connected_components(chain.filter("a < 0"), Scratch(spark)).collect() == []


def brute_line_dedup(docs):
    """{id: clean text} by a set of seen chunks in order of id."""
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        lines, kept = line_dedup._split((text or "").encode()), []
        for a, b in line_dedup.chunks(lines):
            body = b"\n".join(lines[a:b])
            if b - a >= line_dedup.LEAST and body.strip():
                if body in seen:
                    continue
                seen.add(body)
            kept += lines[a:b]
        out[i] = None if text is None else b"\n".join(kept).decode()
    return out


def test_line_dedup_query_against_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute_line_dedup(docs)
    got = {r["doc_id"]: (r["clean_sha256"], r["n_removed"]) for r in QUERIES["op3_line_dedup"](spark, sf_dir).collect()}
    assert {i: g[0] for i, g in got.items()} == {i: sha(t) for i, t in want.items()}
    assert sum(g[1] for g in got.values()) > 0


def test_cuts_do_not_move_with_what_stands_before():
    passage = [f"line {k} of a passage".encode() for k in range(60)]
    whole = {tuple(passage[a:b]) for a, b in line_dedup.chunks(passage)}
    for shift in range(1, 6):
        lines = [b"other %d" % k for k in range(shift)] + passage + [b"end"]
        moved = {tuple(lines[a:b]) for a, b in line_dedup.chunks(lines)}
        assert len(whole & moved) >= 0.7 * len(whole)
        assert [x for a, b in line_dedup.chunks(lines) for x in lines[a:b]] == lines
    same = [b"x"] * 1000
    assert max(b - a for a, b in line_dedup.chunks(same)) <= line_dedup.MOST


def test_line_dedup_on_odd_rows(spark, odd, none):
    got = {(r["doc_id"], r["clean_text"]): r["n_lines"] for r in line_dedup.line_dedup(odd).collect()}
    assert got[(7, LONG)] == 3 and got[(3, None)] == 0 and got[(4, "")] == 0 and got[(6, " \t\n ")] == 2
    assert line_dedup.line_dedup(none).collect() == []
    text = "\n".join(f"line {k}" for k in range(40))
    df = spark.createDataFrame([(1, text), (2, "head\n" + text), (2, "head\n" + text), (None, text)], "doc_id bigint, text string")
    want = brute_line_dedup({0: text, 1: text, 2: "head\n" + text})
    got = {(r["doc_id"], r["clean_text"]) for r in line_dedup.line_dedup(df).collect()}
    assert got == {(None, want[0]), (1, want[1]), (2, want[2])}


def brute_passages(docs):
    """[clean text] of texts in order: a line goes when it and its neighbour (or it alone, if long) stood so before."""
    seen, out = set(), []
    for text in docs:
        lines, gone = text.split("\n") if text else [], set()
        full = [i for i, x in enumerate(lines) if x.encode().strip()]
        runs = sorted([*zip(full, full[1:]), *((i,) for i in full if len(lines[i].encode().split()) > 50)])
        for r in runs:
            body = tuple(lines[i] for i in r)
            if body in seen:
                gone |= set(range(r[0], r[-1] + 1))
            seen.add(body)
        out.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_passages_against_all_repeated_line_runs(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r["clean_sha256"] for r in QUERIES["op3_passage_dedup"](spark, sf_dir).collect()}
    assert got == {i: sha(t) for i, t in zip(sorted(docs), brute_passages([docs[i] for i in sorted(docs)]))}


def test_passages_wherever_they_start_and_end(spark):
    run, long = [f"line {k} of the run" for k in range(6)], " ".join(f"w{k}" for k in range(51))
    texts = ["\n".join(["a0", "a1", *run, "a2", long]), "\n".join([*run[:4], "b0", *run[4:], "b1"]), "\n".join(["c0", *run[1:3], "", run[3], "c1"]),
             "\n".join(["d0", long, "d1", "line 0 of the run", "d2"]), "x\nx\nx"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["clean_text"] for r in line_dedup.passage_dedup(df).sort("doc_id").collect()]
    assert got == brute_passages(texts)
    assert got[1:4] == ["b0\nb1", "c0\nc1", "d0\nd1\nline 0 of the run\nd2"] and got[0] == texts[0] and got[4] == "x"


def test_passages_on_odd_rows(spark, odd, none):
    got = {(r["doc_id"], r["clean_text"]): r["n_lines"] for r in line_dedup.passage_dedup(odd).collect()}
    assert got[(7, LONG)] == 3 and got[(3, None)] == 0 and got[(4, "")] == 0 and got[(6, " \t\n ")] == 2
    assert line_dedup.passage_dedup(none).collect() == []


def test_lines_of_one_digest_with_several_bodies_stay(spark, monkeypatch):
    class Colliding:
        xxh3_128_digest = staticmethod(lambda x: b"c" * 16 if x in (b"one", b"two") else xxhash.xxh3_128_digest(x))

    monkeypatch.setattr(line_dedup, "xxhash", Colliding)
    df = spark.createDataFrame([(1, "a\nb\none\nc"), (2, "a\nb\ntwo\nc"), (3, "a\nb\none\nc")], "doc_id int, text string")
    got = [r["clean_text"] for r in line_dedup.passage_dedup(df).sort("doc_id").collect()]
    assert got == ["a\nb\none\nc", "two\nc", "one\nc"]  # "one" and its neighbours are not proven to stand before
