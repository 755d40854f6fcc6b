"""Token counts and coded token blocks against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from guestfold.llm import rangecoder, token_blocks, token_counts
from guestfold.llm.pretokens import byte_chars
from guestfold.llm.queries import QUERIES

from odd_rows import LONG

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["It's we'll '' 's''ll x 'd'm x'S don't I'll you've", "héllo wörld naïve ﬁ ſ İstanbul Ⅷ ½ 日本語 テスト 한국 é é 🎉🎉 zero​width",
         "a<|endoftext|>b <|startoftext|><|endoftext|>", "", "   ", " \n\n  x  \ty ", "1234 abc123 !!!??..", "\x1c\x1d a\x85b\xa0c", "a" * 500, "ab" * 200,
         "!" * 300, "AAAA bbbb ŉ Ŀ ÀÉ ×÷"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(WORD)


def test_counts_are_the_librarys(spark, sf_dir, counter):
    t = Tokenizer.from_file(WORD)
    for x in TEXTS:
        assert counter.count(x) == len(t.encode(x, add_special_tokens=False).ids), x
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op4_token_counts"](spark, sf_dir).collect()}
    for (i, x), e in zip(docs.items(), t.encode_batch(list(docs.values()), add_special_tokens=False)):
        r = got[i]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(x.encode()), len(e.ids), len(e.ids) > 2048)
        assert r["tokens_within"] <= 2048 and (r["tokens_within"] == r["n_tokens"]) != r["over_limit"]


def test_counts_at_every_prefix(spark, sf_dir, counter):
    t = Tokenizer.from_file(WORD)
    raw = {c: b for b, c in enumerate(byte_chars())}
    some = [r["text"][:200] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(12).collect()]
    for x in [y.lower() for y in some] + ["it's we'll x'll don't 's ''s", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "a<|endoftext|>b1234!!??"]:
        data, at = x.encode(), 0
        for word, counts in counter.prefix_counts(x):
            own = word.encode() if word in counter.split.special else bytes(raw[c] for c in word)
            at = data.index(own, at)
            for k, n in zip([len(own)] if len(counts) == 1 and len(own) > 1 else range(1, len(own) + 1), counts):
                try:
                    cut = data[:at + k].decode()
                except UnicodeDecodeError:
                    continue
                assert n == len(t.encode(cut, add_special_tokens=False).ids), cut[-30:]
            at += len(own)


def test_budgets(counter):
    n = counter.count("one two three unbelievable")
    assert counter.words_within("one two three unbelievable", n) == (4, n)
    assert counter.words_within("one two three unbelievable", 2) == (2, 2)
    assert counter.words_within("", 5) == counter.words_within(None, 5) == (0, 0)


def test_counts_on_odd_rows(odd, none):
    got = {(r["doc_id"], r["n_bytes"]): (r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(odd, WORD).collect()}
    assert got[(3, 0)] == got[(4, 0)] == got[(None, 0)] == (0, False)
    assert got[(7, len(LONG))] == (len(Tokenizer.from_file(WORD).encode(LONG, add_special_tokens=False).ids), True)
    assert token_counts.token_counts(none, WORD).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_range_coder_round_trip(seed):
    rng = np.random.default_rng(seed)
    blocks = [np.zeros(0, int), np.array([rangecoder.MAX_ID]), np.zeros(3000, int), np.arange(700),
              rng.integers(0, 1 << 29, 2000), rng.zipf(1.2, 5000) % 50_000, np.tile([7, 8, 9], 900),
              *[rng.integers(0, 1 << rng.integers(1, 20), s) for s in rng.integers(0, 600, 40)]]
    coded = rangecoder.encode(blocks)
    back = rangecoder.decode([(len(b), bits, code) for b, (bits, code) in zip(blocks, coded)])
    assert all(len(a) == len(b) and (a == b).all() for a, b in zip(blocks, back))
    assert rangecoder.encode([]) == [] and rangecoder.decode([]) == []
    with pytest.raises(ValueError):
        rangecoder.encode([np.array([1 << 29])])


def test_blocks_do_not_depend_on_their_neighbours():
    a, b = np.arange(2000) % 97, np.arange(1500) % 89
    assert rangecoder.encode([a, b]) == [rangecoder.encode([x])[0] for x in (a, b)]


def test_a_predictable_block_is_small():
    code = rangecoder.encode([np.tile(np.arange(50), 80)])[0][1]
    assert len(code) < 0.15 * 2 * 4000


def test_code_size_of_documents(spark):
    """Blocks beat deflate on the same blocks, and all orders together the entropy of single ids over all blocks."""
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").sort("doc_id").select("text").collect()]
    encoded = Tokenizer.from_file(BYTE).encode_batch_fast([x or "" for x in docs], add_special_tokens=False)
    ids = np.concatenate([[*e.ids, 2] for e in encoded])
    blocks = [ids[i:i + rangecoder.BLOCK] for i in range(0, len(ids), rangecoder.BLOCK)]
    coded = sum(len(code) for _, code in rangecoder.encode(blocks)) * 8 / len(ids)
    deflated = sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks) * 8 / len(ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert coded < 0.85 * deflated and coded < -(share * np.log2(share)).sum()


def test_a_table_learnt_in_steps_is_that_of_all_ids():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, (200, 5)) % 300
    table = rangecoder._Table(5)
    for a, b in ((0, 8), (8, 9), (9, 120), (120, 200)):
        table.add(ids[a:b])
    for lane in range(5):
        own = table.keys >> 32 == lane
        values, counts = np.unique(ids[:, lane], return_counts=True)
        assert (table.keys[own] & 0xFFFFFFFF).tolist() == values.tolist() and table.counts[own].tolist() == counts.tolist()
        ends = table.start[own] + table.freq[own]
        assert table.start[own][0] == 0 and (table.start[own][1:] == ends[:-1]).all() and ends[-1] == table.last[lane] < 65536
        once = (counts == 1).sum() / 200
        assert abs((65536 - table.last[lane]) / 65536 - once) < 0.02


def test_coder_and_decoder_share_their_tables():
    """The coder's counts by rank give every id the share that the decoder's table finds it by."""
    rng = np.random.default_rng(7)
    ids = (rng.zipf(1.3, (300, 6)) % 400).astype(np.uint32)
    counts, table = rangecoder._Counts(ids), rangecoder._Table(6)
    for a, b in ((0, 0), (0, 8), (8, 9), (9, 120), (120, 200)):
        if b:
            counts.add(b)
            table.add(ids[a:b])
        assert (counts.last == table.last).all()
        lane = np.tile(np.arange(6), 300 - b)
        start, size, known = counts.of_ids(lane, counts.at[b:].ravel())
        for slot in (start, start + size - 1):
            got = table.of_slots(lane, slot)
            assert (got[0] == start).all() and (got[1] == size).all() and (got[2] == known).all()
            assert (got[3][known] == ids[b:].ravel()[known]).all()
        assert (known == [x in ids[:b, k] for x, k in zip(ids[b:].ravel(), lane)]).all()


def test_words_in_use_are_not_encoded_again(monkeypatch):
    """A full cache of words lets go of those that no text used lately, not of all."""
    monkeypatch.setattr(token_blocks, "CACHE_WORDS", 40)
    e, t, asked = token_blocks.WordEncoder(BYTE), Tokenizer.from_file(BYTE), []

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return t.model.tokenize(word)

    e.known.model = Model()
    texts = [f"common words here and word{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(300)]
    for x, ids in zip(texts, (e.encode([x])[0] for x in texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids
    assert len(asked) == 304 and len(e.known) + len(e.known.older) <= 50


def test_the_longest_block():
    ids = np.random.default_rng(5).permutation(rangecoder.MOST)
    [(bits, code)] = rangecoder.encode([ids])
    assert (rangecoder.decode([(len(ids), bits, code)])[0] == ids).all()
    with pytest.raises(ValueError):
        rangecoder.encode([np.zeros(rangecoder.MOST + 1, int)])


def test_crc32_join():
    a, b = b"first part" * 99, b"and the second"
    assert rangecoder.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rangecoder.crc32_join(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def expected(docs):
    t, at, out = Tokenizer.from_file(BYTE), 0, []
    for i, x in docs:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


def test_token_blocks_query(spark, sf_dir):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = sorted(map(tuple, QUERIES["op2_token_blocks"](spark, sf_dir).collect()))
    assert got == [x[:4] for x in expected(docs)]


def test_token_blocks_on_odd_rows(spark, odd, none):
    rows = [r for r in odd.select("doc_id", "text").collect() if r["doc_id"] is not None]
    rows += [spark.createDataFrame([(100 + k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string").collect()][0]
    df = spark.createDataFrame([tuple(r) for r in rows], "doc_id bigint, text string")
    got = sorted(map(tuple, token_blocks.round_trip(df, BYTE, with_ids=True).collect()))
    want = expected(sorted((tuple(r) for r in rows), key=lambda r: r[0]))
    assert [tuple(x) for x in got] == want
    nulls = token_blocks.round_trip(odd, BYTE).filter("doc_id is null").collect()
    assert sorted(r["start"] for r in nulls)[0] == 0 and len(nulls) == 2  # nulls come first
    assert token_blocks.round_trip(none, BYTE).collect() == []


def test_a_damaged_block_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(k, f"text number {k}") for k in range(50)], "doc_id bigint, text string")
    token_blocks.write_ids(df, f"{tmp_path}/a", BYTE)
    blocks = spark.read.parquet(f"{tmp_path}/a")
    blocks.selectExpr("* except (crc32)", "crc32 + 1 as crc32").write.parquet(f"{tmp_path}/b")
    with pytest.raises(Exception, match="doesn't fit its checksum"):
        token_blocks.read_ids(spark, f"{tmp_path}/b").collect()


def test_long_ids_beside_a_null_keep_their_digits(spark):
    from guestfold.llm import decontaminate, langid, line_dedup, quality, simhash
    big = 2 ** 60 + 1
    df = spark.createDataFrame([(big, "one two\nthree"), (None, "four"), (big + 1, "five\nsix")], "doc_id bigint, text string")
    none = df.filter("1 = 0")
    outs = [token_blocks.round_trip(df, BYTE), token_counts.token_counts(df, WORD), line_dedup.line_dedup(df), simhash.simhash_components(df),
            langid.identify(df, langid.fit(df.selectExpr("doc_id", "text", "'en' lang"))), quality.score(df, quality.fit(none, none.withColumnRenamed("text", "quality"))),
            decontaminate.decontaminate(df, spark.createDataFrame([(1, "five six")], "item_id int, text string"))]
    for out in outs:
        assert {r["doc_id"] for r in out.collect()} == {big, big + 1, None}


def test_stored_prefix_tables_answer_without_encoding(spark, odd, none, sf_dir, counter):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 3000").limit(30).unionByName(
        odd.filter("doc_id in (3, 4, 8)").withColumn("doc_id", -F.col("doc_id")).select("doc_id", "text"), allowMissingColumns=True).select("doc_id", "text")
    stored = token_counts.prefix_tables(docs, path).withColumn("n", F.lit(40)).withColumn("budget", F.lit(25))
    got = stored.select("doc_id", "counts", token_counts.tokens_of(F.col("counts"), F.col("n")).alias("head"),
                        token_counts.steps_within(F.col("counts"), F.col("budget")).alias("fit")).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    totals = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path).collect()}
    assert len(got) >= 30
    for r in got:
        want = [n for _, own in counter.prefix_counts(texts[r["doc_id"]]) for n in own] if texts[r["doc_id"]] else []
        assert r["counts"] == want and (want[-1] if want else 0) == totals[r["doc_id"]]
        assert r["head"] == (want[min(40, len(want)) - 1] if want else 0)
        assert r["fit"] == max([i + 1 for i, x in enumerate(want) if x <= 25], default=0)
    assert token_counts.prefix_tables(none, path).collect() == []
