"""Source mixing (marginals, odd rows) and the pipeline against a brute-force version of its stages."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from guestfold.llm import decontaminate, mixing, quality, simhash
from guestfold.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"


def docs_of(spark):
    return spark.read.parquet(f"{MID}/documents.parquet")


def test_raked_weights_meet_the_targets(spark):
    targets = {"source": 0.5, "lang": {"en": 0.4, "de": 0.2, "fr": 0.3, "es": 0.1}, "topic": 1.0}
    got = mixing.mix(docs_of(spark), targets=targets, rounds=30).toPandas()
    mass = got["__tokens"] * got["__weight"]
    total = got["__tokens"].sum()
    by = lambda c, m: m.groupby(got[c]).sum() / total
    for k, v in targets["lang"].items():
        assert by("lang", mass)[k] == pytest.approx(v, abs=1e-3)
    tempered = by("source", got["__tokens"]) ** 0.5
    assert by("source", mass).sort_index().to_numpy() == pytest.approx((tempered / tempered.sum()).sort_index().to_numpy(), abs=1e-3)
    assert by("__topic", mass).to_numpy() == pytest.approx(by("__topic", got["__tokens"]).to_numpy(), abs=1e-3)
    assert got["__probability"].between(0, 1).all() and got["__probability"].max() == pytest.approx(1)
    kept = got[got["__kept"]]
    assert len(kept) == pytest.approx(got["__probability"].sum(), rel=0.15)
    assert set(docs_of(spark).columns) <= set(got.columns)


def test_one_document_of_a_rare_cell_hardly_lowers_the_others(spark):
    docs = docs_of(spark).select("doc_id", "text", "source", "lang")
    rare = docs.limit(1).select(F.lit(-1).cast("bigint").alias("doc_id"), "text", F.lit("new source").alias("source"), F.lit("xx").alias("lang"))
    plain, more = (mixing.mix(d).drop("text").toPandas().set_index("doc_id") for d in (docs, docs.unionByName(rare)))
    share = lambda g: (g["__tokens"] * g["__probability"]).sum() / g["__tokens"].sum()
    assert share(plain) == pytest.approx(mixing.KEEP, abs=1e-6) and share(more) == pytest.approx(mixing.KEEP, abs=1e-6)
    assert more["__probability"].between(0, 1).all() and more.loc[-1, "__probability"] == 1
    assert (more["__probability"].drop(-1) - plain["__probability"]).abs().max() < 0.05
    assert plain["__kept"].mean() == pytest.approx(mixing.KEEP, abs=0.05)


def test_bounded_probabilities_meet_targets_that_the_tokens_allow(spark):
    got = mixing.mix(docs_of(spark), keep=0.4, rounds=30).drop("text").toPandas()
    kept = got["__tokens"] * got["__probability"]
    for c in ("source", "lang", "__topic"):
        want = (got["__tokens"] * got["__weight"]).groupby(got[c]).sum() / got["__tokens"].sum()
        assert (kept.groupby(got[c]).sum() / kept.sum()).to_numpy() == pytest.approx(want.to_numpy(), abs=1e-3)


def test_cells_raked_by_many_tasks_get_the_same_weights(spark, monkeypatch):
    one = {tuple(r) for r in mixing.report(docs_of(spark)).collect()}
    monkeypatch.setattr(mixing, "TASK_CELLS", 20)
    assert {tuple(r) for r in mixing.report(docs_of(spark)).collect()} == one


def test_mixing_on_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == 12 and all(0 <= r["__probability"] <= 1 for r in got)
    assert {r["__tokens"] for r in got if r["doc_id"] in (3, 4, 5, 6)} == {0}
    assert len({r["__kept"] for r in got if r["doc_id"] == 2}) == 1
    assert mixing.mix(none).collect() == []
    assert mixing.mix(odd, targets={"source": {"a": 1.0}, "lang": 1.0, "topic": 1.0}).filter("source = 'b' and __tokens > 0 and __kept").count() == 0
    assert mixing.mix(odd.withColumn("kind", F.lit("k")), topic_col="kind").select("__topic").distinct().count() == 1


def test_only_dataframe_operations(spark):
    plan = mixing.report(docs_of(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def brute_pipeline(spark):
    """The rows of the last stage, by plain loops; the learnt model and the raked probabilities are taken as they are."""
    docs = {r["doc_id"]: r for r in docs_of(spark).collect()}
    model = quality.fit(docs_of(spark), spark.read.parquet(f"{MID}/labels.parquet"))
    scores = model.score(np.stack([quality.terms(r["text"].encode()) for r in docs.values()]))
    kept = [i for i, s in zip(docs, scores) if s >= 0.3]
    fps = {i: simhash.fingerprint(docs[i]["text"].encode()) for i in kept}
    least = {i: i for i in kept}
    changed = True
    close = [(a, b) for a in kept for b in kept if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    while changed:
        changed = False
        for a, b in close:
            m = min(least[a], least[b])
            if (least[a], least[b]) != (m, m):
                least[a] = least[b] = m
                changed = True
    kept = [i for i in kept if least[i] == i]
    windows = set()
    for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect():
        w = decontaminate.words(r["text"])
        windows |= {tuple(w[k:k + min(len(w), 10)]) for k in range(len(w) - min(len(w), 10) + 1) if w}
    sizes = {len(x) for x in windows}
    clean = lambda w: not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    kept = [i for i in kept if clean(decontaminate.words(docs[i]["text"]))]
    mixed = mixing.mix(docs_of(spark).filter(F.col("doc_id").isin(kept))).filter("__kept").select("doc_id").collect()
    t, at, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i in sorted(r["doc_id"] for r in mixed):
        ids = np.array([*t.encode(docs[i]["text"], add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_pipeline_against_brute_force(spark):
    assert sorted(map(tuple, QUERIES["pipeline"](spark, MID).collect())) == brute_pipeline(spark)


def test_stages_keep_the_columns_and_stand_odd_rows(spark, odd, none):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for rows in (odd, none):
        docs = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, MID)
            assert docs.columns == odd.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, MID).collect()
    near = corpus_pipeline.near_dedup_stage(spark, odd, MID).collect()
    assert sorted(r["doc_id"] for r in near) == [1, 3, 7, 8, 9]


def test_near_dedup_tells_rows_with_one_id_apart(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(1, a), (1, b), (1, b), (None, b), (None, "lone words that nothing else has in it"), (2, a),
            (None, "another text without an id of its own"), (None, "another text without an id of its own")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.one_of_each(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, a), (1, b), (None, rows[4][1]), (None, rows[6][1])], key=str)


def test_stages_keep_columns_that_clash_with_internal_names(spark, odd):
    names = ["__n", "__j", "__weight", "__kept", "__topic", "__tokens", "__probability", "row", "n", "digest", "draw", "kept", "j", "probability"]
    docs = odd.withColumns({n: F.concat(F.lit(n), F.coalesce("doc_id", F.lit(0))) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, MID)
        assert got.columns == docs.columns, name
        assert all(r[n] == f"{n}{r['doc_id'] or 0}" for r in got.collect() for n in names), name
    corpus_pipeline.STAGES[-1][1](spark, docs, MID).collect()
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in ("__weight", "__kept", "__topic", "__tokens", "__probability")] + [
        "__topic", "__tokens", "__weight", "__probability", "__kept"]
    assert mixed.filter("probability <> concat('probability', coalesce(doc_id, 0))").count() == 0
