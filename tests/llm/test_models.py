"""Importance resampling, neighbour search and the pipeline."""

import random

import numpy as np
import pytest
from samples import prose

import __spark_entry__ as entry
import corpus_pipeline
from sparkloom.llm import importance as I
from sparkloom.llm import neighbours as K
from sparkloom.llm.common import stage


# ---- importance

def corpus():
    r = random.Random(12)
    good = [(i, prose(i, r.randint(20, 300)), "en", "a") for i in range(400)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(5000 + i, r.randint(20, 300)).split()), "en", "a") for i in range(80)]
    bad += [(2000 + i, "buy " * r.randint(30, 90), "en", "a") for i in range(40)]
    return good, bad


@pytest.fixture(scope="module")
def judged(spark, make, tmp_path_factory):
    good, bad = corpus()
    folder = str(tmp_path_factory.mktemp("sf"))
    make(good + bad).write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, 0) for d, *_ in good[::2]] + [(d, 0, 0) for d, *_ in bad[::2]] + [(None, 1, 0), (5, None, 0), (10 ** 9, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {d for d, *_ in good}


def test_held_out_accuracy(spark, judged):
    folder, good = judged
    rows = I.op5_importance(spark, folder).collect()
    odd = [r for r in rows if r.doc_id % 2]  # without labels
    assert sum(r.kept == (r.doc_id in good) for r in odd) >= 0.97 * len(odd)
    assert sum(r.kept for r in rows if r.doc_id in good) >= 0.99 * len(good)
    assert {(r.doc_id, r.kept, r.key) for r in rows} == {(r.doc_id, r.kept, r.key) for r in I.op5_importance(spark, folder).collect()}


def test_top_k_is_the_largest_keys(spark):
    r = random.Random(3)
    keys = [r.gauss(0, 50) for _ in range(500)] + [7.0] * 5
    from pyspark.sql import functions as F
    df = stage(spark.createDataFrame([(k,) for k in keys], "k double").select("k", I.as_hash(F.col("k")).alias("h")), "test")
    for k in (0, 1, 10, 499, 505):
        kept = df.where(F.col("h") <= I.top_k(df, k)).count()
        steps = sorted((int(np.floor(x * (1 << 20))) for x in keys), reverse=True)
        assert kept == (0 if k == 0 else sum(s >= steps[k - 1] for s in steps))


def test_gumbel_draws_in_proportion(spark):
    from pyspark.sql import functions as F
    rows = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, F.log(F.lit(3.0))).otherwise(0.0).alias("w"))
    top = rows.withColumn("key", F.col("w") + I.gumbel("id")).orderBy(F.desc("key")).limit(500)
    assert 0.68 < top.where("id % 2 = 0").count() / 500 < 0.82


def test_hard_rows(spark, hard, make, sf):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ratios, limit = I.classify(hard, labels)
    assert limit == -float("inf") and not ratios.any()
    scored = I.scored(hard, ratios)
    assert scored.columns == [*hard.columns, "__n", "__weight"]
    kept = I.quality_stage(spark, hard, sf)
    assert kept.columns == hard.columns and kept.where("text is null or trim(text) = ''").count() == 0
    assert I.quality_stage(spark, make([]).limit(0), sf).collect() == []


# ---- neighbours

def plain_search(rows, k=20):
    """Every valid row against every other one."""
    dims = max({len(v) for _, v in rows if v}, key=lambda n: sum(len(v or []) == n for _, v in rows), default=0)
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == dims and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.array(v)
    out = {}
    for q in good:
        if q % 20 == 0:
            out[q] = sorted(((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q))[:k]
    return out


def test_small_tables_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=6).round(3).tolist()) for i in range(90)]
    rows += [(i, rows[5][1]) for i in range(100, 180)]  # more copies than neighbours
    rows += [(300, None), (320, [0.0] * 6), (340, [float("nan")] * 6), (360, [1.0] * 5 + [None]), (380, [1.0] * 3),
             (None, [1.0] * 6), (400, [float("inf")] + [1.0] * 5), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 key", "2 v", "3 cid", "4 part").repartition(4)
    got = {}
    for x in K.search(df, "vec_id % 20 = 0").collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    want = plain_search(rows)
    assert set(got) == set(want)
    for q, near in want.items():
        found = sorted(got[q])
        assert [a for a, _, _ in found] == list(range(1, len(near) + 1))
        assert [i for _, i, _ in found] == [i for _, i in near]
        assert np.allclose([s for _, _, s in found], [-s for s, _ in near], atol=1e-12)
    one = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert K.search(one, "vec_id % 20 = 0").collect() == [] and K.search(one.limit(0), "vec_id % 20 = 0").collect() == []


def test_near_ties_of_large_vectors(spark):
    r = np.random.default_rng(8)
    one = r.normal(size=6) * 1e6  # products of one query with its shuffled forms differ in the last bits only
    rows = [(i, ([1e6 / 3] * 6 if i % 20 == 0 else r.permutation(one).tolist())) for i in range(200)]
    got = {}
    for f in K.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 20 = 0").collect():
        got.setdefault(f.query_id, []).append((f.rank, f.vec_id))
    assert {q: [i for _, i in sorted(near)] for q, near in got.items()} == {q: [i for _, i in near] for q, near in plain_search(rows).items()}


def test_partitions_reach_the_recall(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(30, 16))
    x = centres[r.integers(0, 30, 3000)] + 0.4 * r.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for f in K.search(df, "vec_id % 20 = 0", sample=1500, block=200, batch=20, parts=8).collect():
        got.setdefault(f.query_id, set()).add(f.vec_id)
    want = plain_search(rows)
    assert np.mean([len(got[q] & {i for _, i in near}) / 20 for q, near in want.items()]) >= 0.9


def test_parts_are_balanced():
    r = np.random.default_rng(5)
    x = r.normal(size=(900, 8))
    part = K.balanced_parts(x, K.nearest(x, x, 11)[:, 1:], 6, r)
    assert np.bincount(part, minlength=6).max() <= 166


# ---- pipeline

def test_pipeline(spark, judged, tmp_path):
    folder, good = judged
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "secret scans",
                                                     "mixing sources to target weights", "packing"]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        held.append(docs)
        if i < 4:
            assert docs.columns == columns
    ids = {r.doc_id for r in held[0].select("doc_id").collect()}
    assert len(ids & good) >= 0.99 * len(good) and len(ids - good) <= 3
    assert held[1].count() == held[1].select("doc_id").distinct().count()
    assert {r.doc_id for r in held[4].select("doc_id").distinct().collect()} == {
        r.doc_id for r in held[3].select("doc_id").distinct().collect()}


def test_pipeline_on_hard_rows(spark, hard, make, sf):
    for docs in (hard, make([]).limit(0)):
        for name, step in corpus_pipeline.STAGES[:-1]:
            docs = stage(step(spark, docs, sf), name.split()[0])
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()


def test_every_corpus_query_is_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)}
