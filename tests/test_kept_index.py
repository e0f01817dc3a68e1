"""A kept index answers like a scan of the texts, grows by batches and opens only the files of the asked tokens."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import kept_index as KI
from sparkloom.sources import sinks

SCHEMA = "id bigint, t string, token string, span int"


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    out = {i * 331: " ".join(rng.choices(words[:3] if i % 3 else words, k=rng.randint(1, 12))) for i in range(-60, 240)}
    out[7] = "rare-w1 W0"
    return out


@pytest.fixture(scope="module")
def folder(spark, texts):
    folder, rows = sinks.scratch(spark, "index"), [(k, v, "clash", 1) for k, v in texts.items()]
    KI.append(spark.createDataFrame(rows[:150], SCHEMA), "id", "t", folder)
    KI.append(spark.createDataFrame(rows[150:] + rows[150:170] + [(None, "w0", "", 0), (9000, None, "", 0), (9001, " - ", "", 0)], SCHEMA),
              "id", "t", folder)
    return folder


@pytest.mark.parametrize("query", ["w0", "w0 w1", "w1 w2-w0", "w5 w6", "rare w0", "rare w39", "absent w0", "", " - "])
def test_search_equals_a_scan(spark, folder, texts, query):
    wanted = set(KI.wanted_tokens(query))
    want = sorted(k for k, v in texts.items() if wanted and wanted <= set(v.upper().replace("-", " ").split()))
    assert ids(KI.search(KI.open_index(spark, folder), "id", query)) == want


def test_blocks_are_bounded_sorted_and_counted(spark, folder, texts):
    index = KI.open_index(spark, folder)
    assert index.filter((F.size("offsets") != F.col("n")) | (F.col("n") > KI.SPAN) | (F.sort_array("offsets") != F.col("offsets"))).count() == 0
    assert index.filter("last - first >= 16384 OR first < span * 16384 OR offsets[0] != first - span * 16384").count() == 0
    count = {r.token: r.n for r in index.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    assert count["W0"] == sum("w0" in v.lower().replace("-", " ").split() for v in texts.values())


def test_only_blocks_of_the_tokens_are_read(spark, folder):
    index = KI.open_index(spark, folder)
    found = KI.blocks_of(index, ["RARE", "W0"])
    read = KI.reads(index, "rare w0").collect()
    held = index.filter("token IN ('RARE', 'W0')")
    assert sum(r.blocks for r in read) == held.count() and sum(r.ids for r in read) == held.agg(F.sum("n")).first()[0]
    assert len(read) < len(index.inputFiles()) / 5
    buckets = {r[0] for r in held.select("bucket").distinct().collect()}
    assert {int(r.file.split("bucket=")[1].split("/")[0]) for r in read} == buckets
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN", plan) and "In(token" in plan
    spans = KI.candidate_spans(index, "rare w0")
    assert spans.count() == 1 and spans.first().lo == spans.first().hi == 7  # one of the spans of W0 is left
    assert index.filter("token = 'W0'").select("span").distinct().count() > 3
    assert "offsets" not in spans._jdf.queryExecution().executedPlan().toString()


def test_a_batch_replaces_itself_and_an_id_may_grow(spark):
    folder = sinks.scratch(spark, "index")
    for _ in range(2):
        KI.append(spark.createDataFrame([(1, "a b"), (2, "a")], "id bigint, t string"), "id", "t", folder, batch="one")
    KI.append(spark.createDataFrame([(2, "b"), (1, "a")], "id bigint, t string"), "id", "t", folder, batch="two")
    index = KI.open_index(spark, folder)
    assert index.agg(F.sum("n")).first()[0] == 5 and ids(KI.search(index, "id", "b a")) == [1, 2]


def test_an_empty_table_makes_an_empty_index(spark):
    folder = sinks.scratch(spark, "index")
    KI.append(spark.createDataFrame([], "id bigint, t string"), "id", "t", folder)
    assert ids(KI.search(KI.open_index(spark, folder), "id", "a")) == []
