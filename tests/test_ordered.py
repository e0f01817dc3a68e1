"""Ordered windows in chunks give what lists give, whatever the chunks; quantiles by radix selection."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import joins as J
from sparkloom.operators.groups import ordered_bits, quantiles, ranked, with_group
from sparkloom.operators.nulls import interpolate
from sparkloom.operators import ordered
from sparkloom.operators.ordered import Ahead, Rolling, RowNumber, Running, Shift, Total, over_order
from sparkloom.session import prepare, scratch_path

SPECS = {
    "s": Running("sum", "v"), "c": Running("count", "v"), "lo": Running("min", "v"), "hi": Running("max", "v"),
    "last": Running("last", "v"), "next": Ahead("v"), "lag": Shift("v", 2), "lead": Shift("v", -3),
    "roll": Rolling("sum", "v", 4), "full": Rolling("avg", "v", 3, 3), "n": RowNumber(), "t": Total("sum", "v"), "tc": Total("count", "v")}


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"]) if i % 3 == 1 else f"k{i % 40}"
        value = None if rng.random() < 0.4 else rng.randint(-50, 50)
        rows.append((key, rng.randint(0, 30), i, value))
    return spark.createDataFrame(rows, "k string, day int, id int, v bigint").repartition(5)


def expected(rows, by, descending):
    """Brute force over Python lists."""
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[c] for c in by), []).append(r)
    out = {}
    for members in groups.values():
        members.sort(key=lambda r: (r["day"], r["id"]), reverse=descending)
        vals = [r["v"] for r in members]
        for i, r in enumerate(members):
            seen = [x for x in vals[:i + 1] if x is not None]
            later = [x for x in vals[i:] if x is not None]
            frame4 = [x for x in vals[max(0, i - 3):i + 1] if x is not None]
            frame3 = [x for x in vals[max(0, i - 2):i + 1] if x is not None]
            out[r["id"]] = (
                sum(seen) if seen else None, len(seen), min(seen, default=None), max(seen, default=None),
                seen[-1] if seen else None, later[0] if later else None, vals[i - 2] if i >= 2 else None,
                vals[i + 3] if i + 3 < len(vals) else None, sum(frame4) if frame4 else None,
                sum(frame3) / 3 if len(frame3) == 3 else None, i + 1,
                sum(x for x in vals if x is not None) if any(x is not None for x in vals) else None,
                sum(x is not None for x in vals))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("chunks, samples", [(1, 1), (60, 3), (512, 16)])
def test_over_order_matches_brute_force(spark, frame, monkeypatch, by, chunks, samples, descending):
    monkeypatch.setattr(ordered, "CHUNKS", chunks)
    monkeypatch.setattr(ordered, "SAMPLES", samples)
    out = over_order(frame, by, ["day", "id"], SPECS, descending).collect()
    want = expected(frame.collect(), by, descending)
    assert len(out) == 900
    for r in out:
        assert tuple(r[c] for c in SPECS) == pytest.approx(want[r["id"]]), r


def test_a_hot_group_is_spread_and_nothing_runs_while_planning(spark, frame):
    rows = spark.range(60_000).select(F.lit("hot").alias("k"), "id", (F.col("id") % 7).alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    out = over_order(rows, "k", "id", {"n": RowNumber(), "lag": Shift("v"), "next": Ahead("v")})
    assert len(tracker.getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setJobGroup("running", "running")
    held = out.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n")).collect()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["n"] for r in held) == 60_000 and max(r["n"] for r in held) <= 2 * 60_000 / parts
    assert out.where("n <> id + 1 or next <> v or (id > 0 and lag <> (id - 1) % 7)").count() == 0


def test_same_digits_at_any_partition_count(spark, frame):
    rows = frame.select("k", "day", "id", (F.col("v") * 0.1 + F.col("id") / 3).alias("v"))
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            out = over_order(rows.repartition(parts + 1), "k", ["day", "id"], {"s": Running("sum", "v"), "r": Rolling("avg", "v", 3)})
            found.append(sorted(tuple(r) for r in out.select("id", "s", "r").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_empty_and_single(spark, frame):
    for rows in (frame.where("id < 0"), frame.where("id = 5")):
        for by in (["k"], []):
            out = over_order(rows, by, ["day", "id"], SPECS)
            assert out.count() == rows.count()


def test_quantiles_and_ranks(spark, frame):
    got = {r["k"]: (r["a"], r["b"]) for r in quantiles(frame, "k", "v", {"a": 0.25, "b": 0.9}).collect()}
    ranks = ranked(frame, "k", "v").select("id", "rank_avg", "rank_min", "rank_dense").collect()
    pdf = frame.toPandas()
    assert len(got) > 40
    for key, (a, b) in got.items():
        vals = pdf[pdf.k.isna() if key is None else pdf.k == key].v.dropna()
        assert (a, b) == pytest.approx((vals.quantile(0.25), vals.quantile(0.9)))
    pdf["k"] = pdf.k.fillna("none")
    for method, col in (("average", "rank_avg"), ("min", "rank_min"), ("dense", "rank_dense")):
        want = dict(zip(pdf.id, pdf.groupby("k").v.rank(method=method)))
        for r in ranks:
            assert (r[col] is None and want[r["id"]] != want[r["id"]]) or r[col] == pytest.approx(want[r["id"]])


ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002, -1.0, 0.1, 0.1, 1e300, -1e300,
       1.7976931348623157e308, float("inf"), float("-inf"), 3.0, 4.0, 8.0, 7.999999999999999, 1024.0, 1023.9999999999999, 1e-5, 123456.789]


def test_bits_keep_the_order_of_doubles(spark):
    rng = random.Random(3)
    values = ODD + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 308) for _ in range(3000)]
    values += [2.0 ** e for e in range(-1074, 1024)] + [float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b")).collect()
    for r in rows:
        if r["v"] == r["v"] and r["v"]:
            bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
            assert r["b"] == (bits if r["v"] > 0 else -bits), r
        else:
            assert r["b"] == (0 if r["v"] == 0 else 2 ** 63 - 1)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_are_exact(spark, by):
    rng = random.Random(4)
    values = [v for v in ODD if abs(v) < 1e200] + [rng.gauss(0, 1) * 10 ** rng.randint(-9, 9) for _ in range(700)] + [2.5] * 300 + [None] * 20
    rows = [("hot" if i % 3 else f"k{i % 11}", v) for i, v in enumerate(values)] + [(None, 1.5), ("none", None)]
    probs = {"lo": 0.0, "a": 0.05, "m": 0.5, "b": 0.999, "hi": 1.0}
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {tuple(r[c] for c in by): tuple(r[p] for p in probs) for r in quantiles(df, by, "v", probs).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault((k,) if by else (), []).append(v)
    assert got.keys() == groups.keys()
    for key, vals in groups.items():
        vals.sort()
        for p, g in zip(probs.values(), got[key]):
            at = p * (len(vals) - 1)
            lo, hi = vals[math.floor(at)], vals[math.ceil(at)]
            assert g == lo + (hi - lo) * (at - math.floor(at))


def test_interpolation_leaves_known_points(spark, frame):
    out = interpolate(frame, "k", ["day", "id"], "v", "filled")
    assert out.filter("v IS NOT NULL AND v <> filled").count() == 0
    pdf = frame.toPandas().fillna({"k": "none"}).sort_values(["k", "day", "id"])
    want = pdf.groupby("k").v.transform(lambda s: s.astype("float64").interpolate())
    want = dict(zip(pdf.id, want))
    for r in out.withColumn("filled", F.col("filled").cast("double")).collect():
        w = want[r["id"]]
        assert (w != w and r["filled"] is None) or r["filled"] == pytest.approx(w)


def test_joins_of_group_values_are_split_on_skew(spark):
    """A key with most of the rows is split by adaptive execution, also before a group-by on the same key."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    path = scratch_path(spark, "skew")
    spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.rand(1).alias("v"),
                                F.col("id")).repartition(8).write.parquet(path)
    df = spark.read.schema("k bigint, v double, id bigint").parquet(path)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        prepare(spark)
        out = with_group(df, "k", total=F.sum("v")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("t"), F.max("v").alias("v"), F.max("id").alias("id"))
        got = {r["k"]: r["n"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert got[7] > 66_000 and sum(got.values()) == 200_000
    assert "skew=true" in plan


def test_as_of_join(spark):
    versions = spark.createDataFrame(
        [(1, 10, 20, 1, "a"), (1, 30, None, 1, "b"), (1, 30, None, 2, "c"), (None, 5, None, 1, "n"), (2, None, None, 1, "no"), (1, 12, 14, 0, "gone")],
        "k int, since int, until int, tie int, code string")
    asked = spark.createDataFrame([(1, 9), (1, 10), (1, 13), (1, 14), (1, 30), (1, 30), (1, 99), (None, 7), (2, 7), (3, 7), (1, None)], "k int, at int")
    got = J.as_of_join(asked, versions, ["k"], "at", "since", ["code"], until="until", tie="tie").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 9, None), (1, 10, "a"), (1, 13, "gone"), (1, 14, None), (1, 30, "c"), (1, 30, "c"), (1, 99, "c"), (None, 7, "n"),
         (2, 7, None), (3, 7, None), (1, None, None)], key=str)
    assert {r.code for r in J.as_of_join(asked, versions.limit(0), ["k"], "at", "since", ["code"]).collect()} == {None}
    assert J.as_of_join(asked.limit(0), versions, ["k"], "at", "since", ["code"]).count() == 0
    with pytest.raises(ValueError):
        J.as_of_join(asked, versions.withColumnRenamed("code", "AT"), ["k"], "at", "since", ["AT"])


def test_as_of_join_cuts_a_hot_key(spark):
    asked = spark.range(6000).selectExpr("IF(id % 3 = 0, id, 0) AS k", "id % 500 AS at", "id")
    versions = spark.range(1500).selectExpr("IF(id % 3 = 0, id, 0) AS k", "id % 400 AS since", "id AS code")
    got = {r.id: r.code for r in J.as_of_join(asked, versions, ["k"], "at", "since", ["code"], tie="code").collect()}
    held = {}
    for r in versions.collect():
        held.setdefault(r.k, []).append((r.since, r.code))
    assert got == {r.id: max((v for v in held.get(r.k, []) if v[0] <= r.at), default=(0, None))[1] for r in asked.collect()}


def test_rows_of_uncut_groups_are_looked_up_once(spark, frame):
    """What picks the rows for carries and halos is their group, not their place among the borders."""
    plan = over_order(frame, ["k"], ["day", "id"], SPECS)._jdf.queryExecution().optimizedPlan().toString()
    picks = [line for line in plan.splitlines() if "Filter" in line]
    assert any("array_contains" in line for line in picks) and not any(" aggregate(" in line or "(aggregate(" in line for line in picks)
