"""Keyed state: totals and first arrivals equal the batch whatever the order, late rows stay, state ends, loads go on."""

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.sources import sinks
from sparkloom.streaming import keyed_state as K
from sparkloom.streaming import micro_batches as M

SCHEMA = "id bigint, ts timestamp_ntz, u string, v double"
U = {"u": "string"}


def deliver(spark, path, days, users=("a", "b", None)):
    """One file a day, in the given order."""
    for day in days:
        rows = [(day * 10 + i, dt.datetime(2024, 1, day, i), u, None if i == 1 else day + 0.25) for i, u in enumerate(users)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


def stream(spark, path):
    return M.read_files(spark, path + "/", SCHEMA, files_per_batch=1)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def batch_totals(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path).groupBy("u").agg(
        F.count(F.lit(1)), F.sum("v"), F.max("v"), F.min("ts"), F.max("ts")))


@pytest.mark.parametrize("days", [[1, 2, 3, 4], [4, 3, 2, 1]])
def test_totals_and_first_equal_batch_in_any_order(spark, days):
    path = deliver(spark, sinks.scratch(spark, "keyed"), days)
    changes = K.load(K.keyed_totals(stream(spark, path), ["u"], "ts", "v", slots=2), sinks.scratch(spark, "a"))
    assert rows(K.totals_of(changes, U)) == batch_totals(spark, path)
    first = K.load(K.keyed_first(stream(spark, path), "u", "v", "ts", slots=2), sinks.scratch(spark, "b"))
    want = spark.read.schema(SCHEMA).parquet(path).groupBy("u", F.col("v").cast("string").alias("item")).agg(F.min("ts"))
    assert rows(K.first_of(first, U)) == rows(want)


def test_lifetime_closes_keys_and_keeps_late_rows(spark):
    path = sinks.scratch(spark, "keyed")
    deliver(spark, path, [1, 2], users=("a", "b"))
    deliver(spark, path, [20, 21], users=("c",))  # moves the mark past a and b
    deliver(spark, path, [3], users=("a",))  # late
    spark.createDataFrame([(9, None, "c", 1.5)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)
    deliver(spark, path, [22], users=("b",))  # begins anew
    changes = K.load(K.keyed_totals(stream(spark, path), ["u"], "ts", "v", lifetime="3 days", slots=1), sinks.scratch(spark, "a")).cache()
    closed = changes.filter("kind = 'closed'")
    assert rows(K._keys(closed, U).select("u", "n", "units")) == [("a", 2, 350), ("b", 2, None)]
    assert rows(K.aside_of(changes, U).select("u", "kind", "units")) == [("a", "late", 325), ("c", "undated", 150)]
    assert rows(K.totals_of(changes, U, aside=True)) == batch_totals(spark, path)
    assert rows(K.totals_of(changes, U).select("u", "n")) == [("a", 2), ("b", 3), ("c", 2)]


def state_rows(spark, folder):
    """Keys that the state store still holds."""
    return spark.read.format("statestore").option("stateVarName", "totals").load(f"{folder}/state").count()


def test_state_is_bounded_by_the_lifetime(spark):
    path, held = sinks.scratch(spark, "keyed"), []
    folder = sinks.scratch(spark, "a")
    for round_ in range(3):  # new users every day; each call is a restart
        for day in range(1 + 5 * round_, 6 + 5 * round_):
            deliver(spark, path, [day], users=tuple(f"{day}-{i}" for i in range(4)))
        changes = K.load(K.keyed_totals(stream(spark, path), ["u"], "ts", "v", lifetime="2 days", slots=1), folder)
        held.append(state_rows(spark, folder))
    assert max(held) <= 4 * 4 and held[0] == held[2]
    assert rows(K.totals_of(changes, U)) == batch_totals(spark, path) and K.aside_of(changes, U).count() == 0


def test_restart_goes_on_and_null_amounts_and_empty_tables(spark):
    path, folder = deliver(spark, sinks.scratch(spark, "keyed"), [5]), sinks.scratch(spark, "a")
    make = lambda: K.load(K.keyed_totals(stream(spark, path), ["u"], "ts", "v", slots=2), folder)
    make()
    deliver(spark, path, [2, 7])
    assert rows(K.totals_of(make(), U)) == batch_totals(spark, path)
    assert make().count() == make().count()  # nothing new, nothing handed out again
    none = sinks.scratch(spark, "none")
    spark.createDataFrame([], SCHEMA).write.parquet(none)
    empty = K.load(K.keyed_totals(stream(spark, none), ["u"], "ts", "v"), sinks.scratch(spark, "c"))
    assert K.totals_of(empty, U).count() == 0


def test_null_numbers_as_keys(spark):
    path = sinks.scratch(spark, "keyed")
    data = [(i, dt.datetime(2024, 1, 1, i), None if i % 2 else 2 ** 60 + i, 1.0) for i in range(6)]
    spark.createDataFrame(data, "id bigint, ts timestamp_ntz, u bigint, v double").write.parquet(path)
    src = M.read_files(spark, path + "/", "id bigint, ts timestamp_ntz, u bigint, v double")
    changes = K.load(K.keyed_totals(src, ["u"], "ts", "v"), sinks.scratch(spark, "a"))
    got = {r.u: r.n for r in K.totals_of(changes, {"u": "bigint"}).collect()}
    assert got == {None: 3, 2 ** 60: 1, 2 ** 60 + 2: 1, 2 ** 60 + 4: 1}


def test_keys_share_states_and_a_hot_key_is_few_rows():
    """What goes to the states is one row per key of a batch, and a state works for many keys."""
    part = pd.DataFrame({"who": ["a", "a", "b", "a"], "slot": [1, 1, 1, 1], "dated": [True, True, False, False], "us": [7, 5, 0, 0],
                         "has": [1, 0, 0, 1], "amount": [30, 0, 0, 12]})
    (out,) = K._pieces(iter([part]))
    got = [tuple(None if pd.isna(v) else v for v in r) for r in out.itertuples(index=False)]
    assert got == [("a", 1, 5, 5, 7, 3, 2, 42, 30), ("b", 1, None, None, None, 1, 0, None, None)]
    seen = pd.DataFrame({"who": ["a", "a", "b"], "slot": [1, 1, 1], "us": [9, 4, 6], "named": [True, True, False], "item": ["x", "x", ""]})
    (first,) = K._earliest(iter([seen]))
    assert [tuple(r) for r in first.itertuples(index=False)] == [("a", 1, 4, True, "x"), ("b", 1, 6, False, "")]
