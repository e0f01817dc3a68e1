"""Ranked search against looking every term up in every document."""

import math
import re
from collections import Counter

import pytest
from sparkloom.llm.lexical import Best, OP12_SQL, Scanner, folded, op12_lexical, search

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score long, rank int, term string"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain(docs, items, k=10):
    """{item_id: [(score, doc_id), ...]} from (doc_id, text) and (item_id, text)."""
    counted = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    counted = [x for x in counted if x[2]]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = {}
    for item, wanted in asked.items():
        found = []
        for d, c, n in counted:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in wanted.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out[item] = [(-s, None if none else d) for s, none, d in sorted(found)[:k]]
    return {i: r for i, r in out.items() if r}


def by_item(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["item_id"]), r["rank"])):
        assert r["rank"] == len(out.setdefault(r["item_id"], [])) + 1
        out[r["item_id"]].append((r["score"], r["doc_id"]))
    return out


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "alpha12 beta7 alpha12 École380 two words"), (2, "MIT License"), (3, None), (4, "  .,; "), (5, "x9x9 unknown"),
            (None, "spam line"), (6, "token=longenough1 0123456789abcdef"), (6, "two"), (7, "東京3 straße5 ÉCOLE1 école1"), (8, "spam")]
    return spark.createDataFrame([(*r, 1, 2, 3, "t") for r in rows], ITEMS)


@pytest.mark.parametrize("block_bytes", [4 << 20, 100])
def test_hard_rows(hard, items, block_bytes):
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert by_item(search(hard, items, block_bytes=block_bytes)) == plain(docs, asked)


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    asked = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert by_item(op12_lexical(spark, sf)) == plain(docs, asked)


def test_ties_over_many_partitions(spark):
    """A third of all rows are copies with one score; the smallest ids win, wherever they lie."""
    docs = [(i * 7919 % 1000, "same words here" if i % 3 == 0 else f"same other{i}") for i in range(1000)] + [(None, "same words here")]
    asked = [(1, "words"), (2, "same"), (3, "here same")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(23)
    found = by_item(search(df, spark.createDataFrame(asked, "item_id long, text string")))
    assert found == plain(docs, asked)


def test_empty_tables(spark, hard, items):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert search(none, items).collect() == []
    assert search(hard, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert search(hard, items.where("item_id in (3, 4)")).collect() == []


def test_terms_are_whole():
    scanner = Scanner([b"a", b"ab", b"\xc3\xa9"])
    assert scanner.counts(folded("A a,ab--aab abé é É ab".encode())) == Counter({0: 2, 1: 2, 2: 1})
    assert folded(None) == folded(b"") == b" "


def test_best_keeps_the_first_of_equals():
    import numpy as np

    best = Best(1, 2)
    for ids in ([9, 4, None], [5, 1, 3], [None, 2, 8]):
        best.add(ids, np.full((3, 1), 7, np.int64))
    assert best.rows[0] == [(-7, False, 1), (-7, False, 2)]


def test_long_text(spark):
    docs = [(1, "needle " * 300_000 + "hay"), (2, "hay " * 400_000)]
    asked = [(1, "needle hay")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_item(search(df, spark.createDataFrame(asked, "item_id long, text string"))) == plain(docs, asked)


def test_sql_ranks_alike(spark, sf):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    names = "item_id, rank, doc_id, score"
    found = [tuple(r) for r in op12_lexical(spark, sf).select(*names.split(", ")).collect()]
    assert sorted(found) == sorted(con.sql(f"select {names} from ({OP12_SQL})").fetchall())
