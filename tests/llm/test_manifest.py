"""The Merkle manifest against a plain tree over sorted lists."""

import hashlib
import random
import zlib

import pytest
from sparkloom.llm.manifest import fold, levels_of, manifest as build, op13_manifest, path_of, reduced

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SMALL = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    for nodes in tree[:-1]:
        begin = i - i % 8
        yield "".join(nodes[begin:i]), "".join(nodes[i + 1:begin + 8])
        i //= 8


def plain(rows):
    """(doc_id, source, lang, n_chars, text) rows -> the rows of the manifest."""
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = other = digest("".join(map(field, (doc_id, source, lang, n_chars, text))))
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            other = digest("".join(map(field, (doc_id, source, lang, n_chars, text.translate(LOW)))))
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, other))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = levels([r[2] for r in groups[name]])
    top = levels([trees[n][-1][0] for n in names]) if names else None
    out = []
    for k, name in enumerate(names):
        for i, (_, _, leaf, doc_id, node) in enumerate(groups[name]):
            path = [*siblings(trees[name], i), *siblings(top, k)]
            for left, right in path:
                node = digest(left + node + right)
            out.append((doc_id, leaf, trees[name][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(out, key=lambda r: [str(x) for x in r])


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: [str(x) for x in r])


def given(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_table(spark, sf):
    assert rows_of(op13_manifest(spark, sf)) == plain(given(spark.read.parquet(f"{sf}/documents.parquet")))


def test_hard_rows(hard):
    found = rows_of(build(hard))
    assert found == plain(given(hard))
    assert len(found) == hard.count()


@pytest.mark.parametrize("partitions", [1, 7])
def test_repeated_and_missing_ids(spark, partitions):
    r = random.Random(5)
    rows = []
    for _ in range(900):
        doc_id = r.choice([None, r.randint(-70_000, 70_000), r.randint(0, 40), r.randint(-2 ** 62, 2 ** 62)])
        rows.append((doc_id, r.choice(["a", None]), r.choice(["en"] * 6 + ["é", "z", "", None]), r.choice([None, 3]),
                     r.choice(["Aa", "b", None, "", "É B"])))
    rows += [(7, "s", "en", 1, "same Row")] * 300 + [(None, None, None, None, None)] * 200
    df = spark.createDataFrame(rows, SMALL).repartition(partitions)
    assert rows_of(build(df)) == plain(rows)


def test_several_arrays_of_leaves_and_of_groups(spark):
    """More than 4,096 leaves in a group, and more than 4,096 groups: two rounds each."""
    rows = [(i * 37 % 100_003, "s", "en", 1, f"Text {i}") for i in range(9000)] + [(5, "s", "en", 1, "copy")] * 4200
    rows += [(i, "s", f"l{i}", 1, f"Text {i}") for i in range(4300)]
    assert rows_of(build(spark.createDataFrame(rows, SMALL))) == plain(rows)


def test_one_row_and_none(spark):
    one = [(3, "s", "en", 2, "ab")]
    found = rows_of(build(spark.createDataFrame(one, SMALL)))
    assert found == plain(one)
    assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == digest("")
    empty = build(spark.createDataFrame([], SMALL))
    assert empty.columns == COLUMNS and empty.collect() == []


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 3, "ABC" if i % 2 else "abc") for i in range(60)]
    for r in build(spark.createDataFrame(rows, SMALL)).collect():
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["doc_id"] % 2 == 1
        assert r["verified"] == (not hit)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513, 4096])
def test_paths_fold_to_the_last_node(n):
    tree = reduced([digest(str(i)) for i in range(n)], levels_of(n))
    assert len(tree[-1]) == 1
    for i in {0, n // 2, n - 1}:
        assert fold(tree[0][i], path_of(tree, i)) == tree[-1][0]


def test_long_text(spark):
    rows = [(1, "s", "en", None, "Ab " * 1_000_000), (3, "s", "en", None, "Ab " * 1_000_001)]
    assert rows_of(build(spark.createDataFrame(rows, SMALL))) == plain(rows)
