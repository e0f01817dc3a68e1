"""License scan, quality rules, repeated passages and near duplicates against plain versions."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from samples import prose

from sparkloom.llm import licenses as L
from sparkloom.llm import near_dedup as N
from sparkloom.llm import quality_rules as Q
from sparkloom.llm import repeats as R
from sparkloom.llm.common import components, stage

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- licenses

def plain_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    at = [(i, label) for p, label in L.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


def test_licenses(spark, hard, make, sf):
    for df in (hard, spark.read.parquet(f"{sf}/documents.parquet")):
        got = sorted((tuple(r)[:6] for r in L.scan_licenses(df).collect()), key=str)
        assert got == sorted(((r.doc_id, *plain_license(r.text)) for r in df.select("doc_id", "text").collect()), key=str)
    full = dict((t[0], t[2]) for t in L.TEMPLATES)
    gap = full["apache-2.0"].replace("may not", "may (really) not").replace("compliance", "full compliance").upper()
    docs = make([(1, prose(1, 50) + "\n" + gap, "en", "a"), (2, "the license of the file " * 30, "en", "a"),
                 (3, full["mit-text"], "en", "a"), (4, "version 2 0 license apache the under licensed", "en", "a")])
    got = {r.doc_id: r for r in L.scan_licenses(docs).collect()}
    assert got[1].labels == "apache,apache-2.0,apache-2.0-notice" and got[1].score > 0.9
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "mit-text" and got[3].score == 1
    assert "apache-2.0" not in got[4].labels
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got.values())
    assert L.scan_licenses(make([]).limit(0)).collect() == []


def plain_labels(index, words, apart=4):
    """Labels of the templates whose words stand within ``apart`` differences of each other, by looking everywhere."""
    found = set()
    for t, template in enumerate(index.words):
        for low in range(-len(template), len(words)):
            held = sum(index.idf[w] for i, w in enumerate(template) if w in words[max(0, low + i):max(0, low + i + apart + 1)])
            part = b" " + b" ".join(words[max(0, low):max(0, low + apart + len(template))]) + b" "
            if held >= index.needed * index.total[t] and any(b" " + b" ".join(p) + b" " in part for p in index.phrases[t]):
                found.add(index.labels[t])
    return found


def test_licenses_beside_each_other(make):
    full = {t[0]: t[2] for t in L.TEMPLATES}
    r = random.Random(4)
    files = [" ".join(full.values()), f"{full['mit-text']} {prose(1, 30)} {full['apache-2.0-notice']}",
             f"{full['mit-notice']} {prose(2, 30)} {full['mit-text']}"]
    for i in range(12):
        files.append(f" {prose(i, 15)} ".join(" ".join(w for w in full[x].split() if r.random() > 0.03)
                                             for x in r.sample(sorted(full), r.randint(2, 6))))
    short = [full[x] for x in ("apache-2.0-notice", "mit-notice", "gpl-3.0", "cc-by-4.0")] * 15
    rows = [(i, x, "en", "a") for i, x in enumerate(files + short + [prose(i, 40) for i in range(60)])]
    docs = make(rows)
    n, seen = L.seen_in(docs.select("text"), set(L.Index(L.TEMPLATES).postings))
    index = L.Index(L.TEMPLATES, n, seen)
    got = {r.doc_id: set(filter(None, r.labels.split(","))) - set(L.BASE.values()) for r in L.scan_licenses(docs).collect()}
    want = [plain_labels(index, L.words_of(x.encode())) for x in files]
    assert want[0] == set(full) and want[1] == {"mit-text", "apache-2.0-notice"} and want[2] == {"mit-text", "mit-notice"}
    assert [got[i] for i in range(len(files))] == want


# ---- quality rules

def plain_counts(text):
    words = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if often[run] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_counts_and_base_rule(spark, hard, sf):
    for df in (hard, spark.read.parquet(f"{sf}/documents.parquet")):
        got = Q.judged(stage(Q.measured(df), "test")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                            "n_repeat_words", "base_failed", "kept").collect()
        want = []
        for r in df.select("doc_id", "text").collect():
            c = plain_counts(r.text)
            want.append((r.doc_id, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
        assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
        assert not any(r.base_failed and r.kept for r in got)


def test_limits_follow_the_group(make):
    rows = [(i, prose(i, 60), "en", "plain") for i in range(250)]
    rows += [(1000 + i, " ".join(w + "#" for w in prose(i, 60).split()), "en", "tags") for i in range(250)]
    rows += [(2000, " ".join(w + "#" for w in prose(7, 60).split()), "en", "plain"), (2001, prose(8, 60), "en", "rare")]
    got = {r.doc_id: r.kept for r in Q.judged(stage(Q.measured(make(rows)), "test")).collect()}
    assert not got[2000] and got[2001]
    assert all(got[i] for i in range(250)) and all(got[1000 + i] for i in range(250))
    assert Q.judged(stage(Q.measured(make([]).limit(0)), "test")).collect() == []


def test_quality_query_agrees_with_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    df = Q.op9_quality_rules(spark, sf)
    want = con.execute(f"select {', '.join(df.columns)} from ({Q.OP9_SQL})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


# ---- repeated passages

def plain_repeats(rows):
    """{(doc_id, text)} -> result, by a set of all strings of 50 bytes of documents with smaller ids."""
    order = sorted({(d is None, d or 0, (t or "").encode()) for d, t in rows})
    seen, out, waiting, last = set(), {}, [], None
    for none, d, b in order:
        if (none, d) != last:
            for w in waiting:
                seen.update(w[i:i + 50] for i in range(len(w) - 49))
            waiting, last = [], (none, d)
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 49):
            if b[i:i + 50] in seen:
                edge[i] += 1
                edge[i + 50] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[None if none else d, b] = (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
        waiting.append(b)
    return out


@pytest.mark.parametrize("many", [4096, 1])
def test_repeats(spark, hard, make, many, monkeypatch):
    monkeypatch.setattr(R, "MANY", many)
    passage, other = prose(20, 12), prose(21, 30)
    extra = make([(100, "ab" * 300, "en", "a"), (101, "x" + "ab" * 100 + "y", "en", "a"), (102, passage, "en", "a"),
                  (103, "head " + passage[5:60] + " tail " + other, "en", "a"), (104, other[:49] + "|" + other[50:], "en", "a"),
                  (104, passage + other, "en", "a"), (105, "\x00" * 120, "en", "a"), (106, "\x00" * 60 + "é" * 60, "en", "a"),
                  (107, "a" * 200 + "b" + "a" * 200, "en", "a")])
    df = hard.unionAll(extra)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = plain_repeats(rows)
    got = sorted((tuple(r) for r in R.remove_repeats(df).collect()), key=str)
    assert got == sorted(((d, *want[d, (t or "").encode()]) for d, t in rows), key=str)


def test_repeats_over_documents(spark, sf, texts):
    want = plain_repeats(texts)
    got = {r.doc_id: tuple(r)[1:] for r in R.op8_repeats(spark, sf).collect()}
    assert got == {d: want[d, t.encode()] for d, t in texts}


def test_repeats_of_mixed_pieces(make):
    r = random.Random(11)
    pool = ["".join(r.choices(a, k=n)) for a, n in zip(["ab", "abc", "abcdefgh", "0123456789abcdef"] * 8, range(4, 68, 2))]
    rows = [(i // 2, "".join(r.choice(pool) for _ in range(r.randint(1, 30))), "en", "a") for i in range(150)]
    want = plain_repeats([row[:2] for row in rows])
    got = sorted(tuple(row) for row in R.remove_repeats(make(rows)).collect())
    assert got == sorted((d, *want[d, t.encode()]) for d, t, _, _ in rows)


def test_repeats_write_only_what_has_to_be_compared(make, monkeypatch):
    """Texts with common phrases that share no window, and copies of whole passages: neither is written as contexts."""
    r, written = random.Random(12), {}

    def kept(df, name):
        out = stage(df, name)
        written[name] = (out.count(), sum(os.path.getsize(f.removeprefix("file:")) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(R, "stage", kept)
    some = lambda n: "".join(r.choices("0123456789abcdef", k=n))
    passage = some(3000)
    rows = [(i, "".join(some(40) + " a common phrase of words " for _ in range(40)) + some(2000) + passage, "en", "a") for i in range(100)]
    got = sorted(tuple(row)[:3] for row in R.remove_repeats(make(rows)).collect())
    assert got[0] == (0, len(rows[0][1]), 0) and all(3000 <= x[2] < 3010 for x in got[1:])
    size = sum(len(row[1]) for row in rows)
    assert sum(b for name, (_, b) in written.items() if name != "texts") < size / 4, written


def test_judge_sends_only_what_may_meet():
    h, key = np.array([1, 1, 1, 2, 2, 3, 3, 4], np.uint32), np.array([5, 5, 6, 7, 8, 9, 10, 11], np.uint64)
    left, right = np.array([3, 3, 3, 4, 5, R.ANY, 0, 1], np.uint16), np.array([0, 0, 0, 6, 7, R.ANY, 9, 1], np.uint16)
    d = np.array([2, 9, 4, 1, 2, 1, 2, 1], np.int64)
    assert R.judge(h, key, left, right, d).tolist() == [2, 1, 2, 0, 0, 2, 2, 0]
    assert R.judge(h, key, left, right, np.ones(8, np.int64)).tolist() == [0] * 8


def test_no_repeats_in_nothing(make):
    assert R.remove_repeats(make([]).limit(0)).collect() == []
    assert [tuple(r)[:4] for r in R.remove_repeats(make([(1, None, "en", "a")])).collect()] == [(1, 0, 0, 0)]


def test_suffix_array_sorts():
    r = random.Random(6)
    for alphabet in (b"ab", b"abcdefgh", bytes(range(256))):
        for _ in range(20):
            data = bytes(r.choices(alphabet, k=r.randint(1, 400)))
            t = np.frombuffer(data, np.uint8)
            padded = np.concatenate([t, np.zeros(72, np.uint8)]).astype(np.uint64)
            words = np.zeros(len(t) + 64, np.uint64)
            for k in range(8):
                words |= padded[k:k + len(words)] << np.uint64(56 - 8 * k)
            order = R.suffix_array(t, words).tolist()
            assert sorted(order) == list(range(len(data)))
            heads = [data[i:i + 50] for i in order if i + 50 <= len(data)]
            assert heads == sorted(heads)


# ---- near duplicates

def plain_groups(rows):
    sets = []
    for _, text in rows:
        w = SPACED.findall(lowered(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    low = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return [(d, len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def test_groups(spark, hard, make, sf):
    r = random.Random(9)
    words = prose(30, 200).split()
    chain = []
    for i in range(40):  # each text near the one before, the ends far apart
        words[r.randrange(200)] = f"new{i}"
        words[r.randrange(200)] = f"other{i}"
        chain.append((500 + i, " ".join(words), "en", "a"))
    hub = prose(31, 100).split()
    star = []
    for i in range(60):
        w = list(hub)
        for _ in range(3):
            w[r.randrange(100)] = f"s{i}"
        star.append((700 + i, " ".join(w), "en", "a"))
    for df in (hard.unionAll(make(chain + star)), spark.read.parquet(f"{sf}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = N.near_duplicates(df).collect()
        assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(plain_groups(rows), key=str)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert N.near_duplicates(make([]).limit(0)).collect() == []


def test_stage_keeps_one_row_of_each_group(spark, make):
    one, two, three = prose(1, 80), prose(2, 80), prose(3, 80)
    near = " ".join(["changed", *one.split()[1:]])
    docs = make([(None, one, "en", "a"), (4, one, "en", "a"), (None, near, "en", "a"), (4, near, "en", "b"),
                 (None, two, "en", "a"), (None, two, "en", "b"), (7, three, "en", "a"), (7, three, "en", "a"),
                 (7, two + " " + three, "en", "a"), (None, "", "en", "a"), (None, None, "en", "a"), (8, "", "en", "a")])
    got = sorted(((r.doc_id, r.text) for r in N.dedup_stage(spark, docs, "").collect()), key=str)
    kept = min(one, near, key=lambda x: hashlib.md5(x.encode()).digest())
    want = [(4, kept), (None, two), (7, three), (7, two + " " + three), (None, ""), (None, None), (8, "")]
    assert got == sorted(want, key=str)
    assert N.dedup_stage(spark, docs, "").columns == docs.columns


def test_signatures_are_superminhash():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 3, 40, 400, 5000)]
    together = N.signatures(sets)
    for s, row in zip(sets, together):
        assert (N.signatures([s])[0] == row).all()  # a set's signature does not depend on its neighbours
        assert sorted(np.unique(N.signatures([s[:1]])[0] >> 24)) == list(range(N.SLOTS))  # one rank of each step
    a = np.unique(r.integers(0, 1 << 63, 3000, dtype=np.uint64))
    for share in (0.3, 0.75, 0.9):
        n = int(3000 * share)
        b = np.concatenate([a[:n], r.integers(0, 1 << 63, 3000 - n, dtype=np.uint64)])
        x = N.signatures([a, np.unique(b)])
        true = n / (6000 - n)
        assert abs((x[0] == x[1]).mean() - true) < 0.15


def test_components(spark):
    r = random.Random(11)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(30)]
    edges += [(None, 5), (5, None), (300, 300)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert {x.node: x.root for x in got} == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
