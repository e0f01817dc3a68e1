"""Targets, nested limits and the mixed corpus."""

import re

import duckdb
import pytest

from sparkloom.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Shares again and again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()) * share, {}
    while True:
        rest = [s for s in order if s not in fixed]
        left, by = total - sum(fixed.values()), sum(weight[s] for s in rest)
        above = [s for s in rest if left * weight[s] / by > most * sizes[s]]
        if not above:
            return {**fixed, **{s: left * weight[s] / by for s in rest}}
        fixed.update({s: most * sizes[s] for s in above})


def test_hard_rows(hard):
    rows = hard.collect()
    size = lambda t: len(WORD.findall(t or ""))
    sums = {}
    for r in rows:
        sums[r.source] = sums.get(r.source, 0) + size(r.text)
    want = plain_targets(sums)
    by_id = {}
    for r in rows:
        by_id.setdefault((r.doc_id, size(r.text)), []).append(r.source)
    got = M.mix_sizes(hard).collect()
    assert len(got) == len(rows)
    taken = {}
    for g in got:
        source = next(s for s in by_id[g.doc_id, g.size] if sums[s] == g.source_size)
        assert g.target == pytest.approx(want[source])
        assert 0 <= g.taken <= 2 * g.size
        taken[source] = taken.get(source, 0) + g.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 2
    assert sorted(map(tuple, M.mix_sizes(hard).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mixed_corpus_meets_the_targets(hard):
    """Every text is whole, as often as its row allows, and a source misses its target by half a text at most."""
    mixed = M.mix(hard)
    assert mixed.columns == hard.columns
    rows, size = hard.collect(), lambda t: len(WORD.findall(t or ""))
    sums, given, largest = {}, {}, {}
    for r in rows:
        sums[r.source] = sums.get(r.source, 0) + size(r.text)
        given[tuple(r)] = given.get(tuple(r), 0) + 1
        largest[r.source] = max(largest.get(r.source, 0), size(r.text) * given[tuple(r)])
    want, words, times = plain_targets(sums), dict.fromkeys(sums, 0), {}
    for r in mixed.collect():
        words[r.source] += size(r.text)
        times[tuple(r)] = times.get(tuple(r), 0) + 1
    assert all(n <= 2 * given[r] for r, n in times.items())
    for s, n in words.items():
        assert abs(n - want[s]) <= largest[s] / 2 + 1


def test_rows_without_ids_are_told_apart(make):
    """A third of a source has no id: its texts are drawn one by one, not all or none."""
    rows = [(None if i % 3 else i, f"w{i} " * 10, "en", "ab"[i % 2]) for i in range(600)]
    words = {"a": 0, "b": 0}
    for r in M.mix(make(rows)).collect():
        words[r.source] += len(WORD.findall(r.text))
        assert len(WORD.findall(r.text)) == 10
    want = plain_targets({"a": 3000, "b": 3000})
    assert all(abs(words[s] - want[s]) <= 6 for s in words)


def test_budgets_nest(hard):
    small = {r.doc_id: r.taken for r in M.mix_sizes(hard, share=0.5).collect()}
    large = {r.doc_id: r.taken for r in M.mix_sizes(hard, share=0.9).collect()}
    assert all(large[d] >= n for d, n in small.items())


def test_empty_and_wordless(make):
    assert M.mix_sizes(make([]).limit(0)).collect() == []
    got = M.mix_sizes(make([(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in got} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_query_agrees_with_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(con.execute(f"select {', '.join(names)} from ({M.OP1_SQL})").fetchall())
    assert sorted(tuple(r) for r in M.op1_mix(spark, sf).select(*names).collect()) == want
