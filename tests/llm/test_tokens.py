"""Encoding, the token file and packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkloom.llm import packing as P
from sparkloom.llm import token_file as T
from sparkloom.llm.tokens import default_tokenizer, encoder
from sparkloom.session import scratch_path


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_whole_text(plain, texts):
    e = encoder(default_tokenizer())
    r = random.Random(1)
    signs = list("aBcé ÉßÆ'st\n\t\x1c\x85\xa0.,!#0９Σσİ́K漢ÿ÷ªµ_-") + ["'s", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", " ", " "]
    for text in [t for _, t in texts[:60]] + ["".join(r.choices(signs, k=r.randint(0, 14))) for _ in range(3000)]:
        assert np.frombuffer(e.ids(text.encode()), e.dtype).tolist() == plain(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_capitals_with_combining_marks():
    e = encoder(default_tokenizer())
    for word in ("J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "Ma\u0308RZ", "\u00c9COLE", "\u00c4rger,"):
        text = f"See {word} and x{word}Y HERE"
        assert e.ids(text.encode()) == e.whole(text)


def test_round_trip(spark, hard, plain):
    path = scratch_path(spark, "test-tokens")
    T.write_tokens(hard, path)
    got = T.read_tokens(spark, path, with_ids=True).collect()
    rows = hard.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (r.doc_id is not None, r.doc_id or 0, len(i), crc(i)) for r in rows for i in [plain(r.text) + [1]])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(
        (r.doc_id for r in rows), key=lambda d: (d is not None, d or 0))
    for doc in (3, 8, 10, 11, 19):
        assert [x.tolist() for x in T.read_document(spark, path, doc)] == [plain(r.text) + [1] for r in rows if r.doc_id == doc]
    assert T.read_document(spark, path, 999) == []


def test_one_document_opens_its_blocks_only(spark, monkeypatch):
    path = scratch_path(spark, "tokens")
    docs = spark.range(60).selectExpr("IF(id < 4, NULL, id - id % 15 div 14) AS doc_id", "concat('word ', id) AS text")
    T.write_tokens(docs.coalesce(1), path, block_docs=3)
    spans = [(r.first_doc, r.last_doc) for r in spark.read.parquet(f"{path}/blocks").collect()]
    assert len(spans) >= 20 and any(first is None for first, _ in spans)
    opened, plain = [], T.Block
    monkeypatch.setattr(T, "Block", lambda *given: opened.append(1) or plain(*given))
    held = [r.doc_id for r in docs.collect()]
    for doc in (4, *[first for first, _ in spans if first is not None][:3], 13, 14, 59, 99):
        opened.clear()
        assert len(T.read_document(spark, path, doc)) == held.count(doc)
        assert len(opened) == sum(last is not None and (first is None or first <= doc) and doc <= last for first, last in spans)
        assert len(opened) <= 2


def test_a_block_names_its_dictionary():
    block = T.pack_block([(7, 2, T._tools(b"")[0].compress(np.array([5, 1], "<u2").tobytes()))], 2, T._key(b""))
    assert T.Block(block, b"").ids(0).tolist() == [5, 1]
    with pytest.raises(ValueError):
        T.Block(block, b"other")


def test_empty_table(spark, make):
    path = scratch_path(spark, "test-none")
    T.write_tokens(make([]).limit(0), path)
    assert T.read_tokens(spark, path).collect() == []
    assert P.pack(make([]).limit(0)).collect() == []


def check_pieces(pieces, rows, plain, capacity=4096):
    want = defaultdict(list)
    for r in rows:
        want[r.doc_id].append(plain(r.text) + [2])
    windows, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for d, lists in want.items():
        expected = sorted(len(i) for i in lists)
        assert sum(n for _, n, _, _ in parts[d]) == sum(expected)
        if len({tuple(i) for i in lists}) == 1:
            for start, n, check, total in parts[d]:
                assert total == len(lists[0]) and check == crc(lists[0][start:start + n])
            covered = sorted((s, n) for s, n, _, _ in parts[d])
            assert sorted(x for s, n in covered for x in range(s, s + n)) == sorted(list(range(len(lists[0]))) * len(lists))
    for placed in windows.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
    assert sorted(windows) == list(range(len(windows)))
    return sum(capacity - sum(n for _, n in w) for w in windows.values())


def test_packing(hard, plain):
    rows = hard.collect()
    padding = check_pieces(P.pack(hard).collect(), rows, plain)
    total = sum(len(plain(r.text)) + 1 for r in rows)
    assert padding < 4096 + 16 * (total // 4096 + 1)
    joined = P.sequences(P.pack(hard, with_ids=True)).collect()
    assert sum(len(r.ids) // 4 for r in joined) == total and all(len(r.ids) == 4 * r.length for r in joined)


def test_closest_multiset_is_the_best_sum():
    r = random.Random(3)
    for _ in range(200):
        counts = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(1, 5))}
        space = r.randint(1, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= space}
        filled, take = P.closest_multiset(counts, space)
        assert filled == max(sums) == sum(k * n for k, n in take.items())
        assert all(n <= counts[k] for k, n in take.items())


def test_plan_places_every_remainder_once():
    r = random.Random(4)
    for _ in range(60):
        counts = {r.randint(1, 99): r.randint(1, 50) for _ in range(r.randint(1, 12))}
        plan, windows = P.plan_windows(counts, 100, tolerance=2)
        covered, filled = defaultdict(list), defaultdict(list)
        for first, rank, n, before, length, window, per, slot, at in plan.tolist():
            for i in range(n):
                covered[first, rank + i].append((before, length))
                j = slot + i
                filled[window + j // per].append((at + j % per * length, length))
        assert set(covered) == {(k, i) for k, n in counts.items() for i in range(n)}
        for (first, _), pieces in covered.items():
            assert [x for b, n in sorted(pieces) for x in range(b, b + n)] == list(range(first))
        assert set(filled) == set(range(windows))
        for pieces in filled.values():
            assert [x for a, n in sorted(pieces) for x in range(a, a + n)] == list(range(sum(n for _, n in pieces)))
            assert sum(n for _, n in pieces) <= 100
