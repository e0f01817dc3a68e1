"""Language profiles against binding and bundling letter by letter, and on held-out documents."""

import math
import zlib

import numpy as np
import pytest
from sparkloom.llm import language
from sparkloom.llm.language import DIMENSIONS, OWN, SLOTS, UNIT, Profiles, letter_vectors, op11_language, predicted

VECTORS = letter_vectors().astype(np.int64)


def letters(text):
    """Letter slots with single gaps, by plain rules."""
    out = [0]
    for c in text.lower():
        slot = 0
        if c.isalpha():
            slot = ord(c) if ord(c) < OWN else OWN + int(language.mix(np.array([ord(c)], np.uint64))[0]) % (SLOTS - OWN)
        if slot or out[-1]:
            out.append(slot)
    return out + ([0] if out[-1] else [])


def bundle(text):
    slots, out = letters(text), np.zeros(DIMENSIONS, np.int64)
    for a, b, c in zip(slots, slots[1:], slots[2:]):
        out += np.roll(VECTORS[a], 2) * np.roll(VECTORS[b], 1) * VECTORS[c]
    return out


def has_letter(text):
    return text is not None and any(c.isalpha() for c in text)


def unit(v):
    length = math.sqrt(float((v.astype(float) ** 2).sum()))
    return v / length if length else v.astype(float)


def plain(rows):
    """[(doc_id, held_out, lang_pred, score)] from (doc_id, lang, text)."""
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 3
    sums = {}
    for d, lang, text in rows:
        if fold(d) in (0, 2) and lang is not None and has_letter(text):
            sums[lang] = sums.get(lang, 0) + np.rint(unit(bundle(text)) * UNIT).astype(np.int64)
    names = sorted(sums, key=str.encode)
    protos = [unit(sums[n]) for n in names]
    out = []
    for d, _, text in rows:
        if not names or not has_letter(text):
            out.append((d, fold(d) == 1, "und", 0.0))
            continue
        near = [round(float(unit(bundle(text)) @ p), 9) for p in protos]
        best = max(range(len(names)), key=lambda i: (near[i], -i))
        out.append((d, fold(d) == 1, names[best], min(max(near[best], 0.0), 1.0)))
    return out


def compared(found, wanted):
    key = lambda r: (str(r[0]), r[2], round(r[3], 3))
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [r[:3] for r in found] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in found], [r[3] for r in wanted], atol=2e-6)


def test_hard_rows(hard):
    rows = [(r.doc_id, r.lang, r.text) for r in hard.collect()]
    compared(predicted(hard).collect(), plain(rows))


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    compared(op11_language(spark, sf).collect(), plain(rows))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in op11_language(spark, folder).collect() if r.held_out]
    assert len(found) > 200
    assert sum(docs[r.doc_id] == r.lang_pred for r in found) / len(found) > 0.98


def test_partitions_and_stretches_do_not_matter(hard, monkeypatch):
    wanted = sorted(map(tuple, predicted(hard).collect()), key=str)
    monkeypatch.setattr(language, "STRETCH", 1000)
    monkeypatch.setattr(language, "TOGETHER", 3)
    texts = [r.text for r in hard.select("text").collect()]
    sums, lettered = Profiles().bundles(texts)
    for text, row, told in zip(texts, sums, lettered):
        assert told == has_letter(text)
        assert (row == (bundle(text) if has_letter(text) else 0)).all()
    assert sorted(map(tuple, predicted(hard.repartition(11)).collect()), key=str) == wanted


def test_nothing_learned_and_empty(spark, make):
    bare = make([(1, "some text", None, "a"), (2, "more", None, "a"), (3, None, "en", "a")])
    assert {(r.lang_pred, r.score) for r in predicted(bare).collect()} == {("und", 0.0)}
    assert predicted(bare.where("doc_id < 0")).collect() == []


def test_equal_languages_take_the_smaller_name(make):
    learned = [d for d in range(50) if zlib.crc32(str(d).encode()) % 3 != 1][:4]
    rows = [(learned[0], "the same text", "zz", "a"), (learned[1], "the same text", "aa", "a"),
            (learned[2], "another text", "\U0001f600", "a"), (learned[3], "another text", "￿", "a")]
    found = {r.doc_id: r.lang_pred for r in predicted(make(rows)).collect()}
    assert found == {learned[0]: "aa", learned[1]: "aa", learned[2]: "￿", learned[3]: "￿"}


@pytest.mark.parametrize("text", ["123 !?", "", None, "　"])
def test_without_letters(make, text):
    learned = next(d for d in range(50) if zlib.crc32(str(d).encode()) % 3 != 1)
    rows = predicted(make([(learned, "words", "en", "a"), (1000, text, "en", "a")])).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in rows}[1000] == ("und", 0.0)
