"""Language identification by hyperdimensional profiles.

Each letter has a random vector of ``DIMENSIONS`` signs. An n-gram binds the vectors of its letters, each permuted
(rotated) by its place: r2(a) * r1(b) * r0(c). A text bundles (adds) the vectors of its n-grams, as often as they
stand in it. A language's prototype bundles the unit vectors of its texts, so long texts weigh no more than short
ones. A text is given the language whose prototype has the largest cosine with it; ties go to the smaller name.

Letters are lower-cased; runs of anything else are one gap, which is a letter of its own, and a text begins and
ends with a gap. Letters from U+0800 on share half of the vectors by hash, so the table has one size. Texts are
cut into stretches of at most ``STRETCH`` n-grams (each n-gram lies in one), whose bundles add up exactly: all
sums are whole numbers, so neither the cut nor the order of rows changes a prototype. What is learned is one
vector per language, summed with partial sums; up to ``MOST`` languages are taken, more are an error.

Defined results: a null text or one without letters is ``und`` with score 0, and teaches nothing; so is every text
if nothing was learned; a null ``lang`` is not learned; a null doc_id has no remainder, so its row is neither held
out nor learned; repeated rows count each time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, mix, stage, texts

DIMENSIONS = 1024
SIZE = 3  # letters of an n-gram
SLOTS = 4096  # letter vectors; slot 0 is the gap
OWN = 2048  # letters below have a vector of their own
STRETCH = 1 << 18
TOGETHER = 64  # texts that are bundled by one product
UNIT = 1 << 20  # unit vectors are added in whole steps of 2^-20
MOST = 20_000


def letter_vectors(dimensions: int = DIMENSIONS, slots: int = SLOTS) -> np.ndarray:
    """One row of signs per letter slot, from a hash of slot and place."""
    words = np.arange(slots * (dimensions // 64), dtype=np.uint64) + np.uint64(1)
    bits = np.unpackbits(mix(words * np.uint64(0x9E3779B97F4A7C15)).astype("<u8").view(np.uint8))
    return (bits.reshape(slots, dimensions).astype(np.int8) << 1) - 1


class Profiles:
    """Bundles of texts. ``slot_of`` remembers each code point's letter slot (0: gap, 65535: not yet asked)."""

    def __init__(self, size: int = SIZE):
        base = letter_vectors()
        self.size = size
        self.places = [np.roll(base, size - 1 - k, axis=1) for k in range(size)]  # by place in the n-gram
        self.slot_of = np.full(0x110000, 0xFFFF, np.uint16)

    def slots(self, text: str) -> np.ndarray:
        """Letter slots of a text with one gap at both ends and between words; only gaps where it has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.slot_of[points]
        if (found == 0xFFFF).any():
            for p in np.unique(points[found == 0xFFFF]).tolist():
                own = p if p < OWN else OWN + int(mix(np.array([p], np.uint64))[0] % np.uint64(SLOTS - OWN))
                self.slot_of[p] = own if chr(p).isalpha() else 0
            found = self.slot_of[points]
        found = np.concatenate([np.zeros(1, np.uint16), found, np.zeros(1, np.uint16)])
        return found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]

    def stretches(self, found: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        """Groups of (place of the text, its n-gram codes) for one product each."""
        owners, grams, held = [], [], 0
        for at, text in enumerate(found):
            slots = self.slots(text).astype(np.int64) if text else np.zeros(1, np.int64)
            if not slots.any():
                continue
            n = len(slots) - self.size + 1
            for begin in range(0, n, STRETCH):
                part = slots[begin:begin + STRETCH + self.size - 1]
                code = np.zeros(len(part) - self.size + 1, np.int64)
                for k in range(self.size):
                    code = code * SLOTS + part[k:len(part) - self.size + 1 + k]
                owners.append(at)
                grams.append(code)
                held += len(code)
                if len(owners) == TOGETHER or held >= STRETCH:
                    yield owners, grams
                    owners, grams, held = [], [], 0
        if owners:
            yield owners, grams

    def bundles(self, found: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the n-gram vectors, whether it has a letter) of each text."""
        out, lettered = np.zeros((len(found), DIMENSIONS), np.int64), np.zeros(len(found), bool)
        for owners, grams in self.stretches(found):
            lettered[owners] = True
            kinds, which = np.unique(np.concatenate(grams), return_inverse=True)
            row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
            order = np.argsort(which, kind="stable")
            row, which = row[order], which[order]
            for begin in range(0, len(kinds), 4096):  # products of bounded size; below 2^24, so floats are exact
                lo, hi = np.searchsorted(which, [begin, begin + 4096])
                width = min(4096, len(kinds) - begin)
                counts = np.bincount(row[lo:hi] * width + which[lo:hi] - begin, minlength=len(grams) * width)
                part = kinds[begin:begin + width]
                vectors = self.places[self.size - 1][part % SLOTS]
                for k in range(1, self.size):
                    vectors = vectors * self.places[self.size - 1 - k][part // SLOTS ** k % SLOTS]
                sums = counts.reshape(len(grams), width).astype(np.float32) @ vectors.astype(np.float32)
                np.add.at(out, owners, np.rint(sums).astype(np.int64))
        return out, lettered


_PROFILES: dict[int, Profiles] = {}


def profiles() -> Profiles:
    """One table of letter vectors per worker process (about 20 MB)."""
    if not _PROFILES:
        _PROFILES[0] = Profiles()
    return _PROFILES[0]


def unit(sums: np.ndarray) -> np.ndarray:
    length = np.sqrt((sums.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return sums / np.where(length > 0, length, 1.0)


def decoded(found: list[bytes | None]) -> list[str | None]:
    return [None if t is None else t.decode("utf-8", "replace") for t in found]


def prototypes(docs: DataFrame) -> DataFrame:
    """(lang, place, total): the bundled unit vectors of ``docs(lang, text)``, in steps of 2^-20."""

    def learn(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            if held:
                names = list(held)
                yield pa.record_batch([
                    pa.array([n.decode() for n in names for _ in range(DIMENSIONS)]),
                    pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(names))),
                    pa.array(np.concatenate([held[n] for n in names]))], ["lang", "place", "total"])
                held.clear()

        for langs, found in texts(batches, "lang", "text"):
            sums, lettered = profiles().bundles(decoded(found))
            steps = np.rint(unit(sums) * UNIT).astype(np.int64)
            for at in np.flatnonzero(lettered).tolist():
                name = langs[at]
                if name not in held and len(held) >= 256:
                    yield from flush()
                held[name] = held[name] + steps[at] if name in held else steps[at]
        yield from flush()

    rows = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(learn, "lang string, place int, total long").groupBy("lang", "place").agg(F.sum("total").alias("total"))


def fitted(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and unit prototypes of the languages of ``docs``, in the order of their names."""
    sums = stage(prototypes(docs), "prototypes")
    count = sums.select("lang").distinct().count()
    if count > MOST:
        raise ValueError(f"{count} languages; at most {MOST} can be told apart")
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "total"))).alias("v")) \
        .select("lang", F.transform("v", lambda x: x["total"]).alias("v")).collect()  # one row per language
    found = sorted((r["lang"].encode(), r["lang"], r["v"]) for r in rows)
    return [n for _, n, _ in found], unit(np.array([v for _, _, v in found], np.float64).reshape(len(found), DIMENSIONS))


def identify(docs: DataFrame, names: list[str], vectors: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score of ``docs(doc_id, held_out, text)``."""

    def predict(batches):
        for batch in batches:
            (found,) = next(texts(iter([batch]), "text"))
            sums, lettered = profiles().bundles(decoded(found))
            best, score = np.zeros(len(found), int), np.zeros(len(found))
            if names and len(found):
                near = np.round(unit(sums) @ vectors.T, 9)
                best = near.argmax(axis=1)  # the first of equals has the smallest name
                score = np.clip(near[np.arange(len(found)), best], 0.0, 1.0)
            told = lettered & bool(names)
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array([names[b] if t else "und" for b, t in zip(best, told)], pa.string()),
                pa.array(np.where(told, np.round(score, 6), 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")


def predicted(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Learn from the rows whose crc32 of doc_id leaves another remainder than ``held``, predict all rows."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == held, F.lit(False)).alias("held_out"),
                       (fold != held).alias("learned"), "lang", F.col("text").cast("string").alias("text"))
    names, vectors = fitted(rows.where("learned").select("lang", "text"))
    return identify(rows, names, vectors)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(documents(spark, sf_dir))


QUERIES = {"op11_language": op11_language}
ORACLES: dict[str, str] = {}
