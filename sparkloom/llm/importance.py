"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target text (labelled good) and one of raw text (all
documents), give each document the log ratio of its chances. Documents are drawn without replacement in
proportion to that ratio by Gumbel top-k: a document's key is its log ratio plus Gumbel noise from the hash of
its doc_id, and the k largest keys are kept. Reruns agree.

N-grams are words, pairs of words, and pairs of word shapes (case, ending, digits, whether the word before is
the same), hashed into a fixed number of counters, so a model has one size at any scale. The raw model counts
every document; the target model is fitted on the texts of at most about ``sample`` labelled documents, chosen
by hash. One half of the labelled documents fits, the other half finds the log ratio that parts good from bad
best; k is the number of documents that reach it, so k follows the corpus. The k-th key is found by nested
histograms, without sorting.

Defined results: a null or empty text has log ratio 0 and no n-grams, and is rejected; null doc_ids share one
noise value; repeated rows are judged alike; documents without labels are judged like others; without labels of
both kinds nothing is rejected but texts without words; an empty table gives no rows; ties at the limit are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.common import Remembered, documents, hash60, mix, nested_limits, ready, stage, table, texts

WORD_BITS, SHAPE_BITS = 12, 7
WORDS, PAIRS = 1 << WORD_BITS, 1 << 2 * SHAPE_BITS
_ENDS = {ord("!"): 2, ord("?"): 2, **dict.fromkeys(b"#*$%&|<>", 3), **dict.fromkeys(b".,;:", 1)}


def shaped(word: bytes) -> int:
    """A word's hash with its shape in the lowest six bits."""
    core = word.strip(b"!?#*$%&|<>.,;:\"'()")
    case = 3 if not core else 2 if len(core) > 1 and core.isupper() else 1 if core[:1].isupper() else 0
    digits = any(48 <= c <= 57 for c in core)
    return xxhash.xxh3_64_intdigest(word.lower()) & ~63 | case | _ENDS.get(word[-1], 0) << 2 | digits << 4 | (len(core) > 20) << 5


_SHAPED = Remembered(shaped)


def ngrams(text: bytes | None) -> np.ndarray:
    """Counters (below WORDS + PAIRS) of a text's n-grams."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int32)
    h = np.fromiter(map(_SHAPED.in_use().__getitem__, words), np.uint64, len(words))
    word, shape = h >> np.uint64(6), (h & np.uint64(63)).astype(np.int32)
    shape[1:] += (word[1:] == word[:-1]).astype(np.int32) << 6
    single = mix(word) >> np.uint64(64 - WORD_BITS)
    double = mix(word[1:] * np.uint64(0x9E3779B97F4A7C15) + word[:-1]) >> np.uint64(64 - WORD_BITS)
    shapes = WORDS + (shape[:-1] << SHAPE_BITS) + shape[1:]
    return np.concatenate([single.astype(np.int32), double.astype(np.int32), shapes])


def labelled(labels: DataFrame, sample: int) -> dict[int, tuple[bool, bool]]:
    """doc_id -> (good, fits the model and not the limit) of at most about ``sample`` labelled documents."""
    each = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").alias("quality"))
    rows = each.count()
    h = hash60("doc_id", "labels")
    picked = each.where(h < int(min(1.0, sample / max(rows, 1)) * (1 << 60))).limit(2 * sample)
    return {r[0]: (r[1] > 0, r[2]) for r in picked.select("doc_id", "quality", (h.bitwiseAND(1) == 0).alias("fit")).collect()}


def fit(docs: DataFrame, known: dict[int, tuple[bool, bool]]) -> np.ndarray:
    """log(target / raw) per counter; words and shapes are two models, smoothed by the raw one."""
    target = {d for d, (good, fits) in known.items() if good and fits}

    def count(batches):
        raw, good = np.zeros(WORDS + PAIRS, np.int64), np.zeros(WORDS + PAIRS, np.int64)
        for ids, found in texts(batches, "doc_id", "text"):
            grams = [ngrams(t) for t in found]
            if grams:
                raw += np.bincount(np.concatenate(grams), minlength=len(raw))
                picked = [g for d, g in zip(ids, grams) if d in target]
                if picked:
                    good += np.bincount(np.concatenate(picked), minlength=len(raw))
        used = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(good[used])], ["gram", "raw", "good"])

    sums = docs.mapInArrow(count, "gram int, raw long, good long").groupBy("gram").agg(F.sum("raw"), F.sum("good")).collect()
    raw, good = np.zeros(WORDS + PAIRS), np.zeros(WORDS + PAIRS)
    for gram, r, g in sums:  # at most WORDS + PAIRS rows
        raw[gram], good[gram] = r, g
    out = np.zeros(WORDS + PAIRS)
    for part in (slice(0, WORDS), slice(WORDS, None)):
        r, g = raw[part], good[part]
        if r.sum() and g.sum():
            p = (r + 0.5) / (r + 0.5).sum()
            g = g + 0.2 * len(r) * p  # prior: the raw model
            out[part] = np.log(g / g.sum()) - np.log(p)
    return out.astype(np.float32)


def scored(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """All rows and columns of ``docs`` with __n (n-grams) and __weight (log ratio)."""
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("__n", T.LongType()), T.StructField("__weight", T.DoubleType())])

    def score(batches):
        for batch in batches:
            (found,) = next(texts(iter([batch]), "text"))
            grams = [ngrams(t) for t in found]
            weights = [float(ratios[g].sum(dtype=np.float64)) for g in grams]
            yield pa.record_batch([*batch.columns, pa.array([len(g) for g in grams], pa.int64()),
                                   pa.array(weights, pa.float64())], [*names, "__n", "__weight"])

    return docs.mapInArrow(score, schema)


def gumbel(doc_id: str = "doc_id") -> Column:
    u = (hash60(doc_id, "gumbel").cast("double") + 0.5) / float(1 << 60)
    return -F.log(-F.log(u))


def best_limit(weights: list[tuple[float, bool]]) -> float:
    """The log ratio that parts good from bad with the best mean of both shares; -inf without both kinds."""
    good = sorted(w for w, g in weights if g)
    bad = sorted(w for w, g in weights if not g)
    if not good or not bad:
        return -math.inf
    g, b = np.array(good), np.array(bad)
    cuts = np.unique(np.concatenate([g, b]))
    hits = 1 - np.searchsorted(g, cuts) / len(g) + np.searchsorted(b, cuts) / len(b)
    top = np.flatnonzero(hits >= hits.max() - 0.002)
    low = cuts[top[0]]  # of equally good limits the lowest: what is clean stays
    below = b[b < low]
    return float((low + below[-1]) / 2) if len(below) else float(low)


def as_hash(key: Column) -> Column:
    """Keys in descending order as 0 .. 2^60 - 1, in steps of 2^-20."""
    steps = F.floor(F.least(F.greatest(key, F.lit(-5e11)), F.lit(5e11)) * (1 << 20)).cast("long")
    return F.lit(1 << 59) - steps


def top_k(keys: DataFrame, k: int) -> int:
    """The largest ``h`` among the k smallest of ``keys(h)``; -1 if k is 0."""
    if k <= 0:
        return -1
    rows = keys.select(F.lit(0).alias("key"), "h", F.lit(1).cast("long").alias("size"), F.lit(k).cast("long").alias("left"))
    return nested_limits(rows).head()["limit"]


def classify(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> tuple[np.ndarray, float]:
    """The fitted log ratios and the log ratio from which on a document counts as good."""
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labelled(labels, sample)
    ratios = fit(pairs, known)
    held_out = {d: good for d, (good, fits) in known.items() if not fits}
    wanted = pairs.where(F.col("doc_id").isin(list(held_out))) if held_out else pairs.limit(0)
    each = scored(wanted, ratios).where("__n > 0").groupBy("doc_id").agg(F.min("__weight").alias("weight"))
    weights = [(r["weight"], held_out[r["doc_id"]]) for r in each.collect()]
    return ratios, best_limit(weights)


def keep_limit(rows: DataFrame, limit: float) -> int:
    """The Gumbel top-k limit for ``rows(__n, __weight, h)``; k counts the rows whose log ratio reaches ``limit``."""
    words = rows.where("__n > 0")
    return top_k(words, words.where(F.col("__weight") >= F.lit(limit)).count())


def op5_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_grams, log_ratio, key, kept of every row."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ratios, limit = classify(docs, table(spark, sf_dir, "labels"))
    key = F.col("__weight") + gumbel()
    rows = stage(scored(docs, ratios).drop("text").withColumns({"key": key, "h": as_hash(key)}), "scores")
    last = keep_limit(rows, limit)
    return rows.select("doc_id", F.col("__n").alias("n_grams"), F.col("__weight").alias("log_ratio"), "key",
                       ((F.col("__n") > 0) & (F.col("h") <= last)).alias("kept"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the sample keeps, unchanged."""
    known = table(spark, sf_dir, "labels")
    ready(spark, 8 << 20)
    ratios, limit = classify(docs, known)
    h = as_hash(F.col("__weight") + gumbel())
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    last = keep_limit(stage(scored(narrow, ratios).select("__n", "__weight", h.alias("h")), "scores"), limit)
    return scored(docs, ratios).where((F.col("__n") > 0) & (h <= last)).select(*docs.columns)


QUERIES = {"op5_importance": op5_importance}
ORACLES: dict[str, str] = {}
