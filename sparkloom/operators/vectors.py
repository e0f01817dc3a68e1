"""Vector search and text vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import arrays as A
from sparkloom.operators.groups import joined_on, top_rows

QUERIES_PER_PASS = 512
ROWS_PER_BLOCK = 8192
DOCS_PER_BLOCK = 512
PAIRS_PER_STEP = 1 << 15


def vector_of(df: DataFrame, key: str, value, vector: str) -> Column:
    """The vector of one key, as a scalar subquery."""
    return df.filter(F.col(key) == value).agg(F.first(vector)).scalar()


def nearest(df: DataFrame, key: str, vector: str, query: Column, k: int, exclude: list = (), out: str = "similarity") -> DataFrame:
    """The k most similar keys by cosine: one scan, and each task keeps its best k."""
    rows = df.filter(~F.col(key).isin(*exclude)) if exclude else df
    scored = rows.withColumn("_q", query).select(key, A.cosine(F.col(vector), F.col("_q")).alias(out))
    return scored.orderBy(F.desc(out), key).limit(k)


def analogy(df: DataFrame, key: str, vector: str, a, b, c, k: int, keep_inputs: bool = False) -> DataFrame:
    """Keys nearest to a - b + c."""
    va, vb, vc = (vector_of(df, key, x, vector) for x in (a, b, c))
    rows = df if keep_inputs else df.filter(~F.col(key).isin(a, b, c))
    src = rows.withColumns({"_a": va, "_b": vb, "_c": vc})
    target = A.add(A.add(F.col("_a"), A.scale(F.col("_b"), -1.0)), F.col("_c"))
    scored = src.select(key, A.cosine(F.col(vector), target).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), key).limit(k)


def vector_sums(df: DataFrame, by: list[str] | str, vector: str, dims: int, weight: Column | None = None) -> DataFrame:
    """Per group: element-wise sum, and the total weight.

    One plain sum per element, which is combined before the shuffle and needs no explode.
    """
    by = [by] if isinstance(by, str) else list(by)
    w = F.lit(1) if weight is None else weight
    sized = F.when(F.size(vector) == dims, F.col(vector)).otherwise(F.raise_error(F.lit(f"a vector has not {dims} elements")))
    df = df.withColumn(vector, F.when(F.col(vector).isNotNull(), sized))
    element = [F.sum(F.get(F.col(vector), F.lit(i)).cast("double") * w) for i in range(dims)]
    sums = df.groupBy(*by).agg(*[e.alias(f"_d{i}") for i, e in enumerate(element)], F.sum(w).alias("_w"))
    return sums.select(*by, F.array(*[f"_d{i}" for i in range(dims)]).alias("sums"), F.col("_w").alias("weight"))


def mean_vectors(df: DataFrame, by: list[str] | str, vector: str, dims: int, weight: Column | None = None) -> DataFrame:
    sums = vector_sums(df, by, vector, dims, weight)
    return sums.withColumn("mean", F.transform(sums["sums"], lambda x: x / F.col("weight"))).drop("sums")


def sentence_vectors(docs: DataFrame, words: DataFrame, key: str, vocabulary: DataFrame, word: str, vector: str,
                     dims: int, per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """Mean vector of the known tokens of each text; null and weight 0 where none is known.

    ``words`` has one row per token. Texts lie in blocks of about ``per_block``; a block gets its tokens and, once each,
    the vectors of its words, so sums are held for the texts of one block, however many texts and words there are.
    """
    blocks = docs.agg(F.greatest(F.ceil(F.count(F.lit(1)) / per_block), F.lit(1)).cast("int")).scalar()
    block = F.pmod(F.xxhash64(key), blocks).cast("int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = words.filter(F.col(word).isNotNull()).select(block.alias("_b"), key, word)
    sized = F.when(F.size(vector) == dims, F.col(vector)).otherwise(F.raise_error(F.lit(f"a vector has not {dims} elements")))
    held = F.coalesce(F.when(F.col(vector).isNotNull(), sized).cast("array<double>"), F.array_repeat(F.lit(None).cast("double"), dims))
    asked = tokens.select(F.col("_b").alias("_vb"), F.col(word).alias("_vw")).distinct().join(
        vocabulary.select(F.col(word).alias("_vw"), held.alias("_v")), "_vw")

    def add_up(some: pa.Table, vectors: pa.Table) -> pa.Table:
        names = pc.unique(vectors["_vw"])
        places = pc.index_in(vectors["_vw"], value_set=names).to_numpy()
        flat = vectors["_v"].combine_chunks().flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(float)
        values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, dims)
        table = np.zeros((len(names), 2 * dims + 1))  # of each word: sums, known elements, vectors
        np.add.at(table, places, np.hstack([values, known, np.ones((len(values), 1))]))
        texts = some[key].combine_chunks().dictionary_encode(null_encoding="encode")
        found = pc.index_in(some[word], value_set=names).combine_chunks()
        hits = found.is_valid().to_numpy(zero_copy_only=False)
        code = texts.indices.to_numpy()[hits].astype(np.int64) * max(len(names), 1) + found.drop_null().to_numpy()
        code, times = np.unique(code, return_counts=True)
        out = np.zeros((len(texts.dictionary), 2 * dims + 1))
        for start in range(0, len(code), PAIRS_PER_STEP):
            part = slice(start, start + PAIRS_PER_STEP)
            row, at = np.divmod(code[part], len(names))
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[first]] += np.add.reduceat(table[at] * times[part, None], first)
        some_known = out[:, -1] > 0
        out = out[some_known]
        sums = pa.array(out[:, :dims].ravel(), mask=(out[:, dims:2 * dims] == 0).ravel())
        offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * dims)
        return pa.table({key: texts.dictionary.filter(pa.array(some_known)), "sums": pa.ListArray.from_arrays(offsets, sums),
                         "weight": pa.array(out[:, -1].astype(np.int64))})

    schema = T.StructType([docs.schema[key], T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("weight", T.LongType())])
    # a stated number of partitions is not merged again: a task sorts its tokens by block
    sums = tokens.repartition(parts, "_b").groupBy("_b").cogroup(asked.groupBy("_vb")).applyInArrow(add_up, schema)
    means = sums.select(key, "weight", F.transform("sums", lambda x: x / F.col("weight")).alias("mean"))
    out = joined_on(docs.select(key), means, key)
    return out.withColumn("weight", F.coalesce("weight", F.lit(0)))


def neighbours(queries: DataFrame, train: DataFrame, key: str, vector: str, k: int,
               per_pass: int = QUERIES_PER_PASS, per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Exact k nearest training rows of each query by Euclidean distance.

    Every query meets every training row, in blocks: a task holds about ``per_block`` rows and
    ``per_pass`` queries, whatever their totals are, and hands on k rows per query. The numbers
    of blocks and passes are read inside the plan; nothing comes to the driver.
    """
    many = lambda df, size: df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).cast("int")).scalar()
    blocks, passes = many(train, per_block), many(queries, per_pass)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = train.select(F.pmod(F.xxhash64(key), blocks).cast("int").alias("_b"), spread(passes).alias("_p"),
                        F.col(key).alias("_k"), F.col(vector).cast("array<double>").alias("_v"))
    asked = queries.select(spread(blocks).alias("_qb"), F.pmod(F.xxhash64(key), passes).cast("int").alias("_qp"),
                           F.col(key).alias("_q"), F.col(vector).cast("array<double>").alias("_w"))
    schema = f"query_{key} bigint, {key} bigint, distance double"

    def compare(some: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if some.empty or asking.empty:
            return pd.DataFrame({f"query_{key}": [], key: [], "distance": []})
        names, vectors = some["_k"].to_numpy(), np.stack(some["_v"].to_list())
        out = []
        for name, v in zip(asking["_q"].to_numpy(), asking["_w"]):
            gaps = ((vectors - v) ** 2).sum(axis=1)
            pick = np.lexsort((names, gaps))[:k]
            out.append(pd.DataFrame({f"query_{key}": name, key: names[pick], "distance": np.sqrt(gaps[pick])}))
        return pd.concat(out)

    found = rows.groupBy("_b", "_p").cogroup(asked.groupBy("_qb", "_qp")).applyInPandas(compare, schema)
    return top_rows(found, f"query_{key}", ["distance", key], k)


def vote(found: DataFrame, train: DataFrame, key: str, label: str) -> DataFrame:
    """Most frequent label of each query's neighbours (the smallest on a tie), and their mean label."""
    labelled = found.join(train.select(key, label), key)
    counts = labelled.groupBy(f"query_{key}", label).agg(F.count(F.lit(1)).alias("_n"))
    majority = counts.groupBy(f"query_{key}").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l")))["l"].alias("predicted"),
        (F.sum(F.col(label) * F.col("_n")) / F.sum("_n")).alias("regressed"))
    return majority
