"""Exact nearest neighbours without meeting every row: rings around pivots and the triangle inequality."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import top_rows
from sparkloom.session import checkpointed

PIVOTS = 256
RINGS = 16
ROWS_PER_CELL = 2048
ROWS_PER_RING = 1024
SLICE = 256
ROWS_PER_BLOCK = 16384
QUERIES_PER_PASS = 16384
PAIRS_PER_STEP = 1 << 15


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` from all of ``b``; the bounds that use them allow for rounding."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _kind(df: DataFrame, vector: str) -> str:
    """Floats are carried as they are, half as long, and compared as doubles."""
    return "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float)


def _usable(df: DataFrame, key: str, vector: str, key_as: str, vector_as: str) -> DataFrame:
    values = F.col(vector).cast(_kind(df, vector))
    real = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & real).select(
        F.col(key).cast("bigint").alias(key_as), values.alias(vector_as))


def _pivots(rows: DataFrame, total: int, count: int) -> np.ndarray:
    """Vectors of at most ``count`` rows, drawn by the hash of their value, so copies give one pivot."""
    share = max(total // (64 * count), 1)
    for part in (share, 1):  # a share is empty only where nearly all rows are copies
        some = rows.select("v").filter(F.pmod(F.xxhash64("v"), F.lit(part)) == 0).distinct()
        drawn = some.orderBy(F.xxhash64("v"), "v").limit(count).collect()
        if drawn:
            break
    return np.array([r.v for r in drawn], dtype=float)


def _placed(rows: DataFrame, centres: np.ndarray, rings: int) -> DataFrame:
    """Rows with the cell of their nearest pivot, their distance from it and their ring."""
    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(parts):
            if len(part):
                gaps = _gaps(_matrix(part["v"]), centres)
                cell = gaps.argmin(1)
                yield part.assign(cell=cell, d=gaps[np.arange(len(part)), cell])

    kind = _kind(rows, "v")
    placed = checkpointed(rows.mapInPandas(place, f"k bigint, v {kind}, cell int, d double"), "cells")
    lows, widths = np.zeros(max(len(centres), 1)), np.ones(max(len(centres), 1))
    for cell, lo, hi in placed.groupBy("cell").agg(F.min("d"), F.max("d")).collect():
        lows[cell], widths[cell] = lo, max((hi - lo) / rings, 1e-12)

    def number(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell = part["cell"].to_numpy(int)
            ring = np.minimum((part["d"].to_numpy() - lows[cell]) // widths[cell], rings - 1).astype(int)
            yield pd.DataFrame({"k": part["k"], "v": part["v"], "d": part["d"], "ring": cell * rings + ring})

    return placed.mapInPandas(number, f"k bigint, v {kind}, d double, ring int")


def _slices(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows a few at a time, so that tables of rows by rings stay small."""
    for part in parts:
        for start in range(0, len(part), SLICE):
            yield part.iloc[start:start + SLICE]


class Rings:
    """What tasks know of the rows: pivots, and size and distances of each ring (at most ``pivots * rings`` of them)."""

    def __init__(self, placed: DataFrame, centres: np.ndarray, rings: int):
        self.pivots = centres
        self.scale = 1e-6 + 1e-6 * float(np.sqrt((centres ** 2).sum(-1)).max(initial=0.0))
        found = placed.groupBy("ring").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n"))
        table = found.orderBy("ring").toPandas()
        self.names, self.sizes = table["ring"].to_numpy(int), table["n"].to_numpy(int)
        self.lo, self.hi, self.cell_of = table["lo"].to_numpy(float), table["hi"].to_numpy(float), self.names // rings

    def bounds(self, queries: np.ndarray, only: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """For each query and ring (or some rings): no row lies nearer than the first, none farther than the second."""
        lo, hi = self.lo[only], self.hi[only]
        gaps = _gaps(queries, self.pivots)
        own = gaps.min(1)[:, None]
        at = gaps[:, self.cell_of[only]]
        least = np.maximum(np.maximum(at - hi, lo - at), (at - own) / 2.0)  # rows lie nearer to their own pivot
        slack = self.scale + 1e-6 * (gaps.max(1)[:, None] + hi)
        return np.maximum(least - slack, 0.0), at + hi + slack


class Blocks:
    """Blocks of at most ``size`` rows: small rings share one, a large ring has several and its rows go by the hash of their key."""

    def __init__(self, cells: Rings, size: int):
        self.first, self.parts = np.zeros(len(cells.names), int), np.maximum(-(-cells.sizes // size), 1)
        block, held = 0, 0
        for i, (rows, parts) in enumerate(zip(cells.sizes.tolist(), self.parts.tolist())):
            if held and held + rows > size:
                block, held = block + 1, 0
            self.first[i] = block
            block, held = (block + parts, 0) if parts > 1 else (block, held + rows)
        self.ring = np.repeat(np.arange(len(self.parts)), self.parts)  # the rings of the blocks, by block
        self.block = np.concatenate([np.arange(a, a + n) for a, n in zip(self.first, self.parts)])
        self.starts = np.flatnonzero(np.diff(self.block, prepend=-1))
        self.names = self.block[self.starts]

    def met(self, rings: np.ndarray) -> np.ndarray:
        """Which blocks hold one of the rings, for rows of flags by ring."""
        return np.logical_or.reduceat(rings[:, self.ring], self.starts, axis=1)


def _dense(vectors: pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks()
    if len(pc.unique(pc.list_value_length(vectors))) > 1:
        raise ValueError("vectors differ in length")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)


class Best:
    """The k nearest rows so far of a few queries, whose own rows lie within ``limit``."""

    def __init__(self, queries: np.ndarray, limit: np.ndarray, k: int):
        self.queries, self.limit, self.k = queries, limit, k
        self.square = (queries * queries).sum(1)
        self.owner, self.gap, self.key = np.empty(0, int), np.empty(0), np.empty(0, np.int64)

    def meet(self, some: np.ndarray, keys: np.ndarray, rows: np.ndarray, square: np.ndarray) -> None:
        """Let queries ``some`` meet rows: one matrix product tells which pairs can count, and those are worked out exactly."""
        w, of, k = self.queries[some], self.square[some], self.k
        about = of[:, None] + square[None, :] - 2.0 * (w @ rows.T)
        slack = 1e-15 * (rows.shape[1] + 8) * (np.sqrt(of) + np.sqrt(square.max())) ** 2  # of a square by the product
        reach = self.limit[some] ** 2 * (1 + 1e-14) + slack
        count = ~(about > reach[:, None])  # not a number counts
        many = np.flatnonzero(count.sum(1) > 4 * k)
        if len(many):
            tight = np.partition(about[many], k - 1, axis=1)[:, k - 1] + 2 * slack[many]
            count[many] &= ~(about[many] > tight[:, None])
        at, row = np.nonzero(count)
        gaps = [np.sqrt(((rows[row[i:i + PAIRS_PER_STEP]] - w[at[i:i + PAIRS_PER_STEP]]) ** 2).sum(axis=1))
                for i in range(0, len(at), PAIRS_PER_STEP)]
        owner = np.concatenate([self.owner, some[at]])
        gap, key = np.concatenate([self.gap, *gaps]), np.concatenate([self.key, keys[row]])
        order = np.lexsort((key, gap, owner))
        owner, gap, key = owner[order], gap[order], key[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = (place < k) & ~(gap > self.limit[owner])
        last = keep & (place == k - 1)
        self.limit[owner[last]] = np.minimum(self.limit[owner[last]], gap[last])
        self.owner, self.gap, self.key = owner[keep], gap[keep], key[keep]


def _compare(rows: DataFrame, cells: Rings, blocks: Blocks, asked: DataFrame, k: int, per_pass: int) -> DataFrame:
    """The best k rows of each (query, block) pair. The queries of a block are cut into passes; a task holds one of both."""
    wanted = asked.select("q", "w", "limit", F.explode("blocks").alias("b"))
    calls = {r.b: r.n for r in asked.select(F.explode("blocks").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}
    passes = [-(-calls.get(b, 0) // per_pass) for b in range(int(blocks.names.max()) + 1)]
    conf = asked.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parts = max(min(2 * sum(passes), int(conf)), 1)  # a stated number is not merged again: few bytes are much work here

    turns = lambda b: F.get(F.lit(passes), F.col(b))
    left = rows.filter(turns("b") > 0).withColumn("p", F.explode(F.sequence(F.lit(0), turns("b") - 1)))
    right = wanted.withColumn("p", F.pmod(F.xxhash64("q"), turns("b")).cast("int"))

    def nearest(some: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        if some.num_rows and asking.num_rows:
            some = some.sort_by("ring")
            keys, vectors = some["k"].to_numpy(), _dense(some["v"])
            square = (vectors * vectors).sum(1)
            held, starts = np.unique(some["ring"].to_numpy(), return_index=True)
            ends = [*starts[1:], len(keys)]
            only = np.searchsorted(cells.names, held)
            names, queries, limits = asking["q"].to_numpy(), _dense(asking["w"]), asking["limit"].to_numpy()
            for at in range(0, len(names), SLICE):
                best = Best(queries[at:at + SLICE], limits[at:at + SLICE].copy(), k)
                near, _ = cells.bounds(best.queries, only)
                for i in near.mean(0).argsort():
                    open_ = np.flatnonzero(~(near[:, i] > best.limit))
                    if len(open_):
                        own = slice(starts[i], ends[i])
                        best.meet(open_, keys[own], vectors[own], square[own])
                out.append((names[at:at + SLICE][best.owner], best.key, best.gap))
        q, key, gap = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"q": pa.array(q, pa.int64()), "k": pa.array(key, pa.int64()), "distance": pa.array(gap, pa.float64())})

    return left.repartition(parts, "b", "p").groupBy("b", "p").cogroup(right.repartition(parts, "b", "p").groupBy("b", "p")).applyInArrow(
        nearest, "q bigint, k bigint, distance double")


def pruned_neighbours(queries: DataFrame, train: DataFrame, key: str, vector: str, k: int, pivots: int = PIVOTS, rings: int = RINGS,
                      cell_rows: int = ROWS_PER_CELL, ring_rows: int = ROWS_PER_RING, per_block: int = ROWS_PER_BLOCK,
                      per_pass: int = QUERIES_PER_PASS,
                      seen: Callable[[int, int], None] | None = None) -> DataFrame:
    """Exact k nearest training rows of each query by Euclidean distance, ties to the smaller key.

    Rows lie in cells (nearest of at most ``pivots`` drawn rows, one for ``cell_rows`` rows) and in rings by
    their distance from the pivot (at most ``rings`` a cell, about ``ring_rows`` rows or more in the mean).
    Rings lie in blocks of at most ``per_block`` rows. A query first meets the block whose ring may hold the nearest
    row; its k-th distance there, or what the table of rings promises, excludes every ring that cannot hold a nearer
    row, and the second pass meets the blocks of the others, once each. In a block a matrix product tells which pairs
    can count; their distances are worked out from the vectors. Of copies of a row only k can be asked for, so the
    others go first. ``seen`` is told the pairs in the blocks met and all pairs. Rows and queries whose key or
    vector is null, or whose vector holds a null or a number that is not finite, are left out; all vectors
    must have one length. Fewer than k rows: all of them.
    """
    schema = f"query_{key} bigint, {key} bigint, distance double"
    rows = checkpointed(top_rows(_usable(train, key, vector, "k", "v"), "v", ["k"], k), "train")
    total = rows.count()
    pivots = min(pivots, total // cell_rows + 1)
    rings = min(rings, total // (pivots * ring_rows) + 1)
    centres = _pivots(rows, total, pivots)
    if not len(centres):
        return train.sparkSession.createDataFrame([], schema)
    placed = _placed(rows, centres, rings)
    cells = Rings(placed, centres, rings)
    blocks = Blocks(cells, per_block)
    counts, kind = cells.sizes, _kind(queries, vector)
    where = np.zeros((2, len(centres) * rings), int)
    where[:, cells.names] = blocks.first, blocks.parts
    first_of, parts_of = (F.get(F.lit(x.tolist()), F.col("ring")) for x in where)
    placed = checkpointed(placed.select("k", "v", "ring", (first_of + F.pmod(F.xxhash64("k"), parts_of)).cast("int").alias("b")), "blocks")

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(parts):
            if len(part):
                near, far = cells.bounds(_matrix(part["w"]))
                order = far.argsort(1)
                enough = (counts[order].cumsum(1) >= k).argmax(1)
                full = counts.sum() >= k
                limit = np.take_along_axis(far, order, 1)[np.arange(len(part)), enough] if full else np.inf
                start = np.where(near <= near.min(1, keepdims=True), far, np.inf).argmin(1)
                yield part.assign(limit=limit, blocks=[[b] for b in blocks.first[start].tolist()])

    fields = f"q bigint, w {kind}, limit double, blocks array<int>"
    asked = checkpointed(_usable(queries, key, vector, "q", "w").mapInPandas(first, fields), "asked")
    begun = checkpointed(_compare(placed, cells, blocks, asked, k, per_pass), "begun")
    kth = top_rows(begun, "q", ["distance", "k"], k).groupBy("q").agg(F.max("distance").alias("kth"), F.count(F.lit(1)).alias("n"))
    bound = F.least("limit", F.when(F.col("n") >= k, F.col("kth")).otherwise(float("inf")))
    limits = asked.join(kth, "q", "left").select("q", "w", bound.alias("limit"), "blocks")

    def others(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(parts):
            if len(part):
                near, _ = cells.bounds(_matrix(part["w"]))
                met = blocks.met(~(near > part["limit"].to_numpy()[:, None]))
                met &= blocks.names[None, :] != np.array([b[0] for b in part["blocks"]])[:, None]
                yield part.assign(blocks=[blocks.names[x].tolist() for x in met])

    more = checkpointed(limits.mapInPandas(others, fields), "others")
    if seen:
        met = asked.select(F.explode("blocks").alias("b")).unionAll(more.select(F.explode("blocks").alias("b"))).groupBy("b").count()
        pairs = met.join(placed.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b").agg(F.sum(F.col("n") * F.col("count"))).first()[0]
        seen(pairs or 0, asked.count() * int(counts.sum()))
    found = begun.unionByName(_compare(placed, cells, blocks, more, k, per_pass))
    best = top_rows(found, "q", ["distance", "k"], k)
    return best.select(F.col("q").alias(f"query_{key}"), F.col("k").alias(key), "distance")
