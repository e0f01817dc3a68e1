"""Ordered windows as a range-partitioned prefix scan: one plan for every size and any skew.

A plain window sends each group to one task. Here the rows, in the order of (group, order key), are cut into chunks
of about the same size. Small groups lie whole in one chunk, a large one is cut by as many borders as its rows
need. A chunk is a window partition of its own; what a row needs from other chunks arrives as

* a carry, for running values: one row per chunk of a cut group, summed up over the chunks before it;
* a halo, for lags, leads and rolling frames: copies of the few rows next to the chunk.

Borders are rows of the input: a sample of one row for each of ``CHUNKS * SAMPLES`` hash buckets (the row with the
smallest hash, found by a partial ``min``) is sorted and every ``SAMPLES``-th row becomes a border. So they follow
from the values alone: a recomputed task, another branch of the plan or another number of partitions finds the same
chunks and the same digits. Only groups that hold a border are cut, so carries are at most two rows per border, and
the borders, carries and halos are bounded by the number of chunks; borders and carries are looked up in arrays. Rows go
straight to the partition of their chunk. Everything is one lazy plan: nothing is run or measured while it is built.
The plan names its input several times (borders, rows, carries, halos), so an input that is itself the result of a
shuffle should be a written table (``session.checkpointed``); the callers here see to that.

The order key must be unique within a group; add a tie-break column where it is not.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 512  # at least; one per shuffle partition where there are more of those
SAMPLES = 16  # sampled rows per chunk: chunks differ by about a quarter of their size


@dataclass(frozen=True)
class Running:
    """Aggregate from the first row of the group to this one: sum, count, min, max, last."""
    fn: str
    col: str


@dataclass(frozen=True)
class Ahead:
    """First non-null value at or after this row."""
    col: str


@dataclass(frozen=True)
class Shift:
    """Value ``by`` rows earlier (positive) or later (negative)."""
    col: str
    by: int = 1


@dataclass(frozen=True)
class Rolling:
    """Aggregate over the last ``size`` rows; null until ``min_periods`` values are there."""
    fn: str
    col: str
    size: int
    min_periods: int = 1


@dataclass(frozen=True)
class Total:
    """Aggregate over the whole group: sum, count, min, max."""
    fn: str
    col: str


@dataclass(frozen=True)
class RowNumber:
    """1-based position in the group."""


_AGG = {
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg,
    "stddev": F.stddev_samp, "product": F.product,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _combine(fn: str, carried: Column, local: Column) -> Column:
    if fn == "count":
        return F.coalesce(carried, F.lit(0)) + local
    if fn == "sum":
        return F.coalesce(carried + local, carried, local)
    if fn == "product":
        return F.coalesce(carried * local, carried, local)
    if fn == "min":
        return F.least(carried, local)
    if fn == "max":
        return F.greatest(carried, local)
    return F.coalesce(local, carried)


def renamed(df: DataFrame, keys: list[str], prefix: str) -> tuple[DataFrame, Column]:
    """``df`` with prefixed column names, and the null-safe join condition on ``keys``."""
    out = df.select(*[F.col(c).alias(prefix + c) for c in df.columns])
    return out, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _dense(df: DataFrame, place: str, value: Column, size: int) -> Column:
    """Array of ``value`` by place, 0 to size - 1; a scalar subquery, so looking up is no join."""
    every = df.sparkSession.range(size).select(F.col("id").alias(place), *[
        F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c != place])
    each = df.unionByName(every).groupBy(F.col(place).cast("int").alias("p")).agg(value.alias("v"))
    return each.agg(F.sort_array(F.collect_list(F.struct("p", "v"))).alias("s")).select(F.transform("s", lambda x: x["v"])).scalar()


def _borders(df: DataFrame, keys: list[str], by: list[str], chunks: int) -> Column:
    """``rows``: ``chunks - 1`` rows of ``keys`` at most, in order, that cut the rows evenly; ``groups``: hashes of the
    groups they cut. A scalar subquery."""
    rows = df.select(*keys, F.xxhash64(*keys).alias("_h")).withColumn("_b", F.pmod("_h", F.lit(chunks * SAMPLES)))
    least = _dense(rows.select("_b", "_h"), "_b", F.min("_h"), chunks * SAMPLES)
    sample = rows.where(F.col("_h") == F.get(least, F.col("_b").cast("int"))).select(F.struct(*keys).alias("k")).distinct()
    listed = sample.agg(F.sort_array(F.collect_list("k")).alias("s"))  # at most chunks * SAMPLES rows
    places = F.expr(f"filter(sequence({SAMPLES}, greatest({SAMPLES}, size(s)), {SAMPLES}), i -> i < size(s))")
    cuts = listed.select(F.transform(places, lambda i: F.element_at("s", i + 1)).alias("rows"))
    hashes = F.array_distinct(F.transform("rows", lambda r: F.xxhash64(*[r[k] for k in by])))
    return cuts.select(F.struct("rows", hashes.alias("groups")).alias("cuts")).scalar()


def _position(cuts: Column, key: Column, most: int) -> Column:
    """How many borders are at or below the key, by halving."""
    def step(found: Column, power: Column) -> Column:
        probe = found + power
        fits = (probe <= F.size(cuts)) & (F.get(cuts, probe - 1) <= key)
        return F.when(fits, probe).otherwise(found)

    powers = F.array(*[F.lit(1 << p) for p in reversed(range(most.bit_length()))])
    return F.aggregate(powers, F.lit(0), step)


def over_order(df: DataFrame, by: list[str] | str, order: list[str] | str, columns: dict[str, object],
               descending: bool = False, base: DataFrame | None = None) -> DataFrame:
    """Add ordered-window columns to ``df``; see the classes above for what they compute.

    Borders are taken from ``df``, or from ``base`` if that holds the same keys and is cheaper to read.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    kept = df.columns
    base = df if base is None else base
    if not by:
        df, base, by = df.withColumn("_all", F.lit(0)), base.withColumn("_all", F.lit(0)), ["_all"]
    keys = list(dict.fromkeys([*by, *order]))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(CHUNKS, parts)
    cuts = F.col("_cuts")["rows"]

    def placed(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("_chunk", _position(cuts, F.struct(*keys), chunks))
        part = F.floor(F.col("_chunk").cast("bigint") * parts / (F.size(cuts) + 1)).cast("int")  # chunks in order, evenly
        return out.select(*df.columns, "_chunk", part.alias("_part"))

    frame = df.withColumn("_cuts", _borders(base, keys, by, chunks))
    # only rows of cut groups are looked up for carries and halos; an uncut group of the same hash adds nothing to them
    large = placed(frame.filter(F.array_contains(F.col("_cuts")["groups"], F.xxhash64(*by))))
    frame = placed(frame).withColumn("_halo", F.lit(False))

    back = max([c.by for c in columns.values() if isinstance(c, Shift)]
               + [c.size - 1 for c in columns.values() if isinstance(c, Rolling)] + [0])
    front = max([-c.by for c in columns.values() if isinstance(c, Shift)] + [0])
    for reach, flip in ((back, descending), (front, not descending)):
        if reach > 0:
            frame = frame.unionByName(_halo(large, by, order, reach, flip).withColumn("_halo", F.lit(True)))

    frame = frame.repartitionById(parts, F.col("_part"))
    result = _windows(frame, by, order, columns, descending).filter(~F.col("_halo"))
    carry = _carry(large, by, order, columns, descending)
    if carry is not None:
        entries = carry.select("_chunk", F.struct(*by, *[F.col(c).alias("_c_" + c) for c in carry.columns if c in columns]).alias("_e"))
        carries = _dense(entries, "_chunk", F.collect_list("_e"), chunks)  # a chunk holds parts of two cut groups at most
        own = F.filter(F.col("_here"), lambda e: reduce(lambda a, b: a & b, [e[k].eqNullSafe(F.col(k)) for k in by]))
        result = result.withColumn("_here", F.get(carries, F.col("_chunk"))).withColumn("_e", F.get(own, 0)).withColumns({
            name: F.coalesce(F.col("_e")["_c_" + name], F.col(name)) if isinstance(spec, Total) else
            _combine("count" if isinstance(spec, RowNumber) else getattr(spec, "fn", "last"), F.col("_e")["_c_" + name], F.col(name))
            for name, spec in columns.items() if isinstance(spec, (Running, RowNumber, Ahead, Total))})
    return result.select(*kept, *columns)


def _windows(frame: DataFrame, by, order, columns, descending) -> DataFrame:
    whole = [*by, "_part", "_chunk"]

    def spec(flip: bool):
        return Window.partitionBy(*whole).orderBy(*[F.col(c).desc() if flip else F.col(c).asc() for c in order])

    forward, backward = spec(descending), spec(not descending)
    so_far = (Window.unboundedPreceding, Window.currentRow)

    def own(c: Column) -> Column:
        return F.when(~F.col("_halo"), c)

    out = {}
    for name, item in columns.items():
        if isinstance(item, Running):
            out[name] = _AGG[item.fn](own(F.col(item.col))).over(forward.rowsBetween(*so_far))
        elif isinstance(item, Total):
            out[name] = _AGG[item.fn](own(F.col(item.col))).over(Window.partitionBy(*whole))
        elif isinstance(item, RowNumber):
            out[name] = F.count(own(F.lit(1))).over(forward.rowsBetween(*so_far))
        elif isinstance(item, Ahead):
            out[name] = F.last(own(F.col(item.col)), ignorenulls=True).over(backward.rowsBetween(*so_far))
        elif isinstance(item, Shift):
            out[name] = F.lag(item.col, item.by).over(forward)
        elif isinstance(item, Rolling):
            rows = forward.rowsBetween(1 - item.size, 0)
            value = _AGG[item.fn](item.col).over(rows)
            if item.min_periods > 1:
                value = F.when(F.count(item.col).over(rows) >= item.min_periods, value)
            out[name] = value
        else:
            raise TypeError(f"unknown window column {item!r}")
    return frame.withColumns(out)


def _carry(large: DataFrame, by, order, columns, descending) -> DataFrame | None:
    """State of each cut group's running columns just before (or after) each chunk."""
    totals, states = [], []
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    inside = Window.partitionBy(*by, "_chunk").orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, item in columns.items():
        if isinstance(item, RowNumber):
            total, fn, flip = F.count(F.lit(1)), "sum", False
        elif isinstance(item, Total):
            total, fn, flip = _AGG[item.fn](item.col), "sum" if item.fn == "count" else item.fn, None
        elif isinstance(item, Running) and item.fn in ("sum", "product") and large.schema[item.col].dataType.typeName() in ("double", "float"):
            # rounded sums depend on the order of rows: added in the chunk's own order, as on its rows
            large = large.withColumn("_run_" + name, _AGG[item.fn](item.col).over(inside))
            total, fn, flip = last("_run_" + name, F.struct(*order)), item.fn, False
        elif isinstance(item, Running) and item.fn != "last":
            total, fn, flip = _AGG[item.fn](item.col), "sum" if item.fn == "count" else item.fn, False
        elif isinstance(item, (Running, Ahead)):
            flip, fn = isinstance(item, Ahead), "last"
            at = F.when(F.col(item.col).isNotNull(), F.struct(*order))
            total = (first if flip else last)(item.col, at)
        else:
            continue
        totals.append(total.alias(name))
        states.append((name, fn, flip))
    if not totals:
        return None
    per_chunk = large.groupBy(*by, "_chunk").agg(*totals)
    forward = F.col("_chunk").desc() if descending else F.col("_chunk").asc()
    backward = F.col("_chunk").asc() if descending else F.col("_chunk").desc()
    before, whole = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, Window.unboundedFollowing)
    return per_chunk.select(*by, "_chunk", *[
        _AGG[fn](name).over(Window.partitionBy(*by).orderBy(backward if flip else forward)
                            .rowsBetween(*(whole if flip is None else before))).alias(name)
        for name, fn, flip in states])


def _halo(large: DataFrame, by, order, reach: int, flip: bool) -> DataFrame:
    """Copies of the ``reach`` rows just before each chunk (after it, when flipped)."""
    away = [F.col(c).asc() if flip else F.col(c).desc() for c in order]
    toward = [F.col(c).desc() if flip else F.col(c).asc() for c in order]
    rank = Window.partitionBy(*by, "_chunk").orderBy(*away)
    edge = large.withColumn("_r", F.row_number().over(rank)).filter(F.col("_r") <= reach).drop("_r")
    edge = edge.withColumn("_p", F.row_number().over(Window.partitionBy(*by).orderBy(*toward)))
    starts = (edge.groupBy(*by, "_chunk", "_part").agg((F.min("_p") - 1).alias("_end")).filter("_end > 0")
              .withColumn("_p", F.explode(F.sequence(F.greatest(F.col("_end") - reach + 1, F.lit(1)), F.col("_end"))))
              .withColumnsRenamed({"_chunk": "_to", "_part": "_there"}))
    starts, match = renamed(starts.select(*by, "_p", "_to", "_there"), [*by, "_p"], "_b_")
    return edge.join(starts, match).select(
        *[c for c in large.columns if c not in ("_chunk", "_part")], F.col("_b__to").alias("_chunk"), F.col("_b__there").alias("_part"))
