"""Packing of token sequences into windows by minimum bin slack.

A document is cut into whole windows and one remainder. Only the number of remainders per length reaches the
planner: at most ``capacity`` counters, whatever the corpus holds. The planner seeds a window with the longest
remainder, finds by a bitset subset-sum the multiset of lengths that comes closest to the space left, and
backtracks how many of each length it takes; the pattern is repeated as often as the counts allow. Where the
closest multiset still leaves more than ``tolerance`` tokens, the next longest remainder is cut to fill the
window and its tail goes back into the multiset.

Every remainder knows its rank among those of its length (a counter in its task plus the counts of the tasks
before), so it finds its window in the plan without any sort or group of documents.

Defined results: a null text is a document of the end id alone; a null doc_id is kept; repeated rows are
separate documents; an empty table has no pieces; other columns are not read. A document of exactly a window's
length is one whole window. Sequence ids run from 0 without gaps.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, offsets, stage, texts
from sparkloom.llm.tokens import default_tokenizer, encoder

CAPACITY = 4096


def closest_multiset(counts: dict[int, int], space: int) -> tuple[int, dict[int, int]]:
    """(filled, {length: how many}): the multiset of ``counts`` with the largest sum up to ``space``."""
    reach, full, steps = 1, (1 << (space + 1)) - 1, []
    for length in sorted((x for x in counts if x <= space), reverse=True):
        left, part = min(counts[length], space // length), 1
        while left > 0 and not reach >> space & 1:
            part = min(part, left)
            steps.append((length, part, reach))
            reach = (reach | reach << (length * part)) & full
            left, part = left - part, part * 2
        if reach >> space & 1:
            break
    best = at = reach.bit_length() - 1
    take: dict[int, int] = defaultdict(int)
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            at -= length * part
            take[length] += part
    return best, dict(take)


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY, tolerance: int = 16) -> tuple[np.ndarray, int]:
    """Placements of all remainders, and the number of windows.

    A row: (length at first, first rank, how many, tokens before, piece length, first window, pieces a window,
    first slot, offset in the window).
    """
    left = {k: int(v) for k, v in counts.items() if v > 0}
    lots = {k: deque([(k, 0, v, 0)]) for k, v in left.items()}
    rows, windows = [], 0

    def take(length: int, n: int) -> list[tuple]:
        out = []
        left[length] -= n
        if not left[length]:
            del left[length]
        while n:
            first, rank, held, before = lots[length].popleft()
            used = min(n, held)
            if used < held:
                lots[length].appendleft((first, rank + used, held - used, before))
            out.append((first, rank, used, before))
            n -= used
        return out

    while left:
        seed = max(left)
        space = capacity - seed
        rest = dict(left)
        rest[seed] -= 1
        filled, need = closest_multiset({k: v for k, v in rest.items() if v}, space)
        need[seed] = need.get(seed, 0) + 1
        gap, cut = space - filled, 0
        if gap > tolerance:  # whatever is left is longer than the gap, or it would have been taken
            cut = max((k for k, v in left.items() if v > need.get(k, 0)), default=0)
        with_cut = {**need, cut: need.get(cut, 0) + 1} if cut else need
        times = min(left[k] // n for k, n in with_cut.items())
        at = 0
        for length in sorted(need, reverse=True):
            slot = 0
            for first, rank, n, before in take(length, need[length] * times):
                rows.append((first, rank, n, before, length, windows, need[length], slot, at))
                slot += n
            at += length * need[length]
        if cut:
            slot = 0
            for first, rank, n, before in take(cut, times):
                rows.append((first, rank, n, before, gap, windows, 1, slot, at))
                slot += n
                lots.setdefault(cut - gap, deque()).append((first, rank, n, before + gap))
                left[cut - gap] = left.get(cut - gap, 0) + n
        windows += times
    return np.array(rows, np.int64).reshape(-1, 9), windows


def encoded(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Ids of every document with its place among those of its task: the rank of its remainder, whole windows before."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def encode(batches):
        code, part = encoder(tokenizer), TaskContext.get().partitionId()
        end, ranks, whole = np.array([end_id], code.dtype).tobytes(), defaultdict(int), 0
        for ids, found in texts(batches, "doc_id", "text"):
            data = [code.ids(t) + end for t in found]
            cols = []
            for d in data:
                n = len(d) // code.dtype.itemsize
                tail = n % capacity
                cols.append((part, n, tail, ranks[tail], whole))
                ranks[tail] += 1
                whole += n // capacity
            number = [pa.array(c, pa.int64()) for c in zip(*cols)] if cols else [pa.array([], pa.int64())] * 5
            yield pa.record_batch([pa.array(ids, pa.int64()), *number, pa.array(data, pa.binary())],
                                  ["doc_id", "part", "n", "tail", "rank", "whole", "ids"])

    return stage(docs.mapInArrow(
        encode, "doc_id long, part long, n long, tail long, rank long, whole long, ids binary"), "ids")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = CAPACITY,
         tolerance: int = 16, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, as u32)."""
    tokenizer = tokenizer or default_tokenizer()
    dtype = encoder(tokenizer).dtype
    rows = encoded(docs, tokenizer, end_id, capacity)
    groups = stage(rows.groupBy("part", "tail").agg(
        F.count("*").alias("held"), F.sum(F.expr(f"n div {capacity}")).alias("windows")), "counts")
    counts = {r[0]: r[1] for r in groups.where("tail > 0").groupBy("tail").agg(F.sum("held")).collect()}  # < capacity rows
    plan, _ = plan_windows(counts, capacity, tolerance)
    first_packed = groups.agg(F.coalesce(F.sum("windows"), F.lit(0))).head()[0]
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    cuts = np.searchsorted(plan[:, 0], np.arange(capacity + 1))
    before = F.sum("held").over(Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = groups.select("part", "tail", F.coalesce(before, F.lit(0)).alias("ranks_before")) \
        .join(offsets(groups, "part", "windows").withColumnRenamed("before", "windows_before"), "part")
    placed = rows.join(places, ["part", "tail"]).select(
        "doc_id", "n", "tail", (F.col("rank") + F.col("ranks_before")).cast("long").alias("rank"),
        (F.col("whole") + F.col("windows_before")).cast("long").alias("whole"), "ids")

    def pieces(batches):
        for found in texts(batches, "doc_id", "n", "tail", "rank", "whole", "ids"):
            out = []
            for doc, n, tail, rank, whole, data in zip(*found):
                ids = np.frombuffer(data, dtype).astype("<u4")
                cut = [(k * capacity, capacity, whole + k, 0) for k in range(n // capacity)]
                if tail:
                    part = plan[cuts[tail]:cuts[tail + 1]]
                    for _, r, _, start, length, window, per, slot, at in \
                            part[(part[:, 1] <= rank) & (rank < part[:, 1] + part[:, 2])].tolist():
                        j = slot + rank - r
                        cut.append((n - tail + start, length, first_packed + window + j // per, at + j % per * length))
                for start, length, sequence, at in sorted(cut):
                    piece = ids[start:start + length].tobytes()
                    out.append((doc, start, length, zlib.crc32(piece), n, sequence, at, piece if with_ids else None))
            cols = list(zip(*out)) or [()] * 8
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())],
                                  ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    out = placed.mapInArrow(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long, ids binary")
    return out if with_ids else out.drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the windows of ``pack(..., with_ids=True)``; a group holds one window."""
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), listed.alias("p")).select(
        "sequence_id", "length", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op3_pack": op3_pack}
ORACLES: dict[str, str] = {}
