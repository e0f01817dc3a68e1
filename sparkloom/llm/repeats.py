"""Removal of repeated passages with suffix arrays built by two-stage sorting.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

1. Equal texts are one class; copies of its first document go whole, only first documents are searched.
2. Each window of 50 bytes has an anchor, the 16-byte string in it with the smallest hash. Equal windows have
   equal anchors. A run of windows with one anchor is a context: the bytes they cover.
3. Texts lie in groups of about 8 MB. A group sends marks of its different contexts to slices of the anchors: 24
   bits of the anchor, 64 of the context, the smallest id, and 16 each of the 33 bytes that end and that begin with
   the anchor. Two bits come back. One says that an equal context has a smaller id: all windows go, the bytes stay
   where they are. The other says that a different context with the anchor may share a window and has another id:
   a window of 50 bytes holds 17 bytes before its anchor or 17 behind it, so one of the two 33-byte strings is
   equal. Only such contexts are cut out and meet by anchor; those that share a window with another one have their
   suffixes sorted, about a megabyte at a time: two-stage sorting sorts only suffixes that are smaller than their
   successors, by their first 56 bytes, and induces the others by scanning the buckets of first bytes. Neighbours
   with a common prefix of 50 bytes or more are one group; its smallest id is that of each of its windows.
4. An anchor with more than ``MANY`` different contexts (a common pair of words, say) would not fit one task: its
   contexts are cut into single windows, which are grouped by their bytes with partial minima.
5. Each text takes the windows whose smallest id is below its own.

Defined results: a null text is empty; texts of fewer than 50 bytes lose nothing; rows of one id do not remove
from each other; a null doc_id comes after all ids; repeated rows have equal results; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, drop, mix, stage, texts

LENGTH, GRAM = 50, 16
CONTEXT = 64  # windows in a context at most; longer runs are cut into several
MANY = 4096
CHUNK = 1 << 20
GROUP = 1 << 23
SIDE = (LENGTH - GRAM) // 2  # a window holds so many bytes before its anchor or behind it
NONE, ANY = 0, 65535  # instead of the 16 bits of a side: outside the context; the anchor occurs more than once
LAST = (1 << 63) - 1
_P = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each place on, by doubling."""
    h = mix(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < size:
        h = mix(h[:-step] * _P + h[step:])
        step *= 2
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (width - step)], h[width - step:]) if step < width else h


def contexts(found: list[bytes], compared: bool) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, windows, key, left, right) of each run of windows with one anchor.

    ``key`` is a hash of the context, ``left`` and ``right`` are 16 bits of the 33 bytes that end and begin with its
    anchor (ANY if not ``compared``).
    """
    sizes = np.array([len(t) for t in found])
    data = np.frombuffer(b"".join(found), np.uint8)
    empty = [np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.uint64, np.uint16, np.uint16)]
    if len(data) < LENGTH:
        return tuple(empty)
    grams = gram_hashes(data)
    low = sliding_min(grams, LENGTH - GRAM + 1)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(found)), sizes)[: len(low)]
    place = np.arange(len(low))
    inside = place + LENGTH <= ends[owner]
    low, owner, place = low[inside], owner[inside], place[inside]
    if not len(low):
        return tuple(empty)
    new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])]))
    long = np.diff(np.concatenate([new, [len(low)]]))
    cuts = -(-long // CONTEXT)
    within = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = np.repeat(new, cuts) + CONTEXT * within
    many = np.minimum(np.repeat(long, cuts) - CONTEXT * within, CONTEXT)
    owner, h, at = owner[first], low[first], place[first]
    halves = mix(grams[:-GRAM] * _P + grams[GRAM:])  # of 32 bytes; four cover a context
    end = at + many + LENGTH - 1
    key = mix(halves[at] + many.astype(np.uint64))
    for start in (at + 32, at + 64, end):
        key = mix(key * _P + halves[np.minimum(start, end - 32)])
    left, right = sides(grams, halves, h, at, many) if compared else [np.full(len(h), ANY, np.uint16)] * 2
    return owner, h, at - (ends - sizes)[owner], many, key, left, right


def sides(grams: np.ndarray, halves: np.ndarray, h: np.ndarray, at: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits each of the 33 bytes that end and that begin with the anchor, where they lie in the context."""
    count, where = np.zeros(len(h), np.int64), at.copy()
    width = LENGTH - GRAM + 1
    for k in range(width + int(many.max()) - 1):
        here = slice(None) if k < width else np.flatnonzero(many > k - width + 1)
        same = grams[at[here] + k] == h[here]
        count[here] += same
        where[here] += same * k
    single = count == 1
    where = np.where(single, where, at)
    out = []
    for start in (where - SIDE, where):
        held = (start >= at) & (start + GRAM + SIDE <= at + many + LENGTH - 1)
        x = np.where(held, start, at)
        bits = (mix(halves[x] * _P + grams[x + SIDE]) >> np.uint64(48)) % np.uint64(ANY - 1) + np.uint64(1)
        out.append(np.where(single, np.where(held, bits, NONE), ANY).astype(np.uint16))
    return out[0], out[1]


def chunks(*columns: list) -> list[tuple[list, ...]]:
    """Slices of parallel lists whose texts (the last list) hold about CHUNK bytes."""
    out, at, held = [], 0, 0
    for i, text in enumerate(columns[-1]):
        held += len(text)
        if held >= CHUNK or i == len(columns[-1]) - 1:
            out.append(tuple(c[at:i + 1] for c in columns))
            at, held = i + 1, 0
    return out


def suffix_array(t: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places of all suffixes in the order of (at least) their first 56 bytes, by two-stage sorting."""
    n = len(t)
    step = np.sign(t[1:].astype(np.int16) - t[:-1])
    decided = np.where(step != 0, np.arange(n - 1), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = np.zeros(n, bool)  # than its successor; the last suffix is larger than the empty one
    smaller[:-1] = np.concatenate([step, [-1]])[decided] > 0
    direct = np.flatnonzero(smaller)
    direct = direct[np.lexsort([words[direct + 8 * k] for k in range(6, -1, -1)])]
    bounds = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        layer = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        bucket = [layer]
        while len(layer):  # runs of one byte induce themselves
            layer = layer[layer > 0] - 1
            layer = layer[t[layer] == c]
            bucket.append(layer)
        full = np.concatenate([*bucket, direct[bounds[c]:bounds[c + 1]]])
        if not len(full):
            continue
        out.append(full)
        before = full[full > 0] - 1
        before = before[t[before] > c]
        if len(before):
            before = before[np.argsort(t[before], kind="stable")]
            edges = np.flatnonzero(np.concatenate([[True], t[before[1:]] != t[before[:-1]]]))
            for a, b in zip(edges, [*edges[1:], len(before)]):
                waiting[t[before[a]]].append(before[a:b])
    return np.concatenate(out)


def smallest_ids(found: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each window of each context, the smallest id among the contexts that hold the window."""
    sizes = np.array([len(c) for c in found])
    t = np.frombuffer(b"".join(found), np.uint8)
    padded = np.concatenate([t, np.zeros(72, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(t) + 64, np.uint64)
    for k in range(8):
        words |= padded[k:k + len(words)] << np.uint64(56 - 8 * k)
    order = suffix_array(t, words)
    owner = np.repeat(np.arange(len(found)), sizes)
    ends = np.cumsum(sizes)
    order = order[order + LENGTH <= ends[owner[order]]]
    same = np.ones(len(order) - 1, bool)  # common prefix of neighbours: 50 bytes or more
    for k in range(7):
        a, b = words[order[1:] + 8 * k], words[order[:-1] + 8 * k]
        same &= (a == b) if k < 6 else (a >> np.uint64(48)) == (b >> np.uint64(48))
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    low = np.minimum.reduceat(ids[owner[order]], starts)
    out = np.empty(len(t), np.int64)
    out[order] = np.repeat(low, np.diff(np.concatenate([starts, [len(order)]])))
    return [out[e - s:e - LENGTH + 1] for s, e in zip(sizes, ends)]


def _lists(values: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(values) if values else np.empty(0, np.int64)))


def numbered(distinct: DataFrame) -> DataFrame:
    """(g, u, d, th, text): texts counted by u, in groups g of consecutive ones that hold about GROUP bytes."""

    def number(batches):
        g = u = TaskContext.get().partitionId() << 33
        held = 0
        for batch in batches:
            sizes = np.cumsum([len(t) for found, in texts([batch], "text") for t in found], dtype=np.int64)
            group = g + (held + sizes) // GROUP
            held += int(sizes[-1]) if len(sizes) else 0
            yield pa.record_batch([pa.array(group, pa.int64()), pa.array(np.arange(u, u + len(sizes))),
                                   *(batch.column(batch.schema.get_field_index(n)) for n in ("d", "th", "text"))], ["g", "u", "d", "th", "text"])
            u += len(sizes)

    return distinct.select("d", "th", "text").mapInArrow(number, "g long, u long, d long, th binary, text string")


def entries(found: list[bytes], ds: list[int], parts: int, compared: bool = True) -> tuple[dict, dict]:
    """The contexts of some texts, and the different ones among them, ordered by slice of the anchors, anchor and key.

    Contexts: o (text), h, at, n, and e (number of its entry). Entries: part, h (24 bits), key, left, right, d (smallest id).
    """
    pieces, at = [], 0
    for part, in chunks(found):
        o, *rest = contexts(part, compared)
        pieces.append((o + at, *rest))
        at += len(part)
    o, h, at, n, key, left, right = (np.concatenate(c) for c in zip(*pieces))
    d = np.array(ds, np.int64)[o]
    mixed = mix(h)
    place = (mixed % np.uint64(parts)) << np.uint64(24) | mixed >> np.uint64(40)
    order = np.lexsort((key, place))
    p, k = place[order], key[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (k[1:] != k[:-1])
    e = np.empty(len(p), np.int64)
    e[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    firsts = order[starts]
    low = np.minimum.reduceat(d[order], starts) if len(starts) else d
    return {"o": o, "h": h, "at": at, "n": n, "e": e, "d": d}, {
        "part": (p[starts] >> np.uint64(24)).astype(np.int64), "h": p[starts].astype(np.uint32) & np.uint32((1 << 24) - 1),
        "key": k[starts], "left": left[firsts], "right": right[firsts], "d": low}


PLANES = (("h", np.uint32, 3), ("key", np.uint64, 8), ("left", np.uint16, 2), ("right", np.uint16, 2), ("d", np.int64, 8))


def packed(marks: dict, a: int, b: int) -> bytes:
    """Entries a to b, all first bytes, all second bytes and so on: bytes that hardly differ compress well."""
    return b"".join(marks[name][a:b].view(np.uint8).reshape(b - a, -1).T[:kept].tobytes() for name, _, kept in PLANES)


def unpacked(data: bytes) -> dict:
    n = len(data) // sum(kept for _, _, kept in PLANES)
    planes, out, at = np.frombuffer(data, np.uint8).reshape(-1, n), {}, 0
    for name, kind, kept in PLANES:
        x = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
        x[:, :kept] = planes[at:at + kept].T
        out[name], at = x.view(kind)[:, 0], at + kept
    return out


def marks_of(texts_table: DataFrame, parts: int) -> DataFrame:
    """(g, first, part, data): the entries of each run of texts of a group, by slice of the anchors; ``first`` is the run's first text."""

    def find(batches):
        at, us, ds, held = None, [], [], []

        def close():
            _, marks = entries(held, ds, parts)
            part = marks["part"]
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
            data = [packed(marks, a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            return pa.record_batch([pa.array([at] * len(data), pa.int64()), pa.array([us[0]] * len(data), pa.int64()),
                                    pa.array(part[edges[:-1]]), pa.array(data, pa.binary())], ["g", "first", "part", "data"])

        for columns in texts(batches, "g", "u", "d", "text"):
            for g, u, d, text in zip(*columns):
                if us and (g != at or u != us[-1] + 1):  # a file may be read in pieces
                    yield close()
                    us, ds, held = [], [], []
                at = g
                us.append(u)
                ds.append(d)
                held.append(text)
        if us:
            yield close()

    return texts_table.select("g", "u", "d", "text").mapInArrow(find, "g long, first long, part long, data binary")


def differing(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which members of a bucket are in one whose members have different values."""
    if not len(bucket):
        return np.zeros(0, bool)
    order = np.argsort(bucket, kind="stable")
    b, x = bucket[order], low[order]
    starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    out = np.empty(len(b), bool)
    out[order] = np.repeat(np.minimum.reduceat(x, starts) != np.maximum.reduceat(x, starts), np.diff(np.concatenate([starts, [len(b)]])))
    return out


def judge(h: np.ndarray, key: np.ndarray, left: np.ndarray, right: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Per entry: 1 if an equal context has a smaller id, 2 if it is the first and may share windows with one of another id."""
    order = np.lexsort((key, h))
    h, key, d = h[order], key[order], d[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (key[1:] != key[:-1])])
    starts, kind = np.flatnonzero(new), np.cumsum(new) - 1
    low = np.minimum.reduceat(d, starts)
    h, left, right = h[starts].astype(np.uint64), left[order][starts], right[order][starts]
    meet = np.zeros(len(low), bool)
    unclear = np.isin(h, h[left == ANY])
    meet[unclear] = differing(h[unclear], low[unclear])
    for side in (left, right):
        some = np.flatnonzero(~unclear & (side != NONE))
        meet[some] |= differing(h[some] << np.uint64(16) | side[some], low[some])
    out = np.empty(len(d), np.uint8)
    out[order] = np.where(d > low[kind], 1, 2 * meet[kind])
    return out


def judged(marks: DataFrame) -> DataFrame:
    """(g, first, part, said): what ``judge`` says of the entries, one slice of the anchors at a time."""

    def answer(batches):
        part, names, held = None, [], []

        def close():
            every = [unpacked(x) for x in held]
            said = judge(*(np.concatenate([x[n] for x in every]) for n, _, _ in PLANES))
            edges = np.cumsum([0] + [len(x["d"]) for x in every])
            said = [said[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            return pa.record_batch([*(pa.array(c, pa.int64()) for c in zip(*names)), pa.array([part] * len(said), pa.int64()),
                                    pa.array(said, pa.binary())], ["g", "first", "part", "said"])

        for columns in texts(batches, "g", "first", "part", "data"):
            for g, first, p, data in zip(*columns):
                if names and p != part:
                    yield close()
                    names, held = [], []
                part = p
                names.append((g, first))
                held.append(data)
        if names:
            yield close()

    return marks.repartition("part").sortWithinPartitions("part").mapInArrow(answer, "g long, first long, part long, said binary")


def contexts_of(texts_table: DataFrame, said: DataFrame, parts: int) -> DataFrame:
    """(h, key, context, d, u, at, stop): contexts that have to be compared; key is a 128-bit hash of the context.

    Of equal ones in a run of texts only the first has its bytes. Rows without a key are ranges that go: ``at`` to ``stop``.
    """
    names = ["h", "key", "context", "d", "u", "at", "stop"]

    def resolve(us, ds, found, said):
        if not found or not said:
            return
        each, marks = entries(found, ds, parts, compared=False)
        said = np.frombuffer(b"".join(said), np.uint8)
        if len(said) != len(marks["d"]):
            raise RuntimeError("contexts and what was said of them differ in number")
        e, us = each["e"], np.array(us, np.int64)[each["o"]]
        stop = each["at"] + each["n"] + LENGTH - 1
        gone = (said[e] == 1) | (each["d"] > marks["d"][e])
        i = np.flatnonzero(gone)
        if len(i):
            new = np.flatnonzero(np.concatenate([[True], (us[i[1:]] != us[i[:-1]]) | (each["at"][i[1:]] > stop[i[:-1]])]))
            last = np.concatenate([new[1:] - 1, [len(i) - 1]])
            none = pa.nulls(len(new), pa.int64())
            yield pa.record_batch([none, pa.nulls(len(new), pa.binary()), pa.nulls(len(new), pa.binary()), none, pa.array(us[i[new]]),
                                   pa.array(each["at"][i[new]]), pa.array(stop[i[last]])], names)
        i = np.flatnonzero((said[e] == 2) & ~gone)
        if len(i):
            cut = [found[o][a:b] for o, a, b in zip(each["o"][i].tolist(), each["at"][i].tolist(), stop[i].tolist())]
            first = np.zeros(len(i), bool)
            first[np.unique(e[i], return_index=True)[1]] = True
            yield pa.record_batch([
                pa.array(each["h"][i].view(np.int64)), pa.array([xxhash.xxh3_128_digest(c) for c in cut], pa.binary()),
                pa.array([c if x else None for c, x in zip(cut, first.tolist())], pa.binary()), pa.array(each["d"][i]), pa.array(us[i]),
                pa.array(each["at"][i]), pa.nulls(len(i), pa.int64())], names)

    def group(us, ds, found, answers):
        """Runs of texts begin at the texts that answers name; those in between without one have no contexts."""
        edges = np.searchsorted(us, [*answers, us[-1] + 1]) if us else []
        for a, b, said in zip(edges[:-1], edges[1:], answers.values()):
            yield from resolve(us[a:b], ds[a:b], found[a:b], said)

    def cut(batches):
        at, us, ds, found, answers = None, [], [], [], {}
        for columns in texts(batches, "g", "u", "d", "text", "said"):
            for g, u, d, text, said in zip(*columns):
                if g != at:
                    yield from group(us, ds, found, answers)
                    at, us, ds, found, answers = g, [], [], [], {}
                if said is None:
                    us.append(u)
                    ds.append(d)
                    found.append(text)
                else:
                    answers.setdefault(u, []).append(said)
        yield from group(us, ds, found, answers)

    none = F.lit(None)
    rows = texts_table.select("g", "u", "d", "text", none.cast("long").alias("part"), none.cast("binary").alias("said")).unionAll(
        said.select("g", F.col("first").alias("u"), none.cast("long").alias("d"), none.cast("string").alias("text"), "part", "said"))
    return rows.repartition("g").sortWithinPartitions("g", "u", "part").mapInArrow(
        cut, "h long, key binary, context binary, d long, u long, at long, stop long")


def shared_contexts(found: list[bytes]) -> np.ndarray:
    """Which contexts have a window that stands elsewhere among them, too (by its hash; a few too many do no harm)."""
    sizes = np.array([len(c) for c in found])
    half = gram_hashes(np.frombuffer(b"".join(found), np.uint8), 32)
    window = mix(half[: len(half) - (LENGTH - 32)] * _P + half[LENGTH - 32:])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(found)), sizes)[: len(window)]
    inside = np.arange(len(window)) + LENGTH <= ends[owner]
    window, owner = window[inside], owner[inside]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    out = np.zeros(len(found), bool)
    out[owner[order[1:][same]]] = True
    out[owner[order[:-1][same]]] = True
    return out


def sorted_minima(rows: DataFrame) -> DataFrame:
    """(key, low): by suffix arrays over whole anchors, about CHUNK bytes at a time.

    A context that is alone with its anchor has nothing to be sorted with; one that shares no window with another
    is left out of the sort, and of the result if only one text holds it.
    """

    def resolve(batches):
        hs, keys, found, ds, often, held = [], [], [], [], [], 0

        def close():
            h, d, n = np.array(hs), np.array(ds, np.int64), np.array(often)
            low = [np.full(len(c) - LENGTH + 1, x) for c, x in zip(found, ds)]
            alone = np.concatenate([[True], h[1:] != h[:-1]]) & np.concatenate([h[1:] != h[:-1], [True]])
            rest = np.flatnonzero(~alone)
            if len(rest):
                rest = rest[shared_contexts([found[i] for i in rest])]
            if len(rest):
                for i, x in zip(rest, smallest_ids([found[i] for i in rest], d[rest])):
                    low[i] = x
            kept = n > 1
            kept[rest] = True
            kept = np.flatnonzero(kept)
            return pa.record_batch([pa.array([keys[i] for i in kept], pa.binary()), _lists([low[i] for i in kept])], ["key", "low"])

        for columns in texts(batches, "h", "key", "context", "d", "n"):
            for h, key, c, d, n in zip(*columns):
                if held >= CHUNK and h != hs[-1]:
                    yield close()
                    hs, keys, found, ds, often, held = [], [], [], [], [], 0
                hs.append(h)
                keys.append(key)
                found.append(c)
                ds.append(d)
                often.append(n)
                held += len(c)
        if hs:
            yield close()

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(resolve, "key binary, low array<long>")


def grouped_minima(rows: DataFrame) -> DataFrame:
    """(key, low) for anchors of too many contexts: single windows, grouped by their bytes."""
    count = F.length("context") - (LENGTH - 1)
    each = rows.withColumn("i", F.explode(F.sequence(F.lit(1), count))) \
        .select("key", "d", "i", F.substring(F.col("context"), F.col("i"), F.lit(LENGTH)).alias("window"))
    low = each.groupBy("window").agg(F.min("d").alias("low"))
    back = each.join(low, "window").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "low"))).alias("l"))
    return back.select("key", F.col("l.low").alias("low"))


def removed_ranges(rows: DataFrame, low: DataFrame) -> DataFrame:
    """(u, start, stop): runs of bytes to remove, one or more per context."""

    def cut(batches):
        for batch in batches:
            us, ats, ds = (np.asarray(batch.column(i)) for i in range(3))
            lists = batch.column(3)
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            sizes = np.diff(offsets)
            owner = np.repeat(np.arange(len(us)), sizes)
            place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes) + ats[owner]
            gone = flat[offsets[0]:offsets[-1]] < ds[owner]
            owner, place = owner[gone], place[gone]
            if len(owner):
                new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)]))
                last = np.concatenate([new[1:] - 1, [len(owner) - 1]])
                yield pa.record_batch([pa.array(us[owner[new]]), pa.array(place[new]), pa.array(place[last] + LENGTH)], ["u", "start", "stop"])

    return rows.select("key", "u", "at", "d").join(low, "key").select("u", "at", "d", "low") \
        .mapInArrow(cut, "u long, start long, stop long")


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The result of every row of ``rows(doc_id, d, th, text)``; ``found(th, first, ranges)`` has one row per text.

    A copy of a text whose first document has a smaller id goes whole.
    """

    def apply(batches):
        for ids, ds, firsts, lists, found_texts in texts(batches, "doc_id", "d", "first", "ranges", "text"):
            out = []
            for d, first, text, here in zip(ds, firsts, found_texts, lists):
                spans = [[0, len(text)]] if d > first and len(text) >= LENGTH else \
                    merged([(r["start"], r["stop"]) for r in here or []])
                at, kept = 0, []
                for start, stop in spans:
                    kept.append(text[at:start])
                    at = stop
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                  ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.join(found, "th").select("doc_id", "d", "first", "ranges", "text").mapInArrow(
        apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.unhex(F.md5("text")).alias("th"), "text")
    distinct = rows.groupBy("th").agg(F.min("d").alias("d"), F.first("text").alias("text"))
    found = stage(numbered(distinct), "texts")
    names = stage(found.select("u", "th", F.col("d").alias("first")), "names")

    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    said = stage(judged(marks_of(found, parts)), "said")
    cut = stage(contexts_of(found, said, parts), "contexts")
    drop(found, said)
    equal = cut.where("key is null").select("u", F.col("at").alias("start"), "stop")
    cut = cut.where("key is not null")
    different = stage(cut.groupBy("key").agg(F.min("d").alias("d"), F.count("*").alias("n"), F.first("h").alias("h"),
                                             F.first("context", ignorenulls=True).alias("context")), "different")
    many = stage(different.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("h"), "many")
    low = sorted_minima(different.join(many, "h", "left_anti"))
    if not many.isEmpty():
        low = low.unionAll(grouped_minima(different.join(many, "h", "left_semi")))
    low = stage(low, "low")
    drop(different)
    ranges = stage(removed_ranges(cut, low).unionAll(equal), "ranges")
    drop(cut, low)
    per = ranges.groupBy("u").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))  # bounded by the text
    return digests(rows, names.join(per, "u", "left").select("th", "first", "ranges"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


QUERIES = {"op8_repeats": op8_repeats}
ORACLES: dict[str, str] = {}
