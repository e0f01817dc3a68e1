"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

1. Texts with the same set of five-word shingles are one class (128-bit fingerprint, partial aggregates).
2. SuperMinHash: each shingle gives every slot a correlated permutation rank, step j of its own shuffle lands in
   one slot with rank j + a fraction. Ranks only grow with j, so a text stops as soon as no slot can still
   improve; a text of many shingles is done after two or three steps.
3. Bands of four slots: classes that share a band meet. Nothing lists all pairs of a band: in ``TURNS`` turns, each
   band draws one member by hash, and each class keeps the drawn member of another component whose signature agrees
   best with its own; confirmed links join components. So a turn confirms at most one pair for each class.
4. Bands that still hold several components are searched for the links between them by prefix filtering, which
   loses none: shingles are ordered by how many of these classes hold them, and two sets of similarity 0.75 share
   one of their rarest shingles, at places that the sizes bound. A passage that thousands of texts share is not
   rare, so it makes no pairs; shingles that stand in one component only are dropped before they meet.
5. A pair is confirmed on the full sets, 100 * intersection >= 75 * union, if its sizes allow that and its
   signatures agree in half of the slots (six standard errors below 0.75).
6. Components by union-find rounds on the confirmed links.

With 32 bands of four slots a pair of similarity 0.75 shares a band but for 5 in a million.

Defined results: null or empty texts have no shingles and are linked with nothing; a text of fewer than five
words is one shingle; a null doc_id joins the group of its text (component_id is then the group's smallest id,
or null without any); repeated rows are all kept or all dropped; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import components, documents, mix, ready, shingles, stage, texts, word_hashes

SIZE = 5
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
TURNS = 2
STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set: ranks as step << 24 | fraction, one row per set."""
    h = np.full((len(sets), slots), 0xFFFFFFFF, np.uint32)
    flat = h.reshape(-1)
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None
    for j in range(slots):
        if not len(items):
            break
        draw = mix(items + np.uint64((j + 1) * int(STEP) & 0xFFFFFFFFFFFFFFFF))
        k = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = k
        else:
            rows = np.arange(len(items))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        rank = np.uint32(j << 24) | (draw >> np.uint64(40)).astype(np.uint32)
        np.minimum.at(flat, owner * slots + slot, rank)
        going = (h.max(axis=1) >= np.uint32((j + 1) << 24))[owner] if j + 1 < slots else np.zeros(len(owner), bool)
        if order is None and going.any():  # the shuffles are needed from the second step on
            items, owner, k = items[going], owner[going], k[going]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(items), 1))
            order[np.arange(len(items)), k] = 0
        elif not going.all():
            items, owner = items[going], owner[going]
            order = order[going] if order is not None else None
    return h


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * STEP, rows.shape[:2]).copy()
    for r in range(rows.shape[2]):
        key = mix(key ^ rows[:, :, r]) + STEP
    return key.view(np.int64)


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), SIZE))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n_shingles, set_id, bands, signature (lowest byte of each slot) of every row."""

    def sign(batches):
        for ids, keys_of, found in texts(batches, "doc_id", "text_id", "text"):
            at = 0
            while at < len(found):  # about 100,000 shingles at a time
                sets, held = [], 0
                while at + len(sets) < len(found) and held < 100_000:
                    sets.append(shingle_set(found[at + len(sets)]))
                    held += len(sets[-1])
                sig = signatures(sets)
                keys = band_keys(sig)
                n = len(sets)
                yield pa.record_batch([
                    pa.array(ids[at:at + n], pa.int64()), pa.array(keys_of[at:at + n], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1))),
                    pa.array([x.tobytes() for x in (sig & 0xFF).astype(np.uint8)], pa.binary())],
                    ["doc_id", "text_id", "n_shingles", "set_id", "bands", "signature"])
                at += n

    return docs.mapInArrow(sign, "doc_id long, text_id binary, n_shingles long, set_id binary, bands array<long>, signature binary")


def agreement(pairs: DataFrame) -> DataFrame:
    """``pairs(a, b, na, nb, sa, sb)`` whose sizes and signatures allow a similarity of 0.75: (a, b, agree)."""
    sized = pairs.where("least(na, nb) * 100 >= greatest(na, nb) * 75").select("a", "b", "sa", "sb")

    def agree(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (2, 3))
            same = np.count_nonzero(x == y, axis=1)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(same.astype(np.int32))],
                                  ["a", "b", "agree"]).filter(pa.array(same >= SLOTS // 2))

    return sized.mapInArrow(agree, "a long, b long, agree int")


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a similarity of 0.75."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    return agreement(pairs.join(b, "b").join(a, "a")).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 75 * union of the full sets."""
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                inside = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * inside >= 75 * (len(both) - inside))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(b, "b").join(a, "a").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n_shingles, items): the sorted shingle hashes of classes, from the text of their first document."""

    def build(batches):
        for found, in texts(batches, "text"):
            sets = [shingle_set(t) for t in found]
            yield pa.record_batch([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                                   pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "items"])

    named = docs.join(nodes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    if not nodes.where("rep is null").isEmpty():
        named = named.union(docs.where("doc_id is null"))
    found = named.select("text").mapInArrow(build, "set_id binary, items binary")
    return nodes.select("node", "set_id", "n_shingles").join(found, "set_id").dropDuplicates(["node"]).drop("set_id")


def contested(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(band, node, root) of the bands whose members are in several components."""
    own = members.withColumn("root", F.col("node")) if roots is None else \
        members.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    own = stage(own, "own")
    mixed = own.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    return stage(own.join(mixed, "band"), "contested")


def star_pairs(own: DataFrame, nodes: DataFrame, turn: int) -> DataFrame:
    """Each node of a contested band with the most similar drawn member of another component: at most one pair a node."""
    known = own.join(nodes.select("node", "n_shingles", "signature"), "node")
    draw = F.xxhash64("node", "band", F.lit(turn))  # each band draws anew, so a group meets many of its members
    drawn = known.groupBy("band").agg(F.min(F.struct(draw, "node", "root", "n_shingles", "signature")).alias("d"))
    met = known.join(drawn, "band").where("root <> d.root").select(
        F.col("node").alias("a"), F.col("d.node").alias("b"), F.col("n_shingles").alias("na"), F.col("d.n_shingles").alias("nb"),
        F.col("signature").alias("sa"), F.col("d.signature").alias("sb"))
    best = agreement(met).groupBy("a").agg(F.max(F.struct("agree", F.xxhash64("a", "b"), "b")).alias("m"))
    return best.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()


def prefix_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of ``nodes(node, root)`` of different components that share a shingle rare enough for 0.75."""

    def spread(batches):
        for names, roots, sizes, found in texts(batches, "node", "root", "n_shingles", "items"):
            for name, root, size, items in zip(names, roots, sizes, found):
                each = np.frombuffer(items, np.int64)
                yield pa.record_batch([pa.array(np.full(len(each), x, np.int64)) for x in (name, root, size)] + [pa.array(each)],
                                      ["node", "root", "n", "shingle"])

    each = stage(nodes.join(sets, "node").select("node", "root", "n_shingles", "items").mapInArrow(
        spread, "node long, root long, n long, shingle long"), "shingles")
    often = each.groupBy("shingle").agg(F.count("*").alias("df"))
    ranked = each.join(often, "shingle").groupBy("node", "root", "n").agg(  # a list is bounded by its text
        F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("items"))
    prefix = ranked.withColumn("items", F.slice("items", F.lit(1), (F.col("n") - F.ceil(F.col("n") * 75 / 100) + 1).cast("int")))
    posted = stage(prefix.select("node", "root", "n", F.posexplode("items").alias("place", "item")).where("item.df > 1")
                   .select("node", "root", "n", "place", F.col("item.shingle").alias("shingle")), "prefixes")
    mixed = posted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    posted = stage(posted.join(mixed.select("shingle"), "shingle"), "postings")
    x, y = posted.alias("x"), posted.alias("y")
    needed = F.ceil((F.col("x.n") + F.col("y.n")) * 75 / 175)
    met = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) \
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * 75) \
        & (F.col("x.place") <= F.col("x.n") - needed) & (F.col("y.place") <= F.col("y.n") - needed)
    return x.join(y, met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n_shingles, root, component_id of every row; without shingles root is null."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text_id"), F.col("text").cast("string").alias("text"))
    rows = stage(fingerprints(docs), "signatures")
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("signature").alias("signature"))
    nodes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    each = nodes.select(F.explode("bands").alias("band"), "node")
    shared = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = stage(each.join(shared, "band"), "bands")
    sets = stage(full_sets(docs, nodes.join(members.select("node").distinct(), "node", "left_semi")), "sets")
    links, roots = None, None
    for turn in range(TURNS + 1):
        own = contested(members, roots)
        if own.isEmpty():
            break
        pairs = star_pairs(own, nodes, turn) if turn < TURNS else \
            plausible(prefix_pairs(own.select("node", "root").distinct(), sets), nodes)
        more = stage(confirmed(stage(pairs, "pairs"), sets), "links")
        links = more if links is None else links.union(more)
        roots = components(links)

    named = nodes.select("node", "set_id", "rep", F.col("node").alias("root")) if roots is None else \
        nodes.join(roots, "node", "left").select("node", "set_id", "rep", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_set = named.join(smallest, "root").select("set_id", "root", "component_id")
    filled = rows.where("n_shingles > 0").select("doc_id", "text_id", "n_shingles", "set_id").join(of_set, "set_id") \
        .select("doc_id", "text_id", "n_shingles", "root", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "text_id", "n_shingles", F.lit(None).cast("long").alias("root"),
                                                F.col("doc_id").alias("component_id"))
    return filled.unionAll(empty)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    found = grouped(docs.withColumn("text_id", F.lit(None).cast("binary")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def text_id() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: of its smallest id the text of smallest hash, ids before rows without one.

    Texts without shingles are in no group: of repeated rows of one id one stays, and all rows without an id.
    """
    ready(spark, 8 << 20)
    found = stage(grouped(docs.withColumn("text_id", text_id())), "grouped")
    each = found.groupBy("root", "doc_id", "text_id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_id", "n"))
    kept = stage(each.where("root is not null").groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.text_id", "k.n")
                 .unionAll(each.where("root is null and doc_id is not null").select("doc_id", "text_id", "n")), "kept")
    kept = kept.select(F.col("doc_id").alias("__doc"), F.col("text_id").alias("__id"), "n")
    rows = docs.withColumn("__text", text_id())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__id"))
    once = rows.join(kept.where("n = 1"), same, "left_semi").select(*docs.columns)
    again = rows.join(kept.where("n > 1"), same, "left_semi").dropDuplicates(["doc_id", "__text"]).select(*docs.columns)
    bare = stage(found.where("root is null and doc_id is null").select("text_id").distinct(), "bare")
    without = rows.where("doc_id is null").join(bare.select(F.col("text_id").alias("__text")), "__text", "left_semi")
    return once.unionAll(again).unionAll(without.select(*docs.columns))


QUERIES = {"op6_near_dedup": op6_near_dedup}
ORACLES: dict[str, str] = {}
