"""Merkle manifest of a dataset, with leaf coordinates by bitmap ranks.

A leaf is the hash of one row. Leaves of a group (``lang``) stand in ascending order of doc_id; every 8 in a row
become their hash until one node is left, the group's subroot; subroots in the order of their groups become the
root in the same way.

1. No leaf is sorted. The doc_ids of a group are merged into bitmaps of 2^15 ids (partial aggregates; parquet and
   shuffles compress them), one per binary digit of the number of rows that hold an id, so repeated ids count as
   often as they stand. A popcount directory in two levels gives the rows before each bitmap; a leaf's coordinate
   is that plus the popcounts of its bitmaps below its own bit.
2. Only rows whose ids do not tell them apart (several different rows of one id, or without an id) are placed
   among each other by their hashes, in a range-partitioned count. Equal rows are one entry with a count until the
   end, since they only differ in their coordinate.
3. A leaf's coordinate is its key: leaf i has slot i mod 4096 of array i div 4096. An array is reduced by four
   levels of eight at once; its last node is a slot of the next array, so 2^36 leaves take three rounds. Each node
   passes its siblings (left and right ones of each level) down to its leaves, where a proof is put together and
   the root is folded from the leaf, the tampered one where there is one, and the untouched siblings.

Defined results: nulls are ``-``, rows without a doc_id stand before all others of their group and are never
tampered with; a null group is a group of its own before all others; different rows of one id stand in the order
of their hashes, repeated rows are leaves of their own; a table of one row has its leaf as root and a proof of no
siblings; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, offsets, stage

FAN, LEVELS = 8, 4
ARRAY = FAN ** LEVELS  # slots of one array
BITS = 15  # ids of one bitmap
SUPER = 10  # bitmaps of one upper entry of the directory
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def small_letters(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_hash(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(text if n == "text" else F.col(n)) for n in FIELDS]), 256))


def leaves(docs: DataFrame, every: int = 3) -> DataFrame:
    """(lang, doc_id, leaf, other) of every row; ``other`` is the tampered leaf, or null where the row stays."""
    text, tampered = F.col("text").cast("string"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), F.col("lang").cast("string").alias("lang"),
                       F.col("n_chars"), text.alias("text"))
    return rows.select("lang", "doc_id", leaf_hash(F.col("text")).alias("leaf"),
                       F.when(tampered, leaf_hash(small_letters(F.col("text")))).alias("other"))


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null meeting null; the other columns of ``right`` are added."""
    other = right.select(*[F.col(k).alias("__" + k) for k in keys], *[c for c in right.columns if c not in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col("__" + k))
    return left.join(other, match, how).drop(*["__" + k for k in keys])


def directory(ids: DataFrame) -> DataFrame:
    """(lang, bucket, before, slices): rows before each bitmap and its bitmaps, from ``ids(lang, doc_id, n)``.

    ``slices`` holds (digit, bitmap): an id's bit is set in the bitmaps of the binary digits of its number of rows.
    """
    digits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: F.getbit(F.col("n"), k) == 1)
    each = ids.select("lang", F.shiftright("doc_id", BITS).alias("bucket"), F.explode(digits).alias("digit"),
                      F.col("doc_id").bitwiseAND((1 << BITS) - 1).alias("bit"))
    maps = each.groupBy("lang", "bucket", "digit").agg(F.bitmap_construct_agg("bit").alias("bits"))
    held = stage(maps.groupBy("lang", "bucket").agg(
        F.collect_list(F.struct("digit", "bits")).alias("slices"),  # at most 63 bitmaps of 4 KB
        F.sum(F.call_function("shiftleft", F.bitmap_count("bits"), F.col("digit"))).alias("held")), "bitmaps")
    upper = held.groupBy("lang", F.shiftright("bucket", SUPER).alias("super")).agg(F.sum("held").alias("total"))
    so_far = (Window.unboundedPreceding, -1)
    upper = upper.withColumn("above", F.sum("total").over(Window.partitionBy("lang").orderBy("super").rowsBetween(*so_far)))
    inside = Window.partitionBy("lang", "super").orderBy("bucket").rowsBetween(*so_far)
    lower = held.select("lang", "bucket", F.shiftright("bucket", SUPER).alias("super"), "held") \
        .withColumn("inside", F.sum("held").over(inside))
    before = joined(lower, upper.drop("total"), ["lang", "super"]).select(
        "lang", "bucket", (F.coalesce("above", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("before"))
    return joined(held.select("lang", "bucket", "slices"), before, ["lang", "bucket"])


def rank(before: Column, slices: Column, bit: Column) -> Column:
    """Rows with a smaller id: those before the bitmap and the popcounts below ``bit``, by digit."""
    whole = F.shiftright(bit, 3)
    mask = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(7)) - 1

    def below(bits: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, whole + 1, F.lit(1))), 16, 10).cast("int")
        return F.bitmap_count(F.substring(bits, F.lit(1), whole)) + F.bit_count(byte.bitwiseAND(mask))

    return before + F.aggregate(slices, F.lit(0).cast("long"), lambda a, s: a + F.call_function(
        "shiftleft", below(s["bits"]).cast("long"), s["digit"]))


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, doc_id, leaf, other, place) of every row, (lang, leaves)): coordinates from 0 in each group."""
    kinds = stage(rows.groupBy("lang", "doc_id", "leaf").agg(F.count("*").alias("n"), F.first("other").alias("other")), "leaves")
    per_id = kinds.groupBy("lang", "doc_id").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    per_id = stage(per_id, "ids")
    groups = stage(per_id.groupBy("lang").agg(
        F.sum("n").alias("leaves"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("bare")), "groups")
    with_id = kinds.where("doc_id is not null").withColumn("bucket", F.shiftright("doc_id", BITS))
    found = joined(with_id, directory(per_id.where("doc_id is not null")), ["lang", "bucket"])
    bit = F.col("doc_id").bitwiseAND((1 << BITS) - 1).cast("int")
    found = found.select("lang", "doc_id", "leaf", "other", "n", rank(F.col("before"), F.col("slices"), bit).alias("place"))
    found = found.unionAll(kinds.where("doc_id is null").select("lang", "doc_id", "leaf", "other", "n", F.lit(0).cast("long")))
    shared = per_id.where("kinds > 1").select("lang", "doc_id")
    if not shared.isEmpty():
        found = joined(found, among(joined(kinds.drop("other"), shared, ["lang", "doc_id"])), ["lang", "doc_id", "leaf"], "left") \
            .withColumn("place", F.col("place") + F.coalesce("earlier", F.lit(0))).drop("earlier")
    bare = F.when(F.col("doc_id").isNotNull(), F.col("bare")).otherwise(0)  # rows without an id come first
    found = joined(found, groups.select("lang", "bare"), ["lang"]).withColumn("place", F.col("place") + bare).drop("bare")
    many = found.where("n > 1")  # equal rows: one leaf each, spread before they are counted out
    runs = many.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {ARRAY})"))).repartition("lang", "doc_id", "leaf", "run")
    each = F.explode(F.expr(f"sequence(run * {ARRAY}, least(n, (run + 1) * {ARRAY}) - 1)"))
    copies = runs.withColumn("copy", each).withColumn("place", F.col("place") + F.col("copy"))
    names = ["lang", "doc_id", "leaf", "other", "place"]
    return found.where("n = 1").select(*names).unionAll(copies.select(*names)), groups


def among(kinds: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, earlier): rows of the same id with a smaller hash, by a range-partitioned count."""
    keys = ["lang", "doc_id"]
    ranged = stage(kinds.repartitionByRange(*keys, "leaf").withColumn("part", F.spark_partition_id()), "shared")
    so_far = (Window.unboundedPreceding, -1)
    inside = F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("leaf").rowsBetween(*so_far))
    ends = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("total"))
    ends = ends.withColumn("above", F.sum("total").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(*so_far)))
    return joined(ranged.withColumn("inside", inside), ends.drop("total"), [*keys, "part"]).select(
        *keys, "leaf", (F.coalesce("inside", F.lit(0)) + F.coalesce("above", F.lit(0))).alias("earlier"))


# one array of slots: up to four levels of eight

def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels until one node of ``n`` is left, at most those of one array."""
    out = 0
    while n > 1 and out < LEVELS:
        n, out = -(-n // FAN), out + 1
    return out


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from the slots up to the last one."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest("".join(out[-1][i:i + FAN])) for i in range(0, len(out[-1]), FAN)])
    return out


def path_of(levels: list[list[str]], slot: int) -> list[dict[str, str]]:
    """Left and right siblings of a slot, level by level."""
    out = []
    for nodes in levels[:-1]:
        begin = slot - slot % FAN
        out.append({"left": "".join(nodes[begin:slot]), "right": "".join(nodes[slot + 1:begin + FAN])})
        slot //= FAN
    return out


def fold(leaf: str, path: list[dict[str, str]]) -> str:
    for step in path:
        leaf = digest(step["left"] + leaf + step["right"])
    return leaf


def slot_array(slots: list[dict], name: str) -> list:
    out = [None] * len(slots)
    for s in slots:
        out[s["slot"]] = s[name]
    return out


def array_of() -> Column:
    return F.expr(f"place div {ARRAY}")


def each_row(batch: pa.RecordBatch):
    """One row at a time: an array of slots is large as Python objects."""
    for i in range(batch.num_rows):
        yield [c[i].as_py() for c in batch.columns]


def arrays(nodes: DataFrame, *more: str) -> DataFrame:
    """(lang, array, slots) from (lang, place, node, ...): at most 4096 slots a row."""
    slot = F.struct((F.col("place") % ARRAY).cast("int").alias("slot"), "node", *more)
    return nodes.groupBy("lang", array_of().alias("array")).agg(F.collect_list(slot).alias("slots"))


def reduce_arrays(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, place, node): the last node of each array, a slot of the next round; ``sizes(lang, leaves)``."""

    def up(batches):
        for batch in batches:
            last = []
            for _, _, slots, n in each_row(batch):
                nodes = [x.hex() for x in slot_array(slots, "node")]
                last.append(bytes.fromhex(reduced(nodes, levels_of(n))[-1][0]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(last, pa.binary())], ["lang", "place", "node"])

    known = joined(held.select("lang", "array", F.transform("slots", lambda s: F.struct(s["slot"], s["node"])).alias("slots")),
                   sizes, ["lang"]).select("lang", "array", "slots", "leaves")
    return known.mapInArrow(up, "lang string, place long, node binary")


def node_paths(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, place, path): the siblings of every slot within its array."""

    def siblings(batches):
        for batch in batches:
            for lang, array, slots, n in each_row(batch):
                levels = reduced([x.hex() for x in slot_array(slots, "node")], levels_of(n))
                for begin in range(0, len(slots), 256):
                    part = range(begin, min(begin + 256, len(slots)))
                    yield pa.record_batch([
                        pa.array([lang] * len(part), pa.string()), pa.array([array * ARRAY + i for i in part], pa.int64()),
                        pa.array([path_of(levels, i) for i in part],
                                 pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))], ["lang", "place", "path"])

    known = joined(held, sizes, ["lang"]).select("lang", "array", "slots", "leaves")
    return known.mapInArrow(siblings, f"lang string, place long, path {PATH}")


def tree(held: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, array, path) above each array of the leaves, (lang, node) last nodes), round by round."""
    rounds, top = [], sizes.agg(F.max("leaves")).head()[0] or 1
    nodes = stage(reduce_arrays(held, sizes), "nodes")
    while top > ARRAY:
        sizes = sizes.select("lang", F.ceil(F.col("leaves") / ARRAY).cast("long").alias("leaves"))
        upper = stage(arrays(nodes), "arrays")
        rounds.append(node_paths(upper, sizes))
        nodes, top = stage(reduce_arrays(upper, sizes), "nodes"), -(-top // ARRAY)
    above = nodes.select("lang", "place", F.array().cast(PATH).alias("path"))
    for own in reversed(rounds):  # from the top: own siblings, then those of the array's last node
        upper = above.select("lang", F.col("place").alias("array"), F.col("path").alias("higher"))
        each = own.withColumn("array", array_of())
        above = stage(joined(each, upper, ["lang", "array"]).select("lang", "place", F.concat("path", "higher").alias("path")), "paths")
    return above.withColumnRenamed("place", "array"), nodes.select("lang", "node")


def in_order(subroots: DataFrame) -> DataFrame:
    """(lang, place, node): groups in the order of their names (UTF-8 bytes, null first), counted by range."""
    ranged = stage(subroots.repartitionByRange("lang").withColumn("part", F.spark_partition_id()), "subroots")
    counted = offsets(ranged.withColumn("one", F.lit(1)), "part", "one")
    inside = F.row_number().over(Window.partitionBy("part").orderBy("lang")) - 1
    return ranged.withColumn("inside", inside).join(counted, "part").select(
        "lang", (F.col("inside") + F.col("before")).cast("long").alias("place"), "node")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    rows, groups = placed(leaves(docs))
    held = stage(arrays(rows.withColumnRenamed("leaf", "node"), "doc_id", "other"), "arrays")
    sizes = groups.select("lang", "leaves")
    above, subroots = tree(held, sizes)
    named = stage(in_order(subroots), "ordered")
    one = F.lit(None).cast("string").alias("lang")
    count = named.select(one, "place", "node").groupBy("lang").agg(F.count("*").alias("leaves"))
    upper = stage(arrays(named.select(one, "place", "node")), "tops")
    higher, roots = tree(upper, count)
    own = node_paths(upper, count).withColumn("array", array_of())
    tops = joined(own, higher.withColumnRenamed("path", "higher"), ["lang", "array"]).select(
        "place", F.concat("path", "higher").alias("top"))
    root = roots.select(F.col("node").alias("root"))
    tops = named.join(tops, "place").select("lang", F.col("node").alias("subroot"), "top", root.scalar().alias("root"))
    known = joined(joined(joined(held, sizes, ["lang"]), above, ["lang", "array"]), tops, ["lang"]).select(
        "slots", "leaves", F.concat("path", "top").alias("path"), "subroot", "root")

    def prove(batches):
        for batch in batches:
            for slots, n, path, subroot, root in each_row(batch):
                ids, nodes, others = (slot_array(slots, name) for name in ("doc_id", "node", "other"))
                names = [x.hex() for x in nodes]
                levels, subroot, root = reduced(names, levels_of(n)), subroot.hex(), root.hex()
                tail = "".join(p["left"] + p["right"] for p in path)
                proofs, folded = [], []
                for i in range(len(ids)):
                    near = path_of(levels, i)
                    proofs.append(digest("".join(p["left"] + p["right"] for p in near) + tail))
                    start = names[i] if others[i] is None else others[i].hex()
                    folded.append(fold(fold(start, near), path))
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), pa.array(names), pa.array([subroot] * len(ids)), pa.array([root] * len(ids)),
                    pa.array(proofs), pa.array(folded), pa.array(np.array(folded) == root)],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return known.mapInArrow(prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                   "folded_root string, verified boolean")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


QUERIES = {"op13_manifest": op13_manifest}
ORACLES: dict[str, str] = {}
