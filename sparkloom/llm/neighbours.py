"""Approximate nearest neighbours by learned partitions.

1. Equal vectors are one class that keeps its ``k + 1`` smallest ids (limited before the shuffle), so a vector
   held by a third of all rows costs as much as any other.
2. On a sample of at most ``sample`` classes, chosen by hash, the nearest-neighbour graph is cut into balanced
   parts: a balanced start, then nodes move to the part that holds most of their neighbours while it has room.
3. A small network with one hidden layer learns from the sample which parts hold a vector's neighbours.
4. Every class goes to its most probable part. A query goes to its most probable parts until their chances add
   up to a share that reaches ``recall`` on sample vectors kept from the training.
5. A part is searched in blocks of about ``block`` classes by batches of queries: one task holds one block and
   one batch, however large a part is. Inner products are exact, on the original vectors in double precision.

The sample and its model are all that reaches the driver; their size doesn't grow with the data.

Defined results: rows whose id or vector is null, or whose vector is zero, holds a null or non-finite
component, or has another length than most, take no part; repeated rows of one id are one candidate; equal
scores go to the smaller id; with fewer than k candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import hash60, ready, stage, table

K = 20


def valid_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, key (128-bit hash of the vector), v (doubles as bytes), dims."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")) \
        .where("vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null)")

    def check(batches):
        for batch in batches:
            lists = batch.column(1)
            starts, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            ids, vecs = [], []
            for i, vec_id in enumerate(batch.column(0).to_pylist()):
                v = flat[starts[i]:starts[i + 1]]
                if np.isfinite(v).all() and v.any():
                    ids.append(vec_id)
                    vecs.append((v + 0.0).tobytes())  # -0.0 and 0.0 are one
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([xxhash.xxh3_128_digest(v) for v in vecs], pa.binary()),
                                   pa.array(vecs, pa.binary()), pa.array([len(v) // 8 for v in vecs], pa.int32())],
                                  ["vec_id", "key", "v", "dims"])

    return rows.mapInArrow(check, "vec_id long, key binary, v binary, dims int")


class Router:
    """Partition of a sample's neighbour graph and the network that sends vectors to its parts."""

    def __init__(self, x: np.ndarray, parts: int, recall: float, near: int = 20, hidden: int = 64, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.parts, self.mass = parts, 1.0
        if parts < 2:
            return
        order = rng.permutation(len(x))
        held, train = x[order[: len(x) // 4]], x[order[len(x) // 4:]]
        graph = nearest(train, train, near + 1)[:, 1:]
        part = balanced_parts(train, graph, parts, rng)
        wanted = np.zeros((len(train), parts))
        np.add.at(wanted, (np.repeat(np.arange(len(train)), near), part[graph].ravel()), 1.0 / near)
        wanted = 0.7 * wanted + 0.3 * np.eye(parts)[part]
        self.scale = 1 / (np.sqrt((train ** 2).mean()) + 1e-12)
        self._train(train * self.scale, wanted, hidden, rng)
        chances = self.chances(held)
        home = self.chances(train).argmax(1)
        hit = np.zeros((len(held), parts))
        found = nearest(held, train, near)
        np.add.at(hit, (np.repeat(np.arange(len(held)), near), home[found].ravel()), 1.0 / near)
        best = np.argsort(-chances, axis=1)
        reach = np.cumsum(np.take_along_axis(hit, best, 1), 1)
        before = np.cumsum(np.take_along_axis(chances, best, 1), 1) - np.take_along_axis(chances, best, 1)
        for mass in np.linspace(0.3, 1.0, 71):  # the smallest share of chances that finds enough
            used = (before < mass).sum(1)
            if np.take_along_axis(reach, used[:, None] - 1, 1).mean() >= recall:
                break
        self.mass = float(mass)

    def _train(self, x, wanted, hidden, rng, epochs=60, batch=128, rate=0.004):
        sizes = (x.shape[1], hidden, self.parts)
        p = [rng.normal(0, 1 / np.sqrt(sizes[0]), sizes[:2]), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), sizes[1:]), np.zeros(self.parts)]
        first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
        step = 0
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                step += 1
                h = np.maximum(x[at] @ p[0] + p[1], 0)
                d = (_softmax(h @ p[2] + p[3]) - wanted[at]) / len(at)
                back = (d @ p[2].T) * (h > 0)
                for w, g, m, s in zip(p, (x[at].T @ back, back.sum(0), h.T @ d, d.sum(0)), first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        self.weights = p

    def chances(self, x: np.ndarray) -> np.ndarray:
        if self.parts < 2:
            return np.ones((len(x), 1))
        w = self.weights
        return _softmax(np.maximum(x * self.scale @ w[0] + w[1], 0) @ w[2] + w[3])

    def routes(self, x: np.ndarray) -> list[list[int]]:
        """The parts to search for each vector."""
        c = self.chances(x)
        best = np.argsort(-c, axis=1)
        c = np.take_along_axis(c, best, 1)
        used = np.maximum((np.cumsum(c, 1) - c < self.mass).sum(1), 1)
        return [b[:n].tolist() for b, n in zip(best, used)]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def nearest(queries: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(queries), min(k, len(rows))), np.int64)
    for at in range(0, len(queries), 512):
        s = queries[at:at + 512] @ rows.T
        top = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        out[at:at + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng, rounds: int = 12) -> np.ndarray:
    """Parts of nearly equal size that cut few edges."""
    room = int(np.ceil(1.1 * len(x) / parts))
    centres = x[rng.choice(len(x), parts, replace=False)]
    part = np.zeros(len(x), np.int64)
    for _ in range(8):  # balanced k-means as a start
        score = x @ centres.T
        sizes, part[:] = np.zeros(parts, np.int64), -1
        for i in np.argsort(-(score.max(1) - np.median(score, 1))):
            for c in np.argsort(-score[i]):
                if sizes[c] < room:
                    part[i] = c
                    sizes[c] += 1
                    break
        centres = np.array([x[part == c].mean(0) if sizes[c] else x[rng.integers(len(x))] for c in range(parts)])
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12
    back = [[] for _ in range(len(x))]
    for i, row in enumerate(graph):
        for j in row:
            back[j].append(i)
    around = [np.concatenate([graph[i], np.array(back[i], np.int64)]) for i in range(len(x))]
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[around[i]], minlength=parts)
            c = int(votes.argmax())
            if votes[c] > votes[part[i]] and sizes[c] < room:
                sizes[part[i]] -= 1
                sizes[c] += 1
                part[i] = c
                moved += 1
        if not moved:
            break
    return part


def search(rows: DataFrame, is_query: str, k: int = K, sample: int = 4096, recall: float = 0.96, block: int = 4096,
           batch: int = 2048, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``is_query`` holds."""
    rows = stage(valid_vectors(rows), "vectors")
    dims = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(1).collect()
    dims = dims[0][0] if dims else 0
    rows = rows.where(F.col("dims") == dims).drop("dims")
    ids = rows.select("key", "vec_id")
    place = F.dense_rank().over(Window.partitionBy("key").orderBy("vec_id"))
    few = ids.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("key").agg(
        F.array_sort(F.collect_set("vec_id")).alias("ids"))
    asked = rows.where(is_query).select("key").distinct().withColumn("asked", F.lit(True))
    vectors = rows.groupBy("key").agg(F.first("v").alias("v"))
    classes = stage(vectors.join(few, "key").join(asked, "key", "left").withColumns(
        {"asked": F.coalesce("asked", F.lit(False)), "cid": F.monotonically_increasing_id()}), "classes")
    n = classes.count()
    picked = classes.where(hash60("cid", "sample") < int(min(1.0, sample / max(n, 1)) * (1 << 60))).limit(2 * sample)
    x = np.array([np.frombuffer(r[0], np.float64) for r in picked.select("v").collect()]).reshape(-1, max(dims, 1))
    parts = parts or max(1, min(len(x) // 128, int(np.sqrt(n)) // 12))
    router = Router(x, parts if len(x) >= 512 else 1, recall)

    def route(batches):
        for b in batches:
            v = b.column(1).to_pylist()
            mat = np.frombuffer(b"".join(v), np.float64).reshape(len(v), -1)
            asked_here = b.column(3).to_pylist()
            home = router.chances(mat).argmax(1) if len(v) else []
            ways = router.routes(mat) if len(v) else []
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(home, pa.int32()),
                                   pa.array([w if a else None for w, a in zip(ways, asked_here)], pa.list_(pa.int32()))],
                                  ["cid", "v", "ids", "part", "ways"])

    routed = stage(classes.select("cid", "v", "ids", "asked").mapInArrow(
        route, "cid long, v binary, ids array<long>, part int, ways array<int>"), "routed")
    home = routed.groupBy("part").agg(F.greatest(F.ceil(F.count("*") / block), F.lit(1)).cast("int").alias("blocks"))
    ways = routed.where("ways is not null").select("cid", "v", F.explode("ways").alias("part"))
    load = ways.groupBy("part").agg(F.greatest(F.ceil(F.count("*") / batch), F.lit(1)).cast("int").alias("turns"))
    plan = stage(home.join(load, "part"), "plan")  # one row per part
    draw = lambda salt, many: F.pmod(F.xxhash64("cid", F.lit(salt)), F.col(many)).cast("int")
    left = routed.join(plan, "part").withColumn("b", draw("block", "blocks")) \
        .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).select("part", "b", "t", "cid", "v", "ids")
    right = ways.join(plan, "part").withColumn("t", draw("turn", "turns")) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            F.col("part").alias("qpart"), F.col("b").alias("qb"), F.col("t").alias("qt"), F.col("cid").alias("query"),
            F.col("v").alias("q"))

    def compare(some: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"cid": [], "score": [], "vec_id": []}
        if some.num_rows and asking.num_rows:
            mat = np.frombuffer(b"".join(some.column("v").to_pylist()), np.float64).reshape(some.num_rows, -1)
            q = np.frombuffer(b"".join(asking.column("q").to_pylist()), np.float64).reshape(asking.num_rows, -1)
            listed = some.column("ids").to_pylist()
            first = np.array([i[0] for i in listed])
            # what rounding may take from a product, whatever the norms
            room = 4 * mat.shape[1] * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(mat, axis=1).max()
            for at in range(0, len(q), 256):
                s = q[at:at + 256] @ mat.T
                near = min(k + 1, len(mat))
                limit = -np.partition(-s, near - 1, axis=1)[:, near - 1]
                for r, cid in enumerate(asking.column("query")[at:at + 256].to_pylist()):
                    top = np.flatnonzero(~(s[r] < limit[r] - room[at + r]))
                    exact = (mat[top] * q[at + r]).sum(1)
                    held, last = 0, np.inf
                    for o in np.lexsort((first[top], -exact))[:k + 1]:
                        if held > k and exact[o] < last:  # of equal scores a later class may hold a smaller id
                            break
                        for vec_id in listed[top[o]]:
                            out["cid"].append(cid)
                            out["score"].append(float(exact[o]))
                            out["vec_id"].append(vec_id)
                            held += 1
                        last = exact[o]
        return pa.table({"cid": pa.array(out["cid"], pa.int64()), "score": pa.array(out["score"], pa.float64()),
                         "vec_id": pa.array(out["vec_id"], pa.int64())})

    found = left.groupBy("part", "b", "t").cogroup(right.groupBy("qpart", "qb", "qt")).applyInArrow(compare, "cid long, score double, vec_id long")
    rank = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("place", rank).where(F.col("place") <= k + 1).groupBy("cid").agg(
        F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    queries = rows.where(is_query).select("vec_id", "key").distinct().join(classes.select("key", "cid"), "key")
    mine = queries.join(best, "cid").select(F.col("vec_id").alias("query_id"), F.slice(F.filter(
        "near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


QUERIES = {"op10_neighbours": op10_neighbours}
ORACLES: dict[str, str] = {}
