"""Joins. The physical join is left to Spark: adaptive execution broadcasts a side only
after measuring it and splits skewed partitions of a sort-merge join."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import joined_on, top_rows, whole
from sparkloom.operators.ordered import Running, over_order
from sparkloom.operators.reshape import listed
from sparkloom.session import checkpointed


def not_in(df: DataFrame, col: str, other: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN``: a null on the other side leaves no row.

    Written as an anti join on a hash key, since the null-aware form of Spark would
    broadcast the whole other side.
    """
    clean = whole(other, nulls=F.count_if(F.col(key).isNull()))["nulls"] == 0
    keys = other.select(F.col(key).alias("_key")).filter("_key IS NOT NULL")
    return df.filter(F.col(col).isNotNull() & clean).join(keys, F.col(col) == F.col("_key"), "left_anti")


def role_pairs(df: DataFrame, keys: list[str], role: Column, cols_a: list[str], cols_b: list[str],
               prefix_a: str, prefix_b: str) -> DataFrame:
    """Rows where ``role`` holds, next to the other rows of the same key, with prefixes."""
    a = df.filter(role).select(*keys, *[F.col(c).alias(prefix_a + c) for c in cols_a])
    b = df.filter(~role).select(*keys, *[F.col(c).alias(prefix_b + c) for c in cols_b])
    return a.join(b, keys)


def link_list(df: DataFrame, key: str, ids: str, other: DataFrame, other_key: str, value: str, out: str) -> DataFrame:
    """Replace a list of foreign keys by the linked values, in list order, unknown keys left out.

    ``key`` names one row, so a list that is put together again is no longer than it was.
    """
    refs = df.select(key, F.posexplode(ids).alias("_i", "_id"))
    found = refs.join(other.select(F.col(other_key).alias("_id"), F.col(value).alias("_v")).filter("_v IS NOT NULL"), "_id")
    placed = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_l"))
    return joined_on(df.drop(ids), placed.select(key, F.col("_l._v").alias(out)), key)


def match_rate(requests: DataFrame, accepts: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """Share of requests with an accept on all keys."""
    hit = accepts.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return requests.join(hit, keys, "left").agg(
        F.round(F.try_divide(F.count("_hit").cast("double"), F.count(F.lit(1))), digits).alias("rate"))


def product_with_values(df: DataFrame, values: list | Column, out: str) -> DataFrame:
    """Each row with each of the values that the caller lists or has in an array; null is a value like any other."""
    return df.withColumn(out, F.explode(values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])))


def held_values(df: DataFrame, col: str, values: list) -> Column:
    """The listed values and then all others of a dictionary column, null among them, as an array."""
    held = F.transform(F.array_sort(F.collect_set(F.struct(F.col(col).alias("v")))), lambda x: x["v"])
    return df.agg(F.array_distinct(F.concat(F.array(*[F.lit(v) for v in values]), held)).alias("v")).scalar()


def pair_counts(df: DataFrame, key: str, col: str, values: list, ordered: bool = False, rest: str | None = None) -> DataFrame:
    """How many keys hold both values, for each pair of the given dictionary values.

    One pass sets a flag per value and key; pairs are products of flags, never rows.
    ``ordered`` gives permutations instead of combinations. ``rest`` names one more value
    that stands for all values that are not listed.
    """
    if rest is not None:
        df, values = df.withColumn(col, listed(F.col(col), values, rest)), [*values, rest]
    flags = df.groupBy(key).agg(*[F.max((F.col(col) == v).cast("int")).alias(f"f{i}") for i, v in enumerate(values)])
    pairs = list((permutations if ordered else combinations)(range(len(values)), 2))
    sums = flags.agg(*[F.sum(F.col(f"f{a}") * F.col(f"f{b}")).alias(f"p{a}_{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(values[a]).alias("a"), F.lit(values[b]).alias("b"),
                              F.coalesce(F.col(f"p{a}_{b}"), F.lit(0)).alias("n")) for a, b in pairs])
    return sums.select(F.inline(rows))


def latest_effective(df: DataFrame, key: str, effective: list[str], expires: str, as_of: Column,
                     active: Column | None = None) -> DataFrame:
    """Newest active row per key, kept only if it has not expired."""
    rows = df if active is None else df.filter(active)
    newest = top_rows(rows, key, [F.desc(c) for c in effective])
    return newest.filter(F.col(expires).isNull() | (F.col(expires) > as_of))


def as_of(versions: DataFrame, at: Column) -> DataFrame:
    """The versions that were current at a time."""
    return versions.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


def as_of_join(rows: DataFrame, versions: DataFrame, keys: list[str], at: str, since: str, values: list[str],
               until: str | None = None, tie: str | None = None) -> DataFrame:
    """Each row with the values of the version of its key that is valid at the row's own time ``at``.

    That is the newest one with ``since`` at or before it, of several with one time the one with the largest ``tie``
    (then ``until`` and values). If it has ended (``until`` at or before the row's time) the row gets nulls: an older
    version does not come back. Rows without a version, or without a time, get nulls; versions without a time count
    for nothing; a null key is a key like any other. Repeated rows stay. ``values`` must not be columns of ``rows``.

    Rows and versions are one ordered scan, the last version carried forward, so no pair is made and a key that
    holds most rows is cut into chunks like any other (``ordered.over_order``).
    """
    if clash := {c.lower() for c in rows.columns} & {c.lower() for c in values}:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    names = [f"_k{i}" for i in range(len(keys))]
    held = F.struct((F.col(tie) if tie else F.lit(0)).alias("tie"), (F.col(until) if until else F.lit(0)).alias("until"),
                    *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    right = versions.filter(F.col(since).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(since).alias("_t"), F.lit(0).alias("_side"), held.alias("_v"))
    left = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(at).alias("_t"), F.lit(1).alias("_side"),
                       F.struct("*").alias("_row"), F.xxhash64(*[f.name for f in rows.schema if f.dataType.typeName() not in ("map", "variant")]).alias("_salt"))
    scan = checkpointed(left.unionByName(right, allowMissingColumns=True))  # named several times by over_order
    now = over_order(scan, names, ["_t", "_side", "_v", "_salt"], {"_now": Running("last", "_v")}).filter("_side = 1")
    valid = F.col("_now.until").isNull() | (F.col("_now.until") > F.col("_t")) if until else F.lit(True)
    return now.select("_row.*", *[F.when(valid, F.col(f"_now.v{i}")).alias(c) for i, c in enumerate(values)])


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
