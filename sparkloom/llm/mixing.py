"""Mixing of sources to target weights by hash-threshold histograms.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share ``share`` times all words;
no source gives more than ``most`` times its own words, and what it can't give is shared again by weight.

Choice of documents: every document of a source is taken as many whole times as fit the target; what is left
of the target is met by the documents with the smallest hashes. Their limit is found without sorting: words are
summed by source and the leading digit of the hash, the digit in which the budget ends is refined by its next
digit, and so on over the six digits of the hash. Only rows in the digit where the budget ends go on, so each
round holds a 2^-10 share of the one before. The limit is then a filter. In the report (``mix_sizes``) the
documents that hold exactly the limit (one, or repeated rows of one id) share the words that are still missing, in
proportion to their size, so a source's words come to its target rounded to whole words; the mixed corpus
(``mix``) takes every text whole. Budgets nest: a smaller target is a subset.

Defined results: a null text has size 0 and is taken with 0 words; a null source is a source of its own; in the
report null doc_ids share one hash; an empty table gives no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import WORD, documents, hash60, nested_limits, offsets, ready, stage

WEIGHTS = (5, 2, 1)


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """Null becomes a key that no source has."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2) -> DataFrame:
    """(key, source_size, target) per source of ``sizes(key, size)``. 'n' (null) sorts behind all other keys."""
    sums = sizes.groupBy("key").agg(F.sum("size").cast("long").alias("source_size"))
    order = [F.col("key") == "n", F.col("key")]
    ranged = stage(sums.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    counted = offsets(ranged.withColumn("one", F.lit(1)), "part", "one")
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = stage(ranged.join(counted, "part").select("key", "source_size", weight.alias("weight")), "weights")
    all_words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).head()[0]
    budget, full, rest, seen = float(all_words) * share, 0.0, None, -1
    while True:  # each round fixes the sources that would give too much; one row of sums comes back
        if rest is None:
            target = F.lit(None).cast("double")
            above = F.lit(False)
        else:
            target = F.col("weight") * F.lit(budget - full) / F.lit(rest)
            above = target > F.col("source_size") * F.lit(float(most))
        found = sources.agg(F.count_if(above), F.sum(F.when(above, F.col("source_size"))),
                            F.sum(F.when(~above, F.col("weight")))).head()
        if found[0] == seen or not found[2]:
            break
        seen, full, rest = found[0], float(found[1] or 0) * most, float(found[2])
    if rest is None:
        return sources.select("key", "source_size", F.lit(0.0).alias("target"))
    target = F.col("weight") * F.lit(budget - full) / F.lit(rest)
    return sources.select("key", "source_size", F.least(target, F.col("source_size") * F.lit(float(most))).alias("target"))


def limits(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, source_size, target, passes, limit, limit_left, limit_size) from ``sizes(key, h, size)``."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rounds = wanted.withColumn("passes", passes).withColumn(
        "words", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long"))
    rows = sizes.where("size > 0").join(rounds.where("words > 0").select("key", F.col("words").alias("left")), "key")
    return stage(rounds.drop("words").join(nested_limits(rows), "key", "left"), "limits")


def taken_words() -> Column:
    """Words a row takes, from its size and hash and its source's limits."""
    extra = (F.when(F.col("h") < F.col("limit"), F.col("size"))
             .when(F.col("h") == F.col("limit"), F.expr("size * limit_left div limit_size")).otherwise(0))
    return (F.col("passes") * F.col("size") + F.coalesce(extra, F.lit(0))).cast("long")


def mix_sizes(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key().alias("key"),
                             size_of().alias("size"), hash60("doc_id", "mix").alias("h")), "sizes")
    found = limits(rows.select("key", "h", "size"), targets(rows, **how))
    return rows.join(found, "key").select("doc_id", "size", "source_size", "target", taken_words().alias("taken"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: every row as often as it is taken, always whole.

    Rows are drawn by the hash of id and text, so rows without an id are told apart. The rows of the limit (one, or
    repeated rows) are taken if that brings the source nearer to its target.
    """
    row_key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = docs.select(F.struct(*docs.columns).alias("row"), source_key().alias("key"), size_of().alias("size"), hash60(row_key, "mix").alias("h"))
    sizes = stage(rows.select("key", "h", "size"), "sizes")
    found = limits(sizes, targets(sizes, **how)).select(F.col("key").alias("of"), "passes", "limit", "limit_left", "limit_size")
    near = (F.col("h") == F.col("limit")) & (F.col("limit_left") * 2 >= F.col("limit_size"))
    once_more = F.coalesce((F.col("size") > 0) & ((F.col("h") < F.col("limit")) | near), F.lit(False)).cast("int")
    times = (F.col("passes") + once_more).cast("int")
    return rows.join(found, F.col("key") == F.col("of")).select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(documents(spark, sf_dir))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mix(docs)


OP1_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || 'mix'), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from d group by source),
r as (
  select *, sum(source_size) over () * 1.5::double as budget, row_number() over o as k,
         coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0) * 2.0::double as full_words,
         (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::double as rest
  from s window o as (order by source_size / weight, source nulls last)),
l as (select budget, full_words, rest from r
      where weight * (budget::double - full_words::double) / rest <= source_size * 2.0::double order by k limit 1),
t as (
  select source, source_size,
         least(weight * ((select budget from l)::double - (select full_words from l)::double) / (select rest from l),
               source_size * 2.0::double)::double as target
  from s),
p as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from t),
w as (select *, floor(target - passes * source_size + 0.5::double)::bigint as words from p),
g as (select source, h, sum(size)::bigint as held from d where size > 0 group by source, h),
c as (select source, h, held, sum(held) over (partition by source order by h)::bigint as upto from g),
e as (
  select c.source, c.h as edge, c.held, (w.words - c.upto + c.held)::bigint as missing
  from c join w on c.source is not distinct from w.source
  where w.words > 0 and c.upto >= w.words and c.upto - c.held < w.words)
select d.doc_id, d.size, w.source_size, w.target,
       (w.passes * d.size + case when e.edge is null then 0 when d.h < e.edge then d.size
                                 when d.h = e.edge then d.size * e.missing // e.held else 0 end)::bigint as taken
from d join w on d.source is not distinct from w.source
left join e on d.source is not distinct from e.source
"""

QUERIES = {"op1_mix": op1_mix}
ORACLES = {"op1_mix": OP1_SQL}
