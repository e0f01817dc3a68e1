"""An inverted index kept as a table: blocks of document ids per token, stored by token, that grows by appending.

A block holds the ids of one token within a span of ``SPAN`` ids, as sorted offsets that the file format
writes as differences. The folder is partitioned by a hash of the token and sorted by token and span inside
its files, so a query opens the folders of its tokens, reads the small columns of their blocks first, and
unpacks offsets only in spans where every token has a block and their ranges of ids meet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.text import token_rows

SPAN = 1 << 14
BUCKETS = 64
SCHEMA = "token string, span bigint, first bigint, last bigint, n int, offsets array<int>, batch string, bucket int"


def bucket_of(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def blocks(df: DataFrame, key: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """Blocks of a batch of texts. Null keys and texts without words have none; a key that comes twice counts once.

    A block is at most ``SPAN`` ids, so a token of every text is many rows. Ids are gathered where the texts
    are read, each once, so repeated rows cannot swell a block and one list a block and task is shuffled.
    """
    words = token_rows(df.filter(F.col(key).isNotNull()), key, text, distinct=True)
    ids = words.select("token", F.col(key).cast("bigint").alias("id"))
    place = F.floor(F.col("id") / SPAN)
    spans = ids.groupBy("token", place.alias("span")).agg(
        F.sort_array(F.collect_set((F.col("id") - place * SPAN).cast("int"))).alias("offsets"))
    at = lambda i: F.col("span") * SPAN + F.element_at("offsets", i)
    return spans.select("token", "span", at(1).alias("first"), at(-1).alias("last"), F.size("offsets").alias("n"), "offsets",
                        bucket_of(F.col("token"), buckets).alias("bucket"))


def append(df: DataFrame, key: str, text: str, folder: str, batch: str | None = None, buckets: int = BUCKETS) -> str:
    """Add texts to the index at ``folder`` as a batch; written again under the same name, a batch replaces itself.

    ``buckets`` belongs to the folder; adaptive execution cuts a large bucket into several files. Texts of an id already there add their words to it.
    """
    name = batch or uuid.uuid4().hex
    out = blocks(df, key, text, buckets).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "token", "span")
    coded = {"parquet.writer.version": "v2", "parquet.enable.dictionary#offsets.list.element": "false"}  # differences, bit-packed
    out.write.mode("overwrite").options(**coded).partitionBy("bucket").parquet(f"{folder}/batch={name}")
    return name


def open_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("basePath", folder).parquet(folder)


def wanted_tokens(query: str) -> list[str]:
    """The tokens of a query, cut as texts are."""
    return sorted(set(query.upper().replace("-", " ").split()))


def blocks_of(index: DataFrame, tokens: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Blocks of the given tokens; only their folders are opened, and their files skip other tokens by their statistics."""
    spark = index.sparkSession
    numbers = [r[0] for r in spark.range(1).select(F.explode(F.array(*[bucket_of(F.lit(t), buckets) for t in tokens]))).collect()]
    return index.filter(F.col("bucket").isin(*sorted(set(numbers))) & F.col("token").isin(*tokens))


def reads(index: DataFrame, query: str, buckets: int = BUCKETS) -> DataFrame:
    """Per file that holds blocks of the query's tokens: blocks, and ids in them."""
    held = blocks_of(index, wanted_tokens(query), buckets).groupBy(F.input_file_name().alias("file"))
    return held.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("ids"))


def candidate_spans(index: DataFrame, query: str, buckets: int = BUCKETS) -> DataFrame:
    """Spans in which every token of the query has a block, with the range of ids that all of them share.

    Reads ranges and counts of blocks, no ids.
    """
    tokens = wanted_tokens(query)
    per = blocks_of(index, tokens, buckets).groupBy("span", "token").agg(F.min("first").alias("lo"), F.max("last").alias("hi"))
    both = per.groupBy("span").agg(F.count(F.lit(1)).alias("tokens"), F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    return both.filter((F.col("tokens") == len(tokens)) & (F.col("lo") <= F.col("hi"))).select("span", "lo", "hi")


def search(index: DataFrame, key: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys of the texts that hold every token of the query; a query without a token finds none.

    The range of spans in which that is possible is read first, one row, so files outside it are skipped.
    In each span the offsets of the rarest token are cut down by the others in turn.
    """
    tokens = wanted_tokens(query)
    none = index.select(F.col("first").alias(key)).limit(0)
    if not tokens:
        return none
    spans = candidate_spans(index, query, buckets)
    low, high = spans.agg(F.min("span"), F.max("span")).first()
    if low is None:
        return none
    held = blocks_of(index, tokens, buckets).filter(F.col("span").between(low, high)).join(spans, "span")
    merged = held.groupBy("span", "token").agg(F.array_distinct(F.flatten(F.collect_list("offsets"))).alias("o"))  # of all batches
    lists = merged.groupBy("span").agg(F.sort_array(F.collect_list(F.struct(F.size("o").alias("n"), "o"))).alias("l"))
    common = F.aggregate(F.slice("l", 2, len(tokens)), F.col("l")[0]["o"], lambda left, other: F.array_intersect(left, other["o"]))
    return lists.select("span", F.explode(common).alias("o")).select((F.col("span") * SPAN + F.col("o")).alias(key))
