"""Ranked lexical search by an Aho-Corasick scan of the documents, without an index of them.

The terms of all items make one automaton. Each is guarded by a boundary on both sides, so it is found only where
it stands as a whole term; neighbouring terms share a boundary, since the automaton also reports overlapping
matches. Texts are folded byte by byte (A-Z to small letters, everything that ends a term to the boundary), so a
text and an automaton agree on the bytes of UTF-8 and nothing is decoded.

Two scans: the first gives N, L and how many documents hold each term (sums with partial aggregates), the second
counts each document's terms again and adds what they give through the automaton's outputs, lists of (item, times
that the item holds the term). A task keeps the ``k`` best documents of each item, and those few rows are ranked
once more over all tasks. No document's counts are stored.

The automaton is broadcast in blocks of items: as many blocks as keep the text of a block near ``block_bytes``
(items go to blocks by hash of their id), each with its own scans, so the automaton has one size whatever the
number of items. All of a score is 64-bit integer, but for the logarithm of a term's weight.

Defined results: a null text has no terms and counts neither in N nor in L; items without terms and documents
with score 0 give no rows; rows of one item_id are one item with all their terms; null item_ids are one item;
repeated rows of a document are documents of their own; equal scores go by ascending doc_id, null last; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, hash60, stage, table, texts

_ENDS = b"".join(bytes([c]) if c >= 0x80 or bytes([c]).isalnum() else b" " for c in range(256))
FOLD = _ENDS.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
CELLS = 1 << 20  # scores held at once: documents times items
TEXTS = 256


def folded(text: bytes | None) -> bytes:
    """The terms of a text between single or repeated boundaries, with one at both ends."""
    return b" " + text.translate(FOLD) + b" " if text else b" "


class Scanner:
    """The automaton of ``terms``: numbers of the terms found in a text, as often as they stand there."""

    def __init__(self, terms: list[bytes]):
        self.found = ahocorasick.Automaton()
        for n, term in enumerate(terms):
            self.found.add_word((b" " + term + b" ").decode("latin-1"), n)
        if terms:
            self.found.make_automaton()
        self.empty = not terms

    def counts(self, text: bytes) -> Counter:
        """term number -> times, of a folded text."""
        return Counter() if self.empty else Counter(n for _, n in self.found.iter(text.decode("latin-1")))


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]  # (-score, without id, id)
        self.least = np.ones(items, np.int64)  # a score below cannot enter

    def add(self, ids: list[int | None], scores: np.ndarray) -> None:
        """``scores``: one row per document, one column per item."""
        if len(ids) > self.k:  # what is below the k-th of this batch cannot enter either
            kth = np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k]
            least = np.maximum(self.least, kth)
        else:
            least = self.least
        at, of = np.nonzero(scores >= least)
        order = np.argsort(of, kind="stable")
        at, of = at[order], of[order]
        begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
        for begin, end in zip(begins, [*begins[1:], len(of)]):
            item = int(of[begin])
            more = [(-int(scores[d, item]), ids[d] is None, ids[d] or 0) for d in at[begin:end].tolist()]
            self.rows[item] = heapq.nsmallest(self.k, [*self.rows[item], *more])
            if len(self.rows[item]) == self.k:
                self.least[item] = -self.rows[item][-1][0]


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of ``items(item_id, text)``."""

    def split(batches):
        for ids, found in texts(batches, "item_id", "text"):
            rows = [(i, term, n) for i, t in zip(ids, found) for term, n in Counter(folded(t).split()).items()]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                   pa.array([r[2] for r in rows], pa.int64())], ["item_id", "term", "times"])

    each = items.mapInArrow(split, "item_id long, term binary, times long")
    return each.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def statistics(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms, documents that hold each of ``terms``)."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]):
        scanner, holds = Scanner(sent.value), np.zeros(len(sent.value) + 2, np.int64)
        for (found,) in texts(batches, "text"):
            for t in found:
                text = folded(t)
                n = len(text.split())
                if n:
                    holds[-2:] += 1, n
                    holds[np.fromiter(scanner.counts(text), np.int64)] += 1
        used = np.flatnonzero(holds)
        yield pa.record_batch([pa.array(used), pa.array(holds[used])], ["place", "n"])

    rows = docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n")).collect()
    holds = np.zeros(len(terms) + 2, np.int64)
    for place, n in rows:  # at most one row per term of the block
        holds[place] = n
    return int(holds[-2]), int(holds[-1]), holds[:-2]


def weights(holds: np.ndarray, documents_: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents_ + 2) / (2 * df + 1))) for df in holds.tolist()], np.int64)


def ranked_block(docs: DataFrame, items: DataFrame, k: int, length_share: int = 75) -> DataFrame:
    """(item_id, doc_id, score): the ``k`` best documents of each item by task and then overall, ``items`` bounded."""
    rows = items.collect()  # the terms of one block
    terms = sorted({bytes(r["term"]) for r in rows})
    place = {t: n for n, t in enumerate(terms)}
    ids = sorted({r["item_id"] for r in rows}, key=lambda x: (x is not None, x or 0))
    number = {i: n for n, i in enumerate(ids)}
    n_docs, n_terms, holds = statistics(docs, terms)
    of_term = sorted((place[bytes(r["term"])], number[r["item_id"]], r["times"]) for r in rows)
    first = np.searchsorted([t for t, _, _ in of_term], np.arange(len(terms) + 1))
    sent = docs.sparkSession.sparkContext.broadcast((
        terms, ids, weights(holds, n_docs), first, np.array([i for _, i, _ in of_term], np.int64),
        np.array([n for _, _, n in of_term], np.int64)))

    def rank(batches: Iterator[pa.RecordBatch]):
        terms, ids, weight, first, item, times = sent.value
        scanner, best = Scanner(terms), Best(len(ids), k)
        step = max(1, min(TEXTS, CELLS // max(len(ids), 1)))
        for names, found in texts(batches, "doc_id", "text"):
            for begin in range(0, len(found), step):
                part = found[begin:begin + step]
                scores = np.zeros((len(part), len(ids)), np.int64)
                for row, text in zip(scores, map(folded, part)):
                    counts = scanner.counts(text)
                    if counts:
                        n, t = len(text.split()), np.fromiter(counts, np.int64, len(counts))
                        tf = np.fromiter(counts.values(), np.int64, len(counts))
                        m = 100 - length_share + length_share * n * n_docs // n_terms
                        gives = weight[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                        sizes = first[t + 1] - first[t]
                        at = np.repeat(first[t] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                        np.add.at(row, item[at], np.repeat(gives, sizes) * times[at])
                best.add(names[begin:begin + step], scores)
        out = [(ids[i], None if without else d, -s) for i, rows in enumerate(best.rows) for s, without, d in rows]
        yield pa.record_batch([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(rank, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs(doc_id, text)`` for each of ``items(item_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = stage(item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))), "terms")
    held = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).head()[0]
    blocks = max(1, -(-held // block_bytes))
    best = None
    for b in range(blocks):
        part = terms.where(F.pmod(hash60("item_id", "items"), F.lit(blocks)) == b) if blocks > 1 else terms
        found = ranked_block(docs, part, k)
        best = found if best is None else best.unionAll(found)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
with d as (
  select row_number() over () as row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
l as (select row_id, doc_id, len(terms)::bigint as n from d where len(terms) > 0),
s as (select count(*)::bigint as docs, sum(n)::bigint as words from l),
t as (select row_id, unnest(terms) as term from d),
f as (select row_id, term, count(*)::bigint as tf from t group by row_id, term),
i as (
  select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
q as (select item_id, term, count(*)::bigint as times from i group by item_id, term),
w as (
  select term, floor(1000 * ln((2 * s.docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
  from f, s group by term, s.docs),
r as (
  select q.item_id, f.row_id,
         sum(q.times * w.weight * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (25 + (75 * l.n * s.docs) // s.words))))::bigint as score
  from q join w using (term) join f using (term) join l using (row_id), s
  group by q.item_id, f.row_id),
k as (
  select r.item_id, l.doc_id, r.score,
         (row_number() over (partition by r.item_id order by r.score desc, l.doc_id nulls last))::int as rank
  from r join l using (row_id) where r.score > 0)
select item_id, rank, doc_id, score from k where rank <= 10
"""

QUERIES = {"op12_lexical": op12_lexical}
ORACLES = {"op12_lexical": OP12_SQL}
