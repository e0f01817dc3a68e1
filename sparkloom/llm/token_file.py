"""Token ids on disk: one shared zstandard dictionary, each document compressed on its own, an offset index.

A file set is a Parquet folder (any store Spark can write, one commit per task) with two tables:

* ``dictionary``: ``hash`` (first 16 hex digits of its SHA-256) and ``bytes``;
* ``blocks``: ``part, block, first_doc, n_docs, n_tokens, hash, payload``.

A payload holds many documents in ascending doc_id order::

    magic "TKZ2" | id width u32 | documents u32 | dictionary hash 16 bytes
    doc_id i64[n] | id is null u8[n] | tokens u64[n] | offset u64[n + 1] | frames

Frame ``i`` is ``offset[i]:offset[i + 1]`` after the index, so one short document is read by decompressing
its own few bytes. The dictionary is trained on the id arrays of at most ``sample_docs`` documents (chosen by
hash, at most ``sample_bytes`` of each); everything else covers all rows.

Defined results: a null text is empty; a null doc_id sorts first; repeated rows are separate documents, in the
order (doc_id, tokens, checksum); an empty table gives an empty file set; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, hash60, offsets, stage, texts
from sparkloom.llm.tokens import default_tokenizer, encoder
from sparkloom.session import scratch_path

MAGIC = b"TKZ2"
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4096


def _key(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()[:16]


@functools.lru_cache(maxsize=2)
def _tools(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=3)
    return (zstandard.ZstdCompressor(dict_data=data, write_dict_id=False) if data else zstandard.ZstdCompressor(),
            zstandard.ZstdDecompressor(dict_data=data) if data else zstandard.ZstdDecompressor())


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int = 1000,
                     sample_bytes: int = 16 << 10, size: int = 64 << 10) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes; empty where the sample is too small to train on."""
    rows = docs.count()
    share = min(1.0, sample_docs / max(rows, 1))
    picked = docs.where(hash60("doc_id", "dictionary") < int(share * (1 << 60))).limit(2 * sample_docs).select("text")

    def encode(batches):
        code = encoder(tokenizer)
        for (found,) in texts(batches, "text"):
            end = np.array([end_id], code.dtype).tobytes()
            yield pa.record_batch([pa.array([(code.ids(t) + end)[:sample_bytes] for t in found], pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in picked.mapInArrow(encode, "ids binary").collect()]
    if len(samples) < 20 or sum(map(len, samples)) < 4 * size:
        size = max(0, sum(map(len, samples)) // 8)
    if size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # samples that have nothing in common
        return b""


def pack_block(entries: list[tuple], width: int, key: str) -> bytes:
    """``entries``: (doc_id or None, tokens, frame) in order."""
    ids = np.array([0 if d is None else d for d, _, _ in entries], "<i8")
    nulls = np.array([d is None for d, _, _ in entries], "u1")
    tokens = np.array([n for _, n, _ in entries], "<u8")
    offset = np.concatenate([[0], np.cumsum([len(f) for _, _, f in entries])]).astype("<u8")
    return b"".join([MAGIC, np.array([width, len(entries)], "<u4").tobytes(), key.encode(), ids.tobytes(),
                     nulls.tobytes(), tokens.tobytes(), offset.tobytes(), *(f for _, _, f in entries)])


class Block:
    """Reads one payload; ``ids(i)`` touches only the bytes of document ``i``."""

    def __init__(self, payload: bytes, dictionary: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token block")
        width, n = np.frombuffer(payload, "<u4", 2, 4)
        if payload[12:28].decode() != _key(dictionary):
            raise ValueError("the block was written with another dictionary")
        at, n = 28, int(n)
        self.dtype = np.dtype(f"<u{width}")
        self.doc_id = np.frombuffer(payload, "<i8", n, at)
        self.null = np.frombuffer(payload, "u1", n, at + 8 * n)
        self.tokens = np.frombuffer(payload, "<u8", n, at + 9 * n)
        self.offset = np.frombuffer(payload, "<u8", n + 1, at + 17 * n)
        self.frames, self.payload, self.dictionary = at + 17 * n + 8 * (n + 1), payload, dictionary

    def __len__(self) -> int:
        return len(self.doc_id)

    def ids(self, i: int) -> np.ndarray:
        frame = memoryview(self.payload)[self.frames + int(self.offset[i]): self.frames + int(self.offset[i + 1])]
        return np.frombuffer(_tools(self.dictionary)[1].decompress(frame), self.dtype)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1,
                 block_docs: int = BLOCK_DOCS, **sample: int) -> None:
    """Encode every text and write the file set to ``path``; a block holds at most ``block_docs`` documents."""
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(docs, tokenizer, end_id, **sample)
    key, width = _key(dictionary), encoder(tokenizer).dtype.itemsize
    spark.createDataFrame([(key, dictionary)], "hash string, bytes binary").coalesce(1) \
        .write.parquet(f"{path}/dictionary")

    def encode(batches):
        code, squeeze = encoder(tokenizer), _tools(dictionary)[0]
        end = np.array([end_id], code.dtype).tobytes()
        for ids, found in texts(batches, "doc_id", "text"):
            data = [code.ids(t) + end for t in found]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(d) // width for d in data], pa.int64()),
                                   pa.array([zlib.crc32(d) for d in data], pa.int64()),
                                   pa.array([squeeze.compress(d) for d in data], pa.binary())],
                                  ["doc_id", "n", "check", "frame"])

    frames = stage(docs.mapInArrow(encode, "doc_id long, n long, check long, frame binary"), "frames")

    def blocks(batches):
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            return pa.record_batch(
                [pa.array([x], kind) for x, kind in (
                    (part, pa.int32()), (block, pa.int64()), (held[0][0], pa.int64()), (held[-1][0], pa.int64()), (len(held), pa.int64()),
                    (sum(n for _, n, _ in held), pa.int64()), (key, pa.string()), (pack_block(held, width, key), pa.binary()))],
                ["part", "block", "first_doc", "last_doc", "n_docs", "n_tokens", "hash", "payload"])

        for rows in texts(batches, "doc_id", "n", "frame"):
            for entry in zip(*rows):
                if held and (size + len(entry[2]) > BLOCK_BYTES or len(held) >= block_docs):
                    yield close()
                    block, held, size = block + 1, [], 0
                held.append(entry)
                size += len(entry[2])
        if held:
            yield close()

    order = ["doc_id", "n", "check"]
    frames.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        blocks, "part int, block long, first_doc long, last_doc long, n_docs long, n_tokens long, hash string, payload binary",
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked for, ids) of every document of a file set."""
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").head()[1])
    blocks = spark.read.parquet(f"{path}/blocks")

    def decode(batches):
        for parts, numbers, payloads in texts(batches, "part", "block", "payload"):
            for part, number, payload in zip(parts, numbers, payloads):
                block = Block(payload, dictionary)
                ids = [block.ids(i).astype("<u4").tobytes() for i in range(len(block))]
                n = block.tokens.astype(np.int64)
                cols = [pa.array(np.full(len(block), part, np.int32)), pa.array(np.full(len(block), number, np.int64)),
                        pa.array(block.doc_id, mask=block.null.astype(bool)), pa.array(np.cumsum(n) - n), pa.array(n),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                names = ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.record_batch(cols, names)

    docs = blocks.select("part", "block", "payload").mapInArrow(
        decode, "part int, block long, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")
                                   .rowsBetween(Window.unboundedPreceding, -1))
    firsts = blocks.select("part", "block", F.coalesce(inner, F.lit(0)).alias("inner")) \
        .join(offsets(blocks, "part", "n_tokens"), "part") \
        .select("part", "block", (F.col("inner") + F.col("before")).alias("first"))
    return docs.join(firsts, ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("at")).cast("long").alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The id arrays of one document, from the blocks that may hold it (Parquet statistics skip the rest).

    Ids ascend and nulls come first, so a block whose last id is null holds no id at all. One document is in one
    block; rows that repeat an id may go on in the next ones.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").head()[1])
    near = spark.read.parquet(f"{path}/blocks").where(
        (F.col("last_doc") >= doc_id) & (F.col("first_doc").isNull() | (F.col("first_doc") <= doc_id)))
    found = []
    for row in near.select("payload").toLocalIterator():
        block = Block(bytes(row[0]), dictionary)
        found += [block.ids(int(i)) for i in np.flatnonzero((block.doc_id == doc_id) & (block.null == 0))]
    return found


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, end_id=1)
    return read_tokens(spark, path)


QUERIES = {"op2_token_file": op2_token_file}
ORACLES: dict[str, str] = {}
