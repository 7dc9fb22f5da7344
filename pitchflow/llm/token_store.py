"""Token ids on disk: every document compressed alone, with one dictionary for all.

Short documents compress badly alone and can't be read alone when compressed
together. A zstandard dictionary, trained on the serialized ids of a bounded
sample, gives both. A shard is a range of document ids in ascending order, made
of blocks; a block is one binary value:

    "TOKB", version, bytes per id, number of documents, first 8 bytes of the dictionary's hash,
    then per document: a flag (id is null), id, number of tokens, end of its frame; then the frames

so one document is read by decompressing its own frame. Blocks are rows of a
Parquet table with their id range beside them, the dictionary is a table with
its hash; a block refuses a dictionary with another hash. Spark writes both, so
they may lie in any store.

The texts are shuffled once, by range of id; start positions come from running
sums in the writing task and one total per shard. Null texts have no ids but
the end id. Null document ids come first. Rows that repeat an id stand side by
side. Extra columns are not stored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.llm.common import partitions
from pitchflow.llm.tokens import default_path, encoder

#: The dictionary: its size, and the documents and bytes of each that it is trained on.
DICTIONARY, SAMPLE, SAMPLE_BYTES = 64 << 10, 1000, 16 << 10
LEVEL = 3
BLOCK = 2 << 20
END = 0

_HEAD = struct.Struct("<4sBBI8s")
_ROW = np.dtype([("null", "u1"), ("id", "<i8"), ("tokens", "<u4"), ("end", "<u4")])
_BLOCKS = "shard int, block int, first long, last long, docs long, tokens long, start long, dictionary string, payload binary"


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary for ids like the samples; raw content where there are too few to train on, empty without any."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def name(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _tool(dictionary: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class BlockWriter:
    """Collects documents and packs them; ``width`` is 2 or 4 bytes per id."""

    def __init__(self, dictionary: bytes, width: int):
        self.dictionary, self.width, self.press = dictionary, width, zstandard.ZstdCompressor(level=LEVEL, **_tool(dictionary))
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.frames: list[bytes] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self.press.compress(ids.astype(f"<u{self.width}").tobytes())
        self.size += len(frame)
        self.tokens += len(ids)
        self.rows.append((doc_id is None, doc_id or 0, len(ids), self.size))
        self.frames.append(frame)

    def pack(self) -> bytes:
        head = _HEAD.pack(b"TOKB", 1, self.width, len(self.rows), bytes.fromhex(name(self.dictionary))[:8])
        return head + np.array(self.rows, _ROW).tobytes() + b"".join(self.frames)


class Block:
    """A packed block; ``ids(i)`` reads one document and nothing else."""

    def __init__(self, payload: bytes, dictionary: bytes, tool: zstandard.ZstdDecompressor | None = None):
        magic, version, self.width, n, mark = _HEAD.unpack_from(payload)
        if magic != b"TOKB" or version != 1:
            raise ValueError("not a block of token ids")
        if mark != bytes.fromhex(name(dictionary))[:8]:
            raise ValueError("the block was written with another dictionary")
        self.rows = np.frombuffer(payload, _ROW, n, _HEAD.size)
        self._body = memoryview(payload)[_HEAD.size + n * _ROW.itemsize :]
        self._tool = tool or zstandard.ZstdDecompressor(**_tool(dictionary))

    def ids(self, i: int) -> np.ndarray:
        frame = self._body[int(self.rows["end"][i - 1]) if i else 0 : int(self.rows["end"][i])]
        return np.frombuffer(self._tool.decompress(frame), f"<u{self.width}")


def write(docs: DataFrame, folder: str, path: str | None = None, text: str = "text", doc_id: str = "doc_id", end: int = END, shards: int | None = None) -> str:
    """Encode all texts, append ``end`` to each, write ``folder/blocks`` and ``folder/dictionary``; the dictionary's hash."""
    spark, path = docs.sparkSession, path or default_path()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    width = 2 if max(encoder(path).library.get_vocab_size(), end + 1) <= 1 << 16 else 4

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(encoder(path).encode(t.as_py()[:SAMPLE_BYTES]), "<u4").astype(f"<u{width}").tobytes()[:SAMPLE_BYTES] for t in batch["text"]]
            yield pa.record_batch({"ids": pa.array(ids, pa.binary())})

    chosen = rows.select("doc").distinct().orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE)
    sample = rows.join(F.broadcast(chosen), "doc").select(F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    dictionary = train(sorted(bytes(r.ids) for r in sample.mapInArrow(sampled, "ids binary").limit(2 * SAMPLE).collect()))
    mark = name(dictionary)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start, own = TaskContext.get().partitionId(), 0, 0, encoder(path)
        writer = BlockWriter(dictionary, width)

        def done() -> pa.RecordBatch:
            nonlocal block, start
            known = [r[1] for r in writer.rows if not r[0]]
            row = [shard, block, min(known, default=None), max(known, default=None), len(writer.rows), writer.tokens, start, mark, writer.pack()]
            block, start = block + 1, start + writer.tokens
            writer.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in _BLOCKS.split(", ")])

        for batch in batches:
            for doc, ids in zip(batch["doc"].to_pylist(), own.encode_all(batch["text"]), strict=True):
                writer.add(doc, np.append(ids, np.uint32(end)))
                if writer.size >= BLOCK:
                    yield done()
        if writer.rows:
            yield done()

    ranged = rows.repartitionByRange(shards or partitions(spark), F.col("doc").asc_nulls_first()).sortWithinPartitions(F.col("doc").asc_nulls_first(), "text")
    ranged.mapInArrow(packed, _BLOCKS).write.mode("overwrite").parquet(f"{folder}/blocks")
    spark.createDataFrame([(mark, bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.mode("overwrite").parquet(f"{folder}/dictionary")
    return mark


def _dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.schema("hash string, dictionary binary").parquet(f"{folder}/dictionary").first().dictionary)


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids``, from the files."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    dictionary = _dictionary(spark, folder)
    totals = blocks.groupBy("shard").agg(F.sum("tokens").alias("n"))  # a row per shard: the number of partitions written
    base = totals.selectExpr("shard", "sum(n) OVER (ORDER BY shard) - n AS base")
    placed = blocks.join(F.broadcast(base), "shard").selectExpr("base + start AS start", "payload")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor(**_tool(dictionary))
        for batch in batches:
            for first, payload in zip(batch["start"], batch["payload"], strict=True):
                block = Block(payload.as_py(), dictionary, tool)
                rows, crcs, values = block.rows, [], []
                for i in range(len(rows)):
                    own = block.ids(i).astype("<u4").tobytes()
                    crcs.append(zlib.crc32(own))
                    if ids:
                        values.append(own)
                n = rows["tokens"].astype(np.int64)
                out = {
                    "doc_id": pa.array(rows["id"], pa.int64(), mask=rows["null"].astype(bool)), "start": pa.array(first.as_py() + np.cumsum(n) - n),
                    "n_tokens": pa.array(n), "ids_crc32": pa.array(crcs, pa.int64()),
                }
                yield pa.record_batch(out | ({"ids": pa.array(values, pa.binary())} if ids else {}))

    return placed.mapInArrow(unpacked, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row that has this id): the blocks' id ranges prune the read, only its frames are decompressed."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").where((F.col("first") <= doc_id) & (F.col("last") >= doc_id))
    dictionary = _dictionary(spark, folder)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch["payload"]:
                block = Block(payload.as_py(), dictionary)
                hits = np.flatnonzero((block.rows["id"] == doc_id) & (block.rows["null"] == 0))
                yield pa.record_batch({"ids": pa.array([block.ids(i).astype("<u4").tobytes() for i in hits], pa.binary())})

    return [np.frombuffer(r.ids, "<u4") for r in blocks.select("payload").mapInArrow(found, "ids binary").collect()]
