"""Documents packed into as few sequences as best-fit decreasing finds, for all documents at once.

Best-fit decreasing takes documents by falling length and puts each one into the
open sequence with the least room that still holds it. It never looks at
anything but lengths, and there are at most ``capacity`` of these, however many
documents there are. So the packing is worked out for the whole corpus on the
number of documents of each length:

1. every document is encoded, cut into pieces of at most ``capacity`` tokens and
   written; a piece has a number among its task's pieces of its length;
2. pieces are counted per task and length; running sums per length over the
   tasks turn the numbers into ranks over all pieces of that length;
3. ``best_fit_decreasing`` reads the counts per length (at most ``capacity``
   rows) and gives, for ranges of ranks, the sequences and offsets. A segment
   tree over remaining room finds the tightest open sequence in logarithmic
   time, once for all documents of one length that go into sequences alike;
4. every piece looks its rank up in these ranges.

The number of sequences is that of best-fit decreasing over all documents, not
of a packing per shard. Nothing that grows with the corpus is collected: the
ranges number a few per length, the length counts one per length.

A null text is empty and has the end id alone. A document of any length is cut
into whole pieces and the rest; only a document longer than ``capacity`` is cut.
Null ids and rows that repeat an id are documents like others. Ties of length
go by rank. An empty table gives an empty table. Other columns are not read, so
their names can't clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import stored
from pitchflow.llm.word_encoder import default_path, encoder

CAPACITY, END = 2048, 0
#: Texts are encoded together up to so many characters.
TOGETHER = 4 << 20


class Tightest:
    """A segment tree over the amounts of room 0 to ``capacity``: which is the least that has an open sequence and is enough?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        node = self.leaves + room
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def find(self, length: int) -> int | None:
        """The least room of at least ``length``: up to the first open part on the right, then down to its least leaf."""
        node = self.leaves + length
        if not self.open[node]:
            while node % 2 or not self.open[node + 1]:
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


@dataclass(frozen=True)
class Range:
    """Pieces of one length with ranks from ``rank`` on: ``each`` of them go into a sequence, from ``first`` on, from ``offset`` on."""

    length: int
    rank: int
    first: int
    each: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[Range], int]:
    """The ranges by falling length and rising rank, and the number of sequences.

    Sequences with the same room are kept as runs ``(first, number)``. A piece
    that goes into the tightest sequence leaves it tighter still, so the next
    piece of that length follows it until it has no room; a whole run is
    treated at once.
    """
    tree, runs = Tightest(capacity), {}
    ranges, sequences = [], 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if not runs.get(room):
                tree.set(room, True)
            runs.setdefault(room, []).append((first, number))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit {capacity}")
        rank, pieces = 0, counts[length]
        while rank < pieces:
            room = tree.find(length)
            if room is None:
                number = -(-(pieces - rank) // (capacity // length))
                put(capacity, sequences, number)
                sequences += number
                room = capacity
            first, number = runs[room].pop()
            if not runs[room]:
                tree.set(room, False)
            each = room // length
            taken = min(pieces - rank, number * each)
            full, rest = divmod(taken, each)
            ranges.append(Range(length, rank, first, each, capacity - room))
            put(room - each * length, first, full)
            put(room - rest * length, first + full, int(rest > 0))
            put(room, first + full + (rest > 0), number - full - (rest > 0))
            rank += taken
    return ranges, sequences


def cut(docs: DataFrame, capacity: int, path: str, end: int, text: str, doc_id: str, ids: bool) -> DataFrame:
    """A row per piece, with the task it came from and its number among that task's pieces of its length."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *["ids"] * ids]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * ids]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, own, last = TaskContext.get().partitionId(), Counter(), encoder(path), np.array([end], np.uint32)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).cumsum()
            start = 0
            while start < len(sizes):
                # As many texts as fit, one at least.
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + TOGETHER, "right")))
                some, out = batch.slice(start, stop - start), []
                values, ends = own.encode(some["text"])
                at = 0
                for doc, to in zip(some["doc_id"].to_pylist(), ends.tolist(), strict=True):
                    whole = np.append(values[at:to], last).astype("<u4")
                    at = to
                    for k in range(0, len(whole), capacity):
                        piece = whole[k : k + capacity].tobytes()
                        length = len(piece) // 4
                        out.append((doc, k // capacity, k, length, zlib.crc32(piece), part, seen[length], *[piece] * ids))
                        seen[length] += 1
                start = stop
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids binary" * ids
    return rows.mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end: int = END, text: str = "text", doc_id: str = "doc_id", ids: bool = True,
) -> DataFrame:
    """Per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if wanted, ``ids`` (little-endian unsigned 32-bit)."""
    pieces = stored(cut(docs, capacity, path or default_path(), end, text, doc_id, ids))
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per length: ``capacity`` rows.
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges, _ = best_fit_decreasing(lengths, capacity)
    rank, first, each, offset = (np.array([getattr(r, n) for r in ranges], np.int64) for n in ("rank", "first", "each", "offset"))
    begins = {r.length: k for k, r in reversed([*enumerate(ranges)])}  # a length's ranges stand together
    how_many = Counter(r.length for r in ranges)

    base = counts.selectExpr("part", "length", "sum(n) OVER (PARTITION BY length ORDER BY part ROWS UNBOUNDED PRECEDING) - n AS base")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.expr("base + nth"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            found = np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                rows, a = np.flatnonzero(lengths == length), begins[length]
                found[rows] = a + np.searchsorted(rank[a : a + how_many[length]], ranks[rows], "right") - 1
            nth = ranks - rank[found]
            sequence, place = first[found] + nth // each[found], offset[found] + nth % each[found] * lengths
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in kept], pa.array(sequence), pa.array(place)], names=[*kept, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids + ", sequence_id long, offset long"
    return ranked.select(*kept, "rank").mapInArrow(placed, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, doc_ids, ids)`` of ``pack(..., ids=True)``; a sequence holds at most ``capacity`` pieces."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), pieces.alias("pieces"))
    joined = F.aggregate("pieces", F.unhex(F.lit("")), lambda so_far, p: F.concat(so_far, p["ids"]))
    return whole.select("sequence_id", "n_tokens", F.col("pieces.doc_id").alias("doc_ids"), joined.alias("ids"))
