"""Line dedup that can be taken back: sharded cuckoo filters over exact reference tables.

The reference table has one row per (line key, document) and is the truth: its
counts say which keys are repeated and which document keeps them. Over it lie
cuckoo filters, one per shard of the key space, that hold the repeated keys. A
line is looked up in its shard's filter first; only lines that pass are
compared with the exact table, so a false positive costs a comparison and
changes nothing. Filters take insertions and deletions, so documents can be
added and removed later (:meth:`LineIndex.insert`, :meth:`LineIndex.delete`).
Such a change writes its own reference rows, the counts of its keys, and the
filters of shards in which a key began or ceased to be repeated, nothing else;
what was written before is read with it, until :meth:`LineIndex.compacted`.

Every aggregate on keys is partial before it shuffles. A key that stands in a
third of all documents meets its reference row by salted joins.

Null and empty texts are one empty line. Null document ids refer to nothing:
their lines neither count nor go. Rows that repeat a document id count once,
and all lose the same lines. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import digest, fresh, lean, partitions, quoted, stored

SALTS = 16
SLOTS = 4
_TRIM = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class CuckooFilter:
    """A set of 64-bit hashes by 16-bit fingerprints in buckets of four, with deletion.

    A key has two buckets, each found from the other and the fingerprint. When
    no place is left after many moves the table doubles from ``keys()`` of the
    caller, see :meth:`of`. Only keys that were added may be removed.
    """

    MOVES = 500

    def __init__(self, buckets: int):
        self.cells = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * 0.85)))))
        while True:
            out = cls(buckets)
            if all(out.add(int(k)) for k in keys):
                return out
            buckets *= 2

    def _places(self, key: int) -> tuple[int, int, int]:
        mask = len(self.cells) - 1
        mark = (key >> 48 & 0xFFFF) or 1
        first = key & mask
        return mark, first, first ^ (mark * 0x5BD1E995 & mask)

    def add(self, key: int) -> bool:
        mark, a, b = self._places(key)
        for at in (a, b):
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = mark
                return True
        at, mask = a, len(self.cells) - 1
        for move in range(self.MOVES):
            slot = move % SLOTS
            mark, self.cells[at, slot] = int(self.cells[at, slot]), mark
            at ^= mark * 0x5BD1E995 & mask
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = mark
                return True
        return False

    def remove(self, key: int) -> bool:
        mark, a, b = self._places(key)
        for at in (a, b):
            there = np.flatnonzero(self.cells[at] == mark)
            if len(there):
                self.cells[at, there[0]] = 0
                return True
        return False

    def has(self, keys: np.ndarray) -> np.ndarray:
        keys, mask = keys.astype(np.uint64), np.uint64(len(self.cells) - 1)
        marks = (keys >> np.uint64(48)).astype(np.uint64)
        marks[marks == 0] = 1
        first = keys & mask
        second = first ^ (marks * np.uint64(0x5BD1E995) & mask)
        marks = marks.astype(np.uint16)[:, None]
        return (self.cells[first.astype(np.int64)] == marks).any(1) | (self.cells[second.astype(np.int64)] == marks).any(1)

    def pack(self) -> bytes:
        return self.cells.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> CuckooFilter:
        out = cls(1)
        out.cells = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return out


def line_key(line: Column) -> Column:
    """The line without space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_TRIM)), _UPPER, _LOWER)


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def references(docs: DataFrame, min_chars: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row ``(key, doc)`` per document and different line key of at least ``min_chars`` code points."""
    keys = F.filter(F.transform(F.split(F.col(text), "\n"), line_key), lambda k: F.char_length(k) >= min_chars)
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc"), F.explode(F.array_distinct(F.transform(keys, digest))).alias("key")
    )
    return rows


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))


def _by_shard(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("hash", _hash(F.col("key"))).withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))


def _build(key: tuple, table: pa.Table) -> pa.Table:
    built = CuckooFilter.of(table["hash"].to_numpy().view(np.uint64))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([built.pack()], pa.binary())})


def _change(key: tuple, filters: pa.Table, changes: pa.Table) -> pa.Table:
    """The shard's filter after its changes; null if one finds no place, for the caller to build it anew."""
    held = CuckooFilter.unpack(filters["filter"][0].as_py()) if filters.num_rows else CuckooFilter(4)
    hashes, now = changes["hash"].to_numpy().view(np.uint64), changes["now"].to_numpy(zero_copy_only=False)
    for h in hashes[~now]:
        held.remove(int(h))
    fits = all(held.add(int(h)) for h in hashes[now])
    packed = held.pack() if fits else None
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([packed], pa.binary())})


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines whose shard's filter has them. Rows come sorted, each shard's filter before its lines; nothing is held but one filter."""
    at, held = None, None
    for batch in batches:
        place = np.stack([batch["shard"].to_numpy(), batch["salt"].to_numpy()], 1)
        cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if (here := tuple(place[start])) != at:
                at, held = here, None
            if batch["filter"][start].is_valid:
                held = CuckooFilter.unpack(batch["filter"][start].as_py())
                start += 1
            if held is not None and end > start:
                lines = batch.slice(start, end - start)
                found = held.has(lines["hash"].to_numpy().view(np.uint64))
                yield lines.select(["key", "doc", "salt"]).filter(pa.array(found))


class LineIndex:
    """The state: reference rows, their counts, and the filters of the repeated keys.

    ``refs`` ``(doc, key)``; ``counts`` ``(key, n_docs, keeper)``; ``filters``
    ``(shard, filter)``. Each is a DataFrame and can be stored as a table.
    """

    def __init__(self, refs: DataFrame, min_docs: int, min_chars: int, shards: int, counts=None, filters=None):
        self.refs, self.min_docs, self.min_chars, self.shards = refs, min_docs, min_chars, shards
        self.counts = _counts(refs) if counts is None else counts
        if filters is None:
            repeated = _by_shard(self.repeated(), shards).select("shard", "hash")
            filters = repeated.groupBy("shard").applyInArrow(_build, "shard int, filter binary")
        self.filters = filters

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = 5, min_chars: int = 40, shards: int | None = None) -> LineIndex:
        refs = stored(references(docs, min_chars).distinct())
        return cls(refs, min_docs, min_chars, shards or partitions(docs.sparkSession), stored(_counts(refs)))

    def repeated(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs)

    def _with(self, refs: DataFrame, changed: DataFrame) -> LineIndex:
        """The index over ``refs``, with ``changed`` ``(key, n_docs, keeper, before)`` in place of the counts of these keys.

        Written are the changed keys' counts and the filters of shards in which a key began or ceased to be repeated.
        """
        changed, low = stored(changed), F.lit(self.min_docs)
        counts = self.counts.join(changed.select("key"), "key", "left_anti").unionByName(changed.where("n_docs > 0").drop("before"))
        flips = changed.select("key", (F.col("n_docs") >= low).alias("now"), (F.col("before") >= low).alias("was")).where("now <> was")
        flips = _by_shard(flips, self.shards).select("shard", "hash", "now")
        some = flips.select("shard").distinct()
        # An empty side of a pair of groups is no group of its own here: only shards with changes are touched.
        here = self.filters.join(some, "shard", "left_semi")
        tried = stored(here.groupBy("shard").cogroup(flips.groupBy("shard")).applyInArrow(_change, "shard int, filter binary"))
        full = tried.where("filter IS NULL").select("shard")
        repeated = _by_shard(counts.where(F.col("n_docs") >= low), self.shards).join(full, "shard", "left_semi")
        anew = stored(repeated.select("shard", "hash").groupBy("shard").applyInArrow(_build, "shard int, filter binary"))
        filters = self.filters.join(some, "shard", "left_anti").unionByName(tried.where("filter IS NOT NULL")).unionByName(anew)
        return LineIndex(refs, self.min_docs, self.min_chars, self.shards, counts, filters)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with more documents; ids already in it get the new text's lines besides the old ones."""
        new = references(docs, self.min_chars).distinct().join(self.refs, ["key", "doc"], "left_anti")
        new = stored(new.select("doc", "key"))
        more = _counts(new).select("key", F.col("n_docs").alias("more"), F.col("keeper").alias("last"))
        changed = more.join(self.counts, "key", "left").select(
            "key", (F.coalesce("n_docs", F.lit(0)) + F.col("more")).alias("n_docs"), F.greatest("keeper", "last").alias("keeper"),
            F.coalesce("n_docs", F.lit(0)).alias("before"),
        )
        return self._with(self.refs.select("doc", "key").unionByName(new), changed)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose ids are in the first column of ``ids``."""
        gone = stored(ids.select(F.col(ids.columns[0]).cast("long").alias("doc")).where("doc IS NOT NULL").distinct())
        left = self.refs.join(gone, "doc", "left_anti")
        fewer = _counts(self.refs.join(gone, "doc", "left_semi")).select("key", F.col("n_docs").alias("fewer"), F.col("keeper").alias("last"))
        met = stored(fewer.join(self.counts, "key"))
        # Only a key that lost its keeper needs another one; a frequent key's documents are looked at by salts.
        orphans = met.where("keeper = last AND n_docs > fewer").select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = left.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
        heirs = salted.join(orphans, ["key", "salt"], "left_semi").groupBy("key").agg(F.max("doc").alias("heir"))
        changed = met.join(heirs, "key", "left").select(
            "key", (F.col("n_docs") - F.col("fewer")).alias("n_docs"), F.coalesce("heir", "keeper").alias("keeper"), F.col("n_docs").alias("before"),
        )
        return self._with(left, changed)

    def compacted(self) -> LineIndex:
        """The same index with its three tables written anew: after many changes they are read through all of these."""
        return LineIndex(
            stored(self.refs), self.min_docs, self.min_chars, self.shards, stored(self.counts), stored(self.filters)
        )

    def dropped(self) -> DataFrame:
        """``(doc, keys)``: the keys whose lines each document loses; only documents that lose some."""
        lines = _by_shard(self.refs, self.shards).withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        held = self.filters.select("*", salts)
        rows = lines.unionByName(held, allowMissingColumns=True).repartition("shard", "salt")
        rows = rows.sortWithinPartitions("shard", "salt", F.col("filter").isNull())
        near = rows.mapInArrow(lean(_pass), "key binary, doc long, salt int")
        exact = self.repeated().select("key", "keeper", salts)
        hit = near.join(exact, ["key", "salt"]).where("doc <> keeper")
        return hit.groupBy("doc").agg(F.collect_set("key").alias("keys"))


def drop_repeated_lines(
    docs: DataFrame, index: LineIndex, text: str = "text", doc_id: str = "doc_id", names: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with the lines gone that ``index`` gives to another document, and ``n_lines`` and ``n_dropped``, or what ``names`` calls them."""
    gone_id, gone, lines, left = fresh(docs, "gone_id", "gone", "lines", "left")
    dropped = index.dropped().select(F.col("doc").alias(gone_id), F.col("keys").alias(gone))
    joined = docs.join(dropped, F.col(doc_id) == F.col(gone_id), "left").withColumn(
        lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    )
    stays = F.when(
        F.col(gone).isNull(), F.col(lines)
    ).otherwise(F.filter(
        F.col(lines),
        lambda x: (F.char_length(line_key(x)) < index.min_chars) | ~F.array_contains(F.col(gone), digest(line_key(x))),
    ))
    out = joined.withColumn(left, stays)
    n_lines, n_left = F.size(lines).cast("long"), F.size(left).cast("long")
    kept = [F.col(quoted(n)) for n in docs.columns if n not in (text, *names)]
    whole = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return out.select(*kept, whole.alias(text), n_lines.alias(names[0]), (n_lines - n_left).alias(names[1]))
