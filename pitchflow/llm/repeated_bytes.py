"""Exact substring dedup: maximal repeats from an enhanced suffix array's interval tree.

Removed is each byte that a string of ``length`` bytes covers which also starts
earlier (smaller document, or same document and earlier). The suffixes are dealt
out so that no task sees more than it must:

1. Anchors: a position is an anchor if the hash of the ``K`` bytes from it is the
   least in some stretch of ``length`` bytes. Equal strings of that length hold
   the same anchors, and each holds one, so every repeat shows at an anchor. A
   string around an anchor reaches half of its other bytes beyond it on one side
   at least, so an anchor goes on only if it occurs again with the same bytes
   before it or with the same bytes after it: two short hashes beside each
   anchor tell, and what meets by chance stays behind.
2. Each sends its context, what a string of ``length`` bytes around it can hold,
   to the task of its hash.
3. There the suffixes from the anchors are sorted, a stack scan over the common
   prefixes of neighbours gives the intervals of the tree, and a second scan over
   what stands left of an interval's members, read backwards, tells where they
   differ. What differs on both sides is a maximal repeat, with all occurrences.
   All but its first occurrence are covered.
4. Covered ranges meet the texts again by document.

An anchor with more than ``HOT`` occurrences isn't sorted in one task: every
string around it is hashed and its first occurrence found by a partial
aggregate, with the same result. Whole copies of a document need no comparison.
One plan shuffles the texts once and uses that twice. The contexts of frequent
anchors come from another scan of the texts, which knows these few anchors: the
texts are not shuffled for them.

Null texts are empty. Texts shorter than ``length`` bytes lose nothing. Null ids
stand before all others. Rows that repeat an id count as documents in the order
of a digest of the text; rows that repeat both are one document and get equal
results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import digest, groups, stored

LENGTH, K = 100, 32
#: Occurrences of one anchor that a task sorts; with their contexts, about 60 MB.
HOT = 100_000
#: Bytes worked at once by a task that looks for anchors.
SLICE = 1 << 20
#: Room for the position in a number that also tells rows of one id apart.
_BITS = 40

_FACTOR = 0x9E3779B97F4A7C15
_LEAST = -(1 << 63)


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each position, by doubling. ``k`` is a power of two."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
    h ^= h >> np.uint64(31)
    size, factor = 1, _FACTOR
    while size < k:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor & 0xFFFFFFFFFFFFFFFF
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over ``x[i : i + width]``."""
    size = 1
    while 2 * size <= width:
        x = of(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return of(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(texts: list[bytes], length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ma.MaskedArray, np.ma.MaskedArray]:
    """``(text, position, hash, before, after)`` of all anchors.

    A string of ``length`` bytes has half of what it has beside the anchor on one side at least. ``before`` and ``after`` are hashes
    of the ``k`` bytes that begin so much before and after the anchor, masked where the text doesn't reach there.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, np.ma.array(empty.astype(np.int32)), np.ma.array(empty.astype(np.int32))
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    grams = _gram_hashes(data, k)
    choice = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    width = length - k + 1
    least = _sliding(choice, width, np.minimum)  # of the stretch from each position
    # Stretches that leave their text don't count.
    inside = np.ones(len(data), bool)
    for end in ends:
        inside[max(0, end - length + 1) : end] = False
    least[~inside[: len(least)]] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum)[: len(choice)] == choice)
    text = np.searchsorted(ends, at, side="right")
    half = (length - k + 1) // 2
    short = grams.view(np.int64).astype(np.int32)

    def beside(place: np.ndarray) -> np.ma.MaskedArray:
        reached = (place >= (ends - sizes)[text]) & (place + k <= ends[text])
        return np.ma.array(short[np.where(reached, place, 0)], mask=~reached)

    return text, at - (ends - sizes)[text], grams[at].view(np.int64), beside(at - half), beside(at + half)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differs = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differs.bit_length() + 7) // 8


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The tree over sorted strings: ``(length, first, last)`` for each run of strings with a common prefix of exactly that length.

    ``common[i]`` is the prefix strings ``i`` and ``i + 1`` share. Runs shorter than ``least`` are left out.
    """
    stack: list[tuple[int, int]] = []
    for i, now in enumerate([*common, -1]):
        start = i
        while stack and stack[-1][0] > now:
            value, start = stack.pop()
            if value >= least:
                yield value, start, i
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, start))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """``(left, right, members)``: strings of ``left`` bytes before and ``right`` bytes from the anchor that all members share.

    ``lefts`` are read backwards. Each group differs on both sides, or ends
    where its contexts end, and is of at least ``length`` bytes.
    """
    if len(rights) == 2:
        left, right = _common(lefts[0], lefts[1]), _common(rights[0], rights[1])
        if left + right >= length:
            yield left, right, [0, 1]
        return
    order = sorted(range(len(rights)), key=rights.__getitem__)
    common = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    reach = max(map(len, lefts))
    for right, first, last in intervals(common, length - reach):
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        shared = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)]
        for left, a, b in intervals(shared, length - right):
            yield left, right, members[a : b + 1]


def _cover(ranks: list[tuple], lefts: list[bytes], rights: list[bytes], length: int) -> list[tuple[int, int]]:
    """For each occurrence of an anchor, in any order, how many bytes before and from it are covered."""
    n = len(ranks)
    lo, hi = [0] * n, [0] * n
    firsts: dict[tuple[bytes, bytes], int] = {}
    for i in sorted(range(n), key=ranks.__getitem__):
        first = firsts.setdefault((lefts[i], rights[i]), i)
        if first != i and len(lefts[i]) + len(rights[i]) >= length:
            lo[i], hi[i] = len(lefts[i]), len(rights[i])
    own = list(firsts.values())
    if len(own) > 1:
        for left, right, members in maximal_repeats([lefts[i] for i in own], [rights[i] for i in own], length):
            first = min(members)  # ``own`` is in the order of ranks
            for m in members:
                if m != first:
                    i = own[m]
                    lo[i], hi[i] = max(lo[i], left), max(hi[i], right)
    return list(zip(lo, hi, strict=True))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _numbered(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """``(doc, nth, text)``: the id, and a number that tells rows of one id with different texts apart. First as documents, then for every row."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        once = rows.select("doc", F.lit(0).alias("nth"), "text")
        return once, once
    narrow = rows.select("doc", digest(F.col("text")).alias("key"))
    again = narrow.groupBy("doc", "key").count().selectExpr("doc", "key", "row_number() OVER (PARTITION BY doc ORDER BY key) - 1 AS nth")
    every = rows.withColumn("key", digest(F.col("text"))).join(again, ["doc", "key"]).select("doc", F.col("nth").cast("int").alias("nth"), "text")
    return every.dropDuplicates(["doc", "nth"]), every


def covered(numbered: DataFrame, length: int = LENGTH, hot: int = HOT, k: int = K) -> DataFrame:
    """``(doc, nth, ranges)``: the covered ranges of bytes of each document that has some, as an array of ``(a, b)``."""
    near, far = length - k, length

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
        for batch in batches:
            ids, nths, texts, total = [], [], [], 0
            for doc, nth, value in zip(batch["doc"].to_pylist(), batch["nth"].to_pylist(), batch["text"], strict=True):
                ids.append(doc)
                nths.append(nth)
                texts.append(value.as_py().encode())
                total += len(texts[-1])
                if total >= SLICE:
                    yield ids, nths, texts
                    ids, nths, texts, total = [], [], [], 0
            if texts:
                yield ids, nths, texts

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, nths, texts in sliced(batches):
            text, at, hashes, before, after = anchors(texts, length, k)
            place = at + (np.array(nths, np.int64)[text] << _BITS) if len(at) else at
            sides = {n: pa.array(x.data, mask=np.ma.getmaskarray(x)) for n, x in (("before", before), ("after", after))}
            yield pa.record_batch({"hash": pa.array(hashes), "doc": pa.array(np.array(ids, np.int64)[text] if len(at) else at), "at": pa.array(place)} | sides)

    # All copies of a text but the first are covered as a whole.
    same = stored(numbered.select("doc", "nth", digest(F.col("text")).alias("key"), F.octet_length("text").alias("size")).distinct())
    first = same.groupBy("key").agg(F.min(F.struct("doc", "nth")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    salts = 16
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).drop("n")
    copies = same.withColumn("salt", F.pmod(F.xxhash64("doc", "nth"), F.lit(salts)).cast("int")).join(salted, ["key", "salt"])
    copies = stored(copies.where("struct(doc, nth) <> first").select("doc", "nth", F.lit(0).alias("a"), F.col("size").alias("b")))

    every = numbered.mapInArrow(found, "hash long, doc long, at long, before int, after int")
    # A window sorts a frequent anchor's rows on disk if it must; its size decides how it is worked. All windows share one shuffle.
    again = every.selectExpr("*", "count(1) OVER (PARTITION BY hash) AS n").where("n > 1").drop("n")
    beside = again.selectExpr("*", "count(before) OVER (PARTITION BY hash, before) AS b").selectExpr(
        "*", "count(after) OVER (PARTITION BY hash, after) AS a"
    ).where("b > 1 OR a > 1")
    met = stored(beside.selectExpr("hash", "doc", "at", "count(1) OVER (PARTITION BY hash) AS n"))

    kinds = {"hash": pa.int64(), "doc": pa.int64(), "nth": pa.int32(), "at": pa.int64(), "left": pa.binary(), "right": pa.binary()}
    schema = "hash long, doc long, nth int, at long, left binary, right binary"

    def cut(places: Iterator[tuple[int, int, bytes, Iterator[tuple[int, int]]]]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {name: [] for name in kinds}
        for doc, nth, text, own in places:
            for h, at in own:
                for name, x in zip(kinds, (h, doc, nth, at, text[max(0, at - near) : at][::-1], text[at : at + far]), strict=True):
                    rows[name].append(x)
            if len(rows["at"]) > 20_000:
                yield pa.record_batch([pa.array(rows[n], kind) for n, kind in kinds.items()], names=list(kinds))
                rows = {name: [] for name in kinds}
        yield pa.record_batch([pa.array(rows[n], kind) for n, kind in kinds.items()], names=list(kinds))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = zip(*(batch[n] for n in ("doc", "nth", "text", "places")), strict=True)
            yield from cut(
                (doc.as_py(), nth.as_py(), value.as_py().encode(), zip(*(own.values.field(i).to_pylist() for i in range(2)), strict=True))
                for doc, nth, value, own in listed
            )

    def around(rows: DataFrame) -> DataFrame:
        places = rows.groupBy("doc", F.expr(f"int(at >> {_BITS})").alias("nth")).agg(
            F.collect_list(F.struct("hash", F.expr(f"at & {(1 << _BITS) - 1}").alias("at"))).alias("places")
        ).join(copies.select("doc", "nth"), ["doc", "nth"], "left_anti")
        joined = numbered.join(places, ["doc", "nth"]).select("doc", "nth", "text", "places")
        return joined.mapInArrow(contexts, schema)

    def around_frequent(rows: DataFrame) -> DataFrame:
        """As ``around``, by a scan of the texts that keeps what stands around the anchors of ``rows``."""
        # Each has more than ``hot`` occurrences, so they are few.
        wanted = np.array(sorted(r.hash for r in rows.select("hash").distinct().collect()), np.int64)

        def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, nths, texts in sliced(batches):
                text, at, hashes, *_ = anchors(texts, length, k)
                own = np.isin(hashes, wanted)
                if own.any():
                    yield from cut(
                        (ids[t], nths[t], texts[t], [(h, p)]) for t, p, h in zip(text[own].tolist(), at[own].tolist(), hashes[own].tolist(), strict=True)
                    )

        places = rows.selectExpr("hash", "doc", f"int(at >> {_BITS}) AS nth", f"at & {(1 << _BITS) - 1} AS at").join(
            copies.select("doc", "nth"), ["doc", "nth"], "left_anti"
        )
        return numbered.mapInArrow(held, schema).join(places, ["hash", "doc", "nth", "at"], "left_semi")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, table in groups(batches, lambda t: t["hash"].to_pylist()):
            doc, nth, at, left, right = (table[n].to_pylist() for n in ("doc", "nth", "at", "left", "right"))
            if len(doc) < 2:
                continue
            for d, m, p, (lo, hi) in zip(doc, nth, at, _cover(list(zip(doc, nth, at, strict=True)), left, right, length), strict=True):
                if hi:
                    out.append((d, m, p - lo, p + hi))
            if len(out) > 50_000:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], names=["doc", "nth", "a", "b"])
                out = []
        if out:
            yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], names=["doc", "nth", "a", "b"])

    cold = around(met.where(F.col("n") <= hot))
    by_tree = cold.repartition("hash").sortWithinPartitions("hash").mapInArrow(compared, "doc long, nth long, a long, b long")
    found_ranges = [by_tree, copies.where(f"b >= {length}").selectExpr("doc", "bigint(nth)", "bigint(a)", "bigint(b)")]

    frequent = met.where(F.col("n") > hot)
    if not frequent.isEmpty():
        # Of equal contexts all but the first are covered; the others' strings are hashed: l bytes before the anchor, the rest from it.
        texts = stored(around_frequent(frequent).withColumn("c", F.md5(F.concat_ws("-", F.hex("left"), F.hex("right")))))
        first = texts.groupBy("hash", "c").agg(F.min(F.struct("doc", "nth", "at")).alias("first"))
        marked = texts.join(first, ["hash", "c"])
        again = marked.where(f"struct(doc, nth, at) <> first AND octet_length(left) + octet_length(right) >= {length}")
        strings = marked.where("struct(doc, nth, at) = first").selectExpr("*", f"explode(sequence(0, {near})) AS l").where(
            f"octet_length(left) >= l AND octet_length(right) >= {length} - l"
        ).selectExpr("doc", "nth", "at", "l", f"md5(concat(hex(substring(left, 1, l)), '-', hex(substring(right, 1, {length} - l)))) AS s", "hash")
        least = strings.groupBy("hash", "l", "s").agg(F.min(F.struct("doc", "nth", "at")).alias("first"))
        later = strings.join(least, ["hash", "l", "s"]).where("struct(doc, nth, at) <> first")
        found_ranges += [
            again.selectExpr("doc", "bigint(nth) AS nth", "at - octet_length(left) AS a", "at + octet_length(right) AS b"),
            later.groupBy("doc", "nth", "at").agg(F.max("l").alias("most"), F.min("l").alias("fewest")).selectExpr(
                "doc", "bigint(nth) AS nth", "at - most AS a", f"at + {length} - fewest AS b"
            ),
        ]
    ranges = found_ranges[0]
    for more in found_ranges[1:]:
        ranges = ranges.union(more)
    return ranges.groupBy("doc", F.col("nth").cast("int").alias("nth")).agg(F.collect_list(F.struct("a", "b")).alias("ranges"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, text: str = "text", doc_id: str = "doc_id", kept: bool = True) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, the removed ``spans`` and, if wanted, the ``kept`` bytes."""
    numbered, every = _numbered(docs, text, doc_id)
    joined = every.join(covered(numbered, length, hot), ["doc", "nth"], "left").select("doc", "nth", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: 7 if kept else 6]
        span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
        for batch in batches:
            rows = []
            for doc, value, ranges in zip(batch["doc"], batch["text"], batch["ranges"], strict=True):
                body = value.as_py().encode()
                gone = _merged([(r["a"], r["b"]) for r in ranges.as_py()]) if ranges.is_valid else []
                edges = [0, *[x for pair in gone for x in pair], len(body)]
                left = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                doc = doc.as_py()
                rows.append((None if doc == _LEAST else doc, len(body), len(body) - len(left), len(gone), hashlib.sha256(left).hexdigest(), [{"a": a, "b": b} for a, b in gone], left))
            if rows:
                yield pa.record_batch([pa.array(x, kind) for x, kind in zip(list(zip(*rows, strict=True))[: len(names)], kinds, strict=False)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a: long, b: long>>"
    return joined.mapInArrow(cut, schema + ", kept binary" * kept)
