"""Sets of word shingles, and the exact comparison of texts that a search has brought into common buckets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import groups, lean, stored

#: Members of one side of a comparison, and the items of their sets; larger buckets are compared in blocks of this many.
BLOCK, BLOCK_ITEMS = 400, 2_000_000
#: Items whose intersections are counted at once.
ITEMS = 1_000_000
#: Members and items of a block that is compared together with others.
FEW, FEW_ITEMS = 32, 4000

#: Bytes whose words are hashed at once, unless one word is longer.
HASHED = 1 << 16

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    out = x >> np.uint64(33)
    out ^= x
    shifted = np.empty_like(out)
    for factor in _MIX:
        out *= np.uint64(factor)
        np.right_shift(out, np.uint64(33), out=shifted)
        out ^= shifted
    return out


@lru_cache(maxsize=4)
def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start and end. A space stands behind the last."""
    space = (data == 32) | (data - np.uint8(9) < 5)
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        change = np.append(0, change)
    return change[::2], change[1::2]


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, a polynomial of its bytes, from sums over all bytes before it."""
    out, low = np.empty(len(starts), np.uint64), 0
    while low < len(starts):
        a = starts[low]
        high = max(low + 1, int(np.searchsorted(starts, a + HASHED)))
        size = int(ends[high - 1] - a)
        n = 1 << max(HASHED.bit_length(), size.bit_length())
        sums = np.zeros(size + 1, np.uint64)
        terms = data[a : a + size].astype(np.uint64)
        terms += np.uint64(1)
        terms *= _powers(n)[:size]
        np.cumsum(terms, out=sums[1:])
        at = starts[low:high] - a
        out[low:high] = (sums[ends[low:high] - a] - sums[at]) * _powers(n, _INVERSE)[at]
        low = high
    return _mixed(out)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (split at space and 0x09-0x0D), and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, ends = edges(data)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes_of(data, starts, ends), np.diff(np.searchsorted(starts, bounds), prepend=0)


def run_hashes(hashes: np.ndarray, counts: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_hashes`` of texts whose words' hashes are known."""
    first = np.cumsum(counts) - counts
    each = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    at = np.repeat(first - np.cumsum(each) + each, each) + np.arange(each.sum())
    whole = bool((counts >= words).all())
    length = None if whole else np.repeat(np.minimum(counts, words), each)
    out = np.zeros(len(at), np.uint64)
    padded = np.append(hashes, np.zeros(words, np.uint64))
    for k in range(words):
        longer = out * np.uint64(_BASE)
        longer += padded[k:][at]
        longer = _mixed(longer)
        out = longer if whole else np.where(k < length, longer, out)
    return out, each


def shingle_hashes(texts: Sequence[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``words`` words, and their number by text; a shorter text is one run, one without words none."""
    return run_hashes(*word_hashes(texts), words)


def shingle_sets(texts: Sequence[bytes], words: int = 5) -> list[np.ndarray]:
    hashes, each = shingle_hashes(texts, words)
    return [np.unique(x) for x in np.split(hashes, np.cumsum(each)[:-1])]


@lru_cache(maxsize=4)
def _functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def minhashes(hashes: np.ndarray, each: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """``n`` minima per text, 0 where it has no shingle."""
    out = np.zeros((len(each), n), np.uint32)
    some = each > 0
    if some.any():
        starts = (np.cumsum(each) - each)[some]
        for i, (a, b) in enumerate(zip(*_functions(n, seed), strict=True)):
            out[some, i] = np.minimum.reduceat(((hashes * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, range of hashes by range, each with about ``ITEMS`` items."""
    parts = max(1, -(-sum(map(len, sets)) // ITEMS))
    edges = np.array([k * 2**64 // parts for k in range(1, parts)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in sets]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(parts):
        out += _common([s[c[k] : c[k + 1]] for s, c in zip(sets, cuts, strict=True)])
    return out


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Frequent items by matrix products, rare ones pair by pair."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.zeros(0, int)
    often = np.diff(np.append(starts, len(items)))
    for f in np.unique(often[(often > 1) & (often <= 12)]):
        members = owner[starts[often == f][:, None] + np.arange(f)]
        for i in range(f):
            for j in range(i + 1, f):
                out += np.bincount(members[:, i] * n + members[:, j], minlength=n * n).reshape(n, n)
    out += out.T
    many = np.flatnonzero(often > 12)
    for k in range(0, len(many), 2048):
        part = many[k : k + 2048]
        dense = np.zeros((n, len(part)), np.float32)
        for column, p in enumerate(part):
            dense[owner[starts[p] : starts[p] + often[p]], column] = 1
        out += dense @ dense.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _parts(links: np.ndarray) -> np.ndarray:
    """The connected part of each row of a symmetric matrix, by its least row."""
    part = np.full(len(links), -1)
    for i in range(len(links)):
        if part[i] < 0:
            front = np.zeros(len(links), bool)
            front[i] = True
            while front.any():
                part[front] = i
                front = links[front].any(0) & (part < 0)
    return part


def _blocks(members: DataFrame, block: int, items: str = "0") -> DataFrame:
    """``(leaf, id, n)`` to ``(leaf, a, b, first, id)``: each pair of a leaf's members meets in one block ``(a, b)`` of the leaf.

    ``first`` says on which side of the block a member stands. Leaves of up to
    ``block`` members with ``BLOCK_ITEMS`` ``items`` together are one block.
    """
    chunks = f"int(greatest(1, ceil(n / {float(block)}D), ceil({items} / {float(BLOCK_ITEMS)}D)))"
    own = f"int(pmod(xxhash64(id), {chunks}))"
    return members.selectExpr("id", "leaf", f"{own} AS own", f"explode(sequence(0, {chunks} - 1)) AS other").selectExpr(
        "id", "leaf", "least(own, other) AS a", "greatest(own, other) AS b", "own = least(own, other) AS first"
    )


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("leaf", "a", "b").sortWithinPartitions("leaf", "a", "b", "id")


def _block_key(table: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(table[n].to_pylist() for n in ("leaf", "a", "b")), strict=True))


def _close_pairs(items: np.ndarray, sizes: np.ndarray, starts: np.ndarray, threshold: float) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """``(block, pairs)`` of blocks with close pairs. ``items`` has the sets one after the other, ``sizes`` their sizes, ``starts`` each
    block's first set and the end; pairs count from there."""
    members = np.diff(starts)
    block = np.repeat(np.arange(len(members)), members)
    at = np.cumsum(members**2) - members**2
    # An item of a block with its owners in order.
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((items, block[owner]))
    items, owner = items[order], owner[order]
    blocks = block[owner]
    first = np.flatnonzero(np.concatenate([[True], (items[1:] != items[:-1]) | (blocks[1:] != blocks[:-1])])) if len(items) else np.zeros(0, int)
    often = np.diff(np.append(first, len(items)))
    common = np.zeros(int((members**2).sum()), np.int64)
    for f in np.unique(often[often > 1]):
        met = owner[first[often == f][:, None] + np.arange(f)]
        of = block[met[:, 0]]
        own, (i, j) = met - starts[of][:, None], np.triu_indices(f, 1)
        common += np.bincount((at[of][:, None] + own[:, i] * members[of][:, None] + own[:, j]).reshape(-1), minlength=len(common))
    wide = np.repeat(members, members**2)
    cell = np.arange(len(common)) - np.repeat(at, members**2)
    i, j = cell // wide, cell % wide
    low = np.repeat(starts[:-1], members**2)
    union = sizes[low + i] + sizes[low + j] - common
    close = np.flatnonzero((i < j) & (union > 0) & (common >= threshold * union - 1e-4))
    if len(close):
        of = np.repeat(np.arange(len(members)), members**2)[close]
        cuts = np.flatnonzero(np.diff(of)) + 1
        for part in np.split(np.arange(len(close)), cuts):
            yield int(of[part[0]]), list(zip(i[close[part]].tolist(), j[close[part]].tolist(), strict=True))


def _small_blocks(batch: pa.RecordBatch, threshold: float, found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Compares the small blocks that lie inside the batch, as ``linked`` does, into ``found``: ``(id, links, root)``; the other rows come out."""
    leaf, a, b = (batch[n].to_numpy() for n in ("leaf", "a", "b"))
    starts = np.flatnonzero((leaf[1:] != leaf[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    ends = np.append(starts, batch.num_rows)[1:]
    lengths = pc.binary_length(batch["items"]).to_numpy()
    held = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[np.append(starts, batch.num_rows)]
    # The first and the last block may go on in other batches.
    few = np.flatnonzero((ends - starts <= FEW) & (np.diff(held) <= 8 * FEW_ITEMS) & (ends < batch.num_rows))
    left = 0
    for start, end in zip(starts[few].tolist(), ends[few].tolist(), strict=True):
        if start > left:
            yield batch.slice(left, start - left)
        left = end
    several = few[ends[few] - starts[few] > 1]
    # So many blocks at once that their items and pairs stay few.
    total = np.cumsum(np.diff(held)[several])
    for own in np.split(several, np.searchsorted(total, np.arange(2 * ITEMS, total[-1], 2 * ITEMS))) if len(several) else []:
        _settled(batch, starts[own], ends[own], lengths, threshold, found)
    if left < batch.num_rows:
        yield batch.slice(left)


def _settled(batch: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, threshold: float, found: list[tuple]) -> None:
    """Compares the blocks of the batch between ``starts`` and ``ends``, as ``_small_blocks`` says."""
    if not len(starts):
        return
    members = ends - starts
    rows = np.repeat(starts - np.cumsum(members) + members, members) + np.arange(members.sum())
    sets = batch["items"].take(pa.array(rows))
    bounds = np.frombuffer(sets.buffers()[1], np.int32, len(rows) + 1)
    items = np.frombuffer(sets.buffers()[2], np.uint64, int(bounds[-1]) // 8) if bounds[-1] else np.zeros(0, np.uint64)
    for block, pairs in _close_pairs(items, lengths[rows].astype(np.int64) // 8, np.append(0, np.cumsum(members)), threshold):
        start, end = int(starts[block]), int(ends[block])
        links, part, own = [0] * (end - start), list(range(end - start)), batch["leaf"][start].as_py()
        ids, leaves = (batch[n].slice(start, end - start).to_pylist() for n in ("id", "leaves"))
        first = batch["first"].slice(start, end - start).to_pylist() if batch["a"][start].as_py() != batch["b"][start].as_py() else None
        for i, j in pairs:
            if part[i] != part[j]:
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
            if first and first[i] == first[j]:
                continue
            if not any(x < own for x in set(leaves[i]).intersection(leaves[j])):
                links[i] += 1
                links[j] += 1
        found += [(ids[k], links[k], ids[part[k]]) for k in sorted({k for pair in pairs for k in pair})]


def likely(leaves: DataFrame, sketches: DataFrame, equal: int, block: int = BLOCK) -> DataFrame:
    """The rows ``(leaf, id)`` of members that share at least ``equal`` coordinates of their sketches with another one of the leaf.

    ``sketches`` has ``(id, sketch)``, an array of integers. This is far less to
    move than the sets, and leaves few members to compare exactly.
    """
    counts = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    ready = _blocks(leaves.join(counts, "leaf"), block).join(sketches, "id")

    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (leaf, _, _), table in groups(batches, _block_key):
            if table.num_rows < 2:
                continue
            sketch = np.stack([np.asarray(x, np.int64) for x in table["sketch"].to_pylist()])
            same = np.zeros((len(sketch), len(sketch)), np.int16)
            for column in sketch.T:
                same += column[:, None] == column
            np.fill_diagonal(same, 0)
            has = np.flatnonzero((same >= equal).any(0))
            if len(has):
                yield pa.record_batch({"leaf": pa.array([leaf] * len(has), pa.int64()), "id": table["id"].take(pa.array(has)).combine_chunks()})

    return _in_blocks(ready).mapInArrow(lean(screened), "leaf long, id binary").distinct()


def linked(leaves: DataFrame, sets: DataFrame, threshold: float, block: int = BLOCK, sizes: DataFrame | None = None) -> DataFrame:
    """Compare all texts that share a leaf: ``(id, links, root)`` for each block in which a text has a link.

    ``leaves`` has ``(leaf, id)``, ``sets`` ``(id, items)``: sorted 64-bit hashes
    as bytes. Summed over a text's rows, ``links`` is the number of texts with
    Jaccard similarity of at least ``threshold``: a pair that meets in several
    leaves is counted in the least of them, which both texts' lists of leaves
    tell. ``root`` is a text of the same connected part. Pairs are never rows:
    a block of at most two times ``block`` members is compared in memory, and
    with ``sizes``, ``(id, n_items)``, about as many times ``BLOCK_ITEMS`` items
    (a larger set is whole). Leaves with the same members count once.
    """
    leaves = leaves.distinct()
    marks = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    once = stored(marks.where("n > 1").groupBy("n", "x", "y").agg(F.min("leaf").alias("leaf")).select("leaf", "n"))
    members = stored(leaves.join(once, "leaf"))
    lists = members.groupBy("id").agg(F.collect_list("leaf").alias("leaves"))
    weighed = members.withColumn("items", F.lit(0))
    if sizes is not None:
        weights = members.join(sizes, "id").groupBy("leaf").agg(F.sum("n_items").alias("items"))
        weighed = members.join(weights, "leaf")
    ordered = _in_blocks(_blocks(weighed, block, "items").join(sets.join(lists, "id"), "id"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def settled() -> Iterator[pa.RecordBatch]:
            if found:
                ids, links, roots = zip(*found, strict=True)
                yield pa.record_batch({"id": pa.array(ids, pa.binary()), "links": pa.array(links, pa.int64()), "root": pa.array(roots, pa.binary())})
                found.clear()

        for (leaf, a, b), table in groups((part for batch in batches for part in _small_blocks(batch, threshold, found)), _block_key):
            yield from settled()
            n = table.num_rows
            if n < 2:
                continue
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"]]
            common = common_counts(items)
            sizes = np.array([len(x) for x in items], np.float32)
            union = sizes[:, None] + sizes - common
            close = common >= threshold * union - 1e-4
            close &= union > 0
            np.fill_diagonal(close, False)
            counted = close.copy()
            if a != b:
                first = table["first"].to_numpy(zero_copy_only=False)
                counted &= first[:, None] != first
            before: dict[int, list[int]] = {}
            for i, others in enumerate(table["leaves"].to_pylist()):
                for other in others:
                    if other < leaf:
                        before.setdefault(other, []).append(i)
            for met in before.values():
                if len(met) > 1:
                    counted[np.ix_(met, met)] = False
            part = _parts(close)
            has = np.flatnonzero(close.any(0))
            if len(has):
                ids = table["id"].take(pa.array(has)).combine_chunks()
                roots = table["id"].take(pa.array(part[has])).combine_chunks()
                yield pa.record_batch({"id": ids, "links": pa.array(counted.sum(0)[has].astype(np.int64)), "root": roots})
        yield from settled()

    return ordered.mapInArrow(lean(compared), "id binary, links long, root binary")
