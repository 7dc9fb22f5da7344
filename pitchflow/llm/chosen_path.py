"""Similarity join of texts by chosen paths (Christiani, Pagh, Sivertsen 2018).

A text is the set of its five-word shingles; two texts are linked if the
Jaccard similarity of their sets is at least 0.8. Each of several runs splits
all sets recursively: a node of the recursion samples one or two coordinates of
the MinHash sketch, by its path alone, and every set goes to the children that
its tokens there name. So similar sets follow the same paths. Nodes with few
sets are leaves; so are those at the greatest depth, whatever their size. The
number of runs follows from the recall wanted. Members of a leaf whose sketches
agree with another's in as many coordinates as all but one pair in 100,000 at
the threshold do are then compared exactly, in blocks.

The recursion goes level by level over narrow rows ``(path, text)``. Equal
texts are one text from the start, so a group of copies of any size is one row.
A leaf of any size is worked in blocks of bounded size, and a text's links are
counted there without a row per pair: nothing is capped or dropped.

Texts of fewer than five words are one shingle; texts without words link to
nothing, but equal texts always share a class. Null texts are empty ones. Null
ids are carried; a class is named after its least id that isn't null. Repeated
rows are copies. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import components, digest, fresh, lean, stored
from pitchflow.llm.shingles import likely, linked, minhashes, shingle_hashes, shingle_sets

THRESHOLD = 0.8
RECALL = 0.995
WORDS = 5
#: Coordinates of the sketch, the largest bucket that isn't split, and the depth of the recursion.
SKETCH, LEAF, DEPTH = 32, 200, 3
#: One node in so many samples a second coordinate: 1.25 on average, the inverse of the threshold.
SECOND = 4


def survival(similarity: float, depth: int) -> float:
    """How likely two sets of this similarity share a node ``depth`` levels down in one run."""
    share = 1.0
    for _ in range(depth):
        miss = 1 - similarity * share
        share = 1 - ((1 - 1 / SECOND) * miss + miss * miss / SECOND)
    return share


def runs_for(recall: float, similarity: float = THRESHOLD, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth)))


def surely_equal(similarity: float, miss: float = 1e-5) -> int:
    """The most equal coordinates that sets of this similarity have but for a share ``miss`` of all pairs."""
    below = 0.0
    for k in range(SKETCH + 1):
        below += math.comb(SKETCH, k) * similarity**k * (1 - similarity) ** (SKETCH - k)
        if below > miss:
            return k
    return SKETCH


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with their texts, about ``size`` bytes of text at once."""
    for batch in batches:
        start, held, total = 0, [], 0
        for i, value in enumerate(batch["text"]):
            held.append(value.as_py().encode())
            total += len(held[-1])
            if total >= size or i == batch.num_rows - 1:
                yield batch.slice(start, len(held)), held
                start, held, total = i + 1, [], 0


def chosen_paths(sketches: DataFrame, runs: int, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """``(id, sketch)`` to ``(leaf, id)``: the leaves in which a set meets others."""
    start = sketches.selectExpr("id", "sketch", f"explode(sequence(1L, {runs}L)) AS path")
    leaves = []
    rows = start
    for level in range(1, depth + 1):
        first = f"int(pmod(xxhash64(path, {level}, 1), {SKETCH}))"
        second = f"int(pmod({first} + 1 + pmod(xxhash64(path, {level}, 2), {SKETCH - 1}), {SKETCH}))"
        chosen = f"if(pmod(xxhash64(path, {level}, 3), {SECOND}) = 0, array({first}, {second}), array({first}))"
        rows = rows.join(sketches, "id") if "sketch" not in rows.columns else rows
        children = rows.selectExpr("id", f"explode(transform({chosen}, c -> xxhash64(path, c, sketch[c]))) AS path")
        counts = children.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
        limit = leaf if level < depth else 1 << 62
        met = stored(children.join(counts.where("n > 1"), "path"))
        leaves.append(met.where(F.col("n") <= limit).selectExpr("path AS leaf", "id"))
        rows = met.where(F.col("n") > limit).select("id", "path")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def similarity_join(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, words: int = WORDS, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_id`` (a digest), ``class_id``, ``n_copies`` of its text, ``n_links`` to different texts."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("id", digest(F.col("text")))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _slices(batches):
            hashes, each = shingle_hashes(texts, words)
            sketch = minhashes(hashes, each, SKETCH).view(np.int32)
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], part["id"], pa.array([x if n else None for x, n in zip(sketch, each, strict=True)], pa.list_(pa.int32())),
                pa.array(each, pa.int64()),
            ], names=["doc_id", "id", "sketch", "n_items"])

    narrow = stored(rows.mapInArrow(lean(sketched), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, id binary, sketch array<int>, n_items long"))
    texts = stored(narrow.groupBy("id").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("sketch").alias("sketch"), F.first("n_items").alias("n_items"),
    ))
    sketches = texts.where("sketch IS NOT NULL").select("id", "sketch")
    met = chosen_paths(sketches, runs_for(recall, threshold))
    leaves = stored(likely(met, sketches, surely_equal(threshold)))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _slices(batches):
            yield pa.record_batch({"id": part["id"], "items": pa.array([x.tobytes() for x in shingle_sets(own, words)], pa.binary())})

    # Only texts that met another one are read again, one document for each.
    candidates = leaves.select("id").distinct().join(texts.select("id", "least"), "id")
    chosen = rows.join(candidates.withColumnRenamed("id", "_id"), F.expr("doc_id <=> least AND id = _id")).select("id", "text").dropDuplicates(["id"])
    found = stored(linked(leaves, chosen.mapInArrow(lean(sets), "id binary, items binary"), threshold, sizes=texts.select("id", "n_items")))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    parts = components(found.select("id", "root"), "id", "root")

    named = texts.join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    classes = named.groupBy("root").agg(F.min("least").alias("class_id"))
    facts = named.join(classes, "root").selectExpr("id", "class_id", "n_copies", "coalesce(n_links, 0L) AS n_links")
    # A text with very many copies is a row here and many there: copies are split by salt.
    salts = 16
    left = narrow.select("doc_id", "id", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    right = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, ["id", "salt"]).select("doc_id", F.lower(F.hex("id")).alias("text_id"), "class_id", "n_copies", "n_links")


def one_of_each_class(docs: DataFrame, joined: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their class: the least id, one row of it."""
    stays_id, stays_text, times, nth = fresh(docs, "_stays", "_stays_text", "_times", "_nth")
    stays = joined.where("doc_id <=> class_id").groupBy(F.col("doc_id").alias(stays_id), F.col("text_id").alias(stays_text)).agg(F.count(F.lit(1)).alias(times))
    stays = stored(stays)
    key = F.lower(F.hex(digest(F.coalesce(F.col(text), F.lit("")))))
    met = docs.join(stays, F.col(doc_id).eqNullSafe(F.col(stays_id)) & (key == F.col(stays_text)))
    if not stays.where(f"{times} > 1").isEmpty():  # rows that repeat id and text: one of them
        ranked = met.selectExpr("*", f"row_number() OVER (PARTITION BY {stays_id}, {stays_text} ORDER BY 1) AS {nth}")
        met = ranked.where(f"{nth} = 1").drop(nth)
    return met.drop(stays_id, stays_text, times)
