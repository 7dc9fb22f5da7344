"""What several operators of this folder share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, and what a word is.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def read(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors and the driver see.

    Only where the session names none and runs in one process (tests) a temporary folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pitchflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here, and lost executors cost nothing."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that ``df`` does not have, for working columns."""
    taken, out = {n.lower() for n in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def digest(col: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(col))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Free memory that this process's allocators hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` for ``mapInArrow``; after it, its worker, which lives on, holds no memory that is free."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def groups(batches: Iterator[pa.RecordBatch], key: Callable[[pa.RecordBatch], list]) -> Iterator[tuple]:
    """Runs of equal keys in sorted batches, as ``(key, table)``; a run may go on over several batches."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, start = key(batch), 0
        for end in [*(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]:
            if held and keys[start] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = keys[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield last, pa.Table.from_batches(held)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges, as ``(node, root)`` with the least node as the root.

    Alternates two steps until all nodes hang on roots: every node hangs its larger
    neighbours, and then its smaller ones, on its least neighbour (large star,
    small star). Rounds grow with the logarithm of the longest path. Each step
    only needs a node's least neighbour, a partial aggregate, so no node's
    edges meet in one task; the joins split frequent nodes by salt.
    Without edges the result is empty.
    """
    salts = 16
    edges = stored(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    )

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # (u, v): v is to hang on the least of u and its neighbours.
        both = pairs.selectExpr("hi AS u", "lo AS v") if not large else pairs.selectExpr("lo AS u", "hi AS v").union(
            pairs.selectExpr("hi AS u", "lo AS v")
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        spread = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
        joined = spread.join(salted, ["u", "salt"])
        hung = joined.where("v > u" if large else "true").select(F.col("v").alias("x"), "m")
        if not large:
            hung = hung.union(least.selectExpr("u AS x", "m"))
        return hung.where("x <> m").select(F.least("x", "m").alias("lo"), F.greatest("x", "m").alias("hi")).distinct()

    def settled(df: DataFrame) -> bool:
        # Each node either is a root or hangs on one root.
        ends = df.selectExpr("hi AS node", "1 AS hangs", "0 AS holds").union(df.selectExpr("lo", "0", "1"))
        return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs + holds > 1").isEmpty()

    while not settled(edges):
        edges = stored(star(star(edges, True), False))
    nodes = edges.selectExpr("hi AS node", "lo AS root")
    return nodes.union(edges.selectExpr("lo AS node", "lo AS root").distinct())
