"""The corpus pipeline: documents through five stages, each written as Parquet and read again by the next.

Null and empty texts, repeated rows, empty tables and extra columns behave in
every stage as its operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.llm import bpe_chunks, chosen_path, line_dedup, mixing, quality_classifier
from pitchflow.llm.common import fresh, quoted, read, shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the attention model predicts to be of quality; the others go."""
    model = quality_classifier.fit(docs, read(spark, folder, "labels"))
    names = fresh(docs, "score", "predicted")
    return quality_classifier.score(docs, model, names=tuple(names)).where(f"{names[1]} = 1").select(*[quoted(n) for n in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that stand in five documents or more stay in one; ``n_chars`` follows the text."""
    index = line_dedup.LineIndex.build(docs, min_docs=5, min_chars=40)
    cleaned = line_dedup.drop_repeated_lines(docs, index, names=tuple(fresh(docs, "n_lines", "n_dropped")))
    return with_length(cleaned, docs.columns)


def with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` in their order, ``n_chars`` anew where there is one."""
    length = F.char_length("text").cast("long").alias("n_chars")
    return docs.select(*[length if n == "n_chars" else F.col(quoted(n)) for n in columns])


def keep_one(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the least id."""
    return chosen_path.one_of_each_class(docs, chosen_path.similarity_join(docs)).select(*[quoted(n) for n in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mixture by source weights; a document stands in it as often as it is drawn."""
    # The whole row goes along as one column, so no name of a document's columns meets one of the operator's.
    rows = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"), F.struct("*").alias("row"))
    return mixing.mixture(mixing.mix(rows, size=F.col("words"))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document of the mixture, with digests of the ids and of the text decoded from them."""
    return bpe_chunks.transcode(docs, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), release=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good), ("line_dedup", drop_lines), ("chosen_path", keep_one), ("mixture", mix_sources),
    ("bpe", encode),
]

#: A trained classifier and a tokenizer can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, folder)
        if k + 1 < len(STAGES):
            path = shared_folder(spark)
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        docs = out
    return docs
