"""Landed documents: game feeds and schedules.

Feeds are landed as JSON Lines, one game per line, with ``game_pk`` stamped on
the record. Lines split across tasks; whole-file documents (``whole_files``)
give one task per file at best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.operators.nested import explode_path
from pitchflow.schemas import CORRUPT, FEED, SCHEDULE, c


def parse_documents(df: DataFrame, text: str | Column, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A JSON text column as the columns of ``schema`` plus the broken text, if any.

    The one-element ``inline`` keeps the parse in one place: as a plain
    expression it would be repeated wherever a later filter or projection needs
    a part of it. The schema is always read in full, so a document counts as
    broken or not whatever columns are used afterwards.
    """
    col = F.col(text) if isinstance(text, str) else text
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    document = F.from_json(col, f"{schema}, {CORRUPT} STRING", options)
    return df.select(*keep, F.inline(F.array(document)))


# Tells documents apart even if a game has been landed more than once.
DOC_ID = "doc_id"
# A landed document as text, beside its game_pk.
TEXT = "document"
# A parsed document's columns besides those of its schema.
STATUS = "status"


def parse_feed(df: DataFrame, text: str | Column = "value", keep: tuple[str, ...] = (), schema: str = FEED) -> DataFrame:
    """Game documents from JSON text, every one of them: ``status`` says ok or error.

    A document without ``game_pk`` is an error. An error's text is in the
    corrupt-record column. :func:`good_documents` and :func:`broken_documents`
    take the two kinds apart; nothing is dropped here. ``keep`` carries columns of
    ``df`` along, for instance the text itself, so that fields that the schema
    does not name can still be read later; ``schema`` may have more fields, see
    :func:`pitchflow.schemas.feed_schema`.
    """
    parsed = parse_documents(df, text, schema, keep)
    bad = F.col(CORRUPT).isNotNull() | F.col("game_pk").isNull()
    return parsed.withColumn(STATUS, F.when(bad, "error").otherwise("ok"))


def good_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(STATUS) == "ok").drop(CORRUPT, STATUS)


def broken_documents(parsed: DataFrame) -> DataFrame:
    """The error table: what was carried along, the status, and the text."""
    known = [n for n in parsed.columns if n not in (CORRUPT, STATUS, "gameData", "liveData", "dates", TEXT)]
    return parsed.where(F.col(STATUS) == "error").select(*[c(n) for n in known], STATUS, F.col(CORRUPT).alias(TEXT))


def landed(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed texts with ``game_pk`` read from each and a row id, not parsed yet.

    The id is given right at the scan of unchanging files, so a task that is run
    again gives the same ids. A text without a readable ``game_pk`` has none.
    """
    texts = spark.read.text(path, wholetext=whole_files).where(F.length("value") > 0)
    return with_game_pk(texts.withColumn(DOC_ID, F.monotonically_increasing_id()))


def with_game_pk(texts: DataFrame, text: str = "value") -> DataFrame:
    """``game_pk`` beside each text, by a look for this one field."""
    return texts.withColumn("game_pk", F.get_json_object(text, "$.game_pk").cast("bigint")).withColumnRenamed(text, TEXT)


def read_feed(spark: SparkSession, path: str, whole_files: bool = False, schema: str = FEED) -> DataFrame:
    """All landed game documents, parsed, with a row id and a status; see :func:`parse_feed`."""
    return parse_feed(landed(spark, path, whole_files).drop("game_pk"), TEXT, (DOC_ID,), schema)


def schedule_games(documents: DataFrame) -> DataFrame:
    """Schedule documents as one row per listed game, with its day as ``date``."""
    return explode_path(documents, ["dates", "games"], parents={"date": "0.date"})


def parse_schedule(df: DataFrame, text: str | Column = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Schedule documents from JSON text, every one of them, with a status as in :func:`parse_feed`."""
    parsed = parse_documents(df, text, SCHEDULE, keep)
    bad = F.col(CORRUPT).isNotNull() | F.col("dates").isNull()
    return parsed.withColumn(STATUS, F.when(bad, "error").otherwise("ok"))


def read_schedule(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """All landed schedule documents with their status; ``schedule_games(good_documents(...))`` lists the games."""
    texts = spark.read.text(path, wholetext=whole_files).where(F.length("value") > 0)
    return parse_schedule(texts)


def event_variants(texts: DataFrame, keep: tuple[str, ...] = ("game_pk", DOC_ID), text: str = TEXT) -> DataFrame:
    """Every event whole, as a VARIANT beside its place ``event_pos``: all its fields, also those no schema names.

    ``variant_get(event, '$.pitchData.startSpeed', 'double')`` reads one. The rows
    are those of :func:`pitchflow.plans.games.normalise_game` by ``event_pos``.
    """
    shape = "liveData STRUCT<plays: STRUCT<allPlays: ARRAY<STRUCT<playEvents: ARRAY<VARIANT>>>>>"
    lists = "filter(transform(_d.liveData.plays.allPlays, p -> p.playEvents), e -> e IS NOT NULL)"
    return texts.select(*keep, F.from_json(text, shape).alias("_d")).selectExpr(*keep, f"posexplode(flatten({lists})) AS (event_pos, event)")
