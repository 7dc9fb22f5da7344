"""Queries that write a table below the session's shared folder and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.catalog.baseball import _NAMES, _PLAYER, _SHARES, _pitches_sql
from pitchflow.catalog.derived import SQL_PBP, SQL_PLAYS, SQL_RAW, feed, plays, raw_events, undotted
from pitchflow.catalog.registry import Tables, query
from pitchflow.operators.kept import CountLog
from pitchflow.operators.ordered import fill_up, last_of_group_flag
from pitchflow.operators.profile import count_schema, countable_pitches, pitcher_tendencies, tendencies_of_counts
from pitchflow.operators.relational import code_frequencies
from pitchflow.plans.games import normalise_game
from pitchflow.session import work_folder
from pitchflow.sources.tables import (
    pitcher_range, read_codes, read_csv, read_pbp, read_pitches, write_by_game, write_clustered, write_pbp, write_sample,
)

_PITCH_SQL = f"""WITH {SQL_RAW}, p AS (
  SELECT CAST(ts AS DATE) AS day, game_pk, 500 + user_id % 40 AS pitcher, 1000 + user_id % 97 AS batter, event_type AS description,
         CAST(event_id % 240 AS INTEGER) AS pitch_number, CASE WHEN k % 5 <> 0 THEN k % 14 END AS zone,
         CASE WHEN k % 7 <> 0 THEN user_id END AS on_2b FROM raw)
"""
_PITCH_COLUMNS = ["game_pk", "pitcher", "batter", "description", "pitch_number", "zone", "on_2b"]
_PITCH_OUT = "SELECT CAST(day AS VARCHAR) AS game_date, " + ", ".join(_PITCH_COLUMNS) + " FROM p "


def _pitch_rows(t: Tables) -> DataFrame:
    return raw_events(t.events).selectExpr(
        "to_date(ts) AS game_date", "game_pk", "500 + user_id % 40 AS pitcher", "1000 + user_id % 97 AS batter", "event_type AS description",
        "cast(event_id % 240 AS int) AS pitch_number", "cast(if(k % 5 <> 0, k % 14, NULL) AS int) AS zone",
        "if(k % 7 <> 0, user_id, NULL) AS on_2b",
    )


def _pitch_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("game_date").cast("string").alias("game_date"), *_PITCH_COLUMNS)


@query("pitch_table", _PITCH_SQL + _PITCH_OUT + "WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-17'")
def pitch_table(t: Tables):
    folder = work_folder(t.spark)
    rows = _pitch_rows(t).withColumns({"zone": F.col("zone").cast("double"), "on_2b": F.col("on_2b").cast("double")})
    rows.hint("rebalance", "game_date").write.partitionBy("game_date").parquet(folder)
    return _pitch_out(_whole(read_pitches(t.spark, folder, "2024-01-05", "2024-01-17")))


def _whole(df: DataFrame) -> DataFrame:
    return df.withColumns({"zone": F.col("zone").cast("int"), "on_2b": F.col("on_2b").cast("bigint")})


@query("codes_table", f"""WITH {SQL_PLAYS} SELECT details_type_code, details_type_description, count(*) AS cnt FROM plays
WHERE type = 'pitch' GROUP BY ALL""")
def codes_table(t: Tables):
    folder = work_folder(t.spark)
    counted = code_frequencies(plays(t.events).where("type = 'pitch'"), "details.type.code", "details.type.description")
    counted.coalesce(1).write.option("header", True).option("nullValue", "NA").csv(folder)  # a row per code
    return undotted(read_codes(t.spark, folder))


@query("sample_table", """SELECT CAST(row_number() OVER (ORDER BY value DESC, event_id) - 1 AS INTEGER) AS _c0, event_id, user_id, event_type FROM events""")
def sample_table(t: Tables):
    folder = work_folder(t.spark)
    write_sample(t.events.select("event_id", "user_id", "event_type", (-F.col("value")).alias("down")), folder, ["down", "event_id"], None)
    kinds = {"event_id": "BIGINT", "user_id": "BIGINT", "event_type": "STRING", "down": "DOUBLE"}
    return read_csv(t.spark, folder, kinds, index=True).drop("down")


@query("season_table", f"WITH {SQL_PBP['parent']} SELECT {_NAMES} FROM pbp")
def season_table(t: Tables):
    folder = work_folder(t.spark)
    write_pbp(normalise_game(feed(t.events), "parent", doc_keys=["game_pk"]), folder)
    return undotted(read_pbp(t.spark, folder))


def by_game(t: Tables) -> DataFrame:
    """The plays as a table in buckets by game, under a name of its own."""
    name = f"plays_{uuid.uuid4().hex}"
    write_by_game(plays(t.events), name, work_folder(t.spark), buckets=16)
    return t.spark.table(name)


@query(
    "bucketed_fill_and_flag",
    f"""WITH {SQL_PLAYS} SELECT game_pk, event_pos, atBatIndex,
  last_value(result_event IGNORE NULLS) OVER (PARTITION BY game_pk ORDER BY event_pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS result_event,
  CASE WHEN bool_or(pitchNumber IS NULL) OVER g THEN NULL WHEN pitchNumber = max(pitchNumber) OVER g THEN 'true' ELSE 'false' END AS last_flag
FROM plays WINDOW g AS (PARTITION BY game_pk, atBatIndex)""",
)
def bucketed_fill_and_flag(t: Tables):
    return fill_and_flag(by_game(t))


def fill_and_flag(table: DataFrame) -> DataFrame:
    # A game has at most 240 events, so the windows are small.
    some = table.select("game_pk", "event_pos", "atBatIndex", F.col("`result.event`").alias("result_event"), "pitchNumber")
    filled = fill_up(some, ["result_event"], ["game_pk"], ["event_pos"], segment=None)
    return last_of_group_flag(filled, "pitchNumber", ["game_pk", "atBatIndex"], "last_flag", segment=None).drop("pitchNumber")


@query("clustered_pitcher_range", _PITCH_SQL + _PITCH_OUT + "WHERE pitcher = 507 AND day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'")
def clustered_pitcher_range(t: Tables):
    folder = work_folder(t.spark)
    write_clustered(_pitch_rows(t), folder, ["pitcher", "game_date"], ["batter"])
    rows = t.spark.read.schema(_pitch_rows(t).schema).parquet(folder)
    return _pitch_out(pitcher_range(rows, "2024-01-03", "2024-01-20", 507))


@query("checked_tendencies", _pitches_sql("pitcher", 0.5, 505) + f'SELECT pitcher, "Count", {_PLAYER}, {_SHARES} FROM p GROUP BY pitcher, "Count"')
def checked_tendencies(t: Tables):
    return pitcher_tendencies(plays(t.events), 505, add_count=True, check="action")


@query(
    "kept_tendencies",
    _pitches_sql("pitcher") + f'SELECT pitcher, "Count", outs, {_PLAYER}, {_SHARES} FROM p GROUP BY pitcher, "Count", outs',
)
def kept_tendencies(t: Tables):
    """Two thirds of the games land in part, the others whole, then the first ones again and whole."""
    every = plays(t.events)
    log = CountLog(t.spark, work_folder(t.spark), count_schema("pitcher"), "game_pk")
    for number, some in enumerate(("game_pk % 3 <> 1 AND event_pos < 100", "game_pk % 3 = 1", "game_pk % 3 <> 1")):
        batch = every.where(some)
        log.apply(countable_pitches(batch, "pitcher"), batch.select("game_pk"), number)
    return tendencies_of_counts(log.counts(), "pitcher", True, True)
