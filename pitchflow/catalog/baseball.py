"""Queries of the pitch pipeline, on games derived from the events table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pitchflow.catalog.derived import (
    SQL_PBP, SQL_PLAYS, SQL_RAW, feed, feed_texts, flat_name, plays, raw_events, schedule_texts, undotted,
)
from pitchflow.catalog.registry import Tables, query
from pitchflow.functions.pitches import BUCKETS, SINGLE_TYPES
from pitchflow.functions.text import date_prefix
from pitchflow.operators.calendar import pull_weeks, season_summary
from pitchflow.operators.nested import explode_path, game_meta
from pitchflow.operators.ordered import fill_up
from pitchflow.operators.profile import batter_tendencies, pitcher_tendencies, tendencies_all_levels
from pitchflow.operators.relational import code_frequencies, left_join_suffixed
from pitchflow.plans.games import normalise_game, season_games, season_pbp
from pitchflow.schemas import PBP
from pitchflow.sources.feeds import TEXT, broken_documents, good_documents, parse_feed, parse_schedule, schedule_games

# --- tendencies ----------------------------------------------------------------

_SHARES = ", ".join(
    f"sum(CASE WHEN details_type_code IN ({', '.join(repr(x) for x in codes)}) THEN 1 ELSE 0 END) / count(*) AS {name}"
    for name, codes in (BUCKETS | {n: (x,) for n, x in SINGLE_TYPES.items()}).items()
)
# The label's text.
_COUNT = """CASE WHEN details_isStrike IS NULL THEN NULL
  WHEN details_isStrike THEN count_balls_start || '-' || (count_strikes_start - 1)
  WHEN details_isBall THEN (count_balls_start - 1) || '-' || count_strikes_start
  WHEN details_isInPlay THEN count_balls_start || '-' || count_strikes_start
  ELSE 'Pitch Not a Ball or Strike. Original Count: ' || count_balls_start || '-' || count_strikes_start END"""


def _pitches_sql(who: str, confidence: float = 0.5, entity_id: int = 0) -> str:
    one = f" AND matchup_{who}_id = {entity_id}" if entity_id else ""
    return f"""WITH {SQL_PLAYS}, p AS (
  SELECT matchup_{who}_id AS {who}, matchup_{who}_fullName AS player_name, {_COUNT} AS "Count",
         count_outs_start AS outs, details_type_code FROM plays
  WHERE pitchData_typeConfidence >= {confidence} AND type = 'pitch' AND details_type_code IS NOT NULL{one})
"""


_PLAYER = "CASE WHEN count(*) = count(player_name) THEN max(player_name) END AS player, count(*) AS pitches"

_LEVELS = {"": [], "_count": ["Count"], "_outs": ["outs"], "_count_outs": ["Count", "outs"]}
for _who, _run in (("pitcher", pitcher_tendencies), ("batter", batter_tendencies)):
    for _suffix, _extra in _LEVELS.items():
        _keys = ", ".join([_who, *[f'"{e}"' for e in _extra]])
        query(
            f"{_who}_tendencies{_suffix}",
            _pitches_sql(_who) + f"SELECT {_keys}, {_PLAYER}, {_SHARES} FROM p GROUP BY {_keys}",
        )(lambda t, run=_run, extra=_extra: run(plays(t.events), add_count="Count" in extra, add_outs="outs" in extra))


@query(
    "one_pitcher_tendencies",
    _pitches_sql("pitcher", 0.005, 505)
    + f'SELECT pitcher, "Count", outs, {_PLAYER}, {_SHARES} FROM p GROUP BY pitcher, "Count", outs',
)
def one_pitcher(t: Tables):
    return pitcher_tendencies(plays(t.events), 505, 0.005, add_count=True, add_outs=True)


for _who in ("pitcher", "batter"):
    query(
        f"{_who}_tendencies_all_levels",
        _pitches_sql(_who)
        + f"""SELECT {_who}, "Count", outs, '{_who}' || CASE WHEN grouping("Count") = 0 THEN ',Count' ELSE '' END
  || CASE WHEN grouping(outs) = 0 THEN ',outs' ELSE '' END AS level, {_PLAYER}, {_SHARES}
FROM p GROUP BY GROUPING SETS (({_who}), ({_who}, "Count"), ({_who}, outs), ({_who}, "Count", outs))""",
    )(lambda t, who=_who: tendencies_all_levels(plays(t.events), who))


@query(
    "pitch_type_frequencies",
    f"""WITH {SQL_PLAYS} SELECT details_type_code, details_type_description, count(*) AS cnt FROM plays
WHERE type = 'pitch' GROUP BY ALL ORDER BY 1 NULLS LAST""",
)
def type_frequencies(t: Tables):
    pitches = plays(t.events).where("type = 'pitch'")
    return undotted(code_frequencies(pitches, "details.type.code", "details.type.description"))


@query(
    "call_frequencies",
    f"WITH {SQL_PLAYS} SELECT details_code, details_call_description, count(*) AS cnt FROM plays GROUP BY ALL ORDER BY 1 NULLS LAST",
)
def call_frequencies(t: Tables):
    return undotted(code_frequencies(plays(t.events), "details.code", "details.call.description"))


# --- documents -------------------------------------------------------------------

_NAMES = ", ".join(flat_name(n) for n in PBP)


@query("game_pbp_reference", f"WITH {SQL_PBP['reference']} SELECT {_NAMES} FROM pbp")
def game_pbp_reference(t: Tables):
    return undotted(normalise_game(feed(t.events), "reference", doc_keys=["game_pk"]))


@query("game_pbp_parent", f"WITH {SQL_PBP['parent']} SELECT {_NAMES} FROM pbp")
def game_pbp_parent(t: Tables):
    return undotted(normalise_game(feed(t.events), "parent", doc_keys=["game_pk"]))


@query(
    "pbp_pitcher_tendencies",
    f"""WITH {SQL_PBP['reference']}
SELECT matchup_pitcher_id AS pitcher, CASE WHEN count(*) = count(matchup_pitcher_fullName)
  THEN max(matchup_pitcher_fullName) END AS player, count(*) AS pitches, {_SHARES}
FROM pbp WHERE pitchData_typeConfidence >= 0.5 AND type = 'pitch' AND details_type_code IS NOT NULL GROUP BY 1""",
)
def pbp_pitcher_tendencies(t: Tables):
    return pitcher_tendencies(normalise_game(feed(t.events), "reference", doc_keys=["game_pk"]))


@query(
    "record_path_events",
    f"WITH {SQL_PLAYS} SELECT game_pk, atBatIndex, CAST(event_pos % 6 AS INTEGER) AS pos_1, type, pitchNumber, "
    "endTime, details_type_code FROM plays",
)
def record_path_events(t: Tables):
    out = explode_path(
        feed(t.events), ["liveData.plays.allPlays", "playEvents"], keep=["game_pk"],
        parents={"atBatIndex": "0.atBatIndex"}, positions=True,
    )
    return undotted(out.select("game_pk", "atBatIndex", "pos_1", "type", "pitchNumber", "endTime", "`details.type.code`"))


@query(
    "game_metadata",
    f"""WITH {SQL_RAW} SELECT game_pk, 'Team ' || (game_pk % 30) AS home_team, 'Team ' || ((game_pk + 7) % 30) AS away_team,
  103 + game_pk % 30 % 2 AS home_league_id, CASE WHEN game_pk % 10 = 0 THEN 'Live' ELSE 'Final' END AS game_status,
  strftime(min(ts), '%Y-%m-%d') AS game_date, max(ab) AS current_at_bat FROM raw GROUP BY game_pk""",
)
def game_metadata(t: Tables):
    meta = game_meta(current=True)
    wanted = [meta[n].alias(n) for n in ("home_team", "away_team", "home_league_id", "game_status")]
    return feed(t.events).select(
        "game_pk", *wanted, date_prefix(meta["date_time"]).alias("game_date"),
        meta["current_play"]["atBatIndex"].alias("current_at_bat"),
    )


@query(
    "feed_status",
    f"""WITH {SQL_RAW} SELECT status, count(*) AS documents FROM (
  SELECT game_pk, CASE WHEN game_pk % 9 = 2 THEN 'error' ELSE 'ok' END AS status FROM raw GROUP BY game_pk) GROUP BY status""",
)
def feed_status(t: Tables):
    kept = parse_feed(feed_texts(t.events, broken_every=9), TEXT)
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "feed_errors",
    f"""WITH {SQL_RAW} SELECT game_pk AS landed_as, 'error' AS status, true AS has_text FROM raw
WHERE game_pk % 9 = 2 GROUP BY game_pk""",
)
def feed_errors(t: Tables):
    texts = feed_texts(t.events, broken_every=9).withColumnRenamed("game_pk", "landed_as")
    broken = broken_documents(parse_feed(texts, TEXT, keep=("landed_as",)))
    return broken.select("landed_as", "status", F.col(TEXT).isNotNull().alias("has_text"))


# --- join and fill on flat rows -----------------------------------------------------


@query(
    "attach_and_fill",
    f"""WITH {SQL_RAW}, e AS (SELECT game_pk, event_id, CASE WHEN k % 17 <> 0 THEN ts END AS at, value FROM raw),
b AS (SELECT game_pk, CASE WHEN k % 23 <> 0 THEN ts END AS ended, event_id AS purchase_id, event_type,
        CASE WHEN k % 5 <> 0 THEN value END AS value FROM raw WHERE event_type = 'purchase'),
j AS (SELECT e.game_pk, e.event_id, e.value AS value_x, b.purchase_id, b.value AS value_y
      FROM e LEFT JOIN b ON e.game_pk = b.game_pk AND e.at IS NOT DISTINCT FROM b.ended)
SELECT game_pk, event_id, value_x, last_value(purchase_id IGNORE NULLS) OVER w AS purchase_id,
  last_value(value_y IGNORE NULLS) OVER w AS value_y
FROM j WINDOW w AS (PARTITION BY game_pk ORDER BY event_id DESC, purchase_id DESC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def attach_and_fill(t: Tables):
    raw = raw_events(t.events)
    events = raw.select("game_pk", "event_id", F.when(F.col("k") % 17 != 0, F.col("ts")).alias("at"), "value")
    ends = raw.where("event_type = 'purchase'").select(
        "game_pk", F.when(F.col("k") % 23 != 0, F.col("ts")).alias("ended"), F.col("event_id").alias("purchase_id"),
        F.when(F.col("k") % 5 != 0, F.col("value")).alias("value"),
    )
    # A game has at most 240 events, so joined groups and windows are small.
    joined = left_join_suffixed(events, ends, [("at", "ended")], scope=["game_pk"], hot_right_rows=None)
    keyed = joined.withColumn("match", F.coalesce("purchase_id", F.lit(0)))
    filled = fill_up(keyed, ["purchase_id", "value.y"], ["game_pk"], ["event_id", "match"], segment=None)  # 240 events a game
    return undotted(filled.drop("at", "match"))


# --- season ----------------------------------------------------------------------------

FIRST, LAST = dt.date(2024, 1, 3), dt.date(2024, 1, 20)  # three full weeks, to the 23rd
EXCLUDED = [12, 13]

_IDS = f"""{{head}}, listed AS (SELECT DISTINCT game_pk, CAST(ts AS DATE) AS listed_on FROM raw),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM raw
         WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-23'),
ids AS (SELECT game_pk, listed_on FROM listed JOIN days ON listed_on = day
        WHERE game_pk NOT IN ({", ".join(map(str, EXCLUDED))}))"""


def _pitches(t: Tables):
    return t.events.select(F.to_date("ts").alias("game_date"))


def _schedule(t: Tables):
    return schedule_games(good_documents(parse_schedule(schedule_texts(t.events))))


@query(
    "schedule_games",
    f"""WITH {SQL_RAW} SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, game_pk AS gamePk,
  CASE WHEN game_pk % 10 = 0 THEN 'Live' ELSE 'Final' END AS status_abstractGameState FROM raw""",
)
def schedule(t: Tables):
    return undotted(_schedule(t))


@query(
    "schedule_status_counts",
    f"""WITH {SQL_RAW} SELECT CASE WHEN game_pk % 10 = 0 THEN 'Live' ELSE 'Final' END AS status, count(*) AS cnt
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, game_pk FROM raw) GROUP BY 1""",
)
def schedule_status_counts(t: Tables):
    counts = code_frequencies(_schedule(t), "status.abstractGameState")
    return counts.select(F.col("`status.abstractGameState`").alias("status"), "cnt")


@query(
    "season_game_ids",
    "WITH " + _IDS.replace("{head}", SQL_RAW) + " SELECT game_pk, CAST(listed_on AS VARCHAR) AS listed_on FROM ids",
)
def season_game_ids(t: Tables):
    ids = season_games(_pitches(t), _schedule(t), FIRST, LAST, EXCLUDED, dedupe=False)
    return ids.withColumn("listed_on", F.col("listed_on").cast("string"))


@query(
    "season_summary",
    "WITH " + _IDS.replace("{head}", SQL_RAW)
    + """ SELECT (SELECT count(*) FROM days) AS n_days, count(*) AS n_ids,
  count(DISTINCT game_pk) AS n_distinct_ids FROM ids""",
)
def summary(t: Tables):
    ids = season_games(_pitches(t), _schedule(t), FIRST, LAST, EXCLUDED, dedupe=False)
    return season_summary(pull_weeks(_pitches(t), "game_date", FIRST, LAST), ids)


@query(
    "season_pbp",
    "WITH " + _IDS.replace("{head}", SQL_PBP["reference"])
    + f" SELECT {_NAMES} FROM pbp WHERE game_pk IN (SELECT game_pk FROM ids)",
)
def season(t: Tables):
    return undotted(season_pbp(feed_texts(t.events), _pitches(t), _schedule(t), FIRST, LAST, EXCLUDED, doc_keys=["game_pk"]))


@query(
    "season_pbp_repeated",
    "WITH " + _IDS.replace("{head}", SQL_PBP["parent"])
    + f" SELECT {', '.join('pbp.' + flat_name(n) for n in PBP)} FROM pbp JOIN ids ON pbp.game_pk = ids.game_pk",
)
def season_repeated(t: Tables):
    pbp = season_pbp(
        feed_texts(t.events), _pitches(t), _schedule(t), FIRST, LAST, EXCLUDED, dedupe=False, attach="parent", doc_keys=["game_pk"]
    )
    return undotted(pbp)
