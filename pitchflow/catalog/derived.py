"""Baseball-shaped inputs derived from the given tables.

240 successive events make a game and six an at-bat, so a document has a fixed
greatest size whatever the table's: ``event_id`` is unique. The rules put in
what real feeds contain: events without number or end time, at-bats whose end
matches no event, or another at-bat's, and missing attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.schemas import q
from pitchflow.sources.feeds import TEXT, good_documents, parse_feed

# Pitch-type codes by the event's k; UN is in no bucket, the last has none.
_CODES = ["FF", "SI", "SL", "CH", "CU", "FC", "FT", "FO", "EP", "KN", "FS", "KC", "SC", "CS", "UN", "FF", "SL", "FF"]
_CODE_LIST = ", ".join(f"'{x}'" for x in _CODES) + ", NULL"

# Output name: (Spark SQL, DuckDB SQL) over the columns of `raw`, then of one at-bat.
_EVENT = {
    "type": ("if(k % 11 = 0, 'action', 'pitch')", "CASE WHEN k % 11 = 0 THEN 'action' ELSE 'pitch' END"),
    "pitchNumber": (
        "if(k % 13 = 0, NULL, cast(event_id % 6 + 1 as int))",
        "CASE WHEN k % 13 <> 0 THEN CAST(event_id % 6 + 1 AS INTEGER) END",
    ),
    "endTime": ("if(k % 17 = 0, NULL, concat('t', event_id))", "CASE WHEN k % 17 <> 0 THEN 't' || event_id END"),
    "count.balls.start": ("k % 4", "k % 4"),
    "count.strikes.start": ("cast(k div 4 % 3 as int)", "k // 4 % 3"),
    "count.outs.start": ("cast(k div 12 % 3 as int)", "k // 12 % 3"),
    "details.code": (
        "decode(event_type, 'click', 'S', 'signup', 'F', 'view', 'B', 'purchase', 'X', 'H')",
        "CASE event_type WHEN 'click' THEN 'S' WHEN 'signup' THEN 'F' WHEN 'view' THEN 'B' "
        "WHEN 'purchase' THEN 'X' ELSE 'H' END",
    ),
    "details.isStrike": (
        "if(k % 29 = 0, NULL, event_type in ('click', 'signup'))",
        "CASE WHEN k % 29 <> 0 THEN event_type IN ('click', 'signup') END",
    ),
    "details.isBall": ("event_type = 'view'", "event_type = 'view'"),
    "details.isInPlay": ("event_type = 'purchase'", "event_type = 'purchase'"),
    "details.type.code": (f"element_at(array({_CODE_LIST}), k % 19 + 1)", f"list_extract([{_CODE_LIST}], k % 19 + 1)"),
    "details.type.description": (
        f"concat('type ', element_at(array({_CODE_LIST}), k % 19 + 1))",
        f"'type ' || list_extract([{_CODE_LIST}], k % 19 + 1)",
    ),
    "details.call.description": ("concat('call ', event_type)", "'call ' || event_type"),
    "pitchData.typeConfidence": ("if(k % 11 = 0, NULL, value / 200)", "CASE WHEN k % 11 <> 0 THEN value / 200 END"),
}
_AT_BAT = {
    "playEndTime": (
        "CASE WHEN ab % 7 = 3 THEN 'none' WHEN ab % 9 = 5 THEN concat('t', game_pk * 240 + ab * 6 - 1) "
        "WHEN ab % 19 = 11 THEN NULL ELSE concat('t', game_pk * 240 + ab * 6 + 5) END",
        "CASE WHEN ab % 7 = 3 THEN 'none' WHEN ab % 9 = 5 THEN 't' || (game_pk * 240 + ab * 6 - 1) "
        "WHEN ab % 19 = 11 THEN NULL ELSE 't' || (game_pk * 240 + ab * 6 + 5) END",
    ),
    "result.event": (
        "if(ab % 5 = 2, NULL, element_at(array('Single', 'Strikeout', 'Walk', 'Flyout'), ab % 4 + 1))",
        "CASE WHEN ab % 5 <> 2 THEN list_extract(['Single', 'Strikeout', 'Walk', 'Flyout'], ab % 4 + 1) END",
    ),
    "about.halfInning": (
        "CASE WHEN ab % 10 = 9 THEN NULL WHEN ab div 3 % 2 = 0 THEN 'top' ELSE 'bottom' END",
        "CASE WHEN ab % 10 = 9 THEN NULL WHEN ab // 3 % 2 = 0 THEN 'top' ELSE 'bottom' END",
    ),
    "count.balls.end": ("ab % 4", "ab % 4"),
    "count.strikes.end": ("ab % 3", "ab % 3"),
    "count.outs.end": ("cast(ab div 2 % 3 as int)", "ab // 2 % 3"),
    "matchup.batter.id": ("1000 + (game_pk * 7 + ab * 3) % 97", "1000 + (game_pk * 7 + ab * 3) % 97"),
    "matchup.batter.fullName": (
        "if((game_pk * 7 + ab * 3) % 97 = 31, NULL, concat('Batter ', 1000 + (game_pk * 7 + ab * 3) % 97))",
        "CASE WHEN (game_pk * 7 + ab * 3) % 97 <> 31 THEN 'Batter ' || (1000 + (game_pk * 7 + ab * 3) % 97) END",
    ),
    "matchup.pitcher.id": ("500 + (game_pk + ab div 5) % 23", "500 + (game_pk + ab // 5) % 23"),
    "matchup.pitcher.fullName": (
        "concat('Pitcher ', 500 + (game_pk + ab div 5) % 23)", "'Pitcher ' || (500 + (game_pk + ab // 5) % 23)",
    ),
    "matchup.splits.menOnBase": (
        "element_at(array('Empty', 'Men_On', 'RISP', 'Loaded'), ab % 4 + 1)",
        "list_extract(['Empty', 'Men_On', 'RISP', 'Loaded'], ab % 4 + 1)",
    ),
}


def flat_name(name: str) -> str:
    """Dotted public names as plain ones, for results that leave the library."""
    return name.replace(".", "_")


def undotted(df: DataFrame) -> DataFrame:
    return df.toDF(*[flat_name(n) for n in df.columns])


# The number in {"k": 69}.
_K = "cast(get_json_object(props, '$.k') AS int)"


def raw_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", f"{_K} AS k",
        "event_id div 240 AS game_pk", "cast(event_id % 240 AS int) AS event_pos", "cast(event_id % 240 div 6 AS int) AS ab",
    )


def plays(events: DataFrame) -> DataFrame:
    """One play-by-play row per event, at-bat fields from the event's own at-bat; no shuffle."""
    return raw_events(events).selectExpr(
        "game_pk", "event_pos", "ab AS atBatIndex", *[f"{s} AS {q(n)}" for n, (s, _) in (_EVENT | _AT_BAT).items()]
    )


def game_documents(events: DataFrame) -> DataFrame:
    """Game documents in the landed shape, as struct columns."""
    e = {n: s for n, (s, _) in _EVENT.items()}
    a = {n: s for n, (s, _) in _AT_BAT.items()}
    struct = lambda fields: "named_struct(" + ", ".join(f"'{n}', {s}" for n, s in fields.items()) + ")"
    counts = lambda x, when: struct({n: x[f"count.{n}.{when}"] for n in ("balls", "strikes", "outs")})
    event = struct({
        "event_id": "event_id", "type": e["type"], "pitchNumber": e["pitchNumber"], "endTime": e["endTime"],
        "count": counts(e, "start"),
        "details": struct({
            **{n: e[f"details.{n}"] for n in ("code", "isStrike", "isBall", "isInPlay")},
            "type": struct({n: e[f"details.type.{n}"] for n in ("code", "description")}),
            "call": struct({"description": e["details.call.description"]}),
        }),
        "pitchData": struct({"typeConfidence": e["pitchData.typeConfidence"]}),
    })
    person = lambda who: struct({n: a[f"matchup.{who}.{n}"] for n in ("id", "fullName")})
    play = struct({
        "atBatIndex": "ab", "playEndTime": a["playEndTime"], "result": struct({"event": a["result.event"]}),
        "about": struct({"halfInning": a["about.halfInning"]}), "count": counts(a, "end"),
        "matchup": struct({
            "batter": person("batter"), "pitcher": person("pitcher"),
            "splits": struct({"menOnBase": a["matchup.splits.menOnBase"]}),
        }),
        "playEvents": "xs",
    })
    team = lambda shift: struct({
        "name": f"concat('Team ', (game_pk + {shift}) % 30)", "sport": struct({"id": "1L", "name": "'Major'"}),
        "league": struct({
            "id": f"103 + (game_pk + {shift}) % 30 % 2", "name": f"concat('League ', (game_pk + {shift}) % 30 % 2)",
        }),
    })
    rows = raw_events(events).selectExpr("game_pk", "ab", "ts", f"{event} AS x")
    # One shuffle by game serves both groupings; six rows and forty at-bats are the most a group has.
    at_bats = rows.repartition("game_pk").groupBy("game_pk", "ab").agg(
        F.expr("sort_array(collect_list(x)) AS xs"), F.min("ts").alias("start")
    )
    games = at_bats.selectExpr("game_pk", "start", f"{play} AS play").groupBy("game_pk").agg(
        F.expr("date_format(min(start), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS start"),
        F.expr("sort_array(collect_list(play)) AS plays"),
    )
    game_data = struct({
        "datetime": struct({"dateTime": "start"}),
        "status": struct({"abstractGameState": "if(game_pk % 10 = 0, 'Live', 'Final')"}),
        "teams": struct({"home": team(0), "away": team(7)}),
    })
    live = struct({"plays": struct({
        "allPlays": "plays", "currentPlay": struct({"atBatIndex": "element_at(plays, -1).atBatIndex"}),
    })})
    return games.selectExpr("game_pk", f"{game_data} AS gameData", f"{live} AS liveData")


def feed_texts(events: DataFrame, broken_every: int = 0) -> DataFrame:
    """The documents as landed JSON lines with their ``game_pk``; every so many games with its end cut off."""
    text = F.to_json(F.struct("game_pk", "gameData", "liveData"))
    if broken_every:
        text = F.when(F.col("game_pk") % broken_every == 2, F.substring(text, F.lit(1), F.length(text) - 20)).otherwise(text)
    return game_documents(events).select("game_pk", text.alias(TEXT))


def feed(events: DataFrame) -> DataFrame:
    """The documents, landed and parsed."""
    return good_documents(parse_feed(feed_texts(events), TEXT))


def schedule_documents(events: DataFrame) -> DataFrame:
    """Schedule documents of at most 16 games: every day an event of the game falls on."""
    listed = events.select(F.to_date("ts").cast("string").alias("date"), F.expr("event_id div 240").alias("game_pk")).distinct()
    status = F.struct(F.expr("if(game_pk % 10 = 0, 'Live', 'Final')").alias("abstractGameState")).alias("status")
    games = listed.groupBy("date", F.expr("game_pk div 16").alias("part")).agg(
        F.collect_list(F.struct(F.col("game_pk").alias("gamePk"), status)).alias("games")
    )
    return games.select(F.array(F.struct("date", "games")).alias("dates"))


def schedule_texts(events: DataFrame) -> DataFrame:
    """The schedule documents as landed JSON texts."""
    return schedule_documents(events).select(F.to_json(F.struct("dates")).alias("value"))


def team_log(events: DataFrame) -> DataFrame:
    """A team game log: thirty teams, a game per event."""
    return raw_events(events).select(
        F.col("event_id").alias("game_no"), F.to_date("ts").alias("Date"), F.expr("concat('T', user_id % 30)").alias("Tm"),
        F.expr("if(k % 2 = 0, 'Home', '@')").alias("Home_Away"),
        F.expr("if(value * k % 7 < 4, 'W', 'L')").alias("W/L"), F.col("k").alias("R"),
    )


def batting_lines(lineitem: DataFrame) -> DataFrame:
    """Daily batting lines by player, whole numbers throughout."""
    num = lambda s, n: F.expr(f"cast({s} as int)").alias(n)
    return lineitem.select(
        F.col("l_suppkey").alias("mlb_ID"), F.to_date("l_shipdate").alias("Date"),
        num("l_quantity", "AB"), num("l_linenumber", "H"), num("l_partkey % 3", "2B"), num("l_partkey % 2", "3B"),
        num("l_orderkey % 2", "HR"), num("l_orderkey % 4", "BB"), num("l_linenumber % 2", "HBP"), num("l_orderkey % 3", "SF"),
    )


# --- the same inputs for the SQL side ---------------------------------------


def _sql_columns(columns: dict[str, tuple[str, str]]) -> str:
    return ", ".join(f"{sql} AS {flat_name(name)}" for name, (_, sql) in columns.items())


SQL_RAW = """raw AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 240 AS game_pk, CAST(event_id % 240 AS INTEGER) AS event_pos,
         CAST(event_id % 240 // 6 AS INTEGER) AS ab
  FROM events)"""
SQL_PLAYS = f"""{SQL_RAW},
plays AS (SELECT game_pk, event_pos, ab AS atBatIndex, {_sql_columns(_EVENT)}, {_sql_columns(_AT_BAT)} FROM raw)"""

EVENT_NAMES = [flat_name(n) for n in _EVENT]
AT_BAT_NAMES = ["atBatIndex", *[flat_name(n) for n in _AT_BAT if n != "playEndTime"]]

_META = """SELECT game_pk, strftime(min(ts), '%Y-%m-%d') AS game_date,
  'Team ' || (game_pk % 30) AS home_team, CAST(1 AS BIGINT) AS home_level_id, 'Major' AS home_level_name,
  103 + game_pk % 30 % 2 AS home_league_id, 'League ' || (game_pk % 30 % 2) AS home_league_name,
  'Team ' || ((game_pk + 7) % 30) AS away_team, CAST(1 AS BIGINT) AS away_level_id, 'Major' AS away_level_name,
  103 + (game_pk + 7) % 30 % 2 AS away_league_id, 'League ' || ((game_pk + 7) % 30 % 2) AS away_league_name
  FROM raw GROUP BY game_pk"""

_AB_SQL = ", ".join(AT_BAT_NAMES)
_EV_SQL = ", ".join(EVENT_NAMES)
_FILL_SQL = ",\n  ".join(
    f"last_value({n} IGNORE NULLS) OVER (PARTITION BY game_pk ORDER BY event_pos DESC, match_pos DESC "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {n}"
    for n in AT_BAT_NAMES
)

# CTEs ending in `pbp`: the events with their at-bat's fields, by end time or by parent.
SQL_PBP = {
    "reference": f"""{SQL_PLAYS},
at_bats AS (SELECT DISTINCT game_pk, playEndTime, {_AB_SQL} FROM plays),
joined AS (
  SELECT e.game_pk, e.event_pos, a.atBatIndex AS match_pos, {", ".join("e." + n for n in EVENT_NAMES)},
         {", ".join("a." + n for n in AT_BAT_NAMES)}
  FROM plays e LEFT JOIN at_bats a ON e.game_pk = a.game_pk AND e.endTime IS NOT DISTINCT FROM a.playEndTime),
attached AS (SELECT game_pk, event_pos, {_EV_SQL},
  {_FILL_SQL}
  FROM joined),""",
    "parent": f"""{SQL_PLAYS},
attached AS (SELECT game_pk, event_pos, {_EV_SQL}, {_AB_SQL} FROM plays),""",
}
for _mode in SQL_PBP:
    SQL_PBP[_mode] += f"""
meta AS ({_META}),
pbp AS (
  SELECT t.*, m.* EXCLUDE (game_pk),
    CASE WHEN about_halfInning = 'bottom' THEN home_team WHEN about_halfInning IS NOT NULL THEN away_team END AS batting_team,
    CASE WHEN about_halfInning = 'bottom' THEN away_team WHEN about_halfInning IS NOT NULL THEN home_team END AS fielding_team,
    CASE WHEN bool_or(pitchNumber IS NULL) OVER g THEN NULL
         WHEN pitchNumber = max(pitchNumber) OVER g THEN 'true' ELSE 'false' END AS last_pitch_of_ab
  FROM attached t JOIN meta m ON t.game_pk = m.game_pk
  WINDOW g AS (PARTITION BY t.game_pk, t.atBatIndex))"""
