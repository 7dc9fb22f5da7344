"""Explicit schemas (DDL text) of every landed table, and the name-quoting helper.

Schemas are never inferred: inference costs a pass over the data, drifts between
games, and turns a game's duration such as ``3:06`` into a timestamp.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Backtick a column name: public names contain dots, digits and symbols."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col(q(name))


CORRUPT = "_corrupt_record"

# --- nested documents -------------------------------------------------------

# Paths inside one event and inside one at-bat, with their types.
EVENT_PATHS: dict[str, str] = {
    "type": "STRING", "pitchNumber": "INT", "endTime": "STRING",
    "count.balls": "INT", "count.strikes": "INT", "count.outs": "INT",
    "details.code": "STRING", "details.isStrike": "BOOLEAN", "details.isBall": "BOOLEAN", "details.isInPlay": "BOOLEAN",
    "details.type.code": "STRING", "details.type.description": "STRING", "details.call.description": "STRING",
    "pitchData.typeConfidence": "DOUBLE",
}
AT_BAT_PATHS: dict[str, str] = {
    "atBatIndex": "INT", "playEndTime": "STRING", "result.event": "STRING", "about.halfInning": "STRING",
    "count.balls": "INT", "count.strikes": "INT", "count.outs": "INT",
    "matchup.batter.id": "BIGINT", "matchup.batter.fullName": "STRING",
    "matchup.pitcher.id": "BIGINT", "matchup.pitcher.fullName": "STRING",
    "matchup.splits.menOnBase": "STRING", "pitchIndex": "ARRAY<INT>",
}


def struct_ddl(paths: Mapping[str, str]) -> str:
    """``{"a": "INT", "b.c": "STRING"}`` as a nested struct type."""
    tree: dict = {}
    for path, kind in paths.items():
        *parents, leaf = path.split(".")
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = kind

    def render(node) -> str:
        if isinstance(node, str):
            return node
        return "STRUCT<" + ", ".join(f"{q(name)}: {render(child)}" for name, child in node.items()) + ">"

    return render(tree)


def feed_schema(event_extra: Mapping[str, str] = {}, at_bat_extra: Mapping[str, str] = {}) -> str:
    """One game document. game_pk is stamped on the record when it is landed.

    A live feed has many more fields than the ones used here; those wanted in
    the play-by-play table are named by their paths, for instance
    ``event_extra={"pitchData.startSpeed": "DOUBLE"}``.
    """
    team = {"name": "STRING", "sport.id": "BIGINT", "sport.name": "STRING", "league.id": "BIGINT", "league.name": "STRING"}
    at_bat = AT_BAT_PATHS | dict(at_bat_extra)
    at_bat["playEvents"] = f"ARRAY<{struct_ddl(EVENT_PATHS | dict(event_extra))}>"
    game = {"datetime.dateTime": "STRING", "status.abstractGameState": "STRING"}
    game |= {f"teams.{side}.{path}": kind for side in ("home", "away") for path, kind in team.items()}
    live = {"plays.allPlays": f"ARRAY<{struct_ddl(at_bat)}>", "plays.currentPlay.atBatIndex": "INT"}
    return f"game_pk BIGINT, gameData {struct_ddl(game)}, liveData {struct_ddl(live)}"


FEED = feed_schema()

SCHEDULE = """dates ARRAY<STRUCT<date: STRING,
    games: ARRAY<STRUCT<gamePk: BIGINT, status: STRUCT<abstractGameState: STRING>>>>>"""

# --- play-by-play table -----------------------------------------------------

PBP = {
    "game_pk": "BIGINT", "game_date": "STRING", "event_pos": "INT",
    "type": "STRING", "pitchNumber": "INT", "endTime": "STRING",
    "count.balls.start": "INT", "count.strikes.start": "INT", "count.outs.start": "INT",
    "details.code": "STRING", "details.isStrike": "BOOLEAN", "details.isBall": "BOOLEAN",
    "details.isInPlay": "BOOLEAN", "details.type.code": "STRING", "details.type.description": "STRING",
    "details.call.description": "STRING", "pitchData.typeConfidence": "DOUBLE",
    "atBatIndex": "INT", "result.event": "STRING", "about.halfInning": "STRING",
    "count.balls.end": "INT", "count.strikes.end": "INT", "count.outs.end": "INT",
    "matchup.batter.id": "BIGINT", "matchup.batter.fullName": "STRING",
    "matchup.pitcher.id": "BIGINT", "matchup.pitcher.fullName": "STRING",
    "matchup.splits.menOnBase": "STRING",
    "home_team": "STRING", "home_level_id": "BIGINT", "home_level_name": "STRING",
    "home_league_id": "BIGINT", "home_league_name": "STRING",
    "away_team": "STRING", "away_level_id": "BIGINT", "away_level_name": "STRING",
    "away_league_id": "BIGINT", "away_league_name": "STRING",
    "batting_team": "STRING", "fielding_team": "STRING", "last.pitch.of.ab": "STRING",
}

# --- flat tables, columns in file order -------------------------------------

# Fixed values.
_PITCH_ORDER = [
    "pitch_type", "game_date", "release_speed", "release_pos_x", "release_pos_z", "player_name", "batter",
    "pitcher", "events", "description", "spin_dir", "spin_rate_deprecated", "break_angle_deprecated",
    "break_length_deprecated", "zone", "des", "game_type", "stand", "p_throws", "home_team", "away_team", "type",
    "hit_location", "bb_type", "balls", "strikes", "game_year", "pfx_x", "pfx_z", "plate_x", "plate_z", "on_3b",
    "on_2b", "on_1b", "outs_when_up", "inning", "inning_topbot", "hc_x", "hc_y", "tfs_deprecated",
    "tfs_zulu_deprecated", "fielder_2", "umpire", "sv_id", "vx0", "vy0", "vz0", "ax", "ay", "az", "sz_top",
    "sz_bot", "hit_distance_sc", "launch_speed", "launch_angle", "effective_speed", "release_spin_rate",
    "release_extension", "game_pk", "pitcher.1", "fielder_2.1", "fielder_3", "fielder_4", "fielder_5", "fielder_6",
    "fielder_7", "fielder_8", "fielder_9", "release_pos_y", "estimated_ba_using_speedangle",
    "estimated_woba_using_speedangle", "woba_value", "woba_denom", "babip_value", "iso_value",
    "launch_speed_angle", "at_bat_number", "pitch_number", "pitch_name", "home_score", "away_score", "bat_score",
    "fld_score", "post_away_score", "post_home_score", "post_bat_score", "post_fld_score", "if_fielding_alignment",
    "of_fielding_alignment",
]

_PITCH_STRING = {
    "pitch_type", "player_name", "events", "description", "des", "game_type", "stand", "p_throws", "home_team",
    "away_team", "type", "bb_type", "inning_topbot", "sv_id", "pitch_name", "if_fielding_alignment",
    "of_fielding_alignment", "spin_dir", "spin_rate_deprecated", "break_angle_deprecated",
    "break_length_deprecated", "tfs_deprecated", "tfs_zulu_deprecated", "umpire",
}
_PITCH_LONG = {"batter", "pitcher", "pitcher.1", "game_pk"}
_PITCH_INT = {
    "balls", "strikes", "game_year", "outs_when_up", "inning", "at_bat_number", "pitch_number", "home_score",
    "away_score", "bat_score", "fld_score", "post_away_score", "post_home_score", "post_bat_score",
    "post_fld_score",
}
# Nullable whole numbers that the source writes with a decimal point ("543228.0").
PITCH_FLOAT_LONG = [
    "on_1b", "on_2b", "on_3b", "fielder_2", "fielder_2.1", "fielder_3", "fielder_4", "fielder_5", "fielder_6",
    "fielder_7", "fielder_8", "fielder_9",
]
PITCH_FLOAT_INT = ["zone", "hit_location", "launch_speed_angle"]


def _pitch_type(name: str) -> str:
    if name == "game_date":
        return "DATE"
    for names, kind in ((_PITCH_STRING, "STRING"), (_PITCH_LONG, "BIGINT"), (_PITCH_INT, "INT")):
        if name in names:
            return kind
    return "DOUBLE"


def ddl(columns: Mapping[str, str]) -> str:
    return ", ".join(f"{q(name)} {kind}" for name, kind in columns.items())


PITCH = {name: _pitch_type(name) for name in _PITCH_ORDER}

# The counting columns of a batting line.
COUNTING = [
    "G", "PA", "AB", "R", "H", "2B", "3B", "HR", "RBI", "BB", "IBB", "SO", "HBP", "SH", "SF", "GDP", "SB", "CS",
]

# Columns of the landed tables, in file order.
BATTING = {
    "Name": "STRING", "Age": "INT", "#days": "INT", "Lev": "STRING", "Tm": "STRING",
    **{n: "INT" for n in COUNTING},
    "BA": "DOUBLE", "OBP": "DOUBLE", "SLG": "DOUBLE", "OPS": "DOUBLE",
    "mlb_ID": "BIGINT",
}

TEAM_GAMES = {
    "Date": "DATE", "Tm": "STRING", "Home_Away": "STRING", "Opp": "STRING", "W/L": "STRING",
    "R": "DOUBLE", "RA": "DOUBLE", "Inn": "DOUBLE", "W-L": "STRING", "Rank": "DOUBLE", "GB": "STRING",
    "Win": "STRING", "Loss": "STRING", "Save": "STRING", "Time": "STRING", "D/N": "STRING",
    "Attendance": "DOUBLE", "cLI": "DOUBLE", "Streak": "INT", "Orig. Scheduled": "STRING",
}

# Columns of the code tables.
TYPE_CODES = {"details.type.code": "STRING", "details.type.description": "STRING", "cnt": "BIGINT"}
CALL_CODES = {"details.code": "STRING", "details.call.description": "STRING", "cnt": "BIGINT"}
