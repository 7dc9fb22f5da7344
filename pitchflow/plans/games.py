"""Game documents to the play-by-play table, one game or a season."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.functions.pitches import side_columns
from pitchflow.functions.text import date_prefix
from pitchflow.operators.calendar import distinct_days, game_ids_for_days, grid_end, pull_weeks
from pitchflow.operators.nested import META_PATHS
from pitchflow.operators.ordered import fill_up, last_of_group_flag
from pitchflow.operators.relational import exclude_ids
from pitchflow.schemas import PBP, c, q
from pitchflow.sources.feeds import DOC_ID, STATUS, TEXT, broken_documents, good_documents, parse_feed
from pitchflow.sources.tables import in_range

PLAYS = "liveData.plays.allPlays"

META_COLUMNS = {n: path for n, path in META_PATHS.items() if n != "game_status"}
FLAG = "last.pitch.of.ab"


def _leaf_paths(kind: T.StructType, prefix: str = "") -> list[str]:
    """The paths of the scalar fields; lists are left out."""
    out: list[str] = []
    for field in kind.fields:
        if isinstance(field.dataType, T.StructType):
            out += _leaf_paths(field.dataType, f"{prefix}{field.name}.")
        elif not isinstance(field.dataType, (T.ArrayType, T.MapType)):
            out.append(prefix + field.name)
    return out


def _play_columns(plays: T.ArrayType) -> tuple[dict[str, str], dict[str, str]]:
    """Path inside an event, and inside an at-bat, by output name, as the schema has them.

    The counts, which both have, become start and end; other common names get .x and .y.
    """
    at_bat = plays.elementType
    events = _leaf_paths(at_bat["playEvents"].dataType.elementType)
    at_bats = [p for p in _leaf_paths(at_bat) if p != "playEndTime"]
    common = set(events) & set(at_bats)

    def name(path: str, count: str, other: str) -> str:
        return path if path not in common else path + (count if path.startswith("count.") else other)

    return {name(p, ".start", ".x"): p for p in events}, {name(p, ".end", ".y"): p for p in at_bats}


def _path(element: str, path: str) -> str:
    return ".".join([element, *[q(step) for step in path.split(".")]])


def _fields(element: str, columns: dict[str, str]) -> list[str]:
    return [f"{_path(element, path)} AS {q(name)}" for name, path in columns.items()]


def _struct(element: str, columns: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {_path(element, path)}" for name, path in columns.items()) + ")"


def _by_parent(games: DataFrame, carried: list[str], flag_nulls: str) -> DataFrame:
    """Events with the fields of the at-bat they sit in: two explodes, no shuffle."""
    event_columns, at_bat_columns = _play_columns(games.schema["_plays"].dataType)
    last = "array_max(transform(_ab.playEvents, e -> e.pitchNumber))"
    if flag_nulls == "propagate":
        last = f"if(exists(_ab.playEvents, e -> e.pitchNumber IS NULL), NULL, {last})"
    at_bats = games.selectExpr(
        *carried, "transform(_plays, ab -> greatest(size(ab.playEvents), 0)) AS _sizes", "_plays"
    ).selectExpr(*carried, "_sizes", "posexplode(_plays) AS (_i, _ab)")
    # Events of the at-bats before this one, so that positions run through the game.
    per_at_bat = at_bats.selectExpr(
        *carried, "aggregate(slice(_sizes, 1, _i), 0, (total, n) -> total + n) AS _before",
        *_fields("_ab", at_bat_columns), f"{last} AS _last", "_ab.playEvents AS _events",
    )
    fields = [q(n) for n in at_bat_columns]
    rows = per_at_bat.selectExpr(*carried, "_before", *fields, "_last", "posexplode(_events) AS (_j, _e)")
    flag = """CASE WHEN _e.pitchNumber = _last THEN 'true'
                   WHEN _last IS NOT NULL AND _e.pitchNumber IS NOT NULL THEN 'false' END"""
    return rows.selectExpr(
        *carried, "_before + _j AS event_pos", *_fields("_e", event_columns), *fields, f"{flag} AS {q(FLAG)}"
    )


def _by_end_time(games: DataFrame, carried: list[str], doc_keys: list[str], flag_nulls: str, fill: Sequence[str] | None) -> DataFrame:
    """Events left-joined to at-bats on the end time, then filled upwards.

    Both sides of the join come from one document, so it is done inside the
    document and takes neither a second parse nor a shuffle. The fill and the
    flag need a document's rows together: the nested documents, which are
    compact, are dealt by their key before they become rows, and both windows
    use that.
    """
    games = games.repartition(*[c(k) for k in doc_keys])
    event_columns, at_bat_columns = _play_columns(games.schema["_plays"].dataType)
    matches = f"""transform(filter(_plays, b -> b.playEndTime <=> e.endTime), b -> {_struct("b", at_bat_columns)})"""
    events = f"""flatten(transform(filter(_plays, ab -> ab.playEvents IS NOT NULL),
        ab -> transform(ab.playEvents, e -> named_struct('e', {_struct("e", event_columns)}, 'm', {matches}))))"""
    stacked = games.selectExpr(*carried, f"posexplode({events}) AS (event_pos, _x)")
    joined = stacked.selectExpr(*carried, "event_pos", "_x.e AS _e", "posexplode_outer(_x.m) AS (_match, _ab)")
    flat = joined.selectExpr(
        *carried, "event_pos", "coalesce(_match, 0) AS _match",
        *[f"_e.{q(n)} AS {q(n)}" for n in event_columns], *[f"_ab.{q(n)} AS {q(n)}" for n in at_bat_columns],
    )
    wanted = list(at_bat_columns) if fill is None else [n for n in at_bat_columns if n in fill]
    # A document's events are few by nature: plain windows.
    filled = fill_up(flat, wanted, doc_keys, ["event_pos", "_match"], segment=None)
    return last_of_group_flag(filled, "pitchNumber", [*doc_keys, "atBatIndex"], FLAG, flag_nulls, segment=None)


def _with_doc_keys(feed: DataFrame, doc_keys: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    if doc_keys is not None:
        return feed, list(doc_keys)
    if DOC_ID not in feed.columns:
        feed = feed.withColumn(DOC_ID, F.xxhash64("gameData", "liveData"))
    return feed, ["game_pk", DOC_ID]


def normalise_game(
    feed: DataFrame,
    attach: str = "reference",
    flag_nulls: str = "propagate",
    doc_keys: Sequence[str] | None = None,
    ordered: bool = False,
    fill: Sequence[str] | None = None,
) -> DataFrame:
    """Game documents to one flat row per event.

    ``attach`` decides how an event gets its at-bat's fields. ``"reference"``
    matches the event's end time with the at-bat's (several matches multiply
    the event, a missing time matches a missing time) and gives every event
    without a value the next one below, column by column; an at-bat whose end
    matches nothing thus takes over its successor's fields. ``"parent"`` takes
    them from the at-bat the event is listed in.

    A document is one unit even if its ``game_pk`` comes again: ``doc_keys``
    are columns of ``feed`` that tell documents apart. By default that is the
    id from :func:`read_feed`, or else a hash of the document, which like any
    key of a shuffle must come out the same when a task is run again. Equal
    documents may share a key, as their rows fill each other with equal values.
    ``ordered`` sorts by game, then latest at-bat and pitch first. ``fill``
    names the at-bat columns that ``"reference"`` fills, by default all.

    The table has all scalar fields of events and at-bats that the schema of
    ``feed`` names: the standard ones first, then any extra ones.
    """
    if STATUS in feed.columns:
        raise ValueError("take good_documents() and broken_documents() apart first, so that no document is lost unseen")
    feed, doc_keys = _with_doc_keys(feed, doc_keys)
    extra = [k for k in doc_keys if k != "game_pk"]
    carried = ["game_pk", *extra, *META_COLUMNS]
    meta = [f"{path} AS {n}" for n, path in META_COLUMNS.items()]
    games = feed.selectExpr("game_pk", *extra, *meta, f"{PLAYS} AS _plays")
    if attach == "parent":
        rows = _by_parent(games, carried, flag_nulls)
    elif attach == "reference":
        rows = _by_end_time(games, carried, doc_keys, flag_nulls, fill)
    else:
        raise ValueError("attach must be 'reference' or 'parent'")
    sides = side_columns(c("about.halfInning"), F.col("home_team"), F.col("away_team"))
    rows = rows.withColumns({"game_date": date_prefix(F.col("date_time")), **sides})
    working = {*carried, "_match", *PBP}
    out = rows.selectExpr(*[q(n) for n in PBP], *[q(n) for n in rows.columns if n not in working])
    return sort_plays(out) if ordered else out


def sort_plays(pbp: DataFrame) -> DataFrame:
    """By game; in it the latest at-bat and pitch first, missing last, then feed order."""
    return pbp.orderBy(
        "game_pk", c("atBatIndex").desc_nulls_last(), c("pitchNumber").desc_nulls_last(), "event_pos"
    )


def season_games(
    pitches: DataFrame,
    schedule: DataFrame,
    first: dt.date,
    last: dt.date,
    exclude: Iterable[int] | DataFrame = (),
    dedupe: bool = True,
) -> DataFrame:
    """The ids of the season's games: weekly windows → game days → listed games.

    Of the pitch rows only the date is read. ``exclude`` is a list of ids or a
    DataFrame with the ids in its first column.
    """
    # The windows bound the number of days, so the days can be broadcast.
    days = F.broadcast(distinct_days(pull_weeks(pitches, "game_date", first, last)))
    ids = game_ids_for_days(days, schedule, dedupe)
    return exclude_ids(ids, "game_pk", exclude)


def season_pbp(
    feed: DataFrame,
    pitches: DataFrame,
    schedule: DataFrame,
    first: dt.date,
    last: dt.date,
    exclude: Iterable[int] | DataFrame = (),
    dedupe: bool = True,
    attach: str = "reference",
    flag_nulls: str = "propagate",
    doc_keys: Sequence[str] | None = None,
    fill: Sequence[str] | None = None,
) -> DataFrame:
    """The season's play-by-play table as one lazy plan; no job runs while it is built.

    ``feed`` is either parsed documents, or, better, landed texts as
    :func:`pitchflow.sources.feeds.landed` gives them, ``game_pk`` beside each:
    then the ids meet the texts, and only the season's documents are parsed. How
    the ids travel is left to the optimizer, which knows their size.
    """
    ids = season_games(pitches, schedule, first, last, exclude, dedupe)
    if TEXT in feed.columns:
        wanted = feed.join(ids, "game_pk")
        kept = [n for n in wanted.columns if n not in ("game_pk", TEXT)]
        feed = good_documents(parse_feed(wanted, TEXT, keep=tuple(kept)))
        feed, doc_keys = _with_doc_keys(feed, doc_keys)
    else:
        feed, doc_keys = _with_doc_keys(feed, doc_keys)
        feed = feed.join(ids, "game_pk")
    return normalise_game(feed, attach, flag_nulls, doc_keys=[*doc_keys, "listed_on"], fill=fill)


def season_errors(
    feed: DataFrame, pitches: DataFrame, schedule: DataFrame, first: dt.date, last: dt.date, exclude: Iterable[int] | DataFrame = (),
) -> DataFrame:
    """The error table of the season's landed texts: broken ones of its games, and those that don't tell their game."""
    ids = season_games(pitches, schedule, first, last, exclude)
    own = feed.join(ids, "game_pk", "left_semi").unionByName(feed.where("game_pk IS NULL"))
    kept = tuple(n for n in own.columns if n not in ("game_pk", TEXT))
    return broken_documents(parse_feed(own, TEXT, keep=kept))
