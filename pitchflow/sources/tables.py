"""Flat tables: readers, selections and sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow import schemas
from pitchflow.functions.batting import batting_ratios
from pitchflow.operators.ordered import FOUND, row_index, running_sums
from pitchflow.operators.relational import first_match
from pitchflow.schemas import c, ddl

# Column name for the unnamed row index that stands first in the CSV samples.
INDEX = "_c0"

Day = str | dt.date


def read_csv(spark: SparkSession, path: str, columns: Mapping[str, str], index: bool = False, broken: bool = False) -> DataFrame:
    """A CSV file with a header and an explicit schema; ``NA`` and empty mean missing.

    ``index`` says the file starts with an unnamed row number; it is read as
    ``_c0``. A cell that does not fit its type is an error, unless ``broken`` is
    set: then the row comes with NULL there and its text in ``_corrupt_record``.
    """
    full = {INDEX: "INT", **columns} if index else dict(columns)
    if broken:
        full[schemas.CORRUPT] = "STRING"
    mode = "PERMISSIVE" if broken else "FAILFAST"
    reader = spark.read.schema(ddl(full)).option("header", True).option("nullValue", "NA").option("mode", mode)
    return reader.option("columnNameOfCorruptRecord", schemas.CORRUPT).csv(path)


def read_pitches(
    spark: SparkSession,
    path: str,
    first: Day | None = None,
    last: Day | None = None,
    fmt: str = "parquet",
    index: bool = False,
) -> DataFrame:
    """Pitch-search rows, both dates included.

    Landed as parquet partitioned by ``game_date`` the date range prunes
    directories. The CSV form writes nullable whole numbers with a decimal
    point; they are turned back into integers.
    """
    if fmt == "csv":
        df = read_csv(spark, path, schemas.PITCH, index).drop(INDEX)
        longs = {n: "bigint" for n in schemas.PITCH_FLOAT_LONG} | {n: "int" for n in schemas.PITCH_FLOAT_INT}
        df = df.select(*[c(n).cast(longs[n]).alias(n) if n in longs else c(n) for n in df.columns])
    else:
        df = spark.read.schema(ddl(schemas.PITCH)).parquet(path)
    return in_range(df, "game_date", first, last)


def in_range(df: DataFrame, date_column: str, first: Day | None, last: Day | None) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; a plain comparison that reaches the scan."""
    if first is not None:
        df = df.where(c(date_column) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(c(date_column) < F.date_add(F.lit(last).cast("date"), 1))
    return df


def pitcher_range(pitches: DataFrame, first: Day, last: Day, pitcher_id: int) -> DataFrame:
    return in_range(pitches, "game_date", first, last).where(F.col("pitcher") == pitcher_id)


COUNTING = schemas.COUNTING


def batting_range(
    games: DataFrame,
    first: Day,
    last: Day,
    player: str = "mlb_ID",
    date_column: str = "Date",
    counting: Sequence[str] = COUNTING,
    digits: int | None = 3,
) -> DataFrame:
    """Counting columns summed per player over a date range, with BA, OBP, SLG and OPS.

    Ratios are rounded half up to ``digits`` places (``None``: not at all).
    """
    sums = (
        in_range(games, date_column, first, last)
        .groupBy(c(player))
        .agg(*[F.sum(c(n)).alias(n) for n in counting])
    )
    return with_ratios(sums, digits)


def with_ratios(df: DataFrame, digits: int | None = 3) -> DataFrame:
    ratios = batting_ratios(*[c(n) for n in ("AB", "H", "2B", "3B", "HR", "BB", "HBP", "SF")])
    rounded: dict[str, Column] = {n: r if digits is None else F.round(r, digits) for n, r in ratios.items()}
    return df.withColumns(rounded)


def team_games(
    games: DataFrame,
    team: str,
    season: int | None = None,
    first: Day | None = None,
    last: Day | None = None,
) -> DataFrame:
    """One team's game log of a season or a date range. A season is a range of
    days too, so it prunes like one."""
    if season is not None:
        first, last = dt.date(season, 1, 1), dt.date(season, 12, 31)
    return in_range(games, "Date", first, last).where(F.col("Tm") == team)


def lookup_player(people: DataFrame, last_name: str, first_name: str, last_col: str = "last", first_col: str = "first"):
    """The people of that name, upper and lower case alike."""
    return people.where(
        (F.lower(c(last_col)) == last_name.lower()) & (F.lower(c(first_col)) == first_name.lower())
    )


def lookup_players(
    wanted: DataFrame, people: DataFrame, names: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """For each wanted name its first match in ``people`` by ``order``, NULL if none.

    The people are reduced to one row per name before the join, so a frequent
    name costs no more than a rare one.
    """
    keys = [f"_{n}" for n in names]
    folded = people.withColumns({k: F.lower(c(n)) for k, n in zip(keys, names)}).drop(*names)
    best = first_match(folded, keys, order)
    asked = wanted.withColumns({k: F.lower(c(n)) for k, n in zip(keys, names)})
    return asked.join(best, keys, "left").drop(*keys)


def read_codes(spark: SparkSession, path: str, columns: Mapping[str, str] = schemas.TYPE_CODES) -> DataFrame:
    return read_csv(spark, path, columns)


def write_pbp(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The season table as uncompressed parquet, one directory per day.

    The rebalance hint gathers each day in few files and splits a day that is
    too large for one task, which a plain repartition by day would not do.
    """
    (
        df.hint("rebalance", "game_date")
        .write.mode(mode)
        .option("compression", "uncompressed")
        .partitionBy("game_date")
        .parquet(path)
    )


def read_pbp(spark: SparkSession, path: str, extra: Mapping[str, str] = {}) -> DataFrame:
    """The season table, with ``extra`` columns if it was made with more fields.

    The schema keeps the partition column ``game_date`` a text.
    """
    return spark.read.schema(ddl(schemas.PBP | dict(extra))).parquet(path)


def write_by_game(df: DataFrame, name: str, path: str, buckets: int = 200) -> None:
    """The season table as ``name`` in the session's catalog, in buckets by game, each in the order of the game's events.

    What works within a game (fills, flags, joins by game) then needs no shuffle of
    ``spark.table(name)``. One task writes one bucket; there should be so many that a
    bucket is a few hundred MB. The catalog only knows the place: the files are
    plain Parquet at ``path``.
    """
    (
        df.repartition(buckets, "game_pk")
        .write.mode("overwrite")
        .bucketBy(buckets, "game_pk")
        .sortBy("game_pk", "event_pos")
        .option("path", path)
        .saveAsTable(name)
    )


def write_clustered(df: DataFrame, path: str, by: Sequence[str], bloom: Sequence[str] = (), distinct: int = 100_000, files: int | None = None) -> None:
    """Parquet whose files hold ranges of ``by``, so that a search by the first of them skips almost all files, and a Bloom filter in
    every row group for each column of ``bloom``, by which no order goes.

    Name a second column in ``by`` (a date): then rows of one frequent key are spread over files as well. ``distinct``
    is the number of values that a row group's filter is made for.
    """
    cols = [c(n) for n in by]
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    out = ranged.sortWithinPartitions(*cols).write.mode("overwrite")
    for n in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{n}", "true").option(f"parquet.bloom.filter.expected.ndv#{n}", str(distinct))
    out.parquet(path)


#: A sample of up to so many rows is one file.
ONE_FILE = 100_000


def write_sample(df: DataFrame, path: str, order: Sequence[str], rows: int | None = 10, index: bool = True) -> None:
    """The first ``rows`` rows by ``order`` (all of them, if ``None``) as CSV with a header, the row number from 0 in front if ``index``.

    A sort with a limit keeps only that many rows per task. Up to ``ONE_FILE``
    rows are one file; more are files whose names follow the order, numbered
    through by :func:`row_index`, so that no task has them all.
    """
    by = [c(o) for o in order]
    out = df if rows is None else df.orderBy(*by).limit(rows)
    if index:
        out = row_index(out, order, INDEX)
        by = [F.col(INDEX)]
    few = rows is not None and rows <= ONE_FILE
    out = out.coalesce(1).sortWithinPartitions(*by) if few else out.repartitionByRange(*by).sortWithinPartitions(*by)
    out.write.mode("overwrite").option("header", True).csv(path)


def running_totals(
    df: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str], segment: Column | str | None = FOUND,
) -> DataFrame:
    """A row per key and day that occurs: the sums of ``columns`` up to and including that day.

    Days without rows have no row. Days are summed before anything is ordered;
    a key with very many days is worked in pieces. A missing value counts as 0.
    """
    per_day = df.where(c(day).isNotNull()).groupBy(*[c(k) for k in keys], c(day).cast("date").alias(day)).agg(
        *[F.coalesce(F.sum(c(n)), F.lit(0)).alias(n) for n in columns]
    )
    return running_sums(per_day, columns, keys, [day], segment)


def range_from_totals(totals: DataFrame, keys: Sequence[str], day: str, first: Day, last: Day, columns: Sequence[str]) -> DataFrame:
    """The sums of a date range out of :func:`running_totals`: two rows a key, the last one up to ``last`` less the last one before ``first``.

    Keys without a day in the range are left out, as they are from a sum over the range.
    """
    values = F.struct(*[c(n) for n in columns])
    at, before = F.lit(last).cast("date"), F.lit(first).cast("date")
    ends = totals.where(c(day) <= at).groupBy(*[c(k) for k in keys]).agg(
        F.max_by(values, c(day)).alias("_to"), F.max(c(day)).alias("_last"),
        F.max_by(F.when(c(day) < before, values), F.when(c(day) < before, c(day))).alias("_from"),
    )
    less = lambda n: F.col("_to").getField(n) - F.coalesce(F.col("_from").getField(n), F.lit(0))
    return ends.where(F.col("_last") >= before).select(*[c(k) for k in keys], *[less(n).alias(n) for n in columns])
