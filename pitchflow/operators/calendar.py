"""Season calendar: weekly windows, game days, game ids."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.schemas import c, q

WEEK = 7
#: Days of an aligned block, through which days meet windows.
BLOCK = 16


def season_bounds(season: int, start: str, end: str) -> tuple[dt.date, dt.date]:
    """``(2020, "-07-24", "-09-27")`` as two dates."""
    return dt.date.fromisoformat(f"{season}{start}"), dt.date.fromisoformat(f"{season}{end}")


def week_grid(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """``(week, start_date, end_date)``: full weeks from ``first``, the last one
    may reach beyond ``last``."""
    starts = F.sequence(F.lit(first), F.lit(last), F.expr("interval 7 days"))
    grid = spark.range(1).select(F.posexplode(starts).alias("week", "start_date"))
    return grid.select(
        (F.col("week") + 1).alias("week"), "start_date", F.date_add("start_date", WEEK - 1).alias("end_date")
    )


def grid_end(first: dt.date, last: dt.date) -> dt.date:
    """The last day of the last weekly window."""
    weeks = (last - first).days // WEEK
    return first + dt.timedelta(days=WEEK * weeks + WEEK - 1)


def pull_weeks(df: DataFrame, date_column: str, first: dt.date, last: dt.date) -> DataFrame:
    """The rows of the weekly windows, with their week number and window.

    The windows are back to back, so the week is plain arithmetic on the date
    and no join with the grid is needed; the date range itself reaches the scan
    as a filter on ``date_column``.
    """
    day = c(date_column)
    kept = df.where(day >= F.lit(first)).where(day < F.lit(grid_end(first, last) + dt.timedelta(days=1)))
    index = F.floor(F.datediff(day.cast("date"), F.lit(first)) / WEEK).cast("int")
    kept = kept.withColumn("week", index + 1)
    start = F.date_add(F.lit(first), (F.col("week") - 1) * WEEK)
    return kept.withColumn("start_date", start).withColumn("end_date", F.date_add(F.col("start_date"), WEEK - 1))


def week_counts(df: DataFrame, date_column: str, first: dt.date, last: dt.date, errors: DataFrame | None = None) -> DataFrame:
    """Rows per weekly window, the empty windows included, with a status.

    ``errors`` has one row per failed pull with a day of its window in
    ``date_column``; such a window's status is error, whatever rows it has.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return pull_weeks(rows, date_column, first, last).groupBy("week").agg(F.count(F.lit(1)).alias(name))

    # All sides have one row per week.
    grid = week_grid(df.sparkSession, first, last).join(counted(df, "number_rows"), "week", "left")
    grid = grid.withColumn("number_rows", F.coalesce("number_rows", F.lit(0)))
    status = F.when(F.col("number_rows") > 0, "ok").otherwise("empty")
    if errors is not None:
        grid = grid.join(counted(errors, "_failed"), "week", "left")
        status = F.when(F.col("_failed") > 0, "error").otherwise(status)
    return grid.withColumn("status", status).drop("_failed")


def distinct_days(df: DataFrame, date_column: str = "game_date") -> DataFrame:
    """The days that occur, once each, without the missing one."""
    return df.where(c(date_column).isNotNull()).select(c(date_column).cast("date").alias("game_date")).distinct()


def game_ids_for_days(days: DataFrame, schedule: DataFrame, dedupe: bool = True) -> DataFrame:
    """``(game_pk, listed_on)``: the games the schedule lists on these days.

    ``schedule`` has ``date`` and ``gamePk``. A game listed on two days comes
    twice unless ``dedupe``; then the first day is kept.
    """
    listed = schedule.select(F.col("date").cast("date").alias("game_date"), F.col("gamePk").alias("game_pk"))
    ids = listed.join(days.select("game_date"), "game_date").select("game_pk", F.col("game_date").alias("listed_on"))
    if dedupe:
        ids = ids.groupBy("game_pk").agg(F.min("listed_on").alias("listed_on"))
    return ids


def season_summary(pitches: DataFrame, ids: DataFrame, date_column: str = "game_date") -> DataFrame:
    """One row: game days, listed game ids, distinct game ids."""
    days = distinct_days(pitches, date_column).agg(F.count(F.lit(1)).alias("n_days"))
    games = ids.agg(F.count(F.lit(1)).alias("n_ids"), F.countDistinct("game_pk").alias("n_distinct_ids"))
    both = days.unionByName(games, allowMissingColumns=True)
    return both.agg(*[F.max(n).alias(n) for n in both.columns])


def season_windows(spark: SparkSession, seasons: Sequence[tuple[dt.date, dt.date]], days: int = WEEK) -> DataFrame:
    """``(season, week, start_date, end_date)``: each season's full windows of ``days``, numbered from 1.

    Between seasons there is a gap; seasons may also overlap.
    """
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(seasons, 1)], "season INT, a DATE, b DATE")
    starts = rows.where("a <= b").selectExpr("season", f"posexplode(sequence(a, b, interval {days} days)) AS (week, start_date)")
    return starts.selectExpr("season", "week + 1 AS week", "start_date", f"date_add(start_date, {days - 1}) AS end_date")


def in_windows(df: DataFrame, date_column: str, windows: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Each row with each window its day lies in, both ends included; windows may overlap and leave gaps.

    Days are cut into aligned blocks. A window is listed under the blocks it
    touches, a row under its own, and they meet by the block alone, an
    equi-join, whose windows are then compared. A row travels once; a window
    meets at most the days of two blocks in vain. A row without a day, a window
    without an end, or one that ends before it starts, meets nothing.
    """
    clash = {n.lower() for n in df.columns} & {n.lower() for n in windows.columns}
    if clash:
        raise ValueError(f"rows and windows both have {sorted(clash)}")
    first, last = (f"CAST({q(n)} AS DATE)" for n in (start, end))
    block = lambda day: f"CAST(floor(unix_date({day}) / {BLOCK}) AS INT)"
    listed = windows.where(f"{first} <= {last}").selectExpr("*", f"explode(sequence({block(first)}, {block(last)})) AS _block")
    day = f"CAST({q(date_column)} AS DATE)"
    met = df.selectExpr("*", f"{block(day)} AS _block").join(listed, "_block")
    return met.where(F.expr(f"{day} BETWEEN {first} AND {last}")).drop("_block")


def window_counts(
    df: DataFrame, date_column: str, windows: DataFrame, errors: DataFrame | None = None, start: str = "start_date", end: str = "end_date",
) -> DataFrame:
    """``windows`` with ``number_rows`` and ``status``, as :func:`week_counts`, for windows of any shape.

    A day is counted once and then as often as there are windows over it.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        days = rows.select(c(date_column).cast("date").alias("_day")).groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
        met = in_windows(days, "_day", windows.select(F.struct("*").alias("_w"), c(start).alias("_start"), c(end).alias("_end")).distinct(), "_start", "_end")
        return met.groupBy("_w").agg(F.sum("_n").alias(name))

    grid = windows.withColumn("_w", F.struct("*")).join(counted(df, "number_rows"), "_w", "left")
    grid = grid.withColumn("number_rows", F.coalesce("number_rows", F.lit(0)))
    status = F.when(F.col("number_rows") > 0, "ok").otherwise("empty")
    if errors is not None:
        grid = grid.join(counted(errors, "_failed"), "_w", "left")
        status = F.when(F.col("_failed") > 0, "error").otherwise(status)
    return grid.withColumn("status", status).drop("_failed", "_w")


def id_bitmaps(df: DataFrame, id_column: str, keys: Sequence[str]) -> DataFrame:
    """The distinct whole-number ids of each key as bitmaps: ``keys``, ``bucket``, ``bits``.

    A bitmap of 4 KiB holds the ids of one bucket of 32,768, so rows are as many
    as the buckets in use. Bitmaps merge: those of weeks make those of a season.
    """
    known = df.where(c(id_column).isNotNull()).withColumn("_id", c(id_column).cast("bigint"))
    bucket = F.bitmap_bucket_number("_id").alias("bucket")
    return known.groupBy(*[c(k) for k in keys], bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser ``keys``."""
    return bitmaps.groupBy(*[c(k) for k in keys], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str = "n_distinct_ids") -> DataFrame:
    """The exact number of distinct ids per key, of :func:`id_bitmaps` or :func:`merge_bitmaps` by the same keys."""
    return bitmaps.groupBy(*[c(k) for k in keys]).agg(F.sum(F.bitmap_count("bits")).alias(name))
