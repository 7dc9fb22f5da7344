"""Pitch expressions: type buckets, the count before the pitch, batting side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchflow.functions.text import paste
from pitchflow.schemas import q

# The pitch-type codes of each bucket.
BUCKETS: dict[str, tuple[str, ...]] = {
    "fastballs": ("SI", "FT", "FF", "FC", "FO"),
    "offspeed": ("CH", "EP", "KN", "FS"),
    "breaking_ball": ("CU", "KC", "SC", "SL", "CS"),
}
# Output name and code of each single pitch type, in output order.
SINGLE_TYPES: dict[str, str] = {
    "fs_fb": "FF",
    "ts_fb": "FT",
    "change": "CH",
    "curveball": "CU",
    "slow_curve": "CS",
    "cutter": "FC",
    "eephus": "EP",
    "fork": "FO",
    "knuckle": "KN",
    "knuckle_curve": "KC",
    "screw": "SC",
    "sink": "SI",
    "slider": "SL",
    "split": "FS",
}
SHARE_NAMES: list[str] = [*BUCKETS, *SINGLE_TYPES]


def code_flag(column: str, *codes: str) -> Column:
    """1 where ``column`` holds one of ``codes``, else 0 (also where it is missing)."""
    listed = ", ".join(f"'{code}'" for code in codes)
    return F.expr(f"CASE WHEN {q(column)} IN ({listed}) THEN 1 ELSE 0 END")


def null_flag(code: Column) -> Column:
    return code.isNull().cast("int")


def bucket_flags(code: str) -> dict[str, Column]:
    """The 0/1 indicators behind the 17 share columns, by output name, over the column ``code``."""
    flags = {name: code_flag(code, *codes) for name, codes in BUCKETS.items()}
    flags.update({name: code_flag(code, single) for name, single in SINGLE_TYPES.items()})
    return flags


# Fixed value: the text of the label of other pitches.
OTHER_PITCH = "Pitch Not a Ball or Strike. Original Count: "


def pre_pitch_count(strike: Column, ball: Column, in_play: Column, balls: Column, strikes: Column) -> Column:
    """The ball-strike count the pitch was thrown at, as ``b-s``.

    The event carries the count *after* the pitch, so the pitch's own effect is
    taken off again; the first true flag decides. Every strike takes one off,
    including a foul that left the count at two. A flag that is missing when it
    is needed gives NULL.
    """
    return (
        F.when(strike.isNull(), F.lit(None).cast("string"))
        .when(strike, paste(balls, strikes - 1))
        .when(ball.isNull(), F.lit(None).cast("string"))
        .when(ball, paste(balls - 1, strikes))
        .when(in_play.isNull(), F.lit(None).cast("string"))
        .when(in_play, paste(balls, strikes))
        .otherwise(F.concat(F.lit(OTHER_PITCH), paste(balls, strikes)))
    )


def choose_side(half: Column, when_bottom: Column, when_top: Column) -> Column:
    """``when_bottom`` in the bottom half, ``when_top`` in any other known half,
    NULL where the half is unknown."""
    return F.when(half == "bottom", when_bottom).when(half.isNotNull(), when_top)


def side_columns(half: Column, home: Column, away: Column) -> dict[str, Column]:
    return {
        "batting_team": choose_side(half, home, away),
        "fielding_team": choose_side(half, away, home),
    }
