"""Batting ratios from summed counting columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def batting_ratios(ab: Column, h: Column, doubles: Column, triples: Column, hr: Column,
                   bb: Column, hbp: Column, sf: Column) -> dict[str, Column]:
    """BA, OBP, SLG and OPS, unrounded; NULL where the denominator is zero."""
    obp = _ratio(h + bb + hbp, ab + bb + hbp + sf)
    slg = _ratio(h + doubles + triples * 2 + hr * 3, ab)
    return {"BA": _ratio(h, ab), "OBP": obp, "SLG": slg, "OPS": obp + slg}
