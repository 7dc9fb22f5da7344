"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def paste(*parts: Column | str, sep: str = "-") -> Column:
    """Join values into one text, writing a missing value as ``NA``.

    ``concat`` would turn the whole text into NULL and ``concat_ws`` would skip
    the missing part.
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and sep:
            pieces.append(F.lit(sep))
        text = F.lit(part) if isinstance(part, str) else part.cast("string")
        pieces.append(F.coalesce(text, F.lit("NA")))
    return F.concat(*pieces)


def date_prefix(col: Column) -> Column:
    """The calendar day of an ISO date-time text, as text."""
    return F.substring(col.cast("string"), 1, 10)
