"""Share profiles: how often each category occurs per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.functions.pitches import bucket_flags, pre_pitch_count
from pitchflow.schemas import c, q

# Texts of the guards.
NO_DATA = "No data available for that player. Please try again or display all."
BAD_CONFIDENCE = "Confidence Level out of range. Please choose a number between 0 and 1"


#: Marks the pitches that count where the others are carried along.
KEPT = "_kept"


class NoDataError(ValueError):
    """The chosen player has no rows."""


def _reduce(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], label: Column | None, category: Sequence[str]):
    """The rows reduced to counts per key, label and category, and what to sum in them.

    The label is a grouping key here and not an aggregate, since an aggregate
    over text cannot be kept in a hash table and would sort every row.
    """
    by = [c(k) for k in keys]
    if label is not None:
        by.append(label.cast("string").alias("_label"))
    rows = F.count(F.lit(1)).alias("_rows")
    if category:
        reduced = df.groupBy(*by, *[c(n).alias(f"_c{i}") for i, n in enumerate(category)]).agg(rows)
        named = reduced.selectExpr(
            *[q(k) for k in keys], *(["_label"] if label is not None else []), "_rows",
            *[f"_c{i} AS {q(n)}" for i, n in enumerate(category) if n not in keys],
        )
        flagged = named.select("*", *[flag.alias(f"_f{i}") for i, flag in enumerate(flags.values())])
        return flagged.selectExpr(*[q(n) for n in named.columns], *[f"_f{i} * _rows AS _f{i}" for i in range(len(flags))])
    return df.groupBy(*by).agg(rows, *[F.sum(flag).alias(f"_f{i}") for i, flag in enumerate(flags.values())])


def _shares(flags: Mapping[str, Column], label: Column | None, label_name: str, count_name: str, label_nulls: str):
    """The aggregates over reduced rows."""
    out: list[Column] = []
    if label is not None:
        top = F.max("_label")
        if label_nulls == "propagate":
            top = F.when(~F.max(F.col("_label").isNull()), top)
        out.append(top.alias(label_name))
    rows = F.sum("_rows")
    out.append(rows.alias(count_name))
    return out + [F.expr(f"sum(_f{i}) / sum(_rows) AS {q(name)}") for i, name in enumerate(flags)]


def share_profile(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, Column],
    label: Column | None = None,
    label_name: str = "label",
    count_name: str = "rows",
    label_nulls: str = "skip",
    category: Sequence[str] = (),
    ordered: bool = True,
) -> DataFrame:
    """Per key: the greatest label, the number of rows, and each flag's share of them.

    ``flags`` maps output names to 0/1 expressions. If they depend on a few
    columns with few values only, name these in ``category``: then rows are just
    counted per key and category, and the flags are worked out on the counts.
    Every key, however frequent, is reduced before the shuffle.

    The greatest label goes by byte order; ``label_nulls="propagate"`` makes it
    NULL where any label of the key is missing. Sorted by volume, ties in key
    order.
    """
    if label is None and not category:
        rows = F.count(F.lit(1))
        shares = [(F.sum(flag) / rows).alias(name) for name, flag in flags.items()]
        out = df.groupBy(*[c(k) for k in keys]).agg(rows.alias(count_name), *shares)
    else:
        reduced = _reduce(df, keys, flags, label, category)
        out = reduced.groupBy(*[c(k) for k in keys]).agg(*_shares(flags, label, label_name, count_name, label_nulls))
    if ordered:
        out = out.orderBy(c(count_name).desc(), *[c(k).asc_nulls_last() for k in keys])
    return out


def profile_of_counts(
    counts: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], label: str, label_name: str = "label", count_name: str = "rows",
    label_nulls: str = "skip", rows: str = "_rows",
) -> DataFrame:
    """:func:`share_profile` of rows that come counted: ``rows`` says how often each one stands."""
    weighed = counts.select(
        *[c(k) for k in keys], c(label).alias("_label"), c(rows).alias("_rows"),
        *[(flag * c(rows)).alias(f"_f{i}") for i, flag in enumerate(flags.values())],
    )
    return weighed.groupBy(*[c(k) for k in keys]).agg(*_shares(flags, F.col("_label"), label_name, count_name, label_nulls))


def _pitches(
    pbp: DataFrame, entity: str, entity_id: int, confidence: float, with_count: bool, check: bool | str, keep: Sequence[str] = (),
) -> DataFrame:
    if entity not in ("pitcher", "batter"):
        raise ValueError("entity must be 'pitcher' or 'batter'")
    ident = c(f"matchup.{entity}.id")
    if entity_id != 0:
        pbp = pbp.where(ident == entity_id)
        if check is True and pbp.isEmpty():
            raise NoDataError(NO_DATA)
    if confidence >= 1 or confidence <= 0:
        raise ValueError(BAD_CONFIDENCE)
    code = c("details.type.code")
    counts = (c("pitchData.typeConfidence") >= confidence) & (c("type") == "pitch") & code.isNotNull()
    late = check == "action" and entity_id != 0
    if not late:
        pbp = pbp.where(counts)
    columns = [
        *[c(n) for n in keep],
        *([F.coalesce(counts, F.lit(False)).alias(KEPT)] if late else []),
        ident.alias(entity),
        c(f"matchup.{entity}.fullName").alias("player"),
        c("count.outs.start").alias("outs"),
        code.alias("pitch_type"),
    ]
    if with_count:
        label = pre_pitch_count(
            c("details.isStrike"), c("details.isBall"), c("details.isInPlay"),
            c("count.balls.start"), c("count.strikes.start"),
        )
        columns.append(label.alias("Count"))
    return pbp.select(*columns)


def tendencies(
    pbp: DataFrame,
    entity: str,
    entity_id: int = 0,
    confidence: float = 0.5,
    add_count: bool = False,
    add_outs: bool = False,
    check: bool | str = False,
    label_nulls: str = "propagate",
    ordered: bool = True,
) -> DataFrame:
    """Pitches and pitch-type shares per pitcher or batter.

    ``entity_id`` 0 means everyone. ``add_count`` and ``add_outs`` refine the
    groups by the count before the pitch and by the outs. ``check=True`` costs a
    job: it raises ``NoDataError`` when the chosen player has no rows, before the
    confidence is looked at. ``check="action"`` costs none: the job that makes the
    result fails with that text. A share counts codes of its list over *all* pitches
    with a code, so shares need not add up to one.
    """
    pitches = _pitches(pbp, entity, entity_id, confidence, add_count, check)
    keys = [entity, *(["Count"] if add_count else []), *(["outs"] if add_outs else [])]
    if KEPT in pitches.columns:
        # One player's plays, counted per key and pitch type, fit in one row; a count over no rows is a row as well, so the guard always runs.
        reduced = _reduce(pitches, [KEPT, *keys], bucket_flags("pitch_type"), F.col("player"), ["pitch_type"])
        listed = reduced.agg(F.collect_list(F.struct("*")).alias("_r"))
        some = F.when(F.size("_r") > 0, F.col("_r")).otherwise(F.raise_error(F.lit(NO_DATA)))
        counted = listed.select(F.inline(some)).where(c(KEPT))
        out = counted.groupBy(*[c(k) for k in keys]).agg(
            *_shares(bucket_flags("pitch_type"), F.col("player"), "player", "pitches", label_nulls)
        )
        return out.orderBy(c("pitches").desc(), *[c(k).asc_nulls_last() for k in keys]) if ordered else out
    return share_profile(
        pitches, keys, bucket_flags("pitch_type"), F.col("player"), "player", "pitches", label_nulls,
        ["pitch_type"], ordered,
    )


def pitcher_tendencies(pbp: DataFrame, pitcher_id: int = 0, confidence: float = 0.5,
                       add_count: bool = False, add_outs: bool = False, check: bool | str = False) -> DataFrame:
    return tendencies(pbp, "pitcher", pitcher_id, confidence, add_count, add_outs, check)


def batter_tendencies(pbp: DataFrame, batter_id: int = 0, confidence: float = 0.5,
                      add_count: bool = False, add_outs: bool = False, check: bool | str = False) -> DataFrame:
    return tendencies(pbp, "batter", batter_id, confidence, add_count, add_outs, check)


def share_all_levels(
    df: DataFrame,
    entity: str,
    extra: Sequence[str],
    flags: Mapping[str, Column],
    label: Column | None = None,
    label_name: str = "label",
    count_name: str = "rows",
    label_nulls: str = "skip",
    category: Sequence[str] = (),
) -> DataFrame:
    """The profiles by entity alone and by entity with every subset of ``extra``, in one pass.

    The rows are first reduced to counts per finest key; only these, not the
    rows, are multiplied by the grouping sets. ``level`` names the key columns.
    """
    keys = [entity, *extra]
    reduced = _reduce(df, keys, flags, label, category)
    sets = [[entity, *[e for j, e in enumerate(extra) if mask >> j & 1]] for mask in range(2 ** len(extra))]
    level = F.concat_ws(",", *[F.when(F.grouping(c(k)) == 0, F.lit(k)) for k in keys]).alias("level")
    return reduced.groupingSets([[c(k) for k in s] for s in sets], *[c(k) for k in keys]).agg(
        level, *_shares(flags, label, label_name, count_name, label_nulls)
    )


def tendencies_all_levels(pbp: DataFrame, entity: str, entity_id: int = 0, confidence: float = 0.5,
                          label_nulls: str = "propagate") -> DataFrame:
    """All four key sets of :func:`tendencies` from one pass over the plays."""
    pitches = _pitches(pbp, entity, entity_id, confidence, True, False)
    return share_all_levels(
        pitches, entity, ["Count", "outs"], bucket_flags("pitch_type"), F.col("player"), "player", "pitches",
        label_nulls, ["pitch_type"],
    )


#: Columns of :func:`pitch_counts` by which tendencies are kept up to date, for one kind of player.
COUNT_KEYS = {"game_pk": "BIGINT", "{entity}": "BIGINT", "player": "STRING", "outs": "INT", "pitch_type": "STRING", "Count": "STRING"}


def count_schema(entity: str) -> dict[str, str]:
    return {n.format(entity=entity): kind for n, kind in COUNT_KEYS.items()}


def countable_pitches(pbp: DataFrame, entity: str, confidence: float = 0.5) -> DataFrame:
    """The pitches that tendencies count, a row each, with the columns of :func:`count_schema`."""
    return _pitches(pbp, entity, 0, confidence, True, False, ("game_pk",)).select(*[c(n) for n in count_schema(entity)])


def tendencies_of_counts(
    counts: DataFrame, entity: str, add_count: bool = False, add_outs: bool = False, label_nulls: str = "propagate",
) -> DataFrame:
    """:func:`tendencies` of everyone from counted pitches, unordered."""
    keys = [entity, *(["Count"] if add_count else []), *(["outs"] if add_outs else [])]
    return profile_of_counts(counts, keys, bucket_flags("pitch_type"), "player", "player", "pitches", label_nulls)
