"""Joins, unions and frequency tables over any DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.schemas import c

# A right key with this many rows is worth splitting; at most so many keys are, and each into so many cells.
SPLIT_ROWS, SPLIT_KEYS, CELLS = 100_000, 1000, 16
# A right key's rows are dealt only as far as it takes to have so many in a cell.
CELL_ROWS = 4000


def cols_first(df: DataFrame, *names: str) -> DataFrame:
    """The named columns first, the others after them in their order."""
    return df.select(*[c(n) for n in names], *[c(n) for n in df.columns if n not in names])


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Column names from ``first`` to ``last`` by position, both included."""
    names = df.columns
    a, b = names.index(first), names.index(last)
    return names[a : b + 1] if a <= b else names[b : a + 1][::-1]


def _all(conditions):
    return reduce(lambda x, y: x & y, conditions)


def left_join_suffixed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    scope: Sequence[str] = (),
    suffixes: tuple[str, str] = (".x", ".y"),
    hot_right_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Left join in which a missing key matches a missing key.

    ``on`` pairs a left with a right column; ``scope`` names columns of both
    sides (a game id) that must be equal as well. The left key names survive,
    other names found on both sides get the suffixes, several matches multiply
    the left row.

    A left key with very many rows is split by adaptive execution, which cuts
    the left side of a left join. It cannot cut the right side, so the
    ``SPLIT_KEYS`` most frequent right keys with at least ``hot_right_rows`` rows
    are split into a grid of ``CELLS`` cells. Their right rows are dealt into
    parts of about ``CELL_ROWS`` rows, and their left rows into as many groups as
    there are cells for a part, both by a hash of the row: a left row is repeated
    for each part only, a right row for each group. Such a left row has a match,
    so its copies without one are dropped again. It is one join, with the same
    result whatever the counts are. The left side is read once, the right side
    twice. Where the scope keeps groups small, ``None`` leaves all this out.
    """
    keys = [*on, *((s, s) for s in scope)]
    right_keys = {r for _, r in keys}
    left_keep = set(scope) | {lk for lk, _ in on}
    shared = (set(left.columns) & set(right.columns)) - set(scope)
    shared -= {n for n in shared if n in right_keys and n in left_keep}

    renamed_left = {n: n + suffixes[0] if n in shared else n for n in left.columns}
    lhs = left.select(*[c(n).alias(renamed_left[n]) for n in left.columns])
    right_values = [n for n in right.columns if n not in right_keys]
    rhs = right.select(
        *[c(r).alias(f"_rk{i}") for i, (_, r) in enumerate(keys)],
        *[c(n).alias(n + suffixes[1] if n in shared else n) for n in right_values],
    )
    out = [*renamed_left.values(), *[n + suffixes[1] if n in shared else n for n in right_values]]

    def condition(a: DataFrame, b: DataFrame, prefix: str):
        pairs = []
        for i, (lk, _) in enumerate(keys):
            x, y = a[f"`{renamed_left[lk]}`"], b[f"{prefix}{i}"]
            pairs.append(x == y if lk in scope else x.eqNullSafe(y))
        return _all(pairs)

    if hot_right_rows is None:
        return lhs.join(rhs, condition(lhs, rhs, "_rk"), "left").select(*[c(n) for n in out])

    # A list of bounded length, so it is safe to broadcast.
    hot = F.broadcast(
        rhs.groupBy(*[f"_rk{i}" for i in range(len(keys))])
        .count()
        .where(F.col("count") >= hot_right_rows)
        .orderBy(F.desc("count"), *[f"_rk{i}" for i in range(len(keys))])
        .limit(SPLIT_KEYS)
        .select(
            *[F.col(f"_rk{i}").alias(f"_hk{i}") for i in range(len(keys))],
            F.least(F.ceil(F.col("count") / CELL_ROWS), F.lit(CELLS)).cast("int").alias("_hot"),
        )
    )
    same = [rhs[f"_rk{i}"] == hot[f"_hk{i}"] if lk in scope else rhs[f"_rk{i}"].eqNullSafe(hot[f"_hk{i}"]) for i, (lk, _) in enumerate(keys)]

    # Cell p * groups + g of a key has the right rows of part p and the left rows of group g; ``_hot`` is the number of parts.
    parts = F.coalesce("_hot", F.lit(1))
    groups = F.when(F.col("_hot").isNull(), 1).otherwise(F.floor(F.lit(CELLS) / F.col("_hot")).cast("int"))

    def dealt(df: DataFrame, into):
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        hashed = F.xxhash64(*[df[f"`{n}`"] for n, kind in kinds.items() if "map<" not in kind and "variant" not in kind])
        return F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(hashed, into).cast("int"))

    first, group = dealt(rhs, parts) * groups, dealt(lhs, groups)
    parted = rhs.join(hot, _all(same), "left").select(
        *[rhs[f"`{n}`"] for n in rhs.columns], F.lit(True).alias("_met"),
        F.explode(F.sequence(first, first + groups - 1)).alias("_rpart"),
    )
    repeated = lhs.join(hot, condition(lhs, hot, "_hk"), "left").select(
        *[lhs[f"`{n}`"] for n in lhs.columns], "_hot",
        F.explode(F.sequence(group, group + (parts - 1) * groups, groups)).alias("_lpart"),
    )
    joined = repeated.join(parted, condition(repeated, parted, "_rk") & (repeated["_lpart"] == parted["_rpart"]), "left")
    return joined.where(F.col("_hot").isNull() | F.col("_met")).select(*[c(n) for n in out])


def union_fill(*frames: DataFrame, strict: bool = False) -> DataFrame:
    """Stack by column name, keeping duplicates; columns a frame lacks are NULL.

    ``strict`` demands the same columns everywhere. A column with two types is
    refused: Spark would pick one silently and fail on the values at run time.
    """
    types: dict[str, str] = {}
    for df in frames:
        for field in df.schema.fields:
            kind = field.dataType.simpleString()
            if types.setdefault(field.name, kind) != kind:
                raise TypeError(f"column {field.name} is {types[field.name]} in one frame and {kind} in another")
    if strict:
        for df in frames:
            if set(df.columns) != set(types):
                raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(types))}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)


def exclude_ids(df: DataFrame, column: str, ids: Iterable | DataFrame) -> DataFrame:
    """Drop rows whose id is in ``ids``; a missing id is in no list and stays.

    A short list becomes a predicate, a long one or a DataFrame an anti join.
    """
    if not isinstance(ids, DataFrame):
        listed = [i for i in ids if i is not None]
        if len(listed) <= 200:
            return df.where(c(column).isNull() | ~c(column).isin(*listed))
        ids = df.sparkSession.createDataFrame([(i,) for i in listed], ["_id"])
    # Distinct first: that is reduced before the shuffle, so an id listed very often costs nothing.
    only = ids.select(c(ids.columns[0]).alias("_id")).distinct()
    return df.join(only, c(column) == F.col("_id"), "left_anti")


def code_frequencies(df: DataFrame, *codes: str, ordered: bool = True) -> DataFrame:
    """Rows per code combination as ``cnt``, ordered by code with the missing one last."""
    counts = df.groupBy(*[c(n) for n in codes]).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(*[c(n).asc_nulls_last() for n in codes]) if ordered else counts


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, a missing value before all others.

    The least value of the first order column is found in hash tables; only
    rows that have it go on to the comparison of whole rows, which sorts.
    """
    rest = [n for n in df.columns if n not in keys]
    lead = c(order[0])
    least = df.groupBy(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(lead).alias("_least"), F.max(lead.isNull()).alias("_missing")
    )
    least = least.withColumn("_least", F.when(~F.col("_missing"), F.col("_least")))
    same = _all([c(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    candidates = df.join(least, same & lead.eqNullSafe(F.col("_least")), "left_semi")
    row = F.min_by(F.struct(*[c(n) for n in rest]), F.struct(*[c(n) for n in order])).alias("_row")
    first = candidates.groupBy(*[c(n) for n in keys]).agg(row)
    return first.select(*[c(n) for n in keys], *[F.col("_row").getField(n).alias(n) for n in rest])
