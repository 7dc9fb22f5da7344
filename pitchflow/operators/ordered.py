"""Operators that depend on row order within a group.

A window puts each group in one task, which is right for groups that are small
by nature (the events of one game) and wrong for a key that may hold a third of
a large table. So every operator here works a group in pieces:

1. the table is dealt once by (group, segment);
2. each piece is summarised to one row, and what a piece must know of the others
   is worked out on these rows alone;
3. that knowledge is joined to the piece, and the window runs inside the piece.

The result does not depend on where a group is cut, and the plan is the same at
every size. Both uses of the table read the one shuffle.

``segment`` says where the pieces end. By default (``FOUND``) the operator finds
out itself: a sample of bounded size, taken by a hash of the rows, shows which
groups hold more than one piece's share of the table and which places in the
order divide them evenly. The table's keys and order columns are read twice for
that, once to count; where the input is costly to make, write it first. An
integer expression that never decreases along the order spares this, for
instance ``event_id >> 20`` for a unique ``event_id``; a missing or decreasing
one is an error when the query runs, never another result. ``None`` means plain
windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.schemas import c, q

#: Pieces are found from a sample.
FOUND = "found"
#: Pieces of the whole table per shuffle partition, and sampled rows per piece.
PIECES, SAMPLED = 4, 32


def _list(names: Sequence[str]) -> str:
    return ", ".join(q(n) for n in names)


def _order(names: Sequence[str], how: str = "") -> str:
    return ", ".join(f"{q(n)} {how}".strip() for n in names)


SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
# A piece: its group and its segment.
PIECE = "_group, _seg"
LATER = f"(PARTITION BY _of ORDER BY _nth DESC {BEFORE})"
EARLIER = f"(PARTITION BY _of ORDER BY _nth {BEFORE})"


def _group(df: DataFrame, keys: Sequence[str]) -> Column:
    """All keys, so that a missing key is a key like others. Without keys a 0 made of the row: a constant would be
    folded away, and the table dealt anew by what is left."""
    return F.struct(*[c(k) for k in keys]) if keys else F.struct(F.pmod(F.xxhash64(c(df.columns[0])), F.lit(1)))


def bounds(df: DataFrame, keys: Sequence[str], at: Column, pieces: int) -> DataFrame:
    """``(_of, _cuts)`` of the groups with more than one piece's share: sorted places in the order, fewer than ``pieces`` of all groups.

    A row is in the sample by its hash, so the sample is the same however often
    it is taken; it has about ``SAMPLED`` rows per piece, whatever the table has.
    """
    wanted = float(SAMPLED * pieces)
    keyed = df.select(_group(df, keys).alias("_of"), at.alias("_at"), F.xxhash64(*[c(n) for n in df.columns]).alias("_h"))
    n = df.agg(F.count(F.lit(1)).alias("n")).select(F.greatest("n", F.lit(1))).scalar()
    # The share of the 2^20 hash classes that gives so many rows.
    sample = keyed.where(F.pmod("_h", F.lit(1 << 20)) < F.lit(wanted * (1 << 20)) / n).select("_of", "_at")
    sums = sample.groupBy("_of").agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list("_at")).alias("_ats"))
    # As many pieces as the group has shares of the sample.
    share = sums.selectExpr("_of", "_n", "_ats", f"int(_n * {pieces} / greatest({wanted}D, _n)) AS _m").where("_m > 1")
    return share.selectExpr("_of", "array_distinct(transform(sequence(1, _m - 1), k -> _ats[int(k * _n div _m)])) AS _cuts")


def with_found_segment(df: DataFrame, keys: Sequence[str], at: Column, name: str, pieces: int | None = None) -> DataFrame:
    """``df`` with the number of its group's cuts up to each row, 0 in groups that are not cut."""
    pieces = pieces or PIECES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = bounds(df, keys, at, pieces).selectExpr("_of", "_cuts", "int(ceil(sqrt(size(_cuts)))) AS _step")
    cuts = cuts.selectExpr("*", "transform(sequence(0, int(ceil(size(_cuts) / _step)) - 1), j -> _cuts[j * _step]) AS _heads")
    # The cuts of all groups together are fewer than the pieces: a broadcast of known size.
    met = df.withColumn("_at", at).withColumn("_mine", _group(df, keys)).join(F.broadcast(cuts), F.col("_mine") == F.col("_of"), "left")
    # Found in two looks, each at the square root of all.
    met = met.withColumn("_i", F.expr("size(filter(_heads, h -> h <= _at))"))
    found = "CASE WHEN _cuts IS NULL OR _i = 0 THEN 0 ELSE (_i - 1) * _step + size(filter(slice(_cuts, (_i - 1) * _step + 1, _step), h -> h <= _at)) END"
    return met.select(*[c(n) for n in df.columns], F.expr(found).cast("long").alias(name))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column | str | None) -> tuple[DataFrame, Column | None]:
    """The table and its segment, found if need be. Without an order rows are cut by their hash."""
    if not isinstance(segment, str):
        return df, segment
    if segment != FOUND:
        raise ValueError("segment must be a column, None or FOUND")
    at = F.struct(*[c(n) for n in order]) if order else F.xxhash64(*[c(n) for n in df.columns])
    return with_found_segment(df, keys, at, "_found"), F.col("_found")


def _pieces(df: DataFrame, keys: Sequence[str], segment: Column) -> DataFrame:
    missing = F.raise_error(F.lit("the segment is missing in some row")).cast("long")
    named = df.withColumn("_seg", F.coalesce(segment.cast("long"), missing))
    return named.withColumn("_group", _group(df, keys)).repartition("_group", "_seg")


def _informed(pieces: DataFrame, columns: Sequence[str], order: Sequence[str], stats: Sequence[Column], *carried: Sequence[str]) -> DataFrame:
    """``pieces`` with the last of ``carried``, SQL over the pieces' ``stats`` and over the steps before it.

    A piece's rows have the place ``_nth`` in their group ``_of``. The checksum
    makes the summary need every column, so that Spark sees one shuffle with two
    readers instead of two different ones.
    """
    checked = "_nth"
    if order:
        at = f"struct({_list(order)})"
        stats = [*stats, F.expr(f"min({at})").alias("_lo"), F.expr(f"max({at})").alias("_hi")]
        before = "(PARTITION BY _of ORDER BY _nth)"
        checked = f"if(_lo < lag(_hi) OVER {before}, cast(raise_error('the segment decreases along the order') AS bigint), _nth)"
    every = F.max(F.xxhash64(*[c(n) for n in columns if n != "_found"])).alias("_every")
    summary = pieces.groupBy("_group", "_seg").agg(*stats, every).withColumnsRenamed({"_group": "_of", "_seg": "_nth"})
    for step in carried[:-1]:
        summary = summary.selectExpr("*", *step)
    info = summary.selectExpr("*", f"if(_every IS NULL, NULL, {checked}) AS _checked").selectExpr("_of", "_checked AS _nth", *carried[-1])
    # Every piece has its row. A left join puts no filter below one of the two readers.
    return pieces.join(info, (F.col("_group") == F.col("_of")) & (F.col("_seg") == F.col("_nth")), "left")


def fill_up(df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str], segment: Column | str | None = FOUND) -> DataFrame:
    """Each missing value takes the next present one below it in the group.

    Columns are filled one by one; what has nothing below stays NULL. The window
    runs over the reversed order with a growing frame, which is linear; looking
    forward from every row would be quadratic.
    """
    names = df.columns
    df, segment = _cut(df, keys, order, segment)
    by = _list(keys) if segment is None else PIECE
    below = f"(PARTITION BY {by} ORDER BY {_order(order, 'DESC')} {SO_FAR})"
    if segment is None:
        return df.selectExpr(*[f"last({q(n)}, true) OVER {below} AS {q(n)}" if n in columns else q(n) for n in names])
    at = f"struct({_list(order)})"
    tops = [F.expr(f"min_by({q(n)}, if({q(n)} IS NULL, NULL, {at}))").alias(f"_top{i}") for i, n in enumerate(columns)]
    carried = [f"last(_top{i}, true) OVER {LATER} AS _next{i}" for i in range(len(columns))]
    pieces = _pieces(df, keys, segment)
    data = _informed(pieces, pieces.columns, order, tops, carried)
    number = {n: i for i, n in enumerate(columns)}
    return data.selectExpr(*[
        f"coalesce(last({q(n)}, true) OVER {below}, _next{number[n]}) AS {q(n)}" if n in number else q(n) for n in names
    ])


def last_of_group_flag(
    df: DataFrame, column: str, keys: Sequence[str], name: str, nulls: str = "propagate", segment: Column | str | None = FOUND,
) -> DataFrame:
    """``"true"`` where ``column`` is the group's maximum, else ``"false"``.

    With ``nulls="propagate"`` one missing value makes the flag NULL in its
    whole group; with ``"ignore"`` only on its own row. No order is needed, so
    ``segment`` may be any integer that cuts large groups.
    """
    if nulls not in ("propagate", "ignore"):
        raise ValueError("nulls must be 'propagate' or 'ignore'")
    value, names = q(column), [q(n) for n in df.columns if n != name]
    df, segment = _cut(df, keys, (), segment)
    if segment is None:
        data = df
        missing, top = (f"max({x}) OVER (PARTITION BY {_list(keys)})" for x in (f"{value} IS NULL", value))
    else:
        stats = [F.expr(f"max({value} IS NULL)").alias("_m"), F.expr(f"max({value})").alias("_t")]
        carried = [f"max({x}) OVER (PARTITION BY _of) AS {n}" for x, n in (("_m", "_missing"), ("_t", "_top"))]
        pieces = _pieces(df, keys, segment)
        data = _informed(pieces, pieces.columns, (), stats, carried)
        missing, top = "_missing", "_top"
    flag = f"CASE WHEN {value} = {top} THEN 'true' WHEN {value} IS NOT NULL THEN 'false' END"
    if nulls == "propagate":
        flag = f"if({missing}, NULL, {flag})"
    return data.selectExpr(*names, f"{flag} AS {q(name)}")


def running_record(
    df: DataFrame, result: str, keys: Sequence[str], order: Sequence[str], name: str = "W-L", win: str = "W", loss: str = "L",
    segment: Column | str | None = FOUND,
) -> DataFrame:
    """The record up to and including each row, as ``wins-losses``."""
    names = [q(n) for n in df.columns if n != name]
    df, segment = _cut(df, keys, order, segment)
    data = df.withColumns({
        "_w": c(result).eqNullSafe(F.lit(win)).cast("long"),
        "_l": c(result).eqNullSafe(F.lit(loss)).cast("long"),
    })
    by, wins, losses = _list(keys), "0L", "0L"
    if segment is not None:
        stats = [F.sum("_w").alias("_ws"), F.sum("_l").alias("_ls")]
        carried = [f"coalesce(sum({x}) OVER {EARLIER}, 0L) AS {n}" for x, n in (("_ws", "_w0"), ("_ls", "_l0"))]
        pieces = _pieces(data, keys, segment)
        data, by, wins, losses = _informed(pieces, pieces.columns, order, stats, carried), PIECE, "_w0", "_l0"
    so_far = f"(PARTITION BY {by} ORDER BY {_order(order)} {SO_FAR})"
    return data.selectExpr(*names, f"concat({wins} + sum(_w) OVER {so_far}, '-', {losses} + sum(_l) OVER {so_far}) AS {q(name)}")


def running_sums(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str], segment: Column | str | None = FOUND,
) -> DataFrame:
    """Each of ``columns`` as the group's sum up to and including each row; a missing value adds nothing."""
    names = df.columns
    df, segment = _cut(df, keys, order, segment)
    by, before = _list(keys), {n: "" for n in columns}
    if segment is not None:
        stats = [F.sum(c(n)).alias(f"_sum{i}") for i, n in enumerate(columns)]
        carried = [f"coalesce(sum(_sum{i}) OVER {EARLIER}, 0) AS _base{i}" for i in range(len(columns))]
        pieces = _pieces(df, keys, segment)
        df, by, before = _informed(pieces, pieces.columns, order, stats, carried), PIECE, {n: f"_base{i} + " for i, n in enumerate(columns)}
    so_far = f"(PARTITION BY {by} ORDER BY {_order(order)} {SO_FAR})"
    return df.selectExpr(*[f"{before[n]}coalesce(sum({q(n)}) OVER {so_far}, 0) AS {q(n)}" if n in before else q(n) for n in names])


def _runs(data: DataFrame, by: str, order: str, result: str) -> DataFrame:
    """``_nth_row`` in the group, and ``_len``: the length of the run of equal results that ends at each row.

    The rows so far less those before the last change: all windows have one
    order, so the rows are sorted once.
    """
    rows = f"(PARTITION BY {by} ORDER BY {order})"
    changed = f"NOT ({result} <=> lag({result}) OVER {rows}) AS _changed"
    counted = data.selectExpr("*", changed, f"row_number() OVER {rows} AS _nth_row")
    start = f"last(if(_changed, _nth_row - 1, NULL), true) OVER (PARTITION BY {by} ORDER BY {order} {SO_FAR}) AS _start"
    return counted.selectExpr("*", start).selectExpr("*", "_nth_row - coalesce(_start, 0) AS _len")


def streak(
    df: DataFrame, result: str, keys: Sequence[str], order: Sequence[str], name: str = "Streak", win: str = "W",
    segment: Column | str | None = FOUND,
) -> DataFrame:
    """Signed length of the current run of equal results: positive for ``win``, else negative."""
    names, res = [q(n) for n in df.columns if n != name], q(result)
    df, segment = _cut(df, keys, order, segment)
    if segment is None:
        out, length = _runs(df, _list(keys), _order(order), res), "_len"
    else:
        pieces = _runs(_pieces(df, keys, segment), PIECE, _order(order), res)
        # Per piece: its rows, its last result, and the run it ends with.
        stats = [F.count(F.lit(1)).alias("_n"), *[
            F.expr(f"max_by({x}, _nth_row)").alias(n) for x, n in ((res, "_r"), ("_len", "_t"))
        ]]
        rows = "PARTITION BY _of ORDER BY _nth"
        # A piece of one single run prolongs the run before it when the results agree.
        steps = (
            [f"int(NOT (_t = _n AND _r <=> lag(_r) OVER ({rows}))) AS _first"],
            [f"sum(_first) OVER ({rows} {SO_FAR}) AS _chain"],
            [f"sum(_t) OVER (PARTITION BY _of, _chain ORDER BY _nth {SO_FAR}) AS _run"],
            [f"lag(_r) OVER ({rows}) AS _before_r", f"lag(_run) OVER ({rows}) AS _before_run"],
        )
        out = _informed(pieces, pieces.columns, order, stats, *steps)
        length = f"_len + if(_len = _nth_row AND {res} <=> _before_r, coalesce(_before_run, 0), 0)"
    return out.selectExpr(*names, f"int(if({res} <=> '{win}', 1, -1) * ({length})) AS {q(name)}")


def row_index(
    df: DataFrame, order: Sequence[str], name: str = "_c0", keys: Sequence[str] = (), start: int = 0, segment: Column | str | None = FOUND,
) -> DataFrame:
    """Consecutive numbers from ``start`` along ``order``, in the whole table or in each group; ``name`` comes first.

    Each piece counts its rows, the counts before a piece are summed over one
    row per piece, and rows are numbered inside the piece, so no task sees the
    whole table. Rows that agree in all of ``order`` are numbered in any order.
    """
    names = [q(n) for n in df.columns if n != name]
    df, segment = _cut(df, keys, order, segment)
    by, before = _list(keys) if keys else "0", "0L"
    if segment is not None:
        carried = [f"coalesce(sum(_n) OVER {EARLIER}, 0L) AS _before"]
        pieces = _pieces(df, keys, segment)
        df, by, before = _informed(pieces, pieces.columns, order, [F.count(F.lit(1)).alias("_n")], carried), PIECE, "_before"
    number = f"{start}L + {before} + row_number() OVER (PARTITION BY {by} ORDER BY {_order(order)}) - 1L"
    return df.selectExpr(f"{number} AS {q(name)}", *names)


def attach_forward(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: tuple[str, str], columns: Sequence[str], strict: bool = False,
    segment: Column | str | None = FOUND,
) -> DataFrame:
    """Each left row with ``columns`` of the first right row of its group at or after it (after it, if ``strict``).

    ``at`` names the order column of either side. Both sides are put in one
    order and the right rows' values carried back over the left ones, piece by
    piece; there is no join and no pair of rows, however many rows of one group
    either side has. A missing key is a key like others. A row without ``at``
    meets nothing, as does a left row behind the last right one. Of right rows
    at the same place the least by ``columns`` counts.
    """
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    # Behind its equals, a right row is the next one below them; before them, it is not.
    left_side, right_side = (1, 0) if strict else (0, 1)
    key = lambda df: [c(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    match = F.struct(*[c(n) for n in columns])
    rows = right.where(c(at[1]).isNotNull()).select(*key(right), c(at[1]).alias("_time"), F.lit(right_side).alias("_side"), match.alias("_match"))
    rest = [n for n in left.columns if n not in keys]
    mine = left.select(*key(left), c(at[0]).alias("_time"), F.lit(left_side).alias("_side"), F.struct(*([c(n) for n in rest] or [F.lit(0)])).alias("_row"))
    both = mine.unionByName(rows, allowMissingColumns=True).withColumn("_tie", F.col("_match"))
    filled = fill_up(both, ["_match"], [f"_key{i}" for i in range(len(keys))], ["_time", "_side", "_tie"], segment)
    found = F.when(F.col("_time").isNotNull(), F.col("_match"))
    own = lambda n: F.col(f"_key{keys.index(n)}") if n in keys else F.col("_row").getField(n)
    return filled.where(F.col("_side") == left_side).select(*[own(n).alias(n) for n in left.columns], *[found.getField(n).alias(n) for n in columns])
