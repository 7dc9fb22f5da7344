"""Document fingerprints that can be subtracted: invertible Bloom lookup tables over paragraph digests.

A text's paragraphs are hashed, and each digest is put into three cells of a
small table, one in each third; a cell holds a count, the XOR of its digests and
the XOR of their check hashes. The table is the fingerprint. Subtracting two
tables of one size leaves what the texts don't share; a cell with a single
digest gives it away, it is taken out of its other two cells, and so on until
the table is empty (peeling; Eppstein, Goodrich, Uyeda, Varghese 2011). Where
that gets stuck it is tried again with a table that fits the paragraphs of both
texts and other places, then with larger ones. Should it fail ``TRIES`` times
over, the digests themselves are compared.

The column ``fingerprint`` is a text's table. Its thirds have a power of two of
cells, by the number of the text's own paragraphs alone. A digest's place is its
hash modulo that number, so a table folds to half the size: cells of a third
that are half of it apart are added up. Two texts are compared by their tables
first, the larger folded to the size of the smaller. Cells are rows: since
folding and subtraction are sums, the cells of the difference are made by one
sum over signed digests at the smaller size, and a round of peeling looks at
one third, where each digest has just one cell, and sums again. All cells of a
pair stay in one partition, so the rounds shuffle nothing and compile to hash
aggregates. The sets of digests are written once, in buckets of their rows:
tables, differences and the result are all made bucket by bucket.

Paragraphs end at line ends, at about every second sentence end (where the next
one begins with A to M), and at places inside long stretches that only the
neighbouring letters choose; equal passages have equal paragraphs, whatever
stands before them. These places are rules for Latin letters. A stretch of over
``WHOLE`` characters of which these are less than a quarter is cut where a hash
of two neighbouring characters says so, whatever the script.

Only DataFrame and SQL functions are used. Null texts are empty and have an
empty table; two empty tables are alike (1.0). Repeated paragraphs of a text
count once, and order doesn't count. Rows that repeat are rows like others.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import partitions, quoted, shared_folder, stored

#: The least number of cells of a third of the fingerprint; a power of two.
FIRST = 8
#: Cells of a third for each digest; after the tables of the texts, for those of both texts, doubled on each further try.
#: Rounds of peeling over all three thirds.
ROOM, TRIES, ROUNDS = 0.6, 4, 5

#: Partitions of the cells for each shuffle partition: a digest of 8 bytes becomes three rows of five numbers.
SPREAD = 2
#: Longer stretches of other scripts are cut by neighbouring characters, at one place in ``EVERY`` on average.
WHOLE, EVERY = 200, 48

CUT = r"\n+|(?<=[.!?])[ \t]+(?=[A-M])|(?<=[dgy]) (?=[aeo])"


def digests(text: str) -> str:
    """SQL for the set of paragraph digests of a text expression."""
    # A stretch has no line end, so one can mark the places.
    marked = f"zip_with(cs, slice(cs, 2, size(cs)), (a, b) -> if(pmod(xxhash64(a, b), {EVERY}) = 0, concat(a, '\n'), a))"
    pieces = f"flatten(transform(array(split(x, '')), cs -> split(concat_ws('', {marked}), '\n')))"
    latin = f"length(x) <= {WHOLE} OR 4 * length(regexp_replace(x, '[A-Za-z]', '')) <= 3 * length(x)"
    parts = f"filter(flatten(transform(split({text}, r'{CUT}'), x -> if({latin}, array(x), {pieces}))), x -> length(trim(x)) > 0)"
    return f"array_distinct(transform({parts}, x -> xxhash64(trim(x))))"


def third(keys: str) -> str:
    """SQL for the cells of a third of the table of a set of digests: room for as many again, and up to the next power of two."""
    return f"int(greatest({FIRST}, power(2, ceil(log2({2 * ROOM} * size({keys}))))))"


def written(sets: DataFrame) -> DataFrame:
    """``(row, pair, keys)`` to ``(row, pair, print)``: the table of each set as text, in hexadecimal: the cells of a third and then, with
    spaces between, ``cell:count:digests:check``.

    Empty cells are left out. The rows of ``sets`` lie by ``row``.
    """
    sized = sets.selectExpr("row", "pair", f"{third('keys')} AS s", "explode(keys) AS k")
    placed = ", ".join(_place("k", t, 0) for t in range(3))
    cells = _summed(sized.selectExpr("row", "pair", "s", f"explode(array({placed})) AS cell", "0L AS f", "1 AS n", "k", "xxhash64(k, 7L) AS h"))
    texts = cells.selectExpr("row", "pair", "s", "struct(cell, concat_ws(':', hex(cell), hex(n), hex(k), hex(h)) AS x) AS x")
    listed = texts.groupBy("row", "pair", "s").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return listed.selectExpr("row", "pair", "concat_ws(' ', hex(s), transform(xs, x -> x.x)) AS print")


def _place(key: str, third: int, attempt: int) -> str:
    """SQL for a digest's cell in one third of a table whose thirds have ``s`` cells."""
    return f"int({third} * s + pmod(xxhash64({key}, {10 * attempt + third}L), s))"


def subtracted(pairs: DataFrame, attempt: int = 0) -> DataFrame:
    """``(row, pair, a, b)`` with sets of digests to the cells of table ``a`` less table ``b``: ``(row, pair, s, cell, f, n, k, h)``.

    Attempt 0 subtracts the tables of ``written``, folded to the size of the smaller one, further ones tables that fit both sets.
    The rows of ``pairs`` lie by ``row``; cells that are empty are left out.
    """
    larger = f"int(greatest({FIRST}, ceil({ROOM * 2 ** (attempt - 1)} * (size(a) + size(b)))))"
    sized = pairs.selectExpr("row", "pair", f"{larger if attempt else f'least({third("a")}, {third("b")})'} AS s", "a", "b")
    signed = sized.selectExpr("row", "pair", "s", "explode(concat(transform(a, x -> named_struct('k', x, 'n', 1)), transform(b, x -> named_struct('k', x, 'n', -1)))) AS e")
    placed = ", ".join(_place("e.k", t, attempt) for t in range(3))
    cells = signed.selectExpr("row", "pair", "s", f"explode(array({placed})) AS cell", "0L AS f", "e.n AS n", "e.k AS k", "xxhash64(e.k, 7L) AS h")
    return _summed(cells)


def _summed(cells: DataFrame) -> DataFrame:
    out = cells.groupBy("row", "pair", "s", "cell", "f").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    return out.where("n <> 0 OR k <> 0 OR h <> 0")


def peeled(cells: DataFrame, attempt: int = 0, keep: bool = True, rounds: int = ROUNDS) -> DataFrame:
    """Cells after peeling: rows of cell -1 (only ``a`` has it) and -2 (only ``b``) are recovered digests ``f``, ``n`` times.

    Without ``keep`` these two rows hold the numbers of digests alone. Other rows are cells that got stuck.
    """
    for step in range(3 * rounds):
        third = step % 3
        pure = f"cell >= {third} * s AND cell < {third + 1} * s AND (n = 1 OR n = -1) AND h = xxhash64(k, 7L)"
        digest = "k" if keep else "0L"
        out = [f"named_struct('cell', if(n = 1, -1, -2), 'f', {digest}, 'n', 1, 'k', 0L, 'h', 0L)"]
        out += [f"named_struct('cell', {_place('k', t, attempt)}, 'f', 0L, 'n', -n, 'k', k, 'h', h)" for t in range(3) if t != third]
        same = "named_struct('cell', cell, 'f', f, 'n', n, 'k', k, 'h', h)"
        cells = _summed(cells.selectExpr("row", "pair", "s", f"inline(if({pure}, array({', '.join(out)}), array({same})))"))
    return cells


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written as a table in the shared folder in buckets of ``key``: what is worked by ``key`` from there on shuffles nothing."""
    spark, name = df.sparkSession, f"pitchflow_{uuid.uuid4().hex}"
    count = SPREAD * partitions(spark)
    df.repartition(count, key).write.bucketBy(count, key).option("path", shared_folder(spark)).saveAsTable(name, format="parquet")
    return spark.table(name)


def differences(pairs: DataFrame, keep: bool = False, by_row: bool = False) -> DataFrame:
    """``(row, pair, only_a, only_b)``: how many digests only one of two sets has; with ``keep`` also ``lost`` and ``gained``, the digests.

    ``pairs`` has ``(row, pair, a, b)``; with ``by_row`` they lie by ``row`` already. Pairs without a difference have no row.
    """
    found = []
    pairs = left = pairs if by_row else pairs.repartition(SPREAD * partitions(pairs.sparkSession), "row")
    for attempt in range(TRIES):
        cells = peeled(subtracted(left, attempt), attempt, keep)
        sums = [F.sum(F.expr(f"if(cell = {cell}, n, 0)")).alias(name) for cell, name in ((-1, "only_a"), (-2, "only_b"))]
        if keep:
            sums += [F.expr(f"collect_list(if(cell = {cell}, f, NULL))").alias(name) for cell, name in ((-1, "lost"), (-2, "gained"))]
        # Nothing else is left, and no digest came out twice: otherwise the pair is tried again.
        stuck = F.max(F.expr("cell >= 0 OR n <> 1" if keep else "cell >= 0")).alias("stuck")
        done = stored(cells.groupBy("row", "pair").agg(stuck, *sums))
        found.append(done.where("NOT stuck").drop("stuck"))
        again = done.where("stuck").groupBy("row").agg(F.collect_set("pair").alias("_again"))
        if again.isEmpty():
            break
        left = pairs.join(again, "row").where("array_contains(_again, pair)").drop("_again")
    else:
        exact = left.selectExpr("row", "pair", "array_except(a, b) AS lost", "array_except(b, a) AS gained")
        kept = ["lost", "gained"] if keep else []
        found.append(exact.selectExpr("row", "pair", "bigint(size(lost)) AS only_a", "bigint(size(gained)) AS only_b", *kept))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", extra: str = "_keys", buckets: int | None = None) -> DataFrame:
    """``docs`` with ``_next`` and ``_next_keys``: text and ``extra`` of the next row by falling id, of the first for the last.

    Rows are dealt to ranges of ids and sorted there; only a range's first row
    crosses to its neighbour. Missing ids come last, equal ids by falling text.
    """
    count = buckets or partitions(docs.sparkSession)
    ranks = [i / count for i in range(1, count)]
    found = docs.select(F.percentile_approx(doc_id, ranks, 10_000)).first()[0] if ranks else None
    bounds = sorted(set(found or []))
    # A range's number by two short searches instead of one long.
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[]]
    as_sql = lambda xs: f"cast(array({', '.join(f'{x}L' for x in xs)}) AS array<bigint>)"
    heads, fine = as_sql([g[0] for g in groups[1:]]), f"array({', '.join(map(as_sql, groups))})"
    i = quoted(doc_id)
    coarse = f"size(filter({heads}, x -> x <= {i}))"
    bucket = f"if({i} IS NULL, -1, {coarse} * {step + 1} + size(filter({fine}[{coarse}], x -> x <= {i})))"
    rows = docs.selectExpr("*", f"{bucket} AS _bucket")
    after = f"OVER (PARTITION BY _bucket ORDER BY {i} DESC NULLS LAST, {quoted(text)} DESC)"
    own = rows.selectExpr("*", f"lead({quoted(text)}) {after} AS _lead", f"lead({extra}) {after} AS _lead_keys")
    # One row per range.
    first = rows.groupBy("_bucket").agg(F.max(F.struct(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(extra).alias("x"))).alias("head"))
    order = "OVER (ORDER BY _bucket DESC)"
    wrapped = first.selectExpr("_bucket AS _of", f"coalesce(lead(head) {order}, first(head) {order}) AS _head")
    joined = own.join(wrapped, F.col("_bucket") == F.col("_of"))
    return joined.selectExpr(
        *map(quoted, docs.columns), "coalesce(_lead, _head.t) AS _next", "if(_lead IS NULL, _head.x, _lead_keys) AS _next_keys"
    )


def compare_with_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is replaced by the beginning of the next document,
    and how like it finds itself to the edited text and to the next document."""
    rows = docs.selectExpr(f"{quoted(doc_id)} AS doc_id", f"coalesce({quoted(text)}, '') AS text")
    keyed = rows.selectExpr("*", f"{digests('text')} AS _keys")
    paired = with_next(keyed).selectExpr("doc_id", "text", "_keys AS ka", "_next", "_next_keys AS kn", "bigint(char_length(text)) AS n_chars")
    cut = "int(n_chars div 3)"
    edited = paired.selectExpr("doc_id", "n_chars", "ka", "kn", f"concat(substring(text, 1, int(n_chars) - {cut}), substring(_next, 1, {cut})) AS edited")
    # Written once: the number of a row is the same for all that read it.
    sets = bucketed(edited.selectExpr(
        "monotonically_increasing_id() AS row", "doc_id", "n_chars", "ka", "kn", "unhex(sha2(edited, 256)) AS sha", f"{digests('edited')} AS ke"
    ), "row")
    both = sets.selectExpr("row", "ka", "inline(array(named_struct('pair', 0, 'b', ke), named_struct('pair', 1, 'b', kn)))")
    found = differences(both.selectExpr("row", "pair", "ka AS a", "b"), by_row=True)
    # Pair 0 is the edited text and pair 1 the next one; table 0 is the text's and table 1 the edited text's.
    counts = found.groupBy("row").agg(*[F.max(F.when(F.col("pair") == p, F.col(c))).alias(f"{c}{p}") for p in (0, 1) for c in ("only_a", "only_b")])
    joined = sets.selectExpr("row", "doc_id", "n_chars", "sha", "size(ka) AS n").join(counts, "row", "left")
    for p, keys in enumerate(("ka", "ke")):
        joined = joined.join(written(sets.selectExpr("row", f"{p} AS pair", f"{keys} AS keys")).selectExpr("row", f"print AS print{p}"), "row", "left")

    def likeness(p: int) -> str:
        a, b = f"coalesce(only_a{p}, 0)", f"coalesce(only_b{p}, 0)"
        return f"if(n + {b} = 0, 1D, double(n - {a}) / (n + {b}))"

    return joined.selectExpr(
        "doc_id", "n_chars", "lower(hex(sha)) AS edited_sha256", "coalesce(print0, '') AS fingerprint", "coalesce(print1, '') AS edited_fingerprint",
        f"{likeness(0)} AS near_edited", f"{likeness(1)} AS near_next", "coalesce(only_a0, 0) AS n_lost", "coalesce(only_b0, 0) AS n_gained",
    )
