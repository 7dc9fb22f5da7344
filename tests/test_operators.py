"""One test per rule that is easy to get wrong, on hand-written frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitchflow.functions.pitches import choose_side, null_flag, pre_pitch_count
from pitchflow.functions.text import date_prefix, paste
from pitchflow.operators.calendar import (
    distinct_days, game_ids_for_days, grid_end, pull_weeks, season_bounds, season_summary, week_counts, week_grid,
)
from pitchflow.operators.nested import class_table, drop_list_columns, explode_path, flatten_struct, game_meta
from pitchflow.operators.ordered import FOUND, attach_forward, fill_up, last_of_group_flag, row_index, running_record, streak, with_found_segment
from pitchflow.operators.relational import (
    code_frequencies, col_range, cols_first, exclude_ids, first_match, left_join_suffixed, union_fill,
)
from pitchflow.schemas import FEED, c


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- functions ---------------------------------------------------------------


def test_paste_writes_missing_as_na(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "a INT, b INT")
    assert rows(df.select(paste(F.col("a"), F.col("b")))) == [("1-2",), ("NA-2",)]


def test_pre_pitch_count(spark):
    cases = [
        (True, False, False, 1, 2, "1-1"),
        (True, None, None, 0, 2, "0-1"),  # two-strike foul: the count stayed at 2
        (False, True, False, 3, 1, "2-1"),
        (False, False, True, 3, 2, "3-2"),
        (False, False, False, 1, 1, "Pitch Not a Ball or Strike. Original Count: 1-1"),
        (None, True, False, 1, 1, None),
        (False, None, True, 1, 1, None),
        (False, False, None, 1, 1, None),
        (True, False, False, None, 1, "NA-0"),
        (True, False, False, 1, None, "1-NA"),
        (True, True, True, 2, 2, "2-1"),  # the first true flag decides
    ]
    df = spark.createDataFrame(cases, "s BOOLEAN, b BOOLEAN, p BOOLEAN, balls INT, strikes INT, want STRING")
    got = df.select(pre_pitch_count(*[F.col(n) for n in ("s", "b", "p", "balls", "strikes")]).alias("got"), "want")
    assert all(r.got == r.want for r in got.collect())


def test_side_of_unknown_half_is_null(spark):
    df = spark.createDataFrame([("bottom",), ("top",), (None,)], "h STRING")
    assert [r[0] for r in df.select(choose_side(F.col("h"), F.lit("H"), F.lit("A"))).collect()] == ["H", "A", None]


def test_small_expressions(spark):
    df = spark.createDataFrame([("2020-07-24T23:05:00Z",), (None,)], "t STRING")
    assert rows(df.select(date_prefix(F.col("t")), null_flag(F.col("t")))) == [("2020-07-24", 0), (None, 1)]


# --- nested ------------------------------------------------------------------


def test_flatten_and_explode(spark):
    df = spark.createDataFrame(
        [("d", [{"x": {"y": 1}, "sub": [{"v": 1}, {"v": 2}]}, {"x": {"y": 2}, "sub": []}, {"x": None, "sub": None}])],
        "id STRING, items ARRAY<STRUCT<x: STRUCT<y: INT>, sub: ARRAY<STRUCT<v: INT>>>>",
    )
    one = explode_path(df, ["items"], keep=["id"], positions=True)
    assert one.columns == ["id", "pos_0", "x.y", "sub"] and one.count() == 3
    two = explode_path(df, ["items", "sub"], keep=["id"], parents={"y": "0.x.y"})
    assert rows(two) == [("d", 1, 1), ("d", 1, 2)]
    assert flatten_struct(df).columns == ["id", "items"]
    assert explode_path(df, ["items"], flatten=False).columns == ["element"]


def test_list_columns(spark):
    df = spark.createDataFrame([], "a INT, b ARRAY<INT>, m MAP<STRING, INT>, s STRUCT<z: INT>, `d.e` STRING")
    assert drop_list_columns(df).columns == ["a", "s", "d.e"]
    classes = {r.variable: r.value for r in class_table(df).collect()}
    assert classes == {"a": "int", "b": "list", "m": "list", "s": "struct<z:int>", "d.e": "string"}


def test_game_meta(spark):
    df = spark.createDataFrame([], FEED)
    meta = game_meta(current=True)
    assert df.select(*[v.alias(k) for k, v in meta.items()]).columns == list(meta)
    assert "current_play" not in game_meta()


# --- relational --------------------------------------------------------------


def join_inputs(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, None, 2), (1, "z", 3), (2, "a", 4), (2, "b", 5)], "g INT, e STRING, n INT")
    right = spark.createDataFrame(
        [(1, "a", 10, "x"), (1, None, 11, "y"), (2, "b", 12, "p"), (2, "b", 13, "q")], "g INT, pe STRING, n INT, t STRING"
    )
    return left, right


@pytest.mark.parametrize("hot", [None, 1, 100])
def test_left_join(spark, hot):
    left, right = join_inputs(spark)
    out = left_join_suffixed(left, right, [("e", "pe")], scope=["g"], hot_right_rows=hot)
    assert out.columns == ["g", "e", "n.x", "n.y", "t"]
    assert rows(out) == rows(spark.createDataFrame(
        [(1, "a", 1, 10, "x"), (1, None, 2, 11, "y"), (1, "z", 3, None, None), (2, "a", 4, None, None),
         (2, "b", 5, 12, "p"), (2, "b", 5, 13, "q")], out.schema))


@pytest.mark.parametrize("hot", [None, 2])
def test_join_of_a_table_with_itself(spark, hot):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, None), (6, None)], "n INT, k STRING")
    out = left_join_suffixed(df, df.where("n <> 4").withColumnRenamed("k", "rk"), [("k", "rk")], hot_right_rows=hot)
    want = [(a, x, b) for a, x in df.collect() for b, y in df.collect() if x == y and b != 4] + [(4, "b", None)]
    assert rows(out) == sorted(want, key=repr)


def test_join_same_key_name(spark):
    left = spark.createDataFrame([(1, 5), (2, 6)], "k INT, v INT")
    right = spark.createDataFrame([(1, 7)], "k INT, v INT")
    out = left_join_suffixed(left, right, [("k", "k")])
    assert out.columns == ["k", "v.x", "v.y"] and rows(out) == [(1, 5, 7), (2, 6, None)]


def test_right_column_named_like_left_key(spark):
    left = spark.createDataFrame([("a", 1)], "e STRING, n INT")
    right = spark.createDataFrame([("a", "other")], "pe STRING, e STRING")
    out = left_join_suffixed(left, right, [("e", "pe")])
    assert rows(out) == [("a", 1, "other")]
    assert len(set(out.columns)) == 3


def test_union(spark):
    a = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    b = spark.createDataFrame([("y", 2.0)], "b STRING, c DOUBLE")
    out = union_fill(a, b)
    assert out.columns == ["a", "b", "c"] and rows(out) == [(1, "x", None), (None, "y", 2.0)]
    assert rows(union_fill(a, a, strict=True)) == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError):
        union_fill(a, b, strict=True)
    with pytest.raises(TypeError):
        union_fill(a, spark.createDataFrame([("1",)], "a STRING"))


def test_selections(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`a.x` INT, b INT, d INT, e INT")
    assert cols_first(df, "d", "b").columns == ["d", "b", "a.x", "e"]
    assert col_range(df, "b", "e") == ["b", "d", "e"]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    some = ids.union(spark.createDataFrame([(None,)], "id INT"))
    for listed in ([1, 3], [1, 3, None], [1, *range(3, 400)], ids.where("id <> 2")):
        assert rows(exclude_ids(some, "id", listed)) == [(2,), (None,)]


def test_code_frequencies_missing_last(spark):
    df = spark.createDataFrame([("b", "B"), ("a", "A"), (None, None), ("b", "B")], "code STRING, text STRING")
    assert [tuple(r) for r in code_frequencies(df, "code", "text").collect()] == [("a", "A", 1), ("b", "B", 2), (None, None, 1)]


def test_first_match(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, None), ("b", 2, "z")], "k STRING, o INT, v STRING")
    assert rows(first_match(df, ["k"], ["o"])) == [("a", 1, None), ("b", 2, "z")]
    more = df.union(spark.createDataFrame([("a", 1, "b"), ("c", None, "n"), ("c", 0, "m"), (None, 1, "u")], df.schema))
    assert rows(first_match(more, ["k"], ["o", "v"])) == [("a", 1, None), ("b", 2, "z"), ("c", None, "n"), (None, 1, "u")]


# --- ordered -----------------------------------------------------------------


def test_fill_up(spark):
    data = [("g", i, v, w) for i, (v, w) in enumerate([(None, None), (1, None), (None, "b"), (2, None), (None, None)])]
    df = spark.createDataFrame([*data, ("h", 9, None, "k")], "g STRING, i INT, `v.a` INT, w STRING")
    assert rows(fill_up(df, ["v.a", "w"], ["g"], ["i"])) == [
        ("g", 0, 1, "b"), ("g", 1, 1, "b"), ("g", 2, 2, "b"), ("g", 3, 2, None), ("g", 4, None, None), ("h", 9, None, "k"),
    ]


def test_last_flag(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None)], "g STRING, n INT")
    assert rows(last_of_group_flag(df, "n", ["g"], "f")) == [
        ("a", 1, "false"), ("a", 2, "true"), ("b", 1, None), ("b", None, None)]
    assert rows(last_of_group_flag(df, "n", ["g"], "f", nulls="ignore")) == [
        ("a", 1, "false"), ("a", 2, "true"), ("b", 1, "true"), ("b", None, None)]
    with pytest.raises(ValueError):
        last_of_group_flag(df, "n", ["g"], "f", nulls="other")


# Ten games of one team, in order, with record and streak.
GAMES = [
    ("W", "1-0", "1"), ("L", "1-1", "-1"), ("L", "1-2", "-2"), ("W", "2-2", "1"),
    ("L", "2-3", "-1"), ("L", "2-4", "-2"), ("W", "3-4", "1"), ("W", "4-4", "2"),
    ("W", "5-4", "3"), ("L", "5-5", "-1"),
]


def test_record_and_streak(spark):
    data = [(i, "NYY", *g) for i, g in enumerate(GAMES)]
    df = spark.createDataFrame(data, "i INT, Tm STRING, `W/L` STRING, rec STRING, st STRING")
    out = streak(running_record(df, "W/L", ["Tm"], ["i"]), "W/L", ["Tm"], ["i"])
    assert all(r["W-L"] == r.rec and r.Streak == int(r.st) for r in out.collect())


@pytest.fixture(scope="module")
def uneven(spark):
    """One key with a third of the rows, a missing key, and long runs of missing values."""
    rng = random.Random(7)
    data, value = [], "W"
    for i in range(3000):
        k = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None, None])
        if rng.random() < 0.1:
            value = "L" if value == "W" else "W"
        data.append((i, k, i % 7, rng.randint(0, 9) if rng.random() < 0.03 else None, value, rng.randint(0, 500) if i else None))
    return spark.createDataFrame(data, "i INT, k STRING, day INT, v INT, r STRING, n INT").repartition(6).cache()




@pytest.mark.parametrize("width", [4, 16, 1000, None])
def test_pieces_equal_whole_groups(uneven, width):
    cut = {"segment": F.floor(F.col("i") / width)} if width else {}
    by_day = {"segment": F.col("day")} if width else {}
    plain = {"segment": None}
    assert rows(fill_up(uneven, ["v", "n"], ["k"], ["i"], **plain)) == rows(fill_up(uneven, ["v", "n"], ["k"], ["i"], **cut))
    assert rows(fill_up(uneven, ["v"], ["k"], ["day", "i"], **plain)) == rows(fill_up(uneven, ["v"], ["k"], ["day", "i"], **by_day))
    assert rows(running_record(uneven, "r", ["k"], ["i"], **plain)) == rows(running_record(uneven, "r", ["k"], ["i"], **cut))
    assert rows(streak(uneven, "r", ["k"], ["i"], **plain)) == rows(streak(uneven, "r", ["k"], ["i"], **cut))
    assert rows(row_index(uneven, ["i"], keys=["k"], **plain)) == rows(row_index(uneven, ["i"], keys=["k"], **cut))
    for nulls in ("propagate", "ignore"):
        assert rows(last_of_group_flag(uneven, "n", ["k"], "f", nulls, **plain)) == rows(
            last_of_group_flag(uneven, "n", ["k"], "f", nulls, **cut))


def test_found_segments_cut_the_large_groups(uneven):
    cut = with_found_segment(uneven, ["k"], F.struct("day", "i"), "s", pieces=30)
    assert cut.columns == [*uneven.columns, "s"]
    sizes = {k: sorted(r["count"] for r in cut.where(F.col("k").eqNullSafe(k)).groupBy("s").count().collect()) for k in ("hot", "a")}
    assert 7 <= len(sizes["hot"]) <= 12 and sizes["hot"][-1] < 3 * sizes["hot"][0] + 60
    # Along the order the segment never falls.
    for k in ("hot", "a", None):
        got = [r.s for r in cut.where(F.col("k").eqNullSafe(k)).orderBy("day", "i").collect()]
        assert got == sorted(got) and got[0] == 0
    # Rows at one place stay together, and a table smaller than the sample is cut less.
    same = with_found_segment(uneven.withColumn("i", F.lit(1)), ["k"], F.struct("i"), "s", pieces=30)
    assert same.where("s > 1").isEmpty()
    assert with_found_segment(uneven.limit(100), ["k"], F.struct("i"), "s", pieces=30).agg(F.max("s")).first()[0] < 3


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_row_index(uneven, keys):
    order = ["n", "i"]
    got = row_index(uneven, order, "no", keys, start=5)
    assert got.columns == ["no", *uneven.columns]
    seen = {}
    expected = []
    for r in sorted(uneven.collect(), key=lambda r: (r.n is not None, r.n, r.i)):
        group = r.k if keys else None
        seen[group] = seen.get(group, 4) + 1
        expected.append((seen[group], *r))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert row_index(uneven.limit(0), order).count() == 0


def test_no_task_sees_the_whole_table(spark, uneven):
    """Numbering the whole table deals it by pieces, and the tasks that number it share it."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = row_index(uneven.select("i", "k"), ["i"])
    shares = df.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    alone = [below for line, below in zip(plan, plan[1:]) if "Exchange SinglePartition" in line]
    assert all("partial_count(1)" in below for below in alone)  # a count's row per task
    assert len(shares) >= 3 and max(r["count"] for r in shares) < 2000


@pytest.mark.parametrize("name", ["fill_up", "flag", "record", "streak", "index", "index of all", "forward"])
def test_rows_are_shuffled_once(spark, name):
    """The rows and their summary read one shuffle of the table, also with found pieces."""
    uneven = spark.range(0, 3000, 1, 3).selectExpr("int(id) AS i", "if(id % 3 = 0, 'hot', string(id % 7)) AS k", "if(id % 9 = 0, id, NULL) AS v", "id AS n", "if(id % 5 = 0, 'W', 'L') AS r")
    if name == "forward":
        df = attach_forward(uneven, uneven.select("k", F.col("i").alias("u")), ["k"], ("i", "u"), ["u"])
    elif name.startswith("index"):
        df = row_index(uneven, ["i"], keys=[] if "all" in name else ["k"])
    else:
        df = OPERATORS[name](uneven, FOUND)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    dealt = [line for line in final.split("\n") if "REPARTITION_BY_COL" in line]
    assert sum("ReusedExchange" not in line for line in dealt) == 1 and any("ReusedExchange" in line for line in dealt)
    assert "BroadcastNestedLoopJoin" not in final


def brute_forward(left, right, strict):
    out = []
    for i, k, t in left:
        after = sorted((u, m) for k2, u, m in right if k2 == k and u is not None and t is not None and (u > t or u == t and not strict))
        out.append((i, k, t, *(after[0] if after else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("how", ["found", "none", "time"])
def test_attach_forward(spark, strict, how):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot"] * 5 + ["a", "b", None])
    place = lambda n: None if rng.random() < 0.05 else rng.randint(0, n)
    left = [(i, key(), place(500)) for i in range(1500)] + [(9999, "hot", 1000), (9998, "only left", 1)]
    right = [(key(), place(450), i) for i in range(300)] + [("only right", 4, 1)]
    a, b = spark.createDataFrame(left, "id INT, k STRING, t INT"), spark.createDataFrame(right, "k STRING, u INT, m INT")
    segment = {"found": {}, "none": {"segment": None}, "time": {"segment": F.floor(F.coalesce("_time", F.lit(-1)) / 40)}}[how]
    got = attach_forward(a, b, ["k"], ("t", "u"), ["u", "m"], strict, **segment)
    assert got.columns == ["id", "k", "t", "u", "m"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_forward(left, right, strict)
    assert "Join" not in attach_forward(a, b, ["k"], ("t", "u"), ["u", "m"], strict, segment=None)._jdf.queryExecution().optimizedPlan().toString()
    assert attach_forward(a, b.limit(0), ["k"], ("t", "u"), ["u", "m"]).where("u IS NULL AND m IS NULL").count() == len(left)
    assert attach_forward(a.limit(0), b, ["k"], ("t", "u"), ["u", "m"]).count() == 0
    with pytest.raises(ValueError):
        attach_forward(a, b, ["k"], ("t", "u"), ["k"])


def test_streak_over_missing_results(spark):
    data = [(i, "g", r) for i, r in enumerate(["W", "W", None, None, "L", "W", "W", "W", None, "W"] * 6)]
    df = spark.createDataFrame(data, "i INT, k STRING, r STRING")
    for width in (1, 2, 3, 7):
        cut = {"segment": F.floor(F.col("i") / width)}
        assert rows(streak(df, "r", ["k"], ["i"], segment=None)) == rows(streak(df, "r", ["k"], ["i"], **cut))


OPERATORS = {
    "fill_up": lambda df, cut: fill_up(df, ["v"], ["k"], ["i"], segment=cut),
    "flag": lambda df, cut: last_of_group_flag(df, "n", ["k"], "f", segment=cut),
    "record": lambda df, cut: running_record(df, "r", ["k"], ["i"], segment=cut),
    "streak": lambda df, cut: streak(df, "r", ["k"], ["i"], segment=cut),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_bad_segments_are_errors(uneven, name, width):
    missing = F.when(F.col("i") % 11 != 0, F.floor(F.col("i") / width))
    with pytest.raises(Exception, match="segment is missing"):
        OPERATORS[name](uneven, missing).collect()
    if name != "flag":  # needs no order
        with pytest.raises(Exception, match="segment decreases"):
            OPERATORS[name](uneven, F.floor(-F.col("i") / min(width, 50))).collect()


@pytest.mark.parametrize("name", OPERATORS)
def test_the_table_is_read_once(spark, uneven, name, tmp_path):
    path = str(tmp_path / "rows")
    uneven.write.parquet(path)
    execution = OPERATORS[name](spark.read.parquet(path), F.floor(F.col("i") / 64))._jdf.queryExecution()
    assert execution.toRdd().count() == 3000
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


# --- calendar ----------------------------------------------------------------


@pytest.mark.parametrize("season, start, end, weeks, last", [
    (2020, "-07-24", "-09-27", 10, "2020-10-01"), (2019, "-03-20", "-09-29", 28, "2019-10-01")])
def test_week_grid(spark, season, start, end, weeks, last):
    first, end = season_bounds(season, start, end)
    grid = week_grid(spark, first, end).orderBy("week").collect()
    assert len(grid) == weeks and grid[0].week == 1 and grid[0].start_date == first
    assert str(grid[-1].end_date) == last == str(grid_end(first, end))
    assert all((b.start_date - a.end_date).days == 1 for a, b in zip(grid, grid[1:]))


def test_pull_weeks_equals_range_join(spark):
    first, last = dt.date(2020, 7, 24), dt.date(2020, 8, 20)
    days = [dt.date(2020, 7, 20) + dt.timedelta(days=2 * i) for i in range(25)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "game_date DATE")
    grid = week_grid(spark, first, last)
    want = df.join(grid, df.game_date.between(grid.start_date, grid.end_date)).select(
        "game_date", "week", "start_date", "end_date")
    assert rows(pull_weeks(df, "game_date", first, last)) == rows(want)
    counts = week_counts(df.where("game_date < '2020-08-01'"), "game_date", first, last)
    assert {r.week: (r.number_rows, r.status) for r in counts.collect()} == {
        1: (4, "ok"), 2: (0, "empty"), 3: (0, "empty"), 4: (0, "empty")}
    failed = spark.createDataFrame([(dt.date(2020, 7, 24),), (dt.date(2020, 8, 9),)], "game_date DATE")
    states = week_counts(df.where("game_date < '2020-08-01'"), "game_date", first, last, failed).orderBy("week").collect()
    assert [r.status for r in states] == ["error", "empty", "error", "empty"]


def test_days_ids_summary(spark):
    d1, d2 = dt.date(2020, 7, 24), dt.date(2020, 7, 25)
    pitches = spark.createDataFrame([(d1,), (d1,), (d2,), (None,)], "game_date DATE")
    schedule = spark.createDataFrame([("2020-07-24", 1), ("2020-07-25", 1), ("2020-07-25", 2), ("2020-07-26", 3)], "date STRING, gamePk LONG")
    ids = game_ids_for_days(distinct_days(pitches), schedule, dedupe=False)
    assert rows(ids) == [(1, d1), (1, d2), (2, d2)]
    assert rows(game_ids_for_days(distinct_days(pitches), schedule)) == [(1, d1), (2, d2)]
    assert rows(season_summary(pitches, ids)) == [(2, 3, 2)]


def test_dotted_names(spark):
    df = spark.createDataFrame([(1,)], "`a.b` INT")
    assert df.select(c("a.b")).columns == ["a.b"]
