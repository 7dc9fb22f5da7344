"""Windows of any shape, running totals, bitmaps, schemas found in the data, and indexed samples, against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitchflow.operators.calendar import (
    count_bitmaps, id_bitmaps, in_windows, merge_bitmaps, pull_weeks, season_windows, week_counts, window_counts,
)
from pitchflow.operators.nested import flatten_documents, found_schema
from pitchflow.operators.ordered import running_sums
from pitchflow.sources.tables import INDEX, range_from_totals, running_totals, with_ratios, write_sample

DAY0 = dt.date(1969, 12, 1)  # blocks before and after day 0


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def dated(spark):
    rng = random.Random(1)
    # One day has a third of the rows.
    data = [(i, None if rng.random() < 0.02 else day(40 if rng.random() < 0.33 else rng.randint(0, 120))) for i in range(2000)]
    return data, spark.createDataFrame(data, "i INT, d DATE").repartition(5).cache()


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(2)
    data = []
    for w in range(60):
        a = rng.randint(-30, 130)
        data.append((w, day(a), day(a + rng.choice([0, 0, 1, 6, 15, 16, 17, 90, -1]))))
    data += [(60, None, day(5)), (61, day(5), None), (62, day(-100), day(500)), (63, day(40), day(40)), (64, day(300), day(310))]
    return data, spark.createDataFrame(data, "w INT, a DATE, b DATE")


def test_in_windows(dated, spans):
    (rows, df), (windows, wdf) = dated, spans
    got = in_windows(df, "d", wdf, "a", "b")
    assert got.columns == ["i", "d", "w", "a", "b"]
    expected = [(i, d, *w) for i, d in rows for w in windows if d and w[1] and w[2] and w[1] <= d <= w[2]]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert in_windows(df.limit(0), "d", wdf, "a", "b").count() == 0 == in_windows(df, "d", wdf.limit(0), "a", "b").count()
    with pytest.raises(ValueError):
        in_windows(df.withColumn("W", F.lit(1)), "d", wdf, "a", "b")


def test_in_windows_takes_times(spark):
    times = spark.createDataFrame([(1, dt.datetime(2020, 7, 24, 23, 59)), (2, dt.datetime(2020, 7, 25, 0, 0))], "i INT, t TIMESTAMP")
    windows = spark.createDataFrame([(1, dt.date(2020, 7, 24), dt.date(2020, 7, 24))], "w INT, a DATE, b DATE")
    assert [r.i for r in in_windows(times, "t", windows, "a", "b").collect()] == [1]


def test_window_counts(dated, spans):
    (rows, df), (windows, wdf) = dated, spans
    wdf = wdf.union(wdf.where("w = 63"))  # a window that is listed twice has its rows twice
    failed = [(day(3),), (day(305),), (None,)]
    got = window_counts(df, "d", wdf, df.sparkSession.createDataFrame(failed, "d DATE"), "a", "b")
    inside = lambda days, w: sum(bool(d and w[1] and w[2] and w[1] <= d <= w[2]) for d in days)
    expected = []
    for w in [*windows, windows[63]]:
        n = inside([d for _, d in rows], w)
        expected.append((*w, n, "error" if inside([d for d, in failed], w) else "ok" if n else "empty"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_one_season_is_the_weekly_pull(spark, dated):
    first, last = day(10), day(50)
    windows = season_windows(spark, [(first, last)])
    weekly = pull_weeks(dated[1], "d", first, last).select("i", "week")
    assert sorted(in_windows(dated[1], "d", windows).select("i", "week").collect()) == sorted(weekly.collect())
    counts = window_counts(dated[1], "d", windows).drop("season")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, week_counts(dated[1], "d", first, last).select(*counts.columns).collect()))


def test_season_windows(spark):
    got = season_windows(spark, [(day(0), day(7)), (day(5), day(5)), (day(9), day(8))]).collect()
    assert sorted(map(tuple, got)) == [(1, 1, day(0), day(6)), (1, 2, day(7), day(13)), (2, 1, day(5), day(11))]
    assert season_windows(spark, []).count() == 0


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(4)
    names = ["AB", "H", "2B", "3B", "HR", "BB", "HBP", "SF"]
    data = []
    for _ in range(3000):
        player = 1 if rng.random() < 0.34 else rng.choice([2, 3, 4, 5, None])
        data.append((player, None if rng.random() < 0.01 else day(rng.randint(0, 400)), *[rng.choice([None, 0, 1, 2, 3]) for _ in names]))
    data.append((9, day(3), *[None] * 8))
    return names, spark.createDataFrame(data, "mlb_ID LONG, Date DATE, " + ", ".join(f"`{n}` INT" for n in names)).repartition(4).cache()


@pytest.mark.parametrize("a, b", [(0, 400), (17, 17), (100, 130), (-50, 20), (390, 900), (500, 600), (30, 20)])
def test_ranges_from_running_totals(lines, a, b):
    names, df = lines
    totals = running_totals(df, ["mlb_ID"], "Date", names)
    got = with_ratios(range_from_totals(totals, ["mlb_ID"], "Date", day(a), day(b), names))
    zero = df.fillna(0, names)
    want = with_ratios(
        zero.where(F.col("Date").between(F.lit(day(a)), F.lit(day(b)))).groupBy("mlb_ID").agg(*[F.sum(f"`{n}`").alias(n) for n in names]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.select(*got.columns).collect())))


@pytest.mark.parametrize("segment", ["found", "none", "width"])
def test_running_sums(lines, segment):
    _, df = lines
    df = df.where("Date IS NOT NULL").select("mlb_ID", "Date", F.xxhash64("*").alias("h"), F.col("AB").alias("v"))
    cut = {"found": {}, "none": {"segment": None}, "width": {"segment": F.floor(F.unix_date("Date") / 30)}}[segment]
    got = running_sums(df, ["v"], ["mlb_ID"], ["Date", "h"], **cut)
    seen, expected = Counter(), []
    for r in sorted(df.collect(), key=lambda r: (r.Date, r.h)):
        seen[r.mlb_ID] += r.v or 0
        expected.append((r.mlb_ID, r.Date, r.h, seen[r.mlb_ID]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_bitmaps(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), rng.randint(1, 5), rng.choice([None, 0, -1, -40000, 32767, 32768, 2**40, rng.randint(-10**5, 10**5)])) for _ in range(4000)]
    df = spark.createDataFrame(data, "k STRING, w INT, id LONG")
    weekly = id_bitmaps(df, "id", ["k", "w"])
    got = {(r.k, r.w): r.n_distinct_ids for r in count_bitmaps(weekly, ["k", "w"]).collect()}
    assert got == {g: len({i for k, w, i in data if (k, w) == g and i is not None}) for g in {(k, w) for k, w, _ in data}}
    merged = merge_bitmaps(weekly, ["k"])
    assert {r.k: r.n_distinct_ids for r in count_bitmaps(merged, ["k"]).collect()} == {
        g: len({i for k, _, i in data if k == g and i is not None}) for g in ("a", "b", None)}
    assert "Expand" not in count_bitmaps(merged, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert count_bitmaps(id_bitmaps(df.limit(0), "id", ["k"]), ["k"]).count() == 0


DOCUMENTS = [
    '{"id": 1, "a": {"b": 2, "c d": "x"}, "l": [1, 2]}',
    '{"id": 2.5, "a": {"e": true}, "odd": 1, "VOID": 3}',
    '{"id": 3, "a": null, "odd": {"deep": 1}, "never": null, "l": []}',
    '{"id": 4, "a": {"b"',
    None,
    "{}",
]


def test_documents_come_out_flat(spark):
    df = spark.createDataFrame(list(enumerate(DOCUMENTS)), "n INT, text STRING")
    out = flatten_documents(df, "text", ["n"])
    assert out.columns[:2] == ["n", "status"]
    assert set(out.columns[2:]) == {"id", "a.b", "a.c d", "a.e", "l", "odd", "never", "VOID"}
    got = {r["n"]: r for r in out.withColumn("odd", F.to_json(F.struct("odd"))).collect()}
    assert [got[i]["status"] for i in range(6)] == ["ok", "ok", "ok", "error", "error", "ok"]
    assert (float(got[0]["id"]), got[0]["a.b"], got[0]["a.c d"], got[0]["l"]) == (1.0, 2, "x", [1, 2])
    assert (float(got[1]["id"]), got[1]["a.e"], got[1]["odd"], got[1]["VOID"]) == (2.5, True, '{"odd":1}', 3)
    assert (got[2]["odd"], got[2]["l"], got[2]["never"]) == ('{"odd":{"deep":1}}', [], None)
    assert got[3]["id"] is None and got[3]["a.b"] is None
    # A schema found before spares the look at the data.
    assert flatten_documents(df, "text", ["n"], found_schema(df, "text")).columns == out.columns
    with pytest.raises(ValueError, match="no documents"):
        found_schema(df.where("n = 3"), "text")
    with pytest.raises(ValueError, match="not all"):
        found_schema(spark.createDataFrame([("[1]",)], "text STRING"), "text")
    with pytest.raises(ValueError, match="too"):
        flatten_documents(df.withColumnRenamed("n", "id"), "text", ["id"])


@pytest.mark.parametrize("rows", [None, 7, 5000])
def test_samples_with_index(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("pitchflow.sources.tables.ONE_FILE", 100)
    df = spark.range(0, 3000, 1, 7).selectExpr("id", "id * 7919 % 3001 AS x")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        write_sample(df, str(tmp_path / "out"), ["x"], rows)
    finally:
        spark.conf.unset(setting)
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    read = [line.split(",") for f in files for line in f.read_text().splitlines()[1:]]
    want = sorted((i * 7919 % 3001, i) for i in range(3000))[:rows]
    assert [tuple(map(int, r)) for r in read] == [(n, i, x) for n, (x, i) in enumerate(want)]  # file by file in order
    assert len(files) == 1 if rows == 7 else len(files) > 1
    assert all(f.read_text().splitlines()[0] == f"{INDEX},id,x" for f in files)
