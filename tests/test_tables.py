import datetime as dt

from pyspark.sql import functions as F

from pitchflow import schemas
from pitchflow.functions.batting import batting_ratios
from pitchflow.operators.ordered import running_record, streak
from pitchflow.sources.tables import (
    batting_range, lookup_player, lookup_players, pitcher_range, read_codes, read_csv, read_pitches, team_games,
    with_ratios, write_sample,
)


def test_codes_with_na(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('"details.type.code","details.type.description","cnt"\n"CH","Changeup",3\nNA,NA,2\n')
    assert [tuple(r) for r in read_codes(spark, str(tmp_path)).collect()] == [("CH", "Changeup", 3), (None, None, 2)]


def pitch_line(**values):
    return ",".join(["0", *[str(values.get(n, "")) for n in schemas.PITCH]])


def test_pitch_csv(spark, tmp_path):
    assert len(schemas.PITCH) == 89 and len(schemas.BATTING) == 28 and len(schemas.TEAM_GAMES) == 20
    header = "," + ",".join(schemas.PITCH)
    body = [pitch_line(pitch_type="SL", game_date=f"2019-10-0{d}", pitcher=477132 + d, on_2b="543228.0", zone="6.0",
                       release_speed="89.3", **{"pitcher.1": 5}) for d in (4, 9)]
    (tmp_path / "p.csv").write_text("\n".join([header, *body]))
    df = read_pitches(spark, str(tmp_path), fmt="csv", index=True)
    row = df.orderBy("game_date").first()
    assert (row.on_2b, row.zone, row.release_speed, row["pitcher.1"], row.on_1b) == (543228, 6, 89.3, 5, None)
    assert dict(df.dtypes)["on_2b"] == "bigint" and dict(df.dtypes)["zone"] == "int" and df.columns == list(schemas.PITCH)
    assert read_pitches(spark, str(tmp_path), "2019-10-04", "2019-10-08", "csv", True).count() == 1
    assert pitcher_range(df, "2019-10-01", "2019-10-09", 477141).count() == 1

    df.write.partitionBy("game_date").parquet(str(tmp_path / "parquet"))
    some = read_pitches(spark, str(tmp_path / "parquet"), "2019-10-09", "2019-10-09")
    assert some.count() == 1
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_date" in plan


# AB H 2B 3B HR BB HBP SF and the four published ratios of ten players.
LINES = """
30 9 2 0 3 1 0 0 0.3 0.323 0.667 0.989
6 2 0 0 0 0 0 0 0.333 0.333 0.333 0.667
9 4 0 0 1 0 0 0 0.444 0.444 0.778 1.222
21 5 1 1 0 3 0 0 0.238 0.333 0.381 0.714
2 0 0 0 0 0 0 0 0.0 0.0 0.0 0.0
3 0 0 0 0 0 0 1 0.0 0.0 0.0 0.0
10 4 1 0 2 0 0 0 0.4 0.4 1.1 1.5
16 5 0 0 0 2 0 0 0.313 0.389 0.313 0.701
6 6 1 1 0 0 0 0 1.0 1.0 1.5 2.5
19 0 0 0 0 1 0 0 0.0 0.05 0.0 0.05
"""
COUNTS = ["AB", "H", "2B", "3B", "HR", "BB", "HBP", "SF"]


def test_ratios(spark):
    data = [tuple(float(x) for x in line.split()) for line in LINES.split("\n") if line]
    df = spark.createDataFrame(data, ", ".join(f"`{n}` DOUBLE" for n in [*COUNTS, "ba", "obp", "slg", "ops"])).select(
        *[F.col(f"`{n}`").cast("int").alias(n) for n in COUNTS], *[F.col(n).alias("want_" + n) for n in ("ba", "obp", "slg", "ops")])
    for r in with_ratios(df).collect():
        assert [r[n.upper()] for n in ("ba", "obp", "slg", "ops")] == [r["want_" + n] for n in ("ba", "obp", "slg", "ops")]
    none = spark.range(1).select(*batting_ratios(*[F.lit(0)] * 8).values()).first()
    assert list(none) == [None] * 4


def test_batting_range(spark):
    days = [(dt.date(2017, 5, d), 1 + d % 2, 4, d % 3) for d in range(1, 11)]
    df = spark.createDataFrame(days, "Date DATE, mlb_ID LONG, AB INT, H INT").withColumns({n: F.lit(0) for n in COUNTS[2:]})
    out = {r.mlb_ID: r for r in batting_range(df, "2017-05-01", "2017-05-08", counting=COUNTS).collect()}
    assert out[1].AB == 16 and out[2].AB == 16
    assert out[1].H == sum(d % 3 for d in (2, 4, 6, 8)) and out[1].BA == 0.313  # 5/16, half up


LOG = """,Date,Tm,Home_Away,Opp,W/L,R,RA,Inn,W-L,Rank,GB,Win,Loss,Save,Time,D/N,Attendance,cLI,Streak,Orig. Scheduled
1,2019-06-09,AAA,@,BBB,W,7.0,6.0,10.0,1-0,1.0,Tied,Mary,Pete,None,3:56,D,29028.0,.91,1,
2,2019-06-11,AAA,Home,BBB,W,12.0,5.0,9.0,2-0,1.0,up 1.0,Tina,Walt,None,3:09,D,41538.0,1.15,2,2019-06-10 (Rain)
3,2019-06-11,AAA,Home,BBB,L,4.0,10.0,9.0,2-1,1.0,0.5,Vera,Paul,None,3:20,N,44698.0,1.13,-1,
1,2018-06-11,CCC,Home,BBB,L,4.0,10.0,9.0,0-1,1.0,0.5,Vera,Paul,None,3:20,N,44698.0,1.13,-1,
"""


def test_team_log(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG)
    log = read_csv(spark, str(tmp_path), schemas.TEAM_GAMES, index=True)
    row = log.where("`_c0` = 1 and Tm = 'AAA'").first()
    assert row.Time == "3:56" and row.cLI == 0.91 and row.Save == "None" and row["Orig. Scheduled"] is None
    assert team_games(log, "AAA", season=2019).count() == 3
    assert team_games(log, "CCC", season=2019).count() == 0
    assert team_games(log, "AAA", first="2019-06-10", last="2019-12-01").count() == 2
    # two games share a date: the game number gives the order
    bare = log.withColumnsRenamed({"W-L": "want", "Streak": "want_streak"})
    out = streak(running_record(bare, "W/L", ["Tm"], ["_c0"]), "W/L", ["Tm"], ["_c0"])
    assert all(r["W-L"] == r.want and r.Streak == r.want_streak for r in out.collect())


def test_lookup(spark):
    people = spark.createDataFrame(
        [("Kershaw", "Clayton", 2, 477132), ("kershaw", "CLAYTON", 1, 7), ("Davis", "Khris", 1, 501981)],
        "last STRING, first STRING, rank INT, id LONG")
    assert {r.id for r in lookup_player(people, "kershaw", "clayton").collect()} == {477132, 7}
    wanted = spark.createDataFrame([("KERSHAW", "clayton"), ("Nobody", "X")], "last STRING, first STRING")
    out = {r["last"]: r.id for r in lookup_players(wanted, people, ["last", "first"], ["rank"]).collect()}
    assert out == {"KERSHAW": 7, "Nobody": None}


def test_sample_sink(spark, tmp_path):
    df = spark.range(100).select((100 - F.col("id")).alias("k"), F.lit("x").alias("a.b"))
    write_sample(df, str(tmp_path / "s"), ["k"])
    (part,) = (tmp_path / "s").glob("part-*.csv")
    text = part.read_text().splitlines()
    assert text[0] == "_c0,k,a.b" and text[1] == "0,1,x" and text[-1] == "9,10,x" and len(text) == 11
    back = read_csv(spark, str(tmp_path / "s"), {"k": "INT", "a.b": "STRING"}, index=True)
    assert back.count() == 10
