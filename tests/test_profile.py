import json
import random
from collections import Counter

import pytest
from games import CODES
from pyspark.sql import functions as F

from pitchflow.functions.pitches import BUCKETS, SHARE_NAMES, SINGLE_TYPES, bucket_flags
from pitchflow.operators.profile import (
    BAD_CONFIDENCE, NO_DATA, NoDataError, batter_tendencies, pitcher_tendencies, share_profile, tendencies,
    tendencies_all_levels,
)
from pitchflow.operators.relational import code_frequencies
from pitchflow.schemas import PBP, ddl

NAMES = [
    "type", "details.isStrike", "details.isBall", "details.isInPlay", "count.balls.start", "count.strikes.start",
    "count.outs.start", "details.type.code", "pitchData.typeConfidence", "matchup.pitcher.id", "matchup.pitcher.fullName",
    "matchup.batter.id", "matchup.batter.fullName",
]


@pytest.fixture(scope="module")
def plays():
    rng = random.Random(11)
    out = []
    for _ in range(2500):
        kind = rng.randint(0, 3)
        p, b = rng.choice([1, 1, 1, 2, 3]), rng.randint(1, 6)
        out.append((
            rng.choice(["pitch", "pitch", "pitch", "action"]), kind == 0, kind == 1, kind == 2,
            rng.randint(0, 3), rng.randint(0, 2), rng.randint(0, 2),
            rng.choice([*CODES, "FT", "EP", "FO", "KN", "KC", "SC", "CS", "FS"]),
            rng.choice([None, 0.2, 0.5, 0.7, 0.9]), p, f"P{p}", b, None if b == 4 and rng.random() < 0.1 else f"B{b}",
        ))
    return out


@pytest.fixture(scope="module")
def pbp(spark, plays):
    return spark.createDataFrame(plays, ddl({n: PBP[n] for n in NAMES})).cache()


def brute(plays, who, with_count, with_outs, confidence=0.5):
    groups = {}
    for row in plays:
        r = dict(zip(NAMES, row))
        if r["type"] != "pitch" or r["details.type.code"] is None or (r["pitchData.typeConfidence"] or 0) < confidence:
            continue
        b, s = r["count.balls.start"], r["count.strikes.start"]
        if r["details.isStrike"]:
            label = f"{b}-{s - 1}"
        elif r["details.isBall"]:
            label = f"{b - 1}-{s}"
        elif r["details.isInPlay"]:
            label = f"{b}-{s}"
        else:
            label = f"Pitch Not a Ball or Strike. Original Count: {b}-{s}"
        key = (r[f"matchup.{who}.id"], *([label] if with_count else []), *([r["count.outs.start"]] if with_outs else []))
        groups.setdefault(key, []).append((r["details.type.code"], r[f"matchup.{who}.fullName"]))
    out = {}
    for key, seen in groups.items():
        n, codes, names = len(seen), Counter(x for x, _ in seen), [x for _, x in seen]
        shares = {name: sum(codes[x] for x in group) / n for name, group in BUCKETS.items()}
        shares |= {name: codes[x] / n for name, x in SINGLE_TYPES.items()}
        out[key] = (None if None in names else max(names), n, *[shares[x] for x in SHARE_NAMES])
    return out


@pytest.mark.parametrize("who", ["pitcher", "batter"])
@pytest.mark.parametrize("count", [False, True])
@pytest.mark.parametrize("outs", [False, True])
def test_against_brute_force(pbp, plays, who, count, outs):
    got = tendencies(pbp, who, add_count=count, add_outs=outs)
    width = 1 + count + outs
    assert got.columns == [who, *(["Count"] if count else []), *(["outs"] if outs else []), "player", "pitches", *SHARE_NAMES]
    collected = [tuple(r) for r in got.collect()]
    assert {r[:width]: r[width:] for r in collected} == brute(plays, who, count, outs)
    assert collected == sorted(collected, key=lambda r: (-r[width + 1], r[:width]))


def test_all_levels_is_the_four_key_sets(pbp, plays):
    got = tendencies_all_levels(pbp, "pitcher").collect()
    for level, count, outs in [("pitcher", 0, 0), ("pitcher,Count", 1, 0), ("pitcher,outs", 0, 1), ("pitcher,Count,outs", 1, 1)]:
        names = level.split(",")
        part = {tuple(r[n] for n in names): (r.player, r.pitches, *[r[s] for s in SHARE_NAMES]) for r in got if r.level == level}
        assert part == brute(plays, "pitcher", count, outs)


def test_share_properties(pbp):
    total = set()
    for count in (False, True):
        for outs in (False, True):
            out = pitcher_tendencies(pbp, add_count=count, add_outs=outs).collect()
            total.add(sum(r.pitches for r in out))
            for r in out:
                assert all(0 <= r[n] <= 1 for n in SHARE_NAMES)
                assert r.fastballs == pytest.approx(sum(r[n] for n in ("sink", "ts_fb", "fs_fb", "cutter", "fork")))
    assert len(total) == 1


def test_one_player_and_guards(pbp):
    assert [r.pitcher for r in pitcher_tendencies(pbp, 2).collect()] == [2]
    assert {r.batter for r in batter_tendencies(pbp, 3, 0.005, add_count=True, add_outs=True).collect()} == {3}
    for bad in (0, 1, 1.5, -1):
        with pytest.raises(ValueError, match=BAD_CONFIDENCE):
            pitcher_tendencies(pbp, confidence=bad)
    with pytest.raises(NoDataError, match=NO_DATA):  # the player is looked for before the confidence
        pitcher_tendencies(pbp, 99, confidence=7, check=True)
    assert pitcher_tendencies(pbp, 99).count() == 0
    assert tendencies(pbp.limit(0), "batter", add_count=True).count() == 0
    with pytest.raises(ValueError):
        tendencies(pbp, "catcher")


def test_missing_name(pbp):
    strict = {r.batter: r.player for r in tendencies(pbp, "batter").collect()}
    loose = {r.batter: r.player for r in tendencies(pbp, "batter", label_nulls="skip").collect()}
    assert strict[4] is None and loose[4] == "B4" and strict[1] == loose[1] == "B1"


def test_ten_pitches(spark):
    df = spark.createDataFrame([(477132, x) for x in "SL FF CU SL SL FF SL SL FF SL".split()], "pitcher LONG, pitch_type STRING")
    r = share_profile(df, ["pitcher"], bucket_flags("pitch_type"), count_name="pitches").first()
    assert (r.pitches, r.slider, r.fs_fb, r.curveball, r.fastballs, r.breaking_ball) == (10, 0.6, 0.3, 0.1, 0.3, 0.7)


# One season's pitches by type and by call.
BY_TYPE = "CH 33689 CS 207 CU 26878 FC 18689 FF 98300 FO 3 FS 4878 KC 6506 KN 23 SI 46184 SL 51140 NA 730"
BY_CALL = ("*B 7487 B 97884 C 48139 D 10503 E 6549 F 48658 H 899 L 459 M 67 O 5 P 16 S 30407 T 2696 V 722 W 2132 X 30604")


@pytest.mark.parametrize("table", [BY_TYPE, BY_CALL])
def test_season_frequencies(spark, table):
    words = table.split()
    pairs = [(None if k == "NA" else k, int(n)) for k, n in zip(words[::2], words[1::2])]
    many = spark.createDataFrame(pairs, "code STRING, n INT").select("code", F.explode(F.sequence(F.lit(1), "n")))
    out = [tuple(r) for r in code_frequencies(many, "code").collect()]
    assert out == pairs and sum(n for _, n in out) == 287227


def test_plan(spark, tmp_path, pbp):
    pbp.write.parquet(str(tmp_path / "pbp"))
    stored = spark.read.parquet(str(tmp_path / "pbp"))
    plan = tendencies(stored, "pitcher", 2, 0.6, add_count=True)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(`matchup.pitcher.id`,2)" in pushed and "GreaterThanOrEqual(`pitchData.typeConfidence`,0.6)" in pushed
    assert "matchup.batter" not in plan
    # The rows are counted in hash tables; only the counts are shuffled again for the label.
    steps = [line.strip(" +-:") for line in plan.splitlines() if "Aggregate" in line]
    assert [x.split("(")[0] for x in steps] == ["SortAggregate", "SortAggregate", "HashAggregate", "HashAggregate"]
    assert plan.count("Exchange hashpartitioning") == 2 and "Python" not in plan
    assert json.dumps(SHARE_NAMES).count(",") == 16
