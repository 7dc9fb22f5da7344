"""Tables in a written layout, counts that are kept up to date, and guards that ride along."""

import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pitchflow.catalog.written import fill_and_flag
from pitchflow.operators.kept import CountLog
from pitchflow.operators.profile import NO_DATA, pitcher_tendencies
from pitchflow.session import work_folder
from pitchflow.sources.tables import write_by_game, write_clustered


def ran(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan()


def test_buckets_by_game_need_no_shuffle(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "id % 37 AS game_pk", "cast(id div 37 AS int) AS event_pos", "cast(id div 37 div 5 AS int) AS atBatIndex",
        "if(id % 7 = 0, concat('r', id), NULL) AS `result.event`", "cast(id % 6 AS int) AS pitchNumber",
    )
    write_by_game(rows, "kept_by_game", work_folder(spark), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.table("kept_by_game")
        out = fill_and_flag(table)
        assert "Exchange" not in ran(out).toString()
        assert sorted(map(str, out.collect())) == sorted(map(str, fill_and_flag(rows).collect()))
        # By game alone: a join by more columns than the buckets go by is dealt out anew.
        joined = table.join(table.groupBy("game_pk").agg(F.max("event_pos").alias("last")), "game_pk")
        assert "Exchange" not in ran(joined).toString() and joined.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_read(df):
    """Rows that leave the scan after row groups were skipped."""
    leaf = ran(df).collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_search_reads_few_rows(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 7, id % 200) AS pitcher", "date_add(DATE '2024-01-01', cast(id % 90 AS int)) AS game_date", "xxhash64(id) % 1000000 * 2 AS batter",
    )
    write_clustered(rows, str(tmp_path / "t"), ["pitcher", "game_date"], ["batter"], 4000, files=16)
    table = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    one = table.where("pitcher = 150")
    assert one.count() == rows.where("pitcher = 150").count() > 0 and rows_read(one) <= 40_000 / 8
    hot = table.where("pitcher = 7 AND game_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
    assert hot.count() == rows.where("pitcher = 7 AND game_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'").count()
    assert rows_read(hot) <= 40_000 / 4
    batter = rows.first().batter
    assert table.where(F.col("batter") == batter).count() == rows.where(F.col("batter") == batter).count()
    # Odd numbers lie between the least and the greatest; the filter tells that there are none.
    assert rows_read(table.where(F.col("batter") == batter + 1)) <= 40_000 / 4


KEYS = {"game": "BIGINT", "kind": "STRING"}
LANDED = [
    [(1, "a"), (1, "a"), (1, "b"), (2, None)],
    [(1, "a"), (3, "c"), (3, "c"), (None, "a")],
    [(2, "b"), (2, "b"), (2, None)],
]


def latest(batches):
    rows = {}
    for batch in batches:
        rows |= {g: [r for r in batch if r[0] == g] for g in {r[0] for r in batch}}
    counts = {}
    for _, kind in itertools.chain.from_iterable(rows.values()):
        counts[kind] = counts.get(kind, 0) + 1
    return counts


def frame(spark, rows):
    return spark.createDataFrame(rows, "game long, kind string")


def held(log):
    return {r.kind: r._rows for r in log.counts().collect()}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_counts_follow_the_latest_landing(spark, tmp_path, order):
    log = CountLog(spark, str(tmp_path / "log"), KEYS, "game")
    assert held(log) == {}
    batches = [LANDED[i] for i in order]
    for number, batch in enumerate(batches):
        log.apply(frame(spark, batch), frame(spark, batch), number)
        assert held(log) == latest(batches[: number + 1])
    log.apply(frame(spark, batches[-1]), frame(spark, batches[-1]), 2)
    assert held(log) == latest(batches)


def test_groups_that_lose_all_rows_and_compaction(spark, tmp_path):
    log = CountLog(spark, str(tmp_path / "log"), KEYS, "game")
    log.apply(frame(spark, LANDED[0]), frame(spark, LANDED[0]), 0)
    log.apply(frame(spark, []), frame(spark, [(1, None)]), 1)
    assert held(log) == {None: 1}
    small = log.compacted(str(tmp_path / "small"), 1)
    assert held(small) == {None: 1} and small.differences().count() == 1
    small.apply(frame(spark, LANDED[2]), frame(spark, LANDED[2]), 2)
    assert held(small) == {"b": 2, None: 1}


def test_a_guard_without_a_job(spark):
    from pitchflow.catalog.derived import plays

    events = spark.range(0, 2400).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", "id % 9 AS user_id", "'click' AS event_type", "double(id % 100 + 100) AS value",
        "to_json(named_struct('k', id % 100)) AS props",
    )
    pbp, group = plays(events), "guarded"
    spark.sparkContext.setJobGroup(group, "")
    try:
        some = pitcher_tendencies(pbp, 505, add_count=True, check="action")
        missing = pitcher_tendencies(pbp, 4711, check="action")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert some.collect() == pitcher_tendencies(pbp, 505, add_count=True, check=True).collect() != []
    # A player whose pitches are all below the confidence has data.
    assert pitcher_tendencies(pbp.withColumn("pitchData.typeConfidence", F.lit(0.1)), 505, check="action").collect() == []
    for none in (missing, pitcher_tendencies(pbp.limit(0), 505, check="action")):
        with pytest.raises(PySparkException, match=NO_DATA[:30]):
            none.collect()
