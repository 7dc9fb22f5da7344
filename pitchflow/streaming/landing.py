"""Play-by-play from a growing landing folder.

A document holds a whole game, so no state and no watermark is needed: each
micro-batch is normalised by the same plan as a batch load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchflow.operators.kept import CountLog
from pitchflow.operators.profile import countable_pitches
from pitchflow.plans.games import normalise_game
from pitchflow.sources.feeds import broken_documents, good_documents, parse_feed
from pitchflow.sources.tables import read_pbp, write_pbp


def follow_feeds(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    errors: str,
    attach: str = "reference",
    files_per_batch: int = 1000,
    counts: dict[str, CountLog] = {},
) -> StreamingQuery:
    """Process the documents landed so far, then stop; run again for what comes later.

    ``checkpoint``, ``table`` and ``errors`` must lie in storage all executors
    share. Every batch has its own folder under ``table`` and replaces it when it
    is run again after a failure, so no game is written twice. Broken documents
    go to the same folder under ``errors``, with their text: good and broken
    documents together are the landed ones. ``counts`` holds a log of pitch counts
    for ``pitcher``, ``batter`` or both, which each batch keeps up to date; a game
    that lands again takes its earlier counts back.
    """

    def load(batch: DataFrame, number: int) -> None:
        parsed = parse_feed(batch)
        broken_documents(parsed).write.mode("overwrite").parquet(f"{errors}/batch={number}")
        write_pbp(normalise_game(good_documents(parsed), attach), f"{table}/batch={number}")
        if counts:
            written = read_pbp(spark, f"{table}/batch={number}")
            landed = good_documents(parsed).select("game_pk")
            for entity, log in counts.items():
                log.apply(countable_pitches(written, entity), landed, number)

    texts = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(landing)
    return (
        texts.where(F.length("value") > 0)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
