"""Structured Streaming over files that arrive in a folder."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arriving(spark: SparkSession, sample: str, folder: str, pattern: str, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is that of a sample, since streams infer none. The number of
    files a trigger takes is the intake's back-pressure."""
    return spark.readStream.schema(spark.read.parquet(sample).schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], value: str, length: str, late: str) -> DataFrame:
    """Counts and sums per key and time window; rows later than `late` behind the newest no longer count, and windows that old leave the state.

    To be written in update or append mode: complete mode would keep every window for good.
    """
    return (
        stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
        .groupBy(F.window("_ts", length).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n", "total")
    )


def _streak(key_column: str, ts: str, row_id: str, value: str):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values([ts, row_id])
        last, streak, seen, newest = state.get if state.exists else (None, -1, 0, None)
        started = seen > 0
        for v, t in zip(rows[value], rows[ts].astype("datetime64[us]").astype("int64")):
            seen += 1
            if newest is not None and t < newest:
                continue
            streak = streak + 1 if started and v == last else 0
            last, newest, started = v, int(t), True
        state.update((last, streak, seen, newest))
        yield pd.DataFrame({key_column: [key[0]], "last_value": [last], "streak": [streak], "n_seen": [seen]})

    return run


def unchanged_streaks(stream: DataFrame, key: str, ts: str, row_id: str, value: str) -> DataFrame:
    """The current streak of equal values per key, kept as state between triggers. One row per key and trigger.

    Rows of a trigger are taken in order of time. A row older than the newest of an earlier trigger comes too late to
    change the streak; it only counts as seen.
    """
    kind = stream.schema[key].dataType.simpleString()
    return stream.select(key, ts, row_id, value).groupBy(key).applyInPandasWithState(
        _streak(key, ts, row_id, value), f"`{key}` {kind}, last_value string, streak long, n_seen long", "last_value string, streak long, n_seen long, newest long", "update", GroupStateTimeout.NoTimeout,
    )


def new_bodies(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """Rows whose keys were not seen within the watermark: repeats of a body change nothing."""
    return stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark(keys).drop("_ts")


def run_to_table(stream: DataFrame, path: str, mode: str, key: list[str] | None = None) -> DataFrame:
    """Process all that has arrived and give the result as a table.

    Complete results replace the table; updates are merged by key, the newest batch standing. Each batch is written under
    its number, so a batch that runs again after a failure overwrites itself.
    """
    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/data/_n={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    out = spark.read.parquet(f"{path}/data")
    if mode == "complete":
        return out.join(out.agg(F.max("_batch").alias("_batch")), "_batch", "left_semi").drop("_batch", "_n")
    if mode == "update" and key:
        cols = [c for c in out.columns if c not in ("_batch", "_n")]
        return out.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("r")).select("r.*")
    return out.drop("_batch", "_n")
