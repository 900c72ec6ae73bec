"""Structured Streaming over experiment events: the batch columns on an unbounded table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampType

from cohortry.operators.cleaning import event_columns, keep_first, to_time
from cohortry.operators.experiments import arm_totals, monitor_columns
from cohortry.session import settle


def read_event_stream(
    spark: SparkSession, path: str, schema: StructType | str, file_filter: str | None = None, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """File stream with an explicit schema; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def clean_event_stream(events: DataFrame, watermark: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Silver events from a stream: duplicates within the watermark dropped, then valid arms and repaired columns.

    As in batch an event is deduplicated before its arm is looked at. Of copies that differ, batch keeps the earliest
    and a stream the first that arrives. State is one key per event inside the watermark, so it is bounded by the event
    rate times the delay.
    """
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return event_columns(timed.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark([key]))


def windowed_arm_counts(
    events: DataFrame, keys: Sequence[str] = ("experiment_name",), width: str = "1 day", watermark: str | None = None
) -> DataFrame:
    """Users, conversions and rate per tumbling window and arm; the same columns in batch and streaming."""
    # A cast, even to the same type, would lose the watermark.
    done = isinstance(events.schema["timestamp"].dataType, TimestampType)
    timed = events if done else events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    if watermark:
        timed = timed.withWatermark("timestamp", watermark)
    return (
        timed.groupBy(F.window("timestamp", width), *keys, "group")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("converted").alias("conversions"), F.avg("converted").alias("cvr"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "group", "n", "conversions", "cvr")
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, **trigger) -> DataFrame:
    """Append a stream to a Parquet table (exactly once) until its input is used up, then read it back."""
    started = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def closed_windows(counts: DataFrame, path: str, checkpoint: str, **trigger) -> DataFrame:
    """Windowed counts of a stream with a watermark, each window appended once, when the watermark has passed its end.

    State holds only windows that are still open; it is dropped with the window. What arrives for a closed window is too
    late and changes nothing (``live_monitor`` takes such events).
    """
    return run_to_table(counts, path, checkpoint, **trigger)


COUNTS = ("control_n", "control_conversions", "treatment_n", "treatment_conversions")


def merge_events(events: DataFrame, path: str, batch: int, keys: Sequence[str] = ("experiment_name",), key: str = "event_id") -> None:
    """Adds the events of one micro-batch to the tables under ``path``; the same batch again changes nothing.

    ``events`` (by day and batch) keeps each event once: copies inside the batch, and copies of an event that an earlier
    batch brought for the same day, are left out however late they come. ``totals`` (by day) holds the counts of both arms
    with those before the last batch that changed them, so a batch that is run again starts from these. Only the days that
    the batch has events of are read and written.
    """
    spark = events.sparkSession
    own = keep_first(events.withColumn("timestamp", to_time(F.col("timestamp"))).withColumn("day", F.to_date("timestamp")), [key], ["timestamp"])
    own = settle(own, "micro-batch")
    days = [r.day for r in own.select("day").distinct().collect()]
    of_days = F.col("day").isin([d for d in days if d is not None])
    of_days = of_days | F.col("day").isNull() if None in days else of_days
    stored = spark.read.schema(StructType([*own.schema, StructField("batch", LongType())])).parquet(f"{path}/events")
    known = stored.where(of_days & (F.col("batch") < batch)).select(F.col(key).alias("_known"))
    fresh = settle(own.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti").withColumn("batch", F.lit(batch).cast("bigint")), "fresh")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{path}/events")

    added = arm_totals(event_columns(fresh), [*keys, "day"])
    totals = spark.read.schema(totals_schema(own, keys)).parquet(f"{path}/totals").where(of_days)
    before = [F.when(F.col("batch") == batch, F.col(f"before_{c}")).otherwise(F.col(c)).alias(f"before_{c}") for c in COUNTS]
    base = totals.select(*keys, "day", *before)
    both = base.withColumns({c: F.col(f"before_{c}") for c in COUNTS}).unionByName(added.withColumns({f"before_{c}": F.lit(0).cast("bigint") for c in COUNTS}))
    merged = both.groupBy(*keys, "day").agg(*[F.sum(c).cast("bigint").alias(c) for n in COUNTS for c in (n, f"before_{n}")])
    settled = settle(merged.withColumn("batch", F.lit(batch).cast("bigint")), "totals")
    settled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/totals")


def totals_schema(events: DataFrame, keys: Sequence[str]) -> StructType:
    counts = [StructField(c, LongType()) for n in COUNTS for c in (n, f"before_{n}")]
    return StructType([*[events.schema[k] for k in keys], *counts, StructField("batch", LongType()), StructField("day", DateType())])


def merge_stream(events: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = ("experiment_name",), **trigger) -> None:
    """Runs a stream of events, copies and all, into the tables of ``merge_events`` until its input is used up."""
    spark = events.sparkSession
    day = StructField("day", DateType())
    timed = events.withColumn("timestamp", to_time(F.col("timestamp")))
    for name, schema in (("events", StructType([*timed.schema, day, StructField("batch", LongType())])), ("totals", totals_schema(events, keys))):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*(("day", "batch") if name == "events" else ("day",))).parquet(f"{path}/{name}")
    started = (
        events.writeStream.foreachBatch(lambda rows, batch: merge_events(rows, path, batch, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.awaitTermination()


def live_monitor(
    events: DataFrame, path: str, checkpoint: str, planned: DataFrame, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05, **trigger
) -> DataFrame:
    """Sequential-test table of an event stream, equal to ``sequential_monitor`` over the same events.

    A micro-batch changes only the totals of the days it has events of (``merge_events``); the stream itself keeps no
    state, and events count once however late they or their copies come. The result is computed from the daily totals.
    """
    merge_stream(events, path, checkpoint, keys, **trigger)
    totals = events.sparkSession.read.schema(totals_schema(events, keys)).parquet(f"{path}/totals")
    return monitor_columns(totals.select(*keys, "day", *COUNTS), planned, keys, alpha)


def merged_events(events: DataFrame, path: str) -> DataFrame:
    """Silver events of the tables that ``merge_stream`` keeps."""
    timed = events.withColumn("timestamp", to_time(F.col("timestamp")))
    schema = StructType([*timed.schema, StructField("day", DateType()), StructField("batch", LongType())])
    return event_columns(events.sparkSession.read.schema(schema).parquet(f"{path}/events")).select(*events.columns)
