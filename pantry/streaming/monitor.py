"""Structured Streaming versions of the monitoring and drift operators.

The batch functions in ``pantry.operators.monitor`` / ``drift`` are reused on
streaming DataFrames: event-time windows with a watermark (late rows beyond
the watermark are dropped by Spark and can be counted from the input), bounded
state (bucket counts instead of exact percentiles), and a stream-stream left join with watermarks on both sides plus an event-time bound
for feedback attribution.  Every query keeps its progress in a checkpoint
under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor as M
from ..sources.fixtures import VIEW_SQL
from ..sources.io import output_root

WATERMARK = "10 minutes"
END = "end_of_replay"


def stage_events_by_day(spark: SparkSession, sf_dir: str, end_marker: bool = False, in_order: bool = False) -> str:
    """Write the events table as day-sliced parquet files (a replayable stream
    source derived from the given table); a busy day is spread over many files.

    With ``end_marker`` one event without a user follows, later than all others
    by twice the replay's span and two hours: it moves the watermark past every
    event, so that joins give out all that still waits."""
    path = output_root(spark, "events-stream")
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    # event time must be TIMESTAMP (not NTZ) for watermarks; session TZ is UTC
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    def write(rows: DataFrame, mode: str):
        rows.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).repartitionByRange("ts").write.mode(mode).partitionBy("day").parquet(path)

    if in_order:  # the file source reads by age, so a row is late by less than a day
        days = [r[0] for r in ev.select(F.to_date("ts").alias("day")).distinct().orderBy("day").collect()]  # a value for each day
        for day in days:
            write(ev.where(F.to_date("ts") == F.lit(day)), "append")
    else:
        write(ev, "errorifexists")
    if end_marker:  # written after the others, as the file source reads by age
        gap = (F.max("ts").cast("double") - F.min("ts").cast("double")) * 2 + 7200
        last = ev.agg((F.max("ts").cast("double") + gap).cast("timestamp").alias("ts"))
        write(last.select(*[F.col("ts") if f.name == "ts" else F.lit({"event_type": END, "event_id": -1}.get(f.name))
                            .cast(f.dataType).alias(f.name) for f in ev.schema.fields]), "append")
    return path


def read_request_log_stream(spark: SparkSession, events_path: str, files_per_trigger: int = 5,
                            watermark: str | None = None) -> DataFrame:
    """Streaming request log: file source over the staged events + the same view
    projection as the batch fixture.  A ``watermark`` is taken from all events,
    also from those that the view leaves out."""
    schema = spark.read.parquet(events_path).schema
    ev = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
          .parquet(events_path))
    ev = ev.withWatermark("ts", watermark) if watermark else ev
    return spark.sql(VIEW_SQL["request_log"], events=ev)


def never(ts: str) -> Column:
    """False for every event, but a condition on the event time: a filter that has it
    beside others stays above the watermark, which so sees the rows it drops.  (IS NULL
    would not do: a join's own IS NOT NULL takes it out.)"""
    return F.col(ts) < F.lit("0001-01-02 00:00:00").cast("timestamp")


def _run(query_writer, checkpoint: str):
    q = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def error_rate_stream(log: DataFrame, width: str = "5 minutes") -> DataFrame:
    return M.error_rate(log.withWatermark("ts", WATERMARK), width)


def latency_histogram_stream(log: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Bounded-state p95: cumulative latency bucket counts per window."""
    b = M.bucket_counts(log.withWatermark("ts", WATERMARK), "latency_s", M.LATENCY_BUCKETS,
                        [F.window("ts", width)])
    return b.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    *[c for c in b.columns if c.startswith("le_")])


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a streaming aggregation to completion (Trigger.AvailableNow) and
    return its final result as a batch DataFrame.  Each micro-batch replaces
    the table (complete mode), so replays are idempotent."""
    out = output_root(spark, name)

    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(out)

    _run(stream.writeStream.outputMode(mode).foreachBatch(sink), out + "-ckpt")
    return spark.read.parquet(out)


def run_append(spark: SparkSession, stream: DataFrame, name: str, progress: list | None = None) -> DataFrame:
    """Append-mode query to a parquet sink (exactly-once file sink), then read.
    ``progress`` gets (rows held as state, rows dropped as late) of the last batches."""
    out = output_root(spark, name)
    q = _run(stream.writeStream.outputMode("append").format("parquet").option("path", out), out + "-ckpt")
    if progress is not None:
        progress += [(sum(o["numRowsTotal"] for o in p["stateOperators"]), sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]))
                     for p in q.recentProgress]
    return spark.read.schema(stream.schema).parquet(out)


def feedback_attribution_stream(feedback: DataFrame, served: DataFrame, max_delay_s: int = 3600) -> DataFrame:
    """Stream-stream LEFT join of two streams that carry watermarks, with an
    event-time bound: state holds the rows of the watermarks' delay and of
    ``max_delay_s``, whatever the length of the stream.  Rows later than the
    watermarks are dropped; ``late_attribution`` finds what that has cost."""
    return M.feedback_attribution(feedback, served, max_delay_s)


def late_attribution(feedback: DataFrame, served: DataFrame, attributed: DataFrame, max_delay_s: int = 3600) -> DataFrame:
    """The side table of late rows: of the finished tables ``feedback`` and ``served``,
    the attributions that the stream's result lacks, since the feedback came too late
    (``late`` = feedback) or what it answers did (``late`` = served; the stream then
    says that nothing matches).  Stream rows without those of the second kind, and
    this table, are together the batch result."""
    seen = attributed.groupBy("event_id").agg(F.max(F.col("served_ts").isNotNull()).alias("_matched"))
    open_ = feedback.join(seen, "event_id", "left").where(~F.coalesce("_matched", F.lit(False)))
    again = M.feedback_attribution(open_, served, max_delay_s)
    return again.where(F.col("_matched").isNull() | F.col("served_ts").isNotNull()).withColumn(
        "late", F.when(F.col("_matched").isNull(), "feedback").otherwise("served")).drop("_matched")


def corrected_attribution(attributed: DataFrame, late: DataFrame) -> DataFrame:
    """The batch result from a stream's rows and the side table."""
    wrong = late.where("late = 'served'").select("event_id").distinct()
    return attributed.join(wrong, "event_id", "left_anti").unionByName(late.select(*attributed.columns))
