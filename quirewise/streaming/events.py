"""Structured Streaming: the journal and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.operators.journal import publish
from quirewise.storage import cut

#: Requests of a micro-batch up to which they are named in the journal's filter.
FEW = 1_000


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by type in tumbling windows; on a stream, rows later than `late` are dropped by the watermark."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    grouped = marked.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return grouped.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events no further apart than `gap`."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    grouped = marked.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("w.start").alias("session_start"), "n")


def append_journal(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str):
    """A stream of requests (JSON files of request_id, payload_sha256) appended to a Parquet journal once each.

    Requests the journal has already are replays or conflicts and add nothing; within a batch the least payload of a request counts.
    Each micro-batch writes under its own number, so one that is run again after a failure replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        once = batch.groupBy("request_id").agg(F.min("payload_sha256").alias("payload_sha256"))
        once = cut(once, "requests")
        low, high, n = once.agg(F.min("request_id"), F.max("request_id"), F.count("*")).first()
        if there and n:
            # Files and row groups without these requests are passed over, by range and, for few requests, by their Bloom filters.
            near = F.col("request_id").between(low, high)
            if n <= FEW:
                near = near & F.col("request_id").isin([r.request_id for r in once.select("request_id").collect()])
            journal = spark.read.schema(f"{schema}, batch long").parquet(target).where(F.col("batch") != number).where(near).select(*once.columns)
        else:
            journal = once.limit(0)
        new = publish(journal, once).where("disposition = 'new'").select("request_id", "payload_sha256").sortWithinPartitions("request_id")
        new.write.mode("overwrite").option("parquet.bloom.filter.enabled#request_id", "true").parquet(f"{target}/batch={number}")

    return spark.readStream.schema(schema).json(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
