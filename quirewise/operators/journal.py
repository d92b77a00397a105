"""The append-only journal: chain, selection, idempotent publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chain_breaks(records: DataFrame, partition: Column) -> DataFrame:
    """Records whose previous digest isn't the digest of the record before them, or whose sequence has a gap.

    Within each partition (a block of sequences) neighbours are compared by a window; the ends of blocks are compared with each
    other, so no task orders the whole journal. records: sequence, record_sha256, previous_record_sha256.
    """
    blocked = records.withColumn("_block", partition)
    w = Window.partitionBy("_block").orderBy("sequence")
    seen = blocked.withColumn("_last", F.lag("record_sha256").over(w)).withColumn("_at", F.lag("sequence").over(w)).withColumn("_first", F.col("_at").isNull())
    ends = blocked.groupBy("_block").agg(F.max("sequence").alias("_end"), F.max_by("record_sha256", "sequence").alias("_end_sha"))
    order = Window.partitionBy(F.lit(0)).orderBy("_block")  # one row a block
    ends = ends.select("_block", F.lag("_end").over(order).alias("_before"), F.lag("_end_sha").over(order).alias("_before_sha"))
    linked = seen.join(ends, "_block").withColumn("_last", F.when(F.col("_first"), F.col("_before_sha")).otherwise(F.col("_last"))).withColumn("_at", F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_at")))
    reason = F.when(F.col("_at").isNull() & F.col("previous_record_sha256").isNotNull(), "first_with_previous").when(F.col("_at").isNotNull() & (F.col("sequence") != F.col("_at") + 1), "sequence_gap").when(~F.col("previous_record_sha256").eqNullSafe(F.col("_last")), "digest_mismatch")
    return linked.withColumn("reason", reason).where("reason is not null").select("sequence", "reason")


def publish(journal: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests against a journal (request_id, payload_sha256): replay if the same payload is there, conflict if another is, else new."""
    known = journal.select("request_id", F.col("payload_sha256").alias("there")).distinct()
    status = F.when(F.col("there").isNull(), "new").when(F.col("there") == F.col("payload_sha256"), "replay").otherwise("conflict")
    return requests.join(known, "request_id", "left").select("request_id", "payload_sha256", status.alias("disposition"))
