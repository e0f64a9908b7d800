"""Batches of a fixed number of messages over a stream: what a trigger leaves over is carried into the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.decode import nonempty_bodies
from fleetpulse.operators.ordered import numbered_in_ranges
from fleetpulse.operators.packing import MESSAGES_PER_BATCH, in_place
from fleetpulse.schemas import BATCH_REMAINDER
from fleetpulse.streaming.sinks import BatchWriter
from fleetpulse.streaming.tables import PartedFiles, bucketed_files


def remainder_state(path: str, *, buckets: int = 16) -> PartedFiles:
    """How many messages each partition has sent, and those that do not fill a batch yet."""
    return bucketed_files(path, BATCH_REMAINDER, ["partition"], buckets=buckets)


def batches_across_triggers(keep: BatchWriter, state: PartedFiles, *, size: int = MESSAGES_PER_BATCH) -> BatchWriter:
    """batch_by_count on a stream of messages: hands every batch that is full to `keep`.

    A partition's messages are numbered on from what it sent in earlier triggers, so a batch may hold messages of several.
    Only pieces of batches meet the state, of which there is less than one batch per partition. A trigger that runs again
    starts from the same state, so a message is in one batch, and in one only, whatever fails in between.
    """
    if size < 1:
        raise ValueError("size must be at least 1")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            messages = nonempty_bodies(batch)
            touched = state.touched(messages)
            held = state.rows(spark, state.manifest(spark, batch_id), touched)
            sent = held.select("partition", "sent")
            numbered, number = numbered_in_ranges(
                messages, name="place", keys=["partition"], order=["sequenceNumber"], initial=sent
            )
            item = F.struct("sequenceNumber", "body", "properties")
            pieces = numbered.groupBy("partition", number, fields.whole(F.col("place"), size).alias("batchNo")).agg(
                F.collect_list(F.struct("place", item.alias("item"))).alias("slots")
            )
            full = F.size("slots") == size
            left = held.where(F.size("slots") > 0).select("partition", fields.whole(F.col("slots")[0]["place"], size).alias("batchNo"), "slots")
            joined = (
                pieces.filter(~full).select("partition", "batchNo", "slots").unionByName(left)
                .groupBy("partition", "batchNo").agg(F.flatten(F.collect_list("slots")).alias("slots")).persist()
            )
            try:
                done = pieces.filter(full).select("partition", "batchNo", "slots").unionByName(joined.filter(full))
                keep(_batches(done), batch_id)
                counts = messages.groupBy("partition").agg(F.count(F.lit(1)).alias("sent")).unionByName(sent)
                total = counts.groupBy("partition").agg(F.sum("sent").alias("sent"))
                rest = joined.filter(~full).select(F.col("partition").alias("of"), "slots")
                after = total.join(rest, F.col("partition").eqNullSafe(F.col("of")), "left").select(
                    "partition", "sent", F.coalesce("slots", F.array().cast(BATCH_REMAINDER["slots"].dataType)).alias("slots")
                )
                state.replace(after, batch_id, touched)
            finally:
                joined.unpersist()
        finally:
            batch.unpersist()

    return write


def unfinished(spark: SparkSession, state: PartedFiles, *, size: int = MESSAGES_PER_BATCH) -> DataFrame:
    """The last, short batch of each partition that has one."""
    held = state.rows(spark, state.manifest(spark)).where(F.size("slots") > 0)
    return _batches(held.select("partition", fields.whole(F.col("slots")[0]["place"], size).alias("batchNo"), "slots"))


def _batches(slots: DataFrame) -> DataFrame:
    return slots.select("partition", "batchNo", F.size("slots").cast("bigint").alias("size"), in_place("slots").alias("items"))
