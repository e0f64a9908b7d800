"""Packing rows into batches of a fixed size, in order, without losing any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.decode import alert_record, nonempty_bodies
from fleetpulse.operators.ordered import numbered_in_ranges

MESSAGES_PER_BATCH = 10
ALERTS_PER_PAYLOAD = 100


def pack(
    df: DataFrame, *, size: int, keys: Sequence[str], order: Sequence[str], item: Column, ranges: int | None = None
) -> DataFrame:
    """(keys, batchNo, size, items): `item` of every row, `size` rows to a batch, in order within the keys.

    Rows are dealt once, by ranges of equal depth. A batch inside a range is put together where its rows are; only the
    pieces of batches that cross the edge of a range are moved again. Reads keys and order once more than the rows: store
    df first if it is expensive to compute.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    numbered, number = numbered_in_ranges(df, name="place", keys=keys, order=order, ranges=ranges)
    slots = F.collect_list(F.struct(F.col("place"), item.alias("item")))
    batch_no = fields.whole(F.col("place"), size)
    pieces = numbered.groupBy(*keys, number, batch_no.alias("batchNo")).agg(slots.alias("slots")).drop(number)
    whole = pieces.filter(F.size("slots") == size)
    split = pieces.filter(F.size("slots") < size).groupBy(*keys, "batchNo").agg(F.flatten(F.collect_list("slots")).alias("slots"))
    return whole.unionByName(split).select(
        *keys,
        "batchNo",
        F.size("slots").cast("bigint").alias("size"),
        in_place("slots").alias("items"),
    )


def in_place(slots: str) -> Column:
    """The items of (place, item) slots in order of place."""
    by_place = F.array_sort(slots, lambda a, b: F.signum(a["place"] - b["place"]).cast("int"))
    return F.transform(by_place, lambda slot: slot["item"])


def batch_by_count(messages: DataFrame, *, size: int = MESSAGES_PER_BATCH, ranges: int | None = None) -> DataFrame:
    """Hub messages with a body, packed per partition in sequence order; bodies and properties are kept."""
    return pack(
        nonempty_bodies(messages),
        size=size,
        keys=["partition"],
        order=["sequenceNumber"],
        item=F.struct("sequenceNumber", "body", "properties"),
        ranges=ranges,
    )


def alert_payloads(alerts: DataFrame, *, size: int = ALERTS_PER_PAYLOAD) -> DataFrame:
    """(partitionid, batchNo, size, payload): JSON arrays of at most `size` alerts in order of occurrence.

    Splitting up front means no alert is sent, rejected for the size of its payload and sent again.
    """
    record = alert_record(alerts)
    packed = pack(
        record.withColumn("at", F.col("lastoccurrenceutctime").cast("timestamp")),
        size=size,
        keys=["partitionid"],
        order=["at", *[c for c in record.columns if c != "lastoccurrenceutctime"]],
        item=F.struct(*record.columns),
    )
    return packed.select("partitionid", "batchNo", "size", F.to_json("items").alias("payload"))


def oversized(payloads: DataFrame, *, limit: int = ALERTS_PER_PAYLOAD) -> DataFrame:
    """Payloads from elsewhere that hold more alerts than the receiver accepts, with their alert count."""
    alerts = F.json_array_length("payload")
    return payloads.withColumn("alerts", alerts).filter(F.col("alerts") > limit)
