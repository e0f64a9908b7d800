"""Cold path: captured messages to an enriched table to a delivery summary.

run_cold_path rewrites both tables. The incremental form keeps them up to date instead: enriched rows are added to the
days they belong to, and each delivery's latest times, which merge by maximum, are kept by the hash of the delivery; a run
reads and writes only what its messages touch (see streaming.tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetpulse.functions import fields
from fleetpulse.operators.decode import enrich_telemetry
from fleetpulse.operators.deliveries import delivery_summary, merge_summaries
from fleetpulse.schemas import DELIVERY_SUMMARY, ENRICHED_TELEMETRY
from fleetpulse.sources.files import Store
from fleetpulse.streaming.queries import start, to_batches
from fleetpulse.streaming.tables import KeyedTable, PartedFiles

_WITH_DAY = StructType([*ENRICHED_TELEMETRY.fields, StructField("day", StringType())])
# What lies together in the files of a day.
_CLUSTER = ["deliveryId", "occurrenceUtcTime"]
NO_DAY = "none"


def _with_day(messages: DataFrame) -> DataFrame:
    """Enriched rows and the day they occurred on, missing where the time does not parse."""
    enriched = enrich_telemetry(messages)
    return enriched.withColumn("day", F.date_format(fields.to_time(F.col("occurrenceUtcTime")), "yyyy-MM-dd"))


def write_enriched(messages: DataFrame, path: str) -> None:
    """Overwrites the enriched table, partitioned by the day of occurrence so that readers can skip days. Rows are dealt by
    ranges of day and delivery, so that a day has as many files as its size asks for."""
    rows = _with_day(messages).repartitionByRange("day", *_CLUSTER)
    rows.write.mode("overwrite").partitionBy("day").parquet(path)


def enriched_table(out: str) -> PartedFiles:
    """The enriched table of the incremental form, by day."""
    return PartedFiles(f"{out}/enriched", _WITH_DAY, lambda: F.coalesce("day", F.lit(NO_DAY)), cluster=_CLUSTER)


def delivery_table(out: str, *, buckets: int = 64) -> KeyedTable:
    """The delivery summary of the incremental form, by the hash of the delivery."""
    return KeyedTable(f"{out}/deliveries", DELIVERY_SUMMARY, merge_summaries, ["deliveryid"], buckets=buckets)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """Either form of the enriched table."""
    if Store(spark).names(f"{path}/manifest"):
        table = enriched_table(path.removesuffix("/enriched"))
        return table.rows(spark, table.manifest(spark))
    return spark.read.schema(_WITH_DAY).parquet(path)


def run_cold_path(messages: DataFrame, out: str) -> tuple[str, str]:
    """Rewrites <out>/enriched, then <out>/deliveries from it; an error in the first step leaves the second undone.

    Returns both paths.
    """
    spark = messages.sparkSession
    enriched, deliveries = f"{out}/enriched", f"{out}/deliveries"
    write_enriched(messages, enriched)
    delivery_summary(read_enriched(spark, enriched)).write.mode("overwrite").parquet(deliveries)
    return enriched, deliveries


def run_cold_path_incrementally(messages: DataFrame, out: str, *, buckets: int = 64) -> tuple[str, str]:
    """The same for a message stream: adds what has arrived since the last run to the days and deliveries it touches.

    A micro-batch that is replayed after a failure leaves both tables as if it had run once.
    """
    days, deliveries = enriched_table(out), delivery_table(out, buckets=buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            days.append(batch, batch_id)
            deliveries.write(delivery_summary(batch), batch_id)
        finally:
            batch.unpersist()

    start(to_batches(_with_day(messages), write), f"{out}/checkpoint", available_now=True).awaitTermination()
    return days.path, deliveries.path


def preview(spark: SparkSession, deliveries: str) -> DataFrame:
    """The delivery summary table as it is, in either form."""
    if Store(spark).names(f"{deliveries}/manifest"):
        return delivery_table(deliveries.removesuffix("/deliveries")).read(spark)
    return spark.read.schema(DELIVERY_SUMMARY).parquet(deliveries)
