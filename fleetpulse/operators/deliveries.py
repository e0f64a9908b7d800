"""Delivery summaries and per-delivery documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import fields
from fleetpulse.operators.policy import departed_or_dropped_off

# How device times are sent; text order is time order.
_SENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def delivery_summary(enriched: DataFrame) -> DataFrame:
    """Latest departure (DPS) and latest drop-off (DOP) time per delivery, as the ISO text they came in.

    Texts are compared as text. Those in the form that the times are sent in compare as their microseconds do, and are
    reduced to two numbers per delivery by a hash aggregation, where a maximum of text would have all rows sorted; a text
    in another form stands for itself, as a group of its own. Only the reduced rows are compared as text.
    """
    odd = F.col("odd")

    def latest(status: str):
        return F.max(F.when(F.col("flightStatus") == status, F.col("micros")))

    def text_of(micros: str, any_odd: str):
        sent = F.date_format(F.timestamp_micros(micros), _SENT)
        return F.when(odd.isNull(), sent).when(F.col(any_odd), odd)

    at = fields.to_time(F.col("occurrenceUtcTime"))
    canonical = F.coalesce(F.date_format(at, _SENT) == F.col("occurrenceUtcTime"), F.lit(False))
    told = departed_or_dropped_off(enriched).select(
        F.col("deliveryId").alias("deliveryid"),
        "flightStatus",
        F.when(canonical, F.unix_micros(at)).alias("micros"),
        F.when(~canonical, F.col("occurrenceUtcTime")).alias("odd"),
    )
    reduced = told.groupBy("deliveryid", "odd").agg(
        latest("DPS").alias("started"),
        latest("DOP").alias("completed"),
        F.bool_or(F.col("flightStatus") == "DPS").alias("anyStarted"),
        F.bool_or(F.col("flightStatus") == "DOP").alias("anyCompleted"),
    )
    return merge_summaries(
        reduced.select(
            "deliveryid", text_of("started", "anyStarted").alias("startdate"), text_of("completed", "anyCompleted").alias("completedate")
        )
    )


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """One summary per delivery of several, by the latest times."""
    return summaries.groupBy("deliveryid").agg(F.max("startdate").alias("startdate"), F.max("completedate").alias("completedate"))


def latest_alert_by_delivery(alerts: DataFrame) -> DataFrame:
    """The alert document that remains per delivery when later ones replace earlier ones."""
    columns = alerts.columns
    newest = F.struct("lastoccurrenceutctime", *[c for c in columns if c != "lastoccurrenceutctime"])
    return (
        alerts.groupBy("deliveryid")
        .agg(F.max(newest).alias("newest"))
        .select(*[F.col(f"newest.{c}").alias(c) for c in columns])
    )
