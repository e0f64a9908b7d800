"""Stream sinks. Those that write files are safe to replay: a micro-batch that runs again writes the same place again.
jdbc_append, notifier and row_by_row deliver at least once."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegerType, LongType, Row, StringType, StructField, StructType

from fleetpulse.operators.decode import alert_body
from fleetpulse.operators.packing import ALERTS_PER_PAYLOAD, alert_payloads

BatchWriter = Callable[[DataFrame, int], None]


def with_retries(write: BatchWriter, *, attempts: int = 3, wait_seconds: float = 10.0) -> BatchWriter:
    """Repeats a failed write after a fixed wait; the last failure stops the query, so nothing is skipped."""

    def retrying(batch: DataFrame, batch_id: int) -> None:
        for left in range(attempts, -1, -1):
            try:
                return write(batch, batch_id)
            except Exception:
                if left == 0:
                    raise
                time.sleep(wait_seconds)

    return retrying


def table_append(path: str) -> BatchWriter:
    """Appends each micro-batch to a parquet table, under a folder of its own that a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def json_append(path: str) -> BatchWriter:
    """Appends each micro-batch as JSON documents, one per row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Gives one micro-batch, computed once, to several writers in turn."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def only(predicate: Column, writer: BatchWriter) -> BatchWriter:
    """A writer that gets the rows of a route."""
    return lambda batch, batch_id: writer(batch.filter(predicate), batch_id)


class RowWriter(Protocol):
    """Row-at-a-time output, for targets that offer nothing better."""

    def open(self, partition_id: int, batch_id: int) -> bool:
        """Whether this task's rows are wanted."""

    def process(self, row: Row) -> None: ...

    def close(self, error: BaseException | None) -> None: ...


def row_by_row(make: Callable[[], RowWriter]) -> BatchWriter:
    """Runs a RowWriter over each task's rows on the executors."""

    def write(batch: DataFrame, batch_id: int) -> None:
        def task(rows: Iterable[Row]) -> None:
            writer, error = make(), None
            try:
                if writer.open(TaskContext.get().partitionId(), batch_id):
                    for row in rows:
                        writer.process(row)
            except Exception as failure:
                error = failure
                raise
            finally:
                writer.close(error)

        batch.foreachPartition(task)

    return write


def dead_letter(make: Callable[[], RowWriter], failed: BatchWriter, *, schema: StructType) -> BatchWriter:
    """row_by_row where a row that cannot be written does not stop the others: rows whose `process` raises go to `failed`,
    with the column reason. `schema` is that of the batches.

    Rows are processed once per attempt of their task; a task that runs again, or a failure of open or close, which stops
    the query, has its rows processed again.
    """
    refused = StructType([*schema.fields, StructField("reason", StringType())])
    names = schema.fieldNames()

    def write(batch: DataFrame, batch_id: int) -> None:
        def task(rows: Iterable[Row]) -> Iterable[tuple]:
            writer, error = make(), None
            try:
                if writer.open(TaskContext.get().partitionId(), batch_id):
                    for row in rows:
                        try:
                            writer.process(row)
                        except Exception as failure:
                            yield (*row, f"{type(failure).__name__}: {failure}")
            except Exception as failure:
                error = failure
                raise
            finally:
                writer.close(error)

        rows = batch.select(*names).rdd.mapPartitions(task)
        failed(batch.sparkSession.createDataFrame(rows, refused, verifySchema=False), batch_id)

    return write


def jdbc_append(url: str, table: str, *, rows_per_statement: int = 10_000, properties: dict | None = None) -> BatchWriter:
    """Bulk load into a database table that has a batch_id column.

    The insert runs at least once: a table that must not hold a replayed batch twice needs a unique key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.option("batchsize", rows_per_statement).jdbc(
            url, table, mode="append", properties=properties or {}
        )

    return write


def bus_writer(alerts: DataFrame, topic: str) -> DataStreamWriter:
    """Alerts as JSON bodies to a topic folder; the file sink commits each micro-batch once."""
    return (
        alert_body(alerts)
        .withColumn("enqueuedTime", F.current_timestamp())
        .writeStream.format("json")
        .option("path", topic)
        .outputMode("append")
    )


def broker_rows(alerts: DataFrame) -> DataFrame:
    """Alerts as records of a broker: the JSON body, and the device as key, so that a device's alerts stay in order."""
    return alert_body(alerts, "deviceid").select(F.col("deviceid").alias("key"), F.col("body").alias("value"))


def broker_options(servers: str, topic: str, *, max_record_bytes: int | None = None) -> dict[str, str]:
    """Options of a Kafka-compatible broker to write to; a record counts as written when all replicas have it."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    if max_record_bytes is not None:
        options["kafka.max.request.size"] = str(max_record_bytes)
    return options


def broker_writer(alerts: DataFrame, options: dict[str, str]) -> DataStreamWriter:
    """Alerts to a Kafka-compatible topic, at least once; needs the spark-sql-kafka package on the cluster."""
    return broker_rows(alerts).writeStream.format("kafka").options(**options).outputMode("append")


def notifier(post: Callable[[str], None], *, size: int = ALERTS_PER_PAYLOAD) -> BatchWriter:
    """Hands the alerts of each micro-batch to `post` on the executors, as JSON arrays of at most `size`.

    Delivery is at least once: a failed task posts its payloads again.
    """

    def send(rows: Iterable[Row]) -> None:
        for row in rows:
            post(row["payload"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            alert_payloads(batch, size=size).select("payload").foreachPartition(send)
        finally:
            batch.unpersist()

    return write


PAYLOAD = StructType(
    [
        StructField("partitionid", IntegerType()),
        StructField("batchNo", LongType()),
        StructField("size", LongType()),
        StructField("payload", StringType()),
    ]
)


def payload_append(path: str, *, size: int = ALERTS_PER_PAYLOAD) -> BatchWriter:
    """Like notifier, but leaves the payloads in an outbox table from which a sender can deliver each once."""
    append = table_append(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append(alert_payloads(batch, size=size), batch_id)
        finally:
            batch.unpersist()

    return write


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written by table_append, without the batch column."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id=*")
