"""What the operators share: tables, row keys, written intermediate tables, batches of text."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
KEY = "struct<d:bigint,h:bigint>"
_NULL_ID = -(2**63)


#: Rows of an Arrow batch.
BATCH_ROWS = 1000
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, which may not have it installed: once per application, as a zip file
    in the shared folder. Also bounds the session's Arrow batches."""
    # Rows are whole texts: few to a batch, so that a batch stays small in the executor and in its Python worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, f"{root.name}/{module.relative_to(root)}")
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/code-{uuid.uuid4().hex}/{root.name}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(content.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A non-null key of a row: its id, and the hash of its text, so that ids may be null or repeat.

    Rows that agree in both are one document given twice. Keys order by id, null first.
    """
    return F.struct(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the folder that the cluster shares, and read again: it is computed once, its lineage ends,
    and it outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_made: list[list[str]] = []


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that `make` describes, stored; what it has stored on the way, and only itself reads, is deleted."""
    made: list[str] = []
    _made.append(made)
    try:
        result = stored(make(), name)
    finally:
        _made.pop()
    spark = result.sparkSession
    for path in made[:-1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return result


def slices(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most max_bytes of text each, or of one row that is longer: bounds temporary arrays."""
    lengths = pc.binary_length(texts).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + (n or 0) > max_bytes:
            yield start, i
            start, size = i, 0
        size += n or 0
    if start < len(lengths):
        yield start, len(lengths)


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The given number of rows, chosen by the hash of a column: a documented bound for fitting, the same at each run."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(rows)
