"""Tables that a stream keeps up to date, on plain parquet.

A table is cut into parts: buckets by the hash of its keys, or days. A micro-batch reads and rewrites only the parts it
touches, each into a folder of its own version, and then commits a manifest: a small file, named by the micro-batch, that
says which versions make up each part. The newest manifest is the table. A micro-batch always starts from the manifest
before it, so a replay gives the same table; folders that neither of the two newest manifests names are deleted after the
commit, so the folders do not grow with the number of micro-batches.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.operators.positions import latest_position, position_history
from fleetpulse.schemas import HISTORY, POSITION
from fleetpulse.sources.files import Store

_PART = "__part"
NO_DAY = "none"


@dataclass
class Manifest:
    """The versions of each part that has rows, when a part next has to be read (if its writer says so), a number that the
    writer keeps with the table, and how many rows each version was given, where rows are added."""

    versions: dict[str, list[int]] = field(default_factory=dict)
    due: dict[str, int] = field(default_factory=dict)
    mark: int | None = None
    given: dict[str, list[int]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"versions": self.versions, "due": self.due, "mark": self.mark, "given": self.given})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        return cls(**json.loads(text))


class PartedFiles:
    """The files of a table in parts, from a single stream writer. `part` gives the part of a row, as text fit for a
    folder's name; it is fixed for the table's life. cluster: columns by which rows lie together in a part's files."""

    def __init__(self, path: str, schema: StructType, part: Callable[[], Column], *, cluster: Sequence[str] = ()):
        self.path, self.schema, self.part, self.cluster = path, schema, part, list(cluster)

    def touched(self, df: DataFrame) -> list[str]:
        """The parts of some rows: at most as many names as there are parts."""
        return sorted(r[0] for r in df.select(self.part().alias(_PART)).distinct().collect())

    def manifest(self, spark: SparkSession, before: int | None = None) -> Manifest:
        """The newest manifest, or the newest of the micro-batches before one."""
        store = Store(spark)
        done = [n for n in self._commits(store) if before is None or n < before]
        return Manifest.from_json(store.read_text(f"{self.path}/manifest/{done[-1]}")) if done else Manifest()

    def rows(self, spark: SparkSession, manifest: Manifest, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of some parts, or of all."""
        wanted = manifest.versions.keys() if parts is None else manifest.versions.keys() & set(parts)
        paths = [self._folder(version, part) for part in sorted(wanted) for version in manifest.versions[part]]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def replace(
        self, rows: DataFrame, batch_id: int, touched: Sequence[str], *, due: Column | None = None, mark: int | None = None
    ) -> None:
        """Writes the touched parts anew, all their rows given, and commits. due: a number per row, of which the least of
        each part is kept in the manifest."""
        spark, store = rows.sparkSession, Store(rows.sparkSession)
        before = self.manifest(spark, batch_id)
        versions = {p: v for p, v in before.versions.items() if p not in set(touched)}
        dues = {p: before.due[p] for p in versions if p in before.due}
        written = self._write(rows, batch_id, touched, store)
        versions |= {p: [batch_id] for p in written}
        if due is not None and written:
            new = self.rows(spark, Manifest({p: [batch_id] for p in written}))
            least = new.groupBy(self.part().alias(_PART)).agg(F.min(due).alias("due")).collect()
            dues |= {r[_PART]: r["due"] for r in least if r["due"] is not None}
        self._commit(store, batch_id, Manifest(versions, dues, mark))

    def append(
        self,
        rows: DataFrame,
        batch_id: int,
        *,
        compact_after: int = 8,
        compact: Callable[[DataFrame], DataFrame] = lambda df: df,
        expired: Callable[[str], bool] = lambda part: False,
    ) -> None:
        """Adds rows, a version to each part they touch, and commits. A touched part that already has compact_after
        versions has its newest ones rewritten as one with the new rows, with `compact` applied: those that are not far
        larger than what they are joined with, all of them if none is. So a row is rewritten only when its version grows
        by half or more, however many micro-batches add to its part. Expired parts leave the table and their files go."""
        spark, store = rows.sparkSession, Store(rows.sparkSession)
        before = self.manifest(spark, batch_id)
        counts = rows.groupBy(self.part().alias(_PART)).count().collect()
        touched = {r[_PART]: r["count"] for r in sorted(counts) if not expired(r[_PART])}
        given = {p: before.given.get(p, [0] * len(vs)) for p, vs in before.versions.items()}
        kept = {p: len(given.get(p, ())) for p in touched}
        for p in [p for p, n in kept.items() if n >= compact_after]:
            joined = touched[p]
            while kept[p] and given[p][kept[p] - 1] <= 2 * joined:
                kept[p] -= 1
                joined += given[p][kept[p]]
        full = [p for p, n in kept.items() if n < len(given.get(p, ()))]
        new = rows.filter(self.part().isin(list(touched))) if touched else rows.limit(0)
        if full:
            names = self.schema.fieldNames()
            newest = Manifest({p: before.versions[p][kept[p]:] for p in full})
            merged = self.rows(spark, newest, full).unionByName(new.filter(self.part().isin(full)).select(*names))
            new = new.filter(~self.part().isin(full)).select(*names).unionByName(compact(merged).select(*names))
        written = self._write(new, batch_id, list(touched), store)
        versions = {p: v for p, v in before.versions.items() if not expired(p)}
        given = {p: given[p] for p in versions}
        for p in written:
            versions[p] = [*versions.get(p, ())[: kept[p]], batch_id]
            given[p] = [*given.get(p, ())[: kept[p]], touched[p] + sum(given.get(p, ())[kept[p]:])]
        self._commit(store, batch_id, Manifest(versions, {}, before.mark, given))

    def _write(self, rows: DataFrame, batch_id: int, touched: Sequence[str], store: Store) -> list[str]:
        """Parts that got files."""
        if not touched:
            return []
        folder = f"{self.path}/data/{batch_id}"
        placed = rows.select(self.part().alias(_PART), *self.schema.fieldNames())
        if self.cluster:
            # Files hold neighbours, and a part gets as many as its size asks for, not one of each task.
            placed = placed.repartitionByRange(_PART, *self.cluster).sortWithinPartitions(_PART, *self.cluster)
        else:
            placed = placed.repartition(len(touched), _PART)
        placed.write.mode("overwrite").partitionBy(_PART).parquet(folder)
        return [n.removeprefix(f"{_PART}=") for n in store.names(folder) if n.startswith(f"{_PART}=")]

    def _commit(self, store: Store, batch_id: int, manifest: Manifest) -> None:
        """Writes the manifest, and deletes what the two newest ones do not name."""
        store.write_text(f"{self.path}/manifest/{batch_id}", manifest.to_json())
        done = self._commits(store)
        for old in done[:-2]:
            store.delete(f"{self.path}/manifest/{old}")
        named = [Manifest.from_json(store.read_text(f"{self.path}/manifest/{n}")).versions for n in done[-2:]]
        current = {(v, p) for versions in named for p, vs in versions.items() for v in vs}
        for version in store.names(f"{self.path}/data"):
            folders = [n for n in store.names(f"{self.path}/data/{version}") if n.startswith(f"{_PART}=")]
            left = [n for n in folders if (int(version), n.removeprefix(f"{_PART}=")) in current]
            if not left:
                store.delete(f"{self.path}/data/{version}")
            else:
                for name in set(folders) - set(left):
                    store.delete(f"{self.path}/data/{version}/{name}")

    def _commits(self, store: Store) -> list[int]:
        return sorted(int(n) for n in store.names(f"{self.path}/manifest") if n.isdecimal())

    def _folder(self, version: int, part: str) -> str:
        return f"{self.path}/data/{version}/{_PART}={part}"


def bucketed_files(path: str, schema: StructType, keys: Sequence[str], *, buckets: int = 64) -> PartedFiles:
    """Parts by the hash of the keys."""
    return PartedFiles(path, schema, lambda: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))


def daily_files(path: str, schema: StructType, time: str, *, cluster: Sequence[str] = ()) -> PartedFiles:
    """Parts by the day of a time column; rows without a time are a part of their own."""
    return PartedFiles(
        path, schema, lambda: F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY)), cluster=cluster
    )


class KeyedTable:
    """One row per key, from a single stream writer; keys and the number of buckets are fixed for the table's life.

    `reduce` merges rows to one per key and must give the same whether applied at once or in steps.
    """

    def __init__(
        self,
        path: str,
        schema: StructType,
        reduce: Callable[[DataFrame], DataFrame],
        keys: Sequence[str],
        *,
        buckets: int = 64,
    ):
        self.path, self.schema, self.reduce = path, schema, reduce
        self.files = bucketed_files(path, schema, keys, buckets=buckets)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a micro-batch, reading and writing only the buckets of its keys; a replay of the latest one changes
        nothing."""
        spark = batch.sparkSession
        # Reduced before its keys are looked up, so the batch is read once.
        changes = self.reduce(batch).select(*self.schema.fieldNames()).persist()
        try:
            touched = self.files.touched(changes)
            before = self.files.rows(spark, self.files.manifest(spark, batch_id), touched)
            self.files.replace(self.reduce(before.unionByName(changes)), batch_id, touched)
        finally:
            changes.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows so far."""
        return self.files.rows(spark, self.files.manifest(spark))

    def read_before(self, spark: SparkSession, batch_id: int, *, like: DataFrame | None = None) -> DataFrame:
        """The rows as they were before a micro-batch, also when that batch is a replay; only the buckets of the keys
        in `like` if it is given."""
        parts = None if like is None else self.files.touched(like)
        return self.files.rows(spark, self.files.manifest(spark, batch_id), parts)


def latest_positions(path: str, *, buckets: int = 64) -> KeyedTable:
    """The latest position per device."""
    return KeyedTable(path, POSITION, latest_position, ["deviceId"], buckets=buckets)


class DailyHistory:
    """The positions of all devices, by day of their time, kept for `ttl_days` whole days before the newest one seen.

    Repeats are removed when a day is compacted and when it is read.
    """

    def __init__(self, path: str, *, ttl_days: int | None = None, compact_after: int = 8):
        self.path, self.ttl_days, self.compact_after = path, ttl_days, compact_after
        self.files = daily_files(path, HISTORY, "eventTime", cluster=["deviceId", "eventTime"])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*HISTORY.fieldNames()).persist()
        try:
            days = [d for d in {*self.files.manifest(spark, batch_id).versions, *self.files.touched(rows)} if d != NO_DAY]
            first = self._first_day(max(days, default=None))
            self.files.append(
                rows, batch_id, compact_after=self.compact_after, compact=position_history,
                expired=lambda day: first is not None and day != NO_DAY and day < first,
            )
        finally:
            rows.unpersist()

    def _first_day(self, newest: str | None) -> str | None:
        if newest is None or self.ttl_days is None:
            return None
        return (dt.date.fromisoformat(newest) - dt.timedelta(days=self.ttl_days)).isoformat()

    def read(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame:
        """Each (device, time, point) once, of some days or all."""
        return position_history(self.files.rows(spark, self.files.manifest(spark), days))
