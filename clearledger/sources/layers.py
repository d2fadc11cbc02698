"""Where the tables of each layer lie, and how they are read and written."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock
from typing import ClassVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from clearledger.sources.switch import drop_folder, read_text, subfolders, switch_text

__all__ = ["BucketedLayout", "Layout", "VersionedLayout", "drop_folder", "scratch_folder", "shuffles_dropped", "write_all"]

# Layers, and the table name of each entity inside a layer.
LAYERS = ("bronze", "silver")
ENTITY_TABLES = {
    "bank": "Bank",
    "branch": "Branch",
    "contact": "Contact",
    "account": "Account",
    "financial_holding": "FinancialHolding",
}

# Spark's default codec leaves twice the bytes of this one, in the same time.
DENSE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

# Looking up each text in a dictionary while writing, and copying it from there while reading,
# takes longer than writing and reading it as it is; what the files grow by, the codec takes off again.
PLAIN = {"parquet": {"parquet.enable.dictionary": "false", **DENSE}}

_FIRST_VERSION = "spark.sql.sources.useV1SourceList"
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers: dict[str, tuple[int, str]] = {}  # by session: how many there are, and the setting before the first
_writers_lock = Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, Spark deletes the shuffle files of a query as soon as it is done.

    Left alone, it does that once the driver has collected the query's plan, whatever the disks
    hold. Threads may overlap: the setting goes back when the last one is done.
    """
    session = spark._jsparkSession.sessionUUID()
    with _writers_lock:
        n, before = _writers.get(session, (0, None))
        before = before if n else spark.conf.get(_FILE_CLEANUP)
        spark.conf.set(_FILE_CLEANUP, "true")
        _writers[session] = n + 1, before
    try:
        yield
    finally:
        with _writers_lock:
            n, before = _writers.pop(session)
            if n > 1:
                _writers[session] = n - 1, before
            else:
                spark.conf.set(_FILE_CLEANUP, before)


@dataclass(frozen=True)
class Layout:
    """Folder layout and file format of a set of tables.

    ``format`` is any batch source the cluster has installed. ``write_options`` go to the
    writer as they are, for formats that need an option to replace a table's schema, or to have
    the dictionaries of parquet back that ``write`` leaves out (``PLAIN``).
    """

    base: str
    format: str = "parquet"
    pattern: str = "{base}/{layer}/{table}"
    tables: Mapping[str, str] = field(default_factory=lambda: ENTITY_TABLES)
    write_options: Mapping[str, str] = field(default_factory=dict)

    #: Whether a table can be replaced part by part (``write_parts``).
    in_parts: ClassVar[bool] = True

    def path(self, layer: str, entity: str) -> str:
        if entity not in self.tables:
            raise ValueError(f"no table for {entity!r}; known: {', '.join(self.tables)}")
        return self.pattern.format(
            base=self.base.rstrip("/"), layer=layer, table=self.tables[entity]
        )

    def read(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        return spark.read.format(self.format).load(self.path(layer, entity))

    def read_counts(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        """The table, to count its rows and the values of its columns.

        Parquet and ORC files have these counts in their footers. Spark takes them from there, in
        place of the columns, where the file source is one of the second version and aggregates
        are pushed down (``spark.sql.parquet.aggregatePushdown``, which this sets). Footers
        without counts make Spark read the columns.
        """
        if self.format not in ("parquet", "orc"):
            return self.read(spark, layer, entity)
        spark.conf.set(f"spark.sql.{self.format}.aggregatePushdown", "true")
        first = spark.conf.get(_FIRST_VERSION)
        spark.conf.set(_FIRST_VERSION, ",".join(f for f in first.split(",") if f != self.format))
        try:
            return self.read(spark, layer, entity)
        finally:
            spark.conf.set(_FIRST_VERSION, first)

    def write(self, df: DataFrame, layer: str, entity: str) -> None:
        """Replace the table, schema included."""
        self.write_parts([df], layer, entity)

    def write_parts(self, parts: Iterable[DataFrame], layer: str, entity: str) -> None:
        """Replace the table, schema included, by the rows of several frames, written one after another."""
        options = {**PLAIN.get(self.format, {}), **self.write_options}
        mode = "overwrite"
        for df in parts:
            with shuffles_dropped(df.sparkSession):
                df.write.format(self.format).mode(mode).options(**options).save(self.path(layer, entity))
            mode = "append"


def write_all(layout: Layout, tables: Mapping[str, DataFrame], layer: str) -> None:
    """Replace several tables of a layer. They share nothing, so all are submitted at once."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        for job in [pool.submit(layout.write, df, layer, entity) for entity, df in tables.items()]:
            job.result()


@dataclass(frozen=True)
class VersionedLayout(Layout):
    """Tables of plain files that are replaced as a whole or not at all.

    A write goes to a folder of its own, and one small file that names the table's folder is
    switched last. Until then, and for good if the write fails, readers get the old rows; readers
    that began before the switch keep the old files, of which the last ``keep`` versions stay. Of
    two writers at a time, the last to finish counts.
    """

    keep: int = 1
    in_parts: ClassVar[bool] = False

    def _versions(self, spark: SparkSession, layer: str, entity: str) -> list[str]:
        """The current version and those before it that are kept."""
        return (read_text(spark, f"{self.path(layer, entity)}/current") or "").split()

    def read(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        versions = self._versions(spark, layer, entity)
        if not versions:
            raise FileNotFoundError(f"no table was written to {self.path(layer, entity)}")
        return spark.read.format(self.format).load(f"{self.path(layer, entity)}/{versions[0]}")

    def write(self, df: DataFrame, layer: str, entity: str) -> None:
        spark, base = df.sparkSession, self.path(layer, entity)
        version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        df.write.format(self.format).options(**self.write_options).save(f"{base}/{version}")
        versions = [version, *self._versions(spark, layer, entity)]
        switch_text(spark, f"{base}/current", "\n".join(versions[: 1 + self.keep]))
        for older in versions[1 + self.keep :]:
            drop_folder(spark, f"{base}/{older}")

    def prune(self, spark: SparkSession, layer: str, entity: str) -> None:
        """Delete what failed writes left. Not while another write is going on."""
        base, known = self.path(layer, entity), self._versions(spark, layer, entity)
        for version in subfolders(spark, base):
            if version not in known:
                drop_folder(spark, f"{base}/{version}")


# The raw column that is the key of each entity's rows.
ENTITY_KEYS = {
    "bank": "integration_key",
    "branch": "integration_key",
    "contact": "src_integration_key",
    "account": "int_key",
    "financial_holding": "int_key",
}


@dataclass(frozen=True)
class BucketedLayout(Layout):
    """Tables in buckets by the hash of a key, so that jobs by that key need no shuffle.

    Buckets are known to the session's catalog only, so each table has a name there. A session
    that has not written it registers it from its files, ``buckets`` and ``keys``, which must be those it was written with.
    """

    buckets: int = 200
    keys: Mapping[str, str] = field(default_factory=lambda: ENTITY_KEYS)
    prefix: str = "bucketed"
    in_parts: ClassVar[bool] = False

    def name(self, layer: str, entity: str) -> str:
        place = hashlib.sha256(self.path(layer, entity).encode()).hexdigest()[:16]
        return f"{self.prefix}_{layer}_{entity}_{place}"

    def read(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        name = self.name(layer, entity)
        if not spark.catalog.tableExists(name):
            path = self.path(layer, entity)
            columns = spark.read.format(self.format).load(path).schema
            ddl = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
            spark.sql(
                f"CREATE TABLE {name} ({ddl}) USING {self.format} CLUSTERED BY (`{self.keys[entity]}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return spark.table(name)

    def write(self, df: DataFrame, layer: str, entity: str) -> None:
        """Replace the table. Rows are dealt by key once, here, so that each bucket is one file."""
        key = self.keys[entity]
        dealt = df.repartition(self.buckets, f"`{key}`")
        writer = dealt.write.format(self.format).mode("overwrite").options(**self.write_options)
        writer.bucketBy(self.buckets, key).option("path", self.path(layer, entity)).saveAsTable(self.name(layer, entity))


def scratch_folder(spark: SparkSession, label: str) -> str:
    """Fresh folder for intermediate tables, on storage that all executors share.

    That is below ``spark.checkpoint.dir``, else below the warehouse. On a cluster, a warehouse on
    local disks is refused: each executor would write its part to its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        local = urlparse(base).scheme in ("", "file")
        master = spark.sparkContext.master
        if local and (not master.startswith("local") or master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
