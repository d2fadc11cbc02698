"""Helpers that the operators share: intermediate tables, bounded memos, hashing of texts."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.sources.layers import DENSE, drop_folder, scratch_folder, shuffles_dropped


#: A batch that goes to Python has about so many bytes, not Spark's 10,000 rows, of which a task would hold all texts several times,
#: in Python and beside the JVM's heap.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def work_folder(spark: SparkSession, label: str) -> str:
    """Fresh folder for intermediate tables, on storage that all executors share; a warehouse on
    local disks is refused on a cluster."""
    return scratch_folder(spark, label)


class Tables:
    """Intermediate tables of one run. A table cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = work_folder(spark, label)
        self.serial = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back. Shuffle files go as soon as it is written."""
        self.serial += 1
        if self.serial % 8 == 0:
            self.release()
        path = f"{self.base}/{self.serial:03d}-{name}"
        before = self.spark.conf.get(_BATCH)
        self.spark.conf.set(_BATCH, BATCH_BYTES)
        try:
            with shuffles_dropped(self.spark):
                df.write.options(**DENSE).parquet(path)
        finally:
            self.spark.conf.set(_BATCH, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def feeds(self, df: DataFrame) -> bool:
        """Whether ``df`` still reads tables of this run."""
        return any(f"/{self.base.rsplit('/', 1)[1]}/" in f for f in df.inputFiles())

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this run that nothing reads any more."""
        for df in tables:
            for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if f"/{self.base.rsplit('/', 1)[1]}/" in f"{parent}/":
                    drop_folder(self.spark, parent)

    def release(self) -> None:
        """Let Spark delete the shuffle files and generated classes of queries that are done: it does
        so once the driver has collected their plans, of which Python objects must have let go. Left alone, it does that
        when its heap is full, whatever the disks hold."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        """Delete the run's folder, when its result has been written elsewhere."""
        drop_folder(self.spark, self.base)


def private(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def numbered(tables: Tables, docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``name``, a number for each row that is the same whenever the rows are read.

    Rows of parquet files have a place of their own, so such a table is not written again: the
    number is that of the file and the row's in it. Any other rows are written with their numbers.
    """
    plan = docs._jdf.queryExecution().analyzed()
    kinds = [plan.getClass().getSimpleName()]
    if kinds == ["LogicalRelation"]:
        kinds.append(plan.relation().getClass().getSimpleName())
    plain = kinds[1:] == ["HadoopFsRelation"] and plan.relation().fileFormat().toString() == "Parquet"
    if not plain or "_metadata" in docs.columns:
        return tables.put(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    file, at = private("file_path", docs), private("row_index", docs)
    place = F.col("_metadata.file_path").alias(file)
    # Files in the order in which Spark reads them.
    order = docs.select(place, F.monotonically_increasing_id().alias("at")).groupBy(file).agg(F.min("at").alias("at")).collect()
    files = [(r[0], k << 33) for k, r in enumerate(sorted(order, key=lambda r: r["at"]))]
    first = F.broadcast(tables.spark.createDataFrame(files, f"`{file}` string, `{name}` long"))
    rows = docs.select("*", place, F.col("_metadata.row_index").alias(at)).join(first, file)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(name) + F.col(at)).alias(name))


class Memo(dict):
    """Results of ``make`` by key: the recent ones, between half of ``limit`` and ``limit``.

    Results of keys longer than 64 are not kept, so the memory is bounded as well.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.old = make, limit // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64:
                return value
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8")).cast("long")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the folds of the labelled data are defined by it."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(modulus))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of text each, at least one row."""
    n = batch.num_rows
    if not n:
        return
    lengths = np.asarray(
        pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    ends = np.cumsum(lengths)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, most_bytes)
