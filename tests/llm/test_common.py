import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clearledger.llm import common


def test_batches_for_python_are_bounded_by_bytes(spark):
    def told(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    tables = common.Tables(spark, "test")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    rows = tables.put(texts.mapInArrow(told, "rows long, bytes long"), "told").collect()
    assert sum(r.rows for r in rows) == 2000
    assert max(r.bytes for r in rows) < 2 * common.BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_rows_of_parquet_files_are_numbered_without_being_written(spark, tmp_path, monkeypatch):
    spark.range(100).selectExpr("id % 7 as doc_id", "'x' as text", "id as file_path", "id as n").repartition(4).write.parquet(f"{tmp_path}/docs")
    tables, wrote = common.Tables(spark, "test"), []
    monkeypatch.setattr(tables, "put", lambda df, name: wrote.append(name) or df.localCheckpoint())
    docs = spark.read.parquet(f"{tmp_path}/docs")
    rows = common.numbered(tables, docs, "row")
    assert rows.columns == [*docs.columns, "row"] and not wrote
    first = {r.n: r.row for r in rows.collect()}
    assert len(first) == len(set(first.values())) == 100
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # other tasks, equal numbers
    try:
        again = common.numbered(tables, spark.read.parquet(f"{tmp_path}/docs"), "row")
        assert {r.n: r.row for r in rows.select("n", "row").collect()} == first and len({r.row for r in again.collect()}) == 100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    twice = docs.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"), "n")  # a file's row is no row of these
    for other in (twice, docs.withColumn("_metadata", F.lit(1)), spark.createDataFrame([(1,)], "n int")):
        assert "row" in common.numbered(tables, other, "row").columns
    assert wrote == ["numbered"] * 3
    assert len({r.row for r in common.numbered(tables, twice, "row").collect()}) == 200
    empty = spark.read.schema("doc_id long, text string").parquet(f"{tmp_path}/docs").filter("false")
    empty.write.parquet(f"{tmp_path}/none")
    assert common.numbered(tables, spark.read.schema(empty.schema).parquet(f"{tmp_path}/none"), "row").count() == 0


def test_intermediate_tables_are_dense(spark, tmp_path):
    table = common.Tables(spark, "test").put(spark.range(10), "ids")
    assert {pq.read_metadata(f.removeprefix("file:").replace("//", "")).row_group(0).column(0).compression for f in table.inputFiles()} == {"ZSTD"}
