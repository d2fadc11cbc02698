import time
import uuid
from threading import Barrier
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clearledger.functions import parsing
from clearledger.plans import entities
from clearledger.sources import layers
from clearledger.sources.layers import Layout, VersionedLayout, write_all
from clearledger.workload import bronze, queries


def test_run_all_stored_runs_on_every_call(monkeypatch):
    runs = []
    monkeypatch.setattr(queries, "_STORED", {})
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, label: f"folder{len(runs)}")
    monkeypatch.setattr(queries, "bronze_tables", lambda spark, sf_dir: {})
    monkeypatch.setattr(queries, "run_all", lambda spark, layout: runs.append(layout.base))
    reports = lambda spark, layout: {"layer_compare": layout.base, "completeness": layout.base}
    monkeypatch.setattr(queries.quality, "stored_reports", reports)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app"))
    assert [queries.stored_completeness(spark, "sf") for _ in range(2)] == ["folder0"] * 2
    assert [queries.run_all_stored(spark, "sf") for _ in range(2)] == ["folder1", "folder2"]
    assert runs == ["folder0", "folder1", "folder2"]


def test_tables_of_a_layer_are_written_at_once():
    both = Barrier(2)
    layout = SimpleNamespace(write=lambda df, layer, entity: both.wait(timeout=10))
    write_all(layout, {"bank": None, "branch": None}, "bronze")


def test_a_failed_write_of_a_layer_is_not_lost():
    def fail(df, layer, entity):
        raise OSError(entity)

    with pytest.raises(OSError, match="bank"):
        write_all(SimpleNamespace(write=fail), {"bank": None}, "bronze")


def parts_of(folder):
    files = [pq.read_metadata(f) for f in folder.glob("*.parquet")]
    return [m.row_group(g).column(c) for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)]


def test_stored_texts_and_times_are_written_plain(spark, tmp_path):
    df = spark.range(100).select(F.lit("same").alias("text"), F.timestamp_seconds("id").alias("time"))
    Layout(str(tmp_path)).write(df, "bronze", "bank")
    found = parts_of(tmp_path / "bronze" / "Bank")
    assert found and not any("DICTIONARY" in e for c in found for e in c.encodings)
    assert sorted(Layout(str(tmp_path)).read(spark, "bronze", "bank").collect()) == sorted(df.collect())


def test_write_options_bring_dictionaries_back(spark, tmp_path):
    df = spark.range(100).select(F.lit("same").alias("text"))
    Layout(str(tmp_path), write_options={"parquet.enable.dictionary": "true"}).write(df, "bronze", "bank")
    assert all(any("DICTIONARY" in e for e in c.encodings) for c in parts_of(tmp_path / "bronze" / "Bank"))


@pytest.mark.parametrize("entity", bronze.BRONZE)
def test_raw_texts_are_made_after_rows_multiply(spark, sf_dir, entity):
    plan = bronze.BRONZE[entity](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("Generate explode") :]
    assert "date_format" not in before and "concat" not in before


def test_one_match_tells_all_layouts_of_a_length(spark):
    found, rest = parsing._classified(F.col("c"), parsing.TIMESTAMP_FORMATS, "timestamp")
    lengths = {len(x.shape) for fmt in parsing.TIMESTAMP_FORMATS for x in parsing.layouts(fmt)}
    assert not rest and str(found).upper().count("RLIKE") == len(lengths)


def test_stored_files_are_dense(spark, tmp_path):
    Layout(str(tmp_path)).write(spark.range(100), "bronze", "bank")
    Layout(str(tmp_path), write_options={"compression": "snappy"}).write(spark.range(100), "silver", "bank")
    codecs = lambda layer: {c.compression for c in parts_of(tmp_path / layer / "Bank")}
    assert codecs("bronze") == {"ZSTD"} and codecs("silver") == {"SNAPPY"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_once_a_table_is_written(spark, tmp_path):
    before, at_first = spark.conf.get(layers._FILE_CLEANUP), shuffle_files(spark)
    layout, dealt = Layout(str(tmp_path)), spark.range(1000).repartition(5, "id")
    write_all(layout, {"bank": dealt, "branch": dealt}, "bronze")
    until = time.time() + 20  # Spark deletes them in the background
    while (left := shuffle_files(spark) - at_first) and time.time() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(layers._FILE_CLEANUP) == before
    assert layout.read(spark, "bronze", "bank").count() == layout.read(spark, "bronze", "branch").count() == 1000


def raw_holdings(spark, n=3000):
    """Raw holdings of which a tenth has no key, and two of three rows share theirs."""
    k = [F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), (F.col("id") % (n // 3)).cast("string"))).alias("int_key")]
    spec = entities.ENTITIES["financial_holding"]
    others = [c for c in [*spec.raw_columns, spec.modified] if c != "int_key"]
    times = F.date_format(F.timestamp_seconds(F.col("id") % 700 * 86400 + 10**9), "yyyy-MM-dd HH:mm:ss")
    return spark.range(n).select(*k, *[(times if c == spec.modified else F.concat(F.lit(c), "id")).alias(c) for c in others])


@pytest.mark.parametrize("null_keys", ["collapse", "keep"])
def test_large_tables_are_cleaned_in_slices_of_their_keys(spark, tmp_path, monkeypatch, null_keys):
    raw, layout = raw_holdings(spark), Layout(str(tmp_path))
    layout.write(raw, "bronze", "financial_holding")
    stored = layout.read(spark, "bronze", "financial_holding")
    assert len(entities.slices(stored, "int_key")) == 1
    monkeypatch.setattr(entities, "SLICE_BYTES", 1000)
    parts = entities.slices(stored, "int_key")
    assert len(parts) == entities.MOST_SLICES and all(0 < p.count() < 3000 for p in parts)
    assert sum(p.count() for p in parts) == 3000
    written = entities.run_entity(spark, layout, "financial_holding", null_keys)
    want = entities.clean_entity(raw, "financial_holding", null_keys).collect()
    assert sorted(map(repr, written.table.collect())) == sorted(map(repr, want))
    assert written.n_rows == len(want) and written.n_filled["financialHoldingId"] == sum(r.financialHoldingId is not None for r in want)
    assert entities.run_entity(spark, layout, "financial_holding", null_keys).n_rows == len(want)  # replaced, not appended to
    assert layout.read(spark, "silver", "financial_holding").count() == len(want)


def test_tables_that_are_replaced_as_a_whole_are_not_sliced(spark, tmp_path, monkeypatch):
    layout = VersionedLayout(str(tmp_path))
    layout.write(raw_holdings(spark, 300), "bronze", "financial_holding")
    monkeypatch.setattr(entities, "SLICE_BYTES", 1000)
    written = entities.run_entity(spark, layout, "financial_holding")
    assert written.n_rows == written.table.count() == len(raw_holdings(spark, 300).select("int_key").distinct().collect())


@pytest.mark.parametrize("name", ["run_all_stored", "run_all_profile"])
def test_stored_tables_go_when_the_report_is_made(spark, sf_dir, tmp_path, monkeypatch, name):
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    rows = queries.REGISTRY[name](spark, sf_dir)
    assert not [f for f in tmp_path.rglob("*") if f.is_file()]
    assert rows.count() == {"run_all_stored": 5, "run_all_profile": 90}[name]
