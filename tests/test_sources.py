"""Versioned, bucketed and keyed tables, counts from footers, divided writes."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearledger.operators import rejects
from clearledger.operators.dedup import latest_per_key
from clearledger.plans import quality
from clearledger.plans.entities import clean_entity, merge_entity, run_divided
from clearledger.schemas import target_schema
from clearledger.sources.keyed import KeyedTable
from clearledger.sources.layers import BucketedLayout, Layout, VersionedLayout
from clearledger.sources.switch import read_text, subfolders, switch_text
from clearledger.workload.bronze import bronze_account, bronze_contact
from clearledger.workload.queries import untidy_account
from clearledger.operators.reshape import conform


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def failing(spark, n=1000):
    """Rows of which one fails, after others have been written."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(bad.alias("id"))


def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    layout = VersionedLayout(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        layout.read(spark, "silver", "bank")
    layout.write(spark.range(3), "silver", "bank")
    with pytest.raises(Exception, match="lost"):
        layout.write(failing(spark), "silver", "bank")
    assert rows_of(layout.read(spark, "silver", "bank")) == rows_of(spark.range(3))
    old = layout.read(spark, "silver", "bank")
    layout.write(spark.range(5).withColumn("more", F.lit("x")), "silver", "bank")
    assert old.count() == 3  # a reader that began before the switch
    assert layout.read(spark, "silver", "bank").columns == ["id", "more"]
    for n in range(3):
        layout.write(spark.range(n), "silver", "bank")
    assert layout.read(spark, "silver", "bank").count() == 2
    layout.prune(spark, "silver", "bank")
    assert len(subfolders(spark, layout.path("silver", "bank"))) == 2  # the current one and one before
    assert layout.read(spark, "silver", "bank").count() == 2


def test_switched_text(spark, tmp_path):
    file = f"{tmp_path}/a/pointer"
    assert read_text(spark, file) is None
    for text in ("one", "two ü", ""):
        switch_text(spark, file, text)
        assert read_text(spark, file) == text
    assert [f.name for f in Path(f"{tmp_path}/a").iterdir() if not f.name.startswith(".")] == ["pointer"]


def test_bucketed_bronze_needs_no_exchange(spark, sf_dir, tmp_path):
    raw = bronze_contact(spark, sf_dir)
    layout = BucketedLayout(str(tmp_path), buckets=4)
    layout.write(raw, "bronze", "contact")
    stored = layout.read(spark, "bronze", "contact")
    for null_keys in ("collapse", "keep"):
        clean = clean_entity(stored, "contact", null_keys)
        assert "Exchange" not in plan_of(clean)
        assert "Exchange" in plan_of(clean_entity(raw, "contact", null_keys))
    assert rows_of(clean_entity(stored, "contact")) == rows_of(clean_entity(raw, "contact"))
    spark.sql(f"DROP TABLE {layout.name('bronze', 'contact')}")  # another session, with the files alone
    again = clean_entity(layout.read(spark, "bronze", "contact"), "contact")
    assert "Exchange" not in plan_of(again) and again.count() == clean_entity(raw, "contact").count()
    layout.write(raw.limit(0), "bronze", "contact")
    assert layout.read(spark, "bronze", "contact").count() == 0


def test_counts_come_from_footers(spark, tmp_path):
    layout = Layout(str(tmp_path))
    rows = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), F.lit("x").alias("b"))
    layout.write(rows, "silver", "bank")
    counted = layout.read_counts(spark, "silver", "bank")
    report = quality.completeness({"bank": counted})
    plan = plan_of(report)
    assert "PushedAggregation: [COUNT(*), COUNT(a), COUNT(b)]" in plan
    assert rows_of(report) == rows_of(quality.completeness({"bank": rows}))
    assert "BatchScan" not in plan_of(layout.read(spark, "silver", "bank"))  # other reads are as before
    summary = quality.layer_summary({"silver": {"bank": counted}})
    assert "PushedAggregation: [COUNT(*)]" in plan_of(summary) and summary.first().n_rows == 1000


def test_all_stored_counts_are_pushed(spark, sf_dir, tmp_path):
    layout = Layout(str(tmp_path), tables={"account": "Account"})
    layout.write(bronze_account(spark, sf_dir), "bronze", "account")
    layout.write(clean_entity(bronze_account(spark, sf_dir), "account"), "silver", "account")
    reports = quality.stored_reports(spark, layout)
    for name in ("completeness", "required_violations", "layer_summary"):
        plan = plan_of(reports[name])
        assert plan.count("PushedAggregation: [COUNT") == plan.count("BatchScan") > 0, name


def test_accepted_and_rejected_rows_are_the_input(spark, sf_dir, tmp_path):
    schema = target_schema("account")
    rows = conform(untidy_account(spark, sf_dir), schema)
    found = rejects.write_divided(rejects.divided(rows, schema), f"{tmp_path}/divided")
    assert rows_of(found.accepted.union(found.rejected.drop("missing_fields"))) == rows_of(rows)
    assert found.rejected.count() == rows.filter("statecode is null").count() > 0
    assert {tuple(r.missing_fields) for r in found.rejected.collect()} == {("statecode",)}
    for df in (found.accepted, found.rejected):
        assert "PartitionFilters: [isnotnull(rejected" in plan_of(df)  # reads its own subfolder only
    none = rejects.write_divided(rejects.divided(rows.limit(0), schema), f"{tmp_path}/none")
    assert none.accepted.count() == none.rejected.count() == 0
    clean = run_divided(spark, bronze_account(spark, sf_dir), "account", f"{tmp_path}/clean")
    assert rows_of(clean.accepted) == rows_of(clean_entity(bronze_account(spark, sf_dir), "account"))


def newest(rows):
    return latest_per_key(rows, "k", "t")


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "k string, t long")


def test_batches_give_what_one_run_gives(spark, sf_dir, tmp_path):
    raw = bronze_contact(spark, sf_dir).withColumn("n", F.monotonically_increasing_id())
    table = None
    for i in (2, 0, 1):  # in any order
        table = merge_entity(spark, str(tmp_path), raw.filter(F.col("n") % 3 == i).drop("n"), "contact", n_parts=8)
    assert rows_of(table.read(spark)) == rows_of(clean_entity(raw.drop("n"), "contact"))
    again = merge_entity(spark, str(tmp_path), raw.drop("n"), "contact", n_parts=8)
    assert rows_of(again.read(spark)) == rows_of(clean_entity(raw.drop("n"), "contact"))


def test_only_parts_with_new_keys_are_rewritten(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/t", ("k",), 16)
    first = keyed(spark, [(f"k{i}", i) for i in range(200)] + [(None, 5)])
    assert len(table.merge(spark, first, newest)) == 16
    before = {p: {f.name: f.stat().st_mtime_ns for f in Path(d).iterdir()} for p, d in table.files(spark).items()}
    batch = keyed(spark, [("k3", 999), ("k3", 1), ("fresh", 7), ("k4", 0)])
    touched = table.merge(spark, batch, newest)
    assert 1 <= len(touched) <= 3
    after = {p: {f.name: f.stat().st_mtime_ns for f in Path(d).iterdir()} for p, d in table.files(spark).items()}
    assert {p for p in before if before[p] != after[p]} == set(touched)
    assert rows_of(table.read(spark)) == rows_of(newest(first.union(batch)))
    table.prune(spark)
    assert rows_of(table.read(spark)) == rows_of(newest(first.union(batch)))
    assert sum(len(subfolders(spark, f"{tmp_path}/t/{v}")) for v in subfolders(spark, f"{tmp_path}/t")) == 16


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/t", ("k",), 4)
    with pytest.raises(ValueError, match="nothing was written"):
        table.read(spark)
    table.merge(spark, keyed(spark, [("a", 1), ("b", 2)]), newest)
    bad = keyed(spark, [("a", 9), ("c", 3)])
    with pytest.raises(Exception, match="lost"):
        table.merge(spark, bad, lambda rows: newest(rows).withColumn("t", F.when(F.col("k") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("t"))))
    assert rows_of(table.read(spark)) == rows_of(keyed(spark, [("a", 1), ("b", 2)]))
    with pytest.raises(ValueError, match="4 parts"):
        KeyedTable(table.base, ("k",), 5).read(spark)
    with pytest.raises(ValueError, match="other parts"):
        table.replace(spark, bad, [])
    assert json.loads(read_text(spark, f"{table.base}/index.json"))["n_parts"] == 4


def test_an_empty_batch(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/t", ("k",), 4)
    assert table.merge(spark, keyed(spark, []), newest) == []
    assert table.read(spark).count() == 0
    table.merge(spark, keyed(spark, [("a", 1)]), newest)
    assert table.merge(spark, keyed(spark, []), newest) == []
    assert table.read(spark).count() == 1
