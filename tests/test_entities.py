"""Entity jobs: target schema, plan shape, stored layers."""

import re

import pytest
from pyspark.sql import functions as F

from clearledger.operators.defects import add_newer_copies
from clearledger.plans.entities import DEFAULTED, ENTITIES, clean_entity, run_all
from clearledger.plans.quality import key_counts, stored_reports
from clearledger.schemas import required_fields, target_schema
from clearledger.sources.layers import ENTITY_TABLES, Layout, scratch_folder
from clearledger.workload.bronze import bronze_tables

WIDTHS = {"bank": 18, "branch": 19, "contact": 18, "account": 15, "financial_holding": 20}


@pytest.fixture(scope="module")
def raw_layout(spark, sf_dir, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("layers")))
    for entity, df in bronze_tables(spark, sf_dir).items():
        layout.write(df, "bronze", entity)
    return layout


def test_registry(spark):
    assert list(ENTITIES) == list(ENTITY_TABLES) == list(DEFAULTED) == list(WIDTHS)
    for entity, width in WIDTHS.items():
        schema = target_schema(entity)
        assert len(schema) == width
        assert len(required_fields(schema)) == 2
        assert set(ENTITIES[entity].fields) <= set(schema.names)
    with pytest.raises(ValueError):
        target_schema("loan")
    with pytest.raises(ValueError):
        Layout("/x").path("bronze", "loan")


def test_paths():
    layout = Layout("/data/", format="orc")
    assert layout.path("silver", "financial_holding") == "/data/silver/FinancialHolding"


def raw_strings(spark, entity):
    """Six empty rows of a bronze table, two per key."""
    spec = ENTITIES[entity]
    names = [*spec.raw_columns, spec.modified]
    empty = spark.range(6).select("id", *[F.lit(None).cast("string").alias(n) for n in names])
    return empty.withColumn(spec.key, (F.col("id") % 3).cast("string")).drop("id")


@pytest.mark.parametrize("entity", list(WIDTHS))
def test_clean_fits_the_target(spark, entity):
    got = clean_entity(raw_strings(spark, entity), entity)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in target_schema(entity)]
    rows = got.collect()
    assert sorted(r.integrationKey for r in rows) == ["0", "1", "2"]
    assert {r.statecode_display for r in rows} == {"Active"}


@pytest.mark.parametrize("entity", list(WIDTHS))
def test_plan_has_one_shuffle_behind_a_partial_top_one(spark, raw_layout, entity):
    df = clean_entity(raw_layout.read(spark, "bronze", entity), entity)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_plan_reads_only_mapped_columns(spark, raw_layout):
    wide = raw_layout.read(spark, "bronze", "contact").withColumn("unused", F.lit("x"))
    plan = clean_entity(wide, "contact")._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan


def test_bucketed_table_needs_no_shuffle(spark, raw_layout, tmp_path):
    raw = raw_layout.read(spark, "bronze", "contact")
    writer = raw.write.bucketBy(4, "src_integration_key").option("path", str(tmp_path / "bucketed"))
    writer.mode("overwrite").saveAsTable("bucketed_contact")
    try:
        clean = clean_entity(spark.table("bucketed_contact"), "contact")
        assert "Exchange" not in clean._jdf.queryExecution().executedPlan().toString()
        assert clean.exceptAll(clean_entity(raw, "contact")).count() == 0
        assert clean.count() == raw.select("src_integration_key").distinct().count()
    finally:
        spark.sql("DROP TABLE bucketed_contact")


def test_run_all_stores_clean_tables(spark, raw_layout):
    written = run_all(spark, raw_layout)
    assert list(written) == list(WIDTHS)
    for entity, result in written.items():
        raw = raw_layout.read(spark, "bronze", entity)
        clean = clean_entity(raw, entity)
        assert result.table.schema.names == target_schema(entity).names
        assert result.n_rows == result.table.count() == raw.select(ENTITIES[entity].key).distinct().count()
        counted = result.table.agg(*[F.count(c).alias(c) for c in clean.columns]).first().asDict()
        assert result.n_filled == counted
        assert result.table.exceptAll(clean).count() == 0
    reports = stored_reports(spark, raw_layout)
    assert reports["required_violations"].count() == 0
    assert reports["completeness"].count() == sum(WIDTHS.values())
    compliance = reports["schema_compliance"]
    assert compliance.count() == compliance.filter("is_expected AND is_present AND type_ok").count() == 90
    summary = {(r.layer, r.entity): r for r in reports["layer_summary"].collect()}
    assert len(summary) == 10
    assert summary["silver", "bank"].path == raw_layout.path("silver", "bank")
    assert {r.note for r in reports["layer_compare"].collect()} <= {"deduplicated", "no duplicates"}


def test_known_counts(spark):
    """Six bank rows become 5, and 210 contact rows 200: the copies go, the keys stay."""
    for entity, keys, copies in (("bank", 5, F.col("id") == 0), ("contact", 200, F.col("id") % 20 == 0)):
        spec = ENTITIES[entity]
        names = [n for n in (*spec.raw_columns, spec.modified) if n not in (spec.key, spec.modified)]
        base = spark.range(keys).select(
            "id",
            F.concat(F.lit("K-"), "id").alias(spec.key),
            F.lit("2021-01-01 00:00:00").alias(spec.modified),
            *[F.lit(" x ").alias(n) for n in names],
        )
        raw = add_newer_copies(base, copies.cast("int"), spec.modified, lambda _: F.lit("03/01/2024 10:00")).drop("id")
        clean = clean_entity(raw, entity)
        assert raw.count() - clean.count() == raw.count() - keys == {"bank": 1, "contact": 10}[entity]
        assert clean.filter("year(modifiedOn) = 2024").count() == {"bank": 1, "contact": 10}[entity]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    layout = Layout(str(tmp_path), format=fmt)
    df = spark.createDataFrame([("1", "a")], "id string, x string")
    layout.write(df, "bronze", "bank")
    layout.write(df.drop("x"), "bronze", "bank")
    assert [tuple(r) for r in layout.read(spark, "bronze", "bank").collect()] == [("1",)]


class OtherSession:
    """As much of a session as ``scratch_folder`` asks for."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_is_fresh_and_shared(spark):
    a, b = scratch_folder(spark, "t"), scratch_folder(spark, "t")
    assert a != b
    shared = {"spark.checkpoint.dir": "file:///shared/", "spark.sql.warehouse.dir": "/local"}
    for master in ("local[2]", "yarn", "local-cluster[2,1,512]"):
        assert scratch_folder(OtherSession(master, **shared), "t").startswith("file:///shared/t-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,512]"])
def test_scratch_folder_on_local_disks_is_refused_on_a_cluster(master):
    for local in ("/home/warehouse", "file:/home/warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(OtherSession(master, **{"spark.sql.warehouse.dir": local}), "t")
        assert scratch_folder(OtherSession("local[4]", **{"spark.sql.warehouse.dir": local}), "t").startswith(local)
    assert scratch_folder(OtherSession(master, **{"spark.sql.warehouse.dir": "s3a://b/w"}), "t").startswith("s3a://b/w/")


def test_null_keys_can_be_kept(spark, raw_layout):
    raw = raw_layout.read(spark, "bronze", "contact")
    lost = raw.filter("src_integration_key IS NULL").count()
    kept = clean_entity(raw, "contact", null_keys="keep")
    assert lost > 1
    assert kept.count() == clean_entity(raw, "contact").count() + lost - 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(re.findall(r"\bExchange\b", plan)) == 1


def test_key_counts_shuffle_only_the_key(spark, raw_layout):
    raw = {e: raw_layout.read(spark, "bronze", e) for e in ENTITIES}
    for entity, df in raw.items():
        plan = key_counts({entity: df})._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [f"{ENTITIES[entity].key}:string"]
    for r in key_counts(raw).collect():
        assert (r.n_raw, r.n_clean) == (raw[r.entity].count(), clean_entity(raw[r.entity], r.entity).count())
        assert r.n_null_keys == raw[r.entity].filter(F.col(ENTITIES[r.entity].key).isNull()).count()
    empty = key_counts({"bank": raw["bank"].limit(0)}).first()
    assert (empty.n_raw, empty.n_clean, empty.n_null_keys) == (0, 0, 0)
