"""Session settings and their sizing."""

import os
import subprocess
import sys
from pathlib import Path

from clearledger import session

GB, TB = 1024**3, 1024**4


def sizes(input_bytes, cores, **caps):
    settings = session.shuffle_settings(input_bytes, cores, **caps)
    return [int(settings[f"spark.sql.{k}"]) for k in ("shuffle.partitions", "adaptive.advisoryPartitionSizeInBytes", "files.maxPartitionBytes")]


def test_required_settings_reach_a_foreign_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "EXCEPTION")
    session.require(spark)
    assert {k: spark.conf.get(k) for k in session.REQUIRED} == session.REQUIRED


def test_required_settings_reach_a_session_that_has_none(spark):
    for key in session.REQUIRED:
        spark.conf.unset(key)
    session.require(spark)
    assert {k: spark.conf.get(k) for k in session.REQUIRED} == session.REQUIRED


def test_entry_and_a_query_run_on_a_bare_session():
    code = """
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.entry(spark).count(), contract.queries()["parse_date"](spark, contract.SMOKE_DIR).count())
"""
    root = Path(__file__).resolve().parents[1]
    env = os.environ | {"PYTHONPATH": str(root)}
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    rows = [x for x in done.stdout.splitlines() if x.startswith("rows ")][0].split()[1:]
    assert all(int(n) > 0 for n in rows)


def test_caps_are_arguments():
    assert sizes(100 * TB, 8000, max_partitions=400_000)[0] == 400_000
    assert sizes(100 * TB, 8000, max_scan_tasks=1_000_000)[2] == 256 * 1024**2


def test_small_partitions_are_merged_before_writing(spark, tmp_path):
    settings = session.shuffle_settings(1, 8)
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        spark.range(20_000).selectExpr("id % 5000 AS k").groupBy("k").count().write.parquet(str(tmp_path / "t"))
        assert len(list((tmp_path / "t").glob("part-*"))) == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_small_inputs_get_two_waves():
    assert sizes(1, 8) == [16, 256 * 1024**2, 256 * 1024**2]


def test_large_inputs_get_larger_partitions_not_ever_more():
    partitions, _, split = sizes(10 * TB, 8000)
    assert (partitions, split) == (32_000, 256 * 1024**2)
    partitions, _, split = sizes(100 * TB, 8000)
    assert partitions == 32_000
    assert GB < split < 1.1 * GB
