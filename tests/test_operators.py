"""Reshaping, de-duplication and defect injection."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearledger.functions.parsing import parse_timestamp
from clearledger.operators import defects
from clearledger.operators.dedup import latest_per_key
from clearledger.operators.reshape import conform, rename, trim_all_strings


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_conform(spark):
    schema = StructType.fromDDL("id STRING NOT NULL, n INT, at TIMESTAMP, gone DECIMAL(10,4)")
    df = spark.createDataFrame([("2", "x", 7, "2020-01-02 03:04:05"), ("?", "y", 8, "?")], "n string, extra string, id int, at string")
    got = conform(df, schema)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schema]
    assert rows_of(got) == [("7", 2, datetime(2020, 1, 2, 3, 4, 5), None), ("8", None, None, None)]


def test_conform_matches_exact_names(spark):
    schema = StructType.fromDDL("bankId STRING, `a.b` STRING")
    df = spark.createDataFrame([("1", "2")], "bankid string, `a.b` string")
    assert rows_of(conform(df, schema)) == [(None, "2")]
    with pytest.raises(ValueError, match="differ in case only"):
        conform(df.select("bankid", F.lit("x").alias("bankId")), schema)


def test_trim_all_strings(spark):
    df = spark.createDataFrame([(" a ", 1, "\tb ")], "x string, n int, `y.z` string")
    assert rows_of(trim_all_strings(df)) == [("a", 1, "\tb")]
    assert trim_all_strings(df).schema == df.schema


def test_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename(df, {"c": "z", "a": "y"}).columns == ["z", "y"]


DATED = [
    ("a", "03/01/2024 10:00", 1),
    ("a", "2023-12-31 00:00:00", 2),
    ("b", None, 3),
    ("b", "unreadable", 4),
    (None, "2020-01-01", 5),
    (None, "2021-01-01", 6),
]


def dated(spark):
    return spark.createDataFrame(DATED, "k string, t string, n int").repartition(4)


def test_latest_orders_by_parsed_time(spark):
    got = latest_per_key(dated(spark), "k", parse_timestamp(F.col("t")), tie_break=["n"])
    assert {(r.k, r.n) for r in got.collect()} == {("a", 1), ("b", 4), (None, 6)}


def test_latest_can_keep_null_keys(spark):
    got = latest_per_key(dated(spark), "k", parse_timestamp(F.col("t")), tie_break=["n"], null_keys="keep")
    assert {(r.k, r.n) for r in got.collect()} == {("a", 1), ("b", 4), (None, 5), (None, 6)}
    with pytest.raises(ValueError):
        latest_per_key(dated(spark), "k", "t", null_keys="drop")


def test_latest_breaks_ties_whatever_the_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("t"), (F.col("id") * 37 % 101).alias("x"), "id")
    results = {
        tuple(rows_of(latest_per_key(df.repartition(n, F.col("id") * n), "k", "t"))) for n in (1, 3, 8)
    }
    assert len(results) == 1
    assert len(next(iter(results))) == 7


def test_latest_with_a_hot_key(spark):
    """A third of the rows share one key; brute force gives the same rows."""
    n = 30_000
    df = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") * 7919 % 10007).alias("t"),
        "id",
    )
    best = {}
    for i in range(n):
        k, t = (-1 if i % 3 == 0 else i % 500), i * 7919 % 10007
        best[k] = max(best.get(k, (-1, -1)), (t, i))
    assert {r.k: (r.t, r.id) for r in latest_per_key(df, "k", "t").collect()} == best


def test_latest_with_several_keys_and_a_map_column(spark):
    df = spark.range(40).select(
        (F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), "id", F.create_map(F.lit("x"), F.col("id")).alias("m")
    )
    with pytest.raises(ValueError, match="m; name the columns"):
        latest_per_key(df, ["a", "b"], "id")
    nested = df.withColumn("m", F.array(F.struct("m")))
    with pytest.raises(ValueError, match="m; name the columns"):
        latest_per_key(nested, ["a", "b"], "id")
    got = latest_per_key(df, ["a", "b"], "id", tie_break=["id"]).collect()
    assert sorted(r.id for r in got) == [34, 35, 36, 37, 38, 39]
    assert all(r.m == {"x": r.id} for r in got)


def test_buckets_are_even_and_unrelated(spark):
    df = spark.range(20_000).select(defects.bucket(F.col("id"), 10, 1).alias("a"), defects.bucket(F.col("id"), 10, 2).alias("b"))
    pairs = {(r.a, r.b): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert len(pairs) == 100
    assert 100 < min(pairs.values()) and max(pairs.values()) < 400


def test_bucket_of_negative_and_huge_keys(spark):
    df = spark.createDataFrame([(-5,), (2**62,), (2147483646,), (0,)], "k bigint")
    assert all(0 <= r[0] < 100 for r in df.select(defects.bucket(F.col("k"), 100, 3)).collect())


def test_shares(spark):
    k = F.col("id")
    text = F.lit("Abc")
    df = spark.range(20_000).select(
        defects.blank_out(text, k, 30, 1).isNull().cast("int").alias("blank"),
        defects.pad_spaces(text, k, 2).alias("padded"),
        defects.vary_case(text, k, 3).alias("cased"),
    )
    n = 20_000
    row = df.agg(
        F.sum("blank"),
        F.count_if(F.col("padded") == "  Abc  "),
        F.count_if(F.col("padded") == " Abc"),
        F.count_if(F.col("cased") == "ABC"),
        F.count_if(F.col("cased") == "abc"),
    ).first()
    assert [round(x / n, 2) for x in row] == pytest.approx([0.30, 0.20, 0.08, 0.15, 0.10], abs=0.02)


def test_copies(spark):
    df = spark.range(200).select("id", F.lit(0).alias("t"))
    got = defects.add_newer_copies(df, F.when(F.col("id") % 20 == 0, 1).otherwise(0), "t", lambda copy: copy * 10)
    assert got.columns == ["id", "t"]
    assert got.count() == 210
    assert rows_of(got.filter("id = 20")) == [(20, 0), (20, 10)]
    assert latest_per_key(got, "id", "t").filter("t = 10").count() == 10


def test_poisson_counts(spark):
    """Counts by inverse distribution are spread as the distribution says."""
    limits = defects.poisson_thresholds(0.5)
    assert limits[0] == round(1e6 * 0.60653066) and limits == sorted(limits) and limits[-1] == 1_000_000
    assert defects.poisson_thresholds(0.0)[0] == 1_000_000
    n = 200_000
    counts = spark.range(n).select(defects.poisson_count(F.col("id"), 0.5, 3).alias("c")).groupBy("c").count().collect()
    shares = {r.c: r["count"] / n for r in counts}
    assert abs(sum(c * s for c, s in shares.items()) - 0.5) < 0.01 and abs(shares[0] - 0.6065) < 0.01 and abs(shares[2] - 0.0758) < 0.01


def test_copies_with_replacement_include_copies_of_copies(spark):
    rows = spark.range(50_000).withColumn("t", F.lit(0))
    made = defects.add_copies_with_replacement(rows, F.col("id"), 0.3, "t", lambda a, b: a * 100 + b, salt=4)
    assert made.filter("t = 0").count() == 50_000
    first, second = made.filter("t > 0 and t % 100 = 0").count(), made.filter("t % 100 > 0").count()
    assert abs(first / 50_000 - 0.3) < 0.02 and abs(second / first - 0.3) < 0.05
    assert made.groupBy("id", "t").count().filter("count > 1").isEmpty()
