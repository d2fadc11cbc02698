"""Registered queries: every operator and job, each over whole tables.

Timestamps leave as TIMESTAMP_NTZ, the type of the driver's tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clearledger import session
from clearledger.functions import codes, parsing, text
from clearledger.operators import defects, rejects, reshape
from clearledger.operators.dedup import latest_per_key
from clearledger.plans import quality
from clearledger.plans.entities import clean_all, clean_entity, merge_entity, run_all
from clearledger.schemas import target_schema
from clearledger.sources.layers import BucketedLayout, Layout, VersionedLayout, drop_folder, scratch_folder, write_all
from clearledger.workload import bronze
from clearledger.workload.bronze import bronze_tables, table

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return wall_clock(fn(session.require(spark), sf_dir))

    REGISTRY[fn.__name__] = run
    return fn


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as the session shows them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


# Sources and sinks


@query
def scan_layer(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query
def write_roundtrip(spark, sf_dir):
    """Write the clean account table as a layer table, then read that."""
    layout = Layout(scratch_folder(spark, "write_roundtrip"))
    layout.write(clean_entity(bronze.bronze_account(spark, sf_dir), "account"), "silver", "account")
    return layout.read(spark, "silver", "account")


# Projections

HOLDING_NAMES = {
    "l_orderkey": "account_ref",
    "l_linenumber": "line_no",
    "l_partkey": "product_ref",
    "l_suppkey": "supplier_ref",
    "l_extendedprice": "balance_amount",
    "l_linestatus": "status",
    "l_shipdate": "opened_on",
}


@query
def project_rename(spark, sf_dir):
    return reshape.rename(table(spark, sf_dir, "lineitem"), HOLDING_NAMES)


def untidy_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account-like table with missing, further, and wrongly typed fields."""
    k = F.col("o_orderkey")
    ordered = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("totalPrice"),
        k.cast("string").alias("accountId"),
        F.col("o_custkey").alias("primaryContactId"),
        F.when(defects.bucket(k, 20, 201) == 0, F.lit("x")).otherwise(F.lit("1")).alias("statecode"),
        F.when(defects.bucket(k, 10, 202) == 0, F.lit("soon")).otherwise(ordered).alias("joinDate"),
        bronze.tenths(k, 250, 203).alias("tenureYears"),
        F.col("o_orderdate").cast("timestamp").alias("createdOn"),
        F.col("o_orderpriority").alias("name"),
    )


@query
def conform_schema(spark, sf_dir):
    return reshape.conform(untidy_account(spark, sf_dir), target_schema("account"))


@query
def trim_all_strings(spark, sf_dir):
    k = F.col("p_partkey")
    padded = table(spark, sf_dir, "part").withColumns(
        {
            name: defects.blank_out(defects.pad_spaces(F.col(name), k, salt), k, 5, salt + 1)
            for salt, name in ((205, "p_name"), (207, "p_brand"), (209, "p_type"))
        }
    )
    return reshape.trim_all_strings(padded)


# Scalar functions

TIME_SHAPES = (
    "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "yyyy/MM/dd",
    "yyyy-MM-dd'T'HH:mm:ss.000'Z'", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy",
    "dd-MM-yyyy", "M/d/yyyy", " yyyy-MM-dd ", "'about 'yyyy", None,
)
DATE_SHAPES = (
    "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "M/d/yyyy", "dd-MM-yyyy",
    "yyyy-MM-dd HH:mm:ss", None,
)


def texts_of_orders(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[column.alias(name) for name, column in columns.items()]
    )


@query
def parse_timestamp(spark, sf_dir):
    k = F.col("o_orderkey")
    time = F.col("o_orderdate") + F.make_dt_interval(
        hours=defects.bucket(k, 24, 211).cast("int"), mins=defects.bucket(k, 60, 212).cast("int")
    )
    raw = texts_of_orders(spark, sf_dir, raw=defects.vary_format(time, k, TIME_SHAPES, 213))
    return raw.withColumn("parsed", parsing.parse_timestamp(F.col("raw")))


@query
def parse_date(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = texts_of_orders(spark, sf_dir, raw=defects.vary_format(F.col("o_orderdate"), k, DATE_SHAPES, 214))
    return raw.withColumn("parsed", parsing.parse_date(F.col("raw")))


@query
def normalize_strings(spark, sf_dir):
    k = F.col("o_orderkey")
    phrase = F.concat(
        F.lit("o'neil Sint-Niklaas "), "o_orderpriority", F.lit(" van Liège "), F.col("o_custkey").cast("string")
    )
    raw = defects.pad_spaces(defects.vary_case(phrase, k, 215), k, 216)
    words = texts_of_orders(spark, sf_dir, raw=defects.blank_out(raw, k, 5, 217))
    c = F.col("raw")
    return words.select(
        "o_orderkey",
        text.trimmed(c).alias("trimmed"),
        text.proper_case(c).alias("proper"),
        text.normalize_email(c).alias("lowered"),
    )


@query
def normalize_currency(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = defects.pad_spaces(defects.vary_spelling(k, bronze.CURRENCY_TEXTS, 218), k, 219)
    df = texts_of_orders(spark, sf_dir, raw=defects.blank_out(raw, k, 5, 220))
    return df.withColumn("currency", text.normalize_currency(F.col("raw")))


@query
def derive_full_name(spark, sf_dir):
    names = bronze.bronze_contact(spark, sf_dir).select(
        "customer_id", "last_modified", "src_integration_key", "full_name", "first_name", "last_name"
    )
    full = text.derive_full_name(F.col("full_name"), F.col("first_name"), F.col("last_name"))
    return names.select("customer_id", "last_modified", "src_integration_key", full.alias("full_name"))


@query
def cast_decimal(spark, sf_dir):
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    amount = bronze.money_text(F.col("l_extendedprice"), k, 221)
    bad = defects.vary_spelling(k, ("abc", "12,5", "", "1.2.3", None, "99999999999999999999"), 223)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(defects.bucket(k, 10, 224) == 0, bad).otherwise(amount).alias("raw"),
    )
    return lines.withColumns(
        {
            "amount": parsing.to_decimal(F.col("raw"), 18, 2),
            "rate": parsing.to_decimal(F.col("raw"), 10, 4),
        }
    )


@query
def normalize_boolean(spark, sf_dir):
    k = F.col("o_orderkey")
    texts = (*bronze.BOOLEAN_TEXTS, "open", "maybe", "")
    df = texts_of_orders(spark, sf_dir, raw=defects.pad_spaces(defects.vary_spelling(k, texts, 225), k, 226))
    return df.withColumn("value", codes.normalize_boolean(F.col("raw")))


# Code sets


@query
def status_block(spark, sf_dir):
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    texts = (*bronze.STATE_TEXTS, "y", "n", "???", "")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        codes.resolve_state(defects.pad_spaces(defects.vary_spelling(k, texts, 227), k, 228)).alias("statecode"),
    )
    return reshape.with_status_labels(lines)


@query
def normalize_country(spark, sf_dir):
    k = F.col("o_orderkey")
    texts = (*bronze.COUNTRY_TEXTS, "at", "Atlantis", "")
    df = texts_of_orders(spark, sf_dir, raw=defects.pad_spaces(defects.vary_spelling(k, texts, 229), k, 230))
    return df.withColumn("country", codes.normalize_country(F.col("raw")))


@query
def account_type(spark, sf_dir):
    k = F.col("o_orderkey")
    texts = (*bronze.ACCOUNT_TYPE_TEXTS, "money market", "PRIVATE wealth", "")
    df = texts_of_orders(spark, sf_dir, raw=defects.pad_spaces(defects.vary_spelling(k, texts, 231), k, 232))
    return df.withColumn("account_type", codes.resolve_account_type(F.col("raw")))


@query
def holding_type(spark, sf_dir):
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    texts = (*bronze.HOLDING_TYPE_TEXTS, "crypto", "")
    raw = defects.pad_spaces(defects.vary_spelling(k, texts, 233), k, 234)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", codes.resolve_holding_type(raw).alias("holding_type")
    )
    return lines.withColumn("label", codes.holding_type_label(F.col("holding_type")))


# De-duplication


@query
def dedup_latest(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def dedup_latest_keep_null_keys(spark, sf_dir):
    """Line items keyed by an order number that a third of the rows lost."""
    lines = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber") + F.col("l_partkey") * 104729
    keyed = lines.withColumn("key", defects.blank_out(F.col("l_orderkey"), k, 33, 235))
    return latest_per_key(keyed, "key", "l_shipdate", null_keys="keep")


# Quality reports


@query
def required_violations(spark, sf_dir):
    """The clean tables, and the untidy account table conformed without any cleaning."""
    account = target_schema("account")
    tables = clean_all(bronze_tables(spark, sf_dir))
    tables["account_untidy"] = reshape.conform(untidy_account(spark, sf_dir), account)
    return quality.required_violations(tables, {"account_untidy": account})


@query
def completeness(spark, sf_dir):
    return quality.completeness(clean_all(bronze_tables(spark, sf_dir)))


@query
def layer_summary(spark, sf_dir):
    """Both layers, the clean one counted by its keys."""
    raw = bronze_tables(spark, sf_dir)
    widths = {
        "bronze": {e: len(df.columns) for e, df in raw.items()},
        "silver": {e: len(target_schema(e)) for e in raw},
    }
    counts = quality.key_counts(raw)
    return quality.summary_of(counts, widths)


@query
def layer_compare(spark, sf_dir):
    return quality.layer_compare(bronze_tables(spark, sf_dir))


@query
def key_counts(spark, sf_dir):
    return quality.key_counts(bronze_tables(spark, sf_dir))


@query
def schema_compliance(spark, sf_dir):
    """The five clean tables, and an account table that is not clean."""
    clean = clean_all(bronze_tables(spark, sf_dir))
    reports = [quality.schema_compliance(df, entity) for entity, df in clean.items()]
    untidy = untidy_account(spark, sf_dir)
    reports.append(quality.schema_compliance(untidy, "account_untidy", target_schema("account")))
    return reduce(DataFrame.unionByName, reports)


@query
def field_profile(spark, sf_dir):
    """All that the reports on fields need, of the clean tables, with each table cleaned once."""
    return quality.profile(clean_all(bronze_tables(spark, sf_dir)))


def divided_account(spark, sf_dir) -> rejects.Divided:
    """The untidy account table, conformed, its rows without a required field apart."""
    schema = target_schema("account")
    rows = reshape.conform(untidy_account(spark, sf_dir), schema)
    return rejects.write_divided(rejects.divided(rows, schema), scratch_folder(spark, "divided"))


@query
def accepted_rows(spark, sf_dir):
    return divided_account(spark, sf_dir).accepted


@query
def rejected_rows(spark, sf_dir):
    found = divided_account(spark, sf_dir).rejected
    return found.withColumn("missing_fields", F.array_join("missing_fields", ","))


@query
def defaulted_codes(spark, sf_dir):
    return quality.defaulted_codes(bronze_tables(spark, sf_dir))


# Entity jobs


@query
def bank_silver(spark, sf_dir):
    return clean_entity(bronze.bronze_bank(spark, sf_dir), "bank")


@query
def branch_silver(spark, sf_dir):
    return clean_entity(bronze.bronze_branch(spark, sf_dir), "branch")


@query
def contact_silver(spark, sf_dir):
    return clean_entity(bronze.bronze_contact(spark, sf_dir), "contact")


@query
def account_silver(spark, sf_dir):
    return clean_entity(bronze.bronze_account(spark, sf_dir), "account")


@query
def holding_silver(spark, sf_dir):
    return clean_entity(bronze.bronze_holding(spark, sf_dir), "financial_holding")


@query
def contact_silver_keep_null_keys(spark, sf_dir):
    return clean_entity(bronze.bronze_contact(spark, sf_dir), "contact", null_keys="keep")


@query
def contact_silver_bucketed(spark, sf_dir):
    """Bronze contacts stored in buckets by their key; cleaning them needs no shuffle."""
    layout = BucketedLayout(scratch_folder(spark, "bucketed"), buckets=8)
    layout.write(bronze.bronze_contact(spark, sf_dir), "bronze", "contact")
    return clean_entity(layout.read(spark, "bronze", "contact"), "contact")


@query
def contact_silver_incremental(spark, sf_dir):
    """Bronze contacts in two batches, each merged into the silver table."""
    raw = bronze.bronze_contact(spark, sf_dir)
    base = scratch_folder(spark, "incremental")
    first = F.coalesce(F.pmod(F.xxhash64("last_modified", "customer_id"), F.lit(3)) > 0, F.lit(True))
    merge_entity(spark, base, raw.filter(first), "contact", n_parts=16)
    return merge_entity(spark, base, raw.filter(~first), "contact", n_parts=16).read(spark)


@query
def account_silver_overwritten(spark, sf_dir):
    """The silver account table over an older one, through versions that are switched."""
    layout = VersionedLayout(scratch_folder(spark, "versions"))
    layout.write(table(spark, sf_dir, "orders"), "silver", "account")
    layout.write(clean_entity(bronze.bronze_account(spark, sf_dir), "account"), "silver", "account")
    return layout.read(spark, "silver", "account")


@query
def all_silver_counts(spark, sf_dir):
    counts = quality.key_counts(bronze_tables(spark, sf_dir))
    return counts.select("entity", F.col("n_clean").alias("n"))


_STORED: dict[tuple[str, str], Layout] = {}


def store(spark: SparkSession, sf_dir: str) -> Layout:
    """Bronze tables and the silver ones that every entity job makes of them, in a fresh folder."""
    layout = Layout(scratch_folder(spark, "stored"))
    write_all(layout, bronze_tables(spark, sf_dir), "bronze")
    run_all(spark, layout)
    return layout


def stored(spark: SparkSession, sf_dir: str) -> Layout:
    """What ``store`` gives, once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        _STORED[key] = store(spark, sf_dir)
    return _STORED[key]


def read_at_once(run: Query) -> Query:
    """A report of few rows, read when it is made; the stored tables, which nothing reads after that, go."""

    def once(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = run(spark, sf_dir)
        folders = {f[: at.end()] for f in report.inputFiles() if (at := re.search(r"/stored-[0-9a-f]{32}(?=/)", f))}
        read = spark.createDataFrame(report.collect(), report.schema)
        for folder in folders:
            drop_folder(spark, folder)
        return read

    return once


@query
def run_all_stored(spark, sf_dir):
    """Store the bronze tables, run every entity job on them, compare the stored layers."""
    return quality.stored_reports(spark, store(spark, sf_dir))["layer_compare"]


REGISTRY["run_all_stored"] = read_at_once(REGISTRY["run_all_stored"])


@query
def run_all_profile(spark, sf_dir):
    """Store the bronze tables, run every entity job, and profile the silver tables from what the
    jobs counted while they wrote. The profile is rows that the driver has, so the stored tables go."""
    layout = Layout(scratch_folder(spark, "profile"))
    write_all(layout, bronze_tables(spark, sf_dir), "bronze")
    found = quality.observed_profile(spark, run_all(spark, layout))
    drop_folder(spark, layout.base)
    return found


@query
def stored_layer_summary(spark, sf_dir):
    return quality.stored_reports(spark, stored(spark, sf_dir))["layer_summary"].drop("path")


@query
def stored_completeness(spark, sf_dir):
    return quality.stored_reports(spark, stored(spark, sf_dir))["completeness"]


@query
def stored_required_violations(spark, sf_dir):
    return quality.stored_reports(spark, stored(spark, sf_dir))["required_violations"]


@query
def stored_schema_compliance(spark, sf_dir):
    return quality.stored_reports(spark, stored(spark, sf_dir))["schema_compliance"]


@query
def stored_defaulted_codes(spark, sf_dir):
    return quality.stored_reports(spark, stored(spark, sf_dir))["defaulted_codes"]


# Defect injection


@query
def inject_dates(spark, sf_dir):
    k = F.col("o_orderkey")
    time = F.col("o_orderdate") + F.make_dt_interval(hours=defects.bucket(k, 24, 236).cast("int"))
    return texts_of_orders(
        spark,
        sf_dir,
        changed=defects.vary_format(time, k, bronze.TIME_TEXTS, 237),
        born=defects.vary_format(time, k, bronze.DATE_TEXTS, 238),
    )


@query
def inject_nulls(spark, sf_dir):
    k = F.col("o_orderkey")
    return texts_of_orders(
        spark,
        sf_dir,
        priority=defects.blank_out(F.col("o_orderpriority"), k, 10, 240),
        price=defects.blank_out(F.col("o_totalprice"), k, 60, 241),
    )


@query
def inject_strings(spark, sf_dir):
    k = F.col("o_orderkey")
    named = F.concat(F.lit("Order "), "o_orderpriority")
    return texts_of_orders(
        spark,
        sf_dir,
        padded=defects.pad_spaces(named, k, 242),
        cased=defects.vary_case(named, k, 243),
        both=defects.pad_spaces(defects.vary_case(named, k, 244), k, 245),
    )


@query
def inject_categories(spark, sf_dir):
    k = F.col("o_orderkey")
    spellings = {
        "state": bronze.STATE_TEXTS,
        "managed": bronze.BOOLEAN_TEXTS,
        "country": bronze.COUNTRY_TEXTS,
        "account_type": bronze.ACCOUNT_TYPE_TEXTS,
        "holding_type": bronze.HOLDING_TYPE_TEXTS,
        "currency": bronze.CURRENCY_TEXTS,
    }
    return texts_of_orders(
        spark,
        sf_dir,
        **{name: defects.vary_spelling(k, list(v), 246 + i) for i, (name, v) in enumerate(spellings.items())},
    )


@query
def inject_duplicates(spark, sf_dir):
    """One later copy of every 20th order, two of every 100th."""
    k = F.col("o_orderkey")
    copies = F.when(F.pmod(k, F.lit(100)) == 0, 2).when(F.pmod(k, F.lit(20)) == 0, 1).otherwise(0)
    return defects.add_newer_copies(
        table(spark, sf_dir, "orders"),
        copies,
        "o_orderdate",
        lambda copy: F.col("o_orderdate") + F.make_dt_interval(copy * 30),
    )


@query
def inject_copies_with_replacement(spark, sf_dir):
    """Later copies of orders, drawn with replacement at an average of one for ten rows."""
    return defects.add_copies_with_replacement(
        table(spark, sf_dir, "orders"), F.col("o_orderkey"), 0.1, "o_orderdate",
        lambda copy, again: F.col("o_orderdate") + F.make_dt_interval(copy * 30 + again), salt=252,
    )
