"""Bronze tables of the five entities: columns of the driver's tables with known defects.

supplier -> bank, part -> branch, customer -> contact, orders -> account, lineitem -> holding.
Only the names of the raw columns are given; their values are those of the driver's tables, and
codes run through every spelling that the library knows. There is one rate for each kind of
defect, whatever the field. Each choice depends only on the row's own key (see
``operators.defects``) and the number of its column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.functions import codes, parsing
from clearledger.operators.defects import (
    add_newer_copies,
    blank_out,
    bucket,
    pad_spaces,
    vary_case,
    vary_format,
    vary_spelling,
)
from clearledger.sources.layers import Layout

NULL_PERCENT = 10
KEYLESS_PERCENT = 2
NEWER_EVERY = 20  # rows, of which one has a newer copy
TIED_EVERY = 50  # rows, of which one has a copy changed at the same time
FIRST_SECOND = 788_918_400  # 1995-01-01 in UTC

Make = Callable[[Column, int], Column]


def spellings(known: Mapping[object, tuple[str, ...]]) -> tuple[str | None, ...]:
    """Every synonym as it is, in upper case and capitalised; an unknown text; NULL."""
    words = [w for group in known.values() for w in group]
    return (*dict.fromkeys(v for w in words for v in (w, w.upper(), w.capitalize())), "no such code", None)


BOOLEAN_TEXTS = spellings(codes.BOOLEANS)
STATE_TEXTS = spellings(codes.STATES)
COUNTRY_TEXTS = spellings(codes.COUNTRIES)
ACCOUNT_TYPE_TEXTS = spellings(codes.ACCOUNT_TYPES)
HOLDING_TYPE_TEXTS = spellings(codes.HOLDING_TYPES)
CURRENCY_TEXTS = ("EUR", "usd", "Gbp")
TIME_TEXTS = (*parsing.TIMESTAMP_FORMATS, "dd-MM-yyyy", "'about 'yyyy", None)
DATE_TEXTS = (*parsing.DATE_FORMATS, "M/d/yyyy", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    layout = Layout(sf_dir, pattern="{base}/{table}.parquet", tables={name: name})
    return layout.read(spark, "", name)


def spread(df: DataFrame) -> DataFrame:
    """A scanned table in at least as many partitions as there are cores.

    A table of few files and row groups is a few scan tasks; whatever follows the scan would run in
    them alone. Larger tables, which have more splits than cores, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def tenths(key: Column, n: int, salt: int) -> Column:
    """Text such as 12.7, below ``n`` tenths; unreadable in 1 of 100 rows."""
    value = bucket(key, n, salt)
    text = F.concat(F.floor(value / 10).cast("string"), F.lit("."), (value % 10).cast("string"))
    return F.when(bucket(key, 100, salt + 1) == 0, F.lit("n/a")).otherwise(text)


def money_text(amount: Column, key: Column, salt: int) -> Column:
    """Two-decimal amount as text, with a third digit to round, and a minus in 1 of 10 rows."""
    digits = F.concat(amount.cast("decimal(18,2)").cast("string"), bucket(key, 10, salt).cast("string"))
    return F.when(bucket(key, 10, salt + 1) == 0, F.concat(F.lit("-"), digits)).otherwise(digits)


# Kinds of raw columns. Each makes a column from the row key and the number of the column.


def plain(name: str) -> Make:
    return lambda k, salt: F.col(name).cast("string")


def text(name: str) -> Make:
    def make(k: Column, salt: int) -> Column:
        value = vary_case(F.col(name).cast("string"), k, salt)
        return blank_out(pad_spaces(value, k, salt + 1), k, NULL_PERCENT, salt + 2)

    return make


def code(texts: tuple[str | None, ...]) -> Make:
    return lambda k, salt: pad_spaces(vary_spelling(k, texts, salt), k, salt + 1)


def number(name: str) -> Make:
    def make(k: Column, salt: int) -> Column:
        readable = F.col(name).cast("decimal(18,4)").cast("string")
        return F.when(bucket(k, 100, salt) >= NULL_PERCENT, readable).otherwise(F.lit("n/a"))

    return make


def some_time(k: Column, salt: int) -> Column:
    """A minute within some 27 years from 1995 on."""
    minutes = (bucket(k, 10_000, salt) * 24 + bucket(k, 24, salt + 1)) * 60 + bucket(k, 60, salt + 2)
    return F.timestamp_seconds(minutes * 60 + FIRST_SECOND)


def time(name: str | None = None) -> Make:
    """A time as text in one of the formats; that of a column, or some time."""
    return lambda k, salt: vary_format(F.col(name) if name else some_time(k, salt + 1), k, TIME_TEXTS, salt)


def date() -> Make:
    return lambda k, salt: vary_format(some_time(k, salt + 1), k, DATE_TEXTS, salt)


def _raw(source: DataFrame, number: int, key: Column, id_value: Column, modified: str, key_name: str, columns: Mapping[str, Make]) -> DataFrame:
    """The raw table: its columns, the change time ``modified``, the integration key ``key_name``,
    and copies of some rows."""
    k = F.col("_k")
    first = 1000 * number
    rows = source.withColumn("_k", key.cast("bigint")).withColumn("_first", some_time(k, first)).withColumn("_changed", F.col("_first"))
    newer = F.pmod(k, F.lit(NEWER_EVERY)) == 0
    copies = F.when(newer | (F.pmod(k, F.lit(TIED_EVERY)) == 1), 1).otherwise(0)
    later = F.col("_changed") + F.make_dt_interval((bucket(k, 300, first + 6) + 1).cast("int"))
    # Copies are made of the narrow source, so that the wide row of texts is put together once.
    doubled = add_newer_copies(rows, copies, "_changed", lambda copy: F.when(newer, later).otherwise(F.col("_changed")))
    salted = k + F.when(F.col("_changed") > F.col("_first"), F.lit(1_000_003)).otherwise(F.lit(0))
    return doubled.select(
        *[make(k, first + 10 * i).alias(name) for i, (name, make) in enumerate(columns.items(), 1)],
        vary_format(F.col("_changed"), salted, TIME_TEXTS, first + 7).alias(modified),
        blank_out(id_value.cast("string"), k, KEYLESS_PERCENT, first + 5).alias(key_name),
    )


def bronze_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, nations = spread(table(spark, sf_dir, "supplier")), table(spark, sf_dir, "nation")
    source = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "left")
    columns = {
        "src_bank_id": plain("s_suppkey"), "bank_name": text("s_name"), "bank_code": text("s_nationkey"),
        "address_1": text("s_name"), "address_2": text("n_regionkey"), "city": text("n_name"),
        "province": text("n_name"), "zip_code": text("s_nationkey"), "country_code": code(COUNTRY_TEXTS),
        "phone": text("s_suppkey"), "status": code(STATE_TEXTS), "created_date": time(),
    }
    return _raw(source, 1, F.col("s_suppkey"), F.col("s_suppkey"), "modified_date", "integration_key", columns)


def bronze_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "branch_id": plain("p_partkey"), "fk_bank_id": plain("p_size"), "branch_name": text("p_name"),
        "branch_code": text("p_brand"), "street_address": text("p_type"), "address_line_2": text("p_brand"),
        "city_name": text("p_name"), "state_province": text("p_type"), "postal_code": text("p_size"),
        "country": code(COUNTRY_TEXTS), "phone_number": text("p_partkey"), "is_active": code(STATE_TEXTS),
        "created_at": time(),
    }
    source = spread(table(spark, sf_dir, "part"))
    return _raw(source, 2, F.col("p_partkey"), F.col("p_partkey"), "updated_at", "integration_key", columns)


def bronze_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "customer_id": plain("c_custkey"), "first_name": text("c_mktsegment"), "last_name": text("c_name"),
        "full_name": text("c_name"), "email": text("c_name"), "phone": text("c_custkey"),
        "date_of_birth": date(), "join_date": time(), "tenure": number("c_acctbal"),
        "primary_branch_id": plain("c_nationkey"), "managed_by_system": code(BOOLEAN_TEXTS),
        "is_active": code(STATE_TEXTS), "created_timestamp": time(),
    }
    source = spread(table(spark, sf_dir, "customer"))
    return _raw(source, 3, F.col("c_custkey"), F.col("c_custkey"), "last_modified", "src_integration_key", columns)


def bronze_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The branch of an account is its customer's, found by a join."""
    orders = spread(table(spark, sf_dir, "orders"))
    homes = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    source = orders.join(homes, orders.o_custkey == homes.c_custkey, "left")
    columns = {
        "acct_id": plain("o_orderkey"), "account_number": text("o_orderkey"), "acct_name": text("o_orderpriority"),
        "account_type": code(ACCOUNT_TYPE_TEXTS), "branch_ref": plain("c_nationkey"),
        "primary_contact_ref": plain("o_custkey"), "join_date": time("o_orderdate"),
        "tenure_years": number("o_totalprice"), "status_flag": code(STATE_TEXTS), "created": time("o_orderdate"),
    }
    return _raw(source, 4, F.col("o_orderkey"), F.col("o_orderkey"), "modified", "int_key", columns)


def bronze_holding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items repeat their (order, line) key by themselves; the contact comes from the order."""
    lines = spread(table(spark, sf_dir, "lineitem"))
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    source = lines.join(owners, lines.l_orderkey == owners.o_orderkey, "left")
    reference = F.concat("l_orderkey", F.lit("-"), "l_linenumber")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber") + F.col("l_partkey") * 104729 + F.col("l_suppkey") * 31
    columns = {
        "holding_id": lambda k, salt: reference, "customer_ref": plain("o_custkey"), "account_ref": plain("l_orderkey"),
        "holding_name": text("l_partkey"), "type": code(HOLDING_TYPE_TEXTS), "balance_amount": number("l_extendedprice"),
        "balance_display": text("l_linestatus"), "currency": code(CURRENCY_TEXTS), "interest_rate": number("l_discount"),
        "opened_on": time("l_shipdate"), "maturity_date": time(), "status": code(STATE_TEXTS),
        "created_timestamp": time("l_shipdate"),
    }
    return _raw(source, 5, key, reference, "updated_timestamp", "int_key", columns)


BRONZE = {
    "bank": bronze_bank,
    "branch": bronze_branch,
    "contact": bronze_contact,
    "account": bronze_account,
    "financial_holding": bronze_holding,
}


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: build(spark, sf_dir) for entity, build in BRONZE.items()}
