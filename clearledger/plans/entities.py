"""Cleaning jobs: raw (bronze) table to canonical (silver) table, one per entity."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearledger.functions import codes
from clearledger.functions.parsing import parse_date, parse_timestamp, to_decimal
from clearledger.functions.text import (
    derive_full_name,
    keep,
    normalize_currency,
    normalize_email,
    proper_case,
    trimmed,
)
from clearledger.operators.dedup import latest_per_key
from clearledger.operators.rejects import Divided, divided, write_divided
from clearledger.operators.reshape import conform, field, with_status_labels
from clearledger.schemas import target_schema
from clearledger.sources.keyed import KeyedTable
from clearledger.sources.layers import Layout


def _money(text: Column) -> Column:
    return to_decimal(text, 18, 2)


def _rate(text: Column) -> Column:
    return to_decimal(text, 10, 4)


class Rule(NamedTuple):
    """How one canonical field is made: a column function and the raw columns it takes."""

    make: Callable[..., Column]
    sources: tuple[str, ...]


def _from(make: Callable[..., Column], *sources: str) -> Rule:
    return Rule(make, sources)


@dataclass(frozen=True)
class Entity:
    """``key`` and ``modified`` are the raw columns that de-duplication uses; ``modified``
    becomes ``modifiedOn``. Fields that have no rule are status columns or NULL."""

    key: str
    modified: str
    fields: Mapping[str, Rule]
    labels: Mapping[str, Rule]

    @property
    def raw_columns(self) -> list[str]:
        """Raw columns that reach the clean table, in field order, apart from ``modified``."""
        return list(dict.fromkeys(s for rule in self.fields.values() for s in rule.sources))


# Raw column(s) and cleaning rule of each canonical field.
ENTITIES = {
    "bank": Entity(
        key="integration_key",
        modified="modified_date",
        fields={
            "bankId": _from(keep, "src_bank_id"),
            "createdOn": _from(parse_timestamp, "created_date"),
            "statecode": _from(codes.resolve_state, "status"),
            "name": _from(trimmed, "bank_name"),
            "bankCode": _from(trimmed, "bank_code"),
            "addressLine1": _from(trimmed, "address_1"),
            "addressLine2": _from(trimmed, "address_2"),
            "city": _from(proper_case, "city"),
            "stateOrProvince": _from(proper_case, "province"),
            "postalCode": _from(trimmed, "zip_code"),
            "country": _from(codes.normalize_country, "country_code"),
            "telephone1": _from(trimmed, "phone"),
            "integrationKey": _from(keep, "integration_key"),
        },
        labels={},
    ),
    "branch": Entity(
        key="integration_key",
        modified="updated_at",
        fields={
            "branchId": _from(keep, "branch_id"),
            "bankId": _from(keep, "fk_bank_id"),
            "createdOn": _from(parse_timestamp, "created_at"),
            "statecode": _from(codes.resolve_state, "is_active"),
            "name": _from(proper_case, "branch_name"),
            "branchCode": _from(trimmed, "branch_code"),
            "addressLine1": _from(trimmed, "street_address"),
            "addressLine2": _from(trimmed, "address_line_2"),
            "city": _from(proper_case, "city_name"),
            "stateOrProvince": _from(proper_case, "state_province"),
            "postalCode": _from(trimmed, "postal_code"),
            "country": _from(codes.normalize_country, "country"),
            "telephone1": _from(trimmed, "phone_number"),
            "integrationKey": _from(keep, "integration_key"),
        },
        labels={},
    ),
    "contact": Entity(
        key="src_integration_key",
        modified="last_modified",
        fields={
            "contactId": _from(keep, "customer_id"),
            "branchId": _from(keep, "primary_branch_id"),
            "createdOn": _from(parse_timestamp, "created_timestamp"),
            "statecode": _from(codes.resolve_state, "is_active"),
            "firstName": _from(proper_case, "first_name"),
            "lastName": _from(proper_case, "last_name"),
            "fullName": _from(derive_full_name, "full_name", "first_name", "last_name"),
            "emailAddress": _from(normalize_email, "email"),
            "telephone1": _from(trimmed, "phone"),
            "dateOfBirth": _from(parse_date, "date_of_birth"),
            "joinDate": _from(parse_timestamp, "join_date"),
            "tenureYears": _from(_money, "tenure"),
            "isManagedByBankSystem": _from(codes.normalize_boolean, "managed_by_system"),
            "integrationKey": _from(keep, "src_integration_key"),
        },
        labels={},
    ),
    "account": Entity(
        key="int_key",
        modified="modified",
        fields={
            "accountId": _from(keep, "acct_id"),
            "branchId": _from(keep, "branch_ref"),
            "primaryContactId": _from(keep, "primary_contact_ref"),
            "createdOn": _from(parse_timestamp, "created"),
            "statecode": _from(codes.resolve_state, "status_flag"),
            "name": _from(trimmed, "acct_name"),
            "accountNumber": _from(trimmed, "account_number"),
            "accountType": _from(codes.resolve_account_type, "account_type"),
            "joinDate": _from(parse_timestamp, "join_date"),
            "tenureYears": _from(_money, "tenure_years"),
            "integrationKey": _from(keep, "int_key"),
        },
        labels={},
    ),
    "financial_holding": Entity(
        key="int_key",
        modified="updated_timestamp",
        fields={
            "financialHoldingId": _from(keep, "holding_id"),
            "contactId": _from(keep, "customer_ref"),
            "accountId": _from(keep, "account_ref"),
            "createdOn": _from(parse_timestamp, "created_timestamp"),
            "statecode": _from(codes.resolve_state, "status"),
            "name": _from(trimmed, "holding_name"),
            "holdingType": _from(codes.resolve_holding_type, "type"),
            "balance": _from(_money, "balance_amount"),
            "balanceDefault": _from(_money, "balance_amount"),
            "balanceDefaultDisplayValue": _from(trimmed, "balance_display"),
            "openedDate": _from(parse_timestamp, "opened_on"),
            "maturityDate": _from(parse_timestamp, "maturity_date"),
            "interestRate": _from(_rate, "interest_rate"),
            "currencyCode": _from(normalize_currency, "currency"),
            "integrationKey": _from(keep, "int_key"),
        },
        labels={"holdingType_display": _from(codes.holding_type_label, "holdingType")},
    ),
}

# Raw columns whose unknown values silently become a default code, by entity.
DEFAULTED = {
    "bank": {"status": codes.STATES},
    "branch": {"is_active": codes.STATES},
    "contact": {"is_active": codes.STATES},
    "account": {"status_flag": codes.STATES},
    "financial_holding": {"status": codes.STATES, "type": codes.HOLDING_TYPES},
}


def _columns(rules: Mapping[str, Rule]) -> dict[str, Column]:
    return {name: rule.make(*map(field, rule.sources)) for name, rule in rules.items()}


def entity_spec(entity: str) -> Entity:
    if entity not in ENTITIES:
        raise ValueError(f"no entity named {entity!r}; known: {', '.join(ENTITIES)}")
    return ENTITIES[entity]


def staged(raw: DataFrame, entity: str) -> DataFrame:
    """The raw columns that cleaning needs, and the parsed change time as ``modifiedOn``."""
    spec = entity_spec(entity)
    return raw.select(*map(field, spec.raw_columns), parse_timestamp(field(spec.modified)).alias("modifiedOn"))


def finished(latest: DataFrame, entity: str) -> DataFrame:
    """Staged rows, one per key, cleaned and conformed to the canonical schema."""
    spec = entity_spec(entity)
    mapped = latest.select("modifiedOn", *[column.alias(name) for name, column in _columns(spec.fields).items()])
    labelled = with_status_labels(mapped)
    if spec.labels:
        labelled = labelled.withColumns(_columns(spec.labels))
    return conform(labelled, target_schema(entity))


def clean_entity(raw: DataFrame, entity: str, null_keys: str = "collapse") -> DataFrame:
    """Latest row per integration key, cleaned and conformed to the canonical schema.

    ``null_keys`` says what becomes of rows without a key, as in ``latest_per_key``.

    The change time is parsed once, before de-duplication, which orders by it; everything else
    is parsed afterwards, on the surviving rows only. The de-duplication is the one shuffle.
    """
    rows = staged(raw, entity)
    return finished(latest_per_key(rows, entity_spec(entity).key, "modifiedOn", null_keys=null_keys), entity)


def merge_entity(spark: SparkSession, base: str, batch: DataFrame, entity: str, n_parts: int = 64) -> KeyedTable:
    """Bring a batch of raw rows into the silver table that lies, with its state, below ``base``.

    The state holds the latest staged row of each key, the silver table the clean one. Both are in
    ``n_parts`` parts by the hash of the key, and only parts that a key of the batch falls into
    are read and rewritten. Batches in any order give the rows that one run over all of them gives.
    NULL keys collapse to one row.
    """
    key = entity_spec(entity).key
    state = KeyedTable(f"{base}/state", (key,), n_parts)
    silver = KeyedTable(f"{base}/silver", ("integrationKey",), n_parts)
    parts = state.merge(spark, staged(batch, entity), lambda rows: latest_per_key(rows, key, "modifiedOn"))
    silver.replace(spark, finished(state.read(spark, parts), entity), parts)
    return silver


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The clean table of every entity, lazily."""
    return {entity: clean_entity(raw[entity], entity) for entity in ENTITIES}


class Written(NamedTuple):
    table: DataFrame
    n_rows: int
    n_filled: dict[str, int]


# A table beyond ``SLICE_BYTES`` is cleaned in slices of its keys, ``MOST_SLICES`` at most, one after
# another, so that the disks hold the shuffle files of one slice, not of the table. Each
# slice scans the table once more, hence the bound.
SLICE_BYTES, MOST_SLICES = 1 << 30, 4


def slices(raw: DataFrame, key: str) -> list[DataFrame]:
    """The rows in as many parts, by the hash of their key, as the size of the table asks for."""
    size = int(str(raw._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = min(MOST_SLICES, -(-size // SLICE_BYTES)) if size < 1 << 62 else 1  # beyond, Spark does not know it
    part = F.pmod(F.xxhash64(field(key)), F.lit(n))
    return [raw.filter(part == i) for i in range(n)] if n > 1 else [raw]


def run_entity(
    spark: SparkSession, layout: Layout, entity: str, null_keys: str = "collapse"
) -> Written:
    """Read the bronze table, clean it, replace the silver table.

    Row count and filled values per field are observed while the table is written, so neither
    needs another pass. ``table`` reads what was written instead of computing it again. Large tables
    are cleaned in slices of their keys where the layout can be written in parts.
    """
    raw = layout.read(spark, "bronze", entity)
    parts = slices(raw, entity_spec(entity).key) if layout.in_parts else [raw]
    seen = [Observation(f"clean_{entity}_{i}") for i in range(len(parts))]
    clean = [clean_entity(part, entity, null_keys) for part in parts]
    names = clean[0].columns
    counts = [F.count(F.lit(1)).alias("n_rows"), *[F.count(field(name)).alias(f"filled_{name}") for name in names]]
    observed = [df.observe(one, *counts) for df, one in zip(clean, seen)]
    if len(observed) > 1:
        layout.write_parts(observed, "silver", entity)
    else:
        layout.write(observed[0], "silver", entity)
    metrics = [one.get for one in seen]
    total = lambda name: sum(m[name] for m in metrics)
    return Written(layout.read(spark, "silver", entity), total("n_rows"), {name: total(f"filled_{name}") for name in names})


def run_divided(spark: SparkSession, raw: DataFrame, entity: str, folder: str, null_keys: str = "collapse") -> Divided:
    """Clean a raw table and write rows that lack a required field apart from all others.

    Both go out in one job over one scan, into two subfolders; rejected rows say which fields they
    lack (``missing_fields``).
    """
    return write_divided(divided(clean_entity(raw, entity, null_keys), target_schema(entity)), folder)


def run_all(spark: SparkSession, layout: Layout, null_keys: str = "collapse") -> dict[str, Written]:
    """Run every entity job. They share nothing, so all are submitted at once."""
    with ThreadPoolExecutor(len(ENTITIES)) as pool:
        jobs = {entity: pool.submit(run_entity, spark, layout, entity, null_keys) for entity in ENTITIES}
        return {entity: job.result() for entity, job in jobs.items()}
