"""Canonical schemas of the clean layer, one per entity."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

# Field names, types, order and required fields of the canonical model.
_AUDIT = "createdOn TIMESTAMP, modifiedOn TIMESTAMP"
_STATUS = (
    "statecode INT NOT NULL, statecode_display STRING, "
    "statuscode INT, statuscode_display STRING"
)
_ADDRESS = (
    "addressLine1 STRING, addressLine2 STRING, addressLine3 STRING, city STRING, "
    "stateOrProvince STRING, postalCode STRING, country STRING, telephone1 STRING"
)

ENTITY_DDL = {
    "bank": f"""
        bankId STRING NOT NULL, {_AUDIT}, {_STATUS},
        name STRING, bankCode STRING, {_ADDRESS}, integrationKey STRING
    """,
    "branch": f"""
        branchId STRING NOT NULL, bankId STRING, {_AUDIT}, {_STATUS},
        name STRING, branchCode STRING, {_ADDRESS}, integrationKey STRING
    """,
    "contact": f"""
        contactId STRING NOT NULL, branchId STRING, {_AUDIT}, {_STATUS},
        firstName STRING, lastName STRING, fullName STRING, emailAddress STRING,
        telephone1 STRING, dateOfBirth DATE, joinDate TIMESTAMP, tenureYears DECIMAL(18,2),
        isManagedByBankSystem BOOLEAN, integrationKey STRING
    """,
    "account": f"""
        accountId STRING NOT NULL, branchId STRING, primaryContactId STRING, {_AUDIT}, {_STATUS},
        name STRING, accountNumber STRING, accountType STRING, joinDate TIMESTAMP,
        tenureYears DECIMAL(18,2), integrationKey STRING
    """,
    "financial_holding": f"""
        financialHoldingId STRING NOT NULL, contactId STRING, accountId STRING,
        {_AUDIT}, {_STATUS},
        name STRING, holdingType INT, holdingType_display STRING, balance DECIMAL(18,2),
        balanceDefault DECIMAL(18,2), balanceDefaultDisplayValue STRING, openedDate TIMESTAMP,
        maturityDate TIMESTAMP, interestRate DECIMAL(10,4), currencyCode STRING,
        integrationKey STRING
    """,
}


@cache
def target_schema(entity: str) -> StructType:
    """Canonical schema of ``entity``; needs a running session to parse the DDL."""
    if entity not in ENTITY_DDL:
        raise ValueError(f"no entity named {entity!r}; known: {', '.join(ENTITY_DDL)}")
    return StructType.fromDDL(ENTITY_DDL[entity])


def required_fields(schema: StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]
