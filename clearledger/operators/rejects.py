"""Part rows that lack a required field from all others."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearledger.operators.reshape import field
from clearledger.schemas import required_fields

MISSING, REJECTED = "missing_fields", "rejected"


class Divided(NamedTuple):
    """``rejected`` has ``missing_fields`` besides the columns of ``accepted``."""

    accepted: DataFrame
    rejected: DataFrame


def divided(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with ``missing_fields``, the required fields of ``schema`` that a row has no value
    in, in schema order, and ``rejected``, whether there are any."""
    gaps = [F.when(field(name).isNull(), F.lit(name)) for name in required_fields(schema)]
    missing = F.array_compact(F.array(*gaps)) if gaps else F.array().cast("array<string>")
    return df.withColumn(MISSING, missing).withColumn(REJECTED, F.size(MISSING) > 0)


def write_divided(rows: DataFrame, folder: str) -> Divided:
    """Write rows of ``divided`` to two subfolders, in one job over one scan.

    Each of the two tables that this returns reads its own subfolder only.
    """
    rows.write.mode("overwrite").partitionBy(REJECTED).parquet(folder)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    kept = [field(c) for c in rows.columns if c != REJECTED]
    accepted = stored.filter(f"not {REJECTED}").select(*kept).drop(MISSING)
    return Divided(accepted, stored.filter(REJECTED).select(*kept))
