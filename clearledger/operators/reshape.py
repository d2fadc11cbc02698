"""Projections: renaming, conforming to a schema, trimming, status columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from clearledger.functions import codes


def field(name: str) -> Column:
    """Column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_distinct_names(df: DataFrame) -> None:
    """Refuse columns that only differ in case, which Spark could not tell apart."""
    seen: dict[str, str] = {}
    for name in df.columns:
        other = seen.setdefault(name.lower(), name)
        if other is not name:
            raise ValueError(f"columns {other!r} and {name!r} differ in case only")


def cast_or_null(column: Column, current: DataType, wanted: DataType) -> Column:
    """The column as ``wanted``; values that do not convert become NULL."""
    return column if current == wanted else column.try_cast(wanted)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select source columns under new names: ``{source: target}``."""
    return df.select(*[field(source).alias(target) for source, target in mapping.items()])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the fields of ``schema``, in its order and types.

    Names match by exact case. Missing fields are NULL, further columns are dropped. Required
    fields are not enforced here: the quality reports count their NULLs.
    """
    check_distinct_names(df)
    current = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (
                cast_or_null(field(f.name), current[f.name], f.dataType)
                if f.name in current
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def trim_all_strings(df: DataFrame) -> DataFrame:
    """Surrounding spaces removed from every string column, in one projection."""
    check_distinct_names(df)
    return df.select(
        *[
            F.trim(field(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else field(f.name)
            for f in df.schema
        ]
    )


def with_status_labels(df: DataFrame) -> DataFrame:
    """Add the columns that follow from ``statecode``: its label, the status code, its label."""
    return df.withColumns(
        {
            "statecode_display": codes.state_label(F.col("statecode")),
            "statuscode": codes.status_of_state(F.col("statecode")),
        }
    ).withColumn("statuscode_display", codes.status_label(F.col("statuscode")))
