"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from clearledger.operators.reshape import check_distinct_names, field

_RANK, _SPREAD = "__rank", "__spread"


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Column,
    tie_break: Sequence[str] | None = None,
    null_keys: str = "collapse",
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, NULLs last.

    Ties are broken by ``tie_break``, by default all columns, so the result does not depend on how
    the rows are spread over partitions. Columns that cannot be ordered (maps and variants, nested
    ones too) are refused unless ``tie_break`` names others. Every task first reduces its own rows
    to one per key, so a key that holds a large share of all rows reaches its reducer as at
    most one row per task.

    ``null_keys``: "collapse" treats NULL as a key like any other; "keep" keeps every row with a
    NULL key, each as a group of its own, so they spread over all reducers.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys must be 'collapse' or 'keep', not {null_keys!r}")
    check_distinct_names(df)
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tie_break is None:
        fixed = {*keys, order_by} if isinstance(order_by, str) else set(keys)
        tie_break = [f.name for f in df.schema if f.name not in fixed]
        odd = [f.name for f in df.schema if f.name in tie_break and not _can_be_ordered(f.dataType)]
        if odd:
            raise ValueError(f"cannot break ties by {', '.join(odd)}; name the columns in tie_break")
    newest = field(order_by) if isinstance(order_by, str) else order_by
    order = [newest, *map(field, tie_break)]
    groups = [*map(field, keys)]
    if null_keys == "keep":
        keyless = reduce(or_, [field(k).isNull() for k in keys])
        df = df.withColumn(_SPREAD, F.when(keyless, F.monotonically_increasing_id()))
        groups.append(F.col(_SPREAD))
    window = Window.partitionBy(*groups).orderBy(*[c.desc_nulls_last() for c in order])
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK, _SPREAD)


def _can_be_ordered(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_can_be_ordered(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _can_be_ordered(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))
