"""Data-quality reports. Each makes one pass over each table and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearledger.functions.codes import is_listed
from clearledger.operators.reshape import check_distinct_names, field
from clearledger.plans.entities import DEFAULTED, Written, entity_spec
from clearledger.schemas import required_fields, target_schema
from clearledger.sources.layers import LAYERS, Layout


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _per_field(df: DataFrame, entity: str, rows: Iterable[tuple[str, dict[str, Column]]]) -> DataFrame:
    """Aggregate ``df`` once and turn the result into one row per field.

    ``rows`` pairs a field name with its named aggregates.
    """
    structs = [
        F.struct(F.lit(name).alias("field"), *[c.alias(n) for n, c in values.items()])
        for name, values in rows
    ]
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*structs).alias("fields"))
    return totals.select(F.lit(entity).alias("entity"), F.inline("fields"), "n_rows")


def field_nulls(df: DataFrame, entity: str, names: Iterable[str] | None = None) -> DataFrame:
    """(entity, field, n_nulls, n_rows) of each named field, by default all."""
    names = df.columns if names is None else names
    missing = {name: F.count(F.lit(1)) - F.count(field(name)) for name in names}
    return _per_field(df, entity, [(name, {"n_nulls": c}) for name, c in missing.items()])


def required_violations(
    clean: Mapping[str, DataFrame], schemas: Mapping[str, StructType] | None = None
) -> DataFrame:
    """Required fields that hold NULLs: (entity, field, n_nulls).

    ``schemas`` has the target schema of tables that are not named after an entity.
    """
    schemas = schemas or {}
    parts = [
        field_nulls(df, name, required_fields(schemas.get(name) or target_schema(name)))
        for name, df in clean.items()
    ]
    return _stack(parts).filter(F.col("n_nulls") > 0).select("entity", "field", "n_nulls")


def completeness(clean: Mapping[str, DataFrame]) -> DataFrame:
    """Filled share of each field in percent: (entity, field, n_rows, n_nulls, pct)."""
    nulls = _stack(field_nulls(df, entity) for entity, df in clean.items())
    pct = (F.col("n_rows") - F.col("n_nulls")) / F.col("n_rows") * 100
    return nulls.select(
        "entity",
        "field",
        "n_rows",
        "n_nulls",
        F.when(F.col("n_rows") > 0, pct).otherwise(F.lit(0.0)).alias("pct"),
    )


def _row_count(df: DataFrame, entity: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("entity", F.lit(entity))


def layer_summary(
    layers: Mapping[str, Mapping[str, DataFrame]], paths: Mapping[tuple[str, str], str] | None = None
) -> DataFrame:
    """Rows and columns of each table: (layer, entity, n_rows, n_columns[, path]).

    ``paths`` maps (layer, entity) to a location; with it, each row also says where.
    """
    parts = []
    for layer, tables in layers.items():
        for entity, df in tables.items():
            row = _row_count(df, entity).select(
                F.lit(layer).alias("layer"),
                "entity",
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
            )
            if paths is not None:
                row = row.withColumn("path", F.lit(paths[layer, entity]))
            parts.append(row)
    return _stack(parts)


def key_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """What cleaning would leave of each raw table: (entity, n_raw, n_clean, n_null_keys).

    Cleaning keeps one row per integration key, NULL counting as one key. So one aggregate on the
    key alone tells the counts: nothing else is read, shuffled or parsed.
    """

    def of(entity: str, df: DataFrame) -> DataFrame:
        key = field(entity_spec(entity).key)
        keys = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        nulls = F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(F.lit(0)))
        totals = keys.agg(F.sum("n").alias("n_raw"), F.count(F.lit(1)).alias("n_clean"), nulls.alias("n_null_keys"))
        zero = F.lit(0).cast("bigint")
        return totals.select(
            F.lit(entity).alias("entity"),
            F.coalesce("n_raw", zero).alias("n_raw"),
            "n_clean",
            F.coalesce("n_null_keys", zero).alias("n_null_keys"),
        )

    return _stack(of(entity, df) for entity, df in raw.items())


def summary_of(counts: DataFrame, widths: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``layer_summary`` of the bronze and silver tables from ``key_counts`` and their widths."""
    parts = []
    for layer, column in zip(LAYERS, ("n_raw", "n_clean")):
        width = F.create_map(*[F.lit(x) for pair in widths[layer].items() for x in pair])
        parts.append(
            F.struct(F.lit(layer).alias("layer"), F.col(column).alias("n_rows"), width[F.col("entity")].alias("n_columns"))
        )
    both = counts.select("entity", F.explode(F.array(*parts)).alias("row"))
    return both.select("row.layer", "entity", "row.n_rows", "row.n_columns")


def layer_compare(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Row counts before and after cleaning: (entity, n_raw, n_clean, difference, note).

    Without ``clean``, for raw tables that are not cleaned yet, from ``key_counts``.
    """
    if clean is None:
        paired = key_counts(raw).drop("n_null_keys")
    else:
        counts = layer_summary({"raw": raw, "clean": clean})

        def of(layer: str) -> Column:
            return F.sum(F.when(F.col("layer") == layer, F.col("n_rows")).otherwise(F.lit(0)))

        paired = counts.groupBy("entity").agg(of("raw").alias("n_raw"), of("clean").alias("n_clean"))
    difference = F.col("n_raw") - F.col("n_clean")
    return paired.withColumns(
        {
            "difference": difference,
            "note": F.when(difference > 0, "deduplicated")
            .when(difference == 0, "no duplicates")
            .otherwise("expanded"),
        }
    )


def _n_cast_fail(blank: DataFrame, name: str, wanted) -> Column:
    """Values of the field that are lost when it is cast to the target type.

    ``blank`` is an empty table of the same schema: whether a conversion exists is asked there,
    so that the plan behind the table is not analysed once a field.
    """
    value = field(name)
    if blank.schema[name].dataType == wanted:
        return F.lit(0).cast("bigint")
    try:
        blank.select(value.try_cast(wanted))
    except AnalysisException:  # no such conversion exists: every value would be lost
        return F.count(value)
    return F.count_if(value.isNotNull() & value.try_cast(wanted).isNull())


def schema_compliance(df: DataFrame, entity: str, schema: StructType | None = None) -> DataFrame:
    """How a table fits its target schema, one row per field.

    (entity, field, is_expected, is_present, type_ok, expected_type, actual_type, n_rows, n_nulls,
    n_cast_fail). A missing field has NULL counts and actual type; an extra field has a NULL
    expected type. Nullability and field order are not compared.
    """
    check_distinct_names(df)
    schema = target_schema(entity) if schema is None else schema
    wanted = {f.name: f.dataType for f in schema}
    actual = {f.name: f.dataType for f in df.schema}
    no_count = F.lit(None).cast("bigint")
    blank = df.sparkSession.createDataFrame([], df.schema)
    rows = []
    for name in [*wanted, *(n for n in actual if n not in wanted)]:
        expected, present = name in wanted, name in actual
        both = expected and present
        same = both and wanted[name] == actual[name]
        rows.append(
            (
                name,
                {
                    "is_expected": F.lit(expected),
                    "is_present": F.lit(present),
                    "type_ok": F.lit(same) if both else F.lit(None).cast("boolean"),
                    "expected_type": F.lit(wanted[name].simpleString() if expected else None).cast("string"),
                    "actual_type": F.lit(actual[name].simpleString() if present else None).cast("string"),
                    "n_nulls": F.count(F.lit(1)) - F.count(field(name)) if present else no_count,
                    "n_cast_fail": _n_cast_fail(blank, name, wanted[name]) if both else no_count,
                },
            )
        )
    return _per_field(df, entity, rows)


_PROFILE = (
    "entity string, field string, is_expected boolean, is_present boolean, type_ok boolean, expected_type string, "
    "actual_type string, n_nulls long, n_cast_fail long, n_rows long, is_required boolean"
)


def profile(clean: Mapping[str, DataFrame], schemas: Mapping[str, StructType] | None = None) -> DataFrame:
    """What the reports on fields need, one row per table and field, from one aggregate per table:
    ``schema_compliance`` and ``is_required``. ``reports_of`` makes the reports of it.

    ``schemas`` has the target schema of tables that are not named after an entity.
    """
    schemas = schemas or {}

    def of(entity: str, df: DataFrame) -> DataFrame:
        schema = schemas.get(entity) or target_schema(entity)
        needed = F.col("field").isin(*required_fields(schema)) if required_fields(schema) else F.lit(False)
        return schema_compliance(df, entity, schema).withColumn("is_required", needed)

    return _stack(of(entity, df) for entity, df in clean.items())


def observed_profile(spark: SparkSession, written: Mapping[str, Written]) -> DataFrame:
    """``profile`` of tables that ``run_entity`` wrote, from what was counted while they were
    written: a few rows that the driver has already, without any further pass."""
    rows = []
    for entity, done in written.items():
        schema = target_schema(entity)
        actual = {f.name: f.dataType for f in done.table.schema}
        for f in schema:
            kind, nulls = f.dataType.simpleString(), done.n_rows - done.n_filled[f.name]
            same = actual[f.name] == f.dataType
            # The writer casts every field to its type, so nothing is left that a cast would lose.
            rows.append(
                (entity, f.name, True, True, same, kind, actual[f.name].simpleString(), nulls, 0, done.n_rows, f.name in required_fields(schema))
            )
    return spark.createDataFrame(rows, _PROFILE)


def reports_of(found: DataFrame) -> dict[str, DataFrame]:
    """The reports on fields, by name, of one ``profile``, which is a row per field: write it to a
    table to make several reports of one pass over the data."""
    present = found.filter("is_present")
    filled = (F.col("n_rows") - F.col("n_nulls")) / F.col("n_rows") * 100
    return {
        "required_violations": present.filter("is_required and n_nulls > 0").select("entity", "field", "n_nulls"),
        "completeness": present.select(
            "entity", "field", "n_rows", "n_nulls", F.when(F.col("n_rows") > 0, filled).otherwise(F.lit(0.0)).alias("pct")
        ),
        "schema_compliance": found.drop("is_required"),
    }


def defaulted_codes(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose text matched no synonym and so got a default code:
    (entity, field, n_rows, n_defaulted)."""
    return _stack(
        _per_field(
            df,
            entity,
            [
                (name, {"n_defaulted": F.count_if(~is_listed(field(name), known))})
                for name, known in DEFAULTED[entity].items()
            ],
        )
        for entity, df in raw.items()
    )


def stored_reports(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Every report over the stored bronze and silver tables, by name, lazily.

    Reports that only count rows and filled values read files through their footers where the
    format has such counts (``Layout.read_counts``): no column data is read for those.
    """
    raw, clean = ({e: layout.read(spark, layer, e) for e in layout.tables} for layer in LAYERS)
    raw_counts, counts = ({e: layout.read_counts(spark, layer, e) for e in layout.tables} for layer in LAYERS)
    paths = {(layer, e): layout.path(layer, e) for layer in LAYERS for e in layout.tables}
    return {
        "layer_summary": layer_summary(dict(zip(LAYERS, (raw_counts, counts))), paths),
        "layer_compare": layer_compare(raw_counts, counts),
        "required_violations": required_violations(counts),
        "completeness": completeness(counts),
        "key_counts": key_counts(raw),
        "schema_compliance": _stack(schema_compliance(df, entity) for entity, df in clean.items()),
        "defaulted_codes": defaulted_codes(raw),
    }
