"""Quality reports on small tables with known answers."""

from pyspark.sql.types import StructType

from clearledger.plans import quality


def contact(spark, rows):
    from clearledger.operators.reshape import conform
    from clearledger.schemas import target_schema

    df = spark.createDataFrame(rows, "contactId string, statecode int, firstName string")
    return conform(df, target_schema("contact"))


ROWS = [("1", 0, "Jan"), (None, 1, "Ann"), ("3", None, None), (None, 0, "Luc")]


def test_required_violations(spark):
    got = quality.required_violations({"contact": contact(spark, ROWS)}).collect()
    assert {tuple(r) for r in got} == {("contact", "contactId", 2), ("contact", "statecode", 1)}
    assert quality.required_violations({"contact": contact(spark, ROWS[:1])}).count() == 0


def test_completeness(spark):
    got = {r.field: (r.n_rows, r.n_nulls, r.pct) for r in quality.completeness({"contact": contact(spark, ROWS)}).collect()}
    assert len(got) == 18
    assert got["firstName"] == (4, 1, 75.0)
    assert got["lastName"] == (4, 4, 0.0)
    empty = quality.completeness({"contact": contact(spark, [])}).collect()
    assert {(r.n_rows, r.n_nulls, r.pct) for r in empty} == {(0, 0, 0.0)}


def test_layer_reports(spark):
    raw = {"a": spark.range(5), "b": spark.range(3), "c": spark.range(2)}
    clean = {"a": spark.range(4), "b": spark.range(3), "c": spark.range(3)}
    got = {tuple(r) for r in quality.layer_compare(raw, clean).collect()}
    assert got == {("a", 5, 4, 1, "deduplicated"), ("b", 3, 3, 0, "no duplicates"), ("c", 2, 3, -1, "expanded")}
    paths = {("bronze", e): f"/x/{e}" for e in raw}
    summary = quality.layer_summary({"bronze": raw}, paths).collect()
    assert {tuple(r) for r in summary} == {("bronze", "a", 5, 1, "/x/a"), ("bronze", "b", 3, 1, "/x/b"), ("bronze", "c", 2, 1, "/x/c")}


def test_schema_compliance(spark):
    schema = StructType.fromDDL("id STRING NOT NULL, n INT, gone DATE, parts DATE")
    df = spark.createDataFrame(
        [("1", "7", ["x"], 1.5), ("2", "x", None, None), (None, None, ["y"], 2.5)],
        "id string, n string, parts array<string>, more double",
    )
    got = {r.field: r for r in quality.schema_compliance(df, "e", schema).collect()}
    assert list(got) == ["id", "n", "gone", "parts", "more"]
    assert (got["id"].type_ok, got["id"].n_nulls, got["id"].n_cast_fail) == (True, 1, 0)
    assert (got["n"].type_ok, got["n"].expected_type, got["n"].actual_type, got["n"].n_cast_fail) == (False, "int", "string", 1)
    assert (got["gone"].is_present, got["gone"].actual_type, got["gone"].n_nulls) == (False, None, None)
    assert (got["parts"].type_ok, got["parts"].n_cast_fail) == (False, 2)
    assert (got["more"].is_expected, got["more"].expected_type, got["more"].n_nulls) == (False, None, 1)


def test_defaulted_codes(spark):
    df = spark.createDataFrame([("active", "loan"), ("??", "crypto"), (None, None), (" CLOSED ", " Loan")], "status string, type string")
    got = {tuple(r) for r in quality.defaulted_codes({"financial_holding": df}).select("entity", "field", "n_rows", "n_defaulted").collect()}
    assert got == {("financial_holding", "status", 4, 2), ("financial_holding", "type", 4, 2)}


def test_reports_are_one_job_per_table(spark):
    """The per-field form would scan the table once per field."""
    df = contact(spark, ROWS)
    plan = quality.completeness({"contact": df})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_one_profile_gives_all_reports_on_fields(spark, sf_dir):
    """Each table is cleaned once: one exchange on its key and one for the sums."""
    from clearledger.plans.entities import ENTITIES, clean_all
    from clearledger.workload.bronze import bronze_tables

    clean = clean_all(bronze_tables(spark, sf_dir))
    found = quality.profile(clean)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == plan.count("Aggregate [") == len(ENTITIES)
    stored = spark.createDataFrame(found.collect(), found.schema)
    reports = quality.reports_of(stored)
    rows = lambda df: sorted(map(str, df.collect()))
    one = {"account": clean["account"]}
    of_account = {k: v.filter("entity = 'account'") for k, v in reports.items()}
    assert rows(of_account["completeness"]) == rows(quality.completeness(one))
    assert rows(of_account["required_violations"]) == rows(quality.required_violations(one))
    wanted = quality.schema_compliance(clean["account"], "account")
    assert rows(of_account["schema_compliance"].select(*wanted.columns)) == rows(wanted)
