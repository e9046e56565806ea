"""Integrity aggregates, profiles, sensitive columns, metadata coverage, serving."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import integrity, profile, serving
from tidemark.plans.gates import metadata_gate, serving_gate


def failing(gate):
    rows = [r.stage for r in gate.collect() if r.verdict == "fail"]
    return rows[0] if rows else None


# -- integrity -------------------------------------------------------------------
def test_key_integrity_counts_blank_and_repeated(spark):
    df = spark.createDataFrame([("a", "g"), ("a", ""), (None, None), (" ", "g")], "k string, g string")
    assert tuple(integrity.key_integrity(df, "k", "g").first()) == (4, 2, 2, 2)


def test_document_integrity(spark):
    df = spark.createDataFrame(
        [("a", "1", "x", "t"), ("a", "1", None, " "), ("b", "1", "x", None)],
        "source_class string, filename string, doc_class string, parsed_text string")
    assert tuple(integrity.document_integrity(df).first()) == (3, 2, 1, 2)


def test_extract_integrity_and_total(spark):
    df = spark.createDataFrame([("a", "/1", None), ("a", "/1", "bad"), ("b", "/2", None)],
                               "doc_class string, path string, extract_error string")
    got = {r.doc_class: tuple(r)[1:] for r in integrity.extract_integrity(df).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, 0, 1), "(all)": (3, 1, 2)}


def test_unexpected_values(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "c string")
    allowed = spark.createDataFrame([("a",), ("b",)], "l string")
    assert [tuple(r) for r in integrity.unexpected_values(df, "c", allowed, "l").collect()] == [("x", 2)]


def test_row_count_expectation(spark):
    assert tuple(integrity.row_count_expectation(spark.range(3), 3, "t").first()) == ("t", 3, 3, True)
    assert not integrity.row_count_expectation(spark.range(3), spark.range(4), "t").first().passed


def test_null_outcome_is_no_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    got = integrity.constraint_violations(df, {"positive": F.col("v") > 0}).first()
    assert tuple(got) == (3, "positive", 1)


# -- profile ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a@b.example", "x", [1]), (2, "call +1 (310) 555-4510", None, None),
         (3, "c@d.example", "y", [2])], "id int, note string, tag string, list array<int>")


def test_profile_is_one_scan_with_a_row_per_column(people):
    got = profile.column_profile(people, "people")
    rows = {r.column_name: r for r in got.collect()}
    assert [rows[c].ordinal for c in people.columns] == [0, 1, 2, 3]
    assert (rows["id"].null_count, rows["id"].min_value, rows["id"].max_value) == (0, "1", "3")
    assert rows["tag"].null_count == 1 and rows["tag"].approx_distinct == 2
    assert rows["tag"].mean_length == 1.0 and rows["id"].mean_length is None
    assert rows["list"].data_type == "array<int>" and rows["list"].min_value is None
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_sensitive_columns_by_rate(people):
    matches = profile.sensitive_matches(people, "people")
    assert {(r.column_name, r.pi_class, r.matches) for r in
            profile.sensitive_columns(matches).collect()} == {
                ("note", "email", 2), ("note", "phone", 1)}
    assert profile.sensitive_columns(matches, 0.9).count() == 0


def dictionary(people, **kw):
    return profile.data_dictionary(
        profile.column_profile(people, "people"),
        profile.sensitive_columns(profile.sensitive_matches(people, "people")), **kw)


def test_dictionary_and_coverage(people):
    df = dictionary(people, domain="crm", curated=("tag",))
    rows = {r.column_name: r for r in df.collect()}
    assert (rows["note"].pi_class, rows["tag"].pi_class, rows["id"].pi_class) == (
        "email, phone", "personal", None)
    assert rows["note"].description == "Note" and rows["id"].business_domain == "crm"
    assert tuple(profile.metadata_coverage(df).first()) == ("people", 4, 0, 0, 2, 0, True)


def test_metadata_gate_states(spark, people):
    df = dictionary(people, domain="crm", curated=("tag",))
    tables = spark.createDataFrame([("people",)], "table_name string")
    note = F.col("column_name") == "note"

    def change(column, value):
        return df.withColumn(column, F.when(note, value).otherwise(F.col(column)))

    null = F.lit(None).cast("string")
    assert failing(metadata_gate(df, tables)) is None
    assert failing(metadata_gate(df, tables.union(
        spark.createDataFrame([("gone",)], "t string")))) == "tables"
    assert failing(metadata_gate(change("description", F.lit("  ")), tables)) == "column_descriptions"
    assert failing(metadata_gate(change("description", null), tables)) == "column_descriptions"
    assert failing(metadata_gate(change("pi_class", F.lit(" ")), tables)) == "pi_values"
    assert failing(metadata_gate(df, tables, 3)) == "pi_columns"
    assert failing(metadata_gate(df.withColumn("business_domain", null), tables)) == "domains"
    schema = "table_name string, column_name string"
    exact = spark.createDataFrame([("people", "note"), ("people", "tag")], schema)
    assert failing(metadata_gate(df, tables, expected_pi=exact)) is None
    assert failing(metadata_gate(df, tables, expected_pi=exact.limit(1))) == "pi_columns"
    more = exact.union(spark.createDataFrame([("people", "id")], schema))
    assert failing(metadata_gate(df, tables, expected_pi=more)) == "pi_columns"


# -- serving ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def mart(spark):
    return spark.range(40).selectExpr(
        "concat('k', id) AS k", "concat('c', id % 3) AS category", "CAST(id AS decimal(10,2)) AS m",
        "IF(id % 3 = 0, NULL, 'one') AS single")


def test_category_column_needs_two_to_25_values(spark, mart):
    assert serving.category_column(mart) == "category"
    assert serving.category_column(mart.select("k", "single", "m")) is None
    assert serving.category_column(mart.select("m")) is None


def test_top_categories_rows_and_kpis(mart):
    top = serving.top_categories(mart, "category", "m", 2).collect()
    assert [(r.category, int(r.total)) for r in top] == [("c0", 273), ("c2", 260)]
    assert [r.k for r in serving.top_rows(mart, "m", "k", 2).collect()] == ["k39", "k38"]
    assert tuple(serving.kpis(mart).first()) == (40, 4, "m", 19.5)
    assert tuple(serving.kpis(mart.select("k")).first()) == (40, 1, None, None)


def test_serving_parity_fails_closed(spark, mart):
    def state(served):
        parity = serving.serving_parity(mart, served, "k")
        row = parity.first()
        return row.passed, failing(serving_gate(parity))

    assert state(mart) == (True, None)
    assert state(None) == (False, "served")
    assert state(mart.where("false")) == (False, "served")
    assert state(mart.where("k <> 'k1'")) == (False, "parity")
    swapped = mart.withColumn("k", F.when(F.col("k") == "k1", "zz").otherwise(F.col("k")))
    assert state(swapped) == (False, "identity")
    doubled = mart.withColumn("k", F.when(F.col("k") == "k1", "k2").otherwise(F.col("k")))
    assert state(doubled) == (False, "primary_key")
