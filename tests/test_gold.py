"""Gold: enrichment grain, marts, reconciliation, and the gate's failing states."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold, reconcile
from tidemark.operators.reconcile import MeasureCheck
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import gold_gate

TXN = "ticket_id string, incident_id string, service string, priority string, " \
      "assignment_group string, configuration_item string, resolution_hours decimal(8,2), " \
      "sla_breached boolean"
DOC = "incident_id string, path string, impact string"


def tickets(spark, rows=None):
    rows = rows if rows is not None else [
        (f"t{i}", f"i{i}", "svc", "P1", "g", "ci", None, i % 2 == 0) for i in range(6)]
    return spark.createDataFrame(rows, TXN)


def reports(spark, keys=("i0", "i1", "i2")):
    return spark.createDataFrame([(k, f"/r/{k}.pdf", "impact") for k in keys], DOC)


@pytest.fixture(scope="module")
def spec(spark):
    return domain_spec("itsm")


@pytest.fixture(scope="module")
def good(spark, spec):
    source, docs = tickets(spark), reports(spark)
    detail = spec.detail(source, docs)
    return {"source": source, "documents": docs, "detail": detail, "mart": spec.mart_of(detail)}


def verdict(spec, state, **changes):
    """(first failing stage or None) of a gate over the state with changes."""
    tables = {**state, **changes}
    rows = gold_gate(spec, tables["source"], tables["documents"], tables["detail"],
                     tables["mart"]).collect()
    assert [r.stage_no for r in rows] == list(range(1, 11))
    failing = [r.stage for r in rows if r.verdict == "fail"]
    assert len(failing) <= 1
    return failing[0] if failing else None


def test_good_state_passes_with_partial_coverage(spec, good):
    assert verdict(spec, good) is None


def test_null_source_key(spark, spec, good):
    bad = good["source"].withColumn(
        "ticket_id", F.when(F.col("ticket_id") != "t5", F.col("ticket_id")))
    assert verdict(spec, good, source=bad) == "source"


def test_blank_source_key(spec, good):
    bad = good["source"].withColumn(
        "ticket_id", F.when(F.col("ticket_id") == "t5", "  ").otherwise(F.col("ticket_id")))
    assert verdict(spec, good, source=bad) == "source"


def test_blank_group_key(spec, good):
    bad = good["source"].withColumn(
        "incident_id", F.when(F.col("ticket_id") == "t5", "").otherwise(F.col("incident_id")))
    assert verdict(spec, good, source=bad) == "source"


def test_duplicate_source_key_with_right_total(spec, good):
    bad = good["source"].withColumn(
        "ticket_id", F.when(F.col("ticket_id") == "t5", "t4").otherwise(F.col("ticket_id")))
    assert verdict(spec, good, source=bad) == "source"


def test_empty_source(spark, spec, good):
    assert verdict(spec, good, source=tickets(spark, [])) == "source"


def test_duplicate_document_key(spark, spec, good):
    assert verdict(spec, good, documents=reports(spark, ("i0", "i0", "i1"))) == "documents"


def test_missing_document_table(spec, good):
    assert verdict(spec, good, documents=None) == "documents"


def test_empty_expected_join(spark, spec, good):
    assert verdict(spec, good, documents=reports(spark, ("x1", "x2"))) == "upstream_join"


def test_missing_detail_table(spec, good):
    assert verdict(spec, good, detail=None) == "detail"


def test_multiplied_detail_grain(spec, good):
    assert verdict(spec, good, detail=good["detail"].union(good["detail"].limit(1))) == "detail"


def test_detail_duplicate_hides_missing_row(spec, good):
    detail = good["detail"].withColumn(
        "ticket_id", F.when(F.col("ticket_id") == "t5", "t4").otherwise(F.col("ticket_id")))
    assert verdict(spec, good, detail=detail) == "detail"


def test_identity_swap_with_right_total(spec, good):
    detail = good["detail"].withColumn(
        "ticket_id", F.when(F.col("ticket_id") == "t5", "zz").otherwise(F.col("ticket_id")))
    assert verdict(spec, good, detail=detail) == "detail_identity"


def test_wrong_document_attached(spec, good):
    detail = good["detail"].withColumn(
        "report_incident_id", F.when(F.col("ticket_id") == "t0", "i1")
        .otherwise(F.col("report_incident_id")))
    assert verdict(spec, good, detail=detail) == "detail_join"


def test_missing_enrichment(spec, good):
    detail = good["detail"].withColumn(
        "report_incident_id", F.when(F.col("ticket_id") != "t0", F.col("report_incident_id")))
    assert verdict(spec, good, detail=detail) == "enrichment"


def test_match_column_must_be_there_too(spec, good):
    detail = good["detail"].withColumn("incident_document_path", F.lit(None).cast("string"))
    assert verdict(spec, good, detail=detail) == "enrichment"


def test_missing_mart(spec, good):
    assert verdict(spec, good, mart=None) == "mart"


def test_mart_null_key(spec, good):
    mart = good["mart"].withColumn(
        "incident_id", F.when(F.col("incident_id") != "i0", F.col("incident_id")))
    assert verdict(spec, good, mart=mart) == "mart"


def test_mart_duplicate_key(spec, good):
    assert verdict(spec, good, mart=good["mart"].union(good["mart"].limit(1))) == "mart"


def test_mart_identity_swap(spec, good):
    mart = good["mart"].withColumn(
        "incident_id", F.when(F.col("incident_id") == "i0", "zz").otherwise(F.col("incident_id")))
    assert verdict(spec, good, mart=mart) == "mart_identity"


def test_mart_measure_mismatch(spark):
    spec = domain_spec("security")
    columns = "finding_id bigint, cve_id bigint, scan_id string, scan_date date, asset_id string, " \
              "status string, severity string, cvss_score decimal(3,1), exploit_available boolean, " \
              "vulnerability_title string, vulnerability_category string, " \
              "remediation_hours decimal(8,2), asset_value_at_risk decimal(14,2), " \
              "weighted_risk decimal(12,3)"
    source = spark.range(12).selectExpr(
        "id AS finding_id", "id % 3 AS cve_id", "'s' AS scan_id", "DATE '2026-01-01' AS scan_date",
        "CAST(id AS string) AS asset_id", "'Open' AS status", "'Low' AS severity",
        "CAST(1 AS decimal(3,1)) AS cvss_score", "false AS exploit_available",
        "'t' AS vulnerability_title", "'c' AS vulnerability_category",
        "CAST(id AS decimal(8,2)) AS remediation_hours", "CAST(id AS decimal(14,2)) AS asset_value_at_risk",
        "CAST(id AS decimal(12,3)) AS weighted_risk")
    assert set(source.columns) == {c.split()[0] for c in columns.split(", ")}
    docs = spark.range(2).selectExpr(
        "id AS cve_id", "concat('/a/', id) AS path", "'f' AS filename", "'t' AS title",
        "'2026-01-01' AS published_date", "'Low' AS severity",
        "CAST(1 AS decimal(3,1)) AS cvss_score", "'p' AS recommended_remediation")
    detail = spec.detail(source, docs)
    mart = spec.mart_of(detail)
    state = {"source": source, "documents": docs, "detail": detail, "mart": mart}
    assert verdict(spec, state) is None
    swapped = mart.withColumn("weighted_risk", F.col("weighted_risk") + F.when(
        F.col("cve_id") == 0, 1).when(F.col("cve_id") == 1, -1).otherwise(0))
    assert verdict(spec, state, mart=swapped) == "mart_reconciliation"
    # Both ways to build a mart agree.
    direct = spec.mart_direct(source, docs).select(mart.columns)
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, mart.collect()))


# -- operators -------------------------------------------------------------------
def test_enrich_keeps_every_fact_and_leaves_nulls(spark, spec):
    rows = spec.detail(tickets(spark), reports(spark, ("i1",))).collect()
    assert len(rows) == 6
    assert [r.ticket_id for r in rows if r.report_incident_id is not None] == ["t1"]


def test_association_counts_pairs_like_a_full_join(spark):
    left = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (3, None), (None, "a"), (7, "q")], "k int, g string")
    right = spark.createDataFrame(
        [(1, "a"), (1, None), (1, "c"), (3, "z"), (4, "a"), (None, "a"), (7, "q")], "k int, d string")
    joined = left.alias("s").join(right.alias("t"), F.col("s.k") == F.col("t.k"), "full")
    wrong = joined.where("s.k IS NULL OR t.k IS NULL OR (d IS NOT NULL AND NOT (g <=> d))").count()
    got = reconcile.association_mismatches(left, right, "k", "g", "k", "d").first()
    assert (got.compared_rows, got.mismatched_rows) == (joined.count(), wrong)


def test_identity_diff_sides_and_examples(spark):
    a = spark.createDataFrame([(str(i),) for i in range(5)], "k string")
    b = spark.createDataFrame([(str(i),) for i in range(3, 8)], "k string")
    diff = reconcile.identity_diff(a, b, "k")
    assert sorted(map(tuple, diff.collect())) == [
        ("missing", "0"), ("missing", "1"), ("missing", "2"),
        ("unexpected", "5"), ("unexpected", "6"), ("unexpected", "7")]
    examples = reconcile.diff_examples(diff, 1)
    assert sorted(map(tuple, examples.collect())) == [("missing", "0"), ("unexpected", "5")]
    assert "WindowGroupLimit" in examples._jdf.queryExecution().executedPlan().toString()


def test_measure_comparison_casts_keys_only_when_types_differ(spark):
    source = spark.createDataFrame([(1, 10), (1, 5), (2, 1)], "k int, v int")
    mart = spark.createDataFrame([("1", 15), ("2", 2)], "k string, v int")
    got = reconcile.measure_mismatches(source, mart, "k", "k", [MeasureCheck("v")]).first()
    assert (got.compared_groups, got.mismatched_groups, got.mismatched_v) == (2, 1, 1)


def test_expected_enriched_compares_across_types(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "t int, g int")
    docs = spark.createDataFrame([("10",)], "d string")
    assert [r[0] for r in gold.expected_enriched(facts, docs, "t", "g", "d").collect()] == ["1"]


def test_manifest_audit_statuses(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "f string, d string")
    listed = spark.createDataFrame([("a", "1"), ("b", "9"), ("x", "5")], "f string, d string")
    got = {r.f: r.status for r in reconcile.manifest_audit(files, listed, "f", "d").collect()}
    assert got == {"a": "ok", "b": "mismatch", "c": "unlisted", "x": "missing"}


# -- skew ------------------------------------------------------------------------
def final_plan(df):
    df.collect()
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_hot_business_key_is_split_by_the_enrichment_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 300_000, 1, 8).selectExpr(
            "id AS t", "IF(id % 3 = 0, 0, id % 5000) AS g", "uuid() AS payload")
        docs = spark.range(5000).selectExpr("id AS d", "concat('/doc/', id) AS path")
        joined = gold.enrich(facts, docs, "g", "d", {"path": "path"})
        assert "skew=true" in final_plan(joined)
        assert joined.where("path IS NOT NULL").count() == 300_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_mart_aggregates_before_it_joins(spark, spec):
    plan = final_plan(spec.mart_direct(tickets(spark), reports(spark)))
    join = plan.index("Join")
    assert "partial_count" in plan[join:]
    assert "partial_" not in plan[:join]
