"""Security queries: findings detail, CVE mart, reconciliation and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import portable, severity_band
from tidemark.operators import gold, reconcile
from tidemark.plans import metrics, standins
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import gold_gate
from tidemark.session import shared_dir
from tidemark.sources.sinks import materialize
from tidemark.workload import base
from tidemark.workload.finance import report, written_gold
from tidemark.workload.registry import register


def cve_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_spec("security").mart_direct(
        standins.scan_findings(spark, sf_dir), standins.advisories(spark, sf_dir))


@register("mart_cve_exposure", base.with_ctes(
    """SELECT cve_id, advisory_document_path, advisory_document_filename, advisory_title,
  advisory_published_date, advisory_recommended_remediation, vulnerability_title,
  vulnerability_category, severity, CAST(cvss_score AS DOUBLE) AS cvss_score, exploit_available,
  first_scan_date, last_scan_date, finding_count, scan_count, affected_assets, open_findings,
  critical_findings, CAST(remediation_hours AS DOUBLE) AS remediation_hours,
  CAST(asset_value_at_risk AS DOUBLE) AS asset_value_at_risk,
  CAST(weighted_risk AS DOUBLE) AS weighted_risk, average_cvss
FROM cve_mart""", base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def mart_cve_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cve_mart(spark, sf_dir))


@register("gold_detail_findings", base.with_ctes(
    """SELECT finding_id, scan_id, CAST(scan_date AS VARCHAR) AS scan_date, asset_id, asset_type,
  environment, f.cve_id, vulnerability_title, vulnerability_category, f.severity,
  CAST(f.cvss_score AS DOUBLE) AS cvss_score, status, CAST(age_days AS BIGINT) AS age_days,
  CAST(remediation_sla_days AS BIGINT) AS remediation_sla_days,
  CAST(remediation_hours AS DOUBLE) AS remediation_hours,
  CAST(asset_value_at_risk AS DOUBLE) AS asset_value_at_risk,
  CAST(weighted_risk AS DOUBLE) AS weighted_risk, exploit_available,
  a.cve_id AS advisory_cve_id, a.path AS advisory_document_path,
  a.filename AS advisory_document_filename, a.title AS advisory_title,
  CAST(a.published_date AS VARCHAR) AS advisory_published_date, a.severity AS advisory_severity,
  CAST(a.cvss_score AS DOUBLE) AS advisory_cvss_score,
  a.recommended_remediation AS advisory_recommended_remediation
FROM findings f LEFT JOIN advisories a ON f.cve_id = a.cve_id""", base.FINDINGS, base.ADVISORIES))
def gold_detail_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(domain_spec("security").detail(
        standins.scan_findings(spark, sf_dir), standins.advisories(spark, sf_dir)))


@register("preview_cves", base.with_ctes(
    """SELECT cve_id, severity, finding_count, open_findings, critical_findings,
  CAST(asset_value_at_risk AS DOUBLE) AS asset_value_at_risk,
  CAST(weighted_risk AS DOUBLE) AS weighted_risk
FROM cve_mart ORDER BY weighted_risk DESC, cve_id""",
    base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def preview_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(gold.preview(
        cve_mart(spark, sf_dir),
        ["cve_id", "severity", "finding_count", "open_findings", "critical_findings",
         "asset_value_at_risk", "weighted_risk"], "weighted_risk", "cve_id"))


@register("severity_band", base.with_ctes(
    f"""SELECT severity, MIN(CAST(cvss_score AS DOUBLE)) AS lowest_score,
  MAX(CAST(cvss_score AS DOUBLE)) AS highest_score, COUNT(*) AS findings,
  COUNT(*) FILTER (WHERE severity IS DISTINCT FROM {base.BAND.format('cvss_score')}) AS wrong_band
FROM (SELECT cvss_score, CASE WHEN exploit_available THEN 'Critical' ELSE severity END AS severity
      FROM findings) AS reported GROUP BY severity""", base.FINDINGS))
def severity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings as a scanner reports them that calls every exploit critical."""
    reported = standins.scan_findings(spark, sf_dir).withColumn("severity", F.when(
        F.col("exploit_available"), "Critical").otherwise(F.col("severity")))
    return portable(reported.groupBy("severity").agg(
        F.min("cvss_score").alias("lowest_score"), F.max("cvss_score").alias("highest_score"),
        F.count(F.lit(1)).alias("findings"),
        F.count_if(~F.col("severity").eqNullSafe(severity_band("cvss_score"))).alias("wrong_band")))


@register("reconcile_mart_findings", base.with_ctes(
    """SELECT COUNT(*) AS compared_groups,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_hours OR NOT ok_value OR NOT ok_risk) AS mismatched_groups,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_hours) AS mismatched_remediation_hours,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_value) AS mismatched_asset_value_at_risk,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_risk) AS mismatched_weighted_risk
FROM (SELECT e.cve_id IS NOT NULL AND m.cve_id IS NOT NULL AS ok_key,
        e.h IS NOT DISTINCT FROM m.remediation_hours AS ok_hours,
        e.v IS NOT DISTINCT FROM m.asset_value_at_risk AS ok_value,
        e.r IS NOT DISTINCT FROM m.weighted_risk AS ok_risk
      FROM (SELECT cve_id, SUM(remediation_hours) AS h, SUM(asset_value_at_risk) AS v,
              SUM(weighted_risk) AS r FROM findings GROUP BY cve_id) e
      FULL JOIN cve_mart m ON e.cve_id = m.cve_id) AS compared""",
    base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def reconcile_mart_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts are written once, for the mart and for what it is compared with."""
    spec, root = domain_spec("security"), shared_dir(spark, "reconcile-findings")
    facts = materialize(standins.scan_findings(spark, sf_dir), f"{root}/facts")
    mart = spec.mart_direct(facts, standins.advisories(spark, sf_dir))
    return reconcile.measure_mismatches(facts, mart, spec.group_key, spec.group_key, spec.checks)


@register("gate_gold_findings", base.gold_gate_sql(
    ",".join([base.FINDINGS, base.ADVISORIES, base.CVE_MART]), "findings", "advisories",
    "cve_mart", "finding_id", "cve_id", "cve_id",
    {"remediation_hours": "SUM(remediation_hours)",
     "asset_value_at_risk": "SUM(asset_value_at_risk)", "weighted_risk": "SUM(weighted_risk)"}))
def gate_gold_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = domain_spec("security")
    return gold_gate(spec, *written_gold(
        spark, spec, standins.scan_findings(spark, sf_dir),
        standins.advisories(spark, sf_dir), "gold-findings"))


# -- metric views ----------------------------------------------------------------
_SUMS = {
    "finding_count": "COUNT(*)", "scan_count": "COUNT(DISTINCT scan_id)",
    "affected_assets": "COUNT(DISTINCT asset_id)",
    "open_findings": "CAST(SUM(CASE WHEN status = 'Open' THEN 1 ELSE 0 END) AS BIGINT)",
    "critical_findings": "CAST(SUM(CASE WHEN severity = 'Critical' THEN 1 ELSE 0 END) AS BIGINT)",
    "remediation_hours": "CAST(SUM(remediation_hours) AS DOUBLE)",
    "value_at_risk": "CAST(SUM(asset_value_at_risk) AS DOUBLE)",
    "average_cvss": "CAST(SUM(cvss_score) AS DOUBLE) / COUNT(cvss_score)",
}


def _findings_query(name: str, dims: list[str], measures: list[str], where: dict | None = None,
                    order_by: list[tuple[str, str]] = (), limit: int | None = None) -> None:
    snakes = [d.lower().replace(" ", "_") for d in dims]
    shown = [f"CAST({d} AS VARCHAR) AS {d}" if d == "scan_date" else d for d in snakes]
    shown += [f"{_SUMS[m.lower().replace(' ', '_')]} AS {m.lower().replace(' ', '_')}"
              for m in measures]
    sql = f"SELECT {', '.join(shown)} FROM findings"
    if where:
        sql += " WHERE " + " AND ".join(
            f"{d.lower().replace(' ', '_')} = '{v}'" for d, v in where.items())
    sql += f" GROUP BY {', '.join('findings.' + d for d in snakes)}"
    if order_by:
        sql += " ORDER BY " + ", ".join(
            f"{n.lower().replace(' ', '_')} {way.upper()}" for n, way in order_by)
    if limit is not None:
        sql += f" LIMIT {limit}"

    @register(name, base.with_ctes(sql, base.FINDINGS))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(metrics.FINDINGS.query(
            {"findings": standins.scan_findings(spark, sf_dir)}, dims, measures, where,
            order_by, limit))


_findings_query("metric_findings_all",
                ["Scan Date", "Asset Type", "Environment", "Severity", "Vulnerability Category"],
                ["Finding Count", "Scan Count", "Affected Assets", "Open Findings",
                 "Critical Findings", "Remediation Hours", "Value at Risk", "Average CVSS"])
_findings_query("q_open_by_severity", ["Severity"], ["Open Findings"], None,
                [("Open Findings", "desc"), ("Severity", "asc")])
_findings_query("q_open_critical_asset", ["Asset Type"], ["Open Findings"],
                {"Severity": "Critical"}, [("Asset Type", "asc")])
_findings_query("q_var_environment", ["Environment"], ["Value at Risk"], None,
                [("Environment", "asc")])
_findings_query("q_open_critical_category", ["Vulnerability Category"], ["Open Findings"],
                {"Severity": "Critical"},
                [("Open Findings", "desc"), ("Vulnerability Category", "asc")])
_findings_query("preview_severity_exposure", ["Severity"],
                ["Finding Count", "Open Findings", "Value at Risk"], None,
                [("Value at Risk", "desc"), ("Severity", "asc")])


@register("metric_cves_all", base.with_ctes(
    """SELECT cve_id, severity, vulnerability_category,
  CAST(SUM(finding_count) AS BIGINT) AS finding_count,
  CAST(SUM(open_findings) AS BIGINT) AS open_findings,
  CAST(SUM(critical_findings) AS BIGINT) AS critical_findings,
  CAST(SUM(affected_assets) AS BIGINT) AS affected_assets,
  CAST(SUM(remediation_hours) AS DOUBLE) AS remediation_hours,
  CAST(SUM(asset_value_at_risk) AS DOUBLE) AS value_at_risk,
  CAST(SUM(weighted_risk) AS DOUBLE) AS weighted_risk
FROM cve_mart GROUP BY cve_id, severity, vulnerability_category""",
    base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def metric_cves_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(metrics.CVES.query(
        {"cve_exposure": cve_mart(spark, sf_dir)},
        ["CVE ID", "Severity", "Vulnerability Category"],
        [m.name for m in metrics.CVES.measures]))


@register("metric_cves_severity", base.with_ctes(
    """SELECT severity, CAST(SUM(affected_assets) AS BIGINT) AS affected_assets,
  CAST(SUM(weighted_risk) AS DOUBLE) AS weighted_risk
FROM cve_mart GROUP BY severity""", base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def metric_cves_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds distinct counts across CVEs, as the view defines it."""
    return report(metrics.CVES.query(
        {"cve_exposure": cve_mart(spark, sf_dir)}, ["Severity"],
        ["Affected Assets", "Weighted Risk"]))


@register("top_cves_risk", base.with_ctes(
    """SELECT cve_id, CAST(SUM(weighted_risk) AS DOUBLE) AS weighted_risk
FROM cve_mart GROUP BY cve_id ORDER BY weighted_risk DESC, cve_id LIMIT 10""",
    base.FINDINGS, base.ADVISORIES, base.CVE_MART))
def top_cves_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(metrics.CVES.query(
        {"cve_exposure": cve_mart(spark, sf_dir)}, ["CVE ID"], ["Weighted Risk"],
        order_by=[("Weighted Risk", "desc"), ("CVE ID", "asc")], limit=10))
