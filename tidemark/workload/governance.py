"""Governance queries: profiles, sensitive columns, dictionary, coverage, metric sanity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import describe_identifier, normalize_reference
from tidemark.functions.detectors import DETECTORS
from tidemark.operators import profile
from tidemark.operators.cdc import synthesize_log
from tidemark.plans import metrics, standins
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import metadata_gate, metrics_gate
from tidemark.plans.medallion import run_domain
from tidemark.session import shared_dir
from tidemark.sources.tables import SCHEMAS, table
from tidemark.sources.sinks import materialize
from tidemark.workload import base
from tidemark.workload.finance import contract_tables, sales_tables
from tidemark.workload.itsm import incidents, service_mart
from tidemark.workload.registry import register
from tidemark.workload.security import cve_mart

# Every table and column: (name, Spark type).
PROFILED = {name: tuple(tuple(c.strip().split(" ")) for c in ddl.split(","))
            for name, ddl in SCHEMAS.items()}
TEXT_COLUMNS = {name: texts for name, columns in PROFILED.items()
                if (texts := tuple(c for c, kind in columns if kind == "string"))}
CURATED = ("c_name",)


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        profile.column_profile(table(spark, sf_dir, t), t) for t in PROFILED])


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        profile.sensitive_matches(table(spark, sf_dir, t), t, columns=columns)
        for t, columns in TEXT_COLUMNS.items()])


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.data_dictionary(
        _profiles(spark, sf_dir), profile.sensitive_columns(_matches(spark, sf_dir)),
        "commerce", CURATED)


# -- oracle pieces ---------------------------------------------------------------
def _profile_sql() -> str:
    rows = []
    for name, columns in PROFILED.items():
        for i, (column, data_type) in enumerate(columns):
            size = (f"CAST(SUM(length({column})) AS DOUBLE) / COUNT({column})"
                    if data_type == "string" else "CAST(NULL AS DOUBLE)")
            scalar = not data_type.startswith("array")
            low, high = ((f"CAST({f}({column}) AS VARCHAR)" for f in ("MIN", "MAX"))
                         if scalar else ("CAST(NULL AS VARCHAR)",) * 2)
            rows.append(
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, CAST({i} AS BIGINT) AS ordinal, "
                f"'{data_type}' AS data_type, COUNT(*) AS row_count, "
                f"COUNT(*) FILTER (WHERE {column} IS NULL) AS null_count, "
                f"{low} AS min_value, {high} AS max_value, {size} AS mean_length FROM {name}")
    return "profiled AS (" + "\nUNION ALL ".join(rows) + ")"


def _matches_sql() -> str:
    rows = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS detector, "
        f"COUNT({c}) AS values_checked, "
        f"COUNT(*) FILTER (WHERE regexp_matches({c}, '{pattern}')) AS matches FROM {t}"
        for t, columns in TEXT_COLUMNS.items() for c in columns
        for kind, (pattern, _) in DETECTORS.items()]
    return "matched AS (" + "\nUNION ALL ".join(rows) + ")"


_PI = """pi AS (
  SELECT table_name, column_name, detector AS pi_class, matches, values_checked
  FROM matched WHERE matches > 0)"""
_DICTIONARY = ",\n".join([_profile_sql(), _matches_sql(), _PI, """dictionary AS (
  SELECT p.table_name, p.column_name, p.ordinal, p.data_type, p.row_count, p.null_count,
         upper(substr(replace(p.column_name, '_', ' '), 1, 1))
         || lower(substr(replace(p.column_name, '_', ' '), 2)) AS description,
         COALESCE(pi.pi_class, CASE WHEN p.column_name = 'c_name' THEN 'personal' END) AS pi_class,
         'commerce' AS business_domain
  FROM profiled p LEFT JOIN (
    SELECT table_name, column_name, string_agg(pi_class, ', ' ORDER BY pi_class) AS pi_class
    FROM pi GROUP BY table_name, column_name) pi
  ON p.table_name = pi.table_name AND p.column_name = pi.column_name)"""])


@register("column_profile", base.with_ctes("SELECT * FROM profiled", _profile_sql()))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the sketched distinct counts, which no other engine reproduces."""
    return _profiles(spark, sf_dir).drop("approx_distinct")


@register("pii_matches", base.with_ctes("SELECT * FROM matched", _matches_sql()))
def pii_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir)


@register("pii_columns", base.with_ctes("SELECT * FROM pi", _matches_sql(), _PI))
def pii_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sensitive_columns(_matches(spark, sf_dir))


@register("data_dictionary", base.with_ctes("SELECT * FROM dictionary", _DICTIONARY))
def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary(spark, sf_dir)


@register("metadata_coverage", base.with_ctes(
    """SELECT table_name, COUNT(*) AS column_count, CAST(0 AS BIGINT) AS blank_descriptions,
  CAST(0 AS BIGINT) AS blank_pi_classes,
  COUNT(pi_class) AS pi_columns, CAST(0 AS BIGINT) AS blank_domains, COUNT(pi_class) >= 1 AS passed
FROM dictionary GROUP BY table_name""", _DICTIONARY))
def metadata_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.metadata_coverage(_dictionary(spark, sf_dir))


@register("describe_names", """SELECT DISTINCT p_name,
  upper(substr(trim(replace(p_name, '_', ' ')), 1, 1)) || lower(substr(trim(replace(p_name, '_', ' ')), 2)) AS description,
  lower(regexp_replace('`' || p_name || '`."' || p_brand || '"', '[`"''\\s]', '', 'g')) AS reference
FROM part""")
def describe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(F.lit("`"), "p_name", F.lit('`."'), "p_brand", F.lit('"'))
    return table(spark, sf_dir, "part").select(
        "p_name", describe_identifier("p_name").alias("description"),
        normalize_reference(quoted).alias("reference")).distinct()


# -- metric views ----------------------------------------------------------------
def _sanity_sql(view: str, relation: str, measures: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{view}' AS metric_view, '{name}' AS measure, "
        f"ROUND(CAST({expr} AS DOUBLE), 4) AS value, TRUE AS passed FROM {relation}"
        for name, expr in measures.items())


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)"


def _mean(value: str) -> str:
    return f"CAST(SUM({value}) AS DOUBLE) / COUNT({value})"


_SANITY = "\nUNION ALL ".join([
    _sanity_sql("finance_sales_metrics", "lines", {
        "Transaction Count": "COUNT(*)", "Order Count": "COUNT(DISTINCT l_orderkey)",
        "Units Sold": "SUM(units)", "Gross Sales": "SUM(gross_sales)",
        "Net Sales": "SUM(net_sales)", "Gross Margin": "SUM(gross_margin)",
        "Gross Margin Percent": _ratio("SUM(gross_margin)", "SUM(net_sales)")}),
    _sanity_sql("finance_contract_metrics", "contract_mart", {
        "Transaction Count": "SUM(transaction_count)", "Order Count": "SUM(order_count)",
        "Total Units": "SUM(total_units)", "Gross Sales": "SUM(gross_sales)",
        "Net Sales": "SUM(net_sales)", "Gross Margin": "SUM(gross_margin)",
        "Gross Margin Percent": _ratio("SUM(gross_margin)", "SUM(net_sales)")}),
    _sanity_sql("finance_discount_metrics", "lines", {
        "Gross Sales": "SUM(gross_sales)", "Discount Amount": "SUM(discount_amount)",
        "Net Sales": "SUM(net_sales)",
        "Discount Rate": _ratio("SUM(discount_amount)", "SUM(gross_sales)")}),
    _sanity_sql("security_findings_metrics", "findings", {
        "Finding Count": "COUNT(*)", "Scan Count": "COUNT(DISTINCT scan_id)",
        "Affected Assets": "COUNT(DISTINCT asset_id)",
        "Open Findings": "SUM(CASE WHEN status = 'Open' THEN 1 ELSE 0 END)",
        "Critical Findings": "SUM(CASE WHEN severity = 'Critical' THEN 1 ELSE 0 END)",
        "Remediation Hours": "SUM(remediation_hours)", "Value at Risk": "SUM(asset_value_at_risk)",
        "Average CVSS": _mean("cvss_score")}),
    _sanity_sql("security_cve_metrics", "cve_mart", {
        "Finding Count": "SUM(finding_count)", "Open Findings": "SUM(open_findings)",
        "Critical Findings": "SUM(critical_findings)", "Affected Assets": "SUM(affected_assets)",
        "Remediation Hours": "SUM(remediation_hours)", "Value at Risk": "SUM(asset_value_at_risk)",
        "Weighted Risk": "SUM(weighted_risk)"}),
    _sanity_sql("itsm_incident_metrics", "tickets", {
        "Incident Volume": "COUNT(*)", "MTTR Hours": _mean("resolution_hours"),
        "SLA Breach Count": "SUM(CASE WHEN sla_breached THEN 1 ELSE 0 END)"}),
    _sanity_sql("itsm_service_metrics", "service_mart", {
        "Incident Volume": "SUM(incident_count)",
        "MTTR Hours": _mean("mttr_hours"),
        "SLA Breach Count": "SUM(sla_breach_count)"}),
])


@register("metric_sanity", base.with_ctes(
    _SANITY, base.SALES, base.AGREEMENTS, base.CONTRACT_MART, base.FINDINGS, base.ADVISORIES,
    base.CVE_MART, base.TICKETS, base.REPORTS, base.SERVICE_MART))
def metric_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every measure of every view over all rows: present and finite."""
    sales = sales_tables(spark, sf_dir)
    sources = (
        (metrics.SALES, sales), (metrics.CONTRACTS, contract_tables(spark, sf_dir)),
        (metrics.DISCOUNTS, sales),
        (metrics.FINDINGS, {"findings": standins.scan_findings(spark, sf_dir)}),
        (metrics.CVES, {"cve_exposure": cve_mart(spark, sf_dir)}),
        (metrics.INCIDENTS, {"incidents": incidents(spark, sf_dir)}),
        (metrics.SERVICES, {"service_performance": service_mart(spark, sf_dir)}))
    checked = [view.sanity(tables).select(F.lit(view.name).alias("metric_view"), "measure",
                                          F.round("value", 4).alias("value"), "passed")
               for view, tables in sources]
    return reduce(DataFrame.unionByName, checked)


@register("gate_metrics", base.gate_sql(
    [("describe", "n > 0", "1", "1"), ("definition", "n > 0", "0", "0"),
     ("source", "n > 0", "0", "0"), ("join_keys", "repeated = 0", "repeated", "0"),
     ("sanity", "n > 0 AND units IS NOT NULL", "0", "0")],
    base.LINES + ", m AS (SELECT COUNT(*) AS n, SUM(units) AS units, (" + " + ".join(
        f"(SELECT COUNT(*) FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} "
        f"HAVING COUNT(*) > 1) AS r)" for t, k in (
            ("part", "p_partkey"), ("orders", "o_orderkey"), ("customer", "c_custkey"),
            ("nation", "n_nationkey"), ("region", "r_regionkey")))
    + ") AS repeated FROM lines)"))
def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = metrics.METRIC_VIEWS["finance_sales_metrics"]
    return metrics_gate(
        spark, view, sales_tables(spark, sf_dir), "sales_lines",
        ["Sale Date", "Product Family", "Sales Region", "Customer Type"],
        ["Transaction Count", "Order Count", "Units Sold", "Gross Sales", "Net Sales",
         "Gross Margin", "Gross Margin Percent"])


@register("gate_metadata", base.gate_sql(
    [("tables", "tables = wanted", "tables", "wanted"),
     ("column_descriptions", "undescribed = 0", "undescribed", "0"),
     ("pi_values", "pi_columns > 0", "0", "0"), ("pi_columns", "pi_columns >= 1", "pi_columns", "1"),
     ("domains", "undomained = 0", "undomained", "0")],
    _DICTIONARY + """,
m AS (SELECT COUNT(DISTINCT table_name) AS tables, COUNT(pi_class) AS pi_columns,
        @tables@ AS wanted,
        COUNT(*) FILTER (WHERE trim(business_domain) = '') AS undomained,
        COUNT(*) FILTER (WHERE trim(description) = '') AS undescribed FROM dictionary)""".replace("@tables@", str(len(SCHEMAS)))))
def gate_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary is written once; its tables are the ones the profile covers."""
    dictionary = materialize(_dictionary(spark, sf_dir), shared_dir(spark, "dictionary"))
    return metadata_gate(dictionary, dictionary.select("table_name").distinct())


# -- the whole run ---------------------------------------------------------------
_STAGES = """SELECT '{0}' AS domain, 'bronze_transactions' AS stage, COUNT(*) AS row_count FROM {1}
UNION ALL SELECT '{0}', 'silver_documents', COUNT(*) FROM {2}
UNION ALL SELECT '{0}', 'gold_detail', COUNT(*) FROM {1}
UNION ALL SELECT '{0}', 'gold_mart', COUNT(*) FROM {3}
UNION ALL SELECT '{0}', 'gate_stages_passed', 10"""


@register("medallion_summary", base.with_ctes(
    "\nUNION ALL ".join([
        _STAGES.format("finance", "sales", "agreements", "contract_mart"),
        _STAGES.format("security", "findings", "advisories", "cve_mart"),
        _STAGES.format("itsm", "tickets", "reports", "service_mart")]),
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART, base.FINDINGS, base.ADVISORIES,
    base.CVE_MART, base.TICKETS, base.REPORTS, base.SERVICE_MART))
def medallion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three domains from bronze to gate; tickets arrive as a change log."""
    readers = {
        "finance": (lambda: standins.sales_transactions(spark, sf_dir),
                    lambda: standins.agreements(spark, sf_dir)),
        "security": (lambda: standins.scan_findings(spark, sf_dir),
                     lambda: standins.advisories(spark, sf_dir)),
        "itsm": (lambda: synthesize_log(standins.service_tickets(spark, sf_dir),
                                        F.col("ticket_id")),
                 lambda: standins.incident_reports(spark, sf_dir)),
    }
    rows = []
    for domain, (transactions, documents) in readers.items():
        run = run_domain(spark, domain_spec(domain), shared_dir(spark, f"run-{domain}"),
                         transactions, documents)
        for stage, df in run.tables.items():
            rows.append(df.agg(F.lit(domain).alias("domain"), F.lit(stage).alias("stage"),
                               F.count(F.lit(1)).alias("row_count")))
        rows.append(run.gate.agg(F.lit(domain).alias("domain"),
                                 F.lit("gate_stages_passed").alias("stage"),
                                 F.count_if("passed").alias("row_count")))
    return reduce(DataFrame.unionByName, rows)
