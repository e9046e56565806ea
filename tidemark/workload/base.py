"""SQL for the oracles: the stand-in tables and marts as common table expressions."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, units, discount_pct, gross_sales, discount_amount,
         gross_sales - discount_amount AS net_sales,
         gross_sales * CAST(0.6 AS DECIMAL(2,1)) AS cost_of_goods,
         gross_sales - discount_amount - gross_sales * CAST(0.6 AS DECIMAL(2,1)) AS gross_margin
  FROM (SELECT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS units,
               CAST(l_discount AS DECIMAL(6,4)) AS discount_pct,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_sales,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount
        FROM lineitem) AS priced)"""

SALES = LINES + """,
order_lines AS (
  SELECT l_orderkey, SUM(units) AS units, MAX(discount_pct) AS discount_pct,
         SUM(gross_sales) AS gross_sales, SUM(discount_amount) AS discount_amount,
         SUM(net_sales) AS net_sales, SUM(cost_of_goods) AS cost_of_goods,
         SUM(gross_margin) AS gross_margin
  FROM lines GROUP BY l_orderkey),
sales AS (
  SELECT o_orderkey AS transaction_id,
         CAST(o_custkey AS VARCHAR) || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_id,
         CAST(o_orderdate AS DATE) AS sale_date, o_custkey AS customer_id,
         o_orderpriority AS sales_channel, o_custkey AS contract_id,
         COALESCE(units, 0) AS units, COALESCE(discount_pct, 0) AS discount_pct,
         COALESCE(gross_sales, 0) AS gross_sales, COALESCE(discount_amount, 0) AS discount_amount,
         COALESCE(net_sales, 0) AS net_sales, COALESCE(cost_of_goods, 0) AS cost_of_goods,
         COALESCE(gross_margin, 0) AS gross_margin
  FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey)"""

AGREEMENTS = """
agreements AS (
  SELECT c_custkey AS agreement_id,
         '/agreements/' || c_mktsegment || '/' || c_name || '.pdf' AS path,
         c_name || '.pdf' AS filename, c_name AS customer_name,
         DATE '1992-01-01' + CAST(c_nationkey * 30 AS INTEGER) AS effective_date,
         DATE '1992-01-01' + CAST(c_nationkey * 30 + 3650 AS INTEGER) AS expiration_date,
         'USD' AS currency,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS minimum_procedure_commitment,
         CASE WHEN c_acctbal >= 5000 THEN 'tier 1' ELSE 'tier 2' END AS rebate_terms,
         'Nation ' || CAST(c_nationkey AS VARCHAR) AS governing_law,
         'all ' || c_mktsegment AS covered_products
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""

CONTRACT_MART = """
contract_mart AS (
  SELECT s.contract_id,
         MAX(a.path) AS contract_document_path, MAX(a.filename) AS contract_document_filename,
         MAX(a.customer_name) AS contract_customer_name,
         MAX(CAST(a.effective_date AS VARCHAR)) AS contract_effective_date,
         MAX(CAST(a.expiration_date AS VARCHAR)) AS contract_expiration_date,
         MAX(a.currency) AS contract_currency,
         MAX(a.minimum_procedure_commitment) AS contract_minimum_procedure_commitment,
         MAX(a.rebate_terms) AS contract_rebate_terms, MAX(a.governing_law) AS contract_governing_law,
         CAST(MIN(s.sale_date) AS VARCHAR) AS first_sale_date,
         CAST(MAX(s.sale_date) AS VARCHAR) AS last_sale_date,
         COUNT(s.transaction_id) AS transaction_count, COUNT(DISTINCT s.order_id) AS order_count,
         CAST(SUM(s.units) AS BIGINT) AS total_units, SUM(s.gross_sales) AS gross_sales,
         SUM(s.discount_amount) AS discount_amount, SUM(s.net_sales) AS net_sales,
         SUM(s.cost_of_goods) AS cost_of_goods, SUM(s.gross_margin) AS gross_margin,
         CAST(SUM(s.discount_pct) AS DOUBLE) / COUNT(s.discount_pct) AS average_discount_pct
  FROM sales s LEFT JOIN agreements a ON s.contract_id = a.agreement_id
  GROUP BY s.contract_id)"""

BAND = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} >= 9.0 THEN 'Critical' WHEN {0} >= 7.0 THEN 'High'
         WHEN {0} >= 4.0 THEN 'Medium' ELSE 'Low' END"""

FINDINGS = f"""
scored AS (
  SELECT *, CAST(CAST(LEAST(CAST(FLOOR(value) AS BIGINT), 100) AS DECIMAL(5,1))
            * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(3,1)) AS cvss_score,
         CAST(value AS DECIMAL(8,2)) AS amount
  FROM events),
findings AS (
  SELECT event_id AS finding_id, strftime(ts, '%Y%m%d') AS scan_id, CAST(ts AS DATE) AS scan_date,
         props->>'k' AS asset_id, event_type AS asset_type,
         CASE WHEN EXTRACT(hour FROM ts) BETWEEN 8 AND 17 THEN 'Production' ELSE 'Staging' END AS environment,
         user_id AS cve_id, 'Exposure ' || CAST(user_id AS VARCHAR) AS vulnerability_title,
         'Category ' || CAST(user_id % 5 AS VARCHAR) AS vulnerability_category,
         {BAND.format('cvss_score')} AS severity, cvss_score,
         CASE WHEN event_type IN ('error', 'view') THEN 'Open' ELSE 'Remediated' END AS status,
         date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS age_days,
         CASE {BAND.format('cvss_score')} WHEN 'Critical' THEN 7 WHEN 'High' THEN 30
              WHEN 'Medium' THEN 90 ELSE 180 END AS remediation_sla_days,
         amount AS remediation_hours, CAST(amount * 1000 AS DECIMAL(14,2)) AS asset_value_at_risk,
         amount * cvss_score AS weighted_risk, event_type = 'error' AS exploit_available
  FROM scored)"""

ADVISORIES = """
advisories AS (
  SELECT c_custkey AS cve_id,
         '/advisories/' || c_mktsegment || '/' || c_name || '.pdf' AS path,
         c_name || '.pdf' AS filename, 'Advisory on ' || c_name AS title,
         DATE '2023-01-01' + CAST(c_nationkey * 7 AS INTEGER) AS published_date,
         CASE WHEN c_acctbal >= 5000 THEN 'High' ELSE 'Low' END AS severity,
         CAST(5.0 AS DECIMAL(3,1)) AS cvss_score, 'Patch ' || c_mktsegment AS recommended_remediation
  FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'FURNITURE', 'MACHINERY'))"""

CVE_MART = f"""
cve_mart AS (
  SELECT f.cve_id, MAX(a.path) AS advisory_document_path,
         MAX(a.filename) AS advisory_document_filename, MAX(a.title) AS advisory_title,
         MAX(CAST(a.published_date AS VARCHAR)) AS advisory_published_date,
         MAX(a.recommended_remediation) AS advisory_recommended_remediation,
         MAX(f.vulnerability_title) AS vulnerability_title,
         MAX(f.vulnerability_category) AS vulnerability_category,
         {BAND.format('MAX(f.cvss_score)')} AS severity, MAX(f.cvss_score) AS cvss_score,
         BOOL_OR(f.exploit_available) AS exploit_available,
         CAST(MIN(f.scan_date) AS VARCHAR) AS first_scan_date,
         CAST(MAX(f.scan_date) AS VARCHAR) AS last_scan_date,
         COUNT(f.finding_id) AS finding_count, COUNT(DISTINCT f.scan_id) AS scan_count,
         COUNT(DISTINCT f.asset_id) AS affected_assets,
         CAST(SUM(CASE WHEN f.status = 'Open' THEN 1 ELSE 0 END) AS BIGINT) AS open_findings,
         CAST(SUM(CASE WHEN f.severity = 'Critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_findings,
         SUM(f.remediation_hours) AS remediation_hours,
         SUM(f.asset_value_at_risk) AS asset_value_at_risk, SUM(f.weighted_risk) AS weighted_risk,
         CAST(SUM(f.cvss_score) AS DOUBLE) / COUNT(f.cvss_score) AS average_cvss
  FROM findings f LEFT JOIN advisories a ON f.cve_id = a.cve_id
  GROUP BY f.cve_id)"""

TICKETS = """
shipped AS (SELECT l_orderkey, CAST(MAX(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY l_orderkey),
dated AS (
  SELECT *, CAST(o_orderdate AS DATE) AS opened,
         CASE WHEN last_ship >= CAST(o_orderdate AS DATE) THEN last_ship END AS resolved
  FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey),
tickets AS (
  SELECT o_orderkey AS ticket_id, o_orderkey AS incident_id,
         'P' || substr(o_orderpriority, 1, 1) AS priority,
         CASE WHEN resolved IS NULL THEN 'Open' ELSE 'Resolved' END AS status,
         'Group ' || CAST(o_custkey % 7 AS VARCHAR) AS assignment_group,
         'Service ' || o_orderstatus AS service, 'ci-' || CAST(o_custkey AS VARCHAR) AS configuration_item,
         CAST(opened AS VARCHAR) AS opened_at, CAST(resolved AS VARCHAR) AS resolved_at,
         CAST(date_diff('day', opened, resolved) * 24 AS DECIMAL(8,2)) AS resolution_hours,
         COALESCE(date_diff('day', opened, resolved) * 24 > 720, FALSE) AS sla_breached
  FROM dated)"""

REPORTS = """
reports AS (
  SELECT o_orderkey AS incident_id, '/incident_report/' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS path,
         CAST(o_orderkey AS VARCHAR) || '.pdf' AS filename,
         'Value ' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS impact
  FROM orders WHERE o_orderstatus = 'F')"""

SERVICE_MART = """
service_mart AS (
  SELECT t.incident_id, MAX(r.path) AS incident_document_path, MAX(t.service) AS service,
         MAX(t.priority) AS priority, MAX(t.assignment_group) AS assignment_group,
         MAX(t.configuration_item) AS configuration_item, COUNT(t.ticket_id) AS incident_count,
         CAST(SUM(t.resolution_hours) AS DOUBLE) / NULLIF(COUNT(t.resolution_hours), 0) AS mttr_hours,
         CAST(SUM(CASE WHEN t.sla_breached THEN 1 ELSE 0 END) AS BIGINT) AS sla_breach_count
  FROM tickets t LEFT JOIN reports r ON t.incident_id = r.incident_id
  GROUP BY t.incident_id)"""

LOG = """
change_log AS (
  SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(12,2)) AS value, props,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS change_type
  FROM events),
live AS (
  SELECT user_id, event_id, event_type, value, props
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM change_log) AS ranked
  WHERE rn = 1 AND change_type <> 'delete')"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def gate_sql(stages: list[tuple[str, str, str, str]], ctes: str) -> str:
    """Stage rows from scalar SQL; ``stages`` holds (name, passed, observed, expected).

    ``ctes`` must define the one-row relation ``m`` with every number.
    """
    rows = "\nUNION ALL ".join(
        f"SELECT {i} AS stage_no, '{name}' AS stage, COALESCE({passed}, FALSE) AS passed, "
        f"CAST({observed} AS BIGINT) AS observed, CAST({expected} AS BIGINT) AS expected FROM m"
        for i, (name, passed, observed, expected) in enumerate(stages, 1))
    return f"""WITH {ctes},
stages AS ({rows}),
failure AS (SELECT MIN(stage_no) AS first_failure FROM stages WHERE NOT passed)
SELECT CAST(stage_no AS BIGINT) AS stage_no, stage, passed, observed, expected,
       CASE WHEN first_failure IS NULL OR stage_no < first_failure THEN 'pass'
            WHEN stage_no = first_failure THEN 'fail' ELSE 'not reached' END AS verdict
FROM stages CROSS JOIN failure"""


def gold_gate_sql(ctes: str, source: str, documents: str, mart: str, key: str, group: str,
                  document_key: str, sums: dict[str, str], detail: str | None = None) -> str:
    """The gold gate's stages over a detail table and mart built from the same CTEs.

    ``detail`` replaces the detail table: columns k, g and doc over ``s`` and ``d``.
    """
    detail = detail or f"s.{key} AS k, s.{group} AS g, d.{document_key} AS doc"
    wrong = " OR ".join(
        [f"e.{m} IS DISTINCT FROM CAST(x.{m} AS DECIMAL(38,6))" for m in sums] or ["FALSE"])
    expected = ", ".join(
        [f"CAST({agg} AS DECIMAL(38,6)) AS {m}" for m, agg in sums.items()] or ["COUNT(*) AS n"])
    numbers = f"""{ctes},
detail AS (SELECT {detail}
           FROM {source} s LEFT JOIN {documents} d ON s.{group} = d.{document_key}),
wanted AS (SELECT s.{key} AS k FROM {source} s JOIN {documents} d ON s.{group} = d.{document_key}),
e AS (SELECT {group} AS g, {expected} FROM {source} GROUP BY {group}),
m AS (SELECT
  (SELECT COUNT(*) FROM {source}) AS source_rows,
  (SELECT COUNT(DISTINCT {key}) FROM {source}) AS source_distinct,
  (SELECT COUNT(*) FROM {source} WHERE {group} IS NULL) AS blank_groups,
  (SELECT COUNT(*) FROM {documents}) AS documents_rows,
  (SELECT COUNT(DISTINCT {document_key}) FROM {documents}) AS documents_distinct,
  (SELECT COUNT(DISTINCT k) FROM wanted) AS expected_enriched,
  (SELECT COUNT(*) FROM detail) AS detail_rows,
  (SELECT COUNT(DISTINCT k) FROM detail) AS detail_distinct,
  (SELECT COUNT(*) FROM (SELECT {key} FROM {source} EXCEPT SELECT k FROM detail) AS a)
   + (SELECT COUNT(*) FROM (SELECT k FROM detail EXCEPT SELECT {key} FROM {source}) AS b) AS identity,
  (SELECT COUNT(*) FROM {source} s FULL JOIN detail d ON s.{key} = d.k
   WHERE s.{key} IS NULL OR d.k IS NULL
      OR (d.doc IS NOT NULL AND s.{group} IS DISTINCT FROM d.doc)) AS wrong_documents,
  (SELECT COUNT(*) FROM (SELECT k FROM wanted EXCEPT SELECT k FROM detail WHERE doc IS NOT NULL) AS a)
   + (SELECT COUNT(*) FROM (SELECT k FROM detail WHERE doc IS NOT NULL EXCEPT SELECT k FROM wanted) AS b)
   AS enrichment,
  (SELECT COUNT(DISTINCT {group}) FROM {source}) AS group_count,
  (SELECT COUNT(*) FROM {mart}) AS mart_rows,
  (SELECT COUNT(DISTINCT {group}) FROM {mart}) AS mart_distinct,
  (SELECT COUNT(*) FROM e FULL JOIN {mart} x ON e.g = x.{group}
   WHERE e.g IS NULL OR x.{group} IS NULL) AS mart_identity,
  (SELECT COUNT(*) FROM e FULL JOIN {mart} x ON e.g = x.{group}
   WHERE e.g IS NULL OR x.{group} IS NULL OR {wrong}) AS mart_wrong)"""
    return gate_sql([
        ("source", "source_rows > 0 AND source_distinct = source_rows AND blank_groups = 0",
         "source_distinct", "source_rows"),
        ("documents", "documents_rows > 0 AND documents_distinct = documents_rows",
         "documents_distinct", "documents_rows"),
        ("upstream_join", "expected_enriched > 0", "expected_enriched", "1"),
        ("detail", "detail_distinct = detail_rows AND detail_rows = source_rows",
         "detail_rows", "source_rows"),
        ("detail_identity", "identity = 0", "identity", "0"),
        ("detail_join", "wrong_documents = 0", "wrong_documents", "0"),
        ("enrichment", "enrichment = 0", "enrichment", "0"),
        ("mart", "mart_distinct = mart_rows AND mart_rows = group_count", "mart_rows", "group_count"),
        ("mart_identity", "mart_identity = 0", "mart_identity", "0"),
        ("mart_reconciliation", "mart_wrong = 0", "mart_wrong", "0"),
    ], numbers)
