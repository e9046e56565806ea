"""The metric views of the three domains (names, dimensions, measures).

Views over marts add up what the mart holds. Note that ``Order Count`` of the
contract view and ``Affected Assets`` of the CVE view therefore add distinct
counts across keys, and ``MTTR Hours`` of the service view is a mean of means;
the detail views have the exact figures.
"""

from __future__ import annotations

from tidemark.operators.semantic import (
    Dimension as Dim, Join, MetricView, count, count_if, distinct, mean, ratio, total,
)

# Sales lines have no dimension columns of their own: every one is a join away.
SALES_JOINS = (
    Join("part", "l_partkey", "p_partkey", unique=True),
    Join("orders", "l_orderkey", "o_orderkey", unique=True),
    Join("customer", "o_custkey", "c_custkey", after="orders", unique=True),
    Join("nation", "c_nationkey", "n_nationkey", after="customer", bounded=True, unique=True),
    Join("region", "n_regionkey", "r_regionkey", after="nation", bounded=True, unique=True),
)


def _sales_measures(order: str):
    return (
        count("Transaction Count"),
        distinct("Order Count", order),
        total("Units Sold", "units"),
        total("Gross Sales", "gross_sales"),
        total("Net Sales", "net_sales"),
        total("Gross Margin", "gross_margin"),
        ratio("Gross Margin Percent", "Gross Margin", "Net Sales"),
    )


_DISCOUNT_MEASURES = (
    total("Gross Sales", "gross_sales"),
    total("Discount Amount", "discount_amount"),
    total("Net Sales", "net_sales"),
    ratio("Discount Rate", "Discount Amount", "Gross Sales"),
)

SALES = MetricView(
    name="finance_sales_metrics", source="sales_lines",
    comment="Sales revenue and margin metrics",
    joins=SALES_JOINS,
    dimensions=(
        Dim("Sale Date", "to_date(o_orderdate)", "orders"),
        Dim("Product Family", "p_brand", "part"),
        Dim("Sales Region", "r_name", "region"),
        Dim("Customer Type", "c_mktsegment", "customer"),
    ),
    measures=_sales_measures("l_orderkey"))

CONTRACTS = MetricView(
    name="finance_contract_metrics", source="contract_performance",
    comment="Commercial-agreement performance metrics",
    dimensions=(
        Dim("Contract ID", "contract_id"),
        Dim("Customer", "contract_customer_name"),
        Dim("Currency", "contract_currency"),
    ),
    measures=(
        total("Transaction Count", "transaction_count"),
        total("Order Count", "order_count"),
        total("Total Units", "total_units"),
        total("Gross Sales", "gross_sales"),
        total("Net Sales", "net_sales"),
        total("Gross Margin", "gross_margin"),
        ratio("Gross Margin Percent", "Gross Margin", "Net Sales"),
    ))

DISCOUNTS = MetricView(
    name="finance_discount_metrics", source="sales_lines",
    comment="Discount metrics by product family and sales channel",
    joins=SALES_JOINS,
    dimensions=(
        Dim("Product Family", "p_brand", "part"),
        Dim("Sales Channel", "o_orderpriority", "orders"),
        Dim("Customer Type", "c_mktsegment", "customer"),
    ),
    measures=_DISCOUNT_MEASURES)

# The same two views over a detail table that has the dimensions as columns.
GOLD_SALES = MetricView(
    name="finance_sales_metrics", source="gold_sales", comment=SALES.comment,
    dimensions=(
        Dim("Sale Date", "sale_date"),
        Dim("Product Family", "product_family"),
        Dim("Sales Region", "sales_region"),
        Dim("Customer Type", "customer_type"),
    ),
    measures=_sales_measures("order_id"))

GOLD_DISCOUNTS = MetricView(
    name="finance_discount_metrics", source="gold_sales", comment=DISCOUNTS.comment,
    dimensions=(
        Dim("Product Family", "product_family"),
        Dim("Sales Channel", "sales_channel"),
        Dim("Customer Type", "customer_type"),
    ),
    measures=_DISCOUNT_MEASURES)

FINDINGS = MetricView(
    name="security_findings_metrics", source="findings",
    comment="Exposure and remediation metrics by asset and severity",
    dimensions=(
        Dim("Scan Date", "scan_date"),
        Dim("Asset Type", "asset_type"),
        Dim("Environment", "environment"),
        Dim("Severity", "severity"),
        Dim("Vulnerability Category", "vulnerability_category"),
    ),
    measures=(
        count("Finding Count"),
        distinct("Scan Count", "scan_id"),
        distinct("Affected Assets", "asset_id"),
        count_if("Open Findings", "status = 'Open'"),
        count_if("Critical Findings", "severity = 'Critical'"),
        total("Remediation Hours", "remediation_hours"),
        total("Value at Risk", "asset_value_at_risk"),
        mean("Average CVSS", "cvss_score"),
    ))

CVES = MetricView(
    name="security_cve_metrics", source="cve_exposure",
    comment="Per-CVE exposure metrics",
    dimensions=(
        Dim("CVE ID", "cve_id"),
        Dim("Severity", "severity"),
        Dim("Vulnerability Category", "vulnerability_category"),
    ),
    measures=(
        total("Finding Count", "finding_count"),
        total("Open Findings", "open_findings"),
        total("Critical Findings", "critical_findings"),
        total("Affected Assets", "affected_assets"),
        total("Remediation Hours", "remediation_hours"),
        total("Value at Risk", "asset_value_at_risk"),
        total("Weighted Risk", "weighted_risk"),
    ))

INCIDENTS = MetricView(
    name="itsm_incident_metrics", source="incidents",
    comment="Incident volume, SLA and MTTR metrics",
    dimensions=(
        Dim("Priority", "priority"),
        Dim("Service", "service"),
        Dim("Assignment Group", "assignment_group"),
    ),
    measures=(
        count("Incident Volume"),
        mean("MTTR Hours", "resolution_hours"),
        count_if("SLA Breach Count", "sla_breached"),
    ))

SERVICES = MetricView(
    name="itsm_service_metrics", source="service_performance",
    comment="Service performance metrics",
    dimensions=(
        Dim("Service", "service"),
        Dim("Priority", "priority"),
    ),
    measures=(
        total("Incident Volume", "incident_count"),
        mean("MTTR Hours", "mttr_hours"),
        total("SLA Breach Count", "sla_breach_count"),
    ))

METRIC_VIEWS = {view.name: view for view in (
    SALES, CONTRACTS, DISCOUNTS, FINDINGS, CVES, INCIDENTS, SERVICES)}
