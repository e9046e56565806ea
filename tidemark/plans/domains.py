"""The three domains: keys, document attributes, marts and measure checks.

One spec drives the same operators for every domain. Fixed values: the column names of
the detail tables and marts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.gold import (
    Different, Mart, Mean, Total, enrich, mart_from_detail, mart_from_source,
)
from tidemark.operators.incremental import Retractable
from tidemark.operators.reconcile import MeasureCheck


@dataclass(frozen=True)
class DomainSpec:
    """Names, keys and measures of one domain."""

    name: str
    source_key: str
    group_key: str
    document_key: str
    detail_document_key: str
    detail_document_match: str
    carry: tuple[tuple[str, str | Column], ...]
    mart: Mart
    checks: tuple[MeasureCheck, ...]

    def detail(self, facts: DataFrame, documents: DataFrame) -> DataFrame:
        return enrich(facts, documents, self.group_key, self.document_key, dict(self.carry))

    def mart_of(self, detail: DataFrame) -> DataFrame:
        """The mart of a persisted detail table."""
        return mart_from_detail(detail, self.mart)

    def mart_direct(self, facts: DataFrame, documents: DataFrame) -> DataFrame:
        """The same mart, aggregated before documents are joined."""
        return mart_from_source(facts, documents, self.mart, self.document_key, dict(self.carry))


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def finance() -> DomainSpec:
    carry = (
        ("contract_agreement_id", "agreement_id"),
        ("contract_document_path", "path"),
        ("contract_document_filename", "filename"),
        ("contract_customer_name", "customer_name"),
        ("contract_effective_date", F.to_date("effective_date")),
        ("contract_expiration_date", F.to_date("expiration_date")),
        ("contract_currency", "currency"),
        ("contract_minimum_procedure_commitment", "minimum_procedure_commitment"),
        ("contract_rebate_terms", "rebate_terms"),
        ("contract_governing_law", "governing_law"),
        ("contract_covered_products", "covered_products"),
    )
    mart = Mart(
        group_key="contract_id",
        attributes=tuple(name for name, _ in carry[1:10]),
        measures=(
            ("first_sale_date", F.min("sale_date")),
            ("last_sale_date", F.max("sale_date")),
            ("transaction_count", F.count("transaction_id")),
            ("order_count", Different("order_id")),
            ("total_units", Total("units")),
            ("gross_sales", Total("gross_sales")),
            ("discount_amount", Total("discount_amount")),
            ("net_sales", Total("net_sales")),
            ("cost_of_goods", Total("cost_of_goods")),
            ("gross_margin", Total("gross_margin")),
            ("average_discount_pct", Mean("discount_pct")),
        ))
    return DomainSpec(
        name="finance", source_key="transaction_id", group_key="contract_id",
        document_key="agreement_id", detail_document_key="contract_agreement_id",
        detail_document_match="contract_document_path", carry=carry, mart=mart,
        checks=(
            MeasureCheck("transaction_count", "count"),
            MeasureCheck("order_count", "count_distinct", "order_id"),
            MeasureCheck("total_units", "sum", "units"),
            MeasureCheck("gross_sales"),
            MeasureCheck("net_sales"),
            MeasureCheck("gross_margin"),
        ))


def security() -> DomainSpec:
    carry = (
        ("advisory_cve_id", "cve_id"),
        ("advisory_document_path", "path"),
        ("advisory_document_filename", "filename"),
        ("advisory_title", "title"),
        ("advisory_published_date", F.to_date("published_date")),
        ("advisory_severity", "severity"),
        ("advisory_cvss_score", "cvss_score"),
        ("advisory_recommended_remediation", "recommended_remediation"),
    )
    mart = Mart(
        group_key="cve_id",
        attributes=("advisory_document_path", "advisory_document_filename", "advisory_title",
                    "advisory_published_date", "advisory_recommended_remediation"),
        fact_attributes=("vulnerability_title", "vulnerability_category"),
        # The severity of the highest score as the source reports it, not recomputed.
        picked=(("severity", "cvss_score", "severity"),),
        measures=(
            ("cvss_score", F.max("cvss_score")),
            ("exploit_available", F.max("exploit_available")),
            ("first_scan_date", F.min("scan_date")),
            ("last_scan_date", F.max("scan_date")),
            ("finding_count", F.count("finding_id")),
            ("scan_count", Different("scan_id")),
            ("affected_assets", Different("asset_id")),
            ("open_findings", _sum_if(F.col("status") == "Open")),
            ("critical_findings", _sum_if(F.col("severity") == "Critical")),
            ("remediation_hours", Total("remediation_hours")),
            ("asset_value_at_risk", Total("asset_value_at_risk")),
            ("weighted_risk", Total("weighted_risk")),
            ("average_cvss", Mean("cvss_score")),
        ))
    return DomainSpec(
        name="security", source_key="finding_id", group_key="cve_id",
        document_key="cve_id", detail_document_key="advisory_cve_id",
        detail_document_match="advisory_document_path", carry=carry, mart=mart,
        checks=(MeasureCheck("remediation_hours"), MeasureCheck("asset_value_at_risk"),
                MeasureCheck("weighted_risk")))


def itsm() -> DomainSpec:
    carry = (
        ("report_incident_id", "incident_id"),
        ("incident_document_path", "path"),
        ("documented_impact", "impact"),
    )
    mart = Mart(
        group_key="incident_id",
        attributes=("incident_document_path",),
        fact_attributes=("service", "priority", "assignment_group", "configuration_item"),
        collapses=False,  # an incident has hardly more than one ticket
        measures=(
            ("incident_count", F.count("ticket_id")),
            ("mttr_hours", Mean("resolution_hours")),
            ("sla_breach_count", _sum_if(F.col("sla_breached"))),
        ))
    return DomainSpec(
        name="itsm", source_key="ticket_id", group_key="incident_id",
        document_key="incident_id", detail_document_key="report_incident_id",
        detail_document_match="incident_document_path", carry=carry, mart=mart, checks=())


#: The measures of the finance mart in a form that can take facts back.
FINANCE_RETRACTABLE = (
    Retractable("first_sale_date", "low", "sale_date"),
    Retractable("last_sale_date", "high", "sale_date"),
    Retractable("transaction_count", "count", "transaction_id"),
    Retractable("order_count", "distinct", "order_id"),
    *[Retractable(name, "total", column) for name, column in (
        ("total_units", "units"), *[(c, c) for c in (
            "gross_sales", "discount_amount", "net_sales", "cost_of_goods", "gross_margin")])],
    Retractable("average_discount_pct", "mean", "discount_pct"),
)

# Builders, as column expressions need a running session.
DOMAINS = {"finance": finance, "security": security, "itsm": itsm}


def domain_spec(name: str | None) -> DomainSpec:
    key = (name or "").strip().lower()
    if key not in DOMAINS:
        raise ValueError(f"unknown domain {key!r}; choose one of: {', '.join(DOMAINS)}")
    return DOMAINS[key]()
