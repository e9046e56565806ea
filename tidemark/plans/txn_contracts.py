"""The columns, types and row constraints of the transactional tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import severity_band
from tidemark.operators.cdc import current_state
from tidemark.sources.files import CHANGE_TYPE, select_contract

SALES_TRANSACTIONS = """
transaction_id string, order_id string, sale_date date, posting_timestamp timestamp,
customer_id string, customer_name string, customer_type string, facility_state string,
sales_region string, sales_rep_id string, product_sku string, product_family string,
procedure_category string, units int, unit_price decimal(12,2), gross_sales decimal(14,2),
discount_pct decimal(6,4), discount_amount decimal(14,2), net_sales decimal(14,2),
cost_of_goods decimal(14,2), gross_margin decimal(14,2), currency string, sales_channel string,
contract_id string, purchase_order_number string, invoice_number string, payment_status string,
source_updated_at timestamp
"""

SCAN_FINDINGS = """
finding_id string, scan_id string, scan_date date, detected_timestamp timestamp, asset_id string,
asset_name string, asset_type string, environment string, business_unit string, owner_team string,
cve_id string, vulnerability_title string, vulnerability_category string, severity string,
cvss_score decimal(3,1), cvss_vector string, status string, first_detected_date date,
age_days int, remediation_sla_days int, remediation_hours decimal(8,2),
asset_value_at_risk decimal(14,2), weighted_risk decimal(10,2), exploit_available boolean,
detection_source string, source_updated_at timestamp
"""

SERVICE_TICKETS = """
ticket_id string, incident_id string, priority string, status string, assignment_group string,
service string, configuration_item string, opened_at string, resolved_at string,
resolution_hours double, sla_breached boolean, category string, root_cause_code string,
source_updated_at string
"""

CONFIGURATION_ITEMS = """
configuration_item string, service string, environment string, owner_team string,
criticality string
"""

_DDL = {"finance": SALES_TRANSACTIONS, "security": SCAN_FINDINGS, "itsm": SERVICE_TICKETS}
_KEYS = {"finance": "transaction_id", "security": "finding_id", "itsm": "ticket_id"}


def schema(domain: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[domain])


def constraints(domain: str) -> dict[str, Column]:
    """The CHECK constraints of a domain's table, and the arithmetic its columns must obey."""
    c = F.col
    if domain == "finance":
        return {
            "units_positive": c("units") > 0,
            "unit_price_not_negative": c("unit_price") >= 0,
            "gross_sales_not_negative": c("gross_sales") >= 0,
            "discount_pct_in_range": c("discount_pct").between(0, 1),
            "discount_amount_not_negative": c("discount_amount") >= 0,
            "net_sales_not_negative": c("net_sales") >= 0,
            "cost_of_goods_not_negative": c("cost_of_goods") >= 0,
            "gross_is_units_times_price": c("gross_sales") == c("units") * c("unit_price"),
            "net_is_gross_less_discount":
                c("net_sales") == c("gross_sales") - c("discount_amount"),
            "margin_is_net_less_cost":
                c("gross_margin") == c("net_sales") - c("cost_of_goods"),
        }
    if domain == "security":
        return {
            "cvss_score_in_range": c("cvss_score").between(0, 10),
            "age_days_not_negative": c("age_days") >= 0,
            "remediation_sla_days_positive": c("remediation_sla_days") > 0,
            "remediation_hours_not_negative": c("remediation_hours") >= 0,
            "asset_value_at_risk_not_negative": c("asset_value_at_risk") >= 0,
            "weighted_risk_not_negative": c("weighted_risk") >= 0,
            "severity_is_cvss_band": c("severity").eqNullSafe(severity_band("cvss_score")),
        }
    return {"resolution_hours_not_negative": c("resolution_hours") >= 0}


def bronze(domain: str, source: DataFrame) -> DataFrame:
    """A snapshot or a change log as the domain's bronze table: exactly its columns.

    A change log is reduced to the latest non-deleted image per key.
    """
    columns = schema(domain).names
    if CHANGE_TYPE in source.columns:
        return current_state(source, _KEYS[domain], columns)
    return select_contract(source, columns, f"{domain} transactions")
