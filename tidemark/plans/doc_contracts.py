"""The fields of every document class, by domain.

A field is found on a line ``Field Name: value``. Nested fields are repeated
lines whose parts are separated by ``|`` in the order given here.
"""

from __future__ import annotations

from tidemark.operators.documents import FieldRule, labelled


def _fields(*rules: str | FieldRule, required: str | None = None) -> tuple[FieldRule, ...]:
    """``name`` for text, ``name#`` for a number; rules pass through."""
    out = []
    for rule in rules:
        if isinstance(rule, str):
            name = rule.rstrip("#")
            rule = labelled(name, "number" if rule.endswith("#") else "string", name == required)
        out.append(rule)
    return tuple(out)


def _records(name: str, *parts: str) -> FieldRule:
    return labelled(name, "records", parts=tuple(
        (p.rstrip("#"), "number" if p.endswith("#") else "string") for p in parts))


def _list(name: str) -> FieldRule:
    return labelled(name, "list")


FINANCE = {
    "vendor_invoice": _fields(
        "invoice_number", "vendor_name", "invoice_date", "due_date", "purchase_order_number",
        "currency", "subtotal#", "tax_amount#", "freight_amount#", "total_amount#",
        _records("line_items", "item", "description", "quantity#", "unit_price#", "line_amount#"),
        required="invoice_number"),
    "purchase_order": _fields(
        "purchase_order_number", "buyer_name", "vendor_name", "order_date",
        "requested_delivery_date", "ship_to", "payment_terms", "currency", "total_amount#",
        _records("line_items", "line_number", "description", "quantity#", "unit_price#",
                 "line_amount#"),
        required="purchase_order_number"),
    "sales_contract_pricing_agreement": _fields(
        "agreement_id", "customer_name", "effective_date", "expiration_date", "currency",
        "minimum_procedure_commitment", "rebate_terms", "governing_law",
        _records("covered_products", "sku", "product_family", "list_price#", "discount_pct#",
                 "contract_price#"),
        required="agreement_id"),
    "quarterly_financial_statement": _fields(
        "entity_name", "reporting_period", "period_end_date", "currency_scale", "net_sales#",
        "cost_of_sales#", "gross_profit#", "operating_income#", "net_income#",
        "cash_and_equivalents#"),
    "other": _fields(
        "document_subtype", "document_number", "document_date", "issuer_or_preparer",
        "counterparty_or_cost_center", "amount#", "currency", _list("referenced_documents")),
}

SECURITY = {
    "vulnerability_scan": _fields(
        "scan_id", "scanner_name", "scan_date", "target_scope", "authenticated",
        "total_findings#", "critical_count#", "high_count#", "medium_count#", "low_count#",
        "highest_cvss#",
        _records("top_findings", "cve_id", "asset", "category", "cvss#", "status"),
        required="scan_id"),
    "cve_advisory": _fields(
        "cve_id", "title", "published_date", "last_updated", "severity", "cvss_score#",
        "cvss_vector", "exploit_observed", "affected_products", "recommended_remediation",
        _list("references"), required="cve_id"),
    "pentest_report": _fields(
        "engagement_id", "test_type", "start_date", "end_date", "tester_name", "overall_risk",
        "findings_count#", _records("exploited_paths", "attack_path", "impact", "related_cve"),
        _list("recommendations"), required="engagement_id"),
    "cloud_posture_finding": _fields(
        "finding_id", "cloud_provider", "service", "control_id", "benchmark", "severity",
        "region", "status", "resource_id", "first_detected_date", "remediation_guidance",
        required="finding_id"),
    "other": _fields(
        "document_subtype", "document_number", "document_date", "owner_or_preparer", "subject",
        "classification", _list("referenced_documents")),
}

ITSM = {
    "incident_report": _fields(
        "incident_id", "priority", "service", "configuration_item", "opened_at", "resolved_at",
        "impact", required="incident_id"),
    "post_incident_review": _fields(
        "incident_id", "root_cause", "severity", "corrective_action", "owner_team", "review_date",
        required="incident_id"),
    "change_request": _fields(
        "change_id", "service", "risk", "implementation_window", "rollback_plan",
        "approval_status", required="change_id"),
    "kb_article_sop": _fields(
        "kb_id", "title", "applies_to", "procedure_steps", "escalation_path", required="kb_id"),
    "other": _fields(
        "document_subtype", "document_number", "document_date", "issuer_or_preparer"),
}

CONTRACTS = {"finance": FINANCE, "security": SECURITY, "itsm": ITSM}
