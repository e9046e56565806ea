"""A whole domain run on rows of the transactional contract, from log to metrics."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents as docs_ops
from tidemark.operators.cdc import synthesize_log
from tidemark.plans import doc_contracts, txn_contracts
from tidemark.plans.domains import domain_spec
from tidemark.plans.medallion import run_domain
from tidemark.plans.metrics import CONTRACTS, GOLD_DISCOUNTS, GOLD_SALES
from tidemark.session import shared_dir

AGREEMENT = """Sales Contract Pricing Agreement
Agreement ID: A-{0}
Customer Name: Customer {0}
Effective Date: 2026-01-0{0}
Expiration Date: 2026-12-31
Currency: USD
Governing Law: Delaware
Covered Products: SKU-1 | Ortho | 100 | 18% | $82.00
"""


def sale(i):
    schema = txn_contracts.schema("finance")
    gross, discount = D(100 + i), D("10.00")
    net = gross - discount
    values = {
        "transaction_id": f"T{i}", "order_id": f"O{i // 2}", "product_family": f"F{i % 2}",
        "sales_region": "West", "sales_channel": "Direct", "customer_type": "Clinic",
        "contract_id": f"A-{i % 4 + 1}", "units": 1, "unit_price": gross, "gross_sales": gross,
        "discount_pct": D("0.1"), "discount_amount": discount, "net_sales": net,
        "cost_of_goods": D("40.00"), "gross_margin": net - D("40.00")}
    return tuple(values.get(f.name) for f in schema)


@pytest.fixture(scope="module")
def run(spark):
    snapshot = spark.createDataFrame([sale(i) for i in range(12)], txn_contracts.schema("finance"))
    log = synthesize_log(snapshot, F.lit(1))
    stale = synthesize_log(snapshot.withColumn("net_sales", F.lit(0).cast("decimal(14,2)")), F.lit(0))
    gone = synthesize_log(snapshot.where("transaction_id = 'T11'"), F.lit(2)).withColumn(
        "_pg_change_type", F.lit("delete"))
    texts = spark.createDataFrame(
        [(f"/d/{i}.txt", f"{i}.txt", "sales_contract_pricing_agreement", AGREEMENT.format(i))
         for i in (1, 2, 3)], "path string, filename string, doc_class string, parsed_text string")
    agreements = docs_ops.class_table(
        docs_ops.extract(texts, doc_contracts.FINANCE), "sales_contract_pricing_agreement")
    return run_domain(spark, domain_spec("finance"), shared_dir(spark, "run"),
                      lambda: log.unionByName(stale).unionByName(gone), lambda: agreements)


def test_stages_and_gate(run):
    assert {k: v.count() for k, v in run.tables.items()} == {
        "bronze_transactions": 11, "silver_documents": 3, "gold_detail": 11, "gold_mart": 4}
    stages = run.gate.collect()
    assert len(stages) == 10 and all(r.passed for r in stages)


def test_mart_row(run):
    row = run.tables["gold_mart"].where("contract_id = 'A-1'").first()
    assert (row.transaction_count, row.order_count, row.total_units) == (3, 3, 3)
    assert row.net_sales == D(90 + 94 + 98) and row.average_discount_pct == pytest.approx(0.1)
    assert (row.contract_customer_name, str(row.contract_effective_date)) == ("Customer 1", "2026-01-01")
    assert run.tables["gold_mart"].where("contract_id = 'A-4'").first().contract_document_path is None


def test_documents_carry_nested_products(run):
    row = run.tables["gold_detail"].where("contract_id = 'A-2'").first()
    product = row.contract_covered_products[0]
    assert (product.sku, product.discount_pct, product.contract_price) == ("SKU-1", 0.18, 82.0)


def test_metric_views_on_the_run(run):
    sales = {r[0]: r for r in run.metrics(
        GOLD_SALES, "gold_detail", ["Product Family"], ["Transaction Count", "Net Sales"]).collect()}
    assert sales["F0"]["Transaction Count"] == 6
    assert sales["F0"]["Net Sales"] == sum(90 + i for i in range(0, 11, 2))
    rate = run.metrics(GOLD_DISCOUNTS, "gold_detail", [], ["Discount Rate"]).first()[0]
    assert rate == pytest.approx(110 / sum(100 + i for i in range(11)))
    total = run.metrics(CONTRACTS, "gold_mart", [], ["Net Sales", "Order Count"]).first()
    assert total["Net Sales"] == sum(90 + i for i in range(11))


def test_unknown_domain():
    with pytest.raises(ValueError, match="finance, security, itsm"):
        domain_spec("hr")
    assert domain_spec(" Finance ").name == "finance"
