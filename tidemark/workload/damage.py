"""Checks and gates over damaged inputs, where they have something to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import integrity
from tidemark.plans import standins, txn_contracts
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import gold_gate, serving_gate
from tidemark.operators import serving
from tidemark.session import shared_dir
from tidemark.sources import sinks
from tidemark.sources.tables import table
from tidemark.workload import base
from tidemark.workload.finance import written_gold
from tidemark.workload.registry import register
from tidemark.workload.serving import publish


# -- declared CHECK constraints ------------------------------------------------------------
def _checks_sql(rules: dict[str, str], rows: str) -> str:
    return f"WITH {rows}\n" + "\nUNION ALL ".join(
        f"SELECT COUNT(*) AS checked_rows, '{name}' AS constraint_name, "
        f"COUNT(*) FILTER (WHERE NOT ({rule})) AS violations FROM checked"
        for name, rule in rules.items())


def _violations(df: DataFrame, domain: str) -> DataFrame:
    return integrity.constraint_violations(df, txn_contracts.constraints(domain))


@register("txn_checks_finance", _checks_sql({
    "units_positive": "units > 0", "unit_price_not_negative": "unit_price >= 0",
    "gross_sales_not_negative": "gross_sales >= 0",
    "discount_pct_in_range": "discount_pct BETWEEN 0 AND 1",
    "discount_amount_not_negative": "discount_amount >= 0",
    "net_sales_not_negative": "net_sales >= 0",
    "cost_of_goods_not_negative": "cost_of_goods >= 0",
    "gross_is_units_times_price": "gross_sales = units * unit_price",
    "net_is_gross_less_discount": "net_sales = gross_sales - discount_amount",
    "margin_is_net_less_cost": "gross_margin = net_sales - cost_of_goods",
}, base.LINES + """,
checked AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS units,
         CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT) * CAST(0.01 AS DECIMAL(4,2)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS gross_sales,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_discount AS DECIMAL(6,4)) ELSE -CAST(l_discount AS DECIMAL(6,4)) END AS discount_pct,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS net_sales,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)) AS cost_of_goods,
         CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
           - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)) AS gross_margin
  FROM lineitem)"""))
def txn_checks_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a careless export gives them: returns negative, open lines' discounts with
    the wrong sign, tax taken for the discount, unit prices cut to cents."""
    lines = table(spark, sf_dir, "lineitem")
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    units = F.col("l_quantity").cast("bigint")
    part = lambda name: amount * F.col(name).cast("decimal(4,2)")
    rate = F.col("l_discount").cast("decimal(6,4)")
    cost = amount * F.lit("0.6").cast("decimal(2,1)")
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    return _violations(lines.select(
        F.when(F.col("l_returnflag") == "R", -units).otherwise(units).alias("units"),
        (cents * F.lit("0.01").cast("decimal(4,2)")).alias("unit_price"),
        amount.alias("gross_sales"),
        F.when(F.col("l_linestatus") == "F", rate).otherwise(-rate).alias("discount_pct"),
        part("l_discount").alias("discount_amount"), (amount - part("l_tax")).alias("net_sales"),
        cost.alias("cost_of_goods"),
        (amount - part("l_discount") - cost).alias("gross_margin")), "finance")


@register("txn_checks_security", _checks_sql({
    "cvss_score_in_range": "cvss_score BETWEEN 0 AND 10", "age_days_not_negative": "age_days >= 0",
    "remediation_sla_days_positive": "remediation_sla_days > 0",
    "remediation_hours_not_negative": "remediation_hours >= 0",
    "asset_value_at_risk_not_negative": "asset_value_at_risk >= 0",
    "weighted_risk_not_negative": "weighted_risk >= 0",
    "severity_is_cvss_band": f"severity IS NOT DISTINCT FROM {base.BAND.format('cvss_score')}",
}, base.FINDINGS + """,
checked AS (
  SELECT * REPLACE (age_days - 20 AS age_days, remediation_hours - 50 AS remediation_hours,
                    cvss_score * 2 AS cvss_score, weighted_risk - 100 AS weighted_risk)
  FROM findings)"""))
def txn_checks_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with scores on another scale and measures that were shifted."""
    return _violations(standins.scan_findings(spark, sf_dir).withColumns({
        "age_days": F.col("age_days") - 20, "remediation_hours": F.col("remediation_hours") - 50,
        "cvss_score": F.col("cvss_score") * 2, "weighted_risk": F.col("weighted_risk") - 100}),
        "security")


@register("txn_checks_itsm", """WITH checked AS (
  SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * 24 - 720 AS resolution_hours
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT COUNT(*) AS checked_rows, 'resolution_hours_not_negative' AS constraint_name,
  COUNT(*) FILTER (WHERE NOT (resolution_hours >= 0)) AS violations FROM checked""")
def txn_checks_itsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as tickets that count from their deadline on: early ones took less than no time."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return _violations(lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (days * 24 - 720).alias("resolution_hours")), "itsm")


# -- gold gates ----------------------------------------------------------------------------
_SUMS = {"transaction_count": "COUNT(*)", "order_count": "COUNT(DISTINCT order_id)",
         "total_units": "SUM(units)", "gross_sales": "SUM(gross_sales)",
         "net_sales": "SUM(net_sales)", "gross_margin": "SUM(gross_margin)"}


def _gate_sql(*ctes: str, documents: str = "agreements", mart: str = "contract_mart",
              detail: str | None = None) -> str:
    return base.gold_gate_sql(",".join(ctes), "sales", documents, mart, "transaction_id",
                              "contract_id", "agreement_id", _SUMS, detail)


def _gold(spark: SparkSession, sf_dir: str, documents: DataFrame, name: str):
    spec = domain_spec("finance")
    return spec, *written_gold(
        spark, spec, standins.sales_transactions(spark, sf_dir), documents, name)


_TWICE = """
twice AS (SELECT * FROM agreements UNION ALL
          SELECT * FROM agreements WHERE governing_law = 'Nation 3')"""


@register("gate_gold_repeated_document", _gate_sql(
    base.SALES, base.AGREEMENTS, _TWICE,
    base.CONTRACT_MART.replace("LEFT JOIN agreements a", "LEFT JOIN twice a"), documents="twice"))
def gate_gold_repeated_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agreements of one nation were extracted twice."""
    agreements = standins.agreements(spark, sf_dir)
    return gold_gate(*_gold(spark, sf_dir, agreements.unionByName(
        agreements.where("governing_law = 'Nation 3'")), "gold-repeated"))


@register("gate_gold_wrong_mart", _gate_sql(
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART, """
wrong_mart AS (SELECT * REPLACE (CASE WHEN contract_currency IS NULL THEN net_sales + 1
                                 ELSE net_sales END AS net_sales) FROM contract_mart)""",
    mart="wrong_mart"))
def gate_gold_wrong_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart has one unit too much for contracts without a document."""
    spec, bronze, docs, detail, mart = _gold(
        spark, sf_dir, standins.agreements(spark, sf_dir), "gold-wrong-mart")
    return gold_gate(spec, bronze, docs, detail, mart.withColumn("net_sales", F.when(
        F.col("contract_currency").isNull(), F.col("net_sales") + 1).otherwise(F.col("net_sales"))))


@register("gate_gold_wrong_detail", _gate_sql(
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART, detail="""
  CASE WHEN s.sales_channel = '5-LOW' THEN -s.transaction_id ELSE s.transaction_id END AS k,
  s.contract_id AS g,
  CASE WHEN s.sales_channel = '1-URGENT' THEN d.agreement_id + 1 ELSE d.agreement_id END AS doc"""))
def gate_gold_wrong_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities of one channel were swapped, documents of another belong to the next customer."""
    spec, bronze, docs, detail, mart = _gold(
        spark, sf_dir, standins.agreements(spark, sf_dir), "gold-wrong-detail")
    channel = F.col("sales_channel")
    return gold_gate(spec, bronze, docs, detail.withColumns({
        "transaction_id": F.when(channel == "5-LOW", -F.col("transaction_id"))
        .otherwise(F.col("transaction_id")),
        "contract_agreement_id": F.when(channel == "1-URGENT", F.col("contract_agreement_id") + 1)
        .otherwise(F.col("contract_agreement_id"))}), mart)


# -- serving copies ------------------------------------------------------------------------
_CONTRACTS = (base.SALES, base.AGREEMENTS, base.CONTRACT_MART)


def _serving_sql(kept: str) -> str:
    return base.gate_sql(
        [("primary_key", "bad = 0", "bad", "0"), ("served", "t > 0", "t", "1"),
         ("parity", "t = n", "t", "n"), ("identity", "gone = 0", "gone", "0")],
        ",".join(_CONTRACTS) + f""",
served AS (SELECT * FROM contract_mart WHERE {kept}),
m AS (SELECT (SELECT COUNT(*) FROM contract_mart) AS n, (SELECT COUNT(*) FROM served) AS t,
  (SELECT COUNT(*) - COUNT(DISTINCT contract_id) FROM served) AS bad,
  (SELECT COUNT(*) FROM (SELECT contract_id FROM contract_mart EXCEPT
                         SELECT contract_id FROM served) AS x) AS gone)""")


def _serving_gate(spark: SparkSession, sf_dir: str, kept: str) -> DataFrame:
    mart, served = publish(spark, sf_dir)
    old = sinks.materialize(served.where(kept), shared_dir(spark, "served-old"))
    return serving_gate(serving.serving_parity(mart, old, "contract_id"))


@register("gate_serving_stale", _serving_sql("first_sale_date < '1995-01-01'"))
def gate_serving_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving copy lacks the contracts that came after it."""
    return _serving_gate(spark, sf_dir, "first_sale_date < date '1995-01-01'")


@register("gate_serving_empty", _serving_sql("contract_id IS NULL"))
def gate_serving_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _serving_gate(spark, sf_dir, "contract_id IS NULL")
