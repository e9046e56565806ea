"""The benchmark tables read as the domains' transactions and documents.

The tables hold money as doubles that are whole cents. The sales amounts are
decimals of the currency unit with four places, in which discounts are exact too,
so sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import exact_sum, severity_band
from tidemark.sources.files import (
    CHANGE_LSN, CHANGE_ORDER, CHANGE_TIME, CHANGE_TYPE, CHANGE_XID,
)
from tidemark.sources.tables import table

COST_PERCENT = 60  # cost of goods as a share of gross sales; the tables have no cost
MONEY = ("gross_sales", "discount_amount", "net_sales", "cost_of_goods", "gross_margin")
MONEY_TYPE = "decimal(15,4)"
SLA_HOURS = 720


# -- finance -------------------------------------------------------------------
def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales at order-line grain; dimensions are joins away (see ``plans.metrics``)."""
    cents = F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5))
    percent = F.floor(F.col("l_discount") * 100 + F.lit(0.5))
    gross, discount, cost = cents * 100, cents * percent, cents * COST_PERCENT
    amounts = (gross, discount, gross - discount, cost, gross - discount - cost)
    one = F.lit("0.0001").cast("decimal(4,4)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.col("l_quantity").cast("bigint").alias("units"),
        F.col("l_discount").cast("decimal(6,4)").alias("discount_pct"),
        *[(amount.cast("decimal(15,0)") * one).cast(MONEY_TYPE).alias(name)
          for name, amount in zip(MONEY, amounts)])


def sales_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; the business key is the customer's agreement.

    Lines are summed by order before the join. The aggregate is already
    partitioned by the join key, so lines are shuffled once.
    """
    raw = sales_lines(spark, sf_dir)
    lines = raw.groupBy("l_orderkey").agg(
        F.sum("units").alias("units"), F.max("discount_pct").alias("discount_pct"),
        *[exact_sum(raw, a).cast(MONEY_TYPE).alias(a) for a in MONEY])
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), day.cast("string")).alias("order_id"),
        day.alias("sale_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("sales_channel"),
        F.col("o_custkey").alias("contract_id"),
        *[F.coalesce(F.col(c), F.lit(0).cast(lines.schema[c].dataType)).alias(c)
          for c in ("units", "discount_pct", *MONEY)])


def agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted pricing agreements: all customers but one segment's (partial coverage)."""
    start = F.date_add(F.lit("1992-01-01").cast("date"), F.col("c_nationkey") * 30)
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("agreement_id"),
        F.concat(F.lit("/agreements/"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name"),
                 F.lit(".pdf")).alias("path"),
        F.concat("c_name", F.lit(".pdf")).alias("filename"),
        F.col("c_name").alias("customer_name"),
        start.cast("string").alias("effective_date"),
        F.date_add(start, 3650).cast("string").alias("expiration_date"),
        F.lit("USD").alias("currency"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("minimum_procedure_commitment"),
        F.when(F.col("c_acctbal") >= 5000, "tier 1").otherwise("tier 2").alias("rebate_terms"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("governing_law"),
        F.concat(F.lit("all "), F.col("c_mktsegment")).alias("covered_products"))


# -- security ------------------------------------------------------------------
def scan_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event; the business key (CVE) is the user."""
    value = F.col("value").cast("decimal(8,2)")
    tenths = F.least(F.floor("value").cast("bigint"), F.lit(100))
    score = (tenths.cast("decimal(5,1)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(3,1)")
    events = table(spark, sf_dir, "events").select("*", score.alias("cvss_score"))
    severity = severity_band("cvss_score")
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").alias("finding_id"),
        F.date_format("ts", "yyyyMMdd").alias("scan_id"),
        F.to_date("ts").alias("scan_date"),
        F.get_json_object("props", "$.k").alias("asset_id"),
        F.col("event_type").alias("asset_type"),
        F.when(F.hour("ts").between(8, 17), "Production").otherwise("Staging").alias("environment"),
        F.col("user_id").alias("cve_id"),
        F.concat(F.lit("Exposure "), user).alias("vulnerability_title"),
        F.concat(F.lit("Category "), (F.col("user_id") % 5).cast("string"))
        .alias("vulnerability_category"),
        severity.alias("severity"), "cvss_score",
        F.when(F.col("event_type").isin("error", "view"), "Open").otherwise("Remediated")
        .alias("status"),
        F.datediff(F.lit("2024-02-01").cast("date"), F.to_date("ts")).alias("age_days"),
        (F.when(severity == "Critical", 7).when(severity == "High", 30)
         .when(severity == "Medium", 90).otherwise(180)).alias("remediation_sla_days"),
        value.alias("remediation_hours"),
        (value * 1000).cast("decimal(14,2)").alias("asset_value_at_risk"),
        (value * F.col("cvss_score")).alias("weighted_risk"),
        (F.col("event_type") == "error").alias("exploit_available"))


def advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted advisories: the customers of three segments (partial coverage)."""
    return (table(spark, sf_dir, "customer")
            .where(F.col("c_mktsegment").isin("AUTOMOBILE", "FURNITURE", "MACHINERY")).select(
        F.col("c_custkey").alias("cve_id"),
        F.concat(F.lit("/advisories/"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name"),
                 F.lit(".pdf")).alias("path"),
        F.concat("c_name", F.lit(".pdf")).alias("filename"),
        F.concat(F.lit("Advisory on "), F.col("c_name")).alias("title"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey") * 7).cast("string")
        .alias("published_date"),
        F.when(F.col("c_acctbal") >= 5000, "High").otherwise("Low").alias("severity"),
        F.lit("5.0").cast("decimal(3,1)").alias("cvss_score"),
        F.concat(F.lit("Patch "), F.col("c_mktsegment")).alias("recommended_remediation")))


# -- itsm ----------------------------------------------------------------------
def service_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; resolved when its last line ships.

    The times are text, as in the seed. A ticket whose last line ships before
    the order date, or that has no lines, is unresolved.
    """
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"))
    orders = table(spark, sf_dir, "orders")
    opened, resolved = F.to_date("o_orderdate"), F.to_date("last_ship")
    done = resolved >= opened
    hours = F.when(done, F.datediff(resolved, opened) * 24).cast("decimal(8,2)")
    return orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderkey").alias("incident_id"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("priority"),
        F.when(done, "Resolved").otherwise("Open").alias("status"),
        F.concat(F.lit("Group "), (F.col("o_custkey") % 7).cast("string")).alias("assignment_group"),
        F.concat(F.lit("Service "), F.col("o_orderstatus")).alias("service"),
        F.concat(F.lit("ci-"), F.col("o_custkey").cast("string")).alias("configuration_item"),
        opened.cast("string").alias("opened_at"),
        F.when(done, resolved.cast("string")).alias("resolved_at"),
        hours.alias("resolution_hours"),
        F.coalesce(hours > SLA_HOURS, F.lit(False)).alias("sla_breached"))


def incident_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted incident reports: one per finished order (partial coverage)."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("incident_id"),
        F.concat(F.lit("/incident_report/"), key, F.lit(".pdf")).alias("path"),
        F.concat(key, F.lit(".pdf")).alias("filename"),
        F.concat(F.lit("Value "), F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
        .alias("impact"))


# -- change log and documents --------------------------------------------------
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a change log keyed by user; the event id is the log position."""
    return as_change_log(table(spark, sf_dir, "events"))


def as_change_log(events: DataFrame) -> DataFrame:
    change: Column = (F.when(F.col("event_type") == "signup", "insert")
                      .when(F.col("event_type") == "error", "delete").otherwise("update"))
    return events.select(
        "user_id", "event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"),
        "props", change.alias(CHANGE_TYPE), F.col("event_id").alias(CHANGE_LSN),
        F.lit(None).cast("int").alias(CHANGE_XID), F.col("ts").alias(CHANGE_TIME),
        F.col("event_id").alias(CHANGE_ORDER))


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a path whose folder is the shipped class (the language)."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("/documents/"), F.col("lang"), F.lit("/"), name).alias("path"),
        name.alias("filename"), F.col("lang").alias("source_class"),
        F.col("text").alias("parsed_text"), "n_chars")
