"""Serving queries: publishing a mart and what the data app shows of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import portable
from tidemark.operators import cdc, gold, serving
from tidemark.operators.incremental import IncrementalMart
from tidemark.plans import standins
from tidemark.plans.domains import FINANCE_RETRACTABLE
from tidemark.plans.gates import serving_gate
from tidemark.session import shared_dir
from tidemark.sources import files, sinks
from tidemark.streaming.apply import ChangeTarget, apply_changes, each_batch, file_stream
from tidemark.workload import base
from tidemark.workload.finance import contract_mart, report
from tidemark.workload.registry import register
from tidemark.workload.security import cve_mart

_CONTRACTS = (base.SALES, base.AGREEMENTS, base.CONTRACT_MART)
_CVES = (base.FINDINGS, base.ADVISORIES, base.CVE_MART)
_SERVED = ["contract_id", "contract_customer_name", "transaction_count", "net_sales"]
_SERVED_SQL = """SELECT contract_id, contract_customer_name, transaction_count,
  CAST(net_sales AS DOUBLE) AS net_sales FROM contract_mart"""


def publish(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The persisted mart and its serving copy."""
    return _published(spark, sf_dir)[:2]


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    root = shared_dir(spark, "serving")
    mart = sinks.materialize(contract_mart(spark, sf_dir), f"{root}/mart")
    return mart, sinks.publish_snapshot(mart, ["contract_id"], f"{root}/served",
                                        f"{root}/mart"), root


def _served_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served CVE mart; its key is text, as an identifier is not a metric."""
    served = cve_mart(spark, sf_dir).withColumn("cve_id", F.col("cve_id").cast("string"))
    return sinks.materialize(served, shared_dir(spark, "served-cves"))


@register("serving_snapshot", base.with_ctes(_SERVED_SQL, *_CONTRACTS))
def serving_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(publish(spark, sf_dir)[1].select(*_SERVED))


@register("serving_rows", base.with_ctes(
    _SERVED_SQL + " ORDER BY contract_id LIMIT 100", *_CONTRACTS))
def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(files.serving_rows(
        publish(spark, sf_dir)[1].select(*_SERVED), "contract_id", 100))


@register("serving_refused", base.with_ctes(
    """SELECT CAST(1 AS BIGINT) AS step, 'published' AS action, COUNT(*) AS served_rows FROM contract_mart
UNION ALL SELECT 2, 'refused', COUNT(*) FROM contract_mart
UNION ALL SELECT 3, 'refused', COUNT(*) FROM contract_mart
UNION ALL SELECT 4, 'published', COUNT(*) FROM contract_mart WHERE contract_customer_name IS NOT NULL""",
    *_CONTRACTS))
def serving_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy with repeated or blank keys is refused and the one before stays readable."""
    path = f"{shared_dir(spark, 'refused')}/served"
    mart = sinks.materialize(contract_mart(spark, sf_dir).select(*_SERVED),
                             shared_dir(spark, "refused-mart"))
    known = mart.where("contract_customer_name IS NOT NULL")
    blank = mart.withColumn("contract_id", F.when(
        F.col("contract_customer_name").isNotNull(), F.col("contract_id")))
    steps = []
    for number, copy in enumerate((mart, mart.unionByName(known), blank, known), 1):
        try:
            sinks.publish_snapshot(copy, ["contract_id"], path)
            action = "published"
        except sinks.PrimaryKeyError:
            action = "refused"
        steps.append((number, action, sinks.served_copy(spark, path).count()))
    return spark.createDataFrame(steps, "step bigint, action string, served_rows bigint")


_PARITY_SQL = """SELECT COUNT(*) AS source_rows, COUNT(*) AS served_rows,
  COUNT(*) - COUNT(DISTINCT contract_id) AS bad_keys, CAST(0 AS BIGINT) AS key_differences, COUNT(*) > 0 AS passed
FROM contract_mart"""


@register("serving_parity", base.with_ctes(_PARITY_SQL, *_CONTRACTS))
def serving_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, served = publish(spark, sf_dir)
    return serving.serving_parity(mart, served, "contract_id")


@register("gate_serving", base.gate_sql(
    [("source", "n > 0", "1", "1"),
     ("primary_key", "n = k", "n - k", "0"), ("served", "n > 0", "n", "1"),
     ("parity", "n > 0", "n", "n"), ("identity", "n > 0", "0", "0")],
    ",".join(_CONTRACTS)
    + ", m AS (SELECT COUNT(*) AS n, COUNT(DISTINCT contract_id) AS k FROM contract_mart)"))
def gate_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, served, root = _published(spark, sf_dir)
    return serving_gate(serving.serving_parity(mart, served, "contract_id"),
                        sinks.published_source(spark, f"{root}/served") == f"{root}/mart")


@register("serving_incremental", base.with_ctes(_SERVED_SQL, *_CONTRACTS))
def serving_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving copy follows a change feed: corrections arrive before first versions."""
    root = shared_dir(spark, "serving-feed")
    mart = sinks.materialize(contract_mart(spark, sf_dir).select(*_SERVED), f"{root}/mart")
    stale = mart.withColumn("net_sales", F.lit(0).cast(mart.schema["net_sales"].dataType))
    versions = (cdc.synthesize_log(mart, F.lit(2)), cdc.synthesize_log(stale, F.lit(1)))
    target = ChangeTarget(f"{root}/target", ("contract_id",), versions[0].schema)
    for version in versions:  # what has landed is applied before more lands
        version.write.mode("append").parquet(f"{root}/feed")
        stream = file_stream(spark, f"{root}/feed", version.schema)
        apply_changes(stream, target, f"{root}/checkpoint").awaitTermination()
    return report(target.current(spark, _SERVED))


_MEASURED_SQL = """SELECT contract_id, first_sale_date, last_sale_date, transaction_count, order_count,
  total_units, CAST(gross_sales AS DOUBLE) AS gross_sales,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_sales AS DOUBLE) AS net_sales,
  CAST(cost_of_goods AS DOUBLE) AS cost_of_goods, CAST(gross_margin AS DOUBLE) AS gross_margin,
  average_discount_pct, contract_customer_name FROM contract_mart"""


def sales_batches(sales: DataFrame) -> list[DataFrame]:
    """A change log of the sales in three batches, after which all but one channel are left.

    First all sales but those of a channel, the high-priority ones at the neighbouring
    contract and for half their units. Then corrections of these, the channel that was
    missing, and the deletion of another channel. Last, old versions that arrive late, and
    one channel's rows once more as they are.
    """
    high, low = F.col("sales_channel") == "2-HIGH", F.col("sales_channel") == "5-LOW"
    wrong = sales.withColumns({
        "contract_id": F.when(high, F.col("contract_id") + 1).otherwise(F.col("contract_id")),
        "order_id": F.when(high, F.concat("order_id", F.lit("?"))).otherwise(F.col("order_id")),
        "sale_date": F.when(high, F.date_sub("sale_date", 4000)).otherwise(F.col("sale_date")),
        "units": F.when(high, F.expr("units div 2")).otherwise(F.col("units"))})
    gone = cdc.synthesize_log(sales.where("sales_channel = '3-MEDIUM'"), F.lit(3)).withColumn(
        files.CHANGE_TYPE, F.lit("delete"))
    return [
        cdc.synthesize_log(wrong.where(~low), F.lit(1)),
        cdc.synthesize_log(sales.where(high | low), F.lit(3)).unionByName(gone),
        cdc.synthesize_log(wrong.where(high), F.lit(2)).unionByName(
            cdc.synthesize_log(sales.where("sales_channel = '1-URGENT'"), F.lit(4)))]


def incremental_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract mart as it stands after three batches of changes."""
    root = shared_dir(spark, "incremental")
    sales = sinks.materialize(standins.sales_transactions(spark, sf_dir), f"{root}/sales")
    batches = sales_batches(sales)
    mart = IncrementalMart(f"{root}/mart", batches[0].schema, "transaction_id", "contract_id",
                           FINANCE_RETRACTABLE, compact_every=2)
    for number, batch in enumerate(batches, 1):  # what has landed is applied before more lands
        batch.write.mode("append").parquet(f"{root}/feed")
        if number == len(batches):  # all has landed
            sinks.remove_folder(f"{root}/sales")
        stream = file_stream(spark, f"{root}/feed", batch.schema)
        each_batch(stream, mart.apply, f"{root}/checkpoint").awaitTermination()
    return mart.current(spark)


@register("mart_incremental", base.with_ctes(
    _MEASURED_SQL, base.SALES.replace("ON o_orderkey = l_orderkey)", "ON o_orderkey = l_orderkey\n"
                                      "  WHERE o_orderpriority <> '3-MEDIUM')"),
    base.AGREEMENTS, base.CONTRACT_MART))
def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After inserts, moved keys, deletes and late events: the mart of the facts that are left."""
    mart = incremental_sales(spark, sf_dir)
    return report(gold.enrich(mart, standins.agreements(spark, sf_dir), "contract_id", "agreement_id",
                              {"contract_customer_name": "customer_name"}))


@register("serving_kpis", base.with_ctes(
    """SELECT COUNT(*) AS row_count, CAST(22 AS BIGINT) AS column_count, 'cvss_score' AS metric,
  CAST(SUM(cvss_score) AS DOUBLE) / COUNT(cvss_score) AS metric_mean FROM cve_mart""", *_CVES))
def serving_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.kpis(_served_cves(spark, sf_dir))


# The served mart's columns that are no numbers, in order.
_CATEGORIES = (
    "cve_id", "advisory_document_path", "advisory_document_filename", "advisory_title",
    "advisory_published_date", "advisory_recommended_remediation", "vulnerability_title",
    "vulnerability_category", "severity", "exploit_available", "first_scan_date", "last_scan_date")


@register("serving_top_categories", base.with_ctes(
    """SELECT category, CAST(SUM(weighted_risk) AS DOUBLE) AS total FROM candidates
WHERE category IS NOT NULL AND ord = (
  SELECT MIN(ord) FROM (SELECT ord FROM candidates GROUP BY ord
                        HAVING COUNT(DISTINCT category) BETWEEN 2 AND 25) AS small)
GROUP BY category ORDER BY SUM(weighted_risk) DESC, category LIMIT 10""", *_CVES,
    "candidates AS (" + " UNION ALL ".join(
        f"SELECT {i} AS ord, CAST({c} AS VARCHAR) AS category, weighted_risk FROM cve_mart"
        for i, c in enumerate(_CATEGORIES)) + ")"))
def serving_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category column is the first text or flag column with 2 to 25 values."""
    served = _served_cves(spark, sf_dir)
    category = serving.category_column(served)
    top = serving.top_categories(served, category, "weighted_risk")
    return portable(top.select(F.col(category).cast("string").alias("category"), "total"))


@register("serving_top_rows", base.with_ctes(
    """SELECT CAST(cve_id AS VARCHAR) AS cve_id, severity, CAST(weighted_risk AS DOUBLE) AS weighted_risk
FROM cve_mart WHERE weighted_risk IS NOT NULL
ORDER BY cve_mart.weighted_risk DESC, CAST(cve_id AS VARCHAR) LIMIT 10""", *_CVES))
def serving_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(serving.top_rows(
        _served_cves(spark, sf_dir), "weighted_risk", "cve_id")
        .select("cve_id", "severity", "weighted_risk"))
