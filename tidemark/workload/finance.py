"""Finance queries: sales detail, contract mart, reconciliation and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import portable
from tidemark.operators import gold, integrity, reconcile
from tidemark.plans import metrics, standins
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import bronze_transactions_gate, gold_gate
from tidemark.session import shared_dir
from tidemark.sources.files import select_contract
from tidemark.sources.tables import table
from tidemark.sources.sinks import bucketed_table, materialize
from tidemark.workload import base
from tidemark.workload.registry import register


def snake(df: DataFrame) -> DataFrame:
    """Report names: ``Net Sales`` -> ``net_sales``."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def report(df: DataFrame) -> DataFrame:
    return portable(snake(df))


def written_gold(spark: SparkSession, spec, facts: DataFrame, documents: DataFrame,
                 name: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Bronze, documents, detail and mart as written tables, each computed once."""
    root = shared_dir(spark, name)
    bronze = materialize(facts, f"{root}/bronze")
    docs = materialize(documents, f"{root}/documents")
    detail = materialize(spec.detail(bronze, docs), f"{root}/detail")
    mart = materialize(spec.mart_of(detail), f"{root}/mart")
    return bronze, docs, detail, mart


def sales_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"sales_lines": standins.sales_lines(spark, sf_dir),
            **{t: table(spark, sf_dir, t)
               for t in ("part", "orders", "customer", "nation", "region")}}


def contract_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"contract_performance": contract_mart(spark, sf_dir)}


def contract_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_spec("finance").mart_direct(
        standins.sales_transactions(spark, sf_dir), standins.agreements(spark, sf_dir))


# -- gold ------------------------------------------------------------------------
_MART_SQL = """SELECT contract_id, contract_document_path, contract_document_filename,
  contract_customer_name, contract_effective_date, contract_expiration_date, contract_currency,
  contract_minimum_procedure_commitment, contract_rebate_terms, contract_governing_law,
  first_sale_date, last_sale_date, transaction_count, order_count, total_units,
  CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(net_sales AS DOUBLE) AS net_sales, CAST(cost_of_goods AS DOUBLE) AS cost_of_goods,
  CAST(gross_margin AS DOUBLE) AS gross_margin, average_discount_pct
FROM contract_mart"""


@register("mart_contract_performance",
          base.with_ctes(_MART_SQL, base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def mart_contract_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(contract_mart(spark, sf_dir))


_DETAIL_SQL = """SELECT s.transaction_id, s.order_id, CAST(s.sale_date AS VARCHAR) AS sale_date,
  s.customer_id, s.sales_channel, s.contract_id, CAST(s.units AS BIGINT) AS units,
  CAST(s.discount_pct AS DOUBLE) AS discount_pct, CAST(s.gross_sales AS DOUBLE) AS gross_sales,
  CAST(s.discount_amount AS DOUBLE) AS discount_amount, CAST(s.net_sales AS DOUBLE) AS net_sales,
  CAST(s.cost_of_goods AS DOUBLE) AS cost_of_goods, CAST(s.gross_margin AS DOUBLE) AS gross_margin,
  a.agreement_id AS contract_agreement_id, a.path AS contract_document_path,
  a.filename AS contract_document_filename, a.customer_name AS contract_customer_name,
  CAST(a.effective_date AS VARCHAR) AS contract_effective_date,
  CAST(a.expiration_date AS VARCHAR) AS contract_expiration_date,
  a.currency AS contract_currency,
  a.minimum_procedure_commitment AS contract_minimum_procedure_commitment,
  a.rebate_terms AS contract_rebate_terms, a.governing_law AS contract_governing_law,
  a.covered_products AS contract_covered_products
FROM sales s LEFT JOIN agreements a ON s.contract_id = a.agreement_id"""


@register("gold_detail_sales", base.with_ctes(_DETAIL_SQL, base.SALES, base.AGREEMENTS))
def gold_detail_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(domain_spec("finance").detail(
        standins.sales_transactions(spark, sf_dir), standins.agreements(spark, sf_dir)))


BUCKETS = 32  # of the bronze tables; a cluster's would follow from their size


def bucketed_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The transactions and the agreements as bronze tables in buckets of the contract."""
    root = shared_dir(spark, "bucketed")
    name = "bronze_" + root.rsplit("-", 1)[-1]
    return (bucketed_table(standins.sales_transactions(spark, sf_dir), f"{name}_sales",
                           "contract_id", f"{root}/sales", BUCKETS),
            bucketed_table(standins.agreements(spark, sf_dir), f"{name}_agreements",
                           "agreement_id", f"{root}/agreements", BUCKETS))


@register("gold_detail_bucketed", base.with_ctes(_DETAIL_SQL, base.SALES, base.AGREEMENTS))
def gold_detail_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales detail from bucketed bronze tables: no row is exchanged."""
    return report(domain_spec("finance").detail(*bucketed_sales(spark, sf_dir)))


@register("mart_bucketed", base.with_ctes(
    _MART_SQL, base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def mart_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract mart from bucketed bronze tables: no fact is exchanged."""
    return report(domain_spec("finance").mart_direct(*bucketed_sales(spark, sf_dir)))


@register("preview_contracts", base.with_ctes(
    """SELECT contract_id, contract_customer_name, transaction_count,
  CAST(net_sales AS DOUBLE) AS net_sales, CAST(gross_margin AS DOUBLE) AS gross_margin,
  average_discount_pct FROM contract_mart ORDER BY net_sales DESC, contract_id""",
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def preview_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(gold.preview(
        contract_mart(spark, sf_dir),
        ["contract_id", "contract_customer_name", "transaction_count", "net_sales",
         "gross_margin", "average_discount_pct"], "net_sales", "contract_id"))


@register("schema_contract", base.with_ctes(
    """SELECT transaction_id, order_id, CAST(sale_date AS VARCHAR) AS sale_date, contract_id,
  CAST(net_sales AS DOUBLE) AS net_sales FROM sales""", base.SALES))
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(select_contract(
        standins.sales_transactions(spark, sf_dir),
        ["transaction_id", "order_id", "sale_date", "contract_id", "net_sales"]))


# -- integrity and reconciliation ------------------------------------------------
@register("key_integrity_source", base.with_ctes(
    """SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE transaction_id IS NULL) AS blank_keys,
  COUNT(DISTINCT transaction_id) AS distinct_keys,
  COUNT(*) FILTER (WHERE contract_id IS NULL) AS blank_group_keys FROM sales""", base.SALES))
def key_integrity_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.key_integrity(
        standins.sales_transactions(spark, sf_dir), "transaction_id", "contract_id")


@register("key_integrity_document", base.with_ctes(
    """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE agreement_id IS NULL) AS blank_keys,
  COUNT(DISTINCT agreement_id) AS distinct_keys FROM agreements""", base.AGREEMENTS))
def key_integrity_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.key_integrity(standins.agreements(spark, sf_dir), "agreement_id")


@register("key_integrity_detail", base.with_ctes(
    f"""SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE transaction_id IS NULL) AS blank_keys,
  COUNT(DISTINCT transaction_id) AS distinct_keys FROM ({_DETAIL_SQL}) AS detail""",
    base.SALES, base.AGREEMENTS))
def key_integrity_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.key_integrity(domain_spec("finance").detail(
        standins.sales_transactions(spark, sf_dir), standins.agreements(spark, sf_dir)),
        "transaction_id")


@register("key_integrity_mart", base.with_ctes(
    """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE contract_id IS NULL) AS blank_keys,
  COUNT(DISTINCT contract_id) AS distinct_keys FROM contract_mart""",
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def key_integrity_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.key_integrity(contract_mart(spark, sf_dir), "contract_id")


@register("key_integrity_lines",
          """SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE line_key IS NULL OR trim(line_key) = '') AS blank_keys,
  COUNT(DISTINCT line_key) AS distinct_keys
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key
      FROM lineitem) AS keyed""")
def key_integrity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose natural key does repeat."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("line_key"))
    return integrity.key_integrity(lines, "line_key")


@register("expected_enriched", base.with_ctes(
    """SELECT CAST(s.transaction_id AS VARCHAR) AS entity_key
FROM sales s JOIN agreements a ON s.contract_id = a.agreement_id""", base.SALES, base.AGREEMENTS))
def expected_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.expected_enriched(
        standins.sales_transactions(spark, sf_dir), standins.agreements(spark, sf_dir),
        "transaction_id", "contract_id", "agreement_id")


@register("reconcile_detail_join", base.with_ctes(
    f"""SELECT COUNT(*) AS compared_rows, COUNT(*) FILTER (
  WHERE s.transaction_id IS NULL OR d.transaction_id IS NULL
     OR (d.contract_agreement_id IS NOT NULL
         AND s.contract_id IS DISTINCT FROM d.contract_agreement_id)) AS mismatched_rows
FROM sales s FULL JOIN ({_DETAIL_SQL}) AS d ON s.transaction_id = d.transaction_id""",
    base.SALES, base.AGREEMENTS))
def reconcile_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = standins.sales_transactions(spark, sf_dir)
    detail = domain_spec("finance").detail(facts, standins.agreements(spark, sf_dir))
    return reconcile.association_mismatches(
        facts, detail, "transaction_id", "contract_id", "transaction_id", "contract_agreement_id")


@register("reconcile_wrong_orders",
          """SELECT COUNT(*) AS compared_rows, COUNT(*) FILTER (
  WHERE o_orderkey IS NULL OR l_orderkey IS NULL
     OR (l_suppkey IS NOT NULL AND o_custkey IS DISTINCT FROM l_suppkey)) AS mismatched_rows
FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey""")
def reconcile_wrong_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reconciliation on tables that do not agree, with repeated keys."""
    return reconcile.association_mismatches(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
        "o_orderkey", "o_custkey", "l_orderkey", "l_suppkey")


@register("reconcile_mart_sales", base.with_ctes(
    """SELECT COUNT(*) AS compared_groups,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_count OR NOT ok_orders OR NOT ok_units
                   OR NOT ok_gross OR NOT ok_net OR NOT ok_margin) AS mismatched_groups,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_count) AS mismatched_transaction_count,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_orders) AS mismatched_order_count,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_units) AS mismatched_total_units,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_gross) AS mismatched_gross_sales,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_net) AS mismatched_net_sales,
  COUNT(*) FILTER (WHERE NOT ok_key OR NOT ok_margin) AS mismatched_gross_margin
FROM (SELECT e.contract_id IS NOT NULL AND m.contract_id IS NOT NULL AS ok_key,
        e.n IS NOT DISTINCT FROM m.transaction_count AS ok_count,
        e.o IS NOT DISTINCT FROM m.order_count AS ok_orders,
        e.u IS NOT DISTINCT FROM m.total_units AS ok_units,
        e.gs IS NOT DISTINCT FROM m.gross_sales AS ok_gross,
        e.ns IS NOT DISTINCT FROM m.net_sales AS ok_net,
        e.gm IS NOT DISTINCT FROM m.gross_margin AS ok_margin
      FROM (SELECT contract_id, COUNT(*) AS n, COUNT(DISTINCT order_id) AS o,
              CAST(SUM(units) AS BIGINT) AS u, SUM(gross_sales) AS gs, SUM(net_sales) AS ns,
              SUM(gross_margin) AS gm FROM sales GROUP BY contract_id) e
      FULL JOIN contract_mart m ON e.contract_id = m.contract_id) AS compared""",
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def reconcile_mart_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts are written once, for the mart and for what it is compared with."""
    spec, root = domain_spec("finance"), shared_dir(spark, "reconcile-sales")
    facts = materialize(standins.sales_transactions(spark, sf_dir), f"{root}/facts")
    mart = spec.mart_direct(facts, standins.agreements(spark, sf_dir))
    return reconcile.measure_mismatches(facts, mart, spec.group_key, spec.group_key, spec.checks)


_DIFF = """SELECT CASE WHEN o.k IS NULL THEN 'missing' ELSE 'unexpected' END AS side,
  CAST(COALESCE(e.k, o.k) AS VARCHAR) AS entity_key
FROM (SELECT DISTINCT o_custkey AS k FROM orders) e
FULL JOIN (SELECT DISTINCT agreement_id AS k FROM agreements) o ON e.k = o.k
WHERE e.k IS NULL OR o.k IS NULL"""


def _agreement_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.identity_diff(table(spark, sf_dir, "orders"),
                                   standins.agreements(spark, sf_dir), "o_custkey", "agreement_id")


@register("identity_diff", base.with_ctes(_DIFF, base.AGREEMENTS))
def identity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agreement_diff(spark, sf_dir)


@register("identity_diff_examples", base.with_ctes(
    f"""SELECT side, entity_key FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY side ORDER BY entity_key) AS rn FROM ({_DIFF}) AS diff) AS ranked
WHERE rn <= 20""", base.AGREEMENTS))
def identity_diff_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.diff_examples(_agreement_diff(spark, sf_dir), 20)


_RULES_SQL = {
    "units_positive": "units > 0",
    "gross_not_negative": "gross_sales >= 0",
    "discount_not_negative": "discount_amount >= 0",
    "discount_pct_in_range": "discount_pct BETWEEN 0 AND 1",
    "net_is_gross_less_discount": "net_sales = gross_sales - discount_amount",
    "margin_is_net_less_cost": "gross_margin = net_sales - cost_of_goods",
}


@register("constraint_violations", base.with_ctes(
    "\nUNION ALL ".join(
        f"SELECT COUNT(*) AS checked_rows, '{name}' AS constraint_name, "
        f"COUNT(*) FILTER (WHERE NOT ({rule})) AS violations FROM sales"
        for name, rule in _RULES_SQL.items()), base.SALES))
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.constraint_violations(
        standins.sales_transactions(spark, sf_dir),
        {name: F.expr(rule) for name, rule in _RULES_SQL.items()})


@register("expect_row_count", base.with_ctes(
    """SELECT 'sales' AS table_name, a.n AS observed, b.n AS expected, a.n = b.n AS passed
FROM (SELECT COUNT(*) AS n FROM sales) a CROSS JOIN (SELECT COUNT(*) AS n FROM orders) b
UNION ALL
SELECT 'agreements', a.n, b.n, a.n = b.n
FROM (SELECT COUNT(*) AS n FROM agreements) a CROSS JOIN (SELECT COUNT(*) AS n FROM customer) b""",
    base.SALES, base.AGREEMENTS))
def expect_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.row_count_expectation(
        standins.sales_transactions(spark, sf_dir), table(spark, sf_dir, "orders"), "sales"
    ).unionByName(integrity.row_count_expectation(
        standins.agreements(spark, sf_dir), table(spark, sf_dir, "customer"), "agreements"))


@register("gate_bronze_txn", base.gate_sql(
    [("readable", "found IS NOT NULL", "1", "1"), ("row_count", "found = wanted", "found", "wanted")],
    base.SALES.lstrip() + """,
m AS (SELECT (SELECT COUNT(*) FROM sales) AS found, (SELECT COUNT(*) FROM orders) AS wanted)"""))
def gate_bronze_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_transactions_gate(standins.sales_transactions(spark, sf_dir),
                                    table(spark, sf_dir, "orders"))


@register("gate_gold_sales", base.gold_gate_sql(
    ",".join([base.SALES, base.AGREEMENTS, base.CONTRACT_MART]), "sales", "agreements",
    "contract_mart", "transaction_id", "contract_id", "agreement_id",
    {"transaction_count": "COUNT(*)", "order_count": "COUNT(DISTINCT order_id)",
     "total_units": "SUM(units)", "gross_sales": "SUM(gross_sales)",
     "net_sales": "SUM(net_sales)", "gross_margin": "SUM(gross_margin)"}))
def gate_gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = domain_spec("finance")
    return gold_gate(spec, *written_gold(
        spark, spec, standins.sales_transactions(spark, sf_dir),
        standins.agreements(spark, sf_dir), "gold-sales"))


# -- metric views ----------------------------------------------------------------
_FACT = base.LINES + """,
fact AS (
  SELECT l.*, CAST(o_orderdate AS DATE) AS sale_date, o_orderpriority AS sales_channel,
         p_brand AS product_family, r_name AS sales_region, c_mktsegment AS customer_type
  FROM lines l LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

def _amount(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE)"


_SUMS = {
    "transaction_count": "COUNT(*)", "order_count": "COUNT(DISTINCT l_orderkey)",
    "units_sold": "CAST(SUM(units) AS BIGINT)", "gross_sales": "CAST(SUM(gross_sales) AS DOUBLE)",
    "net_sales": "CAST(SUM(net_sales) AS DOUBLE)", "gross_margin": "CAST(SUM(gross_margin) AS DOUBLE)",
    "gross_margin_percent": _amount("gross_margin") + " / NULLIF(" + _amount("net_sales") + ", 0)",
    "discount_amount": "CAST(SUM(discount_amount) AS DOUBLE)",
    "discount_rate": _amount("discount_amount") + " / NULLIF(" + _amount("gross_sales") + ", 0)",
}


def _fact_sql(dims: list[str], measures: list[str], tail: str = "") -> str:
    shown = [f"CAST({d} AS VARCHAR) AS {d}" if d == "sale_date" else d for d in dims]
    shown += [f"{_SUMS[m]} AS {m}" for m in measures]
    group = f" GROUP BY {', '.join('fact.' + d for d in dims)}" if dims else ""
    return base.with_ctes(f"SELECT {', '.join(shown)} FROM fact{group}{tail}", _FACT)


def _sales_query(name: str, view, dims: list[str], measures: list[str],
                 order_by: list[tuple[str, str]] = (), limit: int | None = None) -> None:
    snakes = [d.lower().replace(" ", "_") for d in dims]
    tail = ""
    if order_by:
        tail = " ORDER BY " + ", ".join(
            f"{n.lower().replace(' ', '_')} {way.upper()}" for n, way in order_by)
    if limit is not None:
        tail += f" LIMIT {limit}"
    sql = _fact_sql(snakes, [m.lower().replace(" ", "_") for m in measures], tail)

    @register(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(view.query(sales_tables(spark, sf_dir), dims, measures,
                                 order_by=order_by, limit=limit))


_SALES_DIMS = ["Sale Date", "Product Family", "Sales Region", "Customer Type"]
_SALES_MEASURES = ["Transaction Count", "Order Count", "Units Sold", "Gross Sales", "Net Sales",
                   "Gross Margin", "Gross Margin Percent"]
_sales_query("metric_sales_all", metrics.SALES, _SALES_DIMS, _SALES_MEASURES)
_sales_query("metric_joined_source", metrics.SALES, ["Sales Region", "Customer Type"],
             ["Net Sales", "Order Count"])
_sales_query("metric_margin_pct", metrics.SALES, ["Customer Type"], ["Gross Margin Percent"])
_sales_query("q_net_sales_family", metrics.SALES, ["Product Family"], ["Net Sales"],
             [("Net Sales", "desc"), ("Product Family", "asc")])
_sales_query("top_region_margin", metrics.SALES, ["Sales Region"], ["Gross Margin"],
             [("Gross Margin", "desc"), ("Sales Region", "asc")], 1)
_sales_query("q_top_units_family", metrics.SALES, ["Product Family"], ["Units Sold"],
             [("Units Sold", "desc"), ("Product Family", "asc")], 1)
_sales_query("preview_family_margin", metrics.SALES, ["Product Family"],
             ["Net Sales", "Gross Margin", "Gross Margin Percent"],
             [("Net Sales", "desc"), ("Product Family", "asc")])
_sales_query("metric_discount_all", metrics.DISCOUNTS,
             ["Product Family", "Sales Channel", "Customer Type"],
             ["Gross Sales", "Discount Amount", "Net Sales", "Discount Rate"])
_sales_query("metric_discount_channel", metrics.DISCOUNTS, ["Sales Channel"],
             ["Gross Sales", "Discount Amount", "Discount Rate"],
             [("Discount Amount", "desc"), ("Sales Channel", "asc")])
_sales_query("q_deepest_discount", metrics.DISCOUNTS, ["Product Family"], ["Discount Rate"],
             [("Discount Rate", "desc"), ("Product Family", "asc")], 1)

_CONTRACT_MEASURES = ["Transaction Count", "Order Count", "Total Units", "Gross Sales",
                      "Net Sales", "Gross Margin", "Gross Margin Percent"]


@register("metric_contracts_all", base.with_ctes(
    f"""SELECT contract_id, contract_customer_name AS customer, contract_currency AS currency,
  CAST(SUM(transaction_count) AS BIGINT) AS transaction_count,
  CAST(SUM(order_count) AS BIGINT) AS order_count, CAST(SUM(total_units) AS BIGINT) AS total_units,
  CAST(SUM(gross_sales) AS DOUBLE) AS gross_sales, CAST(SUM(net_sales) AS DOUBLE) AS net_sales,
  CAST(SUM(gross_margin) AS DOUBLE) AS gross_margin,
  {_amount('gross_margin')} / NULLIF({_amount('net_sales')}, 0) AS gross_margin_percent
FROM contract_mart GROUP BY contract_id, contract_customer_name, contract_currency""",
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def metric_contracts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(metrics.CONTRACTS.query(
        contract_tables(spark, sf_dir), ["Contract ID", "Customer", "Currency"],
        _CONTRACT_MEASURES))


@register("q_net_sales_customer", base.with_ctes(
    """SELECT contract_customer_name AS customer, CAST(SUM(net_sales) AS DOUBLE) AS net_sales
FROM contract_mart GROUP BY contract_customer_name""",
    base.SALES, base.AGREEMENTS, base.CONTRACT_MART))
def q_net_sales_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(metrics.CONTRACTS.query(
        contract_tables(spark, sf_dir), ["Customer"], ["Net Sales"]))
