"""Quality gates: ordered stages over metrics that the cluster computes.

A gate collects named numbers from its tables (one small row per source), then
judges its stages on that single row. A stage whose numbers are missing, because
a table could not be read, fails: unknown is never a pass. The first failing
stage is the verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import EXACT, col, document_identity, is_blank
from tidemark.operators.semantic import MetricView
from tidemark.plans.domains import DomainSpec

GATE_COLUMNS = ("stage_no", "stage", "passed", "observed", "expected", "verdict")


@dataclass(frozen=True)
class Stage:
    """``passed`` and the two reported numbers, as SQL over the metric names."""

    name: str
    passed: str
    observed: str
    expected: str


def _metrics(df: DataFrame) -> DataFrame:
    """A one-row summary as (metric, value) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), col(c).cast("bigint").alias("value"))
        for c in df.columns])))


def judge(summaries: Sequence[DataFrame], names: Sequence[str], stages: Sequence[Stage]) -> DataFrame:
    """One row per stage from one-row summaries; absent metrics are NULL and fail."""
    rows = reduce(DataFrame.unionByName, [_metrics(s) for s in summaries])
    wide = rows.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    judged = wide.select(F.array(*[
        F.struct(F.lit(s.name).alias("stage"),
                 F.coalesce(F.expr(s.passed), F.lit(False)).alias("passed"),
                 F.expr(s.observed).cast("bigint").alias("observed"),
                 F.expr(s.expected).cast("bigint").alias("expected"))
        for s in stages]).alias("stages"))
    listed = judged.select(
        F.array_position(F.transform("stages", lambda s: s["passed"]), False).alias("failure"),
        F.posexplode("stages").alias("position", "s"))
    stage_no = (F.col("position") + 1).cast("bigint")
    verdict = (F.when((F.col("failure") == 0) | (stage_no < F.col("failure")), "pass")
               .when(stage_no == F.col("failure"), "fail").otherwise("not reached"))
    return listed.select(stage_no.alias("stage_no"), "s.stage", "s.passed", "s.observed",
                         "s.expected", verdict.alias("verdict"))


def _total(condition: Column | None, value: Column | str) -> Column:
    value = col(value) if isinstance(value, str) else value
    picked = value if condition is None else F.when(condition, value)
    return F.coalesce(F.sum(picked), F.lit(0))


# -- gold ------------------------------------------------------------------------
_GOLD_METRICS = (
    "source_rows", "source_blank", "source_distinct", "source_blank_groups",
    "detail_rows", "detail_blank", "detail_distinct", "identity_missing", "identity_unexpected",
    "wrong_documents", "documents_rows", "documents_blank", "documents_distinct",
    "expected_enriched", "observed_enriched", "enrichment_missing", "enrichment_unexpected",
    "groups", "mart_rows", "mart_blank", "mart_distinct", "mart_missing", "mart_unexpected",
    "mart_mismatched",
)

# The stages of the gold gate, in order.
_GOLD_STAGES = (
    Stage("source", "source_rows > 0 AND source_blank = 0 AND source_blank_groups = 0 "
          "AND source_distinct = source_rows", "source_distinct", "source_rows"),
    Stage("documents", "documents_rows > 0 AND documents_blank = 0 "
          "AND documents_distinct = documents_rows", "documents_distinct", "documents_rows"),
    Stage("upstream_join", "expected_enriched > 0", "expected_enriched", "1"),
    Stage("detail", "detail_blank = 0 AND detail_distinct = detail_rows "
          "AND detail_rows = source_rows", "detail_rows", "source_rows"),
    Stage("detail_identity", "identity_missing + identity_unexpected = 0",
          "identity_missing + identity_unexpected", "0"),
    Stage("detail_join", "wrong_documents = 0", "wrong_documents", "0"),
    Stage("enrichment", "enrichment_missing + enrichment_unexpected = 0",
          "enrichment_missing + enrichment_unexpected", "0"),
    Stage("mart", "mart_blank = 0 AND mart_distinct = mart_rows AND mart_rows = groups",
          "mart_rows", "groups"),
    Stage("mart_identity", "mart_missing + mart_unexpected = 0",
          "mart_missing + mart_unexpected", "0"),
    Stage("mart_reconciliation", "mart_mismatched = 0", "mart_mismatched", "0"),
)


def gold_gate(spec: DomainSpec, source: DataFrame, documents: DataFrame | None,
              detail: DataFrame | None, mart: DataFrame | None) -> DataFrame:
    """All ten gold stages from two stacked aggregations and no join.

    First, source and detail rows are stacked and grouped by transaction key:
    row counts, identities and document associations per key follow. Second,
    those keys, the documents, the re-aggregated source and the mart are stacked
    and grouped by business key: enrichment, mart identities and measures follow.
    Only narrow key columns and partial sums are shuffled.
    """
    keyed = _transaction_level(spec, source, detail)
    summaries = [_transaction_summary(keyed, detail is not None),
                 *_group_summaries(spec, source, documents, mart, keyed, detail is not None)]
    return judge(summaries, _GOLD_METRICS, _GOLD_STAGES)


def _transaction_level(spec: DomainSpec, source: DataFrame, detail: DataFrame | None) -> DataFrame:
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    text = F.lit(None).cast("string")
    left = source.select(
        col(spec.source_key).cast("string").alias("k"),
        col(spec.group_key).cast("string").alias("g"),
        is_blank(spec.group_key).cast("bigint").alias("blank_group"),
        text.alias("doc"), zero.alias("enriched"), one.alias("s"), zero.alias("d"))
    stacked = left
    if detail is not None:
        attached = col(spec.detail_document_key)
        enriched = attached.isNotNull() & col(spec.detail_document_match).isNotNull()
        stacked = left.unionByName(detail.select(
            col(spec.source_key).cast("string").alias("k"), text.alias("g"),
            zero.alias("blank_group"), attached.cast("string").alias("doc"),
            enriched.cast("bigint").alias("enriched"), zero.alias("s"), one.alias("d")))
    return stacked.groupBy("k").agg(
        F.max("g").alias("g"), F.sum("blank_group").alias("blank_groups"),
        F.min("doc").alias("doc_low"), F.max("doc").alias("doc_high"),
        F.max("enriched").alias("enriched"), F.sum("s").alias("s"), F.sum("d").alias("d"))


def _transaction_summary(keyed: DataFrame, has_detail: bool) -> DataFrame:
    blank = F.col("k").isNull() | (F.trim("k") == "")
    keys = F.col("k").isNotNull()
    in_source, in_detail = F.col("s") > 0, F.col("d") > 0
    measures = [
        _total(None, "s").alias("source_rows"),
        _total(blank, "s").alias("source_blank"),
        F.count_if(in_source & keys).alias("source_distinct"),
        _total(None, "blank_groups").alias("source_blank_groups"),
    ]
    if has_detail:
        agrees = (F.col("doc_low").isNull()
                  | (F.col("g").eqNullSafe(F.col("doc_low")) & F.col("g").eqNullSafe(F.col("doc_high"))))
        wrong = (F.when(~in_source, F.col("d")).when(~in_detail, F.col("s"))
                 .when(F.col("k").isNull(), F.col("s") + F.col("d"))
                 .when(~agrees, F.col("d")).otherwise(0))
        measures += [
            _total(None, "d").alias("detail_rows"),
            _total(blank, "d").alias("detail_blank"),
            F.count_if(in_detail & keys).alias("detail_distinct"),
            F.count_if(in_source & ~in_detail).alias("identity_missing"),
            F.count_if(~in_source & in_detail).alias("identity_unexpected"),
            _total(None, wrong).alias("wrong_documents"),
        ]
    return keyed.agg(*measures)


def _group_summaries(spec: DomainSpec, source: DataFrame, documents: DataFrame | None,
                     mart: DataFrame | None, keyed: DataFrame, has_detail: bool) -> list[DataFrame]:
    checks = list(spec.checks)
    counters = ("docs", "src", "marts", "plain", "marked", "orphan_marked")
    exact = F.lit(None).cast(EXACT)

    def layer(df: DataFrame, key: Column, counts: Mapping[str, Column],
              values: Mapping[str, Column]) -> DataFrame:
        return df.select(
            key.cast("string").alias("g"),
            *[counts.get(c, F.lit(0)).cast("bigint").alias(c) for c in counters],
            *[values.get(f"{side}{i}", exact).cast(EXACT).alias(f"{side}{i}")
              for i in range(len(checks)) for side in ("e", "m")])

    # Business keys as the source has them, with the measures the mart must show.
    by_group = source.groupBy(col(spec.group_key).alias("__g")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[c.expected(source).alias(f"__e{i}") for i, c in enumerate(checks)])
    layers = [layer(by_group, F.col("__g"), {"src": F.col("__n")},
                    {f"e{i}": F.col(f"__e{i}") for i in range(len(checks))})]
    if documents is not None:
        layers.append(layer(documents, col(spec.document_key), {"docs": F.lit(1)}, {}))
    if mart is not None:
        layers.append(layer(mart, col(spec.group_key), {"marts": F.lit(1)},
                            {f"m{i}": c.observed() for i, c in enumerate(checks)}))
    if has_detail:
        # Source transactions by group, split by whether the detail shows a document.
        known = keyed.where("s > 0").groupBy("g").agg(
            F.count_if(F.col("enriched") == 0).alias("__plain"),
            F.count_if(F.col("enriched") == 1).alias("__marked"))
        layers.append(layer(known, F.col("g"), {"plain": F.col("__plain"),
                                                "marked": F.col("__marked")}, {}))
        orphans = keyed.where("s = 0 AND enriched = 1").agg(F.count(F.lit(1)).alias("__n"))
        layers.append(layer(orphans, F.lit(None).cast("string"),
                            {"orphan_marked": F.col("__n")}, {}))

    grouped = reduce(DataFrame.unionByName, layers).groupBy("g").agg(
        *[F.sum(c).alias(c) for c in counters],
        *[F.max(f"{side}{i}").alias(f"{side}{i}")
          for i in range(len(checks)) for side in ("e", "m")])

    g = F.col("g")
    blank, known_key = g.isNull() | (F.trim("g") == ""), g.isNotNull()
    has_doc = known_key & (F.col("docs") > 0)
    in_source, in_mart = F.col("src") > 0, F.col("marts") > 0
    measures = [F.count_if(in_source & known_key).alias("groups")]
    if documents is not None:
        measures += [
            _total(None, "docs").alias("documents_rows"),
            _total(blank, "docs").alias("documents_blank"),
            F.count_if((F.col("docs") > 0) & known_key).alias("documents_distinct"),
            _total(has_doc, "src").alias("expected_enriched")]
        if has_detail:
            measures += [
                (_total(None, "marked") + _total(None, "orphan_marked")).alias("observed_enriched"),
                _total(has_doc, "plain").alias("enrichment_missing"),
                (_total(~has_doc, "marked") + _total(None, "orphan_marked"))
                .alias("enrichment_unexpected")]
    if mart is not None:
        same = F.lit(True)
        for i in range(len(checks)):
            same = same & F.col(f"e{i}").eqNullSafe(F.col(f"m{i}"))
        agrees = (known_key & in_source & in_mart & same)
        measures += [
            _total(None, "marts").alias("mart_rows"),
            _total(blank, "marts").alias("mart_blank"),
            F.count_if(in_mart & known_key).alias("mart_distinct"),
            F.count_if(known_key & in_source & ~in_mart).alias("mart_missing"),
            F.count_if(known_key & ~in_source & in_mart).alias("mart_unexpected"),
            F.count_if((in_source | in_mart) & ~agrees).alias("mart_mismatched")
            if checks else F.lit(0).cast("bigint").alias("mart_mismatched")]
    return [grouped.agg(*measures)]


# -- bronze ----------------------------------------------------------------------
def bronze_documents_gate(expected: DataFrame | None, landed: DataFrame | None,
                          registered: DataFrame | None) -> DataFrame:
    """Shipped documents = landed files = registered rows, none of them empty."""
    parts = {"shipped": expected, "landed": landed, "registered": registered}
    summaries = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in parts.items()
                 if df is not None]
    return judge(summaries, tuple(parts), (
        Stage("expected", "shipped > 0", "shipped", "1"),
        Stage("landed", "landed = shipped", "landed", "shipped"),
        Stage("registered", "registered = shipped", "registered", "shipped")))


def bronze_transactions_gate(bronze: DataFrame | None, expected: DataFrame) -> DataFrame:
    """The bronze table can be read and holds exactly the expected rows."""
    summaries = [expected.agg(F.count(F.lit(1)).alias("wanted"))]
    if bronze is not None:
        summaries.append(bronze.agg(F.count(F.lit(1)).alias("found")))
    return judge(summaries, ("wanted", "found"), (
        Stage("readable", "found IS NOT NULL", "IF(found IS NULL, 0, 1)", "1"),
        Stage("row_count", "found = wanted", "found", "wanted")))


# -- silver ----------------------------------------------------------------------
def silver_gate(silver: DataFrame | None, expected: DataFrame, extracted: DataFrame | None,
                class_tables: int | None = None) -> DataFrame:
    """Parsed and classified exactly the shipped documents, and extracted each once.

    ``expected`` has the shipped (source_class, filename) pairs; its classes are
    the label set. ``class_tables`` is the number of class tables written.
    """
    identity = document_identity("source_class", "filename")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    shipped = expected.select(identity.alias("k"), one.alias("e"), zero.alias("o"))
    summaries = [expected.agg(F.count(F.lit(1)).alias("shipped"),
                              F.count_distinct("source_class").alias("labels"))]
    if silver is not None:
        summaries.append(silver.agg(
            F.count(F.lit(1)).alias("silver_rows"),
            F.count_if(is_blank("parsed_text")).alias("blank_text"),
            F.count_if(F.col("doc_class").isNull()).alias("null_class")))
        seen = silver.select(identity.alias("k"), zero.alias("e"), one.alias("o"))
        per_key = shipped.unionByName(seen).groupBy("k").agg(
            F.sum("e").alias("e"), F.sum("o").alias("o"))
        summaries.append(per_key.agg(
            F.count_if(F.col("o") > 0).alias("distinct_documents"),
            F.count_if((F.col("e") > 0) & (F.col("o") == 0)).alias("missing"),
            F.count_if((F.col("e") == 0) & (F.col("o") > 0)).alias("unexpected")))
        labels = expected.select(F.col("source_class").alias("label"), one.alias("e"), zero.alias("o"))
        used = (silver.where("doc_class IS NOT NULL")
                .select(F.col("doc_class").alias("label"), zero.alias("e"), one.alias("o")))
        per_label = labels.unionByName(used).groupBy("label").agg(
            F.sum("e").alias("e"), F.sum("o").alias("o"))
        summaries.append(per_label.agg(
            F.count_if((F.col("e") == 0) & (F.col("o") > 0)).alias("stray_labels")))
    if extracted is not None:
        per_path = extracted.groupBy("doc_class", "path").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("extract_error").isNotNull()).alias("bad"))
        summaries.append(per_path.agg(
            _total(None, "n").alias("extracted"), _total(None, "bad").alias("extract_errors"),
            F.count(F.lit(1)).alias("extracted_paths"),
            *([] if class_tables is None else [F.lit(class_tables).cast("bigint").alias("tables")])))
    tables = "tables = labels" if class_tables is not None else "extracted IS NOT NULL"
    return judge(summaries, (
        "shipped", "labels", "silver_rows", "blank_text", "null_class", "distinct_documents",
        "missing", "unexpected", "stray_labels", "extracted", "extract_errors",
        "extracted_paths", "tables"), (
        Stage("expected", "shipped > 0", "shipped", "1"),
        Stage("text", "blank_text = 0", "blank_text", "0"),
        Stage("class", "null_class = 0", "null_class", "0"),
        Stage("duplicates", "distinct_documents = silver_rows", "distinct_documents", "silver_rows"),
        Stage("identity", "missing + unexpected = 0", "missing + unexpected", "0"),
        Stage("labels", "stray_labels = 0", "stray_labels", "0"),
        Stage("class_tables", tables, "coalesce(tables, labels)", "labels"),
        Stage("extract_errors", "extract_errors = 0", "extract_errors", "0"),
        Stage("extract_duplicates", "extracted_paths = extracted", "extracted_paths", "extracted"),
        Stage("extract_total", "extracted = shipped", "extracted", "shipped")))


# -- serving -----------------------------------------------------------------------
def serving_gate(parity: DataFrame, source_matches: bool | None = None) -> DataFrame:
    """Stages over one ``serving_parity`` row; first, if given, whether the copy was published
    from the source it is compared with."""
    summary = parity.drop("passed")
    first = []
    if source_matches is not None:
        summary = summary.withColumn("matches", F.lit(int(source_matches)).cast("bigint"))
        first = [Stage("source", "matches = 1", "matches", "1")]
    return judge([summary],
                 ("source_rows", "served_rows", "bad_keys", "key_differences",
                  *(["matches"] if first else [])), (
        *first,
        Stage("primary_key", "bad_keys = 0", "bad_keys", "0"),
        Stage("served", "served_rows > 0", "served_rows", "1"),
        Stage("parity", "served_rows = source_rows", "served_rows", "source_rows"),
        Stage("identity", "key_differences = 0", "key_differences", "0")))


# -- metric views --------------------------------------------------------------------
def metrics_gate(spark: SparkSession, view: MetricView | None,
                 tables: Mapping[str, DataFrame], source: str, dimensions: Sequence[str],
                 measures: Sequence[str]) -> DataFrame:
    """A metric view exists, is defined as required, and its measures evaluate sanely.

    ``source``, ``dimensions`` and ``measures`` are the required definition. An
    absent view or source table fails the first stage. Keys of joins that are
    declared unique must not repeat, as totals would grow.
    """
    summaries = []
    if view is None or view.source not in tables:
        summary = spark.range(1).select(F.lit(None).cast("bigint").alias("measures"))
    else:
        summaries.append(view.repeated_keys(tables).where("declared_unique").agg(
            F.coalesce(F.sum("repeated_keys"), F.lit(0)).alias("repeated_keys")))
        errors = view.contract_errors(source, dimensions, measures)
        wrong_source = sum(e.startswith("source ") for e in errors)
        summary = view.sanity(tables).agg(
            F.count(F.lit(1)).alias("measures"), F.count_if(~F.col("passed")).alias("bad_measures"),
            F.lit(wrong_source).cast("bigint").alias("missing_source"),
            F.lit(len(errors) - wrong_source).cast("bigint").alias("missing_names"))
    return judge([summary, *summaries], ("missing_source", "missing_names", "measures",
                                         "bad_measures", "repeated_keys"), (
        Stage("describe", "measures IS NOT NULL", "IF(measures IS NULL, 0, 1)", "1"),
        Stage("definition", "missing_names = 0", "missing_names", "0"),
        Stage("source", "missing_source = 0", "missing_source", "0"),
        Stage("join_keys", "repeated_keys = 0", "repeated_keys", "0"),
        Stage("sanity", "bad_measures = 0", "bad_measures", "0")))


# -- metadata --------------------------------------------------------------------------
def metadata_gate(dictionary: DataFrame, expected_tables: DataFrame, min_pi_columns: int = 1,
                  expected_pi: DataFrame | None = None) -> DataFrame:
    """Every expected table is described, column by column, classified and in a domain.

    ``expected_tables`` has one ``table_name`` per table. ``expected_pi``, with
    (table_name, column_name), asks for exactly those classified columns instead
    of a minimum number.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    wanted = expected_tables.select("table_name", one.alias("e"), zero.alias("c"), zero.alias("d"))
    described = dictionary.select(
        "table_name", zero.alias("e"), one.alias("c"),
        is_blank("business_domain").cast("bigint").alias("d"))
    per_table = wanted.unionByName(described).groupBy("table_name").agg(
        F.sum("e").alias("e"), F.sum("c").alias("c"), F.sum("d").alias("d"))
    expected = F.col("e") > 0
    classified = ~is_blank("pi_class")
    summaries = [
        per_table.agg(F.count_if(expected).alias("wanted"),
                      F.count_if(expected & (F.col("c") == 0)).alias("missing_tables"),
                      F.count_if(expected & (F.col("d") > 0)).alias("undomained")),
        dictionary.agg(F.count(F.lit(1)).alias("column_rows"),
                       F.count_if(is_blank("description")).alias("undescribed"),
                       F.count_if(F.col("pi_class").isNotNull() & ~classified).alias("blank_pi"),
                       F.count_if(classified).alias("pi_columns"))]
    pi_stage = Stage("pi_columns", f"pi_columns >= {int(min_pi_columns)}", "pi_columns",
                     str(int(min_pi_columns)))
    if expected_pi is not None:
        left = expected_pi.select("table_name", "column_name", one.alias("e"), zero.alias("o"))
        right = dictionary.where(classified).select(
            "table_name", "column_name", zero.alias("e"), one.alias("o"))
        summaries.append(left.unionByName(right).groupBy("table_name", "column_name").agg(
            F.sum("e").alias("e"), F.sum("o").alias("o")).agg(
            F.count_if((F.col("e") > 0) != (F.col("o") > 0)).alias("pi_differences")))
        pi_stage = Stage("pi_columns", "pi_differences = 0", "pi_differences", "0")
    return judge(summaries, ("wanted", "missing_tables", "undomained", "column_rows",
                             "undescribed", "blank_pi", "pi_columns", "pi_differences"), (
        Stage("tables", "wanted > 0 AND missing_tables = 0", "wanted - missing_tables", "wanted"),
        Stage("column_descriptions", "undescribed = 0", "undescribed", "0"),
        Stage("pi_values", "blank_pi = 0", "blank_pi", "0"),
        pi_stage,
        Stage("domains", "undomained = 0", "undomained", "0")))
