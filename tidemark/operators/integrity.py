"""Key, document and extraction integrity; expectations and constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import col, document_identity, is_blank


def key_integrity(df: DataFrame, key: str, group_key: str | None = None) -> DataFrame:
    """One row: rows, blank keys, distinct keys and, if asked, blank group keys."""
    measures = [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_blank(key)).alias("blank_keys"),
        F.count_distinct(col(key)).alias("distinct_keys"),
    ]
    if group_key:
        measures.append(F.count_if(is_blank(group_key)).alias("blank_group_keys"))
    return df.agg(*measures)


def document_integrity(docs: DataFrame, text: str = "parsed_text", doc_class: str = "doc_class",
                       id_class: str = "source_class", id_name: str = "filename") -> DataFrame:
    """One row: rows, blank texts, unclassified rows, distinct class/filename identities."""
    return docs.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_blank(text)).alias("blank_text"),
        F.count_if(col(doc_class).isNull()).alias("null_class"),
        F.count_distinct(document_identity(id_class, id_name)).alias("distinct_documents"))


def extract_integrity(extracted: DataFrame, doc_class: str = "doc_class",
                      error: str = "extract_error", path: str = "path") -> DataFrame:
    """Per class: rows, rows with an extraction error, distinct paths; and the total.

    The total is summed from the per-class rows, as a path belongs to one table.
    """
    per_class = extracted.groupBy(col(doc_class).alias("doc_class")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(col(error).isNotNull()).alias("error_rows"),
        F.count_distinct(col(path)).alias("distinct_paths"))
    total = per_class.agg(
        F.lit("(all)").alias("doc_class"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("total_rows", "error_rows", "distinct_paths")])
    return per_class.unionByName(total)


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value combination, in value order."""
    return (df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(*[col(c) for c in columns]))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct().orderBy(col(column))


def row_count_expectation(actual: DataFrame, expected: int | DataFrame, name: str) -> DataFrame:
    """One row: counted rows against a number or another table's rows."""
    counted = actual.agg(F.count(F.lit(1)).alias("observed"), F.lit(0).cast("bigint").alias("expected"))
    if isinstance(expected, DataFrame):
        wanted = expected.agg(F.lit(0).cast("bigint").alias("observed"), F.count(F.lit(1)).alias("expected"))
        counted = counted.unionByName(wanted).agg(
            F.sum("observed").alias("observed"), F.sum("expected").alias("expected"))
    else:
        counted = counted.select("observed", F.lit(expected).cast("bigint").alias("expected"))
    return counted.select(F.lit(name).alias("table_name"), "observed", "expected",
                          (F.col("observed") == F.col("expected")).alias("passed"))


def unexpected_values(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """Distinct non-null values outside the allowed set, with their row counts."""
    counted = (df.where(col(column).isNotNull()).groupBy(col(column).alias("value"))
               .agg(F.count(F.lit(1)).alias("row_count")))
    labels = allowed.select(col(allowed_column).alias("value")).distinct()
    return counted.join(labels, "value", "left_anti")


def constraint_violations(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Per named constraint: rows that break it, in one pass over the table.

    As in a CHECK constraint, an unknown (NULL) outcome is no violation.
    """
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *[
        F.count_if(~rule).alias(name) for name, rule in constraints.items()])
    return unpivot_row(counted, list(constraints), "constraint_name", "violations", ["__rows"]) \
        .withColumnRenamed("__rows", "checked_rows")


def unpivot_row(df: DataFrame, columns: Sequence[str], name: str, value: str,
                keep: Sequence[str] = ()) -> DataFrame:
    """One row per column of a one-row summary."""
    return df.unpivot([col(k) for k in keep], [col(c) for c in columns], name, value)
