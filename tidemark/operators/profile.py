"""Column profiles, sensitive columns and the data dictionary, as data jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.columns import col, describe_identifier, is_blank
from tidemark.functions.detectors import DETECTORS


def _scalar_fields(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType,
                                           T.BinaryType, T.VariantType))]


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, rows, nulls, rough distinct count, extremes, mean text length.

    A single aggregation over the table: one buffer per column and task. The
    distinct count is a sketch, as exact ones would copy every row per column.
    """
    fields = df.schema.fields
    scalar = {f.name for f in _scalar_fields(df)}
    summaries = []
    for i, f in enumerate(fields):
        value = col(f.name)
        rough = F.approx_count_distinct(value) if f.name in scalar else F.lit(None).cast("bigint")
        low = F.min(value).cast("string") if f.name in scalar else F.lit(None).cast("string")
        high = F.max(value).cast("string") if f.name in scalar else F.lit(None).cast("string")
        text = isinstance(f.dataType, T.StringType)
        size = F.sum(F.length(value)) if text else F.lit(None).cast("bigint")
        summaries.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(i).cast("bigint").alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(value.isNull()).alias("null_count"),
            rough.alias("approx_distinct"), low.alias("min_value"), high.alias("max_value"),
            F.try_divide(size.cast("double"), F.count(value)).alias("mean_length")))
    return df.agg(F.array(*summaries).alias("columns")).select(F.inline("columns"))


def sensitive_matches(df: DataFrame, table: str, detectors: Mapping[str, tuple[str, str]] | None = None,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column and detector: non-null values and how many match, in one pass."""
    rules = dict(detectors or DETECTORS)
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cells = [
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                 F.lit(kind).alias("detector"), F.count(col(name)).alias("values_checked"),
                 F.count_if(col(name).contains(needs) & col(name).rlike(pattern)).alias("matches"))
        for name in names for kind, (pattern, needs) in rules.items()]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def sensitive_columns(matches: DataFrame, threshold: float = 0.0) -> DataFrame:
    """A row per column and detector (``pi_class``) whose match rate exceeds ``threshold``."""
    return matches.where((F.col("matches") > 0)
                         & (F.col("matches") > F.lit(threshold) * F.col("values_checked"))).select(
        "table_name", "column_name", F.col("detector").alias("pi_class"), "matches",
        "values_checked")


def data_dictionary(profile: DataFrame, sensitive: DataFrame, domain: str | None,
                    curated: Sequence[str] = ()) -> DataFrame:
    """A reviewable row per (table, column): type, description, classes and domain.

    ``pi_class`` lists all classes found, in the order of their names. ``curated``
    names columns to treat as personal even where no detector fires.
    """
    sensitive = sensitive.groupBy("table_name", "column_name").agg(
        F.array_join(F.sort_array(F.collect_set("pi_class")), ", ").alias("pi_class"))
    detected = F.col("pi_class")
    if curated:
        detected = F.coalesce(detected, F.when(F.col("column_name").isin(*curated), "personal"))
    return profile.join(sensitive.select("table_name", "column_name", "pi_class"),
                        ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "ordinal", "data_type", "row_count", "null_count",
        describe_identifier("column_name").alias("description"), detected.alias("pi_class"),
        F.lit(domain).cast("string").alias("business_domain"))


def metadata_coverage(dictionary: DataFrame, min_pi_columns: int = 1) -> DataFrame:
    """Per table: columns, blank descriptions, classified columns, and the verdict.

    A blank class is not a class, and a table needs a non-blank domain.
    """
    grouped = dictionary.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(is_blank("description")).alias("blank_descriptions"),
        F.count_if(F.col("pi_class").isNotNull() & is_blank("pi_class")).alias("blank_pi_classes"),
        F.count_if(~is_blank("pi_class")).alias("pi_columns"),
        F.count_if(is_blank("business_domain")).alias("blank_domains"))
    passed = ((F.col("blank_descriptions") == 0) & (F.col("blank_pi_classes") == 0)
              & (F.col("pi_columns") >= min_pi_columns) & (F.col("blank_domains") == 0))
    return grouped.withColumn("passed", passed)
