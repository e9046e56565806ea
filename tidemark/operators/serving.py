"""What the data app shows of a served mart, computed on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.columns import col, exact_avg, exact_sum

# A category column has more than one and at most 25 values.
MIN_CATEGORIES = 2
MAX_CATEGORIES = 25


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def kpis(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and the mean of the first numeric column."""
    numeric = numeric_columns(df)
    if not numeric:
        mean = F.lit(None).cast("double")
    else:
        mean = exact_avg(df, numeric[0])
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                  F.lit(numeric[0] if numeric else None).alias("metric"),
                  mean.cast("double").alias("metric_mean"))


def category_column(df: DataFrame, candidates: Sequence[str] | None = None) -> str | None:
    """The first non-numeric column with 2 to 25 distinct values.

    Each candidate in turn is reduced to its distinct values, map-side first, and
    counted up to 26 of them: exact, and no more than that reaches the driver.
    """
    numeric = set(numeric_columns(df))
    names = [c for c in (candidates or df.columns) if c not in numeric]
    for name in names:
        values = df.select(col(name)).where(col(name).isNotNull()).distinct()
        if MIN_CATEGORIES <= values.limit(MAX_CATEGORIES + 1).count() <= MAX_CATEGORIES:
            return name
    return None


def top_categories(df: DataFrame, category: str, metric: str, k: int = 10) -> DataFrame:
    """The ``k`` categories with the largest metric totals."""
    return (df.groupBy(col(category)).agg(exact_sum(df, metric).alias("total"))
            .where(col(category).isNotNull())
            .orderBy(F.desc("total"), col(category)).limit(k))


def top_rows(df: DataFrame, metric: str, key: str, k: int = 10) -> DataFrame:
    """The ``k`` rows with the largest metric; the key settles ties."""
    return df.where(col(metric).isNotNull()).orderBy(col(metric).desc(), col(key)).limit(k)


def serving_parity(source: DataFrame, served: DataFrame | None, key: str) -> DataFrame:
    """One row: row counts of both sides, repeated or blank keys, and the verdict.

    Fails closed: an unreadable serving copy, an empty one, or any unknown is a
    failure. Key sets are compared exactly, as equal counts can hide a swap.
    """
    left = source.select(col(key).cast("string").alias("k"), F.lit(1).cast("bigint").alias("s"),
                         F.lit(0).cast("bigint").alias("t"))
    stacked = left
    if served is not None:
        stacked = left.unionByName(served.select(
            col(key).cast("string").alias("k"), F.lit(0).cast("bigint").alias("s"),
            F.lit(1).cast("bigint").alias("t")))
    per_key = stacked.groupBy("k").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    blank = F.col("k").isNull() | (F.trim("k") == "")
    counts = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("served_rows"),
        F.count_if((F.col("t") > 1) | (blank & (F.col("t") > 0))).alias("bad_keys"),
        F.count_if((F.col("s") > 0) != (F.col("t") > 0)).alias("key_differences"))
    passed = ((F.col("served_rows") > 0) & (F.col("served_rows") == F.col("source_rows"))
              & (F.col("bad_keys") == 0) & (F.col("key_differences") == 0))
    return counts.withColumn("passed", F.coalesce(passed, F.lit(False)))
