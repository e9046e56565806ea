"""Several distinct counts of the same groups without multiplying the rows.

Two distinct counts in one aggregation copy every row, measures and all, once for each.
Here the counted values alone are stacked: narrow rows of (group, which column, value),
made distinct inside the tasks before their only shuffle, then counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import col

_TAG, _VALUE = "__tag", "__value"


def stacked_distincts(rows: DataFrame, keys: Sequence[str],
                      counted: Mapping[str, str]) -> DataFrame:
    """``keys`` and, for each name of ``counted``, the number of different non-null values of
    its column; only groups with any value have a row. Values are told apart as text."""
    tagged = F.array(*[F.struct(F.lit(i).alias("tag"), col(c).cast("string").alias("value"))
                       for i, c in enumerate(counted.values())])
    narrow = rows.select(*[col(k) for k in keys], F.explode(tagged).alias("__pair")).select(
        *[col(k) for k in keys], F.col("__pair.tag").alias(_TAG), F.col("__pair.value").alias(_VALUE))
    different = narrow.where(F.col(_VALUE).isNotNull()).distinct()
    return different.groupBy(*[col(k) for k in keys]).agg(*[
        F.count_if(F.col(_TAG) == i).alias(name) for i, name in enumerate(counted)])


def with_distincts(grouped: DataFrame, rows: DataFrame, keys: Sequence[str],
                   counted: Mapping[str, str]) -> DataFrame:
    """``grouped``, one row a group of ``rows``, with the distinct counts beside it."""
    counts = stacked_distincts(rows, keys, counted)
    counts = counts.select(*[col(k).alias(f"__of_{i}") for i, k in enumerate(keys)],
                           *[col(n) for n in counted])
    same: Column = reduce(lambda a, b: a & b, [
        col(k).eqNullSafe(F.col(f"__of_{i}")) for i, k in enumerate(keys)])
    joined = grouped.join(counts, same, "left")
    return joined.select(*[col(c) for c in grouped.columns],
                         *[F.coalesce(col(n), F.lit(0)).alias(n) for n in counted])
