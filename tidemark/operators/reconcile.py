"""Reconciliation: identity sets, join association, measures and manifests.

Two tables are compared by stacking them with a side tag and grouping by key.
Grouping combines on the map side, so a key that holds a large part of a broken
table is one row per split; a full outer join would put all its pairs in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import EXACT, col, exact_sum


def identity_diff(expected: DataFrame, observed: DataFrame, key: str,
                  observed_key: str | None = None) -> DataFrame:
    """Keys in one set only: ``(side, entity_key)`` with side missing or unexpected."""
    left = expected.select(col(key).cast("string").alias("entity_key"), F.lit(1).alias("e"),
                           F.lit(0).alias("o"))
    right = observed.select(col(observed_key or key).cast("string").alias("entity_key"),
                            F.lit(0).alias("e"), F.lit(1).alias("o"))
    sides = left.unionByName(right).groupBy("entity_key").agg(
        F.max("e").alias("e"), F.max("o").alias("o"))
    return sides.where("e <> o").select(
        F.when(F.col("e") == 1, "missing").otherwise("unexpected").alias("side"), "entity_key")


def diff_examples(diff: DataFrame, examples: int = 20) -> DataFrame:
    """The first sorted keys of each side: a top-k per side, for reports.

    Spark limits the ranked rows inside every task before it shuffles them, so
    no task receives more than ``examples`` rows per side and task.
    """
    by_side = Window.partitionBy("side").orderBy("entity_key")
    return (diff.withColumn("__rank", F.row_number().over(by_side))
            .where(F.col("__rank") <= examples).drop("__rank"))


def association_mismatches(source: DataFrame, detail: DataFrame, source_key: str,
                           source_group: str, detail_key: str, document_key: str) -> DataFrame:
    """One row: transaction rows missing, extra, or attached to a wrong document key.

    The same number as counting, over the full outer join on the key, the rows
    where a side is absent or a non-null document key differs from the business
    key. Pairs are counted from per-(key, value) row counts instead of being
    built: of ``d`` detail rows with value v, each pairs wrongly with every
    source row of its key that has another value.
    """
    left = source.select(
        col(source_key).cast("string").alias("k"), col(source_group).cast("string").alias("v"),
        F.lit(1).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("d"))
    right = detail.select(
        col(detail_key).cast("string").alias("k"), col(document_key).cast("string").alias("v"),
        F.lit(0).cast("bigint").alias("s"), F.lit(1).cast("bigint").alias("d"))
    per_value = left.unionByName(right).groupBy("k", "v").agg(
        F.sum("s").alias("s"), F.sum("d").alias("d"))
    known = F.col("v").isNotNull()
    per_key = per_value.groupBy("k").agg(
        F.sum("s").alias("s"), F.sum("d").alias("d"),
        F.sum(F.when(known, F.col("d")).otherwise(0)).alias("attached"),
        F.sum(F.when(known, F.col("s") * F.col("d")).otherwise(0)).alias("right_pairs"))
    one_sided = F.col("k").isNull() | (F.col("s") == 0) | (F.col("d") == 0)
    wrong = F.when(one_sided, F.col("s") + F.col("d")).otherwise(
        F.col("s") * F.col("attached") - F.col("right_pairs"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(~one_sided, F.col("s") * F.col("d")).otherwise(
            F.col("s") + F.col("d"))), F.lit(0)).alias("compared_rows"),
        F.coalesce(F.sum(wrong), F.lit(0)).alias("mismatched_rows"))


@dataclass(frozen=True)
class MeasureCheck:
    """One mart measure and how it must follow from the source rows."""

    mart_column: str
    kind: str = "sum"  # sum | count | count_distinct
    source_column: str | None = None

    def expected(self, source: DataFrame) -> Column:
        name = self.source_column or self.mart_column
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "count_distinct":
            return F.count_distinct(col(name))
        return exact_sum(source, name).cast(EXACT)

    def observed(self) -> Column:
        value = col(self.mart_column)
        return value.cast(EXACT) if self.kind == "sum" else value


def measure_comparison(source: DataFrame, mart: DataFrame, group_key: str, mart_key: str,
                       checks: Sequence[MeasureCheck]) -> DataFrame:
    """Per business key: side counts and, per measure, whether both sides agree.

    The source is re-aggregated by the business key (exact decimal sums); both
    sides are then unique, so the full join never multiplies rows. The key is
    cast to text only when its types differ, so that the aggregation's own
    partitioning is reused by the join.
    """
    same = source.schema[group_key].dataType == mart.schema[mart_key].dataType
    grouped = source.groupBy(col(group_key).alias("__k")).agg(
        *[c.expected(source).alias(f"__e{i}") for i, c in enumerate(checks)])
    expected = grouped.withColumn("__source", F.lit(True))
    observed = mart.select(
        col(mart_key).alias("__mk"), F.lit(True).alias("__mart"),
        *[c.observed().alias(f"__m{i}") for i, c in enumerate(checks)])
    if same:
        on = F.col("__k") == F.col("__mk")
    else:
        on = F.col("__k").cast("string") == F.col("__mk").cast("string")
    joined = expected.join(observed, on, "full")
    agree = [F.col(f"__e{i}").eqNullSafe(F.col(f"__m{i}")).alias(c.mart_column)
             for i, c in enumerate(checks)]
    return joined.select(
        F.coalesce(F.col("__k").cast("string"), F.col("__mk").cast("string")).alias("business_key"),
        (F.col("__k").isNotNull()).alias("in_source"),
        (F.col("__mk").isNotNull()).alias("in_mart"), *agree)


def measure_mismatches(source: DataFrame, mart: DataFrame, group_key: str, mart_key: str,
                       checks: Sequence[MeasureCheck]) -> DataFrame:
    """One row: compared business keys, mismatched ones, and mismatches per measure."""
    compared = measure_comparison(source, mart, group_key, mart_key, checks)
    both = F.col("in_source") & F.col("in_mart")
    agree = F.lit(True)
    for check in checks:
        agree = agree & col(check.mart_column)
    return compared.agg(
        F.count(F.lit(1)).alias("compared_groups"),
        F.count_if(~(both & agree)).alias("mismatched_groups"),
        *[F.count_if(~(both & col(c.mart_column))).alias(f"mismatched_{c.mart_column}")
          for c in checks])


def manifest_audit(artifacts: DataFrame, manifest: DataFrame, key: str, digest: str) -> DataFrame:
    """Per key: ``ok``, ``mismatch``, ``unlisted`` (no manifest row) or ``missing``.

    Both sides give (key, digest). Repeats of a key collapse while grouping: a
    key is ``ok`` only if all its digests on both sides are one value.
    """
    left = artifacts.select(col(key).alias(key), col(digest).alias("__d"), F.lit(1).alias("__a"),
                            F.lit(0).alias("__m"))
    right = manifest.select(col(key).alias(key), col(digest).alias("__d"), F.lit(0).alias("__a"),
                            F.lit(1).alias("__m"))
    sides = left.unionByName(right).groupBy(col(key)).agg(
        F.max("__a").alias("__a"), F.max("__m").alias("__m"),
        F.min("__d").alias("__lo"), F.max("__d").alias("__hi"),
        F.count_if(F.col("__d").isNull()).alias("__unknown"))
    status = (F.when(F.col("__m") == 0, "unlisted")
              .when(F.col("__a") == 0, "missing")
              .when((F.col("__unknown") > 0) | (F.col("__lo") != F.col("__hi")), "mismatch")
              .otherwise("ok"))
    return sides.select(col(key), status.alias("status"))
