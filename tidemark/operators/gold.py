"""Document enrichment at transaction grain and marts at business-key grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import col, exact_avg, exact_sum
from tidemark.operators.distincts import with_distincts


def enrich(facts: DataFrame, documents: DataFrame, group_key: str, document_key: str,
           carry: Mapping[str, str | Column]) -> DataFrame:
    """Every fact once, with the attributes of the document its key names.

    ``carry`` maps the output name to the document column. A document key must
    be unique (the gate proves it), so the left join keeps the fact grain and
    partial coverage leaves nulls. There is no broadcast hint: the document side
    grows with the business, so adaptive execution picks broadcast from its
    measured size, and splits a hot key's fact partition otherwise (a left join
    may split its left side, and nothing after this join re-groups the rows).
    """
    side = documents.select(
        col(document_key).alias("__document_key"),
        *[(col(source) if isinstance(source, str) else source).alias(name)
          for name, source in carry.items()])
    joined = facts.alias("fact").join(
        side.alias("doc"), F.col(f"fact.{group_key}") == F.col("doc.__document_key"), "left")
    return joined.select("fact.*", *[F.col(f"doc.{name}") for name in carry])


@dataclass(frozen=True)
class Total:
    """The exact sum of a column."""

    column: str

    def over(self, df: DataFrame) -> Column:
        return exact_sum(df, self.column)


@dataclass(frozen=True)
class Mean:
    """The mean of a column, from its exact sum where it is a decimal."""

    column: str

    def over(self, df: DataFrame) -> Column:
        return exact_avg(df, self.column)


@dataclass(frozen=True)
class Different:
    """How many different values a column has."""

    column: str

    def over(self, df: DataFrame) -> Column:
        return F.count_distinct(col(self.column))


@dataclass(frozen=True)
class Mart:
    """Grain, measures and attributes of a business-key mart.

    ``attributes`` come from the document and ``fact_attributes`` from the facts;
    both depend on the business key. ``picked`` are texts of the fact with the
    largest value of another column: (name, that column, text column). ``collapses``
    says that a key has many rows, so that reducing its texts first is worth a pass.
    """

    group_key: str
    measures: tuple[tuple[str, Column | Total | Mean | Different], ...]
    attributes: tuple[str, ...] = ()
    fact_attributes: tuple[str, ...] = ()
    picked: tuple[tuple[str, str, str], ...] = ()
    collapses: bool = True

    @property
    def columns(self) -> list[str]:
        return [self.group_key, *self.attributes, *self.fact_attributes,
                *[name for name, _, _ in self.picked], *[name for name, _ in self.measures]]

    def totals(self, df: DataFrame, attributes: Sequence[str]) -> DataFrame:
        """Measures and attributes by business key.

        The two are aggregated apart. Measures keep to fixed-width buffers and so
        stay in a hash aggregation; one text among them would turn it into a sort
        of all rows. Attributes are first reduced to their distinct values, and
        their first non-null one is taken by ``max``, which does not depend on
        row order. Both sides end up partitioned by the key that joins them. Facts
        without a business key, which the gate rejects, keep their measures and get
        no attributes. Where the key hardly repeats, nothing collapses, and all is
        aggregated in one pass. More than one distinct count is taken apart too.
        """
        counted = {name: m.column for name, m in self.measures if isinstance(m, Different)}
        if len(counted) > 1:
            rest = replace(self, measures=tuple(
                (n, m) for n, m in self.measures if n not in counted))
            return with_distincts(rest.totals(df, attributes), df, [self.group_key], counted)
        key = col(self.group_key)
        measures = [(m.over(df) if isinstance(m, (Total, Mean, Different)) else m).alias(name)
                    for name, m in self.measures]
        texts = [F.max(col(a)).alias(a) for a in attributes]
        texts += [F.max(F.struct(col(by), col(text)))[text].alias(name)
                  for name, by, text in self.picked]
        if not texts:
            return df.groupBy(key).agg(*measures)
        if not self.collapses:
            return df.groupBy(key).agg(*measures, *texts)
        needed = dict.fromkeys([*attributes, *[c for _, by, text in self.picked
                                               for c in (by, text)]])
        described = df.select(key, *[col(c) for c in needed]).distinct().groupBy(key).agg(*texts)
        return df.groupBy(key).agg(*measures).join(described, self.group_key, "left")


def mart_from_detail(detail: DataFrame, mart: Mart) -> DataFrame:
    """The mart of a persisted detail table."""
    totals = mart.totals(detail, [*mart.attributes, *mart.fact_attributes])
    return totals.select(*[col(c) for c in mart.columns])


def mart_from_source(facts: DataFrame, documents: DataFrame, mart: Mart,
                     document_key: str, carry: Mapping[str, str | Column]) -> DataFrame:
    """The same mart without joining at transaction grain.

    Facts are aggregated first (with map-side combine, so a hot key is one row
    per split) and documents join the already unique business keys.
    """
    keep = {name: carry[name] for name in mart.attributes}
    enriched = enrich(mart.totals(facts, mart.fact_attributes), documents, mart.group_key,
                      document_key, keep)
    return enriched.select(*[col(c) for c in mart.columns])


def expected_enriched(facts: DataFrame, documents: DataFrame, source_key: str,
                      group_key: str, document_key: str) -> DataFrame:
    """Keys of the facts whose business key has a document."""
    same_type = (facts.schema[group_key].dataType == documents.schema[document_key].dataType)
    left = col(group_key) if same_type else col(group_key).cast("string")
    right = col(document_key) if same_type else col(document_key).cast("string")
    keyed = facts.select(col(source_key).cast("string").alias("entity_key"),
                         left.alias("__group"))
    keys = documents.select(right.alias("__group"))
    return keyed.join(keys, "__group", "left_semi").select("entity_key")


def preview(mart: DataFrame, columns: Sequence[str], by: str, key: str) -> DataFrame:
    """Chosen mart columns, largest measure first; the key settles ties."""
    return mart.select(*[col(c) for c in columns]).orderBy(col(by).desc(), col(key))
