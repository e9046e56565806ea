"""The semantic layer: named dimensions and measures over a table and its joins.

A metric view holds no data. ``MetricView.query`` builds one DataFrame plan for
the dimensions and measures asked for:

* only joins that a requested dimension needs are planned (they are many-to-one
  left joins, so leaving one out changes neither grain nor totals);
* tables that hang on a joined table are joined to it first, so that the source
  rows meet each branch of the snowflake once;
* when one branch is needed and nothing is counted distinct, the rows are first
  aggregated by its key, which collapses a hot key on the map side; with more
  branches the keys together are nearly as many as the rows;
* more than one distinct count is taken from narrow stacked values, not from copied rows;
* composed measures are evaluated after aggregation, at the query's own grain,
  those that others use first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col, from_limbs, is_blank, limbs, narrow_decimal
from tidemark.operators.distincts import with_distincts


#: A bounded table of at most so many rows is broadcast.
SMALL_ROWS = 10_000


@dataclass(frozen=True)
class Dimension:
    """A named grouping expression; ``join`` names the joined table it reads."""

    name: str
    expr: str
    join: str | None = None


@dataclass(frozen=True)
class Join:
    """A many-to-one left join: ``left_key`` of the rows so far = ``right_key``.

    ``after`` names the join that provides ``left_key`` when it is not a source
    column. ``bounded`` says the table has a fixed number of rows (a code list),
    so aggregating before the join gains nothing, and it is broadcast to the table
    it hangs on once its size is checked. ``unique`` promises that
    ``right_key`` does not repeat (``MetricView.repeated_keys`` proves it); without
    the promise the table is reduced to one row per key, the largest.
    """

    name: str
    left_key: str
    right_key: str
    after: str | None = None
    bounded: bool = False
    unique: bool = False


@dataclass(frozen=True)
class Measure:
    """An aggregate of source expressions, or an expression over other measures.

    ``kind``: ``count``, ``sum``, ``avg``, ``min``, ``max``, ``count_distinct``
    over ``expr``; ``composed`` evaluates ``expr`` over measure names.
    """

    name: str
    kind: str
    expr: str | None = None
    uses: tuple[str, ...] = ()


def count(name: str) -> Measure:
    return Measure(name, "count")


def total(name: str, expr: str) -> Measure:
    return Measure(name, "sum", expr)


def mean(name: str, expr: str) -> Measure:
    return Measure(name, "avg", expr)


def distinct(name: str, expr: str) -> Measure:
    return Measure(name, "count_distinct", expr)


def count_if(name: str, condition: str) -> Measure:
    return Measure(name, "sum", f"CASE WHEN {condition} THEN 1 ELSE 0 END")


def composed(name: str, expr: str, *uses: str) -> Measure:
    return Measure(name, "composed", expr, uses)


def ratio(name: str, numerator: str, denominator: str) -> Measure:
    """``numerator / nullif(denominator, 0)`` of two measures, as a double."""
    return composed(
        name, f"try_divide(CAST(`{numerator}` AS DOUBLE), CAST(`{denominator}` AS DOUBLE))",
        numerator, denominator)


class MetricViewError(ValueError):
    """A metric view or a query on it names something that is not there."""


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    joins: tuple[Join, ...] = ()
    comment: str = ""

    def __post_init__(self) -> None:
        names = [d.name for d in self.dimensions] + [m.name for m in self.measures]
        if len(set(names)) != len(names):
            raise MetricViewError(f"{self.name}: a name is defined twice")
        joins = {j.name for j in self.joins}
        for dimension in self.dimensions:
            if dimension.join is not None and dimension.join not in joins:
                raise MetricViewError(f"{self.name}: {dimension.name} needs unknown join "
                                      f"{dimension.join}")
        known: set[str] = set()
        for join in self.joins:
            if join.after is not None and join.after not in known:
                raise MetricViewError(f"{self.name}: join {join.name} follows {join.after}, "
                                      "which is not declared before it")
            known.add(join.name)
        measures = {m.name for m in self.measures}
        for measure in self.measures:
            unknown = set(measure.uses) - measures
            if unknown:
                raise MetricViewError(f"{self.name}: {measure.name} uses {sorted(unknown)}")
        self._composed([m.name for m in self.measures])

    # -- lookups -----------------------------------------------------------
    def dimension(self, name: str) -> Dimension:
        for dimension in self.dimensions:
            if dimension.name == name:
                return dimension
        raise MetricViewError(f"{self.name} has no dimension {name!r}")

    def measure(self, name: str) -> Measure:
        for measure in self.measures:
            if measure.name == name:
                return measure
        raise MetricViewError(f"{self.name} has no measure {name!r}")

    def _atomic(self, names: Sequence[str]) -> list[Measure]:
        """The stored measures that ``names`` need, each once, in need order."""
        out: dict[str, Measure] = {}

        def add(name: str) -> None:
            measure = self.measure(name)
            if measure.kind == "composed":
                for used in measure.uses:
                    add(used)
            else:
                out[measure.name] = measure

        for name in names:
            add(name)
        return list(out.values())

    def _composed(self, names: Sequence[str]) -> list[Measure]:
        """The composed measures that ``names`` need, used ones before their users."""
        out: dict[str, Measure] = {}

        def add(name: str, users: tuple[str, ...]) -> None:
            measure = self.measure(name)
            if name in users:
                raise MetricViewError(f"{self.name}: {name} is composed of itself")
            if measure.kind == "composed" and name not in out:
                for used in measure.uses:
                    add(used, (*users, name))
                out[name] = measure

        for name in names:
            add(name, ())
        return list(out.values())

    def _needed_joins(self, dimensions: Sequence[Dimension]) -> list[Join]:
        by_name = {j.name: j for j in self.joins}
        needed: set[str] = set()
        for dimension in dimensions:
            name = dimension.join
            while name is not None and name not in needed:
                needed.add(name)
                name = by_name[name].after
        return [j for j in self.joins if j.name in needed]

    # -- the query ---------------------------------------------------------
    def query(self, tables: Mapping[str, DataFrame], dimensions: Sequence[str] = (),
              measures: Sequence[str] = (), where: Mapping[str, object] | None = None,
              order_by: Sequence[tuple[str, str]] = (), limit: int | None = None) -> DataFrame:
        """Aggregate ``measures`` by ``dimensions``.

        ``where`` maps a dimension to a value, or to a list of allowed values.
        ``order_by`` is ``(name, "asc" | "desc")`` pairs; for a stable ``limit``
        end it with the dimensions.
        """
        filters = dict(where or {})
        asked = [self.dimension(d) for d in dimensions]
        filtered = [self.dimension(d) for d in filters if d not in dimensions]
        all_dims = asked + filtered
        atomic = self._atomic(measures)
        partials = [_Partial(m, f"__m{i}") for i, m in enumerate(atomic)]
        joins = self._needed_joins(all_dims)

        rows = self._project(tables[self.source], all_dims, joins, partials)
        rows = _filter(rows, filters, [d for d in all_dims if d.join is None])
        branches = [j for j in joins if j.after is None]
        if (len(branches) == 1 and not branches[0].bounded
                and not any(p.distinct_column for p in partials)):
            rows = _preaggregate(rows, partials)
        # A branch keyed by what is counted distinct comes last and is joined by that very
        # column: its rows are then already where the count needs them.
        counted = {p.measure.expr: p.distinct_column for p in partials if p.distinct_column}
        for join in sorted(branches, key=lambda j: j.left_key in counted):
            right = self._branch(tables, join, joins, all_dims)
            key = counted.get(join.left_key, f"__key_{join.name}")
            rows = rows.join(right, F.col(key) == F.col(f"__on_{join.name}"), "left").drop(
                f"__key_{join.name}", f"__on_{join.name}")
        rows = _filter(rows, filters, [d for d in all_dims if d.join is not None])

        counted = {p.prefix: p.distinct_column for p in partials if p.distinct_column}
        apart = len(counted) > 1 and bool(asked)
        finals = [c for p in partials if not (apart and p.distinct_column) for c in p.finals()]
        grouped = rows.groupBy(*[col(d.name) for d in asked]).agg(
            *(finals or [F.count(F.lit(1)).alias("__rows")]))
        if apart:
            grouped = with_distincts(grouped, rows, [d.name for d in asked], counted)
        resolved = grouped.select(*[col(d.name) for d in asked],
                                  *[p.value().alias(p.measure.name) for p in partials])
        for measure in self._composed(measures):
            resolved = resolved.withColumn(measure.name, F.expr(measure.expr))
        result = resolved.select(*[col(d.name) for d in asked], *[col(m) for m in measures])
        if order_by:
            result = result.orderBy(*[col(n).desc() if way == "desc" else col(n).asc()
                                      for n, way in order_by])
        return result.limit(limit) if limit is not None else result

    @staticmethod
    def _project(rows: DataFrame, dims: Sequence[Dimension], joins: Sequence[Join],
                 partials: Sequence[_Partial]) -> DataFrame:
        """Source rows as local dimensions, join keys and mergeable measure inputs only."""
        local = [F.expr(d.expr).alias(d.name) for d in dims if d.join is None]
        keys = [F.expr(j.left_key).alias(f"__key_{j.name}") for j in joins if j.after is None]
        raw = rows.select(*local, *keys, *[p.raw() for p in partials])
        for p in partials:
            p.data_type = raw.schema[p.prefix].dataType
        return raw.select(*[col(d.name) for d in dims if d.join is None],
                          *[col(f"__key_{j.name}") for j in joins if j.after is None],
                          *[c for p in partials for c in p.inputs()])

    def _branch(self, tables: Mapping[str, DataFrame], join: Join, joins: Sequence[Join],
                dims: Sequence[Dimension]) -> DataFrame:
        """A joined table with all that hangs on it: its key and the dimensions asked for."""
        children = [j for j in joins if j.after == join.name]
        on = f"__on_{join.name}"
        rows = tables[join.name].select(
            F.expr(join.right_key).alias(on),
            *[F.expr(d.expr).alias(d.name) for d in dims if d.join == join.name],
            *[F.expr(j.left_key).alias(f"__key_{j.name}") for j in children])
        if not join.unique:
            rest = [c for c in rows.columns if c != on]
            one = F.max(F.struct(*[col(c) for c in rest])).alias("__one") if rest else None
            rows = (rows.groupBy(on).agg(one).select(on, *[
                F.col("__one").getField(c).alias(c) for c in rest]) if rest else rows.distinct())
        for child in children:
            right = self._branch(tables, child, joins, dims)
            if child.bounded and _is_small(tables[child.name]):
                right = F.broadcast(right)
            rows = rows.join(right, F.col(f"__key_{child.name}") == F.col(f"__on_{child.name}"),
                             "left").drop(f"__key_{child.name}", f"__on_{child.name}")
        return rows

    def repeated_keys(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Per join: how many right keys repeat, which a ``unique`` join must not have."""
        checks = []
        for join in self.joins:
            keys = tables[join.name].select(F.expr(join.right_key).alias("k")).where("k IS NOT NULL")
            counted = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            checks.append(counted.agg(F.lit(join.name).alias("join_name"),
                                      F.lit(join.unique).alias("declared_unique"),
                                      F.count_if(F.col("n") > 1).alias("repeated_keys")))
        schema = "join_name string, declared_unique boolean, repeated_keys bigint"
        if not checks:
            return next(iter(tables.values())).sparkSession.createDataFrame([], schema)
        out = checks[0]
        for check in checks[1:]:
            out = out.unionByName(check)
        return out

    def sanity(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Every measure over all rows: ``(measure, value, passed)``.

        A measure must be non-null and finite. Non-numeric measures pass when
        their text is not blank.
        """
        names = [m.name for m in self.measures]
        totals = self.query(tables, (), names)
        checks = []
        for f in totals.schema.fields:
            value = col(f.name)
            if isinstance(f.dataType, T.NumericType):
                number = value.cast("double")
                good = (number.isNotNull() & ~F.isnan(number)
                        & (F.abs(number) != F.lit(float("inf"))))
            else:
                number, good = F.lit(None).cast("double"), ~is_blank(value)
            checks.append(F.struct(F.lit(f.name).alias("measure"), number.alias("value"),
                                   F.coalesce(good, F.lit(False)).alias("passed")))
        return totals.select(F.inline(F.array(*checks)))

    def contract_errors(self, source: str, dimensions: Sequence[str],
                        measures: Sequence[str]) -> list[str]:
        """What a required definition asks for and this view does not have."""
        errors = []
        declared = {self.source, *[j.name for j in self.joins]}
        if source not in declared:
            errors.append(f"source {source} is not declared")
        have = {d.name for d in self.dimensions}
        errors += [f"dimension {d} is missing" for d in dimensions if d not in have]
        have = {m.name for m in self.measures}
        errors += [f"measure {m} is missing" for m in measures if m not in have]
        return errors


class _Partial:
    """One atomic measure as inputs, mergeable partial sums and a final value.

    A distinct count has no mergeable sum: its value column stays a grouping
    column until the last aggregation. A narrow decimal is summed in two bigint
    limbs, and put together after the last aggregation.
    """

    def __init__(self, measure: Measure, prefix: str):
        self.measure, self.prefix = measure, prefix
        self.data_type: T.DataType = T.LongType()  # set from the projected input

    @property
    def distinct_column(self) -> str | None:
        return self.prefix if self.measure.kind == "count_distinct" else None

    @property
    def _in_limbs(self) -> bool:
        return self.measure.kind in ("sum", "avg") and narrow_decimal(self.data_type)

    def raw(self) -> Column:
        if self.measure.kind == "count":
            return F.lit(1).cast("bigint").alias(self.prefix)
        return F.expr(self.measure.expr).alias(self.prefix)

    def inputs(self) -> list[Column]:
        p, value = self.prefix, F.col(self.prefix)
        if self._in_limbs:
            high, low = limbs(value, self.data_type)
            out = [high.alias(p), low.alias(p + "l")]
        else:
            out = [value]
        if self.measure.kind == "avg":
            out.append(F.when(value.isNotNull(), F.lit(1)).otherwise(0).cast("bigint").alias(p + "n"))
        return out

    def _merge(self) -> list[tuple[str, Callable[[str], Column]]]:
        kind, p = self.measure.kind, self.prefix
        if kind in ("min", "max"):
            return [(p, getattr(F, kind))]
        if kind == "count_distinct":
            return []
        return [(p, F.sum)] + [(p + "l", F.sum)] * self._in_limbs + [(p + "n", F.sum)] * (kind == "avg")

    def merges(self) -> list[Column]:
        return [how(p).alias(p) for p, how in self._merge()]

    def finals(self) -> list[Column]:
        if self.distinct_column:
            return [F.count_distinct(F.col(self.prefix)).alias(self.prefix)]
        return self.merges()

    def value(self) -> Column:
        kind, p = self.measure.kind, self.prefix
        value = F.col(p)
        if self._in_limbs:
            value = from_limbs(value, F.col(p + "l"), self.data_type.scale)
        if kind == "avg":
            return F.try_divide(value.cast("double"), F.col(p + "n"))
        return F.coalesce(value, F.lit(0)) if kind == "count" else value


def _is_small(df: DataFrame) -> bool:
    """Whether a table declared bounded has so few rows indeed; reads no more than these."""
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def _preaggregate(rows: DataFrame, partials: Sequence[_Partial]) -> DataFrame:
    merged = [c for p in partials for c in p.merges()]
    summed = {name for p in partials for name, _ in p._merge()}
    keys = [c for c in rows.columns if c not in summed]
    if not merged:
        return rows.select(*[col(k) for k in keys]).distinct()
    return rows.groupBy(*[col(k) for k in keys]).agg(*merged)


def _filter(rows: DataFrame, filters: Mapping[str, object],
            dims: Sequence[Dimension]) -> DataFrame:
    for dimension in dims:
        if dimension.name in filters:
            value = filters[dimension.name]
            allowed = value if isinstance(value, (list, tuple, set)) else [value]
            rows = rows.where(col(dimension.name).isin(*allowed))
    return rows
