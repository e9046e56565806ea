"""A mart that follows a change log of its facts.

Every batch turns into signed images: the stored image of each changed fact with minus one,
the image that holds after the batch with plus one. Rows whose business key moves subtract
from one key and add to another, deletes only subtract, and an event older than what is
stored changes nothing. From the signed images come two kinds of additive state:

* sums by business key: rows, counts and exact totals;
* multisets by business key and value, for what a sum cannot take back: the least, the
  largest and the number of different values.

A batch writes its own part of the state and nothing else; reading adds the parts up. Only
the touched keys are computed anew, from the state alone, and go to the served mart as a
change log of their own. So a batch costs what its facts and their keys hold. All paths
follow from the batch id: a batch that is replayed leaves the same files. What a batch has
folded goes when the next one begins, as it is not replayed from then on; its signed images
go with its end. So the stored facts can be read as of the last batch only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import col
from tidemark.operators.cdc import is_live, latest_images, synthesize_log
from tidemark.sources.files import CHANGE_COLUMNS, CHANGE_TYPE, ContractError, change_log
from tidemark.sources.sinks import materialize, remove_folder
from tidemark.streaming.apply import ChangeTarget

SUMMED = ("count", "total", "mean", "count_if")
KEPT = ("low", "high", "distinct")
_SIGN = "__sign"


@dataclass(frozen=True)
class Retractable:
    """A measure that can take rows back: ``count`` (of non-null values), ``total``, ``mean``,
    ``low``, ``high`` and ``distinct`` of a column, or ``count_if`` a flag column holds."""

    name: str
    kind: str
    column: str

    def __post_init__(self):
        if self.kind not in SUMMED + KEPT:
            raise ValueError(f"unknown kind of measure {self.kind!r}")


@dataclass(frozen=True)
class IncrementalMart:
    """Where the state lies, the keys and schema of the fact log, and what is measured."""

    path: str
    schema: T.StructType
    source_key: str
    group_key: str
    measures: tuple[Retractable, ...]
    compact_every: int = 16
    tie_break: tuple[str, ...] = ()
    facts: ChangeTarget = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "facts", ChangeTarget(
            f"{self.path}/facts", (self.source_key,), self.schema, self.compact_every,
            self.tie_break))
        for m in self.measures:
            kind = self.schema[m.column].dataType
            if m.kind in ("total", "mean") and isinstance(kind, (T.FloatType, T.DoubleType)):
                raise ContractError(f"{m.column} is a float: sums of floats cannot be taken back")

    # -- a batch -------------------------------------------------------------------
    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body; safe to repeat with the same ``batch_id``."""
        spark = batch.sparkSession
        self._drop_folded(batch_id)
        images = f"{self.path}/signed-{batch_id % 2}"
        signed = materialize(self._signed(change_log(batch), batch_id), images)
        self._write(self._sums(signed), "sums", batch_id)
        for name in self._kept():
            values = signed.groupBy(col(self.group_key), col(name)).agg(
                F.sum(_SIGN).alias("n")).where((F.col("n") != 0) & col(name).isNotNull())
            self._write(values, f"values-{name}", batch_id)
        touched = signed.select(col(self.group_key).alias("__key")).distinct()
        rows = self._rows(spark, batch_id, touched)
        log = synthesize_log(rows, F.lit(batch_id)).withColumn(
            CHANGE_TYPE, F.when(F.col("__rows") > 0, "update").otherwise("delete")).drop("__rows")
        self._served(log.schema).write_batch(log, batch_id)
        remove_folder(images)
        # The facts come last: until then their stored images are those before the batch.
        self.facts.write_batch(batch, batch_id)
        if self._folds(batch_id):
            self._fold(spark, batch_id)

    def _needed(self) -> list[str]:
        return list(dict.fromkeys([self.group_key, *[m.column for m in self.measures]]))

    def _kept(self) -> list[str]:
        return list(dict.fromkeys(m.column for m in self.measures if m.kind in KEPT))

    def _signed(self, batch: DataFrame, batch_id: int) -> DataFrame:
        keys = batch.select(col(self.source_key).alias("__source")).distinct()
        before = self.facts.images(batch.sparkSession, batch_id - 1)
        before = before.join(keys, col(self.source_key).eqNullSafe(F.col("__source")), "left_semi")
        newest = latest_images(before.unionByName(batch.select(*before.columns)),
                               self.source_key, self.tie_break)
        sides = [side.where(is_live()).select(*[col(c) for c in self._needed()],
                                              F.lit(sign).cast("bigint").alias(_SIGN))
                 for side, sign in ((before, -1), (newest, 1))]
        return sides[0].unionByName(sides[1])

    def _sums(self, signed: DataFrame) -> DataFrame:
        aggregates = [F.sum(_SIGN).alias("__rows")]
        for name in dict.fromkeys(m.column for m in self.measures if m.kind in SUMMED):
            value = col(name)
            aggregates.append(F.sum(F.when(value.isNotNull(), F.col(_SIGN)).otherwise(0))
                              .alias(f"count {name}"))
            kinds = {m.kind for m in self.measures if m.column == name}
            if kinds & {"total", "mean"}:
                aggregates.append(self._sum(name, F.when(F.col(_SIGN) > 0, value).otherwise(-value))
                                  .alias(f"sum {name}"))
            if "count_if" in kinds:
                aggregates.append(F.sum(F.when(value, F.col(_SIGN)).otherwise(0))
                                  .alias(f"true {name}"))
        return signed.groupBy(col(self.group_key)).agg(*aggregates)

    def _sum(self, name: str, value: Column) -> Column:
        kind = self.schema[name].dataType
        wide = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()
        return F.coalesce(F.sum(value).cast(wide), F.lit(0).cast(wide))

    # -- state ---------------------------------------------------------------------
    def _folds(self, batch_id: int) -> bool:
        return (batch_id + 1) % self.compact_every == 0

    def _write(self, part: DataFrame, name: str, batch_id: int) -> None:
        part.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")

    def _state(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """The parts of a state that hold after a batch."""
        base = (batch_id // self.compact_every) * self.compact_every - 1
        parts = [f"{self.path}/{name}/batch={b}" for b in range(base + 1, batch_id + 1)]
        if base >= 0:
            parts.append(f"{self.path}/{name}/upto={base}")
        return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in parts])

    def _added(self, state: DataFrame, keys: list[str]) -> DataFrame:
        sums = [c for c in state.columns if c not in keys]
        return state.groupBy(*[col(c) for c in keys]).agg(*[
            F.sum(col(c)).cast(state.schema[c].dataType).alias(c) for c in sums])

    def _fold(self, spark: SparkSession, batch_id: int) -> None:
        """Add all parts up into one."""
        names = {"sums": [self.group_key],
                 **{f"values-{c}": [self.group_key, c] for c in self._kept()}}
        for name, keys in names.items():
            whole = self._added(self._state(spark, name, batch_id), keys)
            alive = whole.where(F.col("n") != 0) if "n" in whole.columns else whole.where(
                reduce(lambda a, b: a | b, [col(c) != 0 for c in whole.columns if c not in keys]))
            alive.write.mode("overwrite").parquet(f"{self.path}/{name}/upto={batch_id}")

    def _drop_folded(self, batch_id: int) -> None:
        """Remove what the batch before this one, which is complete, has folded."""
        if not batch_id or not self._folds(batch_id - 1):
            return
        first = batch_id - self.compact_every
        for name in ("sums", *[f"values-{c}" for c in self._kept()]):
            for old in range(first, batch_id):
                remove_folder(f"{self.path}/{name}/batch={old}")
            if first:
                remove_folder(f"{self.path}/{name}/upto={first - 1}")
        self.facts.drop_folded(batch_id - 1)

    # -- rows ----------------------------------------------------------------------
    def _rows(self, spark: SparkSession, batch_id: int, touched: DataFrame | None) -> DataFrame:
        """The mart's rows of the touched keys, from the state; ``__rows`` is 0 for one that
        is gone."""
        def of_touched(state: DataFrame) -> DataFrame:
            if touched is None:
                return state
            return state.join(touched, col(self.group_key).eqNullSafe(F.col("__key")), "left_semi")
        found = self._added(of_touched(self._state(spark, "sums", batch_id)), [self.group_key])
        for name in self._kept():
            values = self._added(of_touched(self._state(spark, f"values-{name}", batch_id)),
                                 [self.group_key, name]).where("n > 0")
            of = values.groupBy(col(self.group_key).alias("__of")).agg(
                F.min(col(name)).alias(f"low {name}"), F.max(col(name)).alias(f"high {name}"),
                F.count("*").alias(f"distinct {name}"))
            found = found.join(of, col(self.group_key).eqNullSafe(F.col("__of")), "left").drop("__of")
        return found.select(col(self.group_key), *[self._measure(m).alias(m.name)
                                                   for m in self.measures], "__rows")

    def _measure(self, m: Retractable) -> Column:
        count, total = col(f"count {m.column}"), col(f"sum {m.column}")
        if m.kind == "count":
            return count
        if m.kind == "count_if":
            return col(f"true {m.column}")
        if m.kind == "total":
            return F.when(count > 0, total)
        if m.kind == "mean":
            return F.when(count > 0, total.cast("double") / count)
        if m.kind == "distinct":
            return F.coalesce(col(f"distinct {m.column}"), F.lit(0).cast("bigint"))
        return col(f"{m.kind} {m.column}")

    def _served(self, schema: T.StructType) -> ChangeTarget:
        return ChangeTarget(f"{self.path}/served", (self.group_key,), schema, self.compact_every,
                            (self.group_key,))

    def current(self, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
        """The served mart as of the last complete batch."""
        written = spark.read.parquet(f"{self.path}/served/delta").drop("batch").schema
        wanted = [c for c in written.names if c not in CHANGE_COLUMNS]
        return self._served(written).current(spark, columns or wanted)
