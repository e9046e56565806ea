"""Change logs: latest image per key, synthesis from a snapshot, round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col
from tidemark.operators.sequence import numbered
from tidemark.sources.files import (
    CHANGE_COLUMNS, CHANGE_LSN, CHANGE_ORDER, CHANGE_TIME, CHANGE_TYPE, CHANGE_XID,
    change_log, select_contract,
)

DELETE = "delete"
_IMAGE = "__image"
_TIE = "__tie"
_NUMBER = "__number"


def latest_images(log: DataFrame, keys: str | Sequence[str],
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest row of every key, deletes included.

    ``max_by`` combines on the map side, so a key that holds a third of the log
    sends one row per input split. Images are no fixed-width buffers, so this is a
    sort aggregation: a task sorts its split by key. Rows tied on ``_sort_by`` are
    ordered by ``tie_break`` or, without one, by a hash of the whole row image, so
    the winner depends neither on arrival order nor on later projections.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    images = [c for c in log.columns if c not in names]
    last = [col(c) for c in tie_break] if tie_break else [_image_hash(log, names)]
    order = F.struct(col(CHANGE_ORDER), *last)
    winners = log.groupBy(*[col(k) for k in names]).agg(
        F.max_by(F.struct(*[col(c) for c in images]), order).alias(_IMAGE))
    return winners.select(*[
        col(c) if c in names else F.col(_IMAGE)[c].alias(c) for c in log.columns])


def _image_hash(log: DataFrame, keys: Sequence[str]) -> Column:
    return F.xxhash64(*[col(f.name) for f in log.schema.fields
                        if f.name not in keys and _hashable(f.dataType)])


def _hashable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def is_live() -> Column:
    """Not deleted; an unknown change type counts as gone, as in SQL ``<>``."""
    return F.col(CHANGE_TYPE) != DELETE


def current_state(log: DataFrame, keys: str | Sequence[str],
                  columns: Sequence[str] | None = None,
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """Change log -> current rows: latest image, deletes removed, contract projected."""
    wanted = list(columns) if columns is not None else [
        c for c in log.columns if c not in CHANGE_COLUMNS]
    names = [keys] if isinstance(keys, str) else list(keys)
    change_log(log)
    if not tie_break:  # the hash of the image as it is, before columns are dropped
        log, tie_break = log.withColumn(_TIE, _image_hash(log, names)), (_TIE,)
    needed = dict.fromkeys([*names, *wanted, *tie_break, CHANGE_TYPE, CHANGE_ORDER])
    narrow = select_contract(log, list(needed), "change log")
    return select_contract(
        latest_images(narrow, names, tie_break).where(is_live()), wanted)


def synthesize_log(snapshot: DataFrame, sequence: Column | None = None,
                   change_time: Column | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Snapshot -> change log in which every row is an ``insert``.

    ``sequence`` supplies the log position; a column of the data keeps the log
    the same on every run and needs no ordering pass over the rows. Without one
    the position is the row's number, from 1, in the order of the columns ``order``,
    which no single task has to see (``operators.sequence``).
    """
    if sequence is None:
        if not order:
            raise ValueError("a log needs a sequence, or columns that order its rows")
        snapshot = numbered(snapshot, [col(c) for c in order], _NUMBER)
        sequence = F.col(_NUMBER) + 1
    position = sequence.cast("bigint")
    stamp = F.current_timestamp() if change_time is None else change_time
    return snapshot.select(
        *[col(c) for c in snapshot.columns if c != _NUMBER],
        F.lit("insert").alias(CHANGE_TYPE),
        position.alias(CHANGE_LSN),
        F.lit(None).cast("int").alias(CHANGE_XID),
        stamp.cast("timestamp_ntz").alias(CHANGE_TIME),
        position.alias(CHANGE_ORDER),
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows of the left side, and how many (with multiplicity) only one side has.

    Both sides are tagged and grouped once, where two ``exceptAll`` would
    shuffle everything twice.
    """
    columns = left.columns
    tagged = (left.select(*[col(c) for c in columns], F.lit(1).alias("__n"))
              .unionByName(right.select(*[col(c) for c in columns], F.lit(-1).alias("__n"))))
    balance = tagged.groupBy(*[col(c) for c in columns]).agg(
        F.sum("__n").alias("__n"), F.count_if(F.col("__n") > 0).alias("__left"))
    return balance.agg(
        F.coalesce(F.sum("__left"), F.lit(0)).alias("rows_compared"),
        F.coalesce(F.sum(F.greatest(F.col("__n"), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("__n"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
