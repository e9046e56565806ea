"""Row numbers over a whole table without one task that sees all rows.

Rows are dealt to tasks by ranges of the order and sorted there. A row's number is its place
in its task plus the rows of the tasks before; those offsets come from one count a task. The
sorted rows are written once, as a second evaluation could draw other ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import col
from tidemark.session import shared_dir

_SEQ = "__seq"
_PLACE = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[Column], name: str = "nth",
             group: Sequence[str] = (), start: str | None = None,
             stop: str | None = None) -> DataFrame:
    """``df`` with ``name``, each row's number from 0 in the given order, as ``ROW_NUMBER()``
    less one gives it, within its ``group`` if there is one. ``start`` and ``stop``, if named,
    are the numbers of the group's first row and of the row after its last in the order of
    (group, order) over the whole table.

    The order is ascending, nulls first. It has to tell rows apart where their numbers matter:
    rows that tie are numbered in any order, and lie in one task. Groups are null-safe and
    of any size: one that holds a third of all rows lies in a third of the tasks.
    """
    spark = df.sparkSession
    keys = [c.asc_nulls_first() for c in (*map(col, group), *order)]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "numbered")
    (df.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
     .withColumn(_SEQ, F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    part = F.shiftright(F.col(_SEQ), 33)
    # A row for each group and task it has rows in; tasks are as many as ranges.
    runs = rows.groupBy(part.alias("__part"), *[col(c) for c in group]).agg(
        F.min(_SEQ).alias("__low"), F.count("*").alias("__n"))
    tasks = runs.groupBy("__part").agg(F.sum("__n").alias("__of_task"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select(
        "__part",
        F.coalesce(F.sum("__of_task").over(before), F.lit(0)).alias("__offset"))
    runs = runs.join(offsets, "__part").withColumn(
        "__first", F.col("__offset") + F.col("__low").bitwiseAND(F.lit(_PLACE)))
    # A group has at most one run in each task, so its window is as long as there are ranges.
    whole = Window.partitionBy(*[col(c) for c in group] or [F.lit(0)])
    runs = runs.select("__part", "__offset", *[col(c).alias(f"__of_{c}") for c in group],
                       F.min("__first").over(whole).alias("__start"),
                       F.max(F.col("__first") + F.col("__n")).over(whole).alias("__stop"))
    same = part == F.col("__part")
    for c in group:
        same = same & col(c).eqNullSafe(col(f"__of_{c}"))
    found = rows.join(runs, same)
    number = F.col("__offset") + F.col(_SEQ).bitwiseAND(F.lit(_PLACE)) - F.col("__start")
    more = [F.col(at).alias(to) for at, to in (("__start", start), ("__stop", stop)) if to]
    return found.select(*[col(c) for c in df.columns], number.alias(name), *more)
