"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target of words and a weight schedule over training time. The
schedule's integral, scaled to the source's target, is its cumulative demand: the
words it has given by time t. A source's documents stand one after another in a
stream, repeated when the target asks for more than there are; a document's place
in the stream, put through the inverse of the demand, is its training position.
Range-sorting by position gives the curriculum.

Null texts have size 0, are not taken and have no position. Documents of a source
are ordered by a hash of id and text, so reruns agree; rows that are equal in both
are taken as one row with their number. Null sources are one source, after all
others. Whole documents are taken: the last one of a stream is in if most of it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3
#: Weight over time for the sources of each weight in turn: knots of (time, weight),
#: joined by straight lines. The first kind fades out, the last one comes in late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.4), (0.5, 1.0), (1.0, 1.6)))
#: Slices of a source's hash order, whose sums are added up before their rows.
SLICE_BITS = 12

Schedule = Sequence[tuple[float, float]]


def words() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"),
                                     F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
            most: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``kind`` and ``target`` from rows (source, size).

    Sources in code-point order take the weights in turn and share the sum of all
    sizes. A target stops at ``most`` times its source's size; what is over goes to
    the others by weight. That level is found by ordering sources by how soon they
    fill up. The windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("kind", (F.row_number().over(order) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    cap = F.col("source_size") * float(most)
    per = per.select("source", "source_size", "kind", weight.alias("weight"), cap.alias("cap"))
    everything = Window.partitionBy()
    soon = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("cap").over(soon), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(soon), F.lit(0.0))
    level = ((F.sum("source_size").over(everything) - full)
             / (F.sum("weight").over(everything) - used))
    # The level is reached at the first source that it does not fill.
    full_at = F.col("cap") / F.col("weight")
    per = per.withColumn("level", level).withColumn(
        "fit", F.when(F.col("level") <= full_at, F.struct(full_at.alias("at"), "level")))
    reached = F.min("fit").over(everything)["level"]
    return per.withColumn("reached", reached).select(
        "source", "source_size", "kind",
        F.coalesce(F.least("cap", F.col("reached") * F.col("weight")), "cap").alias("target"))


def _areas(schedule: Schedule) -> list[float]:
    return [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]


def when_demanded(share: Column, schedule: Schedule) -> Column:
    """The time by which the schedule has asked for ``share`` of all it asks for."""
    areas = _areas(schedule)
    total, before, found = sum(areas), 0.0, F.lit(float(schedule[-1][0]))
    pieces = []
    for (t0, w0), (t1, w1), area in zip(schedule, schedule[1:], areas):
        slope = (w1 - w0) / (t1 - t0)
        left = F.greatest(F.lit(0.0), share * total - before)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + left * (2 * slope)))
        at = F.lit(t0) + F.when(left <= 0, F.lit(0.0)).otherwise(left * 2 / (root + w0))
        before += area
        pieces.append((before / total, F.least(at, F.lit(t1))))
    for upto, at in reversed(pieces):
        found = F.when(share <= upto, at).otherwise(found)
    return found


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS,
         schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """One row per document: ``doc_id``, ``mark`` (a hash of the text), ``source``, ``size``,
    ``source_size``, ``target``, ``times`` it is taken, ``taken`` words, and ``positions``."""
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    sized = stored(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), mark.alias("mark"),
        F.col("source").cast("string").alias("source"), words().alias("size"))
        .groupBy("doc_id", "mark", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    shares = stored(targets(sized.select("source", (F.col("size") * F.col("rows")).alias("size")),
                            weights, most), "targets")
    both = sized.join(shares.withColumnRenamed("source", "of"),
                      sized["source"].eqNullSafe(F.col("of"))).drop("of")
    order = F.xxhash64("doc_id", "mark", F.lit(11))
    weight = F.col("size") * F.col("rows")
    both = (both.withColumn("order", order)
            .withColumn("slice", F.shiftrightunsigned("order", 64 - SLICE_BITS)))
    sums = both.groupBy("source", "slice").agg(F.sum(weight).alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("slice").alias("at"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy(
        "order", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = (both.withColumn("within", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
              .join(sums, F.col("source").eqNullSafe(F.col("of"))
                    & (F.col("slice") == F.col("at"))))
    # Equal rows stand one after another in the stream.
    placed = placed.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                           F.col("rows") - 1)))
    start = F.col("base") + F.col("within") + F.col("nth") * F.col("size")
    rounds = F.greatest(F.lit(0), F.floor((F.col("target") - start - F.col("size") / 2)
                                          / F.col("source_size")) + 1)
    placed = placed.withColumn("start", start).withColumn(
        "times", F.when(F.col("size") == 0, F.lit(0)).otherwise(
            F.least(rounds, F.lit(most))).cast("int"))
    share = lambda i: F.least(F.lit(1.0), (
        F.col("start") + i * F.col("source_size") + F.col("size") / 2) / F.col("target"))
    positions = []
    for i in range(most):
        at = when_demanded(share(i), schedules[-1])
        for kind in range(len(schedules) - 1):
            at = F.when(F.col("kind") % len(schedules) == kind,
                        when_demanded(share(i), schedules[kind])).otherwise(at)
        positions.append(F.when(F.col("times") > i, at))
    return placed.select(
        "doc_id", "mark", "nth", "source", "size", "source_size", "target", "times",
        (F.col("size") * F.col("times")).alias("taken"),
        F.filter(F.array(*positions), lambda p: p.isNotNull()).alias("positions"))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """``plan`` in training order: range-sorted by the first position, untaken rows last."""
    planned = stored(plan(docs, **how), "mix")
    first = F.get("positions", F.lit(0))
    return planned.withColumn("position", first).orderBy(
        F.col("position").asc_nulls_last(), "doc_id", "mark", "nth")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """Whole rows of ``docs``, as often as the mix takes them, range-sorted by position."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Hashes are never null, so grouping and joining share one shuffle.
    own = lambda i, s: F.xxhash64(F.coalesce(i.cast("string"), F.lit("-")), s)
    rows = docs.select(
        own(F.col("doc_id").cast("bigint"), F.col("source").cast("string")).alias("own"),
        mark.alias("mark"), whole)
    planned = (plan(docs, **how).filter("times > 0")
               .groupBy(own(F.col("doc_id"), F.col("source")).alias("own"), "mark")
               .agg(F.flatten(F.array_sort(F.collect_list(F.struct("nth", "positions")))
                              ["positions"]).alias("positions")))
    # Equal rows take the places of all of them together; one of them carries these.
    one = rows.groupBy("own", "mark").agg(F.first("whole").alias("whole"))
    return (one.join(planned, ["own", "mark"])
            .select("whole", F.explode("positions").alias("position"))
            .repartitionByRange("position").sortWithinPartitions("position")
            .select("whole.*"))
