"""Class profiles learned from documents that came with a class.

A term speaks for a class if it is in a larger share of the class's documents than of the
others'. The counts are one pass over the documents (terms of a document once, added up
inside tasks before the shuffle); what comes back is bounded by classes and terms a class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import col, is_blank
from tidemark.operators.documents import LabelProfile

#: Terms kept for each class, and the largest weight of one.
TERMS = 64
MOST = 10
#: Classes beyond this are refused: the profiles become part of every task's plan.
CLASSES = 1000
#: Groups in which a class's terms compete before the best of all are taken.
HEATS = 64


def term_counts(docs: DataFrame, label: str = "source_class", text: str = "parsed_text") -> DataFrame:
    """``label``, ``term`` and ``docs``: how many of the class's documents hold the term. The
    empty term stands for the documents themselves."""
    words = F.filter(F.split(F.lower(col(text)), r"[^\p{L}]+"), lambda t: t != "")
    return (docs.where(col(label).isNotNull() & ~is_blank(text))
            .select(col(label).alias("label"),
                    F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words))).alias("term"))
            .groupBy("label", "term").agg(F.count("*").alias("docs")))


def learn_profiles(docs: DataFrame, label: str = "source_class", text: str = "parsed_text",
                   terms: int = TERMS) -> DataFrame:
    """``label``, ``term`` and ``weight`` of the terms that tell the classes of ``docs`` apart.

    With n of N documents of the class and m of M others, the smoothed odds ratio is
    ((n + 1) / (N + 2)) / ((m + 1) / (M + 2)); the weight is the whole number of times it
    doubles, at most ``MOST``. Of each class the ``terms`` terms with the largest n * weight
    are kept, ties in order of the term. A class that holds most documents costs no task
    more than others: counts are combined early and the best terms found in heats.
    """
    counts = term_counts(docs, label, text)
    # A row for each class, so this window is short.
    whole = counts.where("term = ''").select(
        "label", F.col("docs").alias("size"),
        F.sum("docs").over(Window.partitionBy(F.lit(0))).alias("total"))
    known = counts.where("term <> ''")
    everywhere = known.groupBy("term").agg(F.sum("docs").alias("everywhere"))
    # Both sides are keyed by few classes or by terms; adaptive execution picks the join.
    placed = known.join(everywhere, "term").join(whole, "label")
    inside = (F.col("docs") + 1).cast("double") * (F.col("total") - F.col("size") + 2)
    outside = (F.col("everywhere") - F.col("docs") + 1).cast("double") * (F.col("size") + 2)
    weight = sum((F.when(inside >= outside * float(2 ** i), 1).otherwise(0)
                  for i in range(1, MOST + 1)), F.lit(0))
    rated = placed.select("label", "term", "docs", weight.cast("bigint").alias("weight")).where(
        "weight > 0")
    best = [(F.col("docs") * F.col("weight")).desc(), "term"]
    heat = F.pmod(F.xxhash64("term"), F.lit(HEATS))
    heats = rated.withColumn("nth", F.row_number().over(
        Window.partitionBy("label", heat).orderBy(*best))).where(F.col("nth") <= terms)
    return heats.withColumn("nth", F.row_number().over(
        Window.partitionBy("label").orderBy(*best))).where(F.col("nth") <= terms).select(
        "label", "term", "weight")


def collected(profiles: DataFrame) -> list[LabelProfile]:
    """Learned profiles as the classifier takes them: a class's terms of each weight."""
    labels = profiles.select("label").distinct().limit(CLASSES + 1).count()
    if labels > CLASSES:
        raise ValueError(f"more than {CLASSES} classes; learn from folders, not from keys")
    found: dict[tuple[str, int], list[str]] = {}
    for row in profiles.orderBy("label", "weight", "term").collect():
        found.setdefault((row["label"], row["weight"]), []).append(row["term"])
    return [LabelProfile(label, tuple(terms), weight)
            for (label, weight), terms in found.items()]


def most_frequent(docs: DataFrame, label: str = "source_class") -> str | None:
    """The class with most documents, the first by name among equals."""
    first = (docs.where(col(label).isNotNull()).groupBy(col(label).alias("label"))
             .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").first())
    return first["label"] if first else None
