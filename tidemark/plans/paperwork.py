"""Documents of the domains' classes, written from the customers.

A customer's market segment decides the class, so each domain has a folder for
each of its five classes. A document is a title and ``Field Name: value`` lines.
Customers of nation 0 forgot the line of the required field, and those of nation 1
wrote no number where the first number should be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.documents import FieldRule
from tidemark.plans.doc_contracts import CONTRACTS
from tidemark.sources.files import binary_files, bronze_documents
from tidemark.sources.sinks import write_files
from tidemark.sources.tables import table

# The market segments, which stand for the classes in order of name.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ITEMS = 2  # lines of a list or of records


def class_of(domain: str) -> dict[str, str]:
    return dict(zip(SEGMENTS, sorted(CONTRACTS[domain])))


def first_number(rules) -> str | None:
    return next((r.name for r in rules if r.kind == "number"), None)


def _words(name: str) -> str:
    return name.replace("_", " ")


def _scalar(rule: FieldRule, first: str | None) -> Column:
    key = F.col("c_custkey").cast("string")
    if rule.kind == "number" and rule.name.endswith("_pct"):
        value = F.concat((F.col("c_custkey") % 30).cast("string"), F.lit("%"))
    elif rule.kind == "number":
        value = F.concat(F.lit("$"), F.format_number(F.col("c_acctbal").cast("decimal(12,2)"), 2))
    elif rule.name.endswith("_date"):
        value = F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey")).cast("string")
    elif rule.required:
        value = key
    else:
        value = F.concat(F.lit(_words(rule.name) + " "), key)
    if rule.name == first:
        value = F.when(F.col("c_nationkey") == 1, "not stated").otherwise(value)
    if rule.required:
        value = F.when(F.col("c_nationkey") != 0, value)
    return value


def _lines(rule: FieldRule, first: str | None) -> list[Column]:
    label = F.lit(_words(rule.name).title() + ": ")
    key = F.col("c_custkey").cast("string")
    if rule.kind == "list":
        return [F.concat(label, F.lit(_words(rule.name) + " "), key, F.lit(f"-{i}"))
                for i in range(ITEMS)]
    if rule.kind == "records":
        return [F.concat(label, F.concat_ws(" | ", *[
            (F.col("c_custkey") % 10 + i).cast("string") if kind == "number"
            else F.concat(F.lit(_words(part) + " "), key, F.lit(f"-{i}"))
            for part, kind in rule.parts])) for i in range(ITEMS)]
    return [F.concat(label, _scalar(rule, first))]


def landed_documents(spark: SparkSession, sf_dir: str, domain: str,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Path, filename, shipped class and content bytes of a domain's documents; ``keep``
    names columns of the customer that stay beside them."""
    classes = class_of(domain)
    text, folder = F.lit(None).cast("string"), F.lit(None).cast("string")
    for segment, name in classes.items():
        rules = CONTRACTS[domain][name]
        first = first_number(rules)
        body = F.concat_ws("\n", F.lit(_words(name).capitalize()),
                           *[line for r in rules for line in _lines(r, first)])
        mine = F.col("c_mktsegment") == segment
        text = F.when(mine, body).otherwise(text)
        folder = F.when(mine, name).otherwise(folder)
    filename = F.concat("c_name", F.lit(".txt"))
    # Texts are made, and files written, by as many tasks as there are cores, however few row
    # groups hold the customers.
    customers = table(spark, sf_dir, "customer").repartition(4 * spark.sparkContext.defaultParallelism)
    return customers.select(
        F.concat(F.lit(f"/{domain}/"), folder, F.lit("/"), filename).alias("path"),
        filename.alias("filename"), folder.alias("source_class"),
        F.encode(text, "UTF-8").alias("content"), *keep)


def write_documents(spark: SparkSession, sf_dir: str, domain: str, root: str) -> DataFrame:
    """A domain's documents as files ``<root>/<class>/<filename>``; returns their listing."""
    docs = landed_documents(spark, sf_dir, domain)
    return write_files(docs.withColumn("place", F.concat_ws("/", "source_class", "filename")),
                       root, "place")


def scanned_documents(spark: SparkSession, root: str, domain: str) -> DataFrame:
    """Documents of a domain as they are read from their files; paths are below the domain."""
    bronze = bronze_documents(binary_files(spark, root, "*.txt"))
    return bronze.withColumn("path", F.concat(
        F.lit(f"/{domain}/"), F.concat_ws("/", "source_class", "filename"))).select(
        "path", "filename", "source_class", "size_bytes", "content")
