"""Document jobs: parse, classify, extract and route, one pass each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col, is_blank
from tidemark.sources.sinks import read_if_present
from tidemark.functions.text import (
    html_elements, term_hits, to_iso_date, to_number, tokens,
)

PARSED_SCHEMA = "struct<document:struct<elements:array<struct<content:string>>>,error_status:string>"


# -- parse -----------------------------------------------------------------
def parse_html(pages: DataFrame, html: str = "html", parsed: str = "parsed") -> DataFrame:
    """Adds ``parsed``: the text elements of a page, or the reason there are none."""
    found = pages.withColumn("__elements", html_elements(html))
    elements = F.transform("__elements", lambda e: F.struct(e.alias("content")))
    status = (F.when(is_blank(html), "no content")
              .when(F.size("__elements") == 0, "no text"))
    return found.withColumn(parsed, F.struct(
        F.struct(elements.alias("elements")).alias("document"),
        status.alias("error_status"))).drop("__elements")


#: Bytes of file content that are parsed before what came of them is handed on.
PARSE_BYTES = 8 << 20


def parse_binary(files: DataFrame, parser: Callable[[bytes], Sequence[str]],
                 content: str = "content", parsed: str = "parsed",
                 most: int = PARSE_BYTES) -> DataFrame:
    """``parsed`` from file bytes by a supplied parser; ``content`` is left behind.

    The parser turns one file into its text elements; an exception becomes the
    row's ``error_status`` and never fails the job. Files reach Python in Arrow batches
    that the session bounds in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``), and
    a batch is parsed and handed on in parts of ``most`` bytes or one larger file, so
    memory does not follow the ten thousand rows that a batch may have.
    """
    names = [c for c in files.columns if c != content]
    schema = T.StructType([*(files.schema[c] for c in names),
                           T.StructField(parsed, T.DataType.fromDDL(PARSED_SCHEMA))])
    kind = pa.struct([
        ("document", pa.struct([("elements", pa.list_(pa.struct([("content", pa.string())])))])),
        ("error_status", pa.string())])

    def parse_one(raw: bytes | None) -> dict:
        elements, status = [], None
        try:
            elements = [{"content": text} for text in parser(raw)] if raw else []
            status = None if elements else ("no text" if raw else "no content")
        except Exception as error:  # the row reports it; the job goes on
            status = type(error).__name__
        return {"document": {"elements": elements}, "error_status": status}

    def run(batches):
        for batch in batches:
            raws = batch.column(content)
            begin, held = 0, 0
            for i in range(batch.num_rows):
                held += len(raws[i].as_buffer() or b"") if raws[i].is_valid else 0
                if held >= most or i == batch.num_rows - 1:
                    part = batch.slice(begin, i + 1 - begin)
                    done = [parse_one(raws[k].as_py()) for k in range(begin, i + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(n) for n in names), pa.array(done, kind)],
                        names=[*names, parsed])
                    begin, held = i + 1, 0
    return files.mapInArrow(run, schema)


def parsed_text(parsed: str = "parsed") -> Column:
    """The elements' text, one per line."""
    return F.concat_ws("\n", F.col(f"{parsed}.document.elements.content"))


def variant_text(parsed: str = "parsed") -> Column:
    """The same from a semi-structured (VARIANT) parse result."""
    elements = F.variant_get(col(parsed), "$.document.elements", "array<variant>")
    return F.concat_ws("\n", F.transform(
        elements, lambda e: F.variant_get(e, "$.content", "string")))


def variant_error(parsed: str = "parsed") -> Column:
    """Error status of a VARIANT parse; JSON null and a missing path are both NULL."""
    return F.try_variant_get(col(parsed), "$.error_status", "string")


def parse_failures(docs: DataFrame, parsed: str = "parsed") -> DataFrame:
    return docs.where(F.col(f"{parsed}.error_status").isNotNull())


def drop_failures(docs: DataFrame, parsed: str = "parsed") -> DataFrame:
    return docs.where(F.col(f"{parsed}.error_status").isNull())


# -- classify ----------------------------------------------------------------
@dataclass(frozen=True)
class LabelProfile:
    """A label and the terms that speak for it, by integer weight."""

    label: str
    terms: tuple[str, ...]
    weight: int = 1


def classify(docs: DataFrame, profiles: Sequence[LabelProfile], text: str = "parsed_text",
             output: str = "doc_class", fallback: str | None = None) -> DataFrame:
    """Adds exactly one label per document, from its whole text alone.

    The label with the highest weighted term count wins; a label may have several
    profiles, which add up. Ties go to the label that sorts first, so every run predicts
    the same. Blank text gets NULL, and text without any term ``fallback``, or without
    one the label that sorts first; without profiles all text gets ``fallback``.
    The text is split once, and only tokens that are a term are scored per label.
    """
    by_label: dict[str, list[LabelProfile]] = {}
    for profile in sorted(profiles, key=lambda p: p.label):
        by_label.setdefault(profile.label, []).append(profile)
    if not by_label:
        return docs.withColumn(output, F.when(~is_blank(text), F.lit(fallback).cast("string")))
    every_term = sorted({t for p in profiles for t in p.terms})
    scored = docs.withColumn("__tokens", tokens(text, every_term))
    candidates = F.array(*[
        F.struct(sum((term_hits(F.col("__tokens"), p.terms) * p.weight for p in of[1:]),
                     term_hits(F.col("__tokens"), of[0].terms) * of[0].weight).alias("score"),
                 F.lit(-i).alias("rank"), F.lit(label).alias("label"))
        for i, (label, of) in enumerate(by_label.items())])
    best = F.array_max(candidates)["label"]
    if fallback is not None:
        best = F.when(F.array_max(candidates)["score"] > 0, best).otherwise(F.lit(fallback))
    return scored.withColumn(output, F.when(~is_blank(text), best)).drop("__tokens")


# -- extract -----------------------------------------------------------------
@dataclass(frozen=True)
class FieldRule:
    """How one field is found in the text and which type it must have.

    ``kind``: string, number, integer, date or boolean; ``list`` gives all
    matches; ``records`` splits every match at ``|`` into typed ``parts``.
    ``needs`` is text that every match contains; documents without it are not
    searched, which spares them the far slower pattern. A rule with a ``label`` is
    looked up among the text's ``label: value`` lines instead, which are split once
    for all fields.
    """

    name: str
    pattern: str
    kind: str = "string"
    required: bool = False
    parts: tuple[tuple[str, str], ...] = ()
    needs: str = ""
    label: str = ""


def labelled(name: str, kind: str = "string", required: bool = False,
             parts: tuple[tuple[str, str], ...] = ()) -> FieldRule:
    """A field on a line of its own: ``Invoice Number: INV-1`` for invoice_number."""
    label = name.replace("_", " ")
    return FieldRule(name, rf"(?im)^[ \t]*{label}[ \t]*:[ \t]*([^\r\n]+)", kind, required, parts,
                     label=label)


def label_lines(text: str | Column) -> Column:
    """The text's ``label: value`` lines as (label in lower case, value), in order."""
    lines = F.filter(F.split(col(text), r"[\r\n]+"), lambda line: line.contains(":"))
    at = lambda line: F.instr(line, ":")
    pairs = F.transform(lines, lambda line: F.struct(
        F.lower(F.regexp_replace(F.substr(line, F.lit(1), at(line) - 1), r"^[ \t]+|[ \t]+$", ""))
        .alias("label"),
        F.trim(F.regexp_replace(F.substr(line, at(line) + 1), r"^[ \t]+", "")).alias("value")))
    return F.filter(pairs, lambda pair: pair["value"] != "")


def classify_by_fields(docs: DataFrame, contracts: Mapping[str, Sequence[FieldRule]],
                       labels: Sequence[str], text: str = "parsed_text",
                       output: str = "doc_class", fallback: str | None = "other") -> DataFrame:
    """Adds the label whose contract's field names the document has most of, by share.

    ``labels`` are those that occur in the data; one without a contract cannot win.
    Ties go to the label that sorts first, and a document without any field to
    ``fallback`` if that is a label, else it has none. Blank text gets NULL.
    """
    known = sorted(set(labels) & set(contracts))
    found = F.array_distinct(F.transform("__lines", lambda pair: pair["label"]))
    candidates = [F.struct(
        (F.size(F.array_intersect(found, F.array(*[F.lit(r.label) for r in contracts[name]])))
         / F.lit(float(len(contracts[name])))).alias("score"),
        F.lit(-i).alias("rank"), F.lit(name).alias("label")) for i, name in enumerate(known)]
    best = F.array_max(F.array(*candidates)) if candidates else F.lit(None).cast(
        "struct<score:double,rank:int,label:string>")
    other = F.lit(fallback if fallback in known else None).cast("string")
    return docs.withColumn("__lines", label_lines(text)).withColumn("__best", best).withColumn(
        output, F.when(~is_blank(text), F.when(F.col("__best.score") > 0, F.col("__best.label"))
                       .otherwise(other))).drop("__lines", "__best")


def parse_text(files: DataFrame, content: str = "content", parsed: str = "parsed") -> DataFrame:
    """Adds ``parsed`` for plain-text files: their non-blank lines, or why there are none."""
    lines = F.filter(F.split(F.decode(col(content), "UTF-8"), r"\r?\n"),
                     lambda line: F.trim(line) != "")
    found = files.withColumn("__lines", F.coalesce(lines, F.array().cast("array<string>")))
    status = (F.when(col(content).isNull() | (F.octet_length(col(content)) == 0), "no content")
              .when(F.size("__lines") == 0, "no text"))
    return found.withColumn(parsed, F.struct(
        F.struct(F.transform("__lines", lambda e: F.struct(e.alias("content"))).alias("elements"))
        .alias("document"), status.alias("error_status"))).drop("__lines")


def _typed(raw: Column, kind: str) -> Column:
    if kind == "number":
        return to_number(raw)
    if kind == "integer":
        return F.regexp_replace(raw, r"[, \t]", "").try_cast("bigint")
    if kind == "date":
        return to_iso_date(raw)
    if kind == "boolean":
        return F.lower(raw).try_cast("boolean")
    return raw


def _record(raw: Column, parts: Sequence[tuple[str, str]]) -> Column:
    pieces = F.split(raw, r"\|")
    return F.struct(*[
        _typed(F.nullif(F.trim(F.get(pieces, F.lit(i))), F.lit("")), kind).alias(name)
        for i, (name, kind) in enumerate(parts)])


def _search(text: Column, rule: FieldRule) -> Column:
    """What the rule's pattern finds in the text; empty when it finds nothing."""
    if rule.kind in ("list", "records"):
        return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(1))
    return F.trim(F.regexp_extract(text, rule.pattern, 1))


def _search_key(rule: FieldRule) -> tuple[str, bool, str]:
    """Rules that are alike in these find the same."""
    return rule.pattern, rule.kind in ("list", "records"), rule.needs


def _labelled(rule: FieldRule) -> Column:
    """The values on the lines with the rule's label, or the first of them."""
    values = F.transform(F.filter("__lines", lambda pair: pair["label"] == rule.label),
                         lambda pair: pair["value"])
    return values if rule.kind in ("list", "records") else F.get(values, F.lit(0))


def _found(raw: Column, rule: FieldRule) -> Column:
    """A search result; NULL instead of empty."""
    empty = F.size(raw) == 0 if rule.kind in ("list", "records") else raw == ""
    return F.when(~empty, raw)


def _value(raw: Column, rule: FieldRule) -> Column:
    if rule.kind == "records":
        return F.transform(raw, lambda r: _record(r, rule.parts))
    if rule.kind == "list":
        return F.transform(raw, lambda r: F.trim(r))
    return _typed(raw, rule.kind)


def _problem(raw: Column, value: Column, rule: FieldRule) -> Column | None:
    """Why the field is unusable; None for a rule that cannot go wrong."""
    problem = None
    if rule.kind not in ("string", "list", "records"):
        problem = F.when(raw.isNotNull() & value.isNull(), f"invalid {rule.name}")
    if rule.required:
        missing = F.when(raw.isNull(), f"missing {rule.name}")
        problem = missing if problem is None else F.coalesce(missing, problem)
    return problem


def extract(docs: DataFrame, contracts: Mapping[str, Sequence[FieldRule]],
            text: str = "parsed_text", doc_class: str = "doc_class",
            keep: Sequence[str] = ("path", "filename")) -> DataFrame:
    """All classes' fields in one pass over the documents.

    Each class has a struct column of its own, NULL for documents of another
    class. ``extract_error`` lists the fields that are present but not of their
    type, or required and absent; it is NULL on success. A document whose class
    has no contract gets ``no contract``.

    A pattern that several classes share is one expression, and it is searched
    only in documents of those classes.
    """
    users: dict[tuple[str, bool, str], list[str]] = {}
    sample: dict[tuple[str, bool, str], FieldRule] = {}
    for label, rules in contracts.items():
        for rule in rules:
            if not rule.label:
                users.setdefault(_search_key(rule), []).append(label)
                sample[_search_key(rule)] = rule
    lines = [label_lines(text).alias("__lines")] if any(
        r.label for rules in contracts.values() for r in rules) else []
    names = {key: f"__raw{i}" for i, key in enumerate(users)}
    found = docs.select(
        *[col(k) for k in keep], col(doc_class).alias("doc_class"), *lines,
        *[F.when(col(doc_class).isin(*users[key]) & col(text).contains(sample[key].needs),
                 _search(col(text), sample[key])).alias(name)
          for key, name in names.items()])

    structs, problems = [], []
    for label, rules in contracts.items():
        mine = F.col("doc_class") == label
        fields, wrong = [], []
        for rule in rules:
            raw = _found(_labelled(rule) if rule.label else F.col(names[_search_key(rule)]), rule)
            value = _value(raw, rule)
            fields.append(value.alias(rule.name))
            problem = _problem(raw, value, rule)
            wrong += [problem] if problem is not None else []
        structs.append(F.when(mine, F.struct(*fields)).alias(label))
        if wrong:
            problems.append(F.when(mine, F.nullif(F.concat_ws("; ", *wrong), F.lit(""))))
    known = F.coalesce(F.col("doc_class").isin(*contracts), F.lit(False))
    problems.append(F.when(~known, "no contract"))
    return found.select(*[col(k) for k in keep], "doc_class",
                        F.coalesce(*problems).alias("extract_error"), *structs)


def class_table(extracted: DataFrame, label: str) -> DataFrame:
    """One class's rows as a flat table; empty, with its columns, when it has none."""
    keep = [c for c in ("path", "filename", "doc_class", "extract_error")
            if c in extracted.columns]
    return (extracted.where(F.col("doc_class") == label)
            .select(*keep, f"`{label}`.*"))


def route_counts(docs: DataFrame, labels: DataFrame, doc_class: str = "doc_class",
                 label: str = "label") -> DataFrame:
    """Rows routed to every known label, empty ones included."""
    counted = docs.groupBy(col(doc_class).alias("label")).agg(
        F.count(F.lit(1)).alias("routed_rows"))
    names = labels.select(col(label).alias("label")).distinct()
    return names.join(counted, "label", "left").select(
        "label", F.coalesce("routed_rows", F.lit(0)).alias("routed_rows"))


def write_class_tables(extracted: DataFrame, path: str, labels: Sequence[str] = ()) -> None:
    """All class tables in one write: one folder per class below ``path``.

    Each of ``labels`` gets its table, an empty one if no document is of the class.
    """
    extracted.write.mode("overwrite").partitionBy("doc_class").parquet(path)
    spark = extracted.sparkSession
    schema = extracted.drop("doc_class").schema
    for label in labels:
        folder = f"{path}/doc_class={label}"
        if read_if_present(spark, folder) is None:
            spark.createDataFrame([], schema).write.parquet(folder)


def class_tables_written(spark, path: str, labels: Sequence[str]) -> int:
    """How many of the labels have a table below ``path``."""
    return sum(read_if_present(spark, f"{path}/doc_class={label}") is not None for label in labels)
