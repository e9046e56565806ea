"""Faults found by review, each with the smallest case that showed it."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import html_elements, to_number
from tidemark.operators import cdc, documents as docs, serving
from tidemark.operators.documents import FieldRule
from tidemark.operators.semantic import (
    Dimension, Join, MetricView, MetricViewError, composed, count, total,
)
from tidemark.plans import standins
from tidemark.sources import sinks
from tidemark.streaming.apply import ChangeTarget
from tidemark.workload import QUERIES


def test_classes_that_share_a_pattern_keep_their_own_hint(spark):
    pattern = "code ([0-9]+)"
    contracts = {"a": (FieldRule("code", pattern, needs="alpha"),),
                 "b": (FieldRule("code", pattern, needs="beta"),)}
    rows = spark.createDataFrame([("p", "f", "code 7 alpha", "a"), ("q", "g", "code 8 beta", "b")],
                                 "path string, filename string, parsed_text string, doc_class string")
    got = {r.path: (r.a, r.b) for r in docs.extract(rows, contracts).collect()}
    assert got["p"][0].code == "7" and got["q"][1].code == "8"


def test_visible_text_between_angle_brackets_stays(spark):
    page = spark.createDataFrame([("<p>5 < 6 and 7 > 3 &mdash; &#38;amp;</p><!-- x --><b>y</b>",)],
                                 "html string")
    assert page.select(html_elements("html")).first()[0] == ["5 < 6 and 7 > 3 — &amp;", "y"]


@pytest.mark.parametrize("raw, number", [
    ("NaN", None), ("Infinity", None), ("-inf", None), ("1e3", 1000.0), ("$-1,234.50", -1234.5),
    ("18%", 0.18), ("1.2.3", None), ("", None)])
def test_only_numbers_are_numbers(spark, raw, number):
    assert spark.range(1).select(to_number(F.lit(raw))).first()[0] == number


def test_lines_are_looked_up_by_label(spark):
    text = "Invoice Number: 7: 8\r\n  VENDOR NAME :  x \nDue Date:\nDue Date: 2024-01-02\nno label"
    rules = {"c": (docs.labelled("invoice_number"), docs.labelled("vendor_name"),
                   docs.labelled("due_date"), docs.labelled("absent", required=True),
                   docs.labelled("invoice_number", "list"))}
    rows = spark.createDataFrame([("p", "f", text, "c")],
                                 "path string, filename string, parsed_text string, doc_class string")
    got = docs.extract(rows, {"c": rules["c"][:4]}).first()
    assert tuple(got.c) == ("7: 8", "x", "2024-01-02", None)
    assert got.extract_error == "missing absent"


def test_documents_without_evidence_are_other(spark):
    contracts = {"invoice": (docs.labelled("invoice_number"), docs.labelled("due_date")),
                 "other": (docs.labelled("subject"),)}
    rows = spark.createDataFrame(
        [(1, "Invoice Number: 1"), (2, "nothing here"), (3, " "), (4, None), (5, "Subject: s"),
         (6, "Subject: s\nInvoice number: 1\nDue date: 2")], "id int, parsed_text string")
    both = docs.classify_by_fields(rows, contracts, ["invoice", "other", "unknown"])
    assert {r.id: r.doc_class for r in both.collect()} == {
        1: "invoice", 2: "other", 3: None, 4: None, 5: "other", 6: "invoice"}
    alone = docs.classify_by_fields(rows, contracts, ["invoice"])
    assert {r.id: r.doc_class for r in alone.collect()}[2] is None


def test_plain_text_parse_outcomes(spark):
    rows = spark.createDataFrame([(1, bytearray(b"a\r\n\n b ")), (2, bytearray(b"")), (3, None),
                                  (4, bytearray(b" \n "))], "id int, content binary")
    got = {r.id: (r.t, r.s) for r in docs.parse_text(rows).select(
        "id", docs.parsed_text().alias("t"), F.col("parsed.error_status").alias("s")).collect()}
    assert got == {1: ("a\n b ", None), 2: ("", "no content"), 3: ("", "no content"),
                   4: ("", "no text")}


def test_an_empty_class_has_a_table(spark, tmp_path):
    rows = spark.createDataFrame([("p", "f", "Subject: s", "other")],
                                 "path string, filename string, parsed_text string, doc_class string")
    extracted = docs.extract(rows, {"other": (docs.labelled("subject"),),
                                    "memo": (docs.labelled("author"),)})
    docs.write_class_tables(extracted, f"{tmp_path}/c", ["memo", "other"])
    assert docs.class_tables_written(spark, f"{tmp_path}/c", ["memo", "other", "lost"]) == 2
    assert spark.read.schema(extracted.schema).parquet(f"{tmp_path}/c/doc_class=memo").count() == 0


LOG = ("k string, a string, b string, _pg_change_type string, _sort_by bigint")


def test_ties_do_not_depend_on_the_projection(spark):
    log = spark.createDataFrame([("x", f"a{i}", f"b{i}", "update", 5) for i in range(9)], LOG)
    narrow = cdc.current_state(log, "k", ["k", "a"]).first()
    wide = cdc.current_state(log, "k", ["k", "a", "b"]).first()
    assert narrow.a == wide.a and wide.b == "b" + wide.a[1:]


def batch(spark, n):
    return spark.createDataFrame([("x", f"a{n}", "", "update", n), (f"k{n}", "", "", "insert", n)],
                                 LOG)


def test_folded_batches_go_and_replays_change_nothing(spark, tmp_path):
    target = ChangeTarget(f"{tmp_path}/t", ("k",), batch(spark, 0).schema, compact_every=2)
    for n in range(8):
        target.write_batch(batch(spark, n), n)
        target.write_batch(batch(spark, n), n)  # again, also after a compaction
        assert target.last_batch(spark) == n
        rows = {r.k: r.a for r in target.current(spark).collect()}
        assert rows["x"] == f"a{n}" and len(rows) == n + 2
    left = sorted(p.name for p in (tmp_path / "t" / "delta").iterdir() if p.is_dir())
    assert left == ["batch=6", "batch=7"]
    assert [p.name for p in (tmp_path / "t" / "base").iterdir()] and not (
        tmp_path / "t" / "base" / "upto=1").exists()


def test_an_unfinished_delta_is_not_seen(spark, tmp_path):
    target = ChangeTarget(f"{tmp_path}/t", ("k",), batch(spark, 0).schema)
    target.write_batch(batch(spark, 0), 0)
    batch(spark, 1).write.parquet(f"{tmp_path}/t/delta/batch=1")  # its writer died here
    assert target.last_batch(spark) == 0
    assert {r.k for r in target.current(spark).collect()} == {"x", "k0"}


def test_overwrite_replaces_the_schema_and_survives_a_failed_write(spark, tmp_path):
    name, path = "round_two_overwrite", f"{tmp_path}/table"
    sinks.overwrite_table(spark.range(3), name, path)
    out = sinks.overwrite_table(spark.range(2).selectExpr("id AS a", "'x' AS b"), name, path)
    assert out.columns == ["a", "b"] and spark.table(name).count() == 2
    assert len(list((tmp_path / "table").iterdir())) == 1  # the version before is gone
    broken = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("z"))
    with pytest.raises(Exception):
        sinks.overwrite_table(broken, name, path)
    assert spark.table(name).columns == ["a", "b"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
    managed = sinks.overwrite_table(spark.range(4), name)
    assert managed.count() == 4 and sinks.overwrite_table(spark.range(5), name).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_an_unreadable_target_is_not_an_empty_one(spark, tmp_path):
    assert sinks.read_if_present(spark, f"{tmp_path}/none") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        sinks.read_if_present(spark, f"{tmp_path}/bad").count()
    with pytest.raises(Exception):
        sinks.idempotent_load(spark.range(1), f"{tmp_path}/bad")


def view(*joins, measures=None):
    return MetricView("v", "fact", (Dimension("Name", "name", "d"),),
                      measures or (count("N"), total("S", "x")), joins)


def test_composed_of_composed(spark):
    one = composed("R", "`S` / `N`", "S", "N")
    two = composed("R2", "`R` * 2", "R")
    tables = {"fact": spark.createDataFrame([(1, 4.0), (1, 8.0)], "k int, x double")}
    v = view(measures=(count("N"), total("S", "x"), two, one), *(Join("d", "k", "k"),))
    assert v.query(tables, (), ["R2"]).first().R2 == 12.0
    assert v.query(tables, (), ["R2", "R"]).first().R == 6.0
    with pytest.raises(MetricViewError):
        view(Join("d", "k", "k"), measures=(composed("A", "`B`", "B"), composed("B", "`A`", "A")))


def test_repeated_right_keys_do_not_change_totals(spark):
    tables = {"fact": spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 4.0)], "k int, x double"),
              "d": spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, name string")}
    v = view(Join("d", "k", "k"))
    assert {(r.Name, r.N, r.S) for r in v.query(tables, ["Name"], ["N", "S"]).collect()} == {
        ("b", 2, 3.0), (None, 1, 4.0)}
    proof = view(Join("d", "k", "k", unique=True)).repeated_keys(tables).first()
    assert tuple(proof) == ("d", True, 1)


def test_category_is_counted_exactly(spark):
    rows = [(f"c{i % 26}", f"d{i % 25}", None, "one") for i in range(500)]
    df = spark.createDataFrame(rows, "wide string, fits string, none string, same string")
    assert serving.category_column(df) == "fits"
    assert serving.category_column(df, ["wide", "same", "none"]) is None


def test_served_money_is_the_sources_money(spark, sf_dir):
    served = QUERIES["serving_snapshot"](spark, sf_dir).agg(F.sum("net_sales")).first()[0]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wanted = lines.agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).first()[0]
    assert served == pytest.approx(wanted, rel=1e-9)
    assert standins.sales_lines(spark, sf_dir).schema["net_sales"].dataType.simpleString() == \
        "decimal(15,4)"


def test_sales_metrics_shuffle_the_lines_once_per_branch(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["metric_sales_all"](spark, sf_dir)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = plan.count("Exchange hashpartitioning")
    assert exchanges <= 7, plan


def test_the_gate_asks_where_a_copy_came_from(spark, tmp_path):
    from tidemark.plans.gates import serving_gate
    mart = spark.range(3).selectExpr("cast(id AS string) AS k", "id AS v")
    served = sinks.publish_snapshot(mart, ["k"], f"{tmp_path}/served", "mart-a")
    parity = serving.serving_parity(mart, served, "k")
    source = sinks.published_source(spark, f"{tmp_path}/served")
    for wanted, verdict in (("mart-a", "pass"), ("mart-b", "fail")):
        stages = serving_gate(parity, source == wanted).orderBy("stage_no").collect()
        assert (stages[0].stage, stages[0].verdict) == ("source", verdict)
    assert sinks.published_source(spark, f"{tmp_path}/none") is None
