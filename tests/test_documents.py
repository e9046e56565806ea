"""Documents: parse, classify, extract per class, route, and the silver gate."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import documents as ops
from tidemark.operators.documents import FieldRule, LabelProfile
from tidemark.plans import doc_contracts
from tidemark.plans.gates import bronze_documents_gate, silver_gate
from tidemark.sources import files


# -- parse -----------------------------------------------------------------------
@pytest.mark.parametrize("html, lines", [
    ("<p>one</p><p>two</p>", ["one", "two"]),
    ("<title>T &amp; U</title><h1>a<b>b</b>c</h1>", ["T & U", "abc"]),
    ("<script>var t='</p>';x()</script><p>seen</p><style>p{}</style>", ["seen"]),
    ("<!-- <p>no</p> --><div>yes<br>more</div>", ["yes", "more"]),
    ("<P CLASS='x'>Upper\n  Case</P>", ["Upper", "Case"]),
    ("&lt;p&gt; &quot;q&quot; &#39;s&#39;&nbsp;x", ["<p> \"q\" 's' x"]),
    ("a &amp;lt; b", ["a &lt; b"]),
    ("plain", ["plain"]),
])
def test_html_elements(spark, html, lines):
    got = spark.createDataFrame([(html,)], "html string").select(text.html_elements("html")).first()[0]
    assert got == lines


def test_parse_reports_errors_per_row(spark):
    pages = spark.createDataFrame(
        [(1, "<p>x</p>"), (2, None), (3, "  "), (4, "<script>x</script><br>")], "id int, html string")
    parsed = ops.parse_html(pages)
    status = {r.id: r.status for r in parsed.select("id", F.col("parsed.error_status").alias("status")).collect()}
    assert status == {1: None, 2: "no content", 3: "no content", 4: "no text"}
    assert sorted(r.id for r in ops.parse_failures(parsed).collect()) == [2, 3, 4]
    kept = ops.drop_failures(parsed).select("id", ops.parsed_text().alias("t")).collect()
    assert [tuple(r) for r in kept] == [(1, "x")]


def test_variant_form_gives_the_same_text_and_null_error(spark):
    rows = spark.createDataFrame([
        ('{"document": {"elements": [{"content": "a"}, {"content": "b"}]}, "error_status": null}',),
        ('{"document": {"elements": []}, "error_status": "broken"}',),
        ('{"document": {"elements": []}}',)], "raw string").select(F.parse_json("raw").alias("parsed"))
    got = rows.select(ops.variant_text().alias("t"), ops.variant_error().alias("e")).collect()
    assert [tuple(r) for r in got] == [("a\nb", None), ("", "broken"), ("", None)]


def test_binary_parser_hook_keeps_failures_as_rows(spark, tmp_path):
    for name, body in (("en/a.txt", b"one\ntwo"), ("fr/b.txt", b"\xff\xfe"), ("fr/c.txt", b"\n")):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(body)
    raw = files.binary_files(spark, str(tmp_path), "*.txt")
    bronze = files.bronze_documents(raw)
    assert bronze.columns == ["path", "filename", "source_class", "size_bytes",
                              "modification_time", "content", "ingested_at"]
    parsed = ops.parse_binary(bronze, lambda raw: raw.decode("utf-8").split())
    rows = {r.filename: r for r in parsed.select(
        "filename", "source_class", ops.parsed_text().alias("t"),
        F.col("parsed.error_status").alias("e")).collect()}
    assert (rows["a.txt"].t, rows["a.txt"].e, rows["a.txt"].source_class) == ("one\ntwo", None, "en")
    assert rows["b.txt"].e == "UnicodeDecodeError" and rows["c.txt"].e == "no text"


def test_listing_files_does_not_read_them(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"123")
    listed = files.binary_files(spark, str(tmp_path)).select("path", "length")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert listed.first().length == 3


# -- classify --------------------------------------------------------------------
PROFILES = (LabelProfile("a", ("red", "rot")), LabelProfile("b", ("blue",), 2))


@pytest.mark.parametrize("body, label", [
    ("red red red blue", "a"), ("Red, BLUE!", "b"), ("red red blue", "a"), ("nothing", "a"),
    ("", None), (None, None), ("redblue blue", "b"),
])
def test_classify_scores_whole_tokens_with_fixed_ties(spark, body, label):
    docs = spark.createDataFrame([(body,)], "parsed_text string")
    assert ops.classify(docs, PROFILES).first().doc_class == label


def test_classify_reads_the_whole_text(spark):
    docs = spark.createDataFrame([("red " + "x " * 200_000 + "blue blue",)], "parsed_text string")
    assert ops.classify(docs, PROFILES).first().doc_class == "b"


# -- extract ---------------------------------------------------------------------
INVOICE = """Vendor Invoice
Invoice Number: INV-1
Vendor Name: Acme
Invoice Date: 2026-01-31
Subtotal: $1,234.50
Tax Amount: 18%
Total Amount: about ten
Line Items: W-1 | Widget | 2 | $10.00 | 20
Line Items: W-2 | Gadget | x | 5 | 5
"""
ADVISORY = """CVE ID: CVE-2026-00001
Title: Overflow
CVSS Score: 9.8
References: https://a.example/1
References: https://a.example/2
"""


def extract(spark, rows, contracts):
    docs = spark.createDataFrame(
        [(f"/d/{i}", f"{i}", c, t) for i, (c, t) in enumerate(rows)],
        "path string, filename string, doc_class string, parsed_text string")
    return ops.extract(docs, contracts)


def test_extract_types_nested_fields_and_errors(spark):
    got = extract(spark, [("vendor_invoice", INVOICE)], doc_contracts.FINANCE)
    row = ops.class_table(got, "vendor_invoice").first()
    assert (row.invoice_number, row.vendor_name, row.invoice_date) == ("INV-1", "Acme", "2026-01-31")
    assert (row.subtotal, row.tax_amount, row.total_amount, row.currency) == (1234.5, 0.18, None, None)
    assert [tuple(i) for i in row.line_items] == [
        ("W-1", "Widget", 2.0, 10.0, 20.0), ("W-2", "Gadget", None, 5.0, 5.0)]
    assert row.extract_error == "invalid total_amount"


def test_extract_missing_required_and_unknown_class(spark):
    got = extract(spark, [("vendor_invoice", "nothing"), ("letter", "x"), (None, "x")],
                  doc_contracts.FINANCE).orderBy("path").collect()
    assert [r.extract_error for r in got] == ["missing invoice_number", "no contract", "no contract"]


def test_extract_lists_and_class_isolation(spark):
    got = extract(spark, [("cve_advisory", ADVISORY), ("pentest_report", "Engagement ID: E-1")],
                  doc_contracts.SECURITY)
    row = ops.class_table(got, "cve_advisory").first()
    assert (row.cve_id, row.cvss_score) == ("CVE-2026-00001", 9.8)
    assert row.references == ["https://a.example/1", "https://a.example/2"]
    assert row.extract_error is None
    assert got.where("doc_class = 'pentest_report' AND cve_advisory IS NOT NULL").count() == 0


def test_empty_class_has_a_table_with_its_columns(spark):
    got = extract(spark, [("cve_advisory", ADVISORY)], doc_contracts.SECURITY)
    table = ops.class_table(got, "cloud_posture_finding")
    assert table.count() == 0 and "remediation_guidance" in table.columns


def test_all_fifteen_contracts():
    sizes = {d: {c: len(f) for c, f in contracts.items()}
             for d, contracts in doc_contracts.CONTRACTS.items()}
    assert sizes == {
        "finance": {"vendor_invoice": 11, "purchase_order": 10,
                    "sales_contract_pricing_agreement": 9, "quarterly_financial_statement": 10,
                    "other": 8},
        "security": {"vulnerability_scan": 12, "cve_advisory": 11, "pentest_report": 9,
                     "cloud_posture_finding": 11, "other": 7},
        "itsm": {"incident_report": 7, "post_incident_review": 6, "change_request": 6,
                 "kb_article_sop": 5, "other": 4}}


@pytest.mark.parametrize("raw, value", [
    ("$1,234.50", 1234.5), ("18%", 0.18), ("-3", -3.0), ("USD 7", 7.0), ("x", None), ("", None)])
def test_to_number(spark, raw, value):
    got = spark.createDataFrame([(raw,)], "r string").select(text.to_number(F.col("r"))).first()[0]
    assert got == (pytest.approx(value) if value is not None else None)


@pytest.mark.parametrize("raw, ok", [("2026-02-28", True), ("2026-02-30", False),
                                     ("28.02.2026", False), ("2026-2-1", False)])
def test_to_iso_date(spark, raw, ok):
    got = spark.createDataFrame([(raw,)], "r string").select(text.to_iso_date(F.col("r"))).first()[0]
    assert (got is not None) == ok


def test_shared_patterns_are_searched_once(spark):
    rule = FieldRule("x", "a(b)")
    got = extract(spark, [("p", "ab"), ("q", "ab")], {"p": (rule,), "q": (rule,)})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
    assert got.where("p.x = 'b' OR q.x = 'b'").count() == 2


def test_route_counts_keep_empty_classes(spark):
    docs = spark.createDataFrame([("a",), ("a",), ("z",)], "doc_class string")
    labels = spark.createDataFrame([("a",), ("b",)], "label string")
    assert sorted(map(tuple, ops.route_counts(docs, labels).collect())) == [("a", 2), ("b", 0)]


# -- gates -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def silver_state(spark):
    shipped = [("a", "1"), ("a", "2"), ("b", "1")]
    expected = spark.createDataFrame(shipped, "source_class string, filename string")
    silver = spark.createDataFrame(
        [(f"/{c}/{n}", n, c, c, "text") for c, n in shipped],
        "path string, filename string, source_class string, doc_class string, parsed_text string")
    extracted = silver.select("path", "doc_class", F.lit(None).cast("string").alias("extract_error"))
    return dict(silver=silver, expected=expected, extracted=extracted, class_tables=2)


def failing(gate):
    rows = [r.stage for r in gate.collect() if r.verdict == "fail"]
    return rows[0] if rows else None


def silver_fails(state, **changes):
    return failing(silver_gate(**{**state, **changes}))


def test_silver_gate_passes(silver_state):
    assert silver_fails(silver_state) is None


def test_silver_gate_failures(spark, silver_state):
    silver, extracted = silver_state["silver"], silver_state["extracted"]
    first = F.col("path") == "/a/1"

    def change(df, column, value):
        return df.withColumn(column, F.when(first, value).otherwise(F.col(column)))

    assert silver_fails(silver_state, expected=silver_state["expected"].where("false")) == "expected"
    assert silver_fails(silver_state, silver=None) == "text"
    assert silver_fails(silver_state, silver=change(silver, "parsed_text", F.lit(" "))) == "text"
    assert silver_fails(silver_state, silver=change(
        silver, "doc_class", F.lit(None).cast("string"))) == "class"
    assert silver_fails(silver_state, silver=silver.union(silver.where(first))) == "duplicates"
    assert silver_fails(silver_state, silver=silver.where(~first)) == "identity"
    assert silver_fails(silver_state, silver=change(silver, "filename", F.lit("9"))) == "identity"
    assert silver_fails(silver_state, silver=change(silver, "doc_class", F.lit("x"))) == "labels"
    assert silver_fails(silver_state, extracted=None) == "class_tables"
    assert silver_fails(silver_state, class_tables=1) == "class_tables"
    assert silver_fails(silver_state, extracted=change(
        extracted, "extract_error", F.lit("bad"))) == "extract_errors"
    assert silver_fails(silver_state, extracted=extracted.union(
        extracted.where(first))) == "extract_duplicates"
    assert silver_fails(silver_state, extracted=extracted.where(~first)) == "extract_total"


def test_dropped_parse_failure_shows_as_missing(silver_state):
    rows = silver_gate(**{**silver_state, "silver": silver_state["silver"].where("path <> '/b/1'")})
    assert rows.where("stage = 'identity'").first().observed == 1


def test_bronze_documents_gate(spark, silver_state):
    docs = silver_state["expected"]
    assert failing(bronze_documents_gate(docs, docs, docs)) is None
    assert failing(bronze_documents_gate(docs.where("false"), docs, docs)) == "expected"
    assert failing(bronze_documents_gate(docs, docs.limit(1), docs)) == "landed"
    assert failing(bronze_documents_gate(docs, docs, None)) == "registered"
