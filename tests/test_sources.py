"""Scans, contracts, sinks and publishing."""

import hashlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns
from tidemark.operators import integrity, reconcile
from tidemark.operators.cdc import synthesize_log
from tidemark.plans import txn_contracts
from tidemark.plans.gates import bronze_transactions_gate
from tidemark.session import shared_dir
from tidemark.sources import files, sinks
from tidemark.sources.files import ContractError


def test_csv_needs_its_declared_header(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("configuration_item,service,environment,owner_team,criticality\n"
                    "ci-1,mail,prod,ops,high\n")
    rows = files.csv_table(spark, str(path), txn_contracts.CONFIGURATION_ITEMS).collect()
    assert [tuple(r) for r in rows] == [("ci-1", "mail", "prod", "ops", "high")]
    with pytest.raises(Exception, match="header does not conform"):
        files.csv_table(spark, str(path), "other string, service string, environment string, "
                                          "owner_team string, criticality string").collect()


def test_csv_types_seed_rows_by_contract(spark, tmp_path):
    schema = txn_contracts.schema("itsm")
    path = tmp_path / "tickets.csv"
    path.write_text(",".join(schema.names) + "\n"
                    "T1,I1,P1,Open,G,S,C,2026-01-01T00:00:00Z,,4.5,true,c,r,2026-01-02\n")
    row = files.csv_table(spark, str(path), schema).first()
    assert (row.ticket_id, row.resolution_hours, row.sla_breached, row.resolved_at) == (
        "T1", 4.5, True, None)


def test_contract_projects_and_names_missing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert files.select_contract(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ContractError, match=r"\['x', 'y'\]"):
        files.select_contract(df, ["a", "y", "x"])


@pytest.mark.parametrize("domain, width", [("finance", 28), ("security", 26), ("itsm", 14)])
def test_transaction_contracts(spark, domain, width):
    schema = txn_contracts.schema(domain)
    assert len(schema) == width
    empty = spark.createDataFrame([], schema)
    assert txn_contracts.bronze(domain, empty.withColumn("extra", F.lit(1))).columns == schema.names
    rules = txn_contracts.constraints(domain)
    assert integrity.constraint_violations(empty, rules).count() == len(rules)
    with pytest.raises(ContractError):
        txn_contracts.bronze(domain, empty.drop(schema.names[0]))


def test_bronze_from_log_equals_bronze_from_snapshot(spark):
    schema = txn_contracts.schema("itsm")
    rows = [("T%d" % i, "I%d" % i, "P1", "Open", "G", "S", "C", "2026", None, float(i), True, "c",
             "r", "2026") for i in range(5)]
    snapshot = spark.createDataFrame(rows, schema)
    log = synthesize_log(snapshot, F.lit(1))
    got = txn_contracts.bronze("itsm", log)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, snapshot.collect()))


def test_finance_constraints_find_broken_rows(spark):
    schema = txn_contracts.schema("finance")
    base = {f.name: None for f in schema}
    good = dict(base, units=2, unit_price=D("10.00"), gross_sales=D("20.00"), discount_pct=D("0.1"),
                discount_amount=D("2.00"), net_sales=D("18.00"), cost_of_goods=D("8.00"),
                gross_margin=D("10.00"))
    bad = dict(good, units=0, discount_pct=D("1.5"), gross_margin=D("11.00"))
    df = spark.createDataFrame([tuple(good.values()), tuple(bad.values()), tuple(base.values())], schema)
    got = {r.constraint_name: r.violations for r in integrity.constraint_violations(
        df, txn_contracts.constraints("finance")).collect()}
    assert {k for k, v in got.items() if v} == {
        "units_positive", "discount_pct_in_range", "gross_is_units_times_price",
        "margin_is_net_less_cost"}


@pytest.mark.parametrize("score, band", [
    ("10.0", "Critical"), ("9.0", "Critical"), ("8.9", "High"), ("7.0", "High"), ("6.9", "Medium"),
    ("4.0", "Medium"), ("3.9", "Low"), ("0.0", "Low"), (None, None)])
def test_severity_bands(spark, score, band):
    df = spark.createDataFrame([(score,)], "s string").select(F.col("s").cast("decimal(3,1)").alias("s"))
    assert df.select(columns.severity_band("s")).first()[0] == band


def test_blank_and_names(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "v string")
    assert [r[0] for r in df.select(columns.is_blank("v")).collect()] == [True, True, True, False]
    names = spark.createDataFrame([(" net_sales_",), ("cve_id",)], "n string")
    assert [r[0] for r in names.select(columns.describe_identifier("n")).collect()] == [
        "Net sales", "Cve id"]
    ref = spark.createDataFrame([("`Cat`.\"S\" . 'T'",)], "n string")
    assert ref.select(columns.normalize_reference("n")).first()[0] == "cat.s.t"


def test_manifest_of_real_files(spark, tmp_path):
    root = tmp_path / "files"
    root.mkdir()
    lines = []
    for name, body in (("a.pdf", b"A"), ("b.pdf", b"B"), ("c.pdf", b"C")):
        (root / name).write_bytes(body)
        digest = hashlib.sha256(b"changed" if name == "b.pdf" else body).hexdigest()
        if name != "c.pdf":
            lines.append(f"{digest}  {name}")
    lines.append(f"{'0' * 64}  gone.pdf")
    (tmp_path / "checksums.sha256").write_text("\n".join(lines) + "\n")
    artifacts = files.binary_files(spark, str(root), "*.pdf").select(
        columns.path_filename("path").alias("relative_path"), F.sha2("content", 256).alias("digest"))
    manifest = files.checksum_manifest(spark, str(tmp_path / "checksums.sha256"))
    got = {r.relative_path: r.status for r in reconcile.manifest_audit(
        artifacts, manifest, "relative_path", "digest").collect()}
    assert got == {"a.pdf": "ok", "b.pdf": "mismatch", "c.pdf": "unlisted", "gone.pdf": "missing"}


# -- sinks -----------------------------------------------------------------------
def test_overwrite_replaces_schema_and_repeats(spark, tmp_path):
    one = spark.range(3).toDF("a")
    two = spark.range(5).selectExpr("id AS b", "'x' AS c")
    sinks.overwrite_table(one, "overwrite_me")
    for _ in range(2):
        got = sinks.overwrite_table(two, "overwrite_me")
        assert got.columns == ["b", "c"] and got.count() == 5
    placed = sinks.overwrite_table(two, "overwrite_there", str(tmp_path / "t"))
    assert placed.count() == 5 and (tmp_path / "t").exists()
    spark.sql("DROP TABLE overwrite_me")
    spark.sql("DROP TABLE overwrite_there")


def test_materialize_runs_once_and_keeps_partitions(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(10).withColumn("p", F.col("id") % 2).mapInPandas(run, "id bigint, p bigint")
    written = sinks.materialize(df, str(tmp_path / "m"), ["p"])
    assert written.count() == 10 and written.where("p = 1").count() == 5
    assert seen.value == 10


def test_idempotent_load_states(spark, tmp_path):
    path = str(tmp_path / "load")
    five, three = spark.range(5), spark.range(3)
    assert sinks.idempotent_load(five, path) == sinks.LoadResult("load", 0, 5)
    assert sinks.idempotent_load(five, path) == sinks.LoadResult("skip", 5, 5)
    assert sinks.idempotent_load(three, path) == sinks.LoadResult("reload", 5, 3)


def test_publish_proves_the_primary_key(spark, tmp_path):
    good = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert sinks.publish_snapshot(good, ["k"], str(tmp_path / "s")).count() == 2
    for i, rows in enumerate(([("a", 1), ("a", 2)], [("a", 1), (None, 2)], [("a", 1), (" ", 2)])):
        with pytest.raises(sinks.PrimaryKeyError):
            sinks.publish_snapshot(spark.createDataFrame(rows, "k string, v int"), ["k"],
                                   str(tmp_path / f"bad{i}"))


def test_bronze_transactions_gate(spark):
    def failing(gate):
        rows = [r.stage for r in gate.collect() if r.verdict == "fail"]
        return rows[0] if rows else None
    assert failing(bronze_transactions_gate(spark.range(3), spark.range(3))) is None
    assert failing(bronze_transactions_gate(spark.range(4), spark.range(3))) == "row_count"
    assert failing(bronze_transactions_gate(None, spark.range(3))) == "readable"


def test_shared_dir_lies_in_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one.startswith(base) and one != two
