"""Ingest queries: scans, sinks, change data and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import path_class, path_filename, portable
from tidemark.operators import cdc, reconcile
from tidemark.plans import standins
from tidemark.plans.gates import bronze_documents_gate
from tidemark.session import shared_dir
from tidemark.sources import files, sinks
from tidemark.sources.tables import table
from tidemark.streaming.apply import ChangeTarget, apply_changes, file_stream
from tidemark.workload import base
from tidemark.workload.registry import register



# -- scans -----------------------------------------------------------------------
ROWS_A_FILE = 500  # bounds a file, which a binary scan reads whole


@register("scan_binary_files", """SELECT lang AS source_class, CAST(SUM(strlen(text) + 1) AS BIGINT) AS size_bytes,
  CAST(SUM(strlen(text) + 1) AS BIGINT) AS content_bytes,
  CAST(SUM(len(string_split(text, chr(10)))) AS BIGINT) AS lines, TRUE AS digests_differ
FROM documents GROUP BY lang""")
def scan_binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files in a folder per class, scanned with their bytes."""
    root = shared_dir(spark, "raw-files")
    for_class = standins.document_rows(spark, sf_dir).select("source_class", "parsed_text")
    for_class.write.option("maxRecordsPerFile", ROWS_A_FILE).partitionBy("source_class").text(root)
    bronze = files.bronze_documents(files.binary_files(spark, root, "*.txt"))
    return bronze.groupBy(
        F.element_at(F.split("source_class", "="), -1).alias("source_class")).agg(
        F.sum("size_bytes").alias("size_bytes"),
        F.sum(F.octet_length("content")).cast("bigint").alias("content_bytes"),
        F.sum(F.regexp_count(F.decode("content", "UTF-8"), F.lit("\n"))).cast("bigint")
        .alias("lines"),
        (F.count_distinct(F.sha2("content", 256)) == F.count_distinct("path"))
        .alias("digests_differ"))


@register("scan_snapshot", """SELECT p_partkey, p_name, p_brand, p_type,
  CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def scan_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(files.snapshot(spark, f"{sf_dir}/part.parquet"))


_MANIFEST = "file_path string, document_id bigint, expected_class string, n_chars bigint"


@register("scan_csv_manifest", """SELECT '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS file_path,
  doc_id AS document_id, lang AS expected_class, n_chars FROM documents""")
def scan_csv_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document manifest written as CSV and read back with a declared schema."""
    path = shared_dir(spark, "manifest-csv")
    standins.document_rows(spark, sf_dir).select(
        F.col("path").alias("file_path"), F.col("doc_id").alias("document_id"),
        F.col("source_class").alias("expected_class"), "n_chars",
    ).write.option("header", "true").csv(path)
    return files.csv_table(spark, path, _MANIFEST)


@register("path_parts", """SELECT '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
  CAST(doc_id AS VARCHAR) || '.txt' AS filename, lang AS source_class FROM documents""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.document_rows(spark, sf_dir).select(
        "path", path_filename("path").alias("filename"), path_class("path").alias("source_class"))


# -- sinks -----------------------------------------------------------------------
@register("roundtrip_overwrite", """SELECT o_orderstatus, COUNT(*) AS order_count,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY o_orderstatus""")
def roundtrip_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is written, overwritten with another schema, and overwritten again."""
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "overwrite")
    name = "tidemark_" + path.rsplit("-", 1)[-1]
    wide = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))
    sinks.overwrite_table(orders.select("o_orderkey"), name, path)
    sinks.overwrite_table(wide, name, path)
    written = sinks.overwrite_table(wide, name, path)
    return portable(written.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("o_totalprice").alias("total_price")))


@register("idempotent_load", """SELECT CAST(1 AS BIGINT) AS step, 'load' AS action, 0 AS rows_before, n AS rows_after
FROM (SELECT COUNT(*) AS n FROM nation) a
UNION ALL SELECT 2, 'skip', n, n FROM (SELECT COUNT(*) AS n FROM nation) a
UNION ALL SELECT 3, 'reload', a.n, b.n
FROM (SELECT COUNT(*) AS n FROM nation) a CROSS JOIN (SELECT COUNT(*) AS n FROM customer) b""")
def idempotent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "idempotent")
    small = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"))
    large = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    results = [sinks.idempotent_load(small, path), sinks.idempotent_load(small, path),
               sinks.idempotent_load(large, path)]
    return spark.createDataFrame(
        [(i, r.action, r.rows_before, r.rows_after) for i, r in enumerate(results, 1)],
        "step bigint, action string, rows_before bigint, rows_after bigint")


# -- change data -----------------------------------------------------------------
_STATE = ["user_id", "event_id", "event_type", "value", "props"]
_LIVE_SQL = base.with_ctes(
    "SELECT user_id, event_id, event_type, CAST(value AS DOUBLE) AS value, props FROM live", base.LOG)


@register("cdc_current_state", _LIVE_SQL)
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cdc.current_state(
        standins.change_events(spark, sf_dir), "user_id", _STATE, ["event_id"]))


@register("cdc_synthesize", """SELECT o_orderkey, o_custkey, o_orderstatus, 'insert' AS _pg_change_type,
  o_orderkey AS _pg_lsn, CAST(NULL AS BIGINT) AS _pg_xid,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS _timestamp, o_orderkey AS _sort_by FROM orders""")
def cdc_synthesize(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    log = cdc.synthesize_log(orders, F.col("o_orderkey"), F.col("o_orderdate"))
    return portable(log.select("o_orderkey", "o_custkey", "o_orderstatus", *files.CHANGE_COLUMNS))


@register("cdc_synthesize_numbered", """SELECT o_orderkey, o_custkey, n AS _pg_lsn, n AS _sort_by
FROM (SELECT o_orderkey, o_custkey,
        ROW_NUMBER() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS n FROM orders) AS numbered""")
def cdc_synthesize_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without a given sequence: rows are numbered in the order of their dates."""
    log = cdc.synthesize_log(table(spark, sf_dir, "orders"),
                             order=("o_orderdate", "o_custkey", "o_orderkey"))
    return log.select("o_orderkey", "o_custkey", files.CHANGE_LSN, files.CHANGE_ORDER)


@register("cdc_roundtrip", """SELECT CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right,
  COUNT(*) AS rows_compared FROM orders""")
def cdc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot -> log -> current state gives the snapshot back."""
    orders = table(spark, sf_dir, "orders")
    log = cdc.synthesize_log(orders, F.col("o_orderkey"))
    state = cdc.current_state(log, "o_orderkey", orders.columns, ["o_orderkey"])
    return cdc.row_differences(orders, state)


@register("cdc_stream_apply", _LIVE_SQL)
def cdc_stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives out of order in several micro-batches; the state is the same."""
    root = shared_dir(spark, "cdc-stream")
    log = standins.change_events(spark, sf_dir)
    log.repartition(6, F.xxhash64("event_id")).write.parquet(f"{root}/log")
    target = ChangeTarget(f"{root}/target", ("user_id",), log.schema, compact_every=4,
                          tie_break=("event_id",))
    stream = file_stream(spark, f"{root}/log", log.schema, max_files=1)
    apply_changes(stream, target, f"{root}/checkpoint").awaitTermination()
    return portable(target.current(spark, _STATE))


# -- manifests -------------------------------------------------------------------
@register("manifest_audit", """SELECT status, COUNT(*) AS artifacts
FROM (SELECT CASE WHEN l.digest IS NULL THEN 'unlisted' WHEN d.digest IS NULL THEN 'missing'
             WHEN d.digest <> l.digest THEN 'mismatch' ELSE 'ok' END AS status
      FROM (SELECT '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
                   sha256(text) AS digest FROM documents) d
      FULL JOIN (
        SELECT '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
               sha256(CASE WHEN toxic = 1 THEN lower(text) ELSE text END) AS digest
        FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT '/benchmark/' || CAST(item_id AS VARCHAR) || '.txt', sha256(text)
        FROM benchmark) l ON d.path = l.path) AS audited GROUP BY status""")
def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a checksum file that lists the labelled ones, toxic ones as they were
    before an edit, and benchmark items that never landed."""
    path = shared_dir(spark, "checksums")
    docs = standins.document_rows(spark, sf_dir).select(
        "doc_id", F.col("path").alias("relative_path"), F.sha2("parsed_text", 256).alias("digest"),
        F.sha2(F.lower("parsed_text"), 256).alias("older"))
    known = docs.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id").select(
        "relative_path", F.when(F.col("toxic") == 1, F.col("older")).otherwise(F.col("digest"))
        .alias("digest"))
    absent = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("/benchmark/"), F.col("item_id").cast("string"), F.lit(".txt"))
        .alias("relative_path"), F.sha2("text", 256).alias("digest"))
    listed = known.unionByName(absent)
    listed.select(F.concat_ws("  ", "digest", "relative_path").alias("value")).write.text(path)
    audit = reconcile.manifest_audit(
        docs, files.checksum_manifest(spark, path), "relative_path", "digest")
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("artifacts"))


@register("gate_bronze_docs", base.gate_sql(
    [("expected", "n > 0", "n", "1"), ("landed", "n > 0", "n", "n"), ("registered", "n > 0", "n", "n")],
    "m AS (SELECT COUNT(*) AS n FROM documents)"))
def gate_bronze_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are landed as files of rows, registered as a table, and counted."""
    root = shared_dir(spark, "bronze-docs")
    shipped = table(spark, sf_dir, "documents")
    landed = sinks.materialize(standins.document_rows(spark, sf_dir), f"{root}/landed",
                               ["source_class"])
    registered = sinks.materialize(landed.select("path", "filename", "source_class"),
                                   f"{root}/bronze")
    return bronze_documents_gate(shipped, landed, registered)


