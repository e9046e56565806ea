"""Sinks: overwrite, write-once materialisation, idempotent load, publishing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.columns import col, is_blank


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table with ``df``, schema included, and read it back.

    A second run leaves the same state. The new rows are written to a version folder of
    their own first; only then does the name move to them, so a write that fails leaves the
    old table as it was. While the schema stays the same the name moves in one catalog
    change and is never missing; a new schema drops the name and creates it again. ``path``
    names the (shared) folder that holds the table's versions, else they lie in the
    session's warehouse. The version that the name left is removed. A managed table of
    that name is replaced.
    """
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-versions"
    version = f"{base}/version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    before = _location(spark, name)
    ours = before is not None and f"{base.split(':')[-1].rstrip('/')}/version-" in before
    written = spark.read.parquet(version).schema
    if ours and spark.table(name).schema == written:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table's files stay
        spark.catalog.createTable(name, version, "parquet", df.schema)
    for old in _versions(base) - {version.rsplit("/", 1)[1]}:
        remove_folder(f"{base}/{old}")
    return spark.table(name)


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Location")


def _versions(base: str) -> set[str]:
    store, place = fs.FileSystem.from_uri(base)
    return {info.base_name for info in store.get_file_info(
        fs.FileSelector(place, allow_not_found=True)) if info.base_name.startswith("version-")}


def bucketed_table(df: DataFrame, name: str, key: str, path: str, buckets: int) -> DataFrame:
    """A catalog table whose rows lie in ``buckets`` files by the hash of ``key``, sorted by it.

    Tables with the same number of buckets join and aggregate by their key without an
    exchange: the rows were dealt once, when they were written. A key that holds a third of
    all rows makes one bucket that large, so such tables are joined unbucketed, where
    adaptive execution splits it. ``path`` is a new folder in shared storage.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # Dealt like the buckets, so a task writes one file for each of its buckets.
    (df.repartition(buckets, col(key)).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def remove_folder(path: str) -> None:
    """Remove a written folder that nothing reads any more; one that is gone is fine."""
    store, place = fs.FileSystem.from_uri(path)
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir(place)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run ``df`` once, into ``path``; later steps read the written rows.

    Losing an executor afterwards costs a re-read, not a recomputation.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """Write each row's ``content`` (text or bytes; null: an empty file) to the file ``path``
    below ``root``, and return path and length of what was written.

    A task writes its rows one by one, under hidden names that are moved into place, so
    readers see whole files; a task that runs again leaves the same files. ``root`` is
    shared storage that Arrow's file systems reach. The listing is a written table beside
    the files.
    """
    def run(batches):
        store, place = fs.FileSystem.from_uri(root)
        known: set[str] = set()
        for batch in batches:
            sizes = []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = raw.as_buffer() if raw.is_valid else b""
                target = f"{place}/{name.lstrip('/')}"
                folder, own = target.rsplit("/", 1)
                if folder not in known:
                    store.create_dir(folder)
                    known.add(folder)
                hidden = f"{folder}/.{own}.{uuid.uuid4().hex}"
                with store.open_output_stream(hidden, compression=None) as stream:
                    stream.write(data)
                store.move(hidden, target)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64())], names=["path", "length"])
    rows = df.select(col(path).cast("string").alias("path"), col(content).cast("binary").alias("content"))
    return materialize(rows.mapInArrow(run, "path string, length bigint"), f"{root}-listing")


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet.

    A target that is there and cannot be read is an error, not an empty one.
    """
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return spark.read.parquet(path)


@dataclass(frozen=True)
class LoadResult:
    action: str
    rows_before: int
    rows_after: int


def idempotent_load(source: DataFrame, path: str) -> LoadResult:
    """Load ``source`` into ``path`` unless it already holds as many rows.

    Same count: ``skip``. Another count above zero: ``reload``. Nothing there:
    ``load``. Counting parquet reads footers only.
    """
    spark = source.sparkSession
    expected = source.count()
    target = read_if_present(spark, path)
    before = target.count() if target is not None else 0
    if before == expected:
        return LoadResult("skip", before, before)
    source.write.mode("overwrite").parquet(path)
    return LoadResult("reload" if before else "load", before,
                      spark.read.parquet(path).count())


class PrimaryKeyError(ValueError):
    """A table to be served has blank or repeated primary keys."""


def publish_snapshot(df: DataFrame, key: Sequence[str], path: str,
                     source: str | None = None) -> DataFrame:
    """Publish a full serving copy below ``path`` and read it.

    The copy is written to a version folder of its own and its primary key is proven on the
    written rows; only then does one small pointer file name it. Readers follow the pointer
    (``served_copy``), so a copy that fails leaves the one before, and so does a publisher
    that dies. The version before the current one stays for readers that have begun; older
    ones and a refused one are removed. The proof reads only the key columns, so the mart
    itself is computed once. ``source`` names what is published. One publisher at a time.
    """
    version = f"version-{uuid.uuid4().hex}"
    served = materialize(df, f"{path}/{version}")
    violations = (served.groupBy(*[col(k) for k in key]).count()
                  .agg(F.count_if((F.col("count") > 1) | _any_blank(key)).alias("n"))
                  .first()["n"])
    if violations:
        remove_folder(f"{path}/{version}")
        raise PrimaryKeyError(f"{violations} key(s) of {list(key)} are blank or repeated")
    before = _pointers(path)
    number = before[-1][0] + 1 if before else 0
    _write_pointer(path, number, {"version": version, "source": source})
    for old, entry in before[:-1]:
        remove_folder(f"{path}/{entry['version']}")
        _remove_pointer(path, old)
    return served


def served_copy(spark: SparkSession, path: str) -> DataFrame | None:
    """The copy that is published below ``path``; None before the first."""
    known = _pointers(path)
    return spark.read.parquet(f"{path}/{known[-1][1]['version']}") if known else None


def published_source(spark: SparkSession, path: str) -> str | None:
    """What the copy below ``path`` was published from; None if that is not known."""
    known = _pointers(path)
    return known[-1][1]["source"] if known else None


_POINTERS = "_pointers"


def _pointers(path: str) -> list[tuple[int, dict]]:
    """Number and content of each pointer, in order. There are two at most, or three while
    a publisher tidies up."""
    store, place = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(f"{place}/{_POINTERS}", allow_not_found=True))
    out = []
    for info in found:
        if info.type == fs.FileType.File and info.base_name.isdigit():
            with store.open_input_stream(info.path) as stream:
                out.append((int(info.base_name), json.loads(stream.readall())))
    return sorted(out, key=lambda x: x[0])


def _write_pointer(path: str, number: int, entry: dict) -> None:
    """A pointer appears whole, under its final name, or not at all."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(f"{place}/{_POINTERS}")
    hidden = f"{place}/{_POINTERS}/.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as stream:
        stream.write(json.dumps(entry).encode())
    store.move(hidden, f"{place}/{_POINTERS}/{number:012d}")


def _remove_pointer(path: str, number: int) -> None:
    store, place = fs.FileSystem.from_uri(path)
    store.delete_file(f"{place}/{_POINTERS}/{number:012d}")


def _any_blank(key: Sequence[str]):
    blank = F.lit(False)
    for name in key:
        blank = blank | is_blank(name)
    return blank
