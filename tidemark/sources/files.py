"""Scans: raw files, snapshots, CSV, change logs and serving copies."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import col, path_class, path_filename
from tidemark.session import shared_dir
from tidemark.sources.sinks import materialize

# The metadata columns a change log carries.
CHANGE_TYPE = "_pg_change_type"
CHANGE_LSN = "_pg_lsn"
CHANGE_XID = "_pg_xid"
CHANGE_TIME = "_timestamp"
CHANGE_ORDER = "_sort_by"
CHANGE_COLUMNS = (CHANGE_TYPE, CHANGE_LSN, CHANGE_XID, CHANGE_TIME, CHANGE_ORDER)
REQUIRED_CHANGE_COLUMNS = (CHANGE_TYPE, CHANGE_ORDER)


class ContractError(ValueError):
    """A source does not offer the columns its reader needs."""


def snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A committed snapshot directory."""
    return spark.read.format(fmt).load(path)


#: Files and bytes that one task reads, and bytes of contents that it holds at once.
FILES_A_TASK, BYTES_A_TASK, HELD_BYTES = 20_000, 64 << 20, 4 << 20
_LISTED = "path string, modificationTime timestamp, length bigint"


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per raw file below ``path``: path, modificationTime, length, content.

    Folders are listed by tasks (``listed_files``) and the files are dealt to tasks that read
    them, so the driver holds no file's name. Only a plan that asks for ``content`` reads
    file bytes; the listing columns come from file status alone. The files are those that lay
    there when this was called. A folder that only Spark's file systems reach, several
    folders (a pattern) and a single file go by Spark's own source, which lists in the driver.
    """
    found = listed_files(spark, path, glob)
    if found is None:
        return (spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", glob)
                .load(path))
    return _with_content(found.repartition(_tasks(spark, found)), path)


def _folder(path: str) -> tuple[str, str] | None:
    """A folder as Arrow's file systems name it and as Spark does; None if it is none, or
    only Spark reaches it."""
    if re.search(r"[*?\[{\\%]", path):
        return None
    try:
        store, place = fs.FileSystem.from_uri(path)
        if store.get_file_info(place).type != fs.FileType.Directory:
            return None
    except (pa.ArrowException, OSError):
        return None
    if isinstance(store, fs.LocalFileSystem):
        place = os.path.normpath(place)
        return place.rstrip("/"), f"file:{place.rstrip('/')}"
    return place.rstrip("/"), path.rstrip("/")


def _glob_pattern(glob: str) -> re.Pattern:
    """Hadoop's glob of a file name as a pattern of the whole name."""
    out, at, choices, listed = "", 0, 0, False
    while at < len(glob):
        c, at = glob[at], at + 1
        if c == "\\" and at < len(glob):
            out, at = out + re.escape(glob[at]), at + 1
        elif listed:
            listed = c != "]"
            out += "^" if c == "!" and out[-1] == "[" else "\\[" if c == "[" else c
        elif c in "*?":
            out += ".*" if c == "*" else "."
        elif c == "[":
            out, listed = out + c, True
        elif c in "{}":
            choices += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        else:
            out += "|" if c == "," and choices else re.escape(c)
    return re.compile(out, re.DOTALL)


def listed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame | None:
    """Path, modificationTime and length of the files below the folder ``path`` that Spark's
    file sources would read (no empty and no hidden ones), as a written table.

    A task lists whole folders, level by level, and holds no listing where the store gives
    one in pieces. None if there is no such folder, or only Spark reaches it.
    """
    if (known := _folder(path)) is None:
        return None
    place, named = known
    fits = _glob_pattern(glob).fullmatch

    def run(batches):
        store, _ = fs.FileSystem.from_uri(path)

        def inside(folder):
            if not isinstance(store, fs.LocalFileSystem):
                for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                    yield (info.base_name, info.type == fs.FileType.Directory, info.size or 0,
                           info.mtime_ns or 0)
                return
            with os.scandir(folder) as entries:
                for entry in entries:
                    try:
                        status = entry.stat()
                        yield entry.name, entry.is_dir(), status.st_size, status.st_mtime_ns
                    except FileNotFoundError:  # it went meanwhile
                        continue

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*found), kinds)] if found else
                [pa.array([], t) for t in kinds], names=["name", "folder", "length", "changed"])
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
        for batch in batches:
            found = []
            for folder in batch.column(0).to_pylist():
                for name, more, length, changed in inside(f"{place}{folder}" or "/"):
                    if (name.startswith(".") or name.startswith("_") and "=" not in name
                            or name.endswith("._COPYING_")):
                        continue
                    if more or length and fits(name):
                        # File status has milliseconds.
                        found.append((f"{folder}/{name}", more, length, changed // 10**6 * 1000))
                    if len(found) == 10_000:
                        yield rows(found)
                        found = []
            yield rows(found)
    schema = "name string, folder boolean, length bigint, changed bigint"
    root, levels, folders = shared_dir(spark, "listing"), [], 1
    level = spark.createDataFrame([("",)], "name string")
    while folders:
        tasks = min(folders, max(_cores(spark), folders // 1000))
        levels.append(f"{root}/{len(levels)}")
        level = materialize(level.repartition(tasks).mapInArrow(run, schema), levels[-1]).where(
            "folder").select("name")
        folders = level.count()
    return spark.read.schema(schema).parquet(*levels).where("NOT folder").select(
        F.concat(F.lit(named), "name").alias("path"),
        F.timestamp_micros("changed").alias("modificationTime"), "length")


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _tasks(spark: SparkSession, listed: DataFrame) -> int:
    """How many tasks read the files."""
    files, size = listed.agg(F.count("*"), F.sum("length")).first()
    return max(1, min(files, max(_cores(spark), files // FILES_A_TASK, (size or 0) // BYTES_A_TASK)))


def _with_content(listed: DataFrame, path: str) -> DataFrame:
    """Files that were listed below the folder ``path``, with their bytes."""
    place, named = _folder(path)

    @F.arrow_udf("binary")
    def content(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store, _ = fs.FileSystem.from_uri(path)
        for names in paths:
            held, size = [], 0
            for name in names.to_pylist():
                with store.open_input_file(f"{place}{name[len(named):]}") as file:
                    held.append(file.read())
                size += len(held[-1])
                if size >= HELD_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            yield pa.array(held, pa.binary())
    return listed.withColumn("content", content("path"))


#: What a binary scan gives, which a stream has to be told.
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_binary_files(spark: SparkSession, path: str, glob: str = "*",
                     max_files: int | None = None) -> DataFrame:
    """Raw files below ``path`` as a stream: each run of the stream takes the files that came
    since, ``max_files`` at a time.

    What came is found when this is called, so call it for each run. Tasks list the folder
    (``listed_files``), and files that are in no earlier listing are added to a written table
    beside it, ``_arrivals-<folder>-<glob>``, which is what the stream reads: its checkpoint
    remembers a few listings instead of every file. One caller at a time finds files; any
    number of streams may read them. A path that is no folder, or that only Spark reaches,
    goes by Spark's own source.
    """
    found = listed_files(spark, path, glob)
    if found is None:
        reader = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
                  .option("recursiveFileLookup", "true").option("pathGlobFilter", glob))
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(path)
    above, own = path.rstrip("/").rsplit("/", 1)
    arrivals = f"{above}/_arrivals-{own}-{zlib.crc32(glob.encode()):08x}"
    store, place = fs.FileSystem.from_uri(arrivals)
    store.create_dir(place)
    known = spark.read.schema(_LISTED).parquet(arrivals).select("path")
    new = found.join(known, "path", "left_anti").select(found.columns)
    if files := new.count():
        # With a bound, a listing holds as many files as a batch may take, and a batch takes one.
        new.repartition(max(1, files // FILES_A_TASK)).write.option(
            "maxRecordsPerFile", max_files or 0).mode("append").parquet(arrivals)
    reader = spark.readStream.schema(_LISTED)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", 1)
    return _with_content(reader.parquet(arrivals).repartition(_tasks(spark, found)), path)


def bronze_documents(files: DataFrame) -> DataFrame:
    """Raw files as document rows; the parent folder is the shipped class."""
    return files.select(
        "path",
        path_filename("path").alias("filename"),
        path_class("path").alias("source_class"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modification_time"),
        "content",
        F.current_timestamp().alias("ingested_at"),
    )


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed rows of CSV files with a header that must name the schema's columns."""
    return (spark.read.schema(schema).option("header", "true")
            .option("enforceSchema", "false").option("mode", "FAILFAST")
            .option("multiLine", "false").csv(path))


def checksum_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``<sha256>  <relative path>`` as (relative_path, digest)."""
    parts = F.split("value", "  ", 2)
    return spark.read.text(path).select(parts[1].alias("relative_path"),
                                        parts[0].alias("digest"))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "source") -> DataFrame:
    """``df`` itself, or an error that names every missing column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"{what} is missing expected columns: {missing}")
    return df


def select_contract(df: DataFrame, columns: Sequence[str], what: str = "source") -> DataFrame:
    """Exactly the contract's columns, in its order; extras are dropped."""
    return require_columns(df, columns, what).select(*[col(c) for c in columns])


def change_log(df: DataFrame) -> DataFrame:
    """A change log, after checking that it can be ordered and applied."""
    return require_columns(df, REQUIRED_CHANGE_COLUMNS, "change log")


def serving_rows(df: DataFrame, key: str | Sequence[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` served rows in key order (a top-k, not a full sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*[col(k) for k in keys]).limit(limit)
