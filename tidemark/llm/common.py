"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Bytes of text worked on at once inside a task; one longer text is a part of its own.
PART_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs a re-read."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tidemark_tasks.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def map_batches(df: DataFrame, run, schema, holds: bool = False) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks. Unless the operator ``holds`` a
    value of its own, a worker lets go of what another one left there."""
    ship(df.sparkSession)

    def started(batches):
        if not holds:
            let_go()
        return run(batches)
    return df.mapInArrow(started, schema)


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of a table that may have any other columns."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def remainder(divisor: int) -> Column:
    """crc32 of the decimal ``doc_id``, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = PART_BYTES
          ) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes together."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    upto = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def map_texts(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]],
              column: str = "text", limit: int = PART_BYTES, holds: bool = False) -> DataFrame:
    """Apply a function of record batches to parts of bounded size.

    ``make`` runs once a task and returns the function, which gives a dictionary
    of the output columns, in the order of ``schema``.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    types = [(f.name, _arrow(f.dataType.simpleString())) for f in fields]

    def run(batches):
        work = make()
        for batch in batches:
            for part in parts(batch, column, limit):
                out = work(part)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := out[n], pa.Array) else pa.array(v, t)
                     for n, t in types], names=[n for n, _ in types])
    return map_batches(df, run, schema, holds)


_HELD: list[tuple] = []


def held_by_worker(key, build: Callable):
    """What ``build`` gives, for all tasks that a Python worker runs one after another. A
    worker holds one such value at a time, until a task of another operator begins."""
    if not _HELD or _HELD[0][0] != key:
        let_go()
        _HELD[:] = [(key, build())]
    return _HELD[0][1]


def let_go() -> None:
    _HELD[:] = []


def _arrow(name: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
             "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    if name.startswith("array<"):
        return pa.list_(plain[name[6:-1]])
    return plain[name]


def word_starts(counts: np.ndarray) -> np.ndarray:
    """Where each run of a concatenation begins."""
    return np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
