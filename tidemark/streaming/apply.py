"""Apply a stream of changes to a keyed table.

The target is kept as compacted deltas. Every micro-batch writes the newest row
per key of that batch to ``delta/batch=<id>``; reading merges deltas with the
latest base by ``_sort_by``. So a batch costs what the batch holds, not what the
target holds; deletes stay as tombstones; and an old event that arrives in a
later batch loses against the stored newer one. Every ``compact_every`` batches
the batch also folds all deltas into a new base.

All paths follow from the batch id alone and are written with overwrite, so a
batch that is replayed after a failure leaves the same files: exactly-once. When
its files are complete, a batch writes its id beside the target; readers go by
the largest id there, so an unfinished delta is not seen and no folder is listed.
A compaction then removes what the one before it has folded: states can be read
back to the last compaction but one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cdc import is_live, latest_images
from tidemark.sources.files import CHANGE_COLUMNS, change_log, select_contract
from tidemark.sources.sinks import read_if_present, remove_folder


@dataclass(frozen=True)
class ChangeTarget:
    """Where a keyed table's deltas and bases lie, and how rows are keyed."""

    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    compact_every: int = 16
    tie_break: tuple[str, ...] = ()

    def _delta(self, batch_id: int) -> str:
        return f"{self.path}/delta/batch={batch_id}"

    def _base(self, batch_id: int) -> str:
        return f"{self.path}/base/upto={batch_id}"

    def _base_upto(self, batch_id: int) -> int:
        """The last batch folded into a base when ``batch_id`` is committed; -1 for none."""
        return (batch_id + 1) // self.compact_every * self.compact_every - 1

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body; safe to repeat with the same ``batch_id``."""
        newest = latest_images(change_log(batch), list(self.keys), self.tie_break)
        newest.write.mode("overwrite").parquet(self._delta(batch_id))
        folded = self._base_upto(batch_id) == batch_id
        if folded:
            images = self._images(batch.sparkSession, batch_id, self._base_upto(batch_id - 1))
            images.write.mode("overwrite").parquet(self._base(batch_id))
        # Two places in turn: the id before stays readable while this one is written.
        batch.sparkSession.createDataFrame([(batch_id,)], "batch bigint").write.mode(
            "overwrite").parquet(self._head(batch_id))
        if folded:
            last = batch_id - self.compact_every
            for old in range(max(0, last - self.compact_every + 1), last + 1):
                remove_folder(self._delta(old))
            if last - self.compact_every >= 0:
                remove_folder(self._base(last - self.compact_every))

    def drop_folded(self, batch_id: int) -> None:
        """Remove what the compaction of batch ``batch_id`` has folded, before the next one would.
        States before that batch are gone then, and it must be complete."""
        last = batch_id - self.compact_every
        for old in range(last + 1, batch_id + 1):
            remove_folder(self._delta(old))
        if last >= 0:
            remove_folder(self._base(last))

    def _head(self, batch_id: int) -> str:
        return f"{self.path}/head-{batch_id % 2}"

    def _images(self, spark: SparkSession, batch_id: int, base: int) -> DataFrame:
        """Newest image per key from base ``base`` and the deltas after it."""
        parts = [self._delta(b) for b in range(base + 1, batch_id + 1)]
        if base >= 0:
            parts.append(self._base(base))
        reader = spark.read.schema(self.schema)
        if len(parts) == 1:  # each part has one row a key
            return reader.parquet(parts[0])
        frames = reduce(DataFrame.unionByName, [reader.parquet(p) for p in parts])
        return latest_images(frames, list(self.keys), self.tie_break)

    def last_batch(self, spark: SparkSession) -> int:
        """The last batch that was completed; -1 before the first."""
        heads = [h for i in (0, 1) if (h := read_if_present(spark, self._head(i))) is not None]
        rows = [r["batch"] for h in heads for r in h.collect()]
        return max(rows, default=-1)

    def images(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """Newest image per key, tombstones included, as of a batch (default: the last)."""
        at = self.last_batch(spark) if batch_id is None else batch_id
        if at < 0:
            return spark.createDataFrame([], self.schema)
        return self._images(spark, at, self._base_upto(at))

    def current(self, spark: SparkSession, columns: Sequence[str] | None = None,
                batch_id: int | None = None) -> DataFrame:
        """Live rows as of a batch (default: the last), without the change columns."""
        wanted = list(columns) if columns is not None else [
            c for c in self.schema.names if c not in CHANGE_COLUMNS]
        return select_contract(self.images(spark, batch_id).where(is_live()), wanted)


def apply_changes(stream: DataFrame, target: ChangeTarget, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Start applying ``stream`` to ``target``; by default all data there is, then stop."""
    return each_batch(stream, target.write_batch, checkpoint, trigger)


def each_batch(stream: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Start giving the batches of ``stream`` to ``body``, which may see one again."""
    return (stream.writeStream.foreachBatch(body)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
