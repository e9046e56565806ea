"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "tidemark", cpus: str | int = "*",
                  shuffle_partitions: int = 8, memory: str = "8g",
                  **conf: str) -> SparkSession:
    """A local session for tests and the benchmark.

    On a cluster the submitter's session is used as it is: nothing in the
    package changes its settings.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording a call site for every column expression doubles planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a written table that every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``. Only
    a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_DIR} to storage shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; call it when no result is read
    any more."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or (_LOCAL[0] if _LOCAL else None)
    if base:
        store, path = fs.FileSystem.from_uri(
            f"{base.rstrip('/')}/{spark.sparkContext.applicationId}")
        if store.get_file_info(path).type == fs.FileType.Directory:
            store.delete_dir(path)


_LOCAL: list[str] = []


def _local_base() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL[0]
