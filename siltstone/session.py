"""Sessions, and the package's way to the executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Rows that Python workers get at once, where the session has Spark's default of 10,000: texts may be long, and the whole batch is in memory.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1000


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine, as tests and the bench use it; on a cluster the submitter configures the session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Makes this package importable on the executors, once per application: Spark's file server hands out a zip of its sources. Bounds the batches that Python workers get."""
    context = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, ROWS)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="siltstone-"), "siltstone.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def write_shared(df: DataFrame, name: str) -> str:
    """Writes df as Parquet to a fresh path in the folder that driver and executors share (spark.checkpoint.dir; below /tmp where that is unset, in local mode only). Deleted when the JVM ends."""
    spark = df.sparkSession
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{(found or 'file:///tmp/checkpoints/siltstone').rstrip('/')}/siltstone-{uuid.uuid4().hex}/{name}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where.getParent())
    df.write.parquet(path)
    return path


def shared_batches(path: str, columns: list[str]):
    """Batches of a table of write_shared, as a task reads them."""
    from pyarrow import dataset, fs

    where, base = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    yield from (b for b in dataset.dataset(base, filesystem=where, format="parquet").to_batches(columns=columns, batch_size=1 << 18, batch_readahead=1, fragment_readahead=1) if b.num_rows)
