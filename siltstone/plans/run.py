"""Many configurations one after another, going on where a run ended."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LOG = logging.getLogger(__name__)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written whole: its marker is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def run_all(spark: SparkSession, configs: dict[str, Callable[[], DataFrame]], path: str, again: bool = False) -> dict[str, str]:
    """Writes each configuration's result below path/name, but those that are there; a failure is logged and the next one runs. Says of each: done, skipped or what failed."""
    said = {}
    for name, make in configs.items():
        out = f"{path}/{name}"
        if not again and exists(spark, out):
            said[name] = "skipped"
            continue
        try:
            make().write.mode("overwrite").parquet(out)
            said[name] = "done"
        except Exception as e:  # noqa: BLE001 - one configuration must not stop the others
            LOG.exception("%s failed", name)
            said[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    return said


def read_all(spark: SparkSession, names: list[str], path: str) -> DataFrame:
    """The results of the configurations that are there, with config."""
    from pyspark.sql import functions as F

    out = None
    for name in names:
        if exists(spark, f"{path}/{name}"):
            part = spark.read.parquet(f"{path}/{name}").withColumn("config", F.lit(name))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no configuration has a result")
    return out
