"""Tables that are written between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset, a local session gets one of its own. On a cluster that is an error: a
    folder of this machine would be out of reach for the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settled(spark: SparkSession) -> Iterator[None]:
    """For a query whose result is taken at once. Spark deletes its shuffle files when it ends, not
    when the driver's memory is next cleaned: nothing needs them any more. A few partitions are
    written side by side, without a sort. Rows go to Python in small batches, since texts are
    long."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """The rows of df as a table in the shared folder: cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with settled(spark):
        df.write.partitionBy(*(by or [])).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() made, once nothing reads them any more."""
    spark = tables[0].sparkSession
    for df in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
