"""Session construction and checkpoint-directory handling."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry") -> SparkSession:
    """A session tuned for local tests and the bench; on a cluster pass master=None and size
    ``spark.sql.shuffle.partitions`` from the data (AQE coalesces what is too many)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    parts = shuffle_partitions or os.environ.get("QUARRY_SHUFFLE_PARTITIONS") or (8 if master and master.startswith("local") else None)
    if parts:   # a cluster's own setting stays
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    b = (b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, honouring ``spark.checkpoint.dir``.

    On a cluster the directory must be shared storage named by the cluster's own
    ``spark.checkpoint.dir``.  Only when nothing is configured and the master is local
    (tests, the bench) do we create a scratch directory ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    d = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, placed next to the checkpoint directory (shared storage)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/quarry-tables/{name}"


class Scratch:
    """Tables of one run, written to a folder of its own in shared storage and read back, so that lineage ends and any
    executor can be lost.  Superseded tables are dropped on the way, the rest when the run ends; results stay."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.tables: set[str] = set()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        self.tables.add(name)
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in self.tables.intersection(names):
            folder = path(f"{self.base}/{name}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
            self.tables.discard(name)

    def finish(self, *results: str) -> None:
        self.drop(*(self.tables - set(results)))
