"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    # AQE sizes shuffles, splits skewed join partitions and switches to broadcast
    # from measured sizes; forcing the skew split trades one extra shuffle for
    # never leaving a hot key in a single task.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "civiframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting (unit tests) gets a temporary
    folder; a cluster without it is a configuration error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="civiframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/civiframe/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` in the shared folder and read it back (cuts the lineage;
    survives the loss of any executor)."""
    return Staged(df.sparkSession).put(df, name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in whatever store they lie."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [str(f.getPath()) for f in found or []]


class Staged:
    """Tables in the shared folder, removed after their last reader.

    ``put`` writes a frame and reads it back; ``drop`` removes the folders given (all
    if none is given). As a context manager it removes all at the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for key in [id(x) for x in frames] or list(self.paths):
            if key in self.paths:
                remove_path(self.spark, self.paths.pop(key)[1])

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
