"""Session builder, table reading, and scratch tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with UTC and AQE; everything else is left to the cluster's settings or to conf."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one where none is set and the session is local. A cluster without one is an error,
    as its executors would write to disks of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        sc = spark.sparkContext
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        found = sc._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


#: Scratch tables of this process.
_MADE: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    _MADE.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the scratch tables made so far: for when no result that reads them is needed any more."""
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: the lineage ends there and any executor can be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint, for loops."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where a small input has fewer partitions than that; a large input is left as it is read."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
