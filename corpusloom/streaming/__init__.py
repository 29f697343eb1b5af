"""Structured Streaming forms: idempotent append, per-key state machines, incremental text reuse. Each gives what its batch
form gives over the same rows, however they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.operators.reuse import candidates, sketched, verified


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Writes what has landed and stops; a later call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def once_per_id(stream: DataFrame, key: str, at: str | None = None, late: str = "1 day") -> DataFrame:
    """Each id once. With an event time, state older than the watermark is given up; without, it is kept."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key]) if at else stream.dropDuplicates([key])


def machine(stream: DataFrame, key: str, order: str, state: str, transitions: list[tuple[str | None, str]]) -> DataFrame:
    """Every transition of each key with the state before it and whether the machine allows it; refused ones change nothing.

    Rows of a batch are taken in their order column; a row that comes later is a later statement, whatever its order.
    """
    allowed = {(a, b) for a, b in transitions}

    def run(keys: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.get[0] if held.exists else None
        rows = pd.concat([*batches]).sort_values(order, kind="stable")
        out = []
        for at, new in zip(rows[order], rows[state]):
            ok = (now, new) in allowed
            out.append((keys[0], at, now, new, ok))
            now = new if ok else now
        held.update((now,))
        yield pd.DataFrame(out, columns=["key", "at", "previous_state", "new_state", "allowed"])

    return stream.select(F.col(key).cast("string").alias("key"), F.col(order).cast("long").alias(order), F.col(state).alias(state)).groupBy("key").applyInPandasWithState(
        run, "key string, at long, previous_state string, new_state string, allowed boolean", "now string", "append", GroupStateTimeout.NoTimeout
    )


def machine_batch(df: DataFrame, key: str, order: str, state: str, transitions: list[tuple[str | None, str]]) -> DataFrame:
    """The same over a finished table."""
    allowed = {(a, b) for a, b in transitions}

    def run(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        now, out = None, []
        for at, new in zip(*[rows.sort_values(order, kind="stable")[c] for c in (order, state)]):
            ok = (now, new) in allowed
            out.append((keys[0], at, now, new, ok))
            now = new if ok else now
        return pd.DataFrame(out, columns=["key", "at", "previous_state", "new_state", "allowed"])

    return df.select(F.col(key).cast("string").alias("key"), F.col(order).cast("long").alias(order), F.col(state).alias(state)).groupBy("key").applyInPandas(run, "key string, at long, previous_state string, new_state string, allowed boolean")


def windowed(stream: DataFrame, at: str, key: str, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts by key in tumbling or sliding windows, closed by the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width, slide) if slide else F.window(at, width), key).count()


class ReuseStore:
    """Sketches of the texts seen so far, as a Parquet table; each micro-batch is held against it and against itself."""

    def __init__(self, sketches: str, relations: str) -> None:
        self.sketches, self.relations = sketches, relations

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch. batch: doc_id, outlet, text; a repeated batch overwrites its own output."""
        spark = batch.sparkSession
        mine = f"batch={batch_id}"
        sketched(batch).write.mode("overwrite").parquet(f"{self.sketches}/{mine}")
        new = spark.read.parquet(f"{self.sketches}/{mine}")
        all_ = spark.read.option("basePath", self.sketches).parquet(self.sketches).where(F.col("batch") <= batch_id).drop("batch")
        found = verified(candidates(new, all_), new, all_).unionByName(verified(candidates(all_, new), all_, new)).select("document_id", "target_document_id")
        same = new.select("sha", "doc_id").join(all_.select("sha", F.col("doc_id").alias("target")), "sha").where("doc_id <> target")  # equal texts of other batches
        pairs = same.select(F.greatest("doc_id", "target").alias("document_id"), F.least("doc_id", "target").alias("target_document_id"))
        found.unionByName(pairs).distinct().write.mode("overwrite").parquet(f"{self.relations}/{mine}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.relations).parquet(self.relations).select("document_id", "target_document_id").distinct()


__all__ = ["ReuseStore", "drained", "file_stream", "machine", "machine_batch", "once_per_id", "windowed"]
