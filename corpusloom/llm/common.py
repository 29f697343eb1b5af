"""What the training-data operators share: reading, folds, Arrow row loops, and the library's scratch tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import cut, scratch_path, shared_dir, written

__all__ = ["SLICE", "cut", "documents", "fold_column", "fold_of", "id_text", "row_map", "scratch_path", "shared_dir", "written"]

#: Rows that a task turns into Python objects at a time.
SLICE = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(df: DataFrame) -> DataFrame:
    """Only doc_id (bigint) and text (null: empty) of a table, whatever else it carries."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def row_map(fn: Callable[..., Iterable[tuple]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that calls fn with each row's columns and emits the tuples it yields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = [out for row in zip(*(c.to_pylist() for c in part.columns)) for out in fn(*row)]
                if rows:
                    yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def fold_of(doc_id: int | None, folds: int) -> int:
    """crc32 of the id as text, modulo folds (a null id: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def fold_column(doc_id, folds: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
