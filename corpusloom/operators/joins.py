"""Joins that need more than an equality: orphans, reconciliation, containing interval, either-key, precedence cascade, pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of child whose non-null key has no parent."""
    there = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(there, key, "left_anti")


def reconciled(stated: DataFrame, found: DataFrame, key: str, content: str) -> DataFrame:
    """missing, not_listed, differs or same for each key of either side."""
    a, b = stated.select(key, F.col(content).alias("a"), F.lit(True).alias("in_a")), found.select(key, F.col(content).alias("b"), F.lit(True).alias("in_b"))
    status = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "not_listed").when(~F.col("a").eqNullSafe(F.col("b")), "differs").otherwise("same")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def containing_interval(points: DataFrame, spans: DataFrame, point: str, key: list[str], bucket: int) -> DataFrame:
    """The span [start, end] that contains each key's points, the latest started one where several do (then the greatest span_id).

    points: key columns and the point (an integer); spans: span_id, start, end. Spans are dealt to buckets of the given width, so
    choose a width near the usual span; each bucket is one sorted pass, in which no span meets a point but the one that it gets.
    Points in no span come with a null span_id.
    """
    width = F.lit(bucket)
    place = lambda c: F.floor(F.col(c) / width)
    real = spans.where("start <= end").select("span_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    nothing = lambda df, *names: [F.lit(None).cast(df.schema[n].dataType).alias(n) for n in names]
    dealt = real.select(F.explode(F.sequence(place("start"), place("end"))).alias("bucket"), F.col("start").alias("at"), F.lit(0).alias("asks"), "span_id", "end", *nothing(points, *key))
    asked = points.select(place(point).alias("bucket"), F.col(point).cast("long").alias("at"), F.lit(1).alias("asks"), *nothing(real, "span_id", "end"), *key)
    rows = dealt.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "at", "asks", "span_id")
    schema = StructType([*[points.schema[c] for c in key], StructField("start", LongType()), StructField("span_id", spans.schema["span_id"].dataType)])
    best = rows.select("bucket", "at", "asks", "span_id", "end", *key).mapInArrow(_latest_open(to_arrow_schema(schema), key), schema)
    return best.groupBy(*key).agg(F.max(F.when(F.col("start").isNotNull(), F.struct("start", "span_id")))["span_id"].alias("span_id"))


def _latest_open(schema: pa.Schema, key: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each point of sorted rows with the last started span that is still open. Of the spans met so far only those are kept that end
    after all that started later: a stack, its ends falling, whose top is the answer once what has ended is taken off."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []
        for batch in batches:
            take, starts, ids = [], [], []
            bucket, at, asks, span, end = [batch.column(c).to_pylist() for c in ("bucket", "at", "asks", "span_id", "end")]
            for i in range(batch.num_rows):
                if bucket[i] != here:
                    here, stack = bucket[i], []
                if asks[i]:
                    while stack and stack[-1][0] < at[i]:
                        stack.pop()
                    take.append(i)
                    starts.append(stack[-1][1] if stack else None)
                    ids.append(stack[-1][2] if stack else None)
                else:
                    while stack and stack[-1][0] <= end[i]:
                        stack.pop()
                    stack.append((end[i], at[i], span[i]))
            kept = batch.take(pa.array(take, pa.int64()))
            yield pa.record_batch([*[kept.column(c).cast(schema.field(c).type) for c in key], pa.array(starts, pa.int64()), pa.array(ids, schema.field("span_id").type)], schema=schema)

    return run


def next_match(df: DataFrame, key: str, at: str, item: str, asks: Column, name: str) -> DataFrame:
    """Each asking row's item with the first other row of its key at a later time (the least item of a tie), or null: one sorted
    pass from the end, in which the least (at, item) met so far is the next one."""
    w = Window.partitionBy(key).orderBy(F.col(at).desc()).rangeBetween(Window.unboundedPreceding, -1)
    answer = F.min(F.when(~asks, F.struct(at, item))).over(w)
    return df.withColumn("answer", answer).where(asks).select(item, F.col("answer")[item].alias(name))


def either_key(df: DataFrame, holds: DataFrame, first: str, second: str) -> DataFrame:
    """df with the hold on its first key, else that on its second. holds: scope (first or second), key, hold; one row a key."""
    one = holds.where("scope = 'first'").select(F.col("key").alias(first), F.col("hold").alias("hold_1"))
    two = holds.where("scope = 'second'").select(F.col("key").alias(second), F.col("hold").alias("hold_2"))
    return df.join(one, first, "left").join(two, second, "left").withColumn("hold", F.coalesce("hold_1", "hold_2")).drop("hold_1", "hold_2")


def cascade(df: DataFrame, key: str, lookups: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """key with the first lookup that has a match: basis and target. lookups: (basis, table of lookup_key and target, key expression)."""
    out = df
    for k, (_, table, expression) in enumerate(lookups):
        least = table.groupBy("lookup_key").agg(F.min("target").alias(f"t{k}")).withColumnRenamed("lookup_key", f"k{k}")
        out = out.withColumn(f"k{k}", expression).join(least, f"k{k}", "left")
    basis = F.coalesce(*[F.when(F.col(f"t{k}").isNotNull(), name) for k, (name, _, _) in enumerate(lookups)], F.lit("proposal"))
    return out.select(key, basis.alias("basis"), F.coalesce(*[F.col(f"t{k}") for k in range(len(lookups))]).alias("target"))


def earliest_holder(df: DataFrame, key: str, item: str, *order: str) -> DataFrame:
    """Items whose key an earlier item had, and the first one that had it."""
    first = F.first(item).over(Window.partitionBy(key).orderBy(*order))
    return df.where(F.col(key).isNotNull()).withColumn("first", first).where(F.col("first") != F.col(item)).select(item, F.col("first").alias(f"first_{item}"))


def shared_between(df: DataFrame, item: str, group: str) -> DataFrame:
    """Items that occur in more than one group."""
    return df.groupBy(item).agg(F.count_distinct(group).alias("groups")).where("groups > 1")


def jaccard_pairs(sets: DataFrame, group: str, item: str, element: str) -> DataFrame:
    """Pairs of items of a group that share elements: shared, union. Each element's list of items should be short."""
    rows = sets.select(group, item, element).distinct()
    size = rows.groupBy(group, item).agg(F.count("*").alias("n"))
    other = rows.select(group, element, F.col(item).alias("other"))
    pairs = rows.join(other, [group, element]).where(F.col(item) < F.col("other")).groupBy(group, item, "other").agg(F.count("*").alias("shared"))
    a, b = size, size.select(group, F.col(item).alias("other"), F.col("n").alias("m"))
    return pairs.join(a, [group, item]).join(b, [group, "other"]).select(group, item, "other", "shared", (F.col("n") + F.col("m") - F.col("shared")).alias("union"))
