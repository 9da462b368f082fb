"""Frequent keys of skewed data by mergeable Misra-Gries summaries.

A summary holds at most ``capacity`` counters whatever the number of keys.  A
counter never exceeds its key's true weight and falls short of it by at most
the summary's error, which is at most the total weight / (capacity + 1).
Summaries of tasks merge by adding counters and errors, so a pass over the
data shuffles ``capacity`` rows a task, and every key with more than that
share of the weight is among them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summaries(rows: DataFrame, key: str, weight: str, capacity: int) -> DataFrame:
    """(key, low, error, total): the counters of every task, and one row with a
    NULL key that has the task's error and total weight.  NULL keys and
    weights are left out; weights must not be negative."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")

    def run(batches):
        import pandas as pd
        import pyarrow as pa
        counters, error, total = pd.Series(dtype="int64"), 0, 0
        for b in batches:
            new = pd.Series(b.column("w").to_numpy(), index=pd.Index(b.column("k").to_pandas(), dtype=object)).groupby(level=0).sum()
            total += int(new.sum())
            counters = counters.add(new, fill_value=0).astype("int64")
            if len(counters) > capacity:
                cut = int(counters.nlargest(capacity + 1).iloc[-1])
                counters = counters[counters > cut] - cut
                error += cut
        n = len(counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counters.index, None], pa.string()), pa.array([*counters.tolist(), 0], pa.int64()),
             pa.array([0] * n + [error], pa.int64()), pa.array([0] * n + [total], pa.int64())], names=["key", "low", "error", "total"])

    src = rows.select(F.col(key).cast("string").alias("k"), F.col(weight).cast("bigint").alias("w")).where("k IS NOT NULL AND w IS NOT NULL")
    return src.mapInArrow(run, "key string, low long, error long, total long")


def merged(parts: DataFrame) -> DataFrame:
    """(key, low, high): low <= true weight <= high for each key that has a
    counter; any other key weighs at most ``high - low``."""
    error = parts.agg(F.coalesce(F.sum("error"), F.lit(0))).scalar()
    return (parts.where("key IS NOT NULL").groupBy("key").agg(F.sum("low").alias("low"))
            .withColumn("high", F.col("low") + error))


def frequent(rows: DataFrame, key: str, weight: str, share: float) -> DataFrame:
    """(key, weight): exactly the keys with more than ``share`` of all weight.

    The summary's candidates, at most about 2 / ``share`` of them, are counted
    again by a semi join, so rare keys are never shuffled."""
    from quarry.session import scratch_path
    spark = rows.sparkSession
    path = scratch_path(spark, "frequent")
    summaries(rows, key, weight, math.ceil(2 / share)).write.parquet(path)
    parts = spark.read.schema("key string, low long, error long, total long").parquet(path)
    total = parts.agg(F.coalesce(F.sum("total"), F.lit(0))).scalar()
    likely = merged(parts).where(F.col("high") > F.lit(share) * total).select(F.col("key").alias("_key"))
    counted = (rows.join(likely, rows[key].cast("string") == F.col("_key"), "left_semi")
               .groupBy(F.col(key).cast("string").alias("key")).agg(F.sum(weight).cast("bigint").alias("weight")))
    return counted.where(F.col("weight") > F.lit(share) * total)
