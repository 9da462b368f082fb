"""Exact distinct counts of integer keys by bitmaps.

Keys are cut into ranges of 32,768; each range that occurs has one bitmap of 4
KB, built by every task for its rows and merged behind the shuffle.  What is
shuffled and held is bounded by the ranges, not by the rows or the keys: for
dense ids a bit per possible id.  Sparse ids are better served by a sketch
(:mod:`quarry.operators.sketch`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(keys: DataFrame, key: Column, *by: str) -> DataFrame:
    """(by..., bucket, bits): one bitmap per range of keys that occurs; mergeable by ``bitmap_or_agg``."""
    rows = keys.select(*by, key.cast("bigint").alias("_key")).where("_key IS NOT NULL")
    return rows.groupBy(*by, F.bitmap_bucket_number("_key").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("bits"))


def count(maps: DataFrame, *by: str) -> DataFrame:
    """(by..., n) of :func:`bitmaps`."""
    return maps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n"))


def rolled_up(maps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of fewer groups from those of more, without the rows."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_texts(keys: DataFrame, key: str) -> DataFrame:
    """(n): distinct non-NULL texts; those that spell an integer go by bitmap,
    only the others are shuffled."""
    number = F.col(key).try_cast("bigint")
    spelled = F.coalesce(number.cast("string") == F.col(key), F.lit(False))
    numbers = count(bitmaps(keys.where(spelled), number))
    others = keys.where(F.col(key).isNotNull() & ~spelled).agg(F.count_distinct(key).alias("n"))
    return numbers.unionByName(others).agg(F.sum("n").cast("bigint").alias("n"))
