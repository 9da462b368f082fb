"""Result writers: text-like files (CSV), appended result rows, and appends in
named batches that can be retried."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_result(df: DataFrame, path: str, fmt: str = "csv", header: bool = True, order=()) -> None:
    """Replace a result set (``longest.txt``-style outputs).

    ``order`` names the columns to sort by, such as the query id: a range
    sort, so the part files read in name order are in query order."""
    if order:
        df = df.orderBy(*order)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)


def append_result(df: DataFrame, path: str) -> None:
    """Append result rows (the timing-line sink) as CSV."""
    df.write.mode("append").option("header", False).csv(path)


# ------------------------------------------------------ appends that can be retried

BATCH_ID = re.compile(r"[A-Za-z0-9_.-]+")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(batch): the batches of an appended result that count."""
    if not _exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], "batch string")
    return spark.read.schema("marker boolean, batch string").parquet(f"{path}/commits").select("batch").distinct()


def stage_batch(df: DataFrame, path: str, batch: str) -> None:
    """First half of an append: the batch's rows, in a folder of its own.  What
    an earlier, failed try left there is replaced; readers do not see it yet."""
    if not BATCH_ID.fullmatch(batch):
        raise ValueError(f"not a batch name: {batch!r}")
    df.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")


def commit_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Second half: the marker that makes the batch count."""
    spark.range(1).select(F.lit(True).alias("marker")).write.mode("overwrite").parquet(f"{path}/commits/batch={batch}")


def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Append the rows of ``df`` as batch ``batch``; False if it was there.

    Rows and marker are two writes, the marker last, so that a reader sees all
    of a batch or nothing.  A replayed batch adds nothing, one that failed in
    between is written again.  One writer per batch name is assumed; writers
    of different batches need no lock, as they share no folder."""
    spark = df.sparkSession
    if committed(spark, path).where(F.col("batch") == batch).limit(1).count():
        return False
    stage_batch(df, path, batch)
    commit_batch(spark, path, batch)
    return True


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of committed batches, with their ``batch``; ``schema`` is that of the rows."""
    if not _exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], f"{schema}, batch string")
    rows = spark.read.schema(f"{schema}, batch string").parquet(f"{path}/rows")
    return rows.join(committed(spark, path), "batch", "left_semi")
