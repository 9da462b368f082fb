"""Source-tree statistics over (path, content) rows.

File counts by extension, total size, the longest files by line count with
their SHA-1 digests, the number of files containing a phrase, and the SPDX
licence tally.  Everything is a projection plus one aggregate or one
top-k (TakeOrderedAndProject) over whole file contents.

Tie rule for the rankings: larger count first, then the smaller path or tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import file_extension, newline_count, spdx_tag

SOURCE_EXTS = ("c", "h")


def with_ext(files: DataFrame) -> DataFrame:
    return files.withColumn("ext", file_extension(F.col("path")))


def count_by_ext(files: DataFrame, exts=SOURCE_EXTS) -> DataFrame:
    return (with_ext(files).where(F.col("ext").isin(*exts))
            .groupBy("ext").agg(F.count(F.lit(1)).cast("bigint").alias("n_files")))


def total_bytes(files: DataFrame) -> DataFrame:
    """Bytes (not disk blocks) of every file in the tree; contents are not read."""
    return files.agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                     F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"))


def line_counts(files: DataFrame, exts=SOURCE_EXTS) -> DataFrame:
    return (with_ext(files).where(F.col("ext").isin(*exts))
            .select("path", newline_count(F.col("content")).alias("lines"), "content"))


def longest(files: DataFrame, k: int = 10, exts=SOURCE_EXTS) -> DataFrame:
    return (line_counts(files, exts).orderBy(F.desc("lines"), F.asc("path")).limit(k)
            .select("path", "lines"))


def longest_sha1(files: DataFrame, k: int = 10, exts=SOURCE_EXTS) -> DataFrame:
    """SHA-1 of the whole content of the k longest files.

    The ranking carries paths and counts only; its k paths then pick the
    contents, and only those are digested, where they are read."""
    picked = files.select("path", "content").join(F.broadcast(longest(files, k, exts).select("path")), "path", "left_semi")
    return picked.select("path", F.sha1(F.col("content").cast("binary")).alias("sha1"))


def grep_count(files: DataFrame, phrase: str) -> DataFrame:
    """Number of files whose content contains the phrase (a row is a file)."""
    hit = files.where(F.col("content").contains(phrase))
    return hit.agg(F.lit(phrase).alias("phrase"), F.count(F.lit(1)).cast("bigint").alias("n_files"))


def licenses(files: DataFrame, exts=("c",)) -> DataFrame:
    """(path, license): first SPDX tag of each source file that has one."""
    return (with_ext(files).where(F.col("ext").isin(*exts))
            .select("path", spdx_tag(F.col("content")).alias("license"))
            .where(F.col("license").isNotNull()))


def license_counts(files: DataFrame, exts=("c",)) -> DataFrame:
    return licenses(files, exts).groupBy("license").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def top_license(files: DataFrame, exts=("c",)) -> DataFrame:
    return license_counts(files, exts).orderBy(F.desc("n"), F.asc("license")).limit(1)
