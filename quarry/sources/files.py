"""A directory tree of files as a DataFrame, and as a packed table that is kept
up to date by listing what has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import sinks

# what opening a file counts in bytes when small files are dealt to tasks: with
# Spark's 4 MB a task gets 32 files, and a tree of millions 100,000 tasks
OPEN_COST = 1 << 16


def read_tree(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, length, content string) for every file below ``root`` that is not
    empty (Spark's file sources skip empty files).

    ``glob`` is a file-name filter such as ``*.{c,h}``.  ``binaryFile`` loads a
    whole file per row; a query that does not use ``content`` only lists the
    files.  For very large trees see :func:`pack_tree`.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "length", F.col("content").cast("string").alias("content"))


def write_tree(files: DataFrame, root: str) -> int:
    """Write (path, content) rows as files below ``root``; how many.

    Every task writes its own rows, each file under another name first, so
    that a retried task replaces whole files.  NULL contents are empty files."""
    def run(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        made = set()
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").cast(pa.binary()).to_pylist(), strict=True):
                target = f"{base}/{name}"
                folder = os.path.dirname(target)
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(content or b"")
                store.move(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    written = files.select("path", F.col("content").cast("string").alias("content")).mapInArrow(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


PACKED = "path string, modified timestamp, length long, content binary"


def pack_tree(spark: SparkSession, root: str, packed: str, glob: str | None = None) -> int:
    """Append to the table at ``packed`` the files below ``root`` that are new or
    changed since the last call; how many versions it holds then.

    Only files modified since the newest packed one are listed and read; of
    those as old as that one, what is packed is left out.  The append is one
    batch, named by its number, so that a call that failed can be repeated.
    Spark's file sources skip empty files."""
    have = sinks.read_appended(spark, packed, PACKED).select("path", "modified", "length")
    last = F.max("modified") - F.expr("INTERVAL 1 SECOND")
    newest = have.agg(F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if newest:
        r = r.option("modifiedAfter", newest)
        # only these can be met again; written, so that their size is known and no content is shuffled to the join
        path = scratch_path(spark, "packed-last")
        have.where(F.col("modified") >= F.to_timestamp(F.lit(newest), "yyyy-MM-dd'T'HH:mm:ss")).write.parquet(path)
        have = spark.read.schema("path string, modified timestamp, length long").parquet(path)
    files = r.load(root).select("path", F.col("modificationTime").alias("modified"), "length", "content")
    new = files.join(have, ["path", "modified", "length"], "left_anti")
    batch = f"{sinks.committed(spark, packed).count():08d}"
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", OPEN_COST)
    try:
        sinks.append_batch(new, packed, batch)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    return sinks.read_appended(spark, packed, PACKED).count()


def read_packed(spark: SparkSession, packed: str) -> DataFrame:
    """(path, length, content string): the newest version of every packed file.

    A packed table keeps files that have left the tree since."""
    rows = sinks.read_appended(spark, packed, PACKED)
    names = rows.select("path", "modified")
    newest = names.groupBy("path").agg(F.max("modified").alias("newest"), F.min("modified").alias("oldest")).where("newest > oldest")
    # the superseded versions, written, so that their number is known and no content is shuffled where they are few
    path = scratch_path(spark, "packed-older")
    names.join(newest, "path").where("modified < newest").select("path", "modified").distinct().write.parquet(path)
    older = spark.read.schema("path string, modified timestamp").parquet(path)
    return rows.join(older, ["path", "modified"], "left_anti").select("path", "length", F.col("content").cast("string").alias("content"))
