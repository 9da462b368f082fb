"""Structured Streaming forms of the two incremental patterns.

* Query feed: the files of a query table are the stream; every micro-batch is answered
  against the static point set by the same grid search as the batch job
  (``foreachBatch``), and the answers are appended to a parquet sink.  The
  stream's checkpoint replaces the reference's end-of-input sentinel.
* Sketch updates: the files of a table of ids are the stream; register updates are aggregated
  with ``max`` per register in complete mode.  The state is at most m rows,
  so no watermark is needed.

No input is copied or repartitioned.  Checkpoints and sinks live in the shared folder named by
``spark.checkpoint.dir`` (fresh sub-folder per run), so a lost executor or a
restarted driver resumes from the checkpoint.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import sketch as hll
from quarry.operators.spatial import sphere_index, sphere_nearest
from quarry.session import scratch_path
from quarry.sources.text import parse_id_tokens


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A table's own files as a stream; files that arrive later are picked up.

    The path is a pattern (of one name), as a stream source takes a table
    that is a single file only so."""
    folder = sf_dir.rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def nearest_stream(index, queries: DataFrame, out_dir: str, ckpt_dir: str):
    """Answer every arriving query micro-batch against a static point index
    (written once by :func:`quarry.operators.spatial.sphere_index`)."""

    def answer(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch id, overwritten: a replayed batch replaces its
        # own output instead of appending a second copy.
        sphere_nearest(index, batch).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return (queries.writeStream.foreachBatch(answer)
            .option("checkpointLocation", ckpt_dir)
            .trigger(availableNow=True)
            .start())


def registers_stream(lines: DataFrame, out_dir: str, ckpt_dir: str, *, m: int = 1024, seed: int = 42):
    """Maintain HLL registers over arriving id lines (complete mode)."""
    toks = parse_id_tokens(lines).where(F.col("token").isNotNull())
    upd = hll.register_updates(toks, "token", m, seed, method="join")
    regs = upd.groupBy("j").agg(F.max("rho").alias("rho"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        # A folder per batch: if a batch fails, the last whole result stays.
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return (regs.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", ckpt_dir)
            .trigger(availableNow=True)
            .start())


def run_nearest_stream(spark: SparkSession, points: DataFrame, sf_dir: str, name: str, as_queries,
                       carry=("location",)) -> DataFrame:
    """Answers to all of table ``name``'s rows, fed as a stream."""
    base = scratch_path(spark, "geo-stream")
    index = sphere_index(points, carry=carry, path=os.path.join(base, "index"))
    queries = as_queries(table_stream(spark, sf_dir, name))
    out = os.path.join(base, "out")
    nearest_stream(index, queries, out, os.path.join(base, "ckpt")).awaitTermination()
    answers = sphere_nearest(index, spark.createDataFrame([], queries.schema)).schema
    return spark.read.schema(answers).parquet(out) if _has_batches(spark, out) else spark.createDataFrame([], answers)


def run_registers_stream(spark: SparkSession, sf_dir: str, name: str, as_lines, m: int = 1024, seed: int = 42) -> DataFrame:
    """Registers after all of table ``name``'s rows, fed as a stream: the last batch's."""
    base = scratch_path(spark, "hll-stream")
    lines = as_lines(table_stream(spark, sf_dir, name))
    out = os.path.join(base, "out")
    registers_stream(lines, out, os.path.join(base, "ckpt"), m=m, seed=seed).awaitTermination()
    schema = "j long, rho long"
    if not _has_batches(spark, out):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema + ", batch long").parquet(out)
    last = found.agg(F.max("batch")).scalar()
    return found.where(F.col("batch") == last).select("j", "rho")


def _has_batches(spark: SparkSession, path: str) -> bool:
    """Whether a batch was written at all (an empty table makes none)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
