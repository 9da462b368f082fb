"""Nearest neighbours of embedding vectors and of named points.

* cosine top-k and Euclidean 1-NN in any dimension: exact, through pivot
  cells (:mod:`quarry.operators.blocked`);
* Euclidean 1-NN of 2-D points also through a grid index
  (:mod:`quarry.operators.spatial`);
* query words -> vectors by an equi join, unknown words by an anti join;
* expected-label checks by a join on the query id.

"Self" is dropped by id, not by position, and scores are rounded to 6
decimals before ranking, ties to the smaller id.  A query whose vector is
NULL or has a NULL or NaN component has no neighbour: Euclidean 1-NN answers
it with NULLs, top-k leaves it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import normalize
from quarry.operators.blocked import BLOCK_ROWS, PivotIndex, exact_topk

SIM_DIGITS = 6


def unit_vectors(vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """Rows with a zero vector are dropped (their unit vector is NULL)."""
    return vectors.withColumn(vec, normalize(F.col(vec))).where(F.col(vec).isNotNull())


def query_vectors(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """(qid, word) x (idx, word, vec) -> (qid, word, idx, vec)."""
    return words.join(vectors, "word").select("qid", "word", "idx", "vec")


def unknown_words(words: DataFrame, vectors: DataFrame) -> DataFrame:
    return words.join(vectors.select("word"), "word", "left_anti").select("qid", "word")


def usable(vec):
    """The vector has no NULL and no NaN, and is not NULL itself."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = 3, block_rows: int = BLOCK_ROWS,
                pivots: int | None = None) -> DataFrame:
    """Exact cosine top-k per query, the query's own vector excluded.

    queries: (qid, idx, vec) raw vectors; vectors: (idx, vec) raw vectors.
    Returns (qid, rank, idx, sim).
    """
    x = unit_vectors(vectors.where(usable(F.col("vec")))).select(F.col("idx").alias("id"), "vec")
    q = unit_vectors(queries.where(usable(F.col("vec")))).select(F.col("qid").alias("id"), F.col("idx").alias("self"), "vec")
    top = exact_topk(PivotIndex(x, pivots), q, k, "dot", SIM_DIGITS, block_rows)
    return top.select("qid", F.col("rank").cast("int").alias("rank"), F.col("rid").alias("idx"),
                      F.round("score", SIM_DIGITS).alias("sim"))


def l2_nearest_vectors(queries: DataFrame, vectors: DataFrame, block_rows: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """Exact Euclidean 1-NN in any dimension: queries (qid, self, vec),
    vectors (idx, vec) -> (qid, idx, dist), one row per query.  ``self`` is an
    id to leave out, or NULL.  Queries and data must agree in dimension."""
    x = vectors.where(usable(F.col("vec"))).select(F.col("idx").alias("id"), "vec")
    q = queries.where(usable(F.col("vec"))).select(F.col("qid").alias("id"), "self", "vec")
    top = exact_topk(PivotIndex(x, pivots), q, 1, "l2", None, block_rows)
    found = top.select(F.col("qid").alias("_q"), F.col("rid").alias("idx"), F.sqrt("score").alias("dist"))
    return queries.join(found, queries.qid == found["_q"], "left").select("qid", "idx", "dist")


def l2_nearest_batched(points: DataFrame, queries: DataFrame, *, pid: str = "id", qid: str = "qid",
                       cols=("easting", "northing"), carry=(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1-NN of points with named coordinates, by matrix products over pivot cells."""
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    q = queries.select(F.col(qid).alias("qid"), F.lit(None).cast("bigint").alias("self"), vec.alias("vec"))
    res = l2_nearest_vectors(q, points.select(F.col(pid).alias("idx"), vec.alias("vec")), block_rows)
    res = res.select(F.col("qid").alias(qid), F.col("idx").alias(pid), "dist")
    if carry:
        res = res.join(points.select(F.col(pid), *carry), pid, "left").select(qid, pid, *carry, "dist")
    return res


def label_mismatches(found: DataFrame, expected: DataFrame, found_col: str = "name") -> DataFrame:
    """Queries whose found label differs from the expected one."""
    j = found.select("qid", F.col(found_col).alias("found")).join(expected, "qid")
    return j.where(~F.col("found").eqNullSafe(F.col("label"))).select(
        "qid", "found", F.col("label").alias("expected"))


def label_error_count(found: DataFrame, expected: DataFrame, found_col: str = "name") -> DataFrame:
    j = found.select("qid", F.col(found_col).alias("found")).join(expected, "qid")
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_queries"),
                 F.count_if(~F.col("found").eqNullSafe(F.col("label"))).cast("bigint").alias("n_errors"))
