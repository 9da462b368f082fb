"""Random-hyperplane LSH for cosine neighbours.

* hyperplanes: ``d`` Gaussian vectors of the data dimension, seeded; each
  entry is Box-Muller over two md5 uniforms, so Spark and SQL agree;
* signature: bit p = (v . plane_p > 0), computed per Arrow batch with one
  matrix product (the planes are d x dim numbers, a parameter-sized constant);
* buckets: L tables, each keyed by k bit positions drawn with replacement;
* index: one Arrow pass emits a row's vector, in four bytes a component where
  that is exact, and its bucket in every table; rows are written per (table, bucket), sorted inside each task, without
  an exchange of vectors;
* probes: a query visits, in every table, its own bucket and the ones it most
  nearly fell into: the planes of the table are flipped in the order of the
  sum of the squared distances of the query from the flipped planes.  A few
  probes do the work of many more tables, so the index stays small;
* top-k: a query is hashed by its own vector, whether it is in the index or
  not; only buckets that some query probes are read on, and
  :func:`search_blocks` ranks them by the exact dot product, a large bucket in
  bounded blocks, so candidate pairs are never rows.
  A query whose buckets are all empty gets no neighbour.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32, md5_u32_py
from quarry.operators.blocked import BLOCK_ROWS, _best, _matrix, checked_dim, pack, search_blocks
from quarry.operators.neighbours import SIM_DIGITS, unit_vectors, usable
from quarry.session import scratch_path

FLIPS = 12  # planes of a table that may be flipped: those nearest the query
_U = 4294967297.0  # 2^32 + 1: maps a 32-bit draw to (0, 1)


def hyperplanes(spark: SparkSession, n_planes: int, dim: int, seed: int) -> DataFrame:
    """(plane, dim, g): standard normal entries, rounded to 9 decimals."""
    pd_ = spark.range(n_planes * dim).select((F.col("id") / dim).cast("bigint").alias("plane"),
                                             (F.col("id") % dim).alias("dim"))
    u1 = (md5_u32(seed, F.col("plane"), F.col("dim"), "a").cast("double") + 1) / _U
    u2 = (md5_u32(seed, F.col("plane"), F.col("dim"), "b").cast("double") + 1) / _U
    g = F.sqrt(-2 * F.log(u1)) * F.cos(2 * F.lit(np.pi) * u2)
    return pd_.select("plane", "dim", F.round(g, 9).alias("g"))


def plane_matrix(planes: DataFrame) -> np.ndarray:
    """The (n_planes x dim) constant; its size is set by parameters, not data."""
    rows = planes.orderBy("plane", "dim").collect()
    n = max(r["plane"] for r in rows) + 1
    m = max(r["dim"] for r in rows) + 1
    a = np.zeros((n, m))
    for r in rows:
        a[r["plane"], r["dim"]] = r["g"]
    return a


def bit_positions(n_tables: int, k: int, n_planes: int, seed: int) -> list[list[int]]:
    """L x k positions in [0, d), drawn with replacement by the md5 rule."""
    return [[md5_u32_py(seed, "h", t, j) % n_planes for j in range(k)] for t in range(n_tables)]


def _sign_bits(planes: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """(rows x planes) of the characters 0 and 1, as bytes."""
    return ((vecs @ planes.T) > 0).astype(np.uint8) + np.uint8(48)


def _strings(chars: np.ndarray) -> pa.Array:
    """One string per row of a (rows x length) byte matrix, without a loop."""
    n, width = chars.shape
    return pa.StringArray.from_buffers(n, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)),
                                       pa.py_buffer(np.ascontiguousarray(chars)))


def signatures(vectors: DataFrame, planes: np.ndarray, id_col: str = "idx") -> DataFrame:
    """(id, sig): sig is the d-character bit string, one Arrow batch at a time."""
    P = np.asarray(planes, dtype=np.float64)

    def fn(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(id_col), _strings(_sign_bits(P, _matrix(b.column("vec"))))], names=[id_col, "sig"])
    rows = vectors.where(usable(F.col("vec"))).select(F.col(id_col).cast("bigint").alias(id_col),
                                                      checked_dim(F.col("vec"), P.shape[1], "a vector").alias("vec"))
    return rows.mapInArrow(fn, f"{id_col} long, sig string")


def bucket_keys(positions: list[list[int]], sig: str = "sig"):
    """array<string> of the L bucket keys: the selected bits of each table,
    in slot order (one SQL expression)."""
    return F.expr("array(" + ", ".join(
        "concat(" + ", ".join(f"substr({sig}, {p + 1}, 1)" for p in pos) + ")" for pos in positions) + ")")


def buckets(sigs: DataFrame, positions: list[list[int]], id_col: str = "idx") -> DataFrame:
    """(id, tbl, bucket): one row per table."""
    return sigs.select(id_col, F.posexplode(bucket_keys(positions)).alias("tbl", "bucket"))


def bucket_sizes(bk: DataFrame) -> DataFrame:
    return bk.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@dataclass(frozen=True)
class LshIndex:
    rows: DataFrame      # (tbl, bucket, idx, vec packed): one row per vector and table
    planes: np.ndarray
    positions: list


SCHEMA = "tbl int, bucket string, {0} long, self long, vec binary"


def probe_bits(dots: np.ndarray, pos: list[int], probes: int) -> np.ndarray:
    """(rows x probes x slots) bits of the buckets of one table that each row
    visits, nearest first; ``dots``: (rows x planes) of unit vectors.  Slots of
    one plane flip together.  Fewer where the table has fewer buckets."""
    planes = list(dict.fromkeys(pos))
    slots = [planes.index(p) for p in pos]
    own = dots[:, planes] > 0
    if probes <= 1:
        return own[:, None, slots]
    flips = min(len(planes), FLIPS)
    margin = np.abs(dots[:, planes])
    order = np.argsort(margin, axis=1, kind="stable")[:, :flips]
    masks = (np.arange(1 << flips)[:, None] >> np.arange(flips)) & 1
    cost = np.take_along_axis(margin, order, 1) ** 2 @ masks.T
    best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    flipped = np.zeros((len(dots), best.shape[1], len(planes)), dtype=bool)
    np.put_along_axis(flipped, np.broadcast_to(order[:, None, :], (*best.shape, flips)), masks[best].astype(bool), axis=2)
    return (own[:, None, :] ^ flipped)[:, :, slots]


def _hashed(rows: DataFrame, planes: np.ndarray, positions, id_col: str, probes: int = 1) -> DataFrame:
    """(tbl, bucket, id, self, vec packed): one Arrow pass over (id, self, vec)."""
    P = np.asarray(planes, dtype=np.float64)

    def fn(batches):
        for b in batches:
            if not b.num_rows:
                continue
            vecs = _matrix(b.column("vec"))
            norm = np.sqrt(np.einsum("ij,ij->i", vecs, vecs))
            some = np.flatnonzero(norm > 0)
            # the signs are those of the vectors as given, the margins of unit vectors
            packed = pack(vecs[some])
            dots = (vecs[some] @ P.T) / norm[some, None]
            for t, pos in enumerate(positions):
                bits = probe_bits(dots, pos, probes)
                n = bits.shape[1]
                at = np.repeat(np.arange(len(some)), n)
                for a in range(0, len(at), 1 << 16):
                    part = at[a:a + (1 << 16)]
                    rid = pa.array(some[part])
                    chars = bits.reshape(len(at), -1)[a:a + (1 << 16)].astype(np.uint8) + np.uint8(48)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), t), pa.int32()), _strings(chars),
                                                      b.column(id_col).take(rid), b.column("self").take(rid), packed.take(pa.array(part))],
                                                     names=["tbl", "bucket", id_col, "self", "vec"])
    src = rows.where(usable(F.col("vec"))).select(F.col(id_col).cast("bigint").alias(id_col), F.col("self").cast("bigint").alias("self"),
                                                  checked_dim(F.col("vec"), P.shape[1], "a vector").alias("vec"))
    return src.mapInArrow(fn, SCHEMA.format(id_col))


def fit(vectors: DataFrame, planes: np.ndarray, positions, path: str | None = None) -> LshIndex:
    """Hash every row once and write (tbl, bucket, idx, packed vector) under
    ``path`` (a fresh folder of the shared location by default), each task's
    rows in bucket order.  No vector is shuffled; queries read these files.
    """
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "lsh-index")
    rows = _hashed(vectors.select("idx", F.lit(None).cast("bigint").alias("self"), "vec"), planes, positions, "idx").drop("self")
    rows.sortWithinPartitions("tbl", "bucket").write.mode("overwrite").parquet(path)
    return LshIndex(spark.read.schema(rows.schema).parquet(path), planes, positions)


def query_by_vector(index: LshIndex, queries: DataFrame, k: int = 3, block_rows: int = BLOCK_ROWS, probes: int = 1) -> DataFrame:
    """queries (qid, self, vec) -> (qid, rank, idx, sim).

    Candidates are the rows in the buckets that the query's own vector
    ``probes`` in each table, ranked by the exact dot product of unit vectors.
    ``self`` is an id to leave out, or NULL.
    """
    q = _hashed(queries, index.planes, index.positions, "qid", probes)
    # written, so that its size is known, queries are hashed for it once and no vector is shuffled to the join
    spark, path = queries.sparkSession, scratch_path(queries.sparkSession, "lsh-wanted")
    q.select("tbl", "bucket").distinct().write.parquet(path)
    wanted = spark.read.schema("tbl int, bucket string").parquet(path)
    g = F.concat_ws(":", "tbl", "bucket")
    data = index.rows.join(wanted, ["tbl", "bucket"], "left_semi").select(g.alias("g"), F.col("idx").alias("id"), "vec")
    found = search_blocks(data, q.select(g.alias("g"), F.col("qid").alias("id"), "self", "vec"), k, "dot", SIM_DIGITS, block_rows,
                          dim=np.asarray(index.planes).shape[1])
    # a pair can meet in several tables
    top = _best(found.groupBy("qid", "rid").agg(F.max("score").alias("score")), k, "dot", SIM_DIGITS)
    return top.select("qid", F.col("rank").cast("int").alias("rank"), F.col("rid").alias("idx"),
                      F.round("score", SIM_DIGITS).alias("sim"))


def candidate_rows(index: LshIndex, queries: DataFrame, probes: int = 1) -> DataFrame:
    """(qid, n_candidates): rows that a query is compared with, a row once for
    every table in which they meet; the search's work, to be weighed against its recall."""
    q = _hashed(queries, index.planes, index.positions, "qid", probes).select("qid", "tbl", "bucket")
    sizes = index.rows.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return q.join(sizes, ["tbl", "bucket"]).groupBy("qid").agg(F.sum("n").alias("n_candidates"))


def query(index: LshIndex, queries: DataFrame, vectors: DataFrame, k: int = 3, block_rows: int = BLOCK_ROWS, probes: int = 1) -> DataFrame:
    """queries (qid, idx) that name rows of ``vectors``; the row itself is left out."""
    named = queries.select("qid", F.col("idx").alias("self")).join(vectors.select(F.col("idx").alias("self"), "vec"), "self")
    return query_by_vector(index, named, k, block_rows, probes)


def lsh_topk(queries: DataFrame, vectors: DataFrame, planes: np.ndarray, positions, k: int = 3,
             block_rows: int = BLOCK_ROWS, probes: int = 1) -> DataFrame:
    """Fit on ``vectors`` (idx, vec) and answer ``queries`` (qid, idx)."""
    return query(fit(vectors, planes, positions), queries, vectors, k=k, block_rows=block_rows, probes=probes)
