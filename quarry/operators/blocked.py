"""Exact top-k of vectors through pivot cells, one plan at every size.

Index: every data row goes to the cell of its nearest pivot (a bounded,
hash-chosen set of data rows); a cell keeps its row count and radius.  Cells
are searched in blocks of bounded size.

Query: (1) a query first searches the cell of the nearest pivot, which gives
it k rows and so a bound on its k-th distance; (2) by the triangle
inequality a cell can only hold a better row if the distance to its pivot
less its radius is within the bound, and only such cells are searched.
Small cells share a group, and a query goes to a group once, with the list of
its cells there and its bound: only rows within the bound leave the search.
All meetings are on (group, block).

A block is searched by :func:`search_blocks`: sorted rows stream through one
task, the block's data rows first and then its queries, so that memory holds
one block and one Arrow batch whatever the number of queries, and each query
leaves at most k rows per block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path

BLOCK_ROWS = 16384
MAX_PIVOTS = 256
GROUPS = 64             # groups of cells: a query is sent to so many at most, and to a block each of larger cells
SCORES = 1 << 21        # scores held at a time
COPIES = 1 << 22        # bytes of query vectors passed on at a time


def _top_rows(key: np.ndarray, ids: np.ndarray, k: int):
    """Per row of ``key`` (lower is better), the k best columns, ties to the
    smaller id.  Returns (row index, column index) arrays."""
    n, m = key.shape
    if m == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    kk = min(k, m)
    kth = np.partition(key, kk - 1, axis=1)[:, kk - 1]
    rows, cols = np.nonzero((key <= kth[:, None]) & np.isfinite(key))
    if rows.size == 0:
        return rows, cols
    order = np.lexsort((ids[cols], key[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    # rank within row
    start = np.r_[0, np.flatnonzero(np.diff(rows)) + 1]
    counts = np.diff(np.r_[start, rows.size])
    rank = np.arange(rows.size) - np.repeat(start, counts)
    keep = rank < k
    return rows[keep], cols[keep]


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1)


def pack(vecs: np.ndarray) -> pa.Array:
    """One binary value per row: four bytes a component where that loses nothing, else eight."""
    with np.errstate(over="ignore"):
        short = vecs.astype("<f4")
    exact = (short == vecs).all(axis=1)
    return pa.array([short[i].tobytes() if ok else vecs[i].astype("<f8").tobytes() for i, ok in enumerate(exact)], pa.binary())


def unpack(column: pa.Array, dim: int) -> np.ndarray:
    out = np.empty((len(column), dim))
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for kind, width in (("<f4", 4 * dim), ("<f8", 8 * dim)):
        at = np.flatnonzero(size == width)
        if len(at):
            out[at] = np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), kind).reshape(len(at), dim)
    return out


def score_block(Q, X, xid, sid, k: int, metric: str, digits: int | None, bound=None):
    """(query row, data row, score) of the k best data rows of each query.

    ``bound``: no row whose score is worse is wanted (all-infinite: none known)."""
    G = Q @ X.T
    if metric != "dot":
        G *= -2.0
        G += np.einsum("ij,ij->i", Q, Q)[:, None]
        G += np.einsum("ij,ij->i", X, X)[None, :]
        np.maximum(G, 0.0, out=G)
    if bound is not None and np.isfinite(bound).all():
        r, c = np.nonzero(G >= bound[:, None] if metric == "dot" else G <= bound[:, None])
        if sid is not None:
            other = sid[r] != xid[c]
            r, c = r[other], c[other]
        score = G[r, c]
        key = np.round(score, digits) if digits is not None else score
        order = np.lexsort((xid[c], -key if metric == "dot" else key, r))
        r, c, score = r[order], c[order], score[order]
        start = np.searchsorted(r, r)
        keep = np.arange(len(r)) - start < k
        return r[keep], c[keep], score[keep]
    key = np.round(G, digits) if digits is not None else G
    if metric == "dot":
        key = -key
    if sid is not None:
        key = np.where(sid[:, None] == xid[None, :], np.inf, key)
    r, c = _top_rows(key, xid, k)
    return r, c, G[r, c]


def _stream_fn(k: int, metric: str, digits: int | None, dim: int | None = None, chunk: int = 256):
    """mapInArrow body over rows sorted by (g, b, side, cell): data rows of a block, then its queries."""
    def vectors(column):
        if dim is None:
            return _matrix(column)
        vecs = unpack(column, dim)
        return vecs / np.sqrt(np.einsum("ij,ij->i", vecs, vecs))[:, None]

    def parts(block, cells):
        """(queries, data rows) that meet: by cell, or all."""
        X, ids, cell = block
        if cells.null_count:
            yield np.arange(len(cells)), slice(0, len(ids))
            return
        flat = cells.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
        for c in sorted(set(flat.tolist())):
            a, z = np.searchsorted(cell, [c, c + 1])
            if a < z:
                yield owner[flat == c], slice(int(a), int(z))

    def run(batches):
        current, held, block = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column("g").to_numpy(zero_copy_only=False)
            at = b.column("b").to_numpy(zero_copy_only=False)
            side = b.column("side").to_numpy(zero_copy_only=False)
            n = b.num_rows
            cell, worst, cells = np.zeros(n, np.int32), np.full(n, np.inf), pa.nulls(n, pa.list_(pa.int32()))
            if "cells" in b.schema.names:
                cell, cells = b.column("cell").to_numpy(zero_copy_only=False), b.column("cells")
                worst = b.column("bound").fill_null(math.inf).to_numpy(zero_copy_only=False)
            rid = b.column("id").to_numpy(zero_copy_only=False)
            sid = b.column("self").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (at[1:] != at[:-1]) | (side[1:] != side[:-1])) + 1
            out = []
            for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(g)], strict=True):
                key = (g[a], at[a])
                if key != current:
                    current, held, block = key, [], None
                vecs = vectors(b.column("vec").slice(a, z - a))
                if side[a] == 0:
                    held.append((vecs, rid[a:z], cell[a:z]))
                    continue
                if block is None:
                    if not held:
                        continue
                    block, held = tuple(map(np.concatenate, zip(*held, strict=True))), []
                for some, rows in parts(block, cells.slice(a, z - a)):
                    X, ids = block[0][rows], block[1][rows]
                    step = max(1, min(chunk, SCORES // len(ids)))
                    for s in range(0, len(some), step):
                        q = some[s:s + step]
                        r, c, score = score_block(vecs[q], X, ids, sid[a + q], k, metric, digits, worst[a + q])
                        out.append((rid[a + q[r]], ids[c], score))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[i] for x in out]), t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                    names=["qid", "rid", "score"])
    return run


def search_blocks(data: DataFrame, queries: DataFrame, k: int, metric: str, digits: int | None,
                  block_rows: int = BLOCK_ROWS, dim: int | None = None) -> DataFrame:
    """(qid, rid, score): for every query, the k best rows of each block of its group.

    data (g string, id, vec); queries (g, id, self, vec), ``self`` being an
    id to leave out or NULL.  A group of any size is cut into blocks of about
    ``block_rows`` by a hash of the id.  With ``cell`` in the data and
    ``cells`` and ``bound`` in the queries, a query meets only those cells of its
    group and leaves only rows within its bound (k best of each).  ``dim``: the
    vectors are packed, and compared as unit vectors.
    """
    spark = data.sparkSession
    # written, so that its size is known and no vector is shuffled to the join
    path = scratch_path(spark, "block-sizes")
    data.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("n")).write.parquet(path)
    sizes = spark.read.schema("g string, n int").parquet(path)
    none = F.lit(None)
    cell = F.col("cell") if "cell" in data.columns else F.lit(0)
    cells, bound = (F.col("cells"), F.col("bound")) if "cells" in queries.columns else (none, none)
    d = data.join(sizes, "g").select("g", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("b"), F.lit(0).alias("side"), cell.alias("cell"),
                                     F.col("id").cast("bigint").alias("id"), none.cast("bigint").alias("self"),
                                     none.cast("double").alias("bound"), none.cast("array<int>").alias("cells"), "vec")
    q = queries.join(sizes, "g").select("g", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("b"), F.lit(1).alias("side"), F.lit(0).alias("cell"),
                                        F.col("id").cast("bigint").alias("id"), F.col("self").cast("bigint").alias("self"),
                                        bound.cast("double").alias("bound"), cells.cast("array<int>").alias("cells"), "vec")
    both = d.unionByName(q).repartition("g", "b").sortWithinPartitions("g", "b", "side", "cell", "id")
    return both.mapInArrow(_stream_fn(k, metric, digits, dim), "qid long, rid long, score double")


def _best(rows: DataFrame, k: int, metric: str, digits: int | None) -> DataFrame:
    """``rows`` with their rank per query, the first k."""
    key = F.round("score", digits) if digits is not None else F.col("score")
    w = Window.partitionBy("qid").orderBy(key.desc() if metric == "dot" else key.asc(), F.col("rid").asc())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _to_pivots(pivots: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    sq = np.einsum("ij,ij->i", vecs, vecs)[:, None] - 2.0 * vecs @ pivots.T + np.einsum("ij,ij->i", pivots, pivots)[None, :]
    return np.sqrt(np.maximum(sq, 0.0))


def checked_dim(vec, dim: int, what: str):
    """``vec``, failing with a clear message where it has another dimension."""
    wrong = F.raise_error(F.concat(F.lit(f"{what} of dimension "), F.size(vec).cast("string"), F.lit(f", expected {dim}")))
    return F.when(F.size(vec) == dim, vec).otherwise(wrong)


class PivotIndex:
    """Data rows by pivot cell, written once to the shared folder."""

    def __init__(self, data: DataFrame, pivots: int | None = None, path: str | None = None):
        """data (id, vec): no NULL vector, no NaN."""
        spark = data.sparkSession
        self.n, self.dim = (lambda r: (r["n"], r["d"] or 0))(data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first())
        m = max(1, min(pivots or int(math.sqrt(self.n) / 4), MAX_PIVOTS))
        # at most MAX_PIVOTS vectors reach the driver
        chosen = data.orderBy(F.xxhash64("id"), "id").limit(m).select("vec").collect() if self.n else []
        self.pivots = P = np.array([r["vec"] for r in chosen], dtype=np.float64).reshape(len(chosen), self.dim)

        def assign(batches):
            for b in batches:
                if b.num_rows:
                    d = _to_pivots(P, _matrix(b.column("vec")))
                    cell = d.argmin(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell]), b.column("id"), b.column("vec")],
                        names=["cell", "dist", "id", "vec"])

        path = path or scratch_path(spark, "pivot-index")
        rows = data.select(F.col("id").cast("bigint").alias("id"), checked_dim(F.col("vec"), self.dim, "a data vector").alias("vec"))
        rows.mapInArrow(assign, "cell int, dist double, id long, vec array<double>").write.mode("overwrite").parquet(path)
        self.rows = spark.read.schema("cell int, dist double, id long, vec array<double>").parquet(path)
        self.count, self.radius = np.zeros(max(1, len(P))), np.zeros(max(1, len(P)))
        for r in self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("r")).collect():
            self.count[r["cell"]], self.radius[r["cell"]] = r["n"], r["r"]

    def groups(self, block_rows: int = BLOCK_ROWS) -> np.ndarray:
        """The group of each cell: neighbours in order, up to a block's rows and the ``GROUPS``-th part of all."""
        most = min(block_rows, self.n / GROUPS)
        out, at, rows = np.zeros(len(self.count), np.int64), 0, 0.0
        for c, n in enumerate(self.count):
            if rows and rows + n > most:
                at, rows = at + 1, 0.0
            out[c], rows = at, rows + n
        return out


def exact_topk(index: PivotIndex, queries: DataFrame, k: int, metric: str = "l2", digits: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact k nearest rows per query: (qid, rid, score, rank).

    queries (id, self, vec).  ``metric`` ``l2``: score is the squared
    distance, smaller first; ``dot``: both sides are unit vectors, larger
    first.  Scores are compared after rounding to ``digits``; ties go to the
    smaller id.  A vector of another dimension than the index's fails.
    """
    P, count, radius, dim = index.pivots, index.count, index.radius, index.dim
    roomy = np.flatnonzero(count > k)  # one row more than k: the query's own may be among them
    q = queries.select(F.col("id").cast("bigint").alias("id"), F.col("self").cast("bigint").alias("self"),
                       checked_dim(F.col("vec"), index.dim, "a query vector").alias("vec"))
    slack = 10.0 ** -digits if digits is not None else 0.0
    group = index.groups(block_rows)

    def home(batches):
        for b in batches:
            if b.num_rows and len(P):
                d = _to_pivots(P, _matrix(b.column("vec")))
                cell = roomy[d[:, roomy].argmin(axis=1)] if len(roomy) else np.full(len(d), -1)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *(b.column(c) for c in ("id", "self", "vec"))],
                                                 names=["cell", "id", "self", "vec"])

    def others(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d = _to_pivots(P, _matrix(b.column("vec")))
            kth = b.column("kth").fill_null(math.nan).to_numpy(zero_copy_only=False)
            if metric == "dot":
                bound = np.sqrt(np.maximum(2.0 - 2.0 * (kth - slack), 0.0))
            else:
                bound = np.sqrt(np.maximum(kth + slack, 0.0))
            bound = np.where(np.isnan(kth), np.inf, bound * (1 + 1e-9) + 1e-7)
            near = (d - radius[None, :len(P)] <= bound[:, None]) & (count[None, :len(P)] > 0)
            cell = b.column("cell").to_numpy(zero_copy_only=False)
            near[np.arange(len(cell))[cell >= 0], cell[cell >= 0]] = False
            # rows that are worse than the k-th found cannot count; equal ones may, by their id
            worst = kth - slack * 1.01 - 1e-9 if metric == "dot" else (kth + slack * 1.01) * (1 + 1e-9) + 1e-12
            worst = pa.array(np.where(np.isnan(kth), np.inf, worst))
            step = max(1, COPIES // (8 * max(1, dim) * (group.max() + 1)))
            for a in range(0, len(near), step):
                r, c = np.nonzero(near[a:a + step])
                # cells of a group are neighbours in order: one row per query and group
                new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (group[c[1:]] != group[c[:-1]])]) if len(r) else r
                take = pa.array(a + r[new])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(r)], pa.int32()), pa.array(c, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(group[c[new]], pa.int32()), *(b.column(x).take(take) for x in ("id", "self", "vec")),
                                                  worst.take(take), lists], names=["grp", "id", "self", "vec", "bound", "cells"])

    schema = "cell int, id long, self long, vec array<double>"
    of = F.array(*[F.lit(int(x)) for x in group])
    data = index.rows.select(F.get(of, F.col("cell")).cast("string").alias("g"), "cell", "id", "vec")

    def search(qs: DataFrame) -> DataFrame:
        return search_blocks(data, qs.select(F.col("grp").cast("string").alias("g"), "id", "self", "vec", "bound", "cells"), k, metric, digits, block_rows)

    spark = q.sparkSession
    path = scratch_path(spark, "pivot-search")
    q.mapInArrow(home, schema).write.parquet(f"{path}/queries")
    at_home = spark.read.schema(schema).parquet(f"{path}/queries")
    in_home = at_home.where("cell >= 0").select(F.get(of, F.col("cell")).alias("grp"), "id", "self", "vec", F.lit(None).cast("double").alias("bound"),
                                                F.array("cell").alias("cells"))
    _best(search(in_home), k, metric, digits).drop("rank").write.parquet(f"{path}/first")
    first = spark.read.schema("qid long, rid long, score double").parquet(f"{path}/first")
    last = F.min("score") if metric == "dot" else F.max("score")
    bound = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, last).alias("kth"))
    rest = at_home.join(bound, at_home.id == bound.qid, "left").select("cell", "id", "self", "vec", "kth").mapInArrow(
        others, "grp int, id long, self long, vec array<double>, bound double, cells array<int>")
    return _best(first.unionByName(search(rest)), k, metric, digits)
