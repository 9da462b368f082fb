import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import lsh, neighbours, spatial


def _sphere_brute(P, Q):
    out = {}
    for qid, qla, qlo in Q:
        best = None
        for pid, pla, plo in P:
            a = (math.sin(math.radians(pla - qla) / 2) ** 2
                 + math.cos(math.radians(qla)) * math.cos(math.radians(pla)) * math.sin(math.radians(plo - qlo) / 2) ** 2)
            d = 2 * math.asin(math.sqrt(min(a, 1.0)))
            key = (round(d, 9), pid)
            if best is None or key < best:
                best = key
        out[qid] = best[1]
    return out


def test_sphere_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    # clustered points plus poles and the antimeridian
    P = [(i, float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for i in range(300)]
    P += [(1000 + i, 40 + float(rng.normal(0, 0.5)), 10 + float(rng.normal(0, 0.5))) for i in range(200)]
    P += [(2000, 90.0, 0.0), (2001, -90.0, 45.0), (2002, 0.0, 179.999), (2003, 0.0, -180.0)]
    Q = [(i, float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for i in range(150)]
    Q += [(500, 89.9, -170.0), (501, -89.95, 100.0), (502, 0.0, -179.999), (503, 40.0, 10.0)]
    pdf = spark.createDataFrame(P, "id long, latitude double, longitude double")
    qdf = spark.createDataFrame(Q, "qid long, latitude double, longitude double")
    got = {r.qid: r.id for r in spatial.nearest_on_sphere(pdf, qdf).collect()}
    assert got == _sphere_brute(P, Q)


def test_sphere_nearest_with_sparse_points(spark):
    # far fewer points than cells the grid would need: stage 2 must widen
    P = [(1, 10.0, 10.0), (2, -60.0, -120.0)]
    Q = [(1, 80.0, 170.0), (2, -10.0, 100.0), (3, 10.0, 10.0)]
    pdf = spark.createDataFrame(P, "id long, latitude double, longitude double")
    qdf = spark.createDataFrame(Q, "qid long, latitude double, longitude double")
    got = {r.qid: r.id for r in spatial.nearest_on_sphere(pdf, qdf, level=6).collect()}
    assert got == _sphere_brute(P, Q)


def test_plane_variants_agree_with_brute_force(spark):
    rng = np.random.default_rng(5)
    P = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(0, 5000, size=(800, 2)))]
    P += [(900, 100.0, 100.0), (901, 100.0, 100.0)]     # duplicate location: smaller id wins
    Q = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(-1000, 6000, size=(120, 2)))]
    Q += [(999, 100.0, 100.0)]
    pdf = spark.createDataFrame(P, "id long, easting double, northing double")
    qdf = spark.createDataFrame(Q, "qid long, easting double, northing double")
    want = {}
    for qid, qx, qy in Q:
        want[qid] = min(((px - qx) ** 2 + (py - qy) ** 2, pid) for pid, px, py in P)[1]
    for res in (spatial.nearest_in_plane(pdf, qdf, form="direct"),
                spatial.nearest_in_plane(pdf, qdf, form="expanded"),
                neighbours.l2_nearest_batched(pdf, qdf, block_rows=64),
                neighbours.l2_nearest_batched(pdf.repartition(4), qdf)):
        assert {r.qid: r.id for r in res.collect()} == want
    assert want[999] == 900


def _vec_frames(spark, n=300, d=16, seed=11):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    X[5] = X[4]                      # duplicate vector: self is dropped by id only
    vecs = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(n)], "idx long, vec array<double>")
    qs = vecs.where(F.col("idx") < 40).select(F.col("idx").alias("qid"), "idx", "vec")
    return X, vecs, qs


def _cos_brute(X, qids, k):
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    out = {}
    for q in qids:
        s = np.round(U @ U[q], 6)
        order = sorted((-s[j], j) for j in range(len(X)) if j != q)
        out[q] = [j for _, j in order[:k]]
    return out


@pytest.mark.parametrize("pivots,block_rows", [(1, 32), (12, 16), (None, 16384), (300, 8)])
def test_cosine_topk_matches_brute_force(spark, pivots, block_rows):
    X, vecs, qs = _vec_frames(spark)
    res = neighbours.cosine_topk(qs, vecs.repartition(3), k=3, block_rows=block_rows, pivots=pivots).collect()
    got = {}
    for r in sorted(res, key=lambda r: (r.qid, r.rank)):
        got.setdefault(r.qid, []).append(r.idx)
    assert got == _cos_brute(X, range(40), 3)
    assert got[4][0] == 5                      # the duplicate is a neighbour, not "self"


def test_lsh_never_beats_exact_and_paths_agree(spark):
    X, vecs, qs = _vec_frames(spark)
    planes = lsh.plane_matrix(lsh.hyperplanes(spark, 8, X.shape[1], 1234))
    pos = lsh.bit_positions(4, 3, 8, 1234)
    index = lsh.fit(vecs.repartition(3), planes, pos)
    approx = lsh.query(index, qs, vecs, k=3, block_rows=16).collect()
    whole = lsh.query(index, qs, vecs, k=3).collect()
    assert sorted(tuple(r) for r in approx) == sorted(tuple(r) for r in whole)
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    bits = (X @ planes.T) > 0
    keys = [[tuple(b[p] for p in ps) for ps in pos] for b in bits]
    for q in range(40):
        cand = [j for j in range(len(X)) if j != q and any(a == b for a, b in zip(keys[q], keys[j]))]
        want = [j for _, j in sorted((-round(float(U[j] @ U[q]), 6), j) for j in cand)[:3]]
        assert [r.idx for r in sorted((r for r in approx if r.qid == q), key=lambda r: r.rank)] == want
    exact = {(r.qid, r.rank): r.sim for r in neighbours.cosine_topk(qs, vecs, k=3).collect()}
    assert approx
    for r in approx:
        assert r.sim <= exact[(r.qid, r.rank)] + 1e-9


def test_signature_sign_rule(spark):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0])], "idx long, vec array<double>")
    planes = np.array([[1.0, 0.0], [0.0, 1.0]])
    got = {r.idx: r.sig for r in lsh.signatures(vecs, planes).collect()}
    assert got == {1: "10", 2: "00", 3: "00"}     # strict: a zero dot is a 0 bit


def test_query_words_and_labels(spark):
    vecs = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [2.0])], "idx long, word string, vec array<double>")
    words = spark.createDataFrame([(10, "a"), (11, "zz")], "qid long, word string")
    assert [(r.qid, r.idx) for r in neighbours.query_vectors(words, vecs).collect()] == [(10, 1)]
    assert [(r.qid, r.word) for r in neighbours.unknown_words(words, vecs).collect()] == [(11, "zz")]
    found = spark.createDataFrame([(1, "x"), (2, "y")], "qid long, name string")
    exp = spark.createDataFrame([(1, "x"), (2, "z")], "qid long, label string")
    assert [tuple(r) for r in neighbours.label_mismatches(found, exp).collect()] == [(2, "y", "z")]
    c = neighbours.label_error_count(found, exp).collect()[0]
    assert (c.n_queries, c.n_errors) == (2, 1)


def test_grid_nn_with_copies_and_dense_cluster(spark):
    # A third of the points are copies of one location, another third sit in
    # a tiny cluster; the answers must equal brute force (ties -> smaller id).
    rng = np.random.default_rng(9)
    P = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1e6, size=(300, 2)))]
    P += [(1000 + i, 5e5, 5e5) for i in range(300)]
    P += [(2000 + i, 2e5 + float(dx), 7e5 + float(dy)) for i, (dx, dy) in enumerate(rng.uniform(0, 3, size=(300, 2)))]
    Q = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1e6, size=(60, 2)))]
    Q += [(100 + i, 5e5 + i, 5e5) for i in range(20)] + [(200 + i, 2e5 + i * 0.1, 7e5 + 1) for i in range(20)]
    pdf = spark.createDataFrame(P, "id long, easting double, northing double")
    qdf = spark.createDataFrame(Q, "qid long, easting double, northing double")
    want = {qid: min(((px - qx) ** 2 + (py - qy) ** 2, pid) for pid, px, py in P)[1] for qid, qx, qy in Q}
    assert {r.qid: r.id for r in spatial.nearest_in_plane(pdf, qdf).collect()} == want
    assert want[100] == 1000


def test_vector_expressions(spark):
    from quarry.functions.vectors import dot, l2_direct, norm, normalize
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    r = df.select(dot(F.col("a"), F.col("b")).alias("d"), l2_direct(F.col("a"), F.col("b")).alias("l"),
                  norm(F.col("a")).alias("n"), normalize(F.col("a")).alias("u")).collect()
    assert (r[0].d, r[0].n, r[0].u) == (4.0, 5.0, [0.6, 0.8])
    assert r[0].l == pytest.approx(math.sqrt(9 + 9))
    assert r[1].u is None                     # zero vector: NULL, not a division error


def test_cluster_conf_sizes_with_cores():
    from quarry.session import cluster_conf
    c = cluster_conf(8000)
    assert c["spark.sql.shuffle.partitions"] == "24000"
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 * 1024


@pytest.mark.parametrize("below", [0, 99])
def test_pruning_depth_never_changes_answers(spark, monkeypatch, below):
    monkeypatch.setattr(spatial, "TIGHTEN_BELOW", below)
    rng = np.random.default_rng(13)
    P = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1e5, size=(200, 2)))]
    P += [(500 + i, 5e4 + float(dx), 5e4 + float(dy)) for i, (dx, dy) in enumerate(rng.uniform(0, 2, size=(200, 2)))]
    Q = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1e4, 1.1e5, size=(40, 2)))]
    pdf = spark.createDataFrame(P, "id long, easting double, northing double")
    qdf = spark.createDataFrame(Q, "qid long, easting double, northing double")
    want = {qid: min(((px - qx) ** 2 + (py - qy) ** 2, pid) for pid, px, py in P)[1] for qid, qx, qy in Q}
    assert {r.qid: r.id for r in spatial.nearest_in_plane(pdf, qdf).collect()} == want


def test_queries_without_a_place_are_answered_with_null(spark):
    nan, P = float("nan"), [(1, 10.0, 10.0), (2, -60.0, -120.0), (3, float("nan"), 5.0), (4, None, 5.0)]
    Q = [(1, None, 10.0), (2, nan, 10.0), (3, 9.0, 9.0), (4, 5.0, None)]
    pdf = spark.createDataFrame(P, "id long, latitude double, longitude double")
    qdf = spark.createDataFrame(Q, "qid long, latitude double, longitude double")
    got = {r.qid: (r.id, r.dist) for r in spatial.nearest_on_sphere(pdf, qdf).collect()}
    assert got.keys() == {1, 2, 3, 4} and got[1] == got[2] == got[4] == (None, None) and got[3][0] == 1
    plane = pdf.toDF("id", "easting", "northing"), qdf.toDF("qid", "easting", "northing")
    for res in (spatial.nearest_in_plane(*plane), spatial.nearest_in_plane(*plane, form="expanded"), neighbours.l2_nearest_batched(*plane)):
        got = [(r.qid, r.id) for r in res.collect()]
        assert sorted(got) == [(1, None), (2, None), (3, 1), (4, None)]
    none = spatial.nearest_in_plane(plane[0].limit(0), plane[1]).collect()
    assert sorted((r.qid, r.id, r.dist) for r in none) == [(i, None, None) for i in (1, 2, 3, 4)]


def test_l2_in_any_dimension_matches_brute_force(spark):
    X, vecs, qs = _vec_frames(spark)
    q = qs.select("qid", F.col("idx").alias("self"), "vec")
    got = {r.qid: (r.idx, r.dist) for r in neighbours.l2_nearest_vectors(q, vecs, block_rows=16, pivots=20).collect()}
    for i in range(40):
        d = np.linalg.norm(X - X[i], axis=1)
        want = min((d[j], j) for j in range(len(X)) if j != i)
        assert got[i][0] == want[1] and abs(got[i][1] - want[0]) < 1e-6


def test_dimension_mismatch_fails_clearly(spark):
    _, vecs, _ = _vec_frames(spark)
    q = spark.createDataFrame([(1, None, [1.0, 2.0])], "qid long, self long, vec array<double>")
    with pytest.raises(Exception, match="a query vector of dimension 2, expected 16"):
        neighbours.l2_nearest_vectors(q, vecs).collect()


def test_pivots_prune_and_blocks_stay_bounded(spark):
    # Two far clusters: a query of one never visits the cells of the other.
    from quarry.operators.blocked import PivotIndex, exact_topk
    rng = np.random.default_rng(2)
    X = np.concatenate([rng.normal(0, 1, size=(200, 4)), rng.normal(1000, 1, size=(200, 4))])
    data = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, vec array<double>")
    index = PivotIndex(data, 8)
    assert index.count.sum() == 400 and index.radius.max() < 100
    q = data.where("id < 20").select("id", F.lit(None).cast("long").alias("self"), "vec")
    got = {r.qid: (r.rid, r["rank"]) for r in exact_topk(index, q, 1).collect()}
    assert got == {i: (i, 1) for i in range(20)}


def test_search_keeps_k_best_whatever_the_number_of_batches():
    # One block, many Arrow batches of queries: memory holds the block and a batch.
    import tracemalloc

    import pyarrow as pa

    from quarry.operators.blocked import _stream_fn
    rng = np.random.default_rng(4)

    def batch(side, ids):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(["c"] * n), pa.array([0] * n, pa.int32()), pa.array([side] * n, pa.int32()), pa.array(ids, pa.int64()),
             pa.array([None] * n, pa.int64()), pa.array(list(rng.normal(size=(n, 8))), pa.list_(pa.float64()))],
            names=["g", "b", "side", "id", "self", "vec"])

    def peak(batches):
        tracemalloc.start()
        rows = sum(r.num_rows for r in _stream_fn(2, "l2", None)(
            x for k in range(batches) for x in ([batch(0, range(500))] if k == 0 else [batch(1, range(200))])))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return rows, top

    few, many = peak(6), peak(60)
    assert (few[0], many[0]) == (5 * 400, 59 * 400)
    assert many[1] < 1.5 * few[1]


def test_far_outlier_leaves_no_crowded_cell(spark):
    rng = np.random.default_rng(21)
    P = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1000, size=(20_000, 2)))] + [(99_999, 5e8, 5e8)]
    Q = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-100, 1100, size=(30, 2)))] + [(100, 4e8, 4e8), (101, 1e6, 1e6)]
    pdf = spark.createDataFrame(P, "id long, easting double, northing double")
    qdf = spark.createDataFrame(Q, "qid long, easting double, northing double")
    index = spatial.plane_index(pdf)
    assert index.pts.groupBy("ci", "cj").count().agg(F.max("count")).first()[0] <= spatial.LEAF
    A = np.array([p[1:] for p in P])
    want = {q: P[int(((A - (x, y)) ** 2).sum(axis=1).argmin())][0] for q, x, y in Q}
    assert {r.qid: r.id for r in spatial.nearest_in_plane(pdf, qdf).collect()} == want


def test_sphere_cell_bound_never_exceeds_a_distance(spark):
    rng = np.random.default_rng(8)
    geom = spatial.Geometry("sphere", 5, 32, 64, True)
    rows = [(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(rng.uniform(-90, 90, 4000), rng.uniform(-180, 180, 4000),
                                                                          rng.uniform(-90, 90, 4000), rng.uniform(-180, 180, 4000))]
    df = spark.createDataFrame(rows, "qa double, qb double, pa double, pb double")
    ci, cj = geom.cells(F.col("pa"), F.col("pb"))
    df = df.withColumns({"ci": ci, "cj": cj})
    for s in (0, 2):
        cells = df.withColumns({"ci": F.shiftright("ci", s), "cj": F.shiftright("cj", s)})
        gap = cells.select((geom.dist(F.col("qa"), F.col("qb"), F.col("pa"), F.col("pb"))
                            - geom.cell_lower_bound(F.col("qa"), F.col("qb"), F.col("ci"), F.col("cj"), s)).alias("g"))
        assert gap.agg(F.min("g")).first()[0] > -1e-9


def _search_batch(g, cells, rng):
    """Rows of one block as the search gets them: 300 data rows in 3 cells, then 20 queries that name cells."""
    import pyarrow as pa
    X, Q = rng.normal(size=(300, 8)), rng.normal(size=(20, 8))
    n = 320
    return X, Q, pa.RecordBatch.from_arrays(
        [pa.array([g] * n), pa.array(np.zeros(n, np.int32)), pa.array(np.r_[np.zeros(300, np.int32), np.ones(20, np.int32)]),
         pa.array(np.r_[np.repeat([4, 5, 6], 100), np.zeros(20)].astype(np.int32)), pa.array(np.r_[np.arange(300), np.arange(20)]), pa.nulls(n, pa.int64()),
         pa.array([None] * 300 + [9.0] * 20, pa.float64()), pa.array([None] * 300 + [cells] * 20, pa.list_(pa.int32())), pa.array([list(map(float, v)) for v in np.r_[X, Q]])],
        names=["g", "b", "side", "cell", "id", "self", "bound", "cells", "vec"])


def test_a_query_meets_its_cells_of_a_block_within_its_bound():
    from quarry.operators.blocked import _stream_fn
    X, Q, batch = _search_batch("0", [4, 6], np.random.default_rng(8))
    got = {}
    for b in _stream_fn(3, "l2", None)([batch]):
        for r in b.to_pylist():
            got.setdefault(r["qid"], set()).add(r["rid"])
    want = {}
    for i, q in enumerate(Q):
        d = ((X - q) ** 2).sum(axis=1)
        near = {int(j) for part in (range(100), range(200, 300)) for j in sorted(part, key=lambda j: d[j])[:3] if d[j] <= 9.0}
        if near:
            want[i] = near
    assert got == want


def test_a_query_is_sent_once_to_a_group_of_cells(spark, monkeypatch):
    # one row per query and cell, a whole batch at a time, held up to 256 copies of a batch of vectors
    from quarry.operators import blocked
    rng = np.random.default_rng(12)
    data = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=24)]) for i in range(2000)], "id long, vec array<double>")
    index = blocked.PivotIndex(data, 200)
    assert index.groups().max() + 1 <= 2 * blocked.GROUPS
    assert (np.diff(index.groups()) >= 0).all()
    sent, search = [], blocked.search_blocks
    monkeypatch.setattr(blocked, "search_blocks", lambda d, q, *a, **k: (sent.append(q), search(d, q, *a, **k))[1])
    q = data.where("id < 50").selectExpr("id", "id as self", "vec")
    assert blocked.exact_topk(index, q, 2).count() == 100
    assert sent[1].groupBy("g", "id").count().where("count > 1").count() == 0
    assert sent[1].count() <= 50 * (index.groups().max() + 1) < sent[1].selectExpr("sum(size(cells)) as n").first().n


def test_packed_vectors_are_exact():
    from quarry.operators.blocked import pack, unpack
    rng = np.random.default_rng(4)
    vecs = np.r_[rng.normal(size=(5, 6)), rng.normal(size=(5, 6)).astype(np.float32), np.full((1, 6), 1e300), np.zeros((1, 6))]
    packed = pack(vecs)
    assert (unpack(packed, 6) == vecs).all() and [len(x) for x in packed.to_pylist()] == [48] * 5 + [24] * 5 + [48, 24]
