"""Multi-probe search: which buckets are visited, and how many true neighbours are found."""
import numpy as np

from quarry import registry
from quarry.operators import lsh

SF = "/root/testdata/sf0.1"


def test_probes_are_the_nearest_buckets():
    rng = np.random.default_rng(1)
    dots, pos = rng.normal(size=(50, 9)), [4, 1, 4, 7, 2]
    got = lsh.probe_bits(dots, pos, 6)
    planes = [4, 1, 7, 2]
    for row, d in zip(got, dots):
        cost = {}
        for mask in range(16):
            flip = {p for i, p in enumerate(planes) if mask >> i & 1}
            cost["".join("01"[bool(d[p] > 0) != (p in flip)] for p in pos)] = sum(d[p] ** 2 for p in flip)
        assert ["".join("01"[int(x)] for x in bits) for bits in row] == sorted(cost, key=cost.get)[:6]
    assert (lsh.probe_bits(dots, pos, 1)[:, 0] == (dots[:, pos] > 0)).all()
    assert lsh.probe_bits(dots, pos, 100).shape == (50, 16, 5)


def test_many_planes_flip_the_nearest_only(monkeypatch):
    monkeypatch.setattr(lsh, "FLIPS", 3)
    dots = np.array([[0.9, -0.1, 0.2, 0.3, -0.8]])
    got = {"".join("01"[int(x)] for x in bits) for bits in lsh.probe_bits(dots, [0, 1, 2, 3, 4], 99)[0]}
    assert len(got) == 8 and all(s[0] == "1" and s[4] == "0" for s in got)


def test_recall_of_the_registered_search(spark):
    vectors = registry._vectors(spark, SF)
    queries = registry._query_vectors(spark, SF)
    exact, approx = ({(r.qid, r.idx) for r in registry.REGISTRY[k](spark, SF).select("qid", "idx").collect()} for k in ("cosine_top3", "lsh_top3"))
    recall = len(exact & approx) / len(exact)
    planes, positions = registry._lsh_params(spark, vectors)
    named = queries.select("qid", queries.idx.alias("self")).join(vectors.select(vectors.idx.alias("self"), "vec"), "self")
    index = lsh.fit(vectors, planes, positions)
    work = lsh.candidate_rows(index, named, registry.LSH_PROBES).agg({"n_candidates": "avg"}).first()[0] / vectors.count()
    single = {(r.qid, r.idx) for r in lsh.query(index, queries, vectors).select("qid", "idx").collect()}
    print(f"recall@3 {recall:.3f}, rows compared per query {work:.2f} of the table; one bucket a table: recall {len(exact & single) / len(exact):.3f}")
    assert recall >= 0.9 > len(exact & single) / len(exact)


def test_more_probes_never_lose_a_neighbour(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 12))
    vecs = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "idx long, vec array<double>")
    qs = spark.createDataFrame([(i, i) for i in range(30)], "qid long, idx long")
    planes = lsh.plane_matrix(lsh.hyperplanes(spark, 10, 12, 7))
    index = lsh.fit(vecs, planes, lsh.bit_positions(2, 6, 10, 7))
    best = [{r.qid: r.sim for r in lsh.query(index, qs, vecs, k=1, probes=p).collect()} for p in (1, 4, 64)]
    assert all(best[1].get(q, -2) >= s for q, s in best[0].items()) and all(best[2][q] >= s for q, s in best[1].items())
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    S = U @ U.T - 3 * np.eye(300)
    assert best[2] == {q: round(float(S[q].max()), 6) for q in range(30)}   # every bucket of a table is every row
