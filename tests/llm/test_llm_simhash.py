import random
import re

import numpy as np
import pytest
from llmdata import awkward, empty
from xxhash import xxh64_intdigest

from quarry.llm import simhash
from quarry.llm.components import components


def naive_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def naive_components(fps, distance=3):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= distance:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def near_texts(n=40, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    out = [" ".join(base)] * 3
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
        out.append(" ".join(words))
    return out + [" ".join(f"y{rng.randrange(5000)}" for _ in range(50)) for _ in range(30)]


@pytest.mark.parametrize("hot", [simhash.HOT_CANDIDATES, 4])
def test_equals_brute_force_on_awkward_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_CANDIDATES", hot)   # 4: all but the smallest buckets go through blocks
    monkeypatch.setattr(simhash, "BLOCK", 8)
    docs = awkward(spark, near_texts())
    src = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(src)
    fps = [naive_fingerprint(r.text) for r in src]
    roots = naive_components(fps)
    want = sorted((r.doc_id is None, r.doc_id or 0, fp, min((s.doc_id for s, q in zip(src, roots) if q == x and s.doc_id is not None), default=None))
                  for r, fp, x in zip(src, fps, roots))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp % 2**64, r.component_id) for r in got) == want
    assert len(set(roots)) < len(src) - 10


def test_one_document_of_each_group_stays(spark):
    docs = awkward(spark, near_texts(10))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    near = simhash.near_duplicates(docs).collect()
    groups = {r.component for r in near}
    assert kept.count() == len(groups)
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {r.component_id for r in near if r.component_id is not None}


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.keep_one(empty(spark)).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_all_links_are_found_by_unequal_thresholds(spark, distance):
    rng = np.random.default_rng(7)
    # half of the bits are tied together, so that partitions differ in selectivity
    tied = np.repeat(rng.integers(0, 2, size=(300, 1)), 32, axis=1)
    bits = np.concatenate([tied, rng.integers(0, 2, size=(300, 32))], axis=1)
    flips = rng.random(bits.shape) < 0.03
    bits = np.concatenate([bits, bits ^ flips])
    fps = sorted({int(x) for x in np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<i8").ravel()})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {(a, b) for i, b in enumerate(fps) for a in fps[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= distance and a != b}
    for parts in (None, [(list(range(0, 40)), 1), (list(range(40, 64)), distance - 2)] if distance >= 3 else None):
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(df, distance, parts).collect()}
        assert got == want


def test_thresholds_are_allocated_by_cost():
    cost, ts = simhash.allocate([[1, 5, 50], [10, 100, 1000], [10, 100, 1000]], 0)
    assert sum(ts) == 0 and (cost, ts) == (15, [1, -1, 0])
    cost, ts = simhash.allocate([[1, 2, 3], [10, 100, 1000]], 1)
    assert (cost, ts) == (3, [2, -1])   # the expensive partition is not probed at all
    both = np.full((64, 64), 25.0)   # independent bits, but for two that go together
    np.fill_diagonal(both, 50)
    both[3, 60] = both[60, 3] = 50
    groups = simhash.group_bits(both, 100, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({3, 60} <= set(g) for g in groups)


def test_forest_spans_without_listing_pairs():
    rng = np.random.default_rng(3)
    centre = 0x0123456789ABCDEF
    fps = np.array(sorted({centre ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(3000)}), dtype=np.uint64).view(np.int64)
    a, b = simhash.spanning_forest(fps, 4)
    assert len(a) == len(fps) - 1
    a, b = simhash.spanning_forest(np.array([0, 7, 15, 31 << 55]), 3)
    assert {(int(x), int(y)) for x, y in zip(a, b)} == {(0, 7), (7, 15)}


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
