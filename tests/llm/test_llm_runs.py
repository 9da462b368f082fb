import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMOKE
from hypothesis import given, settings
from hypothesis import strategies as st
from llmdata import awkward, empty

from quarry.llm import runs


def brute(w):
    """All runs by their definition: every period, every stretch, smallest period of each."""
    n, found = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(s, s + length - p)) for p in range(1, q)):
                found.add((s, length, q))
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    w = []
    for _ in range(rng.randrange(1, 8)):
        root = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.choice((1, 2, 3, 7, 9, 16, 17, 31, 32, 33, 40, 65)))]
        if rng.random() < 0.4:
            root = root * rng.randrange(1, 5)
        stretch = (root * 12)[:rng.randrange(1, 7 * len(root) + 1)]
        if rng.random() < 0.3:
            stretch[rng.randrange(len(stretch))] = 99
        w += stretch
    assert runs.find_runs(np.array(w, dtype=np.int64)) == brute(w)


def test_every_period_and_length():
    rng = random.Random(5)
    for q in range(1, 140):
        root = [rng.randrange(1000) for _ in range(q)]
        for length in (4 * q - 1, 4 * q, 4 * q + 1, 5 * q - 1):
            w = [2000, *(root * 6)[:length], 2001]
            assert runs.find_runs(np.array(w, dtype=np.int64)) == brute(w), (q, length)


def test_texts_of_a_chunk_stay_apart(monkeypatch):
    monkeypatch.setattr(runs, "CHUNK", 40)
    rng = random.Random(1)
    texts = [[rng.choice((b"a", b"b")) for _ in range(rng.randrange(0, 30))] for _ in range(80)] + [[b"a"] * 500, [b"a", b"b"] * 40]
    assert runs.runs_of_texts(texts) == [brute(t) for t in texts]


def plain(doc_id, text):
    """The query's row, step by step as its contract says."""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_the_contract(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect() if len(r.text or "") < 12_000]
    rows += [(r.doc_id, r.text) for r in awkward(spark).collect() if r.text is None or len(r.text) < 12_000]
    rows += [(1000 + i, t) for i, t in enumerate(["a " * 100, "a b " * 100 + "c d e " * 9, " x\x1cy\x85z　q " * 8, "é\t東 \r" * 7, "w"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in runs.op11_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((plain(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > len(rows) // 20


@pytest.mark.parametrize("n", [200_000])
def test_long_periods_and_long_texts(spark, n):
    rng = random.Random(2)
    root = [f"w{rng.randrange(10**6)}" for _ in range(n // 5)]
    text = " ".join(["head", *root * 4, *root[:7], "tail"])
    got = runs.detect(spark.createDataFrame([(1, text), (2, "z " * n)], "doc_id long, text string")).collect()
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[1].runs] == [(1, 4 * len(root) + 7, len(root))]
    assert by_id[1].collapsed == " ".join(["head", *root, "tail"])
    assert [tuple(x) for x in by_id[2].runs] == [(0, n, 1)] and by_id[2].collapsed == "z"


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    got = runs.detect(docs, runs="r", collapsed="c", n_words="w")
    assert got.columns == [*docs.columns, "r", "c", "w"] and got.count() == docs.count()
    assert all((r.w, r.c, r.r) == (0, "", []) for r in got.collect() if not (r.text or "").strip())
    assert runs.detect(empty(spark), runs="r", collapsed="c", n_words="w").collect() == []
