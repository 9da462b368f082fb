"""Frequent keys, bitmap counts, phrase index: against plain Python."""
import random
from collections import Counter

import pytest
from conftest import SMOKE, rows
from pyspark.sql import functions as F

from quarry.operators import corpus, distinct, heavy, phrase_index
from quarry.plans.checks import plan_text
from quarry.registry import REGISTRY
from quarry.sources import fixtures as fx


def _skewed(seed=4, n=20_000):
    rng = random.Random(seed)
    return [(f"k{min(int(rng.paretovariate(0.7)), 3000)}", rng.randrange(1, 4)) for _ in range(n)]


@pytest.mark.parametrize("capacity", [1, 10, 200, 5000])
def test_every_key_is_within_the_bound(spark, capacity):
    data = _skewed()
    true = Counter()
    for k, w in data:
        true[k] += w
    df = spark.createDataFrame([*data, (None, 5), ("k1", None)], "k string, w long").repartition(7)
    parts = heavy.summaries(df, "k", "w", capacity)
    got = {r.key: (r.low, r.high) for r in heavy.merged(parts).collect()}
    error = parts.agg(F.sum("error")).first()[0]
    assert parts.agg(F.sum("total")).first()[0] == sum(true.values())
    assert error <= sum(true.values()) / (capacity + 1) and parts.where("key is not null").count() <= 7 * capacity
    assert all(low <= true[k] <= high for k, (low, high) in got.items())
    assert all(true[k] <= error for k in true if k not in got)


@pytest.mark.parametrize("share", [0.3, 0.02, 0.001])
def test_frequent_keys_are_exact(spark, share):
    data = _skewed(9)
    true = Counter()
    for k, w in data:
        true[k] += w
    df = spark.createDataFrame(data, "k string, w long").repartition(5)
    total = sum(true.values())
    assert {r.key: r.weight for r in heavy.frequent(df, "k", "w", share).collect()} == {k: n for k, n in true.items() if n > share * total}
    assert heavy.frequent(df.limit(0), "k", "w", share).collect() == []


def test_bitmap_counts(spark):
    rng = random.Random(2)
    data = [(rng.choice("ab"), rng.randrange(-70_000, 70_000)) for _ in range(5000)] + [("a", None), ("a", 2**62), ("b", -2**62)]
    df = spark.createDataFrame(data, "g string, k long")
    maps = distinct.bitmaps(df, F.col("k"), "g")
    want = {g: len({k for h, k in data if h == g and k is not None}) for g in "ab"}
    assert {r.g: r.n for r in distinct.count(maps, "g").collect()} == want
    assert distinct.count(distinct.rolled_up(maps)).first()[0] == len({k for _, k in data if k is not None})
    assert distinct.count(distinct.bitmaps(df.limit(0), F.col("k"))).first()[0] == 0


def test_texts_that_spell_integers_go_by_bitmap(spark):
    texts = ["1", "01", "+1", "1", "-5", "x", "", None, "99999999999999999999", "x", " 7", "7"]
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    assert distinct.count_texts(df, "u").first()[0] == len({t for t in texts if t is not None})


def test_tallies_read_the_log_once(spark):
    plan = plan_text(REGISTRY["auth_tallies"](spark, SMOKE))
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan


def test_approx_distinct_shuffles_no_keys(spark):
    from quarry.operators import sketch
    df = spark.range(50_000).selectExpr("id * 7 as k")
    plan = plan_text(sketch.approx_distinct(df, "k"))
    assert "keys=[k" not in plan
    assert all(r.low <= 50_000 <= r.high for r in sketch.approx_distinct(df, "k").collect())


def test_phrase_index_equals_a_scan(spark):
    files = fx.source_files(spark, SMOKE)
    index = phrase_index.build(files)
    some = files.where("length(content) > 200").limit(4).collect()
    wanted = ["the", "License", "SPDX-License-Identifier: GPL-2.0 */", "\n\n", "zzzz", "(GPL-2.0 OR", *[r.content[50:90] for r in some]]
    wanted = [p for p in wanted if len(p) >= 3]
    phrases = spark.createDataFrame([(p,) for p in [*wanted, None, "License"]], "phrase string")
    got = {r.phrase: r.n_files for r in phrase_index.counts(index, phrases).collect()}
    assert got == {p: corpus.grep_count(files, p).first().n_files for p in wanted}
    rare = spark.createDataFrame([(some[0].content[50:90],)], "phrase string")
    assert phrase_index.candidates(index, rare).count() < files.count() / 10
    with pytest.raises(Exception, match="three characters"):
        phrase_index.counts(index, spark.createDataFrame([("ab",)], "phrase string")).collect()


def test_phrase_index_of_odd_files(spark):
    files = spark.createDataFrame([("a", "abc"), ("b", None), ("c", ""), ("d", "ab"), ("e", "xabcabcx"), ("f", "a\U0001F600bc")], "path string, content string")
    index = phrase_index.build(files)
    phrases = spark.createDataFrame([("abc",), ("abca",), ("\U0001F600bc",), ("cab",)], "phrase string")
    assert rows(phrase_index.counts(index, phrases)) == [("abc", 2), ("abca", 1), ("cab", 1), ("\U0001F600bc", 1)]


def test_a_common_trigram_costs_a_row_per_block_not_per_file(spark):
    files = spark.range(5000).selectExpr("concat('f', id) as path", "concat('common text ', id % 7) as content").coalesce(1)
    index = phrase_index.build(files)
    assert index.postings.where("gram = 'com'").count() == 1
    phrases = spark.createDataFrame([("common text",), ("text 3",), ("none",)], "phrase string")
    assert rows(phrase_index.counts(index, phrases)) == [("common text", 5000), ("none", 0), ("text 3", 714)]


def test_postings_of_small_blocks_and_slices(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in rng.choice([97, 98, 99, 0x1F600, 10], n)) for n in (0, 1, 2, 3, 50, 200, 7, 30, 90, 4)]
    ids = [0, 1, 2, 3, 5, 6, 20, 21, 1 << 33, (1 << 33) + 1]     # gaps, and another task's numbers
    batch = pa.RecordBatch.from_arrays([pa.array([*ids, 4], pa.int64()), pa.array([*texts, None])], names=["file", "content"])
    want = {(s[i:i + 3], f) for f, s in zip(ids, texts, strict=True) for i in range(len(s) - 2)}
    for block_files, block_bytes, size in ((8192, 1 << 24, 1 << 21), (4, 1 << 24, 5), (8192, 60, 16)):
        for name, value in (("BLOCK_FILES", block_files), ("BLOCK_BYTES", block_bytes), ("SLICE", size)):
            monkeypatch.setattr(phrase_index, name, value)
        got = []
        for b in phrase_index._postings([batch]):
            for r in b.to_pylist():
                met = np.zeros(8192, int)
                phrase_index._count(met, r["bits"], r["n"])
                got += [(r["gram"], r["block"] + int(f)) for f in np.flatnonzero(met)]
        assert len(got) == len(want) and set(got) == want


def test_blocks_of_very_many_characters_are_halved():
    texts = ["".join(chr(0x20000 + 20 * i + j) for j in range(20)) for i in range(5000)] + ["".join(map(chr, range(0x10000, 0x20000)))]
    got = {(g, first) for first, grams, _, _ in phrase_index._block_postings(texts) for g in grams}
    assert len({g for g, _ in got}) == sum(len(s) - 2 for s in texts) and len({f for _, f in got}) > 1
