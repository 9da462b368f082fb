import os
import random
import re
from collections import Counter

import pytest
from conftest import SMOKE
from llmdata import awkward, empty

from quarry.llm import phrases
from quarry.session import shared_dir


def plain(rows, threshold, top=2000):
    """The contract, step by step."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= threshold}
    hidden = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
              if j - i < len(p) and 100 * a >= 80 * f[lang, p[i:j]]}
    out = []
    for lang in total:
        scored = []
        for (own, p), a in cand.items():
            if own == lang and (lang, p) not in hidden:
                score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def drawn(seed, n=400):
    """Texts with a few common words, so that phrases of all lengths recur, some only in late rows."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        few = ["New", "york", "city", "Of", "the", "él", "x1"] if i % 3 else ["a", "b", "c"]
        words = [rng.choice(few) if rng.random() < 0.7 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 25))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for w in words)
        if i > 3 * n // 4:
            text += "rare late phrase here"
        rows.append((i, rng.choice(["en", "en", "en", "de", None]), text))
    return rows


@pytest.mark.parametrize(("threshold", "shards"), [(30, 4), (2, 2), (7, 1)])
def test_equals_brute_force(spark, threshold, shards):
    rows = drawn(threshold)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    want = plain([r[1:] for r in rows], threshold, 40)
    got = sorted(tuple(r) for r in phrases.collocations(docs, threshold, 40, shards).collect())
    assert got == want and len(want) > 5


def test_full_bitmaps_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 6)
    monkeypatch.setattr(phrases, "MASK", 63)
    rows = drawn(9)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(docs, 6, shards=2).collect()) == plain([r[1:] for r in rows], 6)


def test_the_tables_texts(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = docs.select("lang", "text").collect()
    assert sorted(tuple(r) for r in phrases.collocations(docs, 8, shards=2).collect()) == plain([tuple(r) for r in rows], 8)


def test_counts_of_all_lengths(spark):
    rows = [(i, "en", "one two three four five. Two three") for i in range(10)] + [(99, "", "one two")]
    found, totals = phrases.count_phrases(spark.createDataFrame(rows, "doc_id long, lang string, text string"), 10, 3)
    got = {(r.lang, r.phrase): r.n for r in found.collect()}
    assert got["en", "two three"] == 20 and got["en", "one two three four"] == 10 and ("en", "five two") not in got and ("", "one") not in got
    assert {tuple(r) for r in totals.collect()} == {("en", 70), ("", 2)}


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in phrases.collocations(docs, 2, shards=1).collect()) == plain(rows, 2)
    assert phrases.collocations(empty(spark), shards=1).collect() == []


def test_steps_read_and_keep_numbers_only(spark):
    """The texts are taken apart once; shards and state of the steps hold no text."""
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    docs = spark.createDataFrame(drawn(5), "doc_id long, lang string, text string")
    found, _ = phrases.count_phrases(docs, 5, 2)
    assert found.where("k > 2").count()
    made = [x for x in set(os.listdir(folder)) - before if x.startswith(("phrases-shards", "phrases-state"))]
    assert len(made) > 3
    for x in made:
        assert not [c for c, kind in spark.read.parquet(f"{folder}/{x}").dtypes if kind == "string"], x


def test_many_dictionaries_of_a_language(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART", 256)
    monkeypatch.setattr(phrases, "IDS", 64)
    monkeypatch.setattr(phrases, "PENDING", 50)
    rows = drawn(6) + [(999, "en", "of the new york city " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(docs, 6, shards=2).collect()) == plain([r[1:] for r in rows], 6)
    used = phrases._split(docs, 2).where("word IS NOT NULL").groupBy("lang", "word").count()
    assert used.agg({"count": "max"}).first()[0] > 10
