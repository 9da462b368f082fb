import random
import re

import numpy as np
from conftest import SMOKE
from llmdata import awkward, empty

from quarry.llm import licenses

NOTICES = licenses.notices()


def plain_words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]


def plain_base(text):
    """(places, labels) by comparing words one by one."""
    words, places = plain_words(text), []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), places


def least_errors(s, notice):
    """Fewest edits with which the notice ends somewhere in s, its exact ending right behind: a full table."""
    codes, steps = np.array([ord(c) for c in s]), np.arange(len(s) + 1)
    row = np.zeros(len(s) + 1, dtype=int)
    for c in notice.text:
        new = np.concatenate(([row[0] + 1], np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))))
        row = np.minimum.accumulate(new - steps) + steps
    return min((int(e) for j, e in enumerate(row) if s.startswith(notice.ending, j)), default=None)


def mutate(rng, s, k):
    s = list(s)
    for _ in range(k):
        kind, p = rng.randrange(3), rng.randrange(len(s))
        if kind == 0:
            s[p] = rng.choice("abz 1é")
        elif kind == 1:
            s.insert(p, rng.choice("abz 1é"))
        elif len(s) > 1:
            del s[p]
    return "".join(s)


def test_search_equals_a_full_table():
    rng, searcher, hits = random.Random(4), licenses.Searcher(NOTICES), 0
    for _ in range(120):
        notice = rng.choice(NOTICES)
        phrase = mutate(rng, notice.text + notice.ending, rng.randrange(0, notice.errors + 3))
        text = " ".join([rng.choice(["the", "license", "copy of"]), phrase, rng.choice(["", "version 2", "public"]), mutate(rng, rng.choice(NOTICES).text, 1)])
        s = licenses.folded(text.encode())
        found = {}
        for i, start, end, errors in searcher.search(s):
            found[i] = min(errors, found.get(i, 99))
            assert least_errors(s[start:end], NOTICES[i]) <= errors <= NOTICES[i].errors
        for i, notice in enumerate(NOTICES):
            want = least_errors(s, notice)
            assert (found.get(i) is not None) == (want is not None and want <= notice.errors), (notice, s)
            hits += i in found
    assert hits > 100


def test_adjacent_notices_are_all_found():
    searcher = licenses.Searcher(NOTICES)
    i = next(k for k, x in enumerate(NOTICES) if x.text == " gnu general public license ")
    text = "gnu general public license gnu generel public license " * 300 + "license " * 500
    got = [x for x in searcher.search(licenses.folded(text.encode())) if x[0] == i]
    assert [x[3] for x in got] == [0, 1] * 300


def test_pieces_cover_the_notice():
    for x in NOTICES:
        assert "".join(p for _, p in licenses.pieces(x)) == x.text and len(licenses.pieces(x)) == x.errors + 1
        assert all(p for _, p in licenses.pieces(x))


def test_spans_words_and_errors(spark):
    text = "Intro é. Released  under the MTI-License!\nThen CC BY-NC, cc by nc; Apache License, Version 2.0 ... apache license version 3"
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    got = [(m.label, m.base, text[m.start:m.end], m.first_word, m.last_word) for m in r.matches]
    assert ("cc-by-nc", True, "CC BY-NC", 8, 10) in got and ("cc-by-nc", True, "cc by nc", 11, 13) in got
    assert ("apache-2", True, "Apache License, Version 2", 14, 17) in got
    assert any(m[0] == "mit" and not m[1] and m[2].endswith("MTI-License") for m in got)
    assert all(not m[2].startswith("apache license version 3") for m in got) and r.n_words == 23
    words = plain_words(text)
    assert all(plain_words(t) == words[a:b + 1] for _, _, t, a, b in got)


def test_query_equals_a_plain_count(spark, tmp_path):
    extra = ["Under the MIT license. under\tthe--mit LICENSE", "under the mit licenses", "cc by nc by nc cc by nc", "xcc by nc", "cc  by\x00nc", "éunder the mit license",
             "apache license version 2", "apache license version 20", "apache license version 2é", "A" * 50, "license " * 2000, "cc by nc " * 500,
             "Ａpache license version 2 İ"]
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").unionByName(awkward(spark, extra).select("doc_id", "text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.op12_licenses(spark, str(tmp_path)).collect()

    def row(doc_id, text):
        n, places = plain_base(text)
        return (doc_id, n, len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((row(*r) for r in docs.collect()), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert all(r.score == 1 for r in got if r.n_base) and any(r.n_base for r in got if r.doc_id is not None and r.doc_id < 100)


def test_labels_of_the_table_by_a_full_table(spark):
    """Every notice within its errors is found, in texts of the given table."""
    rows = [r for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect() if r.text and len(r.text) < 900][:25]
    rows += [r for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect() if r.text and "icense" in r.text and len(r.text) < 1500][:10]
    got = {r.doc_id: {m.label for m in r.matches} for r in licenses.scan(spark.createDataFrame(rows)).collect()}
    for r in rows:
        s = licenses.folded(r.text.encode())
        assert got[r.doc_id] == {x.label for x in NOTICES if (e := least_errors(s, x)) is not None and e <= x.errors}


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    got = licenses.scan(docs, matches="m", n_words="w")
    assert got.columns == [*docs.columns, "m", "w"] and got.count() == docs.count()
    assert licenses.scan(empty(spark), matches="m", n_words="w").collect() == []
