import random

import corpus_pipeline
import pytest
from conftest import SMOKE
from llmdata import awkward, empty

from quarry.llm import linededup

WS = " \t\n\x0b\x0c\r"


def near(a, b):
    """Edit distance 1."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


def compared(s):
    return len(s) >= linededup.MIN_CHARS or any(c.isalnum() for c in s)


def make_texts(seed=3):
    rng = random.Random(seed)

    def line(n):
        return "".join(rng.choice("abcdefgh   ") for _ in range(n)).strip().ljust(n, "z")
    lines = [line(rng.randrange(20, 90)) for _ in range(25)] + [line(700), line(3000)]
    out = []
    for _ in range(60):
        s = list(rng.choice(lines))
        for _ in range(rng.randrange(0, 3)):
            k, p = rng.randrange(3), rng.randrange(len(s))
            if k == 0:
                s[p] = rng.choice("xyé東")
            elif k == 1:
                s.insert(p, rng.choice("xyé東"))
            else:
                del s[p]
        out.append("".join(s))
    texts = []
    while out:
        k = rng.randrange(1, 5)
        texts.append("\n".join([*out[:k], "short", "--", rng.choice("abc") + "x", "  " + rng.choice(lines) + "\t", ""]))
        out = out[k:]
    return texts


@pytest.mark.parametrize("region", [linededup.REGION, 4])
def test_equals_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(linededup, "REGION", region)
    texts = make_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_exact_removed, r.n_near_removed) for r in linededup.dedup_lines(docs).collect()}
    first, order = {}, []
    for d, t in enumerate(texts):
        for p, raw in enumerate(t.split("\n")):
            s = raw.strip(WS)
            if compared(s) and s not in first:
                first[s] = (d, p)
                order.append(s)
    long = [s for s in order if len(s) >= linededup.MIN_CHARS]
    late = {s for i, s in enumerate(long) if any(near(s, e) for e in long[:i])}
    assert len(late) > 5
    for d, t in enumerate(texts):
        kept, exact, nearly = [], 0, 0
        for p, raw in enumerate(t.split("\n")):
            s = raw.strip(WS)
            if compared(s) and first[s] != (d, p):
                exact += 1
            elif len(s) >= linededup.MIN_CHARS and s in late:
                nearly += 1
            else:
                kept.append(raw)
        assert got[d] == ("\n".join(kept), exact, nearly)


def test_large_group_of_near_copies_makes_no_pairs(spark):
    base = "the same line of text with one changing letter ? at the end of it"
    texts = [base.replace("?", chr(0x4E00 + i)) for i in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got[0] == texts[0] and all(got[i] == "" for i in range(1, 1500))


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    got = linededup.dedup_lines(docs, ("a", "b"))
    assert got.columns == [*docs.columns, "a", "b"] and got.count() == docs.count()
    # fully equal rows are one document: both keep their lines; "same id" of the same id and another text goes
    assert sorted((r.text or "") for r in got.collect()) == sorted((r.text or "") for r in docs.collect())
    assert linededup.dedup_lines(empty(spark), ("a", "b")).collect() == []
    stage = corpus_pipeline.line_dedup(spark, docs, "")
    assert stage.columns == docs.columns and stage.count() == docs.count()


def test_documents_left_without_a_word_go(spark):
    line = "a line that is certainly long enough to count"
    docs = spark.createDataFrame([(1, line, 45), (2, line + "\n \n", 48), (3, line + "\nown words here", 60), (4, "", 0), (5, None, None)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: (line, 45), 3: ("own words here", 14), 4: ("", 0), 5: (None, None)}


def test_pipeline_drops_short_repeats(spark):
    docs = spark.createDataFrame([(1, "Read more\n---\n7\nown text one", 30), (2, " Read more\n---\n7\nown text ona", 31), (3, "Read more", 9)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: ("Read more\n---\n7\nown text one", 30), 2: ("---\nown text ona", 16)}


def test_no_line_with_a_word_is_left_twice(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")

    def lines(df):
        return [s for r in df.collect() for s in (x.strip(WS) for x in (r.text or "").split("\n")) if any(c.isalnum() for c in s)]
    kept = lines(corpus_pipeline.line_dedup(spark, docs, ""))
    assert len(set(kept)) == len(kept) < len(lines(docs))


def test_short_lines_go_in_the_query_too(spark, tmp_path):
    rows = [(1, "short line\nshort line\n--\n--"), (2, "short line\nother"), (3, "42")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_chars_kept, r.n_exact_removed) for r in linededup.op10_linededup(spark, str(tmp_path)).collect()}
    assert got == {1: (16, 1), 2: (5, 1), 3: (2, 0)}
