"""The registered queries, and the pipeline held against brute force."""
import re

import duckdb
import public_tokenizers
import pytest
from conftest import SMOKE
from llmdata import awkward, empty
from test_llm_simhash import naive_components, naive_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import langid
from quarry.llm.common import staged
from quarry.llm.queries import ORACLE, QUERIES

SMOKE_TABLES = ("documents", "benchmark", "pages")
WS = " \t\n\x0b\x0c\r"


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in SMOKE_TABLES:
        con.execute(f"create view {t} as select * from '{SMOKE}/{t}.parquet'")
    df = QUERIES[key](spark, SMOKE)
    cur = con.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = sorted(tuple(repr(r[names.index(c)]) for c in order) for r in cur.fetchall())
    assert sorted(tuple(repr(r[c]) for c in order) for r in df.collect()) == want


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    cols, sizes = docs.columns, [docs.count()]
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SMOKE), f"t-{name}")
        assert docs.columns == cols
        sizes.append(docs.count())
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) == sizes[-1]
        ids = now
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids
    assert pieces.where("ids is null").count() == 0


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


def plain_line_dedup(texts):
    """{doc_id: text} without repeated lines, by comparing lines one by one in order."""
    seen, variants, gone = set(), {}, set()
    for d in sorted(texts):
        for p, raw in enumerate((texts[d] or "").split("\n")):
            line = raw.strip(WS)
            if len(line) < 20 and not any(c.isalnum() for c in line):
                continue
            if line in seen:
                gone.add((d, p))
                continue
            seen.add(line)
            if len(line) < 20:
                continue
            own = {line, *(line[:i] + line[i + 1:] for i in range(len(line)))}
            if any(one_edit(line, e) for v in own for e in variants.get(v, ())):
                gone.add((d, p))
            for v in own:
                variants.setdefault(v, []).append(line)
    out = {}
    for d, text in texts.items():
        lines = (text or "").split("\n")
        left = "\n".join(x for p, x in enumerate(lines) if (d, p) not in gone)
        changed = any((d, p) in gone for p in range(len(lines)))
        if not changed or left.strip(WS + "\n"):
            out[d] = left if changed else text
    return out


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_contaminated(text, items):
    words = plain_words(text)
    wins = {tuple(w[i:i + 10]) for w in map(plain_words, items) if w for i in range(max(1, len(w) - 9))}
    return any(tuple(words[i:i + n]) in wins for n in {len(w) for w in wins} for i in range(len(words) - n + 1))


def test_every_stage_equals_a_plain_version(spark):
    """On the small table with planted copies, near copies, benchmark passages and rows without a letter."""
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    rows = [r for r in docs.collect() if len(r.text or "") < 15_000]
    long = [r for r in rows if len((r.text or "").split()) > 120][:6]
    planted = [(10**6 + i, r.text) for i, r in enumerate(long[:2])]
    planted += [(10**6 + 10 + i, r.text.replace("\n", " ").replace(r.text.split()[60], "changed", 1)) for i, r in enumerate(long[2:4])]
    planted += [(10**6 + 20 + i, f"{r.text}\nquoted {items[i]} end") for i, r in enumerate(long[4:6])]
    planted += [(10**6 + 30, "1234 5678 --"), (10**6 + 31, None), (10**6 + 32, long[0].text.split("\n")[0])]
    every = [tuple(r) for r in rows] + [(d, t, "en", "s", None if t is None else len(t)) for d, t in planted]
    now = spark.createDataFrame(every, docs.schema)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, staged(stage(spark, now, SMOKE), f"t-{name}")
        found[name] = ({r.doc_id: r.text for r in before.collect()}, now)

    texts, out = found["language_id"]
    model = langid.identify(spark.createDataFrame(every, docs.schema), langid.fit(spark.createDataFrame(every, docs.schema))).collect()
    assert {r.doc_id for r in model if r.lang_pred == "und"} == {d for d, t in texts.items() if not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in model if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}

    texts, out = found["line_dedup"]
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {d: (t, None if t is None else len(t)) for d, t in plain_line_dedup(texts).items()}
    assert 10**6 not in got and 10**6 + 32 not in got

    texts, out = found["simhash_near_dedup"]
    ids = sorted(texts)
    groups = naive_components([naive_fingerprint(texts[d]) for d in ids])
    assert {r.doc_id: r.text for r in out.collect()} == {min(d for d, h in zip(ids, groups) if h == g): texts[min(d for d, h in zip(ids, groups) if h == g)] for g in set(groups)}

    texts, out = found["benchmark_decontamination"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {d: t for d, t in texts.items() if not plain_contaminated(t, items)} and 10**6 + 20 in texts and 10**6 + 20 not in got

    texts, out = found["packing"]
    slow = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces, sequences = {}, {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {d: [x for _, ids in sorted(p) for x in ids] for d, p in pieces.items()} == {
        d: [*slow.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
    for p in sequences.values():
        assert [a for a, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:i]) for i in range(len(p))] and sum(n for _, n in p) <= 1024


def test_run_equals_the_stages_on_awkward_rows(spark, tmp_path):
    for name, rows in (("documents", awkward(spark, ["some text that is here " * 4] * 3)), ("empty", empty(spark))):
        folder = tmp_path / name
        rows.write.parquet(str(folder / "documents.parquet"))
        spark.read.parquet(f"{SMOKE}/benchmark.parquet").write.parquet(str(folder / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(folder))
        assert out.columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
        assert (out.count() == 0) == (name == "empty")


def test_nothing_else_imports_the_subpackage():
    import pathlib
    import re
    root = pathlib.Path(entry.__file__).parent
    for f in [*root.glob("quarry/**/*.py"), root / "bench.py", *root.glob("tools/*.py"), *root.glob("tests/*.py")]:
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s+(quarry\.llm|corpus_pipeline)", f.read_text(), re.M), f
