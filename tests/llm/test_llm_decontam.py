import hashlib
import re

from llmdata import LONG, awkward, empty

from quarry.llm import decontam

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[p:p + n]), set()).add(str(item) if item is not None else "")
    sizes = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                own = wins.get(tuple(w[p:p + n]))
                if own:
                    hit.update(range(p, p + n))
                    found |= own
        out.append((doc is None, doc or 0, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


PASSAGE = "It was the best of times, it was the worst of times, it was the age of wisdom, it was the age of foolishness"
ITEMS = [(1, PASSAGE), (2, "Two words"), (3, None), (4, "!!"), (5, "naïve CAFÉ"), (10, "a b c d e f g h i j k l"), (11, "the age of wisdom"),
         (9, PASSAGE.upper()), (None, "emoji"), (12, "Solo"), (1, PASSAGE)]
TEXTS = [PASSAGE, f"before {PASSAGE} after {PASSAGE}", PASSAGE.replace("wisdom", "reason"), " ".join(PASSAGE.split()[3:14]), "two-words here",
         "two  WORDS", "x a b c d e f g h i j y", "a b c d e f g h i", "b c d e f g h i j k", "the age of wisdom solo the age of wisdom", "solo",
         LONG + " " + PASSAGE]


def test_equals_brute_force(spark):
    docs = awkward(spark, TEXTS)
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id long, text string, win string")
    found = decontam.contamination(docs, items)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
                 for r in found.collect())
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], ITEMS)
    clean = decontam.clean(docs, items)
    assert clean.columns == docs.columns
    bad = {x[1] for x in got if x[-1]}
    assert not bad & {r.doc_id for r in clean.collect()} and clean.count() == sum(not x[-1] for x in got)


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert {(r.n_hit, r.contaminated) for r in decontam.contamination(awkward(spark), items).collect()} == {(0, False)}
    assert decontam.contamination(empty(spark), items).collect() == []
    assert decontam.clean(awkward(spark), items).count() == awkward(spark).count()


def test_full_bitmap_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BITS", 3)   # every shingle passes; the join decides alone
    docs = awkward(spark, TEXTS[:6])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
                 for r in decontam.contamination(docs, items).collect())
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], ITEMS)
