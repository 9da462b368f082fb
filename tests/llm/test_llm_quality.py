import collections
import math
import random
import re

import duckdb
from conftest import SF01, SMOKE
from llmdata import awkward, empty

from quarry.llm import quality

TEXTS = ["a b c a b c a b c", "a a a a a a", "x y z", "one two three one two three four", "l\nl\n\nl\n \n \nm", "# * $ % & | < > #", "a b c d a b c d b c d"]


def naive(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts_equal_a_plain_count(spark):
    docs = awkward(spark, TEXTS)
    got = quality.judge(docs).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == \
        sorted(naive(r.text) for r in docs.select("text").collect())
    assert all(not r.kept for r in got if r.base_failed)


def test_clean_documents_stay_and_junk_goes(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r.doc_id: r for r in quality.op8_quality(spark, SF01).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and i in got and not got[i].base_failed]
    assert sum(got[i].kept for i in good) >= 0.99 * len(good)
    bad = [i for i, q in labels.items() if q == 0 and i in got and not got[i].base_failed]
    assert bad and sum(got[i].kept for i in bad) <= 0.1 * len(bad)
    symbols = [i for i, t in docs.items() if not got[i].base_failed and len(re.findall(r"[#*$%&]{3}", t)) > 0.5 * got[i].n_words]
    assert symbols and not any(got[i].kept for i in symbols)


def plain_kept(docs):
    """{doc_id: kept} by the rules of the module's docstring, in plain Python."""
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t or "")
    shares = {}
    for _, t, lang in docs:
        w = [x.lower() for x in words(t)]
        if lang is not None and len(w) >= 50:
            for x in w:
                shares.setdefault(lang, collections.Counter())[x] += (1 << 30) // len(w)
    common = sorted({x for c in shares.values() for x, _ in sorted(((x, n) for x, n in c.items() if re.search(r"[^\W\d_]", x)), key=lambda y: (-y[1], y[0].encode()))[:25]})

    def histograms(t):
        t = t or ""
        n, w = len(t), [x.lower() for x in words(t)]
        bins = [len(re.findall(p, t)) for p in ("[A-Z]", "[0-9]", r"[^\x00-\x7F]", "[.,;:!?'\"()-]", "[#*$%&|<>]", r"[\x20\x09-\x0D]")]
        tops = collections.Counter(w)
        return [x / max(1, n) for x in [*bins, n - sum(bins)]], [x / max(1, len(w)) for x in [*(tops[c] for c in common), len(w) - sum(tops[c] for c in common)]], n, len(w)

    def js(p, q):
        def part(a, b):
            return a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))

    rows = [(i, lang, naive(t)[5], *histograms(t)) for i, t, lang in docs]
    refs, limits = {}, {}
    for own in {r[1] for r in rows if r[1] is not None and not r[2]}:
        fit = [r for r in rows if r[1] == own and not r[2]]
        refs[own] = [[sum(x) / len(fit) for x in zip(*(r[k] for r in fit))] for k in (3, 4)]
        tops = []
        for k, long in ((3, [r for r in fit if r[5] >= 200]), (4, [r for r in fit if r[6] >= 100])):
            d = [js(r[k], refs[own][k - 3]) for r in long]
            mean = sum(d) / len(d) if d else None
            tops.append(None if not d else (mean, mean + 3 * math.sqrt(sum((x - mean) ** 2 for x in d) / len(d))))
        without = js([0.0] * len(common) + [1.0], refs[own][1])
        if tops[1] and tops[1][0] < without:
            tops[1] = (tops[1][0], min(tops[1][1], (tops[1][0] + without) / 2))
        limits[own] = [t and t[1] for t in tops]

    def near(r, own):
        for k, length, least in ((3, 5, 200), (4, 6, 100)):
            if all(m[k - 3] is None for m in limits.values()) or r[length] < least:
                continue
            if limits[own][k - 3] is None or js(r[k], refs[own][k - 3]) > limits[own][k - 3] + 1e-9:
                return False
        return True
    return sorted((str(r[0]), not r[2] and (not refs or any(near(r, own) for own in refs))) for r in rows)


def test_verdict_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted((str(r.doc_id), r.kept) for r in quality.judge(docs).collect())
    assert got == plain_kept(rows) and len({k for _, k in got}) == 2


def test_repeated_windows_of_long_and_repetitive_texts(spark):
    rng = random.Random(3)
    texts = ["a b c " * 400, " ".join(rng.choice("ab") for _ in range(3000)), " ".join(rng.choice("abcdefghij") for _ in range(1500)), "x " * 70_000,
             " ".join(f"w{rng.randrange(30)}" for _ in range(1030)), "a b c d", "a a a a", "a a a", " ".join(f"u{i}" for i in range(2000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality.judge(docs).collect()}
    assert got == {i: naive(t)[4] for i, t in enumerate(texts)}


def test_distance_is_jensen_shannon(spark):
    p, q = [0.5, 0.25, 0.25, 0.0], [0.1, 0.0, 0.4, 0.5]
    df = spark.createDataFrame([(p,)], "p array<double>")

    def kl(a, m):
        return sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    got = df.select(quality._distance(df.p, q).alias("d"), quality._distance(df.p, p).alias("z")).first()
    assert abs(got.d - math.sqrt((kl(p, m) + kl(q, m)) / 2)) < 1e-12 and got.z == 0


def test_references_are_means_over_all_documents(spark):
    found = quality.features(spark.read.parquet(f"{SF01}/documents.parquet"))
    refs = quality.references(found)
    con = duckdb.connect()
    n, share = con.execute(f"""select count(*), avg(length(regexp_replace(text, '[^A-Z]', '', 'g')) / length(text)) from '{SF01}/documents.parquet'
        where lang = 'de' and doc_id in (select unnest(?))""", [[r.doc_id for r in found.where(~quality.base_failed()).collect()]]).fetchone()
    assert n > 50 and abs(refs["de"][0][0] - share) < 1e-9
    assert all(abs(sum(h) - 1) < 1e-9 for r in refs.values() for h in r)


def test_empty_table_and_no_reference(spark):
    assert quality.judge(empty(spark)).collect() == []
    got = quality.judge(awkward(spark).drop("lang")).collect()
    assert all(r.kept == (not r.base_failed) for r in got)


def _prose(rng, common, letters, n):
    """Words of ``letters``, four in ten of them common."""
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(letters) for _ in range(rng.randrange(3, 9)))
                    for _ in range(n)) + "."


def test_every_language_has_references_and_gibberish_goes(spark):
    rng = random.Random(5)
    latin, cyrillic = "abcdefghilmnoprstuvw", "абвгдежзиклмнопрстуя"
    english, russian = "the of and to in that it is was for".split(), "и в не на что он как это по но".split()
    rows = [(i, _prose(rng, english, latin, 200), "en") for i in range(60)]
    rows += [(100 + i, _prose(rng, russian, cyrillic, 200), "ru") for i in range(60)]
    rows += [(300 + i, " ".join("".join(rng.choice(latin) for _ in range(rng.randrange(3, 9))) for _ in range(300)), "en") for i in range(3)]
    rows += [(400, _prose(rng, russian, cyrillic, 200), None), (401, _prose(rng, english, latin, 150), "tlh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {*english, *russian} <= set(quality.vocabulary(docs))
    refs = quality.references(quality.features(docs))
    assert set(refs) == {"en", "ru", "tlh"}
    kept = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    assert not kept & {300, 301, 302}
    assert {*range(60), *range(100, 160), 400, 401} <= kept


def test_limits_lie_below_a_text_without_common_words(spark):
    found = quality.features(spark.read.parquet(f"{SF01}/documents.parquet"))
    refs = quality.references(found)
    most = quality.limits(found, refs)
    assert set(most) == set(refs)
    for lang, (_, shares) in refs.items():
        assert most[lang][1] < quality._js([0.0] * (len(shares) - 1) + [1.0], shares)
