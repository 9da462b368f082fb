import zlib

from conftest import SF01
from llmdata import awkward, empty

from quarry.llm import langid


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: r for r in langid.op1_langid(spark, SF01).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == {r.doc_id for r in held}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_never_used(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    spoiled = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'xx', lang) as lang")
    a, b = (langid.fit(d) for d in (docs, spoiled))
    assert a["families"] == b["families"] and "xx" not in str(b["members"].keys())
    assert all((x[0] == y[0]).all() for x, y in zip(a["family"], b["family"]))


def test_awkward_rows(spark):
    model = langid.fit(spark.read.parquet(f"{SF01}/documents.parquet"))
    docs = awkward(spark)
    got = langid.identify(docs, model).collect()
    assert len(got) == docs.count()
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {2, 3, 4, 5, None} and all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted(i or 0 for i in (1, 6, 6, 7, 7, 7, 8, -9, None))


def test_without_training_rows_and_with_one_language(spark):
    docs = awkward(spark)
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(empty(spark))).collect()} == {"und"}
    assert langid.identify(empty(spark), langid.fit(empty(spark))).collect() == []
    one = langid.fit(docs.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in langid.identify(docs.where("doc_id = 1"), one).collect()} == {("en", 1.0)}


def test_features_do_not_depend_on_chunks(monkeypatch):
    import numpy as np
    text = "Straße über  1234 !! naïve " * 50
    whole = langid.Features()(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    parts = langid.Features()(text)
    assert np.allclose(whole, parts) and abs(float((whole**2).sum()) - 1) < 1e-5


def test_unknown_languages_are_families_of_their_own():
    assert langid.family_of("en") == langid.family_of("de") == "germanic"
    assert langid.family_of("es") == "romance" and langid.family_of("tlh") == "only-tlh"


def test_copies_count_once_and_every_language_is_learned(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("lang in ('en', 'es')").select("doc_id", "text", "lang")
    copy = docs.where("lang = 'es'").orderBy("doc_id").limit(1).select("text", "lang")
    copies = spark.range(10_000_000, 10_020_000).withColumnRenamed("id", "doc_id").crossJoin(copy)
    rare = spark.createDataFrame([(20_000_000 + i, f"palabra número {i}", f"x{i % 250}") for i in range(500)], "doc_id long, text string, lang string")
    counts = {r.lang: r["count"] for r in langid.training_sample(docs.union(copies), 100).groupBy("lang").count().collect()}
    assert counts == {"en": 50, "es": 50}
    learnt = {r.lang for r in langid.training_sample(docs.union(rare)).select("lang").distinct().collect()}
    assert learnt == {"en", "es", *(r.lang for r in langid.learnable(rare).select("lang").distinct().collect())}
    assert len(learnt) > 200


def test_sample_is_bounded_for_each_language(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.lang: r.n for r in langid.learnable(docs).where("text rlike '\\\\p{L}'").groupBy("lang").agg({"text": "count"})
             .withColumnRenamed("count(text)", "n").collect()}
    for bound in (40, 120):
        counts = {r.lang: r["count"] for r in langid.training_sample(docs, bound).groupBy("lang").count().collect()}
        assert set(counts) == set(texts) and set(counts.values()) == {max(langid.LEAST, bound // len(texts))}
