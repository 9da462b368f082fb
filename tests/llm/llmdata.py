"""Awkward documents that every operator must take: nulls, empty and long
texts, repeated rows, equal ids, extra columns with clashing names."""

EXTRA = ("id", "text_key", "pos", "key", "exact", "near", "fp", "row", "_id", "_text", "n_exact_removed", "component_id", "score", "n")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)

LONG = " ".join(f"word{i % 977} the of and" for i in range(20_000))


def awkward(spark, texts=()):
    rows = [(1, "The quick brown fox jumps over the lazy dog and runs away.", "en"), (2, None, "en"), (3, "", "en"), (4, " \n\t \x0b", None),
            (5, "1234 5678 !!!", "en"), (6, LONG, "en"), (6, LONG, "en"), (None, "no id here but some words in the text", "en"),
            (None, None, None), (7, "same id", "en"), (7, "same id, other text", "en"), (7, "same id", "en"),
            (8, "naïve café — ñandú ß 東京   x\x1cy\x85z", "fr"), (-9, "\U0001F600 emoji \U0001F600", None)]
    rows += [(100 + i, t, "en") for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), *EXTRA) for i, t, lang in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
