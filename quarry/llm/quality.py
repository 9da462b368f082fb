"""Quality rules: base counts and distribution divergence.

Each document has two histograms: character classes, and the common words of
each language together with all other words.  Languages are the values of
``lang``; the common words of each are the ``COMMON_WORDS`` words with the
largest mean share of its documents, and its references the mean histograms of
its documents that pass the base rules.  A document's distance to a language
is the Jensen-Shannon distance (square root of the divergence, base 2, 0 to 1).

A document is rejected unless both histograms are near one and the same
language.  How near follows from the distances of the language's own
documents: at most their mean and ``SPREAD`` standard deviations, and for the
common words also no further than halfway from their mean to the distance of a
text without any common word.  Short texts say little: each histogram is only
compared from a minimum length on.

Only DataFrame functions are used.  Null and empty texts have no words and
fail the base rule; texts are read whole, however long.  Without a reference (an empty table, no language) the
base rules decide alone.  Every row of the input gives one row, repeated
rows included; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WS_BYTES, bound, constant_array, staged, table

MIN_WORDS = 50            # base rule
MAX_REPEAT_PERCENT = 50   # base rule
MIN_CLASS_CHARS = 200     # guard of the character-class comparison
MIN_COMMON_WORDS = 100    # guard of the common-word comparison
COMMON_WORDS = 25         # common words of each language
SPREAD = 3.0              # standard deviations above the mean distance of a language's own documents

SPACE = "[\\x20\\x09-\\x0D]"
WORD = SPACE + "+"
# fixed values: character classes, each counted by its pattern; the rest are lower-case ASCII letters and others
CLASSES = ("[A-Z]", "[0-9]", "[^\\x00-\\x7F]", "[.,;:!?'\"()-]", "[#*$%&|<>]", SPACE)

def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    A window is the hash of its words' hashes.  Windows are sorted as one long
    each, the high bits of the hash before the position, so that equal ones
    are neighbours; the whole hash decides whether they are equal."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    def covered(h: Column, low: Column) -> Column:
        def place(x: Column) -> Column:
            return x.bitwiseAND(low).cast("int")

        def again(order: Column) -> Column:
            twice = F.filter(order, lambda x, i: (F.get(h, place(F.get(order, i - 1))) == F.get(h, place(x))) |
                             (F.get(h, place(F.get(order, i + 1))) == F.get(h, place(x))))
            return F.aggregate(F.sort_array(F.transform(twice, place)), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                               lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s - a["last"])).alias("n"), s.alias("last")), lambda a: a["n"])
        return bound(F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))), again)

    def counted(h: Column) -> Column:
        n = F.size(h)
        low = F.when(n <= 1 << 10, (1 << 10) - 1).when(n <= 1 << 16, (1 << 16) - 1).otherwise((1 << 31) - 1).cast("long")
        return F.when(F.size(F.array_distinct(h)) == n, F.lit(0).cast("long")).otherwise(bound(low, lambda x: covered(h, x)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bound(bound(hashes, windows), counted))


def _base(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, t)"""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))


def _words(text: Column) -> Column:
    """The words of a text; trimmed first, so that no empty one needs to be filtered."""
    return F.split(F.nullif(F.trim(text, F.lit(WS_BYTES)), F.lit("")), WORD)


def _counts(known: Column, words: Column) -> Column:
    """How often each of the sorted ``words`` is in ``known``, which has no other:
    the lengths of the runs when both are sorted together, less one."""
    def runs(x: Column) -> Column:
        starts = F.filter(F.transform(x, lambda w, i: F.when((i == 0) | (w != F.get(x, i - 1)), i)), lambda i: i.isNotNull())
        return bound(starts, lambda s: F.transform(s, lambda at, i: (F.coalesce(F.get(s, i + 1), F.size(x)) - at - 1).cast("long")))
    return bound(F.sort_array(F.concat(known, words)), runs)


def vocabulary(docs: DataFrame) -> list[str]:
    """The common words of all languages, from counts over all documents: of
    each language the words with a letter that have the largest mean share.
    At most ``COMMON_WORDS`` words a language reach the driver."""
    split = F.coalesce(_words(F.lower("t")), F.array().cast("array<string>"))

    def weighed(words: Column) -> Column:
        # whole numbers, so that sums do not depend on their order
        return F.struct((F.lit(1 << 30) / F.greatest(F.size(words), F.lit(1))).cast("long").alias("share"),
                        F.when(F.size(words) >= MIN_WORDS, words).alias("words"))

    # outer: no filter on the words is inferred, which would split every text once more
    rows = _base(docs).where(F.col("lang").isNotNull()).select("lang", bound(split, weighed).alias("x"))
    shares = (rows.select("lang", F.col("x.share").alias("share"), F.explode_outer("x.words").alias("word"))
              .groupBy("lang", "word").agg(F.sum(F.col("share").cast("double")).alias("share")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "word"))
    top = shares.where(F.regexp_like("word", F.lit("\\p{L}"))).withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS)
    return sorted(r["word"] for r in top.select("word").distinct().collect())


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, classes, common)

    Written once: a filter pushed into these expressions would evaluate the
    words of a text anew for each of them."""
    common_words = vocabulary(docs)
    split = _base(docs).select("*", F.coalesce(_words(F.col("t")), F.array().cast("array<string>")).alias("words"))
    known = split.select("*", F.transform(F.filter("words", lambda w: F.lower(w).isin(common_words)), F.lower).alias("known"),
                         F.regexp_replace("t", "[a-z\\x20\\x09-\\x0D]+", "").alias("marks"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.trim(x, F.lit(WS_BYTES))) > 0)
    word_chars = F.length(F.array_join("words", "")).cast("long")
    # white space is what is outside the words; the other classes are counted in what is left without lower-case letters and it
    counted = [F.length("t") - word_chars if p == SPACE else F.regexp_count("marks", F.lit(p)).cast("long") for p in CLASSES]
    common = _counts(F.col("known"), constant_array(common_words, "string"))
    counts = known.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"),
        word_chars.alias("word_chars"),
        bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"), F.length("t").cast("long").alias("n_chars"),
        F.array(*counted).alias("classes"), common.alias("common")
    ).withColumn("n_symbols", F.get("classes", F.lit(CLASSES.index("[#*$%&|<>]"))))
    return staged(counts, "quality")


def _shares(counts: Column, total: Column) -> Column:
    """Histogram as shares of the total; the last bin is what no other bin counts."""
    rest = total - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(F.concat(counts, F.array(rest)), lambda x: x / F.greatest(total, F.lit(1)))


def _filled(p: Column) -> Column:
    """array<struct<a, i>>: the bins of a histogram that are not empty; null for a null histogram."""
    return F.filter(F.transform(p, lambda a, i: F.struct(a.alias("a"), i.alias("i"))), lambda x: x["a"] > 0)


def _to_reference(filled: Column, q: Column) -> Column:
    """Jensen-Shannon distance of a histogram, given by its filled bins, to a reference.

    A bin that is empty in the histogram adds half the reference's share, and
    the reference adds up to 1, so only the filled bins are gone through."""
    def added(s: Column, x: Column) -> Column:
        a, b = x["a"], F.get(q, x["i"])
        both = F.when(b > 0, a * F.log2(2 * a / (a + b)) + b * F.log2(2 * b / (a + b)) - b).otherwise(a)
        return s + both
    terms = F.aggregate(filled, F.lit(1.0), added) / 2
    # greatest() skips nulls
    return F.when(filled.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), terms)))


def _distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram column to a reference; null for a null histogram."""
    return _to_reference(_filled(p), constant_array(q, "double"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def references(found: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """{language: (class shares, common-word shares)}: means over all its
    documents that pass the base rules.  One row per language and bin
    reaches the driver."""
    bins = found.where(F.col("lang").isNotNull() & ~base_failed()).select(
        "lang", F.posexplode(F.concat(_shares(F.col("classes"), F.col("n_chars")), _shares(F.col("common"), F.col("n_words"))))
        .alias("bin", "share"))
    means: dict[str, list[float]] = {}
    for r in bins.groupBy("lang", "bin").agg(F.avg("share").alias("share")).orderBy("lang", "bin").collect():
        means.setdefault(r["lang"], []).append(r["share"])
    k = len(CLASSES) + 1
    return {lang: (m[:k], m[k:]) for lang, m in means.items()}


def _js(p: list[float], q: list[float]) -> float:
    """``_distance`` of two lists."""
    def part(a: float, m: float) -> float:
        return a * math.log2(a / m) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum(part(a, (a + b) / 2) + part(b, (a + b) / 2) for a, b in zip(p, q, strict=True)) / 2))


def _references_column(rows: list[dict]) -> Column:
    kind = "array<struct<lang:string,classes:array<double>,common:array<double>,max_class:double,max_common:double>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _to(refs: Column) -> Column:
    """array<struct<class_distance, common_distance, max_class, max_common>>: one element per
    reference; a distance of a text that is too short for it is null."""
    both = F.struct(_filled(F.when(F.col("n_chars") >= MIN_CLASS_CHARS, _shares(F.col("classes"), F.col("n_chars")))).alias("classes"),
                    _filled(F.when(F.col("n_words") >= MIN_COMMON_WORDS, _shares(F.col("common"), F.col("n_words")))).alias("common"))
    return bound(both, lambda p: F.transform(refs, lambda r: F.struct(
        _to_reference(p["classes"], r["classes"]).alias("class_distance"), _to_reference(p["common"], r["common"]).alias("common_distance"),
        r["max_class"].alias("max_class"), r["max_common"].alias("max_common"))))


def limits(found: DataFrame, refs: dict[str, tuple[list[float], list[float]]], spread: float = SPREAD) -> dict[str, tuple]:
    """{language: (largest class distance, largest common-word distance)}, by
    the distances of its own documents to it; None where none is long enough."""
    every = _references_column([{"lang": lang, "classes": a, "common": b} for lang, (a, b) in sorted(refs.items())])
    own = found.where(F.col("lang").isNotNull() & ~base_failed()).select(
        "lang", F.get(_to(F.filter(every, lambda r: r["lang"] == F.col("lang"))), F.lit(0)).alias("d"))
    stats = [f(F.col(f"d.{c}")).alias(f"{c}_{n}") for c in ("class_distance", "common_distance")
             for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]
    out = {}
    for r in own.groupBy("lang").agg(*stats).collect():
        top = [None if r[f"{c}_mean"] is None else r[f"{c}_mean"] + spread * r[f"{c}_sd"] for c in ("class_distance", "common_distance")]
        if top[1] is not None:
            shares = refs[r["lang"]][1]
            without, mean = _js([0.0] * (len(shares) - 1) + [1.0], shares), r["common_distance_mean"]
            if mean < without:
                top[1] = min(top[1], (mean + without) / 2)
        out[r["lang"]] = tuple(top)
    return out


def judge(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(doc_id, base counts, base_failed, class_distance, common_distance, kept);
    the distances are those to the nearest language by each histogram"""
    found = features(docs)
    refs = references(found)
    most = limits(found, refs, spread) if refs else {}
    every = _references_column([{"lang": lang, "classes": a, "common": b, "max_class": most[lang][0], "max_common": most[lang][1]}
                                for lang, (a, b) in sorted(refs.items())])

    def near(x: Column, which: str, at: int) -> Column:
        if all(m[at] is None for m in most.values()):
            return F.lit(True)
        # rounding: a language's only document is at its limit
        return x[f"{which}_distance"].isNull() | F.coalesce(x[f"{which}_distance"] <= x[f"max_{which}"] + 1e-9, F.lit(False))

    def decided(x: Column) -> Column:
        fine = F.exists(x, lambda r: near(r, "class", 0) & near(r, "common", 1)) if refs else F.lit(True)
        return F.struct(F.array_min(F.transform(x, lambda r: r["class_distance"])).alias("class_distance"),
                        F.array_min(F.transform(x, lambda r: r["common_distance"])).alias("common_distance"), fine.alias("fine"))

    out = found.withColumns({"base_failed": base_failed(), "judged": bound(_to(every), decided)})
    return (out.withColumns({"class_distance": F.col("judged.class_distance"), "common_distance": F.col("judged.common_distance"),
                             "kept": ~F.col("base_failed") & F.col("judged.fine")})
            .drop("classes", "common", "lang", "n_chars", "judged"))


def op8_quality(spark, sf_dir):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "class_distance", "common_distance")
    return judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(*cols)
