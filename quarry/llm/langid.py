"""Hierarchical language identification.

A text is first assigned to a language family and then, within the family, to
a language.  Both steps use linear support vector machines on hashed
character n-grams: families one against the rest, the closely related
languages of a family one against one, decided by votes and then by the sum
of the margins.

Features: letters in lower case, every other character a space, runs of
spaces squeezed, a space at both ends; counts of the 1- to 3-grams of the
whole text, hashed to ``DIMENSIONS``, as square roots of relative frequencies
(so a vector has length 1 whatever the length of the text).

Training rows are a sample: of every language the distinct texts with the
smallest hashes, ``SAMPLE`` divided by the number of languages, but ``LEAST``
at least; copies of a text count once.  Each is a feature vector of fixed size
(8 KB), in one task; only the trained weights reach the driver.  Languages
that the family table does not name form a family of their own.

Null, empty and letterless texts are ``und`` with score 0.  Without a
training row every text is ``und``; with one language, every text with a
letter is that language with score 1.  Ties go to the first name in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged, table, text_key

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
SAMPLE = 2000        # training rows, all languages together
LEAST = 20           # training rows of each language, also where all together are more
RANGE_BITS = 12      # draws are counted in so many bits' worth of ranges before they are ranked
CHUNK = 1 << 18      # characters featurised at a time
FOLDS, HELD = 5, 0
UNDETERMINED = "und"
MIN_SCORE = 0.1      # below it, ``accepted`` rejects a text

# fixed values: families of languages by ISO 639-1 code
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only-{lang}")


class Features:
    """Character n-gram vector of a text, in bounded memory."""

    def __init__(self):
        import sys

        import numpy as np
        self.np = np
        space = 32
        self.table = np.fromiter((i if chr(i).isalpha() else space for i in range(sys.maxunicode + 1)),
                                 np.uint32, sys.maxunicode + 1)

    def __call__(self, text):
        """The vector, or None where the text has no letter."""
        np = self.np
        counts = np.zeros(DIMENSIONS, np.int64)
        tail = np.array([32], np.uint32)
        size = len(text)
        for at in range(0, size, CHUNK):
            raw = text[at:at + CHUNK].lower().encode("utf-32-le", "surrogatepass")
            codes = self.table[np.frombuffer(raw, "<u4")]
            if at + CHUNK >= size:
                codes = np.append(codes, np.uint32(32))
            codes = np.concatenate([tail, codes])
            new = len(tail)
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
            keep[:new] = True
            codes = codes[keep]
            h = np.zeros(len(codes), np.uint32)
            for k in ORDERS:
                # grams of k characters that end in this chunk
                h = (h[:-1] if k > 1 else h) * np.uint32(0x01000193) + (codes[k - 1:] + np.uint32(1)) * np.uint32(0x9E3779B1)
                grams = h[max(0, new - (k - 1)):]
                slot = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(20)
                counts += np.bincount(slot, minlength=DIMENSIONS)
            tail = codes[-(max(ORDERS) - 1):]
        if not _has_letter(text):
            return None
        return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def _has_letter(text) -> bool:
    return any(map(str.isalpha, text))


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: a text, a language, and an id outside the held-out fold."""
    return docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def held_out(doc_id):
    """crc32 of the id as text leaves no remainder; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(True))


def _vectors(batches):
    import pyarrow as pa
    features = Features()
    for b in batches:
        vectors = [None if v is None else v.astype("<f2").tobytes() for v in map(features, b.column("text").to_pylist())]
        out = pa.RecordBatch.from_arrays([b.column("draw"), b.column("lang"), pa.array(vectors, pa.binary())], names=["draw", "lang", "v"])
        yield out.filter(out.column("v").is_valid())


def training_sample(docs: DataFrame, bound: int = SAMPLE):
    """(draw, lang, v): distinct texts, evenly over all languages; None without any."""
    rows = (learnable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                  F.col("lang").cast("string").alias("lang")))
            .where(F.regexp_like("text", F.lit("\\p{L}"))).withColumn("draw", text_key(F.col("text"))))
    distinct = staged(rows.groupBy("lang", "draw").agg(F.min("doc_id").alias("doc_id")), "langid-texts")
    # the smallest draws of a language are in its first ranges of draws: only as many of those as
    # it needs are ranked, so no language's texts meet in one task
    most = max(bound, LEAST)
    part = F.shiftright("draw", 64 - RANGE_BITS)
    sizes = distinct.groupBy("lang", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    first = sizes.withColumn("before", before).where(F.col("before") < most).select("lang", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    near = distinct.withColumn("part", part).join(first, ["lang", "part"], "left_semi").drop("part")
    # written, so that its size is known and the texts are not shuffled to the join
    ranked = staged(near.withColumn("rank", rank).where(F.col("rank") <= most), "langid-ranked")
    languages = ranked.where("rank = 1").count()
    if not languages:
        return None
    chosen = ranked.where(F.col("rank") <= max(LEAST, bound // languages)).drop("rank")
    drawn = rows.join(chosen, ["lang", "draw", "doc_id"], "left_semi").select("draw", "lang", "text")
    return drawn.mapInArrow(_vectors, "draw long, lang string, v binary").dropDuplicates(["draw", "lang"])


def _trained(batches):
    """The model of all rows given, as one row."""
    import pickle

    import numpy as np
    import pyarrow as pa
    langs, vectors = [], []
    for b in batches:
        langs += b.column("lang").to_pylist()
        vectors += b.column("v").to_pylist()
    matrix = np.frombuffer(b"".join(vectors), "<f2").reshape(-1, DIMENSIONS).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(langs, matrix))], pa.binary())], names=["model"])


def linear_svm(x, y, cost: float = 10.0, epochs: int = 20, seed: int = 7):
    """Weights and bias of a linear SVM with squared hinge loss, by dual
    coordinate descent; ``y`` is +1 or -1.  Both classes weigh the same."""
    import numpy as np
    rng = np.random.default_rng(seed)
    n, d = x.shape
    w, b = np.zeros(d, np.float64), 0.0
    weight = np.where(y > 0, n / (2.0 * max(1, (y > 0).sum())), n / (2.0 * max(1, (y < 0).sum()))) * cost
    diag = 0.5 / weight
    q = (x * x).sum(axis=1) + 1.0 + diag
    alpha = np.zeros(n)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(n):
            g = y[i] * (x[i] @ w + b) - 1 + alpha[i] * diag[i]
            if alpha[i] > 0 or g < 0:
                new = max(alpha[i] - g / q[i], 0.0)
                step = (new - alpha[i]) * y[i]
                if step:
                    w += step * x[i]
                    b += step
                    worst = max(worst, abs(step))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w.astype(np.float32), float(b)


def train(langs: list[str], matrix):
    """{families, family (W, b), members: {family: (langs, [(i, j, w, b)])}}"""
    import numpy as np
    langs = np.array(langs, dtype=object)
    known = sorted(set(langs))
    families = sorted({family_of(x) for x in known})
    fam = np.array([family_of(x) for x in langs], dtype=object)
    family = []
    if len(families) > 1:
        family = [linear_svm(matrix, np.where(fam == f, 1.0, -1.0)) for f in families]
    members = {}
    for f in families:
        own = [x for x in known if family_of(x) == f]
        pairs = []
        for i in range(len(own)):
            for j in range(i + 1, len(own)):
                rows = (langs == own[i]) | (langs == own[j])
                pairs.append((i, j, *linear_svm(matrix[rows], np.where(langs[rows] == own[i], 1.0, -1.0))))
        members[f] = (own, pairs)
    return {"families": families, "family": family, "members": members}


def _predict(model):
    """(doc_id, text) -> (doc_id, lang_pred, score)"""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        features = Features()
        families = model["families"]

        def squash(margin):
            return 1.0 / (1.0 + np.exp(-2.0 * margin))

        def decide(v):
            score, f = 1.0, families[0]
            if len(families) > 1:
                margins = np.array([v @ w + b for w, b in model["family"]])
                best = int(margins.argmax())
                f, score = families[best], squash(margins[best])
            own, pairs = model["members"][f]
            if len(own) == 1:
                return own[0], score
            votes, total = np.zeros(len(own)), np.zeros(len(own))
            for i, j, w, b in pairs:
                m = v @ w + b
                votes[i if m >= 0 else j] += 1
                total[i] += m
                total[j] -= m
            best = max(range(len(own)), key=lambda k: (votes[k], total[k], -k))
            return own[best], score * squash(total[best] / (len(own) - 1))

        for b in batches:
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                v = features(text) if text and families else None
                lang, score = decide(v) if v is not None else (UNDETERMINED, 0.0)
                langs.append(lang)
                scores.append(float(score))
            rest = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "text"]
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*names, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model) -> DataFrame:
    """(doc_id, text_key, lang_pred, score): one row per row of ``docs``; only the text is read."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_predict(model), "doc_id long, text_key long, lang_pred string, score double")


def fit(docs: DataFrame, bound: int = SAMPLE):
    """The model, trained in one task on the sample; its weights reach the driver."""
    import pickle

    import numpy as np
    sample = training_sample(docs, bound)
    if sample is None:
        return train([], np.zeros((0, DIMENSIONS), np.float32))
    rows = sample.repartition(1).sortWithinPartitions("draw", "lang")
    return pickle.loads(rows.mapInArrow(_trained, "model binary").first()["model"])


def accepted(docs: DataFrame, model, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, and no
    score below ``min_score`` (a text that fits no learned language)."""
    # written first: the texts are only shuffled where the set is too large to broadcast
    bad = staged(identify(docs, model).where((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < min_score)).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct(), "langid-bad")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (text_key(docs["text"]) == bad["_text"]), "left_anti")


def op1_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
