"""Periodic run detection with string synchronising sets of words.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``MIN_REPEATS`` periods and ``MIN_WORDS`` words long, that
no neighbouring word extends.  All runs of a text are found exactly:

1. Periods up to ``SMALL`` come from comparing the words with themselves,
   shifted.  These are the highly periodic regions of the first scale.
2. At each dyadic scale t (periods t < q <= 2t), every window of t words has a
   hash; position i is selected if the least hash of the windows i..i+t is that
   of window i or of window i+t.  Whether it is selected depends only on the
   2t words from it on, so equal contexts are selected alike, and any t
   neighbouring positions hold a selected one.  Windows inside runs found so
   far with a period of at most t/4 are left out: such highly periodic regions
   have been detected separately, and their small periods are known.
3. Two neighbouring selected positions with equal 2t-word contexts, t to 2t
   apart, propose their distance as period.  A run of four periods q holds
   such a pair: q + 1 - t or more positions of its first part have a context
   and its next copy inside the run.  As the context is no shorter than the
   period, the proposal is the smallest period.
4. A proposal is extended word by word in both directions and kept if it is
   long enough.  Hashes only propose; words decide.

Collapsing keeps the first period of each run.  A text is handled whole;
texts of a batch are handled together in chunks of bounded size, one long text
in a chunk of its own.

Null and empty texts have no words and no runs.  Ties and repeated rows:
each row is handled on its own.  An empty table gives an empty result.
Columns of the input pass through; result columns take the names given, which
the caller chooses so that none clashes.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices, table

MIN_REPEATS = 4    # periods of the shortest run
MIN_WORDS = 6      # words of the shortest run
SMALL = 8          # periods found by direct comparison; a power of two
CHUNK = 1 << 18    # words handled at a time

RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _stretches(equal):
    """(starts, ends) of the maximal true stretches of a boolean array."""
    import numpy as np
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _mixed(x):
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(x, size: int):
    """Least value of every ``size`` neighbours."""
    import numpy as np
    width, out = 1, x
    while width * 2 <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _matching(a, b) -> int:
    """How many leading elements of two equally long arrays are equal."""
    import numpy as np
    at, step, size = 0, 64, len(a)
    while at < size:
        same = a[at:at + step] == b[at:at + step]
        if not same.all():
            return at + int(np.argmin(same))
        at, step = at + step, step * 2
    return size


def _small_runs(w, least: int) -> list[tuple[int, int, int]]:
    """Runs of periods up to ``SMALL``."""
    import numpy as np
    found = []
    for q in range(1, min(SMALL, len(w) // MIN_REPEATS) + 1):
        starts, ends = _stretches(w[q:] == w[:-q])
        long = ends - starts + q >= least * q
        for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            root = w[s:s + q]
            if not any(q % p == 0 and np.array_equal(root, np.roll(root, p)) for p in range(1, q)):
                found.append((s, e - s + q, q))
    return found


def find_runs(w) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an integer array, by start and period."""
    import numpy as np
    n = len(w)
    found = _small_runs(w, MIN_REPEATS)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    t, h = 1, _mixed(w.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while MIN_REPEATS * (t + 1) <= n:
        twice = _mixed(h[:-t] * np.uint64(0xD6E8FEB86659FD93) + h[t:])  # windows of 2t words
        if t >= SMALL:
            value = np.minimum(h, most - np.uint64(1))
            for s, length, q in found:
                if MIN_REPEATS * q <= t <= length:
                    value[s:s + length - t + 1] = most
            least = _window_min(value, t + 1)                           # of the windows i..i+t
            k = min(len(least), len(twice))
            least = least[:k]
            chosen = np.flatnonzero((least != most) & ((value[:k] == least) | (value[t:t + k] == least)))
            order = chosen[np.argsort(twice[chosen], kind="stable")]
            gap = order[1:] - order[:-1]
            pairs = (twice[order[1:]] == twice[order[:-1]]) & (gap > t) & (gap <= 2 * t)
            at = np.flatnonzero(pairs)
            reached: dict[int, int] = {}                                # period -> end of its last stretch
            for i, q in sorted(zip(order[at].tolist(), gap[at].tolist(), strict=True)):
                if i + q < reached.get(q, 0):
                    continue                                            # inside a stretch that has been extended
                ahead = _matching(w[i:n - q], w[i + q:])
                back = _matching(w[:i][::-1], w[q:i + q][::-1])
                reached[q] = i + ahead + q
                if ahead + back + q >= MIN_REPEATS * q:
                    found.append((i - back, ahead + back + q, q))
        h, t = twice, 2 * t
    return sorted(r for r in set(found) if r[1] >= MIN_WORDS)


def _codes(words: list[list[bytes]]):
    """All words as integers, texts separated by a code of their own; and where each text starts."""
    import numpy as np
    import pyarrow as pa
    flat = pa.array([w for t in words for w in t], pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sizes = np.array([len(t) for t in words], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    codes = np.empty(len(flat) + len(words), dtype=np.int64)
    ends = starts + sizes
    inside = np.ones(len(codes), dtype=bool)
    inside[ends] = False
    codes[inside] = flat
    codes[ends] = len(flat) + np.arange(len(words))
    return codes, starts


def runs_of_texts(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words; lists of like length are searched together."""
    import numpy as np
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    long = sorted((i for i in range(len(words)) if len(words[i]) >= MIN_WORDS), key=lambda i: len(words[i]))
    at = 0
    while at < len(long):
        size, end = 0, at
        while end < len(long) and (end == at or size + len(words[long[end]]) <= CHUNK):
            size += len(words[long[end]])
            end += 1
        chunk = long[at:end]
        codes, starts = _codes([words[i] for i in chunk])
        for s, length, q in find_runs(codes):
            k = int(np.searchsorted(starts, s, side="right")) - 1
            out[chunk[k]].append((s - int(starts[k]), length, q))
        at = end
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run has after its first period."""
    out, at, covered = [], 0, []
    for s, e in sorted((s + q, s + length) for s, length, q in runs):
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    for s, e in covered:
        out += words[at:s]
        at = e
    return out + words[at:]


def detect(docs: DataFrame, arrange=None, runs: str = "runs", collapsed: str = "collapsed", n_words: str = "n_words") -> DataFrame:
    """All rows and columns of ``docs`` with the runs of ``text``, the words left
    when every run is cut to its first period (one space between them), and the
    number of words.  ``arrange(doc_id, words)`` may give the words another order."""
    def run(batches):
        import pyarrow as pa
        for b in (part for batch in batches for part in slices(batch, "text")):
            ids = b.column("doc_id").to_pylist()
            words = [(t or b"").split() for t in b.column("text").cast(pa.binary()).to_pylist()]
            if arrange:
                words = [arrange(i, w) for i, w in zip(ids, words, strict=True)]
            found = runs_of_texts(words)
            left = [b" ".join(kept_words(w, r) if r else w) for w, r in zip(words, found, strict=True)]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            listed = pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in found], kind)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, listed, pa.array(left, pa.binary()).cast(pa.string()), pa.array([len(w) for w in words], pa.int64())],
                names=[*b.schema.names, runs, collapsed, n_words])

    schema = T.StructType([*docs.schema.fields, T.StructField(runs, RUN), T.StructField(collapsed, T.StringType()),
                           T.StructField(n_words, T.LongType())])
    return docs.mapInArrow(run, schema)


def strongest(runs: str) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    def better(a: Column, b: Column) -> Column:
        left, right = (b[x].cast("decimal(19,0)") * a[y].cast("decimal(19,0)") for x, y in (("length", "period"), ("period", "length")))
        return F.when(a.isNull() | (left > right), b).otherwise(a)
    kind = RUN.elementType.simpleString()
    return F.aggregate(F.col(runs), F.lit(None).cast(kind), better)   # runs are in order, so the first of equals stays


def perturbed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's fixed rule: in one document of ten, a periodic tail."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    period = words[a:a + p]
    return words[:a] + period * times + period[:rest]


def op11_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = detect(docs, perturbed).withColumn("best", strongest("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    thousand = (F.col("best.length").cast("decimal(19,0)") * 1000).cast("decimal(38,0)")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.call_function("div", thousand, F.col("best.period").cast("decimal(38,0)")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
