"""Benchmark decontamination as a prefix-filtered set join.

1. Words are runs of ASCII letters and digits (A-Z lowered) and of any
   non-ASCII characters.  A window is ``WINDOW`` consecutive item words; a
   shorter item is one window.  The tokens of a window are its shingles of
   ``SHINGLE`` words (the whole window where it is shorter).
2. One pass over the documents keeps the runs of positions whose shingles may
   all be benchmark shingles, tested against a bitmap of fixed size, and that
   are long enough for the shortest window (length bound).  The bitmap has no
   false negatives, so no occurrence is lost.
3. Shingles are ordered by rarity, counted over those runs in all documents.
   Every window must hold all its shingles, so its necessary prefix is the
   single rarest one.
4. An equi-join on the prefix shingle gives candidates; the window must lie
   inside the run (positional bound) and the words are compared exactly.

Null and empty texts have no words.  An empty benchmark, or an empty table of
documents, gives zero hits or no rows.  A row is one result row, also when it
repeats; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import UPPER, staged, table, text_key

WINDOW = 10
SHINGLE = 3
BITS = 23  # the bitmap has 2^23 bits (1 MB), whatever the size of the benchmark


def _tokenizer():
    """(words, hashes): the words of a text; the hashes of its k-word shingles."""
    import numpy as np
    from xxhash import xxh64_intdigest

    keep = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
    factor = np.uint64(0x9E3779B97F4A7C15)

    def words(text):
        return text.encode("utf-8", "surrogatepass").lower().translate(keep).split() if text else []

    def hashes(ws, k):
        if len(ws) < k:
            return np.zeros(0, np.uint64)
        one = np.fromiter(map(xxh64_intdigest, ws), np.uint64, len(ws))
        h = np.zeros(len(ws) - k + 1, np.uint64)
        for j in range(k):
            h = h * factor + one[j:len(ws) - k + 1 + j]
            h ^= h >> np.uint64(29)
        return h

    return words, hashes


def _item_windows(window: int, shingle: int):
    """(item_id, text) -> one row per window of an item."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        words, hashes = _tokenizer()
        for b in batches:
            out = {"item_id": [], "win": [], "len": [], "size": [], "h": []}
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = words(text)
                n = min(window, len(ws))
                k = min(shingle, n)
                h = hashes(ws, k).view(np.int64).tolist() if n else []
                for at in range(len(ws) - n + 1 if n else 0):
                    out["item_id"].append(item)
                    out["win"].append(b" ".join(ws[at:at + n]).decode("utf-8", "surrogatepass"))
                    out["len"].append(n)
                    out["size"].append(k)
                    out["h"].append(h[at:at + n - k + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item_id"], pa.string()), pa.array(out["win"], pa.string()), pa.array(out["len"], pa.int32()),
                 pa.array(out["size"], pa.int32()), pa.array(out["h"], pa.list_(pa.int64()))], names=list(out))
    return run


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, win, len, size, h): every window of every item, with its shingle hashes."""
    src = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_item_windows(window, shingle),
                          "item_id string, win string, len int, size int, h array<long>").distinct()


def _document_runs(bitmap: bytes, sizes: dict[int, int]):
    """(doc_id, text) -> (doc_id, text_key, n_words, runs).

    ``sizes``: for each shingle size, the least number of consecutive shingles
    that a window of that size has.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        words, hashes = _tokenizer()
        bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)
        low = np.uint64(len(bits) - 1)
        kind = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("words", pa.string()), ("h", pa.list_(pa.int64()))]))

        def runs(ws):
            found = []
            for k, least in sizes.items():
                h = hashes(ws, k)
                if len(h) < least:
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate([[False], bits[h & low], [False]]).view(np.int8)))
                for a, z in edge.reshape(-1, 2):
                    if z - a >= least:
                        found.append({"at": int(a), "size": k, "words": b" ".join(ws[a:z + k - 1]).decode("utf-8", "surrogatepass"),
                                      "h": h[a:z].view(np.int64)})
            return found

        for b in batches:
            n, found = [], []
            for text in b.column("text").to_pylist():
                ws = words(text)
                n.append(len(ws))
                found.append(runs(ws))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(found, kind)],
                                             names=["doc_id", "text_key", "n_words", "runs"])
    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items, contaminated): one row per row of ``docs``."""
    wins = staged(item_windows(items, window, shingle), "decontam-windows")
    # what reaches the driver: the set bytes of the bitmap, and one row per shingle size
    slots = wins.select(F.explode("h").alias("h")).select(F.col("h").bitwiseAND((1 << BITS) - 1).alias("s"))
    octets = slots.groupBy(F.shiftright("s", 3).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(s & 7 AS int))")).alias("set")).toLocalIterator()
    bitmap = bytearray(max(1, 1 << (BITS - 3)))
    for r in octets:
        bitmap[r["at"]] = r["set"]
    sizes = {r["size"]: r["least"] for r in
             wins.groupBy("size").agg(F.min(F.col("len") - F.col("size") + 1).alias("least")).collect()}
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                      F.col("text").cast("string").alias("text"))
    scanned = staged(
        src.mapInArrow(_document_runs(bytes(bitmap), sizes),
                       "doc_id long, text_key long, n_words long, runs array<struct<at:int,size:int,words:string,h:array<long>>>")
        .withColumn("row", F.monotonically_increasing_id()), "decontam-runs")

    # one row per position of a run, with the words that a window through it can reach
    reach = window - 1
    runs = (scanned.where(F.size("runs") > 0).select("row", F.explode("runs").alias("r"))
            .select("row", "r.at", "r.size", "r.h", F.split("r.words", " ").alias("w")))
    first = F.greatest(F.col("k") - reach, F.lit(0))
    at = runs.select("row", "at", "size", "w", F.posexplode("h").alias("k", "h")).select(
        "row", "size", "h", (F.col("at") + first).cast("long").alias("from"), (F.col("k") - first).alias("before"),
        F.slice("w", first + 1, F.lit(2 * window)).alias("around"))
    rarity = at.groupBy("size", "h").agg(F.count(F.lit(1)).alias("n"))
    windows = wins.select("win", "len", "size", "h").distinct()
    prefix = (windows.select("win", "len", "size", F.size("h").alias("shingles"), F.posexplode("h").alias("k", "h"))
              .join(rarity, ["size", "h"])
              .groupBy("win", "len", "size", "shingles").agg(F.min(F.struct("n", "h", "k")).alias("p"), F.count(F.lit(1)).alias("present"))
              .where("present = shingles")
              .select("win", "len", "size", F.col("p.h").alias("h"), F.col("p.k").alias("offset")))
    start = F.col("before") - F.col("offset")
    hits = staged(
        at.join(prefix, ["size", "h"])
        .where((start >= 0) & (start + F.col("len") <= F.size("around")))
        .where(F.array_join(F.slice("around", F.greatest(start, F.lit(0)) + 1, F.col("len")), " ") == F.col("win"))
        .select("row", "win", (F.col("from") + start).alias("start"), (F.col("from") + start + F.col("len")).alias("end")).distinct(),
        "decontam-hits")

    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "end"))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["to"]))).alias("n"),
                              F.greatest(a["to"], x["end"]).alias("to")), lambda a: a["n"])
    words = hits.groupBy("row").agg(covered.alias("n_hit"))
    named = (hits.select("row", "win").distinct().join(wins.select("win", "item_id").distinct(), "win")
             .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    found = words.join(named, "row")
    return scanned.drop("runs").join(found, "row", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns unchanged."""
    # written first: the texts are only shuffled where the set is too large to broadcast
    bad = staged(contamination(docs, items, window, shingle).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct(), "decontam-bad")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (text_key(docs["text"]) == bad["_text"]), "left_anti")


def op5_decontam(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS_SQL} AS w FROM benchmark),
n AS (SELECT item_id, w, least({WINDOW}, len(w)) AS k FROM i WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS win
         FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM n)),
ks AS (SELECT DISTINCT k FROM wins),
spans AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT doc_id, p, wins.k AS k, item_id FROM spans JOIN wins ON spans.k = wins.k AND spans.win = wins.win),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""
