"""SimHash near-duplicates by generalised pigeonhole.

1. Fingerprint: each 3-word shingle is hashed to 64 bits; a fingerprint bit is
   set where more than half of the shingle hashes have it.
2. Equal fingerprints collapse to one row, so a group of exact copies, however
   large, is one row in everything that follows.
3. Statistics over all distinct fingerprints: how often each pair of bits is
   set together, and how many collisions each candidate partition has.
4. Correlated bits are grouped into the same partition.  For m partitions with
   thresholds t_1..t_m, sum t_i = distance - m + 1, some partition of every
   qualifying pair differs in at most its t_i bits.  Dynamic programming picks
   the (unequal) thresholds, and the best m, by the estimated number of probe
   rows and candidates.
5. Every fingerprint is indexed under its own partition values and probes the
   values within t_i flips; an equi-join verifies the full distance.
6. A bucket with too many members is cut into bounded blocks; pairs of blocks
   are searched in tasks of their own and only return a spanning forest, so
   a large group of near copies never lists its pairs.
7. Connected components over the fingerprints.

Nulls, empty texts and texts without a word have fingerprint zero and link
like any other.  A null doc_id never becomes a component id unless its
component has no other.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import constant_array, staged, text_key
from quarry.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
PLANS = (2, 3, 4)         # numbers of partitions that are compared
HOT_CANDIDATES = 1 << 14  # probes times indexed rows above which a bucket is searched in blocks
BLOCK = 8192
#: Cost of a probe row (written, shuffled, joined) against that of verifying one candidate.
PROBE_COST, VERIFY_COST = 1.0, 0.05


def fingerprint_fn(shingle: int = SHINGLE):
    """Arrow-batch function: (doc_id, text) -> (doc_id, text_key, fp)."""
    def run(batches):
        from itertools import accumulate, repeat

        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)

        def fingerprint(text):
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
            n = len(words)
            if not n:
                return 0
            joined = memoryview(b" ".join(words))
            if n <= shingle:
                hashes = [xxh64_intdigest(joined, SEED)]
            else:
                ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
                starts = [0, *(e + 1 for e in ends[:n - shingle])]
                hashes = list(map(xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends[shingle - 1:])),
                                  repeat(SEED)))
            octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
            ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ table for k in range(8)])
            return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])

        for b in batches:
            fps = [fingerprint(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(fps, pa.int64())], names=["doc_id", "text_key", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): one row per row of ``docs``."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(fingerprint_fn(shingle), "doc_id long, text_key long, fp long")


def _bit_pairs(batches):
    """Counts of rows in which bits i and j are both set (i <= j)."""
    import numpy as np
    import pyarrow as pa
    total = np.zeros((64, 64))
    for b in batches:
        fps = b.column("fp").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
        for at in range(0, len(fps), 1 << 16):
            bits = np.unpackbits(fps[at:at + (1 << 16)], axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
    i, j = np.triu_indices(64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j].astype(np.int64))], names=["i", "j", "n"])


def bit_statistics(distinct: DataFrame):
    """(64 x 64) counts of common ones, over every distinct fingerprint."""
    import numpy as np
    rows = (distinct.select("fp").mapInArrow(_bit_pairs, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())
    both = np.zeros((64, 64))
    for i, j, n in rows:
        both[i, j] = both[j, i] = n
    return both


def group_bits(both, n: int, m: int) -> list[list[int]]:
    """``m`` groups of near-equal size; bits join the group they correlate with most."""
    import numpy as np
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(64)), []
    for g in range(m):
        size = 64 // m + (g < 64 % m)
        seed = max(free, key=lambda b: (corr[b, free].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            nxt = max(free, key=lambda b: (corr[b, group].mean(), -b))
            group.append(nxt)
            free.remove(nxt)
        groups.append(sorted(group))
    return groups


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def mask_of(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def flips(bits, t: int) -> list[int]:
    """All changes of at most ``t`` of the bits, none first."""
    return [mask_of(c) for k in range(t + 1) for c in combinations(bits, k)]


def _within(bits, ones, n: int, distance: int) -> list[float]:
    """P(two random rows differ in at most t of the bits) / P(in none), t = 0..distance."""
    probs = [1.0]
    for b in bits:
        p = min(max(ones[b] / max(n, 1), 1e-3), 1 - 1e-3)
        d = 2 * p * (1 - p)
        probs = [(probs[k] if k < len(probs) else 0.0) * (1 - d) + (probs[k - 1] * d if k else 0.0)
                 for k in range(min(len(probs) + 1, distance + 1))]
    probs += [0.0] * (distance + 1 - len(probs))
    return [sum(probs[:t + 1]) / probs[0] for t in range(distance + 1)]


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1 or more) with the given sum and the least cost.

    ``costs[i][t]`` is the cost of threshold t in partition i; -1 (the
    partition is not probed) costs nothing.  Knapsack over the partitions.
    """
    best = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t in range(-1, len(row)):
                cand = (c + (row[t] if t >= 0 else 0.0), [*ts, t])
                if s + t not in nxt or cand < nxt[s + t]:
                    nxt[s + t] = cand
        best = nxt
    return best[total]


def choose_partitions(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest plan; what reaches the driver is
    64 x 64 counts and one collision count per candidate partition."""
    import math
    both = bit_statistics(distinct)
    n = distinct.count()
    ones = both.diagonal()
    plans = {m: group_bits(both, n, m) for m in PLANS if m <= distance + 1}
    probes = [(m, i, mask_of(bits)) for m, groups in plans.items() for i, bits in enumerate(groups)]
    keys = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                                        F.col("fp").bitwiseAND(F.lit(mask)).alias("key")) for m, i, mask in probes]))
    pairs = {(r.m, r.i): float(r.pairs) for r in
             distinct.select(keys.alias("k")).groupBy("k.m", "k.i", "k.key").count()
             .groupBy("m", "i").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs")).collect()}
    found = []
    for m, groups in plans.items():
        costs = []
        for i, bits in enumerate(groups):
            ratio = _within(bits, ones, n, distance)
            costs.append([PROBE_COST * n * sum(math.comb(len(bits), k) for k in range(t + 1))
                          + VERIFY_COST * pairs.get((m, i), 0.0) * ratio[t] for t in range(distance + 1)])
        found.append((*allocate(costs, distance - m + 1), groups))
    cost, ts, groups = min(found, key=lambda x: x[0])
    return [(bits, t) for bits, t in zip(groups, ts, strict=True) if t >= 0]


def _probe_rows(distinct: DataFrame, parts) -> DataFrame:
    """(fp, part, key, own): the index row (own) and the probes of every fingerprint."""
    def probes(i, bits, t):
        return F.transform(constant_array(flips(bits, t), "bigint"), lambda f: F.struct(
            F.lit(i).alias("part"), F.col("fp").bitwiseXOR(f).bitwiseAND(F.lit(mask_of(bits))).alias("key"),
            (f == 0).alias("own")))
    lists = [probes(i, bits, t) for i, (bits, t) in enumerate(parts)]
    return distinct.select("fp", F.explode(F.concat(*lists)).alias("p")).select("fp", "p.*")


def spanning_forest(fps, distance: int):
    """Edges of a spanning forest of the links among the given fingerprints.

    Breadth first: a row leaves the unvisited set as soon as it is reached,
    so a dense group costs little more than one pass over it.
    """
    import numpy as np
    left = np.unique(np.asarray(fps, dtype=np.int64)).view(np.uint64)
    a, b = [], []
    while len(left):
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            reached = np.zeros(len(left), bool)
            via = np.zeros(len(left), np.uint64)
            step = max(1, (1 << 21) // len(left))
            for at in range(0, len(frontier), step):
                open_ = np.flatnonzero(~reached)
                if not len(open_):
                    break
                f = frontier[at:at + step]
                near = np.bitwise_count(f[:, None] ^ left[open_][None, :]) <= distance
                hit = near.any(axis=0)
                reached[open_[hit]] = True
                via[open_[hit]] = f[near[:, hit].argmax(axis=0)]
            a.append(via[reached])
            b.append(left[reached])
            frontier, left = left[reached], left[~reached]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]).view(np.int64), np.concatenate([none, *b]).view(np.int64)


def links(distinct: DataFrame, distance: int = DISTANCE, parts=None) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs at most
    ``distance`` bits apart.  Outside large buckets they are all such pairs."""
    if distance < 1:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    parts = parts or choose_partitions(distinct, distance)
    rows = _probe_rows(distinct, parts)
    hot = staged(rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("long")).alias("own"))
                 .where(F.col("n") * F.col("own") > HOT_CANDIDATES).select("part", "key", "n"), "simhash-hot")
    cold = rows.join(hot, ["part", "key"], "left_anti")
    own = cold.where("own").select("part", "key", F.col("fp").alias("a"))
    pairs = (own.join(cold.select("part", "key", F.col("fp").alias("b")), ["part", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
             .select("a", "b"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    large = (rows.join(hot, ["part", "key"]).withColumn("blocks", blocks).withColumn("mine", mine)
             .select("part", "key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("part", "key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def search(pdf):
        import pandas as pd
        a, b = spanning_forest(pdf["fp"].to_numpy(), distance)
        return pd.DataFrame({"a": a, "b": b})

    forest = large.groupBy("part", "key", "i", "j").applyInPandas(search, "a long, b long")
    return pairs.unionByName(forest)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, text_key, fp, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``distance`` differing bits, the document itself included.  An empty
    table gives an empty result.  Repeated rows and extra columns are allowed.
    """
    fps = staged(fingerprints(docs, shingle), "simhash-fp")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    comp = components(links(distinct, distance))
    label = distinct.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = label.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = staged(label.join(smallest, "component").select("fp", "component", "component_id"), "simhash-label")
    return fps.join(ids, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each group: the smallest
    doc_id.  Where that id is on several rows (or the group has no id), the
    row with the smallest text hash stays, once."""
    near = staged(near_duplicates(docs, shingle, distance), "simhash-near")
    mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = near.groupBy("component").agg(F.min(mine).alias("first"))
    # what goes is written first: the texts are only shuffled where it is too large to broadcast
    gone = staged(near.join(chosen, "component").where(mine != F.col("first")).select("doc_id", "text_key").distinct(), "simhash-gone")
    again = staged(near.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "simhash-again")

    def row_in(other, df):
        return df["doc_id"].cast("long").eqNullSafe(other["_id"]) & (text_key(df["text"]) == other["_text"])

    gone, again = (x.toDF("_id", "_text") for x in (gone, again))
    rest = docs.join(gone, row_in(gone, docs), "left_anti")
    twice = rest.join(again, row_in(again, rest), "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(again, row_in(again, rest), "left_anti").unionByName(twice)


def op2_simhash(spark, sf_dir):
    from quarry.llm.common import table
    near = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
