"""Phrase collocation mining by dynamic itemset counting.

Texts are lower-cased (A-Z only), cut into pieces and those into words.  A
phrase is 1 to ``LONGEST`` consecutive words of a piece; all counts are per
language.  Phrases are counted over ``shards`` equal parts of the rows, which
are scanned in a cycle, one part a step, all lengths in the same scan:

1. A word may be counted from the first step on, a longer phrase from the step
   on at which both its subphrases (without the last, without the first word)
   have reached the threshold.
2. A phrase that may be counted is activated at the first step in which its
   shard holds 1/``shards`` of the threshold or more.  A phrase that reaches
   the threshold does so in one of the next ``shards`` steps, as its
   occurrences are dealt over so many shards; what is not activated by then
   never reaches it.  So no row is kept for the many rare phrases.
3. An active phrase is counted for one full cycle, the step of its activation
   included: after that its count is that of all rows.
4. The scans go on until nothing is active and nothing can be activated.

The texts are read once: each part of them becomes codes and a dictionary with
the counts of its words in every shard.  Words below the threshold are in no
phrase that reaches it; the others get a number, joined to the dictionaries,
and the shards keep these numbers only.  A phrase is the numbers of its words,
two longs; it is spelt again at the end.  The steps take the counts of words
from the dictionaries and those of longer phrases from the shards.

Each task counts its rows with NumPy and gives one row per phrase and part of
a batch; a shuffle adds them up.  Tasks know the phrases that may matter by
bitmaps of fixed size (collisions let further phrases through, which the exact
joins behind the shuffle drop).  In the first cycle, when most phrases come up,
a shard is scanned twice: the first scan adds up 64-bit hashes of the phrases,
packed in ranges of hashes, to find the few that have 1/``shards`` of the
threshold; phrases with such a hash are then counted exactly.  The state, one
row per activated phrase, is a table in the shared folder, written anew at
each step; only phrases that are active or new are shuffled for it.

A null text is empty, a null language ``und``.  Rows count as often as they
are given.  An empty table gives no phrase.  Other columns are ignored.  Ties
are ranked by count, then phrase.  Texts are handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import slices, slot_bitmap, staged, table
from quarry.session import scratch_path

LONGEST = 4
THRESHOLD = 30       # occurrences of a candidate
COVERED_PERCENT = 80  # a longer candidate with so much of its count hides a phrase
TOP = 2000           # phrases reported per language
SHARDS = 3
BITS = 23            # of each bitmap
PENDING = 1 << 20    # partial counts that a task adds up before it passes them on
PART = 1 << 22       # bytes of text that a task takes at a time, with one dictionary of words
IDS = 1 << 21        # bytes of word ids that a task counts at a time
SLICES = 16          # parts of a language ranked on their own first

# fixed values: the piece separators [.,;:!?\x0A-\x0D] and the word separators [\x20\x09]
PIECE_END, WORD_END = b".,;:!?\n\x0b\x0c\r", b" \t"
#: A-Z to a-z, every piece separator to a newline, every word separator to a space.
FOLDED = bytes(10 if c in PIECE_END else 32 if c in WORD_END else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Odd multipliers of the places of a phrase in the sum that gives its bits.
PLACES = (0x2545F491, 0x1B873593, 0x3C6EF373, 0x19D699A5)
MASK = (1 << BITS) - 1
SECOND = 9           # the second bit of an active phrase is this much further up in its sum
LOW = (1 << 32) - 1  # a key has two word ids in each of its two longs: hi, lo
NUMBERS = 1024       # groups of words numbered on their own


def _ids() -> list[Column]:
    """The four word ids of a phrase's key; 0 where it is shorter."""
    return [F.shiftrightunsigned("hi", 32), F.col("hi").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned("lo", 32), F.col("lo").bitwiseAND(F.lit(LOW))]


def _sum() -> Column:
    """The 32-bit sum that gives a phrase's bits; the tasks compute the same (``_lengths``)."""
    total = F.lit(0).cast("long")
    for word, by in zip(_ids(), PLACES, strict=True):
        total = total + (word * F.lit(by).cast("long")).bitwiseAND(F.lit(LOW))
    return total.bitwiseAND(F.lit(LOW))


def _tokens(texts: list[bytes]):
    """(codes, word values, piece, first byte) of all words of some texts: equal codes for equal words."""
    import numpy as np
    import pyarrow as pa
    raw = np.frombuffer(b"".join((b"\n", b"\n".join(texts).translate(FOLDED), b"\n")), dtype=np.uint8)
    ends = raw == 10
    word = ~(ends | (raw == 32))
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1     # the text begins and ends outside a word
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    piece = np.searchsorted(np.flatnonzero(ends), starts)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word])]).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary, piece, starts


def _cut(data, lengths):
    """A binary array of pieces of ``data`` with so many items each."""
    import numpy as np
    import pyarrow as pa
    offsets = np.concatenate(([0], np.cumsum(lengths))) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _split(docs: DataFrame, shards: int) -> DataFrame:
    """Parts of the texts of one language, about ``PART`` bytes or one
    text, with a dictionary each.

    Two kinds of rows: one for each text with a word, with its codes in the
    part's dictionary (0 ends a piece) and number of words, and one for each
    word of a part, with its code and its count in each shard."""
    lang = F.coalesce(docs["lang"].cast("string"), F.lit("und"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(lang.alias("lang"), text.alias("text"), F.pmod(F.xxhash64(docs["doc_id"], text), F.lit(shards)).cast("int").alias("shard"))
    counts = [f"c{i}" for i in range(shards)]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        kinds = {"part": pa.int64(), "lang": pa.string(), "shard": pa.int32(), "codes": pa.binary(), "size": pa.int32(),
                 "word": pa.string(), "code": pa.int32(), **dict.fromkeys(counts, pa.int64())}
        number = TaskContext.get().partitionId() << 32

        def batch(m, lang, **columns):
            columns = {"part": pa.array(np.full(m, number)), "lang": pa.array([lang] * m, pa.string()), **columns}
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(m, t)) for c, t in kinds.items()], schema=pa.schema(list(kinds.items())))

        def part(lang, texts, shard):
            codes, values, piece, starts = _tokens(texts)
            if not len(codes):
                return
            ends = np.concatenate((piece[1:] != piece[:-1], [True]))
            at = np.arange(len(codes)) + np.concatenate(([0], np.cumsum(ends)[:-1]))
            out = np.zeros(at[-1] + 2, dtype=np.int32)
            out[at] = codes + 1
            text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts - 1, side="right")
            first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            shard = np.array(shard)[text]
            lengths = np.diff(np.append(at[first], len(out)))
            yield batch(len(first), lang, shard=pa.array(shard[first].astype(np.int32)), codes=_cut(out, lengths),
                        size=pa.array(np.diff(np.append(first, len(codes))).astype(np.int32)))
            m = len(values)
            n = np.bincount(codes * shards + shard, minlength=m * shards).reshape(m, shards)
            words = values.cast(pa.large_string()).cast(pa.string())
            for i in range(0, m, 1 << 16):
                j = min(m, i + (1 << 16))
                yield batch(j - i, lang, word=words[i:j], code=pa.array(np.arange(i + 1, j + 1, dtype=np.int32)),
                            **{c: pa.array(n[i:j, k].copy()) for k, c in enumerate(counts)})

        held: dict[str, list] = {}
        total = 0
        for b in (x for whole in batches for x in slices(whole, "text", PART // 8)):
            for lang, text, shard in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("shard").to_pylist(), strict=True):
                mine = held.setdefault(lang, [0, [], []])
                mine[0] += len(text)
                mine[1].append(text)
                mine[2].append(shard)
                total += len(text)
            full = list(held) if total >= 4 * PART else [x for x, mine in held.items() if mine[0] >= PART - PART // 8]
            for lang in full:
                size, texts, shard = held.pop(lang)
                total -= size
                yield from part(lang, texts, shard)
                number += 1
        for lang, (_, texts, shard) in held.items():
            yield from part(lang, texts, shard)
            number += 1

    schema = "part long, lang string, shard int, codes binary, size int, word string, code int, " + ", ".join(f"{c} long" for c in counts)
    return staged(rows.mapInArrow(run, schema), "phrases-parts")


def _numbered(parts: DataFrame, threshold: int, shards: int) -> DataFrame:
    """(lang, word, id, count in each shard) of the words with ``threshold`` occurrences or more."""
    counts = [f"c{i}" for i in range(shards)]
    sums = parts.where("word IS NOT NULL").groupBy("lang", "word").agg(*[F.sum(c).alias(c) for c in counts])
    often = sums.where(sum((F.col(c) for c in counts[1:]), F.col(counts[0])) >= threshold)
    often = often.withColumn("b", F.pmod(F.xxhash64("lang", "word"), F.lit(NUMBERS)))
    number = (F.row_number().over(Window.partitionBy("b").orderBy("lang", "word")) - 1).cast("long") * NUMBERS + F.col("b") + 1
    fits = F.when(number < 1 << 31, number.cast("int")).otherwise(F.raise_error(F.lit("too many words to number")))
    return staged(often.select("lang", "word", fits.alias("id"), *counts), "phrases-words")


def _encoded(parts: DataFrame, words: DataFrame) -> DataFrame:
    """(ids, size, shard), written by shard: a row for each text, its words as
    ids; 0 for the end of a piece and for words below the threshold."""
    known = slot_bitmap(words.select(F.xxhash64("lang", "word")))
    used = parts.where("word IS NOT NULL").select("part", "lang", "word", "code").where(known(F.xxhash64("lang", "word")))
    used = used.join(words.select("lang", "word", "id"), ["lang", "word"]).select("part", "code", "id").toDF("part", "code", "id")
    texts = parts.where("codes IS NOT NULL").select("part", "shard", "codes")

    def run(used, texts):
        import numpy as np
        import pyarrow as pa
        schema = pa.schema([("shard", pa.int32()), ("size", pa.int32()), ("ids", pa.binary())])
        if not (used.num_rows and texts.num_rows):
            return schema.empty_table()
        codes = texts["codes"].to_pylist()
        lengths = np.array([len(c) for c in codes]) // 4
        codes = np.frombuffer(b"".join(codes), dtype=np.int32)
        ids = np.zeros(int(codes.max()) + 1, dtype=np.int32)
        ids[used["code"].to_numpy()] = used["id"].to_numpy()
        ids = ids[codes]
        kept = ids > 0
        kept[1:] |= kept[:-1]            # one 0 after a stretch of words; every text ends with one
        lengths = np.add.reduceat(kept.astype(np.int64), np.concatenate(([0], np.cumsum(lengths)[:-1])))
        some = lengths > 0
        return pa.Table.from_arrays([texts["shard"].combine_chunks().filter(pa.array(some)), pa.array(lengths[some].astype(np.int32)),
                                     _cut(ids[kept], lengths[some])], schema=schema)

    path = scratch_path(parts.sparkSession, "phrases-shards")
    rows = used.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(run, "shard int, size int, ids binary")
    rows.write.partitionBy("shard").parquet(path)
    return parts.sparkSession.read.schema("size int, ids binary, shard int").parquet(path)


def _bits(bitmap: bytes):
    """A bitmap as an array of 0 and 1."""
    import numpy as np
    return np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little")


def _flags(bitmaps):
    """An array of bytes, with one bit from each bitmap."""
    out = _bits(bitmaps[0])
    for i, b in enumerate(bitmaps[1:], 1):
        out |= _bits(b) << i
    return out


def _lengths(ids, flags, hashed: bool):
    """(length, places that may be counted, those of active phrases, 64-bit hashes of all
    places or None) for each length from 2; ``flags``: see ``_bitmaps``."""
    import numpy as np
    n, code = len(ids), ids.astype(np.uint32)
    inside = word = ids > 0
    sums = code * np.uint32(PLACES[0])
    hashes = _mixed(code.astype(np.uint64)) if hashed else None
    here = flags[sums & np.uint32(MASK)]
    for k in range(2, LONGEST + 1):
        n -= 1
        if n <= 0:
            return
        last = code[k - 1:]
        inside = inside[:n] & word[k - 1:]
        # prefix at i, suffix at i + 1
        usable = inside & (here[:n] & here[1:] & 1).view(bool)
        fresh = (here[:n] | here[1:]) & 2 > 0
        sums = sums[:n] + last * np.uint32(PLACES[k - 1])
        if hashed:
            hashes = _mixed(hashes[:n] * np.uint64(0xD6E8FEB86659FD93) + last)
        here = flags[sums & np.uint32(MASK)]
        going = usable & (here & 4 > 0)
        going &= flags[(sums >> np.uint32(SECOND)) & np.uint32(MASK)] & 8 > 0
        yield k, usable & fresh & ~going, going, hashes


def _mixed(x):
    """Spreads the bits of unsigned 64-bit integers."""
    import numpy as np
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _parts_of(batches):
    """The word ids of parts of Arrow batches; each text's end with a 0."""
    import numpy as np
    for b in (part for batch in batches for part in slices(batch, "ids", IDS)):
        yield np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype=np.int32)


def _likely(rows: DataFrame, step: int, shards: int, threshold: int, bitmaps) -> bytes:
    """Bitmap of the hashes that 1/``shards`` of the threshold or more of the
    places in a shard have which may be counted and are not of active phrases;
    two bits for each.

    Every task sorts the hashes of a part of its rows and cuts them by range;
    a range meets in one task and is a few megabytes, whatever the input, as
    there are as many ranges as it has such parts."""
    shard = rows.where(F.col("shard") == step % shards)
    size = shard.agg(F.coalesce(F.sum(F.col("size").cast("long")), F.lit(0))).first()[0]
    bits = max(8, (4 * size // IDS).bit_length())

    def hashed(batches):
        import numpy as np
        import pyarrow as pa
        flags = _flags(bitmaps)
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        for ids in _parts_of(batches):
            parts = [hashes[wanted] for _, wanted, _, hashes in _lengths(ids, flags, True)]
            h, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            n = n.astype(np.uint32)
            cut = np.append(np.searchsorted(h, edges), len(h))
            filled = np.flatnonzero(cut[1:] > cut[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled.astype(np.int64)), pa.array([h[cut[i]:cut[i + 1]].tobytes() for i in filled], pa.binary()),
                 pa.array([n[cut[i]:cut[i + 1]].tobytes() for i in filled], pa.binary())], names=["range", "h", "n"])

    def added(batches):
        import numpy as np
        import pyarrow as pa

        def slots(parts):
            h, n = (np.concatenate([np.frombuffer(x[i], dtype=t) for x in parts]) for i, t in ((0, np.uint64), (1, np.uint32)))
            order = np.argsort(h, kind="stable")
            h, n = h[order], n[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            many = h[first][np.add.reduceat(n, first) * shards >= threshold]
            both = np.unique(np.concatenate((many & np.uint64(MASK), (many >> np.uint64(BITS)) & np.uint64(MASK))))
            return pa.RecordBatch.from_arrays([pa.array(both.astype(np.int64))], names=["s"])

        at, parts = None, []
        for b in batches:
            for r, h, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if r != at and parts:
                    yield slots(parts)
                    parts = []
                at = r
                parts.append((h, n))
        if parts:
            yield slots(parts)

    sums = shard.select("ids").mapInArrow(hashed, "range long, h binary, n binary").repartition("range").sortWithinPartitions("range")
    return _bitmap(sums.mapInArrow(added, "s long"))


def _scan(rows: DataFrame, step: int, shards: int, bitmaps, likely: bytes | None) -> DataFrame:
    """(hi, lo, n): partial counts of the phrases of two words and more of one shard."""
    names = ["hi", "lo", "n"]

    def added(pending):
        """The counts of several parts, one row per phrase."""
        import pyarrow as pa
        sums = pa.Table.from_batches(pending).group_by(names[:2], use_threads=False).aggregate([("n", "sum")])
        return sums.select([*names[:2], "n_sum"]).rename_columns(names).to_batches(max_chunksize=1 << 16)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        pending = []
        flags = _flags(bitmaps)
        enough = None if likely is None else _bits(likely).view(bool)
        for ids in _parts_of(batches):
            for k, wanted, going, hashes in _lengths(ids, flags, enough is not None):
                at = np.flatnonzero(wanted)
                if enough is not None:
                    h = hashes[at]
                    at = at[enough[h & np.uint64(MASK)] & enough[(h >> np.uint64(BITS)) & np.uint64(MASK)]]
                at = np.concatenate((at, np.flatnonzero(going)))
                if len(at):
                    w = [ids[at + j].astype(np.int64) if j < k else np.zeros(len(at), np.int64) for j in range(LONGEST)]
                    one = pa.table([pa.array(w[0] << 32 | w[1]), pa.array(w[2] << 32 | w[3])], names=names[:2])
                    pending += one.group_by(names[:2], use_threads=False).aggregate([([], "count_all")]).rename_columns(names).to_batches()
                if sum(len(b) for b in pending) >= PENDING:
                    yield from added(pending)
                    pending = []
        if pending:
            yield from added(pending)
        pa.default_memory_pool().release_unused()    # the worker lives on

    return rows.where(F.col("shard") == step % shards).select("ids").mapInArrow(run, "hi long, lo long, n long")


def _bitmap(slots: DataFrame) -> bytes:
    """The bitmap of a table of slots (s); of fixed size, whatever the table."""
    import numpy as np
    words = slots.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b"))
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for r in words.toArrow().to_batches():
        out[r.column(0).to_numpy()] = r.column(1).to_numpy()
    return out.tobytes()


def _bitmaps(state: DataFrame, step: int, shards: int, usable: bytes) -> tuple[bytes, ...]:
    """The bitmaps of a step: phrases whose extensions may be counted
    (``usable``: the last step's), those that came to it in the last cycle,
    and, by two different bits, active ones."""
    import numpy as np
    low, high = _sum().bitwiseAND(F.lit(MASK)), F.shiftright(_sum(), SECOND).bitwiseAND(F.lit(MASK))
    active = F.col("listed") > step - shards
    kinds = [(F.col("since").between(step - shards + 1, step), low), (active, low), (active, high)]
    slots = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(i).alias("kind"), s.alias("s"))) for i, (c, s) in enumerate(kinds)]))
    words = (state.where(active | (F.col("since") > step - shards)).select(F.explode(slots).alias("x")).select("x.*")
             .groupBy("kind", F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b")))
    out = [np.zeros(1 << (BITS - 6), dtype=np.int64) for _ in kinds]
    for r in words.toArrow().to_batches():
        kind, w, b = (r.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        for i in range(len(kinds)):
            out[i][w[kind == i]] = b[kind == i]
    return tuple(x.tobytes() for x in (np.frombuffer(usable, dtype=np.int64) | out[0], *out))


STATE = "hi long, lo long, count long, listed int, since int"


def _advance(state: DataFrame, counts: DataFrame, step: int, shards: int, threshold: int) -> DataFrame:
    """The state after a step: ``listed`` is the step of a phrase's activation,
    ``since`` the first step in which its extensions may be counted.

    A phrase that was active for a full cycle only goes on as it is: its parts
    were usable when it was activated, so it is not allowed again."""
    key = ("hi", "lo")
    done = F.col("listed") <= step - shards
    none = F.lit(None).cast("int")
    both = counts.select(*key, F.col("n").alias("c"), F.lit(0).cast("long").alias("count"), none.alias("listed"), none.alias("since")).unionByName(
        state.where(~done).withColumn("c", F.lit(0).cast("long")))
    merged = both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("c", "count")], *[F.max(c).alias(c) for c in ("listed", "since")])
    merged = merged.where(F.col("listed").isNotNull() | (F.col("c") * shards >= threshold))

    _, b, c, d = _ids()
    top = F.lit(~LOW)
    known = state.where((F.col("since") <= step) & (d == 0)).select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), "since")
    # a word's prefix is itself and its suffix 0, which no phrase has
    parts = merged.withColumns({"prefix_hi": F.when(F.col("lo") == 0, F.col("hi").bitwiseAND(top)).otherwise(F.col("hi")),
                                "prefix_lo": F.when(d == 0, F.lit(0).cast("long")).otherwise(F.col("lo").bitwiseAND(top)),
                                "suffix_hi": F.shiftleft(b, 32).bitwiseOR(c), "suffix_lo": F.shiftleft(d, 32)})
    for side in ("prefix", "suffix"):
        parts = parts.join(known.toDF(f"{side}_hi", f"{side}_lo", f"{side}_since"), [f"{side}_hi", f"{side}_lo"], "left")
    both_since = F.when(F.col("prefix_since").isNotNull() & F.col("suffix_since").isNotNull(), F.greatest("prefix_since", "suffix_since"))
    allowed = F.when(b == 0, F.lit(step < shards)).otherwise(F.coalesce(both_since > step - shards, F.lit(False)))
    counted = parts.where(F.col("listed").isNotNull() | allowed).select(
        *key, (F.col("count") + F.col("c")).alias("count"), F.coalesce(F.col("listed"), F.lit(step)).alias("listed"), "since")
    reached = F.coalesce(F.col("since"), F.when(F.col("count") >= threshold, step + 1))
    return staged(counted.withColumn("since", reached).unionByName(state.where(done)), "phrases-state")


def count_phrases(docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, n): all phrases of 1 to ``LONGEST`` words with
    ``threshold`` occurrences or more, and their counts; (lang, n): all words)."""
    spark = docs.sparkSession
    parts = _split(docs, shards)
    words = _numbered(parts, threshold, shards)
    rows = _encoded(parts, words)
    state = spark.createDataFrame([], STATE)
    step, bitmaps = 0, (bytes(1 << (BITS - 3)),) * 4
    while step < shards or any(b.strip(b"\0") for b in bitmaps[1:]):
        counts = spark.createDataFrame([], "hi long, lo long, n long")
        if any(b.strip(b"\0") for b in bitmaps[1:]):
            likely = _likely(rows, step, shards, threshold, bitmaps) if step <= shards else None
            counts = _scan(rows, step, shards, bitmaps, likely)
        if step < 2 * shards:
            shard = words.select(F.shiftleft(F.col("id").cast("long"), 32).alias("hi"), F.lit(0).cast("long").alias("lo"), F.col(f"c{step % shards}").alias("n"))
            counts = counts.unionByName(shard.where("n > 0"))
        state = _advance(state, counts, step, shards, threshold)
        step += 1
        bitmaps = _bitmaps(state, step, shards, bitmaps[0])
    found = state.where(F.col("count") >= threshold)
    places = found.select("hi", "lo", "count", F.posexplode(F.array(*_ids())).alias("at", "id")).where("id > 0")
    places = places.join(words.select(F.col("id").cast("long").alias("id"), "lang", "word"), "id")
    spelt = places.groupBy("hi", "lo").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word")))["word"].alias("w"), F.first("count").alias("n"))
    totals = parts.where("codes IS NOT NULL").groupBy("lang").agg(F.sum(F.col("size").cast("long")).alias("n"))
    return spelt.select("lang", F.size("w").alias("k"), F.array_join("w", " ").alias("phrase"), "n"), totals


def _exact(c) -> Column:
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of two words and more by
    2,000,000 a / (l + r), where l and r count the two parts of the cut with
    the lowest score; phrases hidden by a longer one are left out."""
    counted, totals = count_phrases(docs, threshold, shards)
    long = counted.where("k > 1").withColumnRenamed("n", "a")
    words = F.split("phrase", " ")
    part = counted.select("lang", F.col("phrase").alias("part"), "n")

    cuts = long.select("lang", "k", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "),
                             "right": F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ")})
    cuts = cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.call_function("div", (_exact("a") * F.lit(2_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), (_exact("l") + _exact("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", score.cast("long"))
    scored = cuts.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))

    inner = long.where("k > 2").select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "a", "size", "k", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    covers = (inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    hidden = F.coalesce(_exact("most") * 100 >= _exact("a") * COVERED_PERCENT, F.lit(False))
    kept = scored.join(covers, ["lang", "phrase"], "left").where(~hidden)

    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    flat = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score").withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    first = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top).drop("slice")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents", "doc_id", "lang", "text"))


OP13_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(x, '[ \t]+'), lambda w: w <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\v\f\r]')) AS x
  FROM documents)),
s AS (SELECT lang, w, unnest(range(len(w))) AS i FROM p),
g AS (SELECT lang, k, array_to_string(w[i + 1 : i + k], ' ') AS phrase FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= {THRESHOLD}),
u AS (SELECT c.lang, c.phrase, a, cut, array_to_string(w[1 : cut], ' ') AS x, array_to_string(w[cut + 1 :], ' ') AS y
      FROM c, (SELECT unnest([1, 2, 3]) AS cut) WHERE cut < k),
v AS (SELECT u.lang, u.phrase, a, cut, x.n AS l, y.n AS r, CAST(2000000 * CAST(a AS HUGEINT) // (x.n + y.n) AS BIGINT) AS score
      FROM u JOIN f x ON x.lang = u.lang AND x.phrase = u.x JOIN f y ON y.lang = u.lang AND y.phrase = u.y),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c o ON o.lang = c.lang AND o.k > c.k
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * CAST(o.a AS HUGEINT) >= {COVERED_PERCENT} * CAST(c.a AS HUGEINT)),
t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT * FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, t.n, score
  FROM b JOIN t USING (lang) ANTI JOIN h ON h.lang = b.lang AND h.phrase = b.phrase) WHERE rank <= {TOP}
"""
