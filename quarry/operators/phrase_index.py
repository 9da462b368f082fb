"""Phrase search over files by a posting index of character trigrams.

Files are numbered and written once; runs of up to ``BLOCK_FILES`` consecutive
numbers and about ``BLOCK_BYTES`` of text are blocks.  The index has one row per block and distinct trigram: which
files of the block have it, as a list of offsets or as a bitmap, whichever is
shorter.  Each task writes its rows in trigram order, and nothing is shuffled
to build them.

A file can hold a phrase only if it has all its trigrams.  A search counts, block
by block, in how many of a phrase's postings each file is, so that a common
trigram costs one row per block and phrase, not one per file; the files with all
of them are read and verified.  Phrases have three characters or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path

SIZE = 3
BLOCK_FILES = 8192      # files of a block; offsets fit 16 bits
BLOCK_BYTES = 1 << 24   # of text, at which a block ends, whatever its number of files
SLICE = 1 << 21         # characters whose trigrams are sorted at a time
PAIRS = 1 << 18         # candidates held before they are passed on
POSTINGS = "gram string, block long, n int, bits binary"


@dataclass(frozen=True)
class PhraseIndex:
    postings: DataFrame   # (gram, block, n, bits): the n files of a block that have a trigram
    files: DataFrame      # (file, path, content)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; a sort is many times faster here than the hash table of ``np.unique``."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _slices(contents: list[str]):
    """(offsets of files, code points) of about ``SLICE`` characters each; the
    parts of a longer content overlap, so that no trigram is lost."""
    at, texts, size = [], [], 0
    for i, s in enumerate(contents):
        for a in range(0, max(1, len(s) - SIZE + 1), SLICE):
            part = s[a:a + SLICE + SIZE - 1]
            at.append((i, len(part)))
            texts.append(part)
            size += len(part)
            if size >= SLICE:
                yield at, _codes("".join(texts))
                at, texts, size = [], [], 0
    if texts:
        yield at, _codes("".join(texts))


def _block_postings(contents: list[str]):
    """(offset of the block's first file, trigrams, their numbers of files, their
    files) for the contents of a block; in halves where so many different
    characters occur that a trigram and an offset do not fit 63 bits."""
    seen = np.zeros(0x110000, bool)
    for s in contents:
        for a in range(0, len(s), SLICE):
            seen[_codes(s[a:a + SLICE])] = True
    chars = np.flatnonzero(seen).astype(np.uint32)
    width, low = max(1, int(len(chars) - 1).bit_length()), int(len(contents) - 1).bit_length()
    if SIZE * width + low > 63:
        half = len(contents) // 2
        yield from _block_postings(contents[:half])
        yield from ((half + first, *rest) for first, *rest in _block_postings(contents[half:]))
        return
    rank = np.zeros(0x110000, np.int64)
    rank[chars] = np.arange(len(chars))
    parts = []
    for at, codes in _slices(contents):
        owner = np.repeat(np.array([i for i, _ in at], np.int64), [n for _, n in at])
        piece = np.repeat(np.arange(len(at), dtype=np.int32), [n for _, n in at])
        r = rank[codes]
        keys = (r[:-2] << 2 * width | r[1:-1] << width | r[2:]) << low | owner[:-2]
        parts.append(_distinct(keys[piece[:-2] == piece[2:]]))
    keys = _distinct(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    if not len(keys):
        return
    grams, files = keys >> low, (keys & (1 << low) - 1).astype("<u2")
    start = np.r_[0, np.flatnonzero(np.diff(grams)) + 1]
    end = np.r_[start[1:], len(keys)]
    g, mask = grams[start], (1 << width) - 1
    spelt = np.stack([chars[g >> 2 * width], chars[g >> width & mask], chars[g & mask]], axis=1)
    text = spelt.astype("<u4").tobytes().decode("utf-32-le")
    yield 0, [text[i:i + SIZE] for i in range(0, len(text), SIZE)], end - start, [_pack(files[a:z], len(contents)) for a, z in zip(start, end, strict=True)]


def _pack(files: np.ndarray, size: int) -> bytes:
    """Offsets as 16-bit numbers, or a bitmap of ``size`` where that is shorter."""
    if 2 * len(files) <= (size + 7) // 8:
        return files.tobytes()
    bits = np.zeros(size, bool)
    bits[files] = True
    return np.packbits(bits).tobytes()


def _postings(batches):
    for b in batches:
        rows = b.filter(b.column("content").is_valid())
        if not rows.num_rows:
            continue
        ids = rows.column("file").to_numpy(zero_copy_only=False)
        contents = rows.column("content")
        step, size = np.diff(ids), pc.binary_length(contents).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        cuts = np.flatnonzero((step < 0) | (step >= BLOCK_FILES)) + 1
        for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(ids)], strict=True):
            # offsets are differences of file numbers: gaps are files without content
            while a < z:
                end = a + 1 + int(min(np.searchsorted(ids[a + 1:z], ids[a] + BLOCK_FILES), np.searchsorted(size[a + 1:z], size[a] + BLOCK_BYTES)))
                texts = [""] * int(ids[end - 1] - ids[a] + 1)
                for i, s in zip(ids[a:end] - ids[a], contents.slice(a, end - a).to_pylist(), strict=True):
                    texts[i] = s
                for first, grams, n, bits in _block_postings(texts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grams, pa.string()), pa.array(np.full(len(grams), ids[a] + first), pa.int64()),
                         pa.array(n, pa.int32()), pa.array(bits, pa.binary())], names=["gram", "block", "n", "bits"])
                a = end


def build(files: DataFrame, path: str | None = None) -> PhraseIndex:
    """Index of (path, content) rows; NULL contents have no trigram."""
    spark = files.sparkSession
    path = path or scratch_path(spark, "phrase-index")
    # a task's numbers are consecutive, and it writes its files in their order
    files.select(F.monotonically_increasing_id().alias("file"), "path", "content").write.parquet(f"{path}/files")
    numbered = spark.read.schema("file long, path string, content string").parquet(f"{path}/files")
    rows = numbered.select("file", "content").mapInArrow(_postings, POSTINGS)
    rows.sortWithinPartitions("gram").write.parquet(f"{path}/postings")
    return PhraseIndex(spark.read.schema(POSTINGS).parquet(f"{path}/postings"), numbered)


def _count(met: np.ndarray, bits: bytes, n: int) -> None:
    """Count the n files of a posting in ``met``."""
    if len(bits) == 2 * n:
        met[np.frombuffer(bits, "<u2")] += 1
    else:
        has = np.unpackbits(np.frombuffer(bits, np.uint8))
        met[:len(has)] += has


def _meet(batches):
    """Rows sorted by (block, phrase): (file, phrases) of the files that are in
    all postings of a phrase, a file at most once per block and ``PAIRS``."""
    held, size, block, phrase, n, met = [], 0, None, None, 0, np.zeros(BLOCK_FILES, np.int32)

    def flush():
        at = np.concatenate([x for x, _ in held])
        names = pa.array([p for _, p in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), [len(x) for x, _ in held])))
        order = np.argsort(at, kind="stable")
        files, start = np.unique(at[order], return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(files + block, pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[start, len(at)], pa.int32()), names.take(pa.array(order)))],
            names=["file", "phrases"])

    for b in batches:
        columns = (b.column(c) for c in ("block", "phrase", "needed", "n"))
        bits = b.column("bits")
        for i, (at, name, needed, count) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
            if at != block or name != phrase:
                if held and (at != block or size >= PAIRS):
                    yield flush()
                    held, size = [], 0
                block, phrase, n = at, name, 0
                met[:] = 0
            _count(met, bits[i].as_py(), count)
            n += 1
            if n == needed:
                files = np.flatnonzero(met == needed)
                if len(files):
                    held.append((files, name))
                    size += len(files)
    if held:
        yield flush()


def _by_file(index: PhraseIndex, phrases: DataFrame) -> DataFrame:
    """(file, phrases): the phrases of which a file has all trigrams."""
    s = F.col("phrase")
    short = F.raise_error(F.concat(F.lit("a phrase needs three characters or more: "), s))
    starts = F.sequence(F.lit(1), F.when(F.length(s) >= SIZE, F.length(s) - SIZE + 1).when(s.isNotNull(), short.cast("int")))
    wanted = phrases.select("phrase").where("phrase IS NOT NULL").distinct().select(
        "phrase", F.array_distinct(F.transform(starts, lambda i: F.substring(s, i, F.lit(SIZE)))).alias("grams"))
    # written, so that its size is known and no posting is shuffled to the join
    path = scratch_path(phrases.sparkSession, "phrase-grams")
    wanted.select("phrase", F.size("grams").alias("needed"), F.explode("grams").alias("gram")).write.parquet(path)
    grams = phrases.sparkSession.read.schema("phrase string, needed int, gram string").parquet(path)
    rows = index.postings.join(grams, "gram").select("block", "phrase", "needed", "n", "bits")
    return rows.repartition("block").sortWithinPartitions("block", "phrase").mapInArrow(_meet, "file long, phrases array<string>")


def candidates(index: PhraseIndex, phrases: DataFrame) -> DataFrame:
    """(phrase, path): files with all trigrams of a phrase.  A phrase of fewer
    than three characters fails; NULL phrases have no row."""
    return index.files.select("file", "path").join(_by_file(index, phrases), "file").select(F.explode("phrases").alias("phrase"), "path")


def search(index: PhraseIndex, phrases: DataFrame) -> DataFrame:
    """(phrase, path): files whose content contains a phrase.

    A file's candidates meet its content in one row, which is not sorted."""
    found = index.files.join(_by_file(index, phrases).hint("shuffle_hash"), "file")
    held = F.filter("phrases", lambda p: F.contains("content", p))
    return found.select("path", F.explode(held).alias("phrase")).select("phrase", "path")


def counts(index: PhraseIndex, phrases: DataFrame) -> DataFrame:
    """(phrase, n_files) of every phrase given, 0 included."""
    found = search(index, phrases).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    return (phrases.select("phrase").where("phrase IS NOT NULL").distinct().join(found, "phrase", "left")
            .select("phrase", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_files")))
