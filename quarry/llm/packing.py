"""Packing of token sequences by first-fit decreasing in randomised groups.

Every document is tokenized and ended with one separator id.  Stretches of
``CAPACITY`` ids are sequences of their own and never leave their task; only
the shorter rest of each document is packed.  Rests are dealt at random to
groups of about ``GROUP`` pieces, which are packed independently: longest
first, each into the first bin with room, found by descending a tournament
tree over the free space of the bins.  The few bins that stay open are then
filled from the emptiest ones by cutting pieces, so that one group leaves at
most one sequence short of the capacity.

Null text counts as empty (one separator id).  Repeated rows are packed as
often as they occur; ids, texts and other columns may clash or be null.  An
empty table gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged, table

CAPACITY = 1024
GROUP = 4096
SEPARATOR = 0
ROWS = 256   # documents tokenized at a time
IDS = "array<int>"


def encoder(path: str):
    """``encode(text) -> numpy uint32 ids`` of a tokenizers file.

    A plain byte-level BPE file, in which a merge's rank is the order of its
    id, is run by tiktoken over the same vocabulary: the ids are the same, at
    a quarter of the time.  Any other file is run by tokenizers.
    """
    import json

    import numpy as np
    from tokenizers import Tokenizer

    slow = []   # loaded where it is first needed

    def by_tokenizers(text):
        if not slow:
            slow.append(Tokenizer.from_file(path))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = model.get("vocab")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    plain = (model.get("type") == "BPE" and isinstance(vocab, dict) and pre.get("type") == "ByteLevel"
             and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
             and not spec.get("truncation") and not model.get("unk_token") and not model.get("dropout")
             and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
             and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)))
    if not plain:
        return by_tokenizers

    import tiktoken
    # a byte-level vocabulary writes the printable bytes as themselves and the rest from U+0100 on
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
    # fixed value: the word pattern of byte-level BPE
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def by_tiktoken(text):
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:  # the pattern engine refuses some very long runs of white space or symbols
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return by_tokenizers(text)

    return by_tiktoken


def _tokenize(path: str, capacity: int, separator: int, keep_ids: bool):
    """(doc_id, text) -> pieces of at most ``capacity`` ids."""
    def run(batches):
        from zlib import crc32

        import numpy as np
        import pyarrow as pa
        encode = encoder(path)
        for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text or ""), separator).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    out["doc_id"].append(doc)
                    out["start"].append(at)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(crc32(piece))
                    out["doc_tokens"].append(len(ids))
                    out["ids"].append(piece.view("<i4") if keep_ids or len(piece) < capacity else None)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))
    return run


class FreeSpace:
    """Tournament tree over the free space of bins: each node holds the largest below it."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.most = [capacity] * (2 * self.size)

    def take(self, length: int) -> int:
        """The first bin with ``length`` free, which is taken from it."""
        most, at = self.most, 1
        while at < self.size:
            at *= 2
            if most[at] < length:
                at += 1
        most[at] -= length
        found = at - self.size
        while at > 1:
            at //= 2
            left, right = most[2 * at], most[2 * at + 1]
            best = left if left >= right else right
            if most[at] == best:
                break
            most[at] = best
        return found


def first_fit_decreasing(lengths, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (piece, from, to); afterwards all bins but one are full.

    ``lengths`` are at most ``capacity``.  Ties keep the order of the pieces.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree, bins = FreeSpace(len(lengths), capacity), []
    for i in order:
        at = tree.take(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append((i, 0, lengths[i]))
    # fill what is open from the emptiest bins, cutting the last piece moved
    used = [sum(z - a for _, a, z in x) for x in bins]
    by_use = sorted(range(len(bins)), key=lambda i: (-used[i], i))
    full, last = 0, len(by_use) - 1
    while full < last:
        to, of = by_use[full], by_use[last]
        room = capacity - used[to]
        if not room:
            full += 1
            continue
        if not bins[of]:
            last -= 1
            continue
        i, a, z = bins[of].pop()
        cut = max(a, z - room)
        bins[to].append((i, cut, z))
        if cut > a:
            bins[of].append((i, a, cut))
        used[to] += z - cut
        used[of] -= z - cut
    return [x for x in bins if x]


def _pack_group(capacity: int):
    def run(key, pdf):
        from zlib import crc32

        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values(["order", "piece"], kind="stable")
        doc, start, total, ids = (pdf[c].tolist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        ids = [np.asarray(x, "<i4") for x in ids]
        out = []
        for n, content in enumerate(first_fit_decreasing([len(x) for x in ids], capacity)):
            offset = 0
            for i, a, z in content:
                part = ids[i][a:z]
                out.append((doc[i], start[i] + a, z - a, crc32(part), total[i], (key[0] << 22 | n) * 2, offset, part))
                offset += z - a
        frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        return frame.astype({"doc_id": "Int64"})
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = GROUP,
         separator: int = SEPARATOR, keep_ids: bool = True) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids); the pieces of a sequence follow each other
    without a gap.  ``keep_ids=False`` leaves ``ids`` null.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids {IDS}"
    pieces = staged(src.mapInArrow(_tokenize(tokenizer_path, capacity, separator, keep_ids), schema)
                    .withColumn("piece", F.monotonically_increasing_id()), "packing-pieces")
    full = pieces.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("piece") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids")
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    order = F.xxhash64("piece", "ids_crc32", F.lit(17))
    dealt = rest.select("doc_id", "start", "doc_tokens", "ids", "piece", order.alias("order"),
                        F.pmod(F.xxhash64("piece", "ids_crc32"), F.lit(groups)).alias("g"))
    packed = dealt.groupBy("g").applyInPandas(
        _pack_group(capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                               f"sequence_id long, offset long, ids {IDS}")
    if not keep_ids:
        packed = packed.withColumn("ids", F.lit(None).cast(IDS))
    return full.unionByName(packed)


def op3_packing(spark, sf_dir):
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                keep_ids=False).drop("ids")
