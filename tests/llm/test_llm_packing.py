import random
import zlib

import numpy as np
import public_tokenizers
from llmdata import awkward, empty
from tokenizers import Tokenizer

from quarry.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip_and_little_padding(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("alpha", "beta", "gamma", "delta")) for _ in range(rng.randrange(0, 900))) for _ in range(150)]
    docs = awkward(spark, texts)
    got = packing.pack(docs, PATH, group=40).collect()
    slow = Tokenizer.from_file(PATH)
    want = sorted([*slow.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.select("text").collect())
    pieces = {}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    # repeated rows share (doc_id, doc_tokens): compare as multisets of whole documents
    whole = []
    for (_, total), parts in pieces.items():
        copies = sum(len(ids) for _, ids in parts) // total
        parts.sort(key=lambda p: p[0])
        flat = [t for _, ids in parts for t in ids]
        whole += [flat] if copies == 1 else [None] * copies
    assert len(whole) == len(want) and all(w in want for w in whole if w is not None)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for parts in seqs.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        total = sum(n for _, n in parts)
        assert 0 < total <= 1024
        short += total < 1024
    assert short <= -(-docs.count() // 40)   # at most one per group


def test_ids_equal_the_tokenizers_library(spark):
    slow, fast = Tokenizer.from_file(PATH), packing.encoder(PATH)
    rng = random.Random(11)
    chars = [*map(chr, range(1, 0x250)), " ", " ", "\n", " ", "東", "\U0001F600", "​", "'s", "'re", "<|endoftext|>"]
    for _ in range(300):
        text = "".join(rng.choice(chars) for _ in range(rng.randrange(60)))
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids, text
    for text in ("", " " * 5000, "a" * 5000, "^" * 5000, "\n" * 300 + "x"):
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids
    other = packing.encoder(public_tokenizers.path("word_bpe_49k.json"))   # not byte level: run by tokenizers
    assert other("Hello world").tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(
        "Hello world", add_special_tokens=False).ids


def test_first_fit_by_tournament_tree_is_first_fit():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 100) for _ in range(300)]
    tree, naive = packing.FreeSpace(len(lengths), 100), []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, free in enumerate(naive) if free >= n), len(naive))
        if at == len(naive):
            naive.append(100)
        naive[at] -= n
        assert tree.take(n) == at
    bins = packing.first_fit_decreasing(lengths, 100)
    spans = sorted(p for b in bins for p in b)
    for i, n in enumerate(lengths):
        own = [(a, z) for k, a, z in spans if k == i]
        assert own[0][0] == 0 and own[-1][1] == n and all(x[1] == y[0] for x, y in zip(own, own[1:]))
    assert sum(sum(z - a for _, a, z in b) < 100 for b in bins) <= 1
    assert packing.first_fit_decreasing([], 100) == [] and packing.first_fit_decreasing([100], 100) == [[(0, 0, 100)]]


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).collect() == []
