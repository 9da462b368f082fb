"""License scan: fuzzy search of short license notices.

A text is lower-cased (A-Z only) and cut into words; the words, one space
between, before and after them, are the searched string.  A notice is a string
of whole words with a number of errors (inserted, deleted or substituted code
points) that it may have, and an ending that must stand there exactly, such as
a version number.

1. Pigeonhole: a notice with k errors is split into k + 1 pieces, and any place
   where it occurs holds at least one piece unchanged.  One Aho-Corasick pass
   finds the pieces (exact seeds) of all notices.
2. Each seed fixes a candidate window, k code points wider than the notice on
   either side of where the notice would start and end.  Windows of one notice
   that overlap are joined.
3. The ``regex`` library matches the notice in the window with at most k
   errors and takes the best match; the search goes on on both sides of it.

So an occurrence is never lost, whatever piece the errors spare.  Matches are
reported with label, errors, the numbers of their first and last word, and
their place in the text in code points.

Null and empty texts have no words and no match.  Texts are searched whole, in
batches of bounded size.  Repeated rows give repeated results; an empty table
an empty one.  Columns of the input pass through; the caller names the result
columns so that none clashes.
"""

from __future__ import annotations

import bisect
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices, table


class Notice(NamedTuple):
    label: str
    text: str           # matched with errors
    errors: int
    ending: str = ""    # matched exactly, right behind it
    base: bool = False  # places without an error count as base places


# fixed values: the base phrases and their labels
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# fixed values: labels, short notices and exact endings
NOTICES = """
mit | permission is hereby granted free of charge to any person obtaining a copy of this software |
mit | released under the mit license |
mit | licensed under the mit license |
apache-2 | licensed under the apache license version | 2
apache-2 | unless required by applicable law or agreed to in writing software distributed under the license |
bsd | redistribution and use in source and binary forms with or without modification are permitted |
gpl | gnu general public license |
lgpl | gnu lesser general public license |
agpl | gnu affero general public license |
gpl | this program is free software you can redistribute it and or modify it under the terms of |
mpl-2 | mozilla public license version | 2
mpl-2 | subject to the terms of the mozilla public license |
cc-by-nc | creative commons attribution noncommercial |
cc-by-sa | creative commons attribution sharealike |
cc-by | licensed under a creative commons attribution |
unlicense | this is free and unencumbered software released into the public domain |
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted |
boost-1 | boost software license version | 1
epl | eclipse public license |
proprietary | all rights reserved no part of this publication may be reproduced |
"""
CHARS_PER_ERROR = 12   # a notice may have one error for so many code points,
MAX_ERRORS = 3         # and so many at most: the time of a bounded-error match grows by a power of them


def notices() -> list[Notice]:
    """The base phrases and the table, each with its number of errors."""
    def errors(text: str) -> int:
        return min(MAX_ERRORS, len(text) // CHARS_PER_ERROR)

    out = []
    for phrase, label in BASE:
        text, digit = re.fullmatch(r"(.*?)( \d+)?", phrase).groups()
        out.append(Notice(label, f" {text}" if digit else f" {text} ", errors(text), f"{digit} " if digit else "", True))
    for line in NOTICES.strip().splitlines():
        label, text, ending = (x.strip() for x in line.split("|"))
        out.append(Notice(label, f" {text}" if ending else f" {text} ", errors(text), f" {ending} " if ending else ""))
    return out


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """(offset, text) of the k + 1 parts, as even as can be."""
    k, n = notice.errors + 1, len(notice.text)
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Searcher:
    """The seeds and patterns of a list of notices."""

    def __init__(self, wanted: list[Notice]):
        import ahocorasick
        import regex
        self.notices = wanted
        self.seeds = ahocorasick.Automaton()
        placed: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(wanted):
            for offset, piece in pieces(notice):
                placed.setdefault(piece, []).append((i, offset))
        for piece, where in placed.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        # without errors the pattern is plain; the window holds the exact ending too
        self.patterns = [regex.compile((f"(?b)(?:{regex.escape(x.text, literal_spaces=True)}){{e<={x.errors}}}" if x.errors else regex.escape(x.text, literal_spaces=True))
                                       + regex.escape(x.ending, literal_spaces=True)) for x in wanted]

    def windows(self, s: str) -> dict[int, list[list[int]]]:
        """{notice: joined candidate windows [start, end)} of a string."""
        raw: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self.seeds.iter(s):
            for i, offset in where:
                start, notice = last + 1 - size - offset, self.notices[i]
                raw.setdefault(i, []).append((max(0, start - notice.errors), start + len(notice.text) + notice.errors + len(notice.ending)))
        out = {}
        for i, found in raw.items():
            joined: list[list[int]] = []
            for a, b in sorted(found):
                if joined and a < joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            out[i] = joined
        return out

    def _in_window(self, i: int, s: str, start: int, end: int) -> set[tuple[int, int, int]]:
        """(errors, start, end) of the matches in a window: the best one, and what is on either side of it."""
        found, open_, least = set(), [(start, end)], len(self.notices[i].text) - self.notices[i].errors
        while open_:
            a, b = open_.pop()
            if b - a >= least and (m := self.patterns[i].search(s, a, b)):
                found.add((sum(m.fuzzy_counts), m.start(), m.end()))
                # two matches may share the space between them
                open_ += [(a, m.start() + 1), (max(m.start() + 1, m.end() - 1), b)]
        return found

    def search(self, s: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) of all matches in a padded string of
        words; of matches of one notice that overlap, the one with fewer errors.
        Long windows are searched in parts that overlap by a whole match."""
        found = []
        for i, places in self.windows(s).items():
            notice, hits = self.notices[i], set()
            most = len(notice.text) + notice.errors + len(notice.ending)
            for a, b in places:
                for at in range(a, max(a + 1, min(b, len(s)) - most), 3 * most):
                    hits |= self._in_window(i, s, at, min(at + 4 * most, b, len(s)))
            taken: list[tuple[int, int]] = []
            for errors, start, end in sorted(hits):
                k = bisect.bisect(taken, (start, end))
                if (not k or taken[k - 1][1] - 1 <= start) and (k == len(taken) or end - 1 <= taken[k][0]):
                    taken.insert(k, (start, end))
                    found.append((i, start, end, errors))
        return sorted(found, key=lambda x: (x[1], x[2], x[0]))


#: [\x00-\x2F\x3A-\x60\x7B-\x7F] become spaces once A-Z are lower case; bytes of other code points stay.
SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
FOLDED = bytes(c + 32 if 65 <= c <= 90 else 32 if c in SEPARATORS else c for c in range(256))
ORIGINAL_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def folded(text: bytes) -> str:
    """The padded string of words; one space where there is no word."""
    words = text.translate(FOLDED).split()
    return f" {b' '.join(words).decode()} " if words else " "


MATCH = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("base", T.BooleanType()),
    T.StructField("errors", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("similarity", T.DoubleType())]))


def scan(docs: DataFrame, wanted: list[Notice] | None = None, matches: str = "matches", n_words: str = "n_words") -> DataFrame:
    """All rows and columns of ``docs`` with the matches in ``text``, by their
    place, and the number of words.  ``base`` is true for error-free places of
    a base phrase."""
    listed = notices() if wanted is None else wanted

    def run(batches):
        import pyarrow as pa
        searcher = Searcher(listed)

        def found(text: bytes, s: str) -> list[dict]:
            hits = searcher.search(s)
            if not hits:
                return []
            places = [m.span() for m in ORIGINAL_WORD.finditer(text.decode())]
            out, word, at = [], 0, 0
            for i, start, end, errors in hits:
                notice = listed[i]
                # words before the first code point of the match that is no space
                begin = start + len(s[start:end]) - len(s[start:end].lstrip(" "))
                word, at = word + s.count(" ", at, begin), begin
                last = word + s.count(" ", begin, start + len(s[start:end].rstrip(" ")))
                out.append({"label": notice.label, "notice": (notice.text + notice.ending).strip(), "base": notice.base and not errors,
                            "errors": errors, "first_word": word - 1, "last_word": last - 1, "start": places[word - 1][0],
                            "end": places[last - 1][1], "similarity": 1 - errors / len(notice.text)})
            return out

        fields = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64()}
        kind = pa.list_(pa.struct([(f.name, fields[f.dataType.simpleString()]) for f in MATCH.elementType.fields]))
        for b in (part for batch in batches for part in slices(batch, "text")):
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            strings = [folded(t) for t in texts]
            rows = [found(t, s) for t, s in zip(texts, strings, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind), pa.array([s.count(" ") - 1 for s in strings], pa.int64())],
                                             names=[*b.schema.names, matches, n_words])

    schema = T.StructType([*docs.schema.fields, T.StructField(matches, MATCH), T.StructField(n_words, T.LongType())])
    return docs.mapInArrow(run, schema)


def op12_licenses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = scan(docs).withColumn("base", F.filter("matches", lambda m: m["base"]))

    def labels(c: str):
        return F.array_join(F.sort_array(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda m: m["first_word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda m: m["first_word"])).alias("last_word"),
        labels("base").alias("base_labels"), labels("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["similarity"])), F.lit(0.0)).alias("score"))
