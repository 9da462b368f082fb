"""Line deduplication by a deletion-neighbourhood join (edit distance 1).

A line is the text between newlines, trimmed of [\\x20\\x09-\\x0D].  Lines with a
letter or a digit are compared, however short, and so are others of at least
``MIN_CHARS`` code points; near lines are only looked for from ``MIN_CHARS`` on
(without ``every_line``, shorter lines are kept).  Lines are ordered by (doc_id, text hash, line
number), null ids last.  A line is removed if an equal line, or one at edit
distance 1 (insert, delete or substitute one code point; not among shorter
lines), comes earlier.

Only DataFrame functions are used:

1. Equal lines collapse on their digest to the earliest occurrence.
2. Two lines within one edit agree in a prefix or a suffix of half their
   length.  Lines that share neither half with another line drop out.
3. The same with regions: everything outside a region of about 64 code points
   (the square root of the length, for long lines) must agree.
4. What remains emits its deletion variants inside the region as hashed keys:
   for a substitution, the region without position p together with p; for an
   insertion, the shorter line's region and the longer one's with one code
   point less.  Equal keys are grouped, and every member is paired with the
   earliest line it can differ from, so a group of any size makes as many
   pairs as it has members.
5. The edit distance of each pair is verified.

Null texts stay null, empty ones empty; a text is split whole, however long.  Fully equal rows (same id and text)
are one document here and keep the same lines; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WS_BYTES, slot_bitmap, staged, table, text_key, unused

MIN_CHARS = 20
REGION = 64


def _trim(c: Column) -> Column:
    return F.trim(c, F.lit(WS_BYTES))


def _left(c: Column, n: Column) -> Column:
    return F.substring(c, F.lit(1), n)


def _right(c: Column, n: Column) -> Column:
    return F.substring(c, F.length(c) - n + 1, n)


def _lines(docs: DataFrame, every_line: bool = True) -> DataFrame:
    """(id, text_key, pos, line): the lines that are compared."""
    compared = F.length("line") >= MIN_CHARS
    if every_line:
        compared |= F.regexp_like("line", F.lit("[\\p{L}\\p{N}]"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_key(F.col("text")).alias("text_key"),
                       F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("pos", "line"))
    return rows.withColumn("line", _trim(F.col("line"))).where(compared)


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of a prefix and a suffix, as the shorter of two lines (class n)
    and as the longer (class n - 1)."""
    def both(c: Column) -> list[Column]:
        head = F.ceil(c / 2).cast("int")
        return [F.xxhash64(F.lit("head"), c, _left(line, head)), F.xxhash64(F.lit("tail"), c, _right(line, c - head))]
    return F.array(*both(n), *both(n - 1))


def _order() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("text_key").alias("text_key"),
                    F.col("pos").alias("pos"))


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key is on more than one row.  A bitmap of fixed size
    drops most other rows before they are shuffled to the join."""
    many = staged(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "lines-shared")
    return rows.where(slot_bitmap(many)(F.col(key))).join(many, key, "left_semi")


def near_lines(lines: DataFrame, first: DataFrame) -> DataFrame:
    """(key): digests of the lines that have an earlier line one edit away.

    ``first``: (key, order, halves), one row per distinct line.
    """
    halves = first.select("key", F.explode("halves").alias("h"))
    alive = _shared(halves, "h").select("key").distinct()
    member = slot_bitmap(alive.select(F.xxhash64("key").alias("k")))
    texts = staged(
        # grouped first: a hot line's occurrences become one row a task before they are shuffled
        lines.withColumn("key", F.unhex(F.md5("line"))).where(member(F.xxhash64("key")))
        .groupBy("key").agg(F.first("line").alias("line")).join(alive, "key")
        .join(first.select("key", "order"), "key"), "lines-alive")

    n = F.length("line")
    classes = (texts.select("key", "order", "line", n.alias("n"), F.explode(F.array(n, n - 1)).alias("c"))
               .withColumn("w", F.greatest(F.lit(REGION), F.ceil(F.sqrt("c")).cast("int"))))
    regions = (classes.withColumn("j", F.explode(F.sequence(F.lit(0), F.ceil(F.col("c") / F.col("w")).cast("int") - 1)))
               .withColumn("from", F.col("j") * F.col("w"))
               .withColumn("after", F.col("c") - F.least("c", (F.col("j") + 1) * F.col("w"))))
    keyed = regions.select(
        "key", "order", "n", "c",
        F.substring("line", F.col("from") + 1, F.col("n") - F.col("from") - F.col("after")).alias("region"),
        F.xxhash64("c", "j", _left(F.col("line"), F.col("from")), _right(F.col("line"), F.col("after"))).alias("outside"))
    open_ = staged(_shared(keyed, "outside"), "lines-regions")

    size = F.length("region")
    positions = F.sequence(F.lit(1), size)

    def without(p: Column) -> Column:
        return F.concat(_left(F.col("region"), p - 1), F.substring(F.col("region"), p + 1, size))

    def variant(role: str, hashed: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), hashed.alias("v"))

    shorter = F.concat(
        F.transform(positions, lambda p: variant("same", F.xxhash64(F.lit("s"), "outside", p, without(p)))),
        F.array(variant("short", F.xxhash64(F.lit("d"), "outside", "region"))))
    longer = F.array_distinct(F.transform(positions, lambda p: variant("long", F.xxhash64(F.lit("d"), "outside", without(p)))))
    variants = _shared(open_.select("key", "order", F.explode(F.when(F.col("n") == F.col("c"), shorter).otherwise(longer)).alias("x"))
                       .select("key", "order", "x.role", "x.v"), "v")

    me = F.struct("order", "key")
    best = variants.groupBy("v").agg(*[F.min(F.when(F.col("role") == r, me)).alias(r) for r in ("same", "short", "long")])
    partner = (F.when(F.col("role") == "same", F.col("same")).when(F.col("role") == "short", F.col("long")).otherwise(F.col("short")))
    pairs = (variants.join(best, "v").withColumn("other", partner).where(F.col("other.order") < F.col("order"))
             .select("key", F.col("other.key").alias("other")).distinct())
    left, right = texts.select("key", F.col("line").alias("a")), texts.select(F.col("key").alias("other"), F.col("line").alias("b"))
    distance = F.levenshtein("a", "b", 1)
    return pairs.join(left, "key").join(right, "other").where(distance == 1).select("key").distinct()


def removed_lines(docs: DataFrame, every_line: bool = True) -> DataFrame:
    """(id, text_key, exact, near): per document that loses lines, their numbers from 0."""
    lines = _lines(docs, every_line)
    n = F.length("line")
    halves = _half_keys(F.col("line"), n)
    if every_line:
        halves = F.when(n >= MIN_CHARS, halves).otherwise(F.array().cast("array<bigint>"))
    scanned = staged(lines.select("id", "text_key", "pos", F.unhex(F.md5("line")).alias("key"),
                                  halves.alias("halves")), "lines")
    first = staged(scanned.groupBy("key").agg(F.min(_order()).alias("order"), F.count(F.lit(1)).alias("times"),
                                              F.any_value("halves").alias("halves")), "lines-first")
    near = near_lines(lines, first).withColumn("is_near", F.lit(True))
    # written, so that its size is known and a hot line's partition can be split in the join
    hit = staged(first.select("key", "order", "times").join(near, "key", "left").where("times > 1 or is_near")
                 .select("key", "order", F.coalesce("is_near", F.lit(False)).alias("is_near")), "lines-hit")
    late = _order() != F.col("order")
    gone = scanned.select("id", "text_key", "pos", "key").join(hit, "key").where(late | F.col("is_near"))
    return gone.groupBy("id", "text_key").agg(
        F.collect_set(F.when(late, F.col("pos"))).alias("exact"), F.collect_set(F.when(~late, F.col("pos"))).alias("near"))


COUNTS = ("n_exact_removed", "n_near_removed")


def dedup_lines(docs: DataFrame, counts: tuple[str, str] = COUNTS, every_line: bool = True) -> DataFrame:
    """All rows of ``docs`` with ``text`` rebuilt from the lines that stay, and
    two more columns, named by ``counts``: how many lines went because an
    equal one, or only because a near one, comes earlier.  Texts that a bitmap
    shows to lose no line are not shuffled."""
    gone = staged(removed_lines(docs, every_line), "lines-gone")
    touched = slot_bitmap(gone.select(F.xxhash64("id", "text_key").alias("k")))
    key = F.xxhash64(docs["doc_id"].cast("long"), text_key(docs["text"]))
    some, others = docs.where(touched(key)), docs.where(~touched(key))
    of, at, exact, near = (unused(docs, c) for c in ("_of", "_at", "_exact", "_near"))
    gone = gone.toDF(of, at, exact, near)
    joined = some.join(gone, some["doc_id"].cast("long").eqNullSafe(F.col(of)) & (text_key(some["text"]) == F.col(at)), "left")
    parts = F.split(some["text"].cast("string"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.concat(exact, near))
    rebuilt = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    text = F.when(F.col(at).isNull(), some["text"]).otherwise(rebuilt)

    def count(c):
        return F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")

    changed = joined.select(*[text.alias(c) if c.lower() == "text" else some[c] for c in docs.columns],
                            count(exact).alias(counts[0]), count(near).alias(counts[1]))
    none = F.lit(0).cast("long")
    return changed.unionByName(others.select("*", none.alias(counts[0]), none.alias(counts[1])))


def op10_linededup(spark, sf_dir):
    kept = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("text_sha256"),
                       "n_exact_removed", "n_near_removed")


_LINE = "trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
OP10_SQL = f"""
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw
           FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, pos, raw, line, length(line) AS n, length(line) >= {MIN_CHARS} OR regexp_matches(line, '[\\p{{L}}\\p{{N}}]') AS compared FROM (SELECT doc_id, pos, raw, {_LINE.replace('(l,', '(raw,')} AS line FROM l)),
f AS (SELECT line, n, min((doc_id, pos)) AS o FROM c WHERE compared GROUP BY line, n),
k AS (SELECT line, n, o, unnest([n, n - 1]) AS c FROM f WHERE n >= {MIN_CHARS}),
h AS (SELECT line, n, o, c, 'h' || left(line, CAST(ceil(c / 2) AS BIGINT)) AS h FROM k UNION ALL
      SELECT line, n, o, c, 't' || right(line, CAST(c - ceil(c / 2) AS BIGINT)) FROM k),
near AS (SELECT DISTINCT a.line FROM h a JOIN h b ON a.c = b.c AND a.h = b.h AND b.o < a.o AND abs(a.n - b.n) <= 1
         WHERE levenshtein(a.line, b.line) = 1),
d AS (SELECT c.doc_id, c.pos, c.raw, c.compared AND (c.doc_id, c.pos) <> f.o AS exact,
             c.n >= {MIN_CHARS} AND (c.doc_id, c.pos) = f.o AND near.line IS NOT NULL AS near
      FROM c LEFT JOIN f ON c.line = f.line LEFT JOIN near ON c.line = near.line),
g AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT coalesce(exact, false) AND NOT coalesce(near, false)), '') AS text,
             count(*) FILTER (exact) AS e, count(*) FILTER (near) AS m FROM d GROUP BY doc_id)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars_kept, sha256(text) AS text_sha256,
       CAST(e AS BIGINT) AS n_exact_removed, CAST(m AS BIGINT) AS n_near_removed FROM g
UNION ALL SELECT doc_id, NULL, NULL, 0, 0 FROM documents WHERE text IS NULL
"""
