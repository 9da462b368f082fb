"""Readers and parsers for the line-oriented input formats.

Each parser works on a DataFrame with one string column (``line`` or the
``value`` column of ``spark.read.text``) so the same code serves a text file
and a fixture derived from the driver tables.  Everything is a column
expression: parsing stays in the JVM inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Adjacency line: owner, colon, whitespace separated ids.  The owner is
# trimmed; a line without a colon is a reject, a blank line is skipped.
ADJ_PATTERN = r"^\s*([^:\s]+)\s*:(.*)$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as ``line string``; splits are planned by Spark."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def _split_ws(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")


def parse_adjacency(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``user: id id ...`` -> (user string, follows array<string>).

    Repeated ids keep their multiplicity, repeated owner lines stay separate
    rows.  Blank lines are dropped; malformed lines are not returned (see
    :func:`adjacency_rejects`).
    """
    line = F.col(line_col)
    user = F.regexp_extract(line, ADJ_PATTERN, 1)
    rest = F.regexp_extract(line, ADJ_PATTERN, 2)
    return (lines
            .where(F.trim(line) != "")
            .where(line.rlike(ADJ_PATTERN))
            .select(user.alias("user"), _split_ws(rest).alias("follows")))


def adjacency_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    line = F.col(line_col)
    return lines.where((F.trim(line) != "") & ~line.rlike(ADJ_PATTERN)).select(line.alias("line"))


def _uint64(tok: Column) -> Column:
    """The 64 bits of an integer token in [-2^63, 2^64), as bigint; NULL for anything else."""
    n = F.when(tok.rlike(r"^[+-]?[0-9]+$"), tok.try_cast("decimal(20,0)"))
    half, high = (F.lit(str(1 << b)).cast("decimal(20,0)") for b in (63, 64))
    return (F.when(n >= half, F.when(n < high, (n - high).try_cast("bigint")))
            .otherwise(n.try_cast("bigint")))


def parse_id_tokens(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Every whitespace token is one unsigned 64-bit key -> (pos int, token bigint).

    Keys from 2^63 on keep their 64 bits (the bigint is negative).  A token
    that is no such integer has a NULL ``token``; :func:`id_token_rejects`
    lists those.
    """
    toks = _split_ws(F.col(line_col))
    return (lines.select(F.posexplode(toks).alias("pos", "tok"))
            .select("pos", _uint64(F.col("tok")).alias("token")))


def id_token_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(pos, tok): the tokens that are not 64-bit integers."""
    return (lines.select(F.posexplode(_split_ws(F.col(line_col))).alias("pos", "tok"))
            .where(_uint64(F.col("tok")).isNull()))


def _numbers(parts: Column) -> Column:
    """Doubles, NULL where one of the texts is not a number."""
    xs = F.transform(parts, lambda x: x.try_cast("double"))
    return F.when(~F.exists(xs, lambda x: x.isNull()), xs)


def parse_vectors(lines: DataFrame, dim: int | None = None, line_col: str = "line") -> DataFrame:
    """``word f1 ... fd`` (single spaces, no quoting) -> (word, vec array<double>).

    With ``dim``, the last ``dim`` fields are the numbers and the word is all
    before them, spaces included; without it, the word is the first field.
    Words such as ``null`` stay text.  A line with a bad number, or too few,
    is left out; :func:`vector_rejects` lists those.
    """
    parsed = _with_vector(lines, dim, line_col)
    return parsed.where("vec is not null").select("word", "vec")


def vector_rejects(lines: DataFrame, dim: int | None = None, line_col: str = "line") -> DataFrame:
    return _with_vector(lines, dim, line_col).where("vec is null").select(F.col(line_col).alias("line"))


def _with_vector(lines: DataFrame, dim: int | None, line_col: str) -> DataFrame:
    parts = F.split(F.col(line_col), " ")
    words = F.lit(1) if dim is None else F.size(parts) - dim
    enough = (words >= 1) & (F.size(parts) > words)
    vec = F.when(enough, _numbers(F.slice(parts, F.greatest(words, F.lit(1)) + 1, F.greatest(F.size(parts) - words, F.lit(0)))))
    return lines.select(F.col(line_col), F.when(enough, F.array_join(F.slice(parts, 1, F.greatest(words, F.lit(1))), " ")).alias("word"),
                        vec.alias("vec"))


def parse_lat_lon(numbered: DataFrame, line_col: str = "line") -> DataFrame:
    """(qid, line ``lat lon``) -> (qid, latitude, longitude); a malformed line
    keeps its id with NULL coordinates, so that every query has an answer row."""
    xs = _numbers(_split_ws(F.col(line_col)))
    good = F.when(F.size(xs) == 2, xs)
    return numbered.select("qid", F.get(good, 0).alias("latitude"), F.get(good, 1).alias("longitude"))


def parse_query_vectors(numbered: DataFrame, line_col: str = "line") -> DataFrame:
    """(qid, line of floats) -> (qid, vec array<double>), NULL for a bad line."""
    return numbered.select("qid", _numbers(_split_ws(F.col(line_col))).alias("vec"))


def parse_labels(numbered: DataFrame, line_col: str = "line") -> DataFrame:
    """(qid, line) -> (qid, label): one expected label per line, trimmed; an empty line is NULL."""
    return numbered.select("qid", F.nullif(F.trim(F.col(line_col)), F.lit("")).alias("label"))


POINT_COLUMNS = {"geo": ("location", "latitude", "longitude", "double"), "plane": ("name", "easting", "northing", "float")}


def _point_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(id, name, two coordinates as text): the rows of a header CSV, numbered."""
    cols = POINT_COLUMNS.get(kind, POINT_COLUMNS["plane"])[:3]
    schema = ", ".join(f"{c} string" for c in cols)
    return with_line_ids(spark.read.schema(schema).option("header", True).csv(path), "id")


def read_point_csv(spark: SparkSession, path: str, kind: str = "geo") -> DataFrame:
    """Header CSV of named points with an explicit schema (no inference).

    ``id`` is the row's number in the file, or in all files by name order; a
    value that is no number is NULL, and the indexes leave such points out
    (:func:`point_rejects` lists them)."""
    name, *xy, number = POINT_COLUMNS.get(kind, POINT_COLUMNS["plane"])
    return _point_rows(spark, path, kind).select("id", name, *[F.col(c).try_cast(number).alias(c) for c in xy])


def point_rejects(spark: SparkSession, path: str, kind: str = "geo") -> DataFrame:
    """(id, name, coordinates as text): the rows of a point CSV that are no
    place: a coordinate that is missing, no number or not finite, or on the
    sphere a latitude beyond the poles."""
    name, *xy, number = POINT_COLUMNS.get(kind, POINT_COLUMNS["plane"])
    values = [F.col(c).try_cast(number) for c in xy]
    good = values[0].isNotNull() & values[1].isNotNull()
    for v in values:
        good &= (F.abs(v) < float("inf")) & ~F.isnan(v)
    if kind == "geo":
        good &= F.abs(values[0]) <= 90
    return _point_rows(spark, path, kind).where(~F.coalesce(good, F.lit(False))).select("id", name, *xy)


def with_line_ids(df: DataFrame, name: str = "qid") -> DataFrame:
    """Line number (from 0) for plain query files, at load; several files are
    numbered through in the order of their names.

    ``monotonically_increasing_id`` counts the rows of a split in order.  One
    row per file block (its first id and its row count) turns into running
    offsets by file name and block, and each row's number is its block's
    offset plus its place in the block: two passes over the files, no per-row
    Python and no window over the rows.  Whether the offsets are broadcast is
    left to their size.
    """
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    t = df.select(*at, F.monotonically_increasing_id().alias("_mid"), *df.columns)
    blocks = t.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = blocks.select(
        "_file", "_block", "_first", (F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")).alias("_off"))
    return (t.join(offsets, ["_file", "_block"])
            .select((F.col("_off") + F.col("_mid") - F.col("_first")).alias(name), *df.columns))
