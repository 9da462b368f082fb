"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

WS_BYTES = " \t\n\x0b\x0c\r"  # the separators [\x20\x09-\x0D]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one driver table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy cuts lineage: every later job reads the files, and a lost
    executor costs a re-read and not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def constant_array(values, element: str) -> Column:
    """A constant array; folded once by the optimizer, one node in the plan."""
    import json
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element}>")


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    have = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in have:
        i += 1
        name = f"{base}_{i}"
    return name


def slices(batch, column: str, most: int = 1 << 22):
    """Parts of an Arrow batch whose ``column`` has at most ``most`` bytes, or one row."""
    import numpy as np
    import pyarrow.compute as pc
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def text_key(c: Column) -> Column:
    """64-bit hash of a text; with the id it identifies a document row."""
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())


def slot_bitmap(keys: DataFrame, bits: int = 22):
    """Native membership filter of fixed size over a table with one long column.

    Returns a function of a long column that is true for every key of the
    table (and for few others, while the table has far fewer keys than
    ``2^bits``).  The bitmap is one row of ``2^bits / 64`` longs, whatever the
    number of keys: a scalar subquery, which no plan spells out.
    """
    key = keys.columns[0]
    words = (keys.where(F.col(key).isNotNull()).select(F.pmod(F.col(key), F.lit(1 << bits)).alias("s"))
             .groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b")))
    every = keys.sparkSession.range(1 << (bits - 6)).join(words, F.col("id") == F.col("w"), "left")
    array = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")))),
                                  lambda x: x["b"]).alias("bitmap")).scalar()

    def contains(c: Column) -> Column:
        s = F.pmod(c, F.lit(1 << bits))
        return F.getbit(F.get(array, F.shiftright(s, 6).cast("int")), s.bitwiseAND(F.lit(63)).cast("int")) == 1
    return contains


def bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, also where ``use`` has it inside a lambda."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def prefix_sums(c: Column, block: int = 256) -> Column:
    """Inclusive running sums of an array<int>, as array<long>: first within
    blocks, then over the blocks, so that long arrays stay cheap."""
    empty = F.array().cast("array<long>")

    def within(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).cast("long").alias("n"), empty.alias("out")),
                           lambda a, x: F.struct((a["n"] + x).alias("n"), F.concat(a["out"], F.array(a["n"] + x)).alias("out")),
                           lambda a: a["out"])

    def over(xs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.ceil(F.size(xs) / block).cast("int")), lambda b: b * block < F.size(xs))
        blocks = F.transform(starts, lambda b: within(F.slice(xs, b * block + 1, F.lit(block))))
        return F.aggregate(blocks, F.struct(F.lit(0).cast("long").alias("n"), empty.alias("out")),
                           lambda a, p: F.struct((a["n"] + F.element_at(p, -1)).alias("n"),
                                                 F.concat(a["out"], F.transform(p, lambda x: x + a["n"])).alias("out")),
                           lambda a: a["out"])
    return bound(c, over)
