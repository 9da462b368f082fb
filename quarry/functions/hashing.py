"""64-bit hashing as column expressions (ANSI-safe, no UDF).

Spark has no unsigned 64-bit type and ANSI mode raises on bigint overflow,
so the multiply-shift register index is computed from 16-bit limbs whose
partial products never exceed 2^35.

Seeded random tables cannot reuse NumPy's generator in SQL; every seeded
draw here is the first 32 bits of ``md5('<seed>:<a>:<b>...')``, which both
Spark and DuckDB can compute.  The values therefore differ from the
reference per seed but have the same (uniform) distribution.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the odd multiplier of the register index.
MULTIPLIER = 0xC863B1E7D63F37A3

TAB_CHUNKS = 4          # 64-bit key = four 16-bit chunks
TAB_SIZE = 1 << 16      # entries per table


def _limb(x: Column, i: int) -> Column:
    return F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(65535))


def multiply_shift_index(x: Column, log2m: int) -> Column:
    """Top ``log2m`` bits of ``x * MULTIPLIER mod 2^64`` (log2m below 64)."""
    if not 0 <= log2m <= 63:
        raise ValueError("log2m must be in [0, 63]")
    if not log2m:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    x0, x1, x2, x3 = (_limb(x, i) for i in range(4))
    c0, c1, c2, c3 = (F.lit(MULTIPLIER >> (16 * i) & 0xFFFF).cast("bigint") for i in range(4))
    p0 = x0 * c0
    p1 = x0 * c1 + x1 * c0 + F.shiftrightunsigned(p0, 16)
    p2 = x0 * c2 + x1 * c1 + x2 * c0 + F.shiftrightunsigned(p1, 16)
    p3 = x0 * c3 + x1 * c2 + x2 * c1 + x3 * c0 + F.shiftrightunsigned(p2, 16)
    if log2m <= 16:
        return F.shiftrightunsigned(p3.bitwiseAND(F.lit(65535)), 16 - log2m)
    whole = p0.bitwiseAND(F.lit(65535))
    for i, p in enumerate((p1, p2, p3), 1):
        whole = whole.bitwiseOR(F.shiftleft(p.bitwiseAND(F.lit(65535)), 16 * i))
    return F.shiftrightunsigned(whole, 64 - log2m)


def md5_u32(*parts) -> Column:
    """First 32 bits of md5 of the ':'-joined parts, as bigint in [0, 2^32)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    s = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def md5_u32_py(*parts) -> int:
    """Driver-side twin of :func:`md5_u32` for parameter-sized constants."""
    s = ":".join(str(p) for p in parts)
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)


def tabulation_hash_inline(x: Column, seed: int) -> Column:
    """64 -> 32 bit tabulation hash: XOR of four table entries chosen by the
    16-bit chunks of x, low chunk first; entries computed inline."""
    h = None
    for i in range(TAB_CHUNKS):
        e = md5_u32(seed, i, _limb(x, i))
        h = e if h is None else h.bitwiseXOR(e)
    return h


def tabulation_tables(spark: SparkSession, seed: int) -> DataFrame:
    """(tbl, idx, v): 4 x 65,536 uniform 32-bit entries; size fixed by the
    algorithm (262,144 rows, about 6 MB), independent of the data."""
    r = spark.range(TAB_CHUNKS * TAB_SIZE).select(F.shiftright("id", 16).alias("tbl"),
                                                  F.col("id").bitwiseAND(F.lit(TAB_SIZE - 1)).alias("idx"))
    return r.select("tbl", "idx", md5_u32(seed, F.col("tbl"), F.col("idx")).alias("v"))


def with_tabulation_hash(df: DataFrame, key: str, seed: int, out: str = "h") -> DataFrame:
    """Join form of the tabulation hash: four equi-joins against the table
    slices.  The table has a proven size bound, so it is broadcast."""
    spark = df.sparkSession
    cur = df
    names = []
    for i in range(TAB_CHUNKS):
        k, v = f"__tk{i}", f"__tv{i}"
        sl = spark.range(TAB_SIZE).select(F.col("id").alias(k), md5_u32(seed, i, F.col("id")).alias(v))
        cur = (cur.withColumn(k, _limb(F.col(key), i))
               .join(F.broadcast(sl), k, "left").drop(k))
        names.append(v)
    h = F.col(names[0])
    for n in names[1:]:
        h = h.bitwiseXOR(F.col(n))
    return cur.withColumn(out, h).drop(*names)


def rho32(h: Column) -> Column:
    """1-based position of the leftmost one in a 32-bit value; 33 for zero."""
    return F.when(h == 0, F.lit(33)).otherwise(F.lit(33) - F.length(F.bin(h))).cast("bigint")
