"""HyperLogLog over tabulation hashing, as DataFrame jobs.

A sketch is the relation ``(j bigint, rho bigint)`` of non-empty registers
plus its parameters ``m`` (number of registers, a power of two) and ``seed``.
Building it is a projection (register index, hash, rho) followed by
``groupBy(j).agg(max(rho))``: partial aggregation leaves at most m rows per
task before the shuffle, whatever the key skew, and the final state is at
most m rows.  Merging is a union followed by the same aggregate.  Nothing is
collected; the estimate is one more aggregate over at most m rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import (multiply_shift_index, rho32, tabulation_hash_inline,
                                      with_tabulation_hash)

# Fixed values of the estimator: alpha = 0.7213 / (1 + 1.079 / m) for every m,
# linear counting below 5/2 m, large-range correction above 2^32 / 30.
ALPHA_NUM = 0.7213
ALPHA_DEN = 1.079
TWO_32 = float(2 ** 32)


@dataclass(frozen=True)
class Sketch:
    registers: DataFrame  # (j, rho)
    m: int
    seed: int


def _check_m(m: int) -> int:
    if m <= 0 or m & (m - 1):
        raise ValueError("m must be a positive power of two")
    return int(math.log2(m))


def hashed_keys(keys: DataFrame, key: str, seed: int, method: str = "join") -> DataFrame:
    """(key, h): 32-bit tabulation hash of each 64-bit key."""
    if method == "inline":
        return keys.select(F.col(key), tabulation_hash_inline(F.col(key), seed).alias("h"))
    return with_tabulation_hash(keys.select(key), key, seed)


def register_updates(keys: DataFrame, key: str, m: int, seed: int, method: str = "join") -> DataFrame:
    """(j, rho) per key: index from multiply-shift of the key, rho from its hash."""
    log2m = _check_m(m)
    hk = hashed_keys(keys.where(F.col(key).isNotNull()), key, seed, method)
    return hk.select(multiply_shift_index(F.col(key), log2m).alias("j"), rho32(F.col("h")).alias("rho"))


def build(keys: DataFrame, key: str, m: int = 1024, seed: int = 42, method: str = "join") -> Sketch:
    upd = register_updates(keys, key, m, seed, method)
    return Sketch(upd.groupBy("j").agg(F.max("rho").alias("rho")), m, seed)


def build_by(keys: DataFrame, key: str, by: str, m: int = 1024, seed: int = 42) -> DataFrame:
    """(by, j, rho): one sketch per value of ``by``, in one pass over the keys."""
    log2m = _check_m(m)
    hashed = with_tabulation_hash(keys.where(F.col(key).isNotNull()).select(by, key), key, seed)
    return (hashed.select(by, multiply_shift_index(F.col(key), log2m).alias("j"), rho32(F.col("h")).alias("rho"))
            .groupBy(by, "j").agg(F.max("rho").alias("rho")))


def merge_all(sketches: DataFrame, m: int, seed: int) -> Sketch:
    """The element-wise register maximum over all sketches of :func:`build_by`."""
    return Sketch(sketches.groupBy("j").agg(F.max("rho").alias("rho")), m, seed)


def merge(a: Sketch, b: Sketch) -> Sketch:
    """Element-wise register maximum; sizes and seeds must agree."""
    if a.m != b.m:
        raise ValueError("sketches must have the same number of registers")
    if a.seed != b.seed:
        raise ValueError("sketches must use the same hash seed")
    regs = a.registers.unionByName(b.registers).groupBy("j").agg(F.max("rho").alias("rho"))
    return Sketch(regs, a.m, a.seed)


def estimate(s: Sketch) -> DataFrame:
    """One row: m, n_set, estimate (double, rounded to 6), estimate_int.

    The harmonic sum is exact in double (terms are 2^-rho, rho <= 33, up to
    2^20 of them), so the result does not depend on summation order.
    The small-m alpha is the large-m formula, as in the reference.
    """
    m = float(s.m)
    alpha = ALPHA_NUM / (1 + ALPHA_DEN / m)
    agg = s.registers.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_set"),
        F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rho"))), F.lit(0.0)).alias("zsum"))
    v = F.lit(s.m) - F.col("n_set")
    z = F.col("zsum") + v.cast("double")
    e_raw = F.lit(alpha * m * m) / z
    est = (F.when((e_raw <= 2.5 * m) & (v > 0), F.lit(m) * F.log(F.lit(m) / v.cast("double")))
           .when(e_raw > TWO_32 / 30, -F.lit(TWO_32) * F.log(1 - e_raw / TWO_32))
           .otherwise(e_raw))
    return agg.select(F.lit(s.m).cast("bigint").alias("m"), "n_set",
                      F.round(est, 6).alias("estimate"), est.cast("bigint").alias("estimate_int"))


APPROX_RSD = 0.03     # asked of approx_count_distinct
DATASKETCH_LGK = 12   # 2^12 registers: about 1.6 % standard error


def approx_distinct(keys: DataFrame, key: str, sigmas: float = 4.0) -> DataFrame:
    """Spark's own sketches for the same question: (sketch, approx, low, high),
    one row per sketch.  The count lies within ``sigmas`` standard errors of
    ``approx``, from ``low`` to ``high``; no key is shuffled."""
    approx = keys.agg(F.approx_count_distinct(key, APPROX_RSD).cast("bigint").alias("hllpp"),
                      F.hll_sketch_estimate(F.hll_sketch_agg(key, DATASKETCH_LGK)).cast("bigint").alias("datasketch"))
    rows = approx.select(F.expr("stack(2, 'hllpp', hllpp, %s, 'datasketch', datasketch, %s) as (sketch, approx, err)"
                                % (repr(APPROX_RSD) + "D", repr(1.04 / math.sqrt(2 ** DATASKETCH_LGK)) + "D")))
    # approx is at most sigmas * err * n, rounded up, away from n
    slack = sigmas * F.col("err")
    return rows.select("sketch", "approx", F.floor((F.col("approx") - 1) / (1 + slack)).alias("low"),
                       F.ceil((F.col("approx") + 1) / (1 - slack)).alias("high"))
