"""Login-attempt analysis of sshd syslog lines.

One pass parses every login line into one frame (day, outcome, account,
invalid account, ip, weight); every report is an aggregate over that frame.
The reference's per-field parallel datasets re-joined by position become
sibling columns of one row, and its accepted/failed union plus left join
becomes conditional sums in one ``groupBy``.

Tie rule for every "top" report: larger count first, then the smaller key,
NULL keys last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import authlog as A


def parse(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Login lines only -> (day, is_ok, is_invalid, account, invalid_account, ip, w).

    ``invalid_account`` is set only on failed invalid-user lines ('' when the
    name is empty, while ``account`` is NULL then).
    """
    line = F.col(line_col)
    ok = line.contains(A.ACCEPTED)
    failed = line.contains(A.FAILED)
    inv = line.contains(A.FAILED_INVALID)
    return (lines.where(ok | failed)
            .select(A.day_key(line).alias("day"),
                    ok.cast("int").alias("is_ok"),
                    inv.cast("int").alias("is_invalid"),
                    A.account(line).alias("account"),
                    F.when(inv, A.invalid_account(line)).alias("invalid_account"),
                    A.source_ip(line).alias("ip"),
                    A.attempt_weight(line).alias("w")))


def filter_counts(lines: DataFrame, line_col: str = "line") -> DataFrame:
    line = F.col(line_col)
    return lines.agg(
        F.count_if(line.contains(A.ACCEPTED)).cast("bigint").alias("n_accepted"),
        F.count_if(line.contains(A.FAILED)).cast("bigint").alias("n_failed"),
        F.count_if(line.contains(A.FAILED_INVALID)).cast("bigint").alias("n_failed_invalid"))


def union_attempts(parsed: DataFrame) -> DataFrame:
    """Bag union of the accepted and the failed attempt frames."""
    acc = parsed.where("is_ok = 1").select("account", "w", "is_ok")
    fail = parsed.where("is_ok = 0").select("account", "w", "is_ok")
    return acc.unionByName(fail)


def per_account(parsed: DataFrame) -> DataFrame:
    """attempts, successes, failures per account in one aggregate."""
    ok = F.col("is_ok") == 1
    return parsed.groupBy("account").agg(
        F.sum("w").cast("bigint").alias("attempts"),
        F.coalesce(F.sum(F.when(ok, F.col("w"))), F.lit(0)).cast("bigint").alias("successes"),
        F.coalesce(F.sum(F.when(~ok, F.col("w"))), F.lit(0)).cast("bigint").alias("failures"))


def attempts_by_account(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("account").agg(F.sum("w").cast("bigint").alias("attempts"))


def successes_by_account(parsed: DataFrame) -> DataFrame:
    return (parsed.where("is_ok = 1").groupBy("account")
            .agg(F.sum("w").cast("bigint").alias("successes")))


def failures_by_account(parsed: DataFrame) -> DataFrame:
    return (parsed.where("is_ok = 0").groupBy("account")
            .agg(F.sum("w").cast("bigint").alias("failures")))


def success_rate(parsed: DataFrame) -> DataFrame:
    """successes / attempts for accounts with at least one success."""
    pa = per_account(parsed).where("successes > 0")
    return pa.select("account", "successes", "attempts",
                     (F.col("successes") / F.col("attempts")).alias("rate"))


def best_success_rate(parsed: DataFrame) -> DataFrame:
    """Every account whose rate equals the maximum (all ties kept).

    The maximum is a scalar subquery evaluated once; both sides use the same
    division on the same integers, so equality is exact.
    """
    sr = success_rate(parsed)
    top = sr.select(F.max("rate")).scalar()
    return sr.where(F.col("rate") == top).select("account", F.round("rate", 6).alias("rate"))


def failures_by_ip(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_ok = 0").groupBy("ip").agg(F.sum("w").cast("bigint").alias("failures"))


def failures_by_invalid(parsed: DataFrame) -> DataFrame:
    return (parsed.where("is_invalid = 1").groupBy("invalid_account")
            .agg(F.sum("w").cast("bigint").alias("failures")))


def attempts_by_day(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("day").agg(F.sum("w").cast("bigint").alias("attempts"))


def top_k(df: DataFrame, key: str, n_col: str, k: int) -> DataFrame:
    """Top k by count: a TakeOrderedAndProject, k rows kept per task."""
    return df.orderBy(F.desc(n_col), F.asc_nulls_last(key)).limit(k)


def day_extremes(parsed: DataFrame) -> DataFrame:
    d = attempts_by_day(parsed)
    return d.agg(
        F.min_by("day", F.struct((-F.col("attempts")).alias("k"), F.col("day").alias("d"))).alias("most_day"),
        F.max("attempts").alias("most_attempts"),
        F.min_by("day", F.struct(F.col("attempts").alias("k"), F.col("day").alias("d"))).alias("least_day"),
        F.min("attempts").alias("least_attempts"))


def tallies(parsed: DataFrame) -> DataFrame:
    """Every tally of the log in one scan and one shuffle:
    (kind, key, attempts, successes, failures), kind one of account, ip, day,
    invalid_account.  ``invalid_account`` only has failures of invalid users.

    GROUPING SETS aggregate each row under four keys; partial aggregation
    leaves one row per key and task."""
    kinds = ("account", "ip", "day", "invalid_account")
    ok = F.col("is_ok") == 1
    zero = F.lit(0).cast("bigint")
    sums = parsed.groupingSets([[k] for k in kinds], *kinds).agg(
        F.grouping_id().alias("gid"), F.sum("w").cast("bigint").alias("attempts"),
        F.coalesce(F.sum(F.when(ok, F.col("w"))), zero).cast("bigint").alias("successes"),
        F.coalesce(F.sum(F.when(~ok, F.col("w"))), zero).cast("bigint").alias("failures"),
        F.max("is_invalid").alias("invalid"))
    # the grouping id has a bit for each key that a row is not grouped by
    of = {(1 << len(kinds)) - 1 - (1 << (len(kinds) - 1 - i)): k for i, k in enumerate(kinds)}
    kind = F.coalesce(*[F.when(F.col("gid") == g, F.lit(k)) for g, k in of.items()])
    key = F.coalesce(*[F.when(F.col("gid") == g, F.col(k)) for g, k in of.items()])
    out = sums.select(kind.alias("kind"), key.alias("key"), "attempts", "successes", "failures", "invalid")
    # rows of valid users have no invalid account
    return out.where(~((F.col("kind") == "invalid_account") & F.col("key").isNull() & (F.col("invalid") == 0))).drop("invalid")
