"""Follow-graph statistics over an adjacency list (user, follows array).

Out-degree and in-degree are a ``groupBy`` with map-side partial
aggregation, so a user who follows (or is followed by) a third of the graph
costs one partial row per task, not a third of the shuffle.  Summaries are a
single global ``agg`` whose partials reduce to one row per task; there is no
single-reducer step as in a two-stage map-reduce.

Tie rule for "most followed" ids: the largest count wins, equal counts go to
the smallest id (ids are compared as strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _top_id(id_col: str, n_col: str):
    # min over (-n, id): largest n first, then the smallest id.
    return F.min_by(F.col(id_col), F.struct((-F.col(n_col)).alias("k"), F.col(id_col).alias("i")))


def follow_counts_per_line(adj: DataFrame) -> DataFrame:
    """Out-degree per line; repeated owner lines stay separate."""
    return adj.select("user", F.size("follows").cast("bigint").alias("n_follows"))


def follow_counts(adj: DataFrame) -> DataFrame:
    """Out-degree per user, summed over the user's lines."""
    return adj.groupBy("user").agg(F.sum(F.size("follows")).cast("bigint").alias("n_follows"))


def out_degree_summary(counts: DataFrame) -> DataFrame:
    """One row: top_user, max_follows, avg_follows, n_zero (follows no one)."""
    return counts.agg(
        _top_id("user", "n_follows").alias("top_user"),
        F.coalesce(F.max("n_follows"), F.lit(0)).cast("bigint").alias("max_follows"),
        F.round(F.coalesce(F.avg("n_follows"), F.lit(0.0)), 6).alias("avg_follows"),
        F.count_if(F.col("n_follows") == 0).cast("bigint").alias("n_zero"))


def follow_summary(adj: DataFrame) -> DataFrame:
    return out_degree_summary(follow_counts(adj))


def summary_as_kv(summary: DataFrame, labels: tuple[str, str, str, str]) -> DataFrame:
    """One-row summary -> (metric, value) text rows, as the reference prints."""
    a, b, c, d = labels
    return summary.select(F.expr(
        "stack(4, "
        f"'{a}', top_user, "
        f"'{b}', cast(max_follows as string), "
        f"'{c}', format_string('%.6f', avg_follows), "
        f"'{d}', cast(n_zero as string)) as (metric, value)"))


def follower_counts(adj: DataFrame) -> DataFrame:
    """In-degree over owners AND mentioned ids; an owner seeds a zero."""
    owners = adj.select(F.col("user").alias("id"), F.lit(0).cast("bigint").alias("w"))
    mentioned = adj.select(F.explode("follows").alias("id"), F.lit(1).cast("bigint").alias("w"))
    return owners.unionByName(mentioned).groupBy("id").agg(F.sum("w").alias("n_followers"))


def follower_summary(adj: DataFrame) -> DataFrame:
    """Top id, max, mean and zero count over owners plus mentioned ids."""
    c = follower_counts(adj)
    return c.agg(
        _top_id("id", "n_followers").alias("top_id"),
        F.coalesce(F.max("n_followers"), F.lit(0)).cast("bigint").alias("max_followers"),
        F.round(F.coalesce(F.avg("n_followers"), F.lit(0.0)), 6).alias("avg_followers"),
        F.count_if(F.col("n_followers") == 0).cast("bigint").alias("n_zero"))


def follower_summary_owners(adj: DataFrame) -> DataFrame:
    """In-degree summary whose population is the distinct line owners.

    Top id and max come from the mentioned ids; the mean divides all
    follower links by the number of owners; the zero count is the owners
    nobody mentions, which stays right when mentioned ids own no line (the
    owners-minus-mentioned subtraction would not).  One full outer join of
    owners and follower counts (both one row per id) and one aggregate.
    """
    mentioned = (adj.select(F.explode("follows").alias("id"))
                 .groupBy("id").agg(F.count(F.lit(1)).alias("n_followers")))
    owners = adj.select(F.col("user").alias("id"), F.lit(True).alias("owner")).distinct()
    both = owners.join(mentioned, "id", "full")
    is_owner = F.col("owner").isNotNull()
    return both.agg(
        F.min_by(F.col("id"), F.when(F.col("n_followers").isNotNull(),
                                     F.struct((-F.col("n_followers")).alias("k"), F.col("id").alias("i"))))
        .alias("top_id"),
        F.coalesce(F.max("n_followers"), F.lit(0)).cast("bigint").alias("max_followers"),
        F.round(F.try_divide(F.coalesce(F.sum("n_followers"), F.lit(0)).cast("double"),
                             F.count_if(is_owner).cast("double")), 6).alias("avg_followers"),
        F.count_if(is_owner & F.col("n_followers").isNull()).cast("bigint").alias("n_zero"),
        F.count_if(is_owner).cast("bigint").alias("n_owners"))


def distinct_users(adj: DataFrame) -> DataFrame:
    return adj.agg(F.count_distinct("user").cast("bigint").alias("n_users"))
