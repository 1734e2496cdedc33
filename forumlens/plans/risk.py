"""Account-risk tables: how many of a group's regulars were later lost or banned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.ranking import top_per_group
from forumlens.operators.select import not_in


def risk(
    activity: DataFrame,
    users1: DataFrame,
    users2: DataFrame,
    group: str = "subreddit",
    n: int = 20,
    min_count: int = 100,
    member: str = "author_name",
) -> DataFrame:
    """Per group: regulars, and how many of them snapshot 2 marks as lost.

    A member's regular groups are their ``n`` most used ones (ties by group name); members
    without an id in snapshot 1 are left out before ranking.  Flags come over a left join,
    so members absent from snapshot 2 count but add NULL to the sums.
    """
    counted = activity.groupBy(group, F.col(member).alias("username")).agg(F.count(F.lit(1)).alias("_n"))
    known = not_in(counted, "username", users1.filter(F.col("id").isNull()).select("username"))
    regular = top_per_group(known, "username", [F.col("_n").desc(), F.col(group).asc_nulls_last()], n)
    flags = users2.select(
        "username",
        F.col("shadowbanned_by_date").isNotNull().cast("bigint").alias("_shadow"),
        F.col("suspended_by_date").isNotNull().cast("bigint").alias("_suspended"),
        F.col("id").isNull().cast("bigint").alias("_bad"),
    )
    return (
        regular.select(group, "username")
        .join(flags, "username", "left")
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("_shadow").alias("shadowban_count"),
            F.sum("_suspended").alias("suspended_count"),
            F.sum("_bad").alias("bad_count"),
        )
        .filter(F.col("count") >= min_count)
        .orderBy(F.col("count").desc(), F.col(group))
    )


def risk_by_comment_group(comments, users1, users2, n=20, min_count=100):
    return risk(comments, users1, users2, "subreddit", n, min_count)


def risk_by_thread_group(threads, users1, users2, n=20, min_count=100):
    return risk(threads, users1, users2, "subreddit", n, min_count)


def risk_by_domain(threads, users1, users2, n=20, min_count=100):
    return risk(threads, users1, users2, "domain", n, min_count)
