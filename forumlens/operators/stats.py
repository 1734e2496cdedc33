"""Member-by-group statistics in one hash aggregation (partial before the shuffle)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.operators.select import as_ntz, in_list


def count_where(cond: Column) -> Column:
    """Rows meeting ``cond``; 0, not NULL, when none does."""
    return F.count(F.when(cond, 1))


def sum_where(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(0))


# The two signed counts split at different scores than the two signed sums; both are kept.
STATS = {
    "count": lambda s: F.count(F.lit(1)).alias("count"),
    "pos_count": lambda s: count_where(s > 0).alias("pos_count"),
    "neg_count": lambda s: count_where(s < 1).alias("neg_count"),
    "score_sum": lambda s: F.sum(s).alias("score_sum"),
    "pos_sum": lambda s: sum_where(s > 0, s).alias("pos_sum"),
    "neg_sum": lambda s: sum_where(s < 0, s).alias("neg_sum"),
    "score_min": lambda s: F.min(s).alias("score_min"),
    "score_max": lambda s: F.max(s).alias("score_max"),
}


def member_group(df: DataFrame, stats: Iterable[str] | None = None, group: str = "subreddit",
                 member: str = "author_name", score: str = "score") -> DataFrame:
    """Chosen statistics per (group, member); all of them if ``stats`` is None, none if empty."""
    wanted = list(STATS) if stats is None else list(stats)
    keys = [F.col(group), F.col(member).alias("username")]
    if not wanted:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[STATS[name](F.col(score)) for name in wanted])


def where_range(df: DataFrame, since=None, until=None, groups: DataFrame | None = None,
                created: str = "created", group: str = "subreddit") -> DataFrame:
    """Rows created between two instants (both included) in the listed groups."""
    rows = df
    if since is not None:
        rows = rows.filter(F.col(created) >= as_ntz(since))
    if until is not None:
        rows = rows.filter(F.col(created) <= as_ntz(until))
    return in_list(rows, group, groups)
