"""Choosing what to process next: filters, semi and anti joins, set unions, limits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.scalars import elapsed_days
from forumlens.operators.ranking import columns, exact_rank, top_per_group
from forumlens.session import freeze

# Names that mean "any group" in a request list.
ANY_GROUP = ("random", "randnsfw")


def as_ntz(when: dt.datetime | str) -> Column:
    return F.lit(str(when)).cast("timestamp_ntz")


def in_list(df: DataFrame, col: str, wanted: DataFrame | None) -> DataFrame:
    """Keep rows whose ``col`` is listed; an empty or all-random list filters nothing.

    ``wanted`` has one column.  A list that AQE measures as small is broadcast, a large
    one is shuffled; either way the join is a semi join, never a literal IN list.
    """
    if wanted is None:
        return df
    names = wanted.select(F.col(wanted.columns[0]).alias("_name")).filter(F.col("_name").isNotNull())
    # Looks at one row of the request list only, so the plan below needs no second branch.
    if names.filter(~F.col("_name").cast("string").isin(*ANY_GROUP)).isEmpty():
        return df
    return df.join(names.distinct(), F.col(col) == F.col("_name"), "left_semi")


def not_in(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """SQL ``col NOT IN (list)`` with its NULL rules, as a shuffled anti join.

    NULL ``col`` rows stay only if the list is empty; a NULL in the list removes every
    row.  Spark's own null-aware anti join must broadcast the list; this one need not.
    """
    keys = listed.select(F.col(listed.columns[0]).alias("_listed"))
    facts = keys.agg(F.count(F.lit(1)).alias("n"), F.count("_listed").alias("known"))
    empty = facts.select(F.col("n") == 0).scalar()
    no_null = facts.select(F.col("n") == F.col("known")).scalar()
    present = keys.filter(F.col("_listed").isNotNull()).distinct()
    # NULL keys are dropped before the join unless the list is empty, so they cannot pile
    # up in one shuffle partition.
    kept = df.filter(no_null & (F.col(col).isNotNull() | empty))
    return kept.join(present, F.col(col) == F.col("_listed"), "left_anti")


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION of one-column frames; each side is reduced before it is shuffled together."""
    name = frames[0].columns[0]
    out = frames[0]
    for other in frames[1:]:
        out = out.union(other.select(F.col(other.columns[0]).alias(name)))
    return out.distinct()


def members_of(comments: DataFrame, threads: DataFrame, member: str = "author_name") -> DataFrame:
    return union_distinct(comments.select(member), threads.select(member))


def shuffle(df: DataFrame, seed: int = 0) -> DataFrame:
    """Random order that is the same on every run and after any task retry."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]))


def limit(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in ``order``; only n rows per task reach the final merge."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def unseen(comments, threads, users, n: int | None = None, seed: int = 0) -> DataFrame:
    """Authors that are not users yet, optionally a random ``n`` of them."""
    new = not_in(members_of(comments, threads), "author_name", users.select("username"))
    if n is None:
        return new
    return limit(new, n, F.xxhash64(F.lit(seed), F.col("author_name")), F.col("author_name"))


def last_seen(df: DataFrame, key, ts: str = "timestamp", cond: Column | None = None,
              case_insensitive: bool = False) -> DataFrame:
    """Newest observation time per key."""
    rows = df if cond is None else df.filter(cond)
    keys = [F.lower(k).alias(k) if case_insensitive else F.col(k) for k in columns(key)]
    return rows.groupBy(*keys).agg(F.max(ts).alias("last_seen"))


def stale(wanted: DataFrame, users: DataFrame, delay: float, now, key: str = "username",
          ts: str = "timestamp") -> DataFrame:
    """Listed members that are unknown or last seen more than ``delay`` days ago."""
    seen = last_seen(users.filter(F.col(key).isNotNull()), key, ts)
    due = F.lit(False) if delay == -1 else elapsed_days(as_ntz(now), "last_seen") >= delay
    return wanted.join(seen, key, "left").filter(F.col("last_seen").isNull() | due).select(*wanted.columns)


def days_before(now, days: float) -> Column:
    """A point in time to compare a bare column with, so that the filter reaches the files."""
    return as_ntz(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(days) * 86400))


def valid(posts: DataFrame, stored: DataFrame, now, min_comments: int = 0, max_comments: int | None = None,
          age: tuple[float, float] | None = None, delay: float = -1, ts: str = "timestamp") -> DataFrame:
    """Posts within comment and age bounds that are new or last refreshed too long ago."""
    kept = posts
    if min_comments:
        kept = kept.filter(F.col("num_comments") >= min_comments)
    if max_comments is not None:
        kept = kept.filter(F.col("num_comments") <= max_comments)
    if age is not None:
        kept = kept.filter(F.col("created").between(days_before(now, age[1]), days_before(now, age[0])))
    seen = last_seen(stored, "id", ts, F.col("scrape_mode") == "thread")
    due = F.lit(False) if delay == -1 else elapsed_days(as_ntz(now), "last_seen") > delay
    return kept.join(seen, "id", "left").filter(F.col("last_seen").isNull() | due).select(*posts.columns)


def members_in_groups(users, comments, threads, groups: DataFrame, delay: float | None = None, now=None,
                      seed: int = 0, ts: str = "timestamp") -> DataFrame:
    """Users active in the given groups, optionally only stale ones, shuffled."""
    active = members_of(in_list(comments, "subreddit", groups), in_list(threads, "subreddit", groups))
    rows = users
    if delay not in (None, -1):
        rows = rows.filter(F.col(ts) < days_before(now, delay))
    chosen = rows.select("username").join(active, F.col("username") == F.col("author_name"), "left_semi")
    return shuffle(chosen, seed)


def _refreshable(df, now, age, delay, groups, mode, ts):
    rows = df
    if age is not None:
        now_ = as_ntz(now)
        day = lambda d: F.make_dt_interval(F.lit(int(d)))
        rows = rows.filter(F.col("created").between(now_ - day(age[1]), now_ - day(age[0])))
    if delay not in (None, -1):
        rows = rows.filter(F.col(ts) < as_ntz(now) - F.make_dt_interval(F.lit(int(delay))))
    if mode is not None:
        rows = rows.filter(F.col("scrape_mode") == mode)
    return in_list(rows, "subreddit", groups)


def threads_to_refresh(threads, now, age=None, delay=None, groups: DataFrame | None = None,
                       mode: str | None = "thread", min_comments: int | None = None,
                       max_comments: int | None = None, comments: DataFrame | None = None,
                       ts: str = "timestamp") -> DataFrame:
    """Ids of threads to visit again; with ``comments`` also threads known only by a comment.

    Comment counts bound threads only when no comments are given, since a comment does
    not carry its thread's count.
    """
    rows = _refreshable(threads, now, age, delay, groups, mode, ts)
    if comments is not None:
        found = _refreshable(comments, now, age, delay, groups, mode, ts)
        return union_distinct(rows.select("id"), found.select("thread_id"))
    if min_comments is not None:
        rows = rows.filter(F.col("num_comments") >= min_comments)
    if max_comments is not None:
        rows = rows.filter(F.col("num_comments") <= max_comments)
    return rows.select("id")


def resample(users1, users2, lo: float, hi: float, now, ts: str = "timestamp") -> DataFrame:
    """Snapshot-1 users missing in snapshot 2, oldest first, with the seconds still to wait."""
    age = elapsed_days(as_ntz(now), ts)
    return (
        users1.join(users2.select("username"), "username", "left_anti")
        .filter(F.col(ts) >= days_before(now, hi))
        .select("username", F.col(ts), F.greatest(F.lit(0.0), (lo - age) * 86400.0).alias("wait_seconds"))
        .orderBy(ts, "username")
    )


def missing_groups(wanted: DataFrame, moderators: DataFrame) -> DataFrame:
    """Requested groups that have no stored moderators."""
    return not_in(wanted.distinct(), wanted.columns[0], moderators.select("subreddit"))


def group_activity(comments, threads, exclude: DataFrame | None = None) -> DataFrame:
    """Threads plus comments per group, most active first."""
    counts = (
        comments.select("subreddit").unionAll(threads.select("subreddit"))
        .groupBy("subreddit").agg(F.count(F.lit(1)).alias("count"))
    )
    if exclude is not None:
        counts = not_in(counts, "subreddit", exclude)
    return counts.orderBy(F.col("count").desc(), "subreddit")


def groups_min(comments, threads, minimum: int | None = None, strict: bool = True) -> DataFrame:
    """Groups seen at all, or seen more than (``strict``) / at least ``minimum`` times."""
    if minimum is None:
        return union_distinct(comments.select("subreddit"), threads.select("subreddit"))
    counts = group_activity(comments, threads)
    enough = F.col("count") > minimum if strict else F.col("count") >= minimum
    return counts.filter(enough).select("subreddit")


def new_ids(ids: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Ids that are not stored yet."""
    return ids.join(stored.select(key), key, "left_anti")


def batches(df: DataFrame, size: int = 100, order: list[Column] | None = None) -> DataFrame:
    """Number rows in chunks of ``size``."""
    order = order or [F.col(c) for c in df.columns]
    ranked = exact_rank(df, order)
    return ranked.withColumn("batch", F.floor((F.col("rn") - 1) / size)).drop("rn")


def interleave(df: DataFrame, group: str, order: list[Column], cap: int | None = None) -> DataFrame:
    """Take the next item of each group in turn; with ``cap`` each group queues at most so many items."""
    turns = exact_rank(df, order, group, "turn") if cap is None else top_per_group(df, group, order, cap, "turn")
    return turns.orderBy("turn", group)


def threads_of(members: DataFrame, comments, threads) -> DataFrame:
    """Threads reached through the members' comments and submissions."""
    key = members.columns[0]
    pick = lambda df, col: df.join(members, F.col("author_name") == members[key], "left_semi").select(
        F.col(col).alias("thread_id")
    )
    return union_distinct(pick(comments, "thread_id"), pick(threads, "id"))


def known(df: DataFrame, requested: DataFrame, col: str = "subreddit") -> DataFrame:
    """Requested groups plus every group already stored."""
    return union_distinct(requested.select(F.col(requested.columns[0]).alias(col)), df.select(col))


def related(mentions: DataFrame) -> DataFrame:
    """Mention edges, one per (group, target, kind, page)."""
    return mentions.select("subreddit", "related_subreddit", "relationship_type", "wiki_name").distinct()


def k_hop(edges: DataFrame, seeds: DataFrame, k: int, exclude: DataFrame | None = None,
          sizes: DataFrame | None = None, min_size: int | None = None, max_size: int | None = None) -> DataFrame:
    """Groups within ``k`` mentions of the seeds, with the hop at which each was first met.

    ``edges``: (subreddit, related_subreddit); ``seeds``: one column; ``sizes``:
    (subreddit, subscribers).  Excluded and out-of-range groups are neither returned nor
    expanded; seeds always are.  Each round touches only the newly met groups and writes
    them to the shared folder.
    """
    links = edges.select(F.col("subreddit").alias("_from"), F.col("related_subreddit").alias("subreddit"))
    links = links.filter(F.col("_from").isNotNull() & F.col("subreddit").isNotNull()).distinct()
    if exclude is not None:
        links = links.join(exclude.select(F.col(exclude.columns[0]).alias("subreddit")), "subreddit", "left_anti")
    if sizes is not None:
        allowed = sizes
        if min_size is not None:
            allowed = allowed.filter(F.col("subscribers") >= min_size)
        if max_size is not None:
            allowed = allowed.filter(F.col("subscribers") <= max_size)
        links = links.join(allowed.select("subreddit"), "subreddit", "left_semi")
    links = freeze(links, "links")
    visited = freeze(seeds.select(F.col(seeds.columns[0]).alias("subreddit")).distinct().withColumn("hop", F.lit(0)))
    frontier = visited
    for hop in range(1, k + 1):
        met = links.join(frontier.select(F.col("subreddit").alias("_from")), "_from", "left_semi")
        fresh = met.select("subreddit").distinct().join(visited.select("subreddit"), "subreddit", "left_anti")
        frontier = freeze(fresh.withColumn("hop", F.lit(hop)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited
