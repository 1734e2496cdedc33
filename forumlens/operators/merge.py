"""Freshness-gated merges of a batch of records into a current-state or history table.

Plain Parquet has no MERGE, so a merge is a join that yields the new table.  All joins and
aggregations of one merge share the record key, so rows are placed by that key once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.scalars import elapsed_days
from forumlens.operators.ranking import columns, first_by_key, match_keys

Policy = Callable[[Column, Column, bool], Column]


def _fresh(elapsed: Column, delay: float) -> Column:
    return F.lit(True) if delay == -1 else elapsed < delay


def policy_users(delay: float) -> Policy:
    """A stored user changes only when the stored row is old enough."""
    return lambda elapsed, mode, history: ~_fresh(elapsed, delay)


def policy_threads(delay: float) -> Policy:
    """Full 'thread' records always pass; others only feed a history, once old enough."""
    return lambda elapsed, mode, history: (mode == "thread") | (F.lit(history) & ~_fresh(elapsed, delay))


def policy_comments() -> Policy:
    """Full 'thread' records update; a history takes every observation."""
    return lambda elapsed, mode, history: (mode == "thread") | F.lit(history)


def policy_always() -> Policy:
    return lambda elapsed, mode, history: F.lit(True)


def _keyed(df: DataFrame, keys: list[str], fold_case: bool) -> DataFrame:
    make = (lambda k: F.lower(k)) if fold_case else F.col
    return df.withColumns({f"_key_{k}": make(k) for k in keys})


def admitted(target: DataFrame, source: DataFrame, key, policy: Policy, ts: str | None = "timestamp",
             history: bool = False, fold_case: bool = False) -> DataFrame:
    """Source rows the policy lets through: those with an unseen key and the permitted updates."""
    keys = columns(key)
    hidden = [f"_key_{k}" for k in keys]
    seen = F.max(ts).alias("_seen") if ts else F.lit(None).cast("timestamp_ntz").alias("_seen")
    state = _keyed(target, keys, fold_case).groupBy(*hidden).agg(seen, F.lit(True).alias("_stored"))
    rows = _keyed(source, keys, fold_case).alias("s").join(state.alias("t"), hidden, "left")
    elapsed = elapsed_days(F.col(ts), F.col("_seen")) if ts else F.lit(None).cast("double")
    mode = F.col("scrape_mode") if "scrape_mode" in source.columns else F.lit("")
    unseen = F.col("_stored").isNull()
    if ts:
        unseen = unseen | F.col("_seen").isNull()
    passes = unseen | F.coalesce(policy(elapsed, mode, history), F.lit(False))
    return rows.filter(passes).select(*source.columns)


def reduce_batch(source: DataFrame, key, order: list[str], fold_case: bool = False) -> DataFrame:
    """One row per key: the newest non-NULL value of every column."""
    keys = columns(key)
    hidden = [f"_key_{k}" for k in keys]
    rank = F.struct(*[F.col(c) for c in order])
    newest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c)
        for c in source.columns
        if c not in keys or fold_case
    ]
    reduced = _keyed(source, keys, fold_case).groupBy(*hidden).agg(*newest)
    if not fold_case:
        reduced = reduced.withColumns({k: F.col(f"_key_{k}") for k in keys})
    return reduced.select(*source.columns)


def patch(target: DataFrame, source: DataFrame, key, update_cols: list[str] | None = None,
          fold_case: bool = False) -> DataFrame:
    """Upsert one source row per key; a NULL source value keeps the stored one."""
    keys = columns(key)
    t = _keyed(target, keys, fold_case).withColumn("_in_t", F.lit(True))
    s = _keyed(source, keys, fold_case)
    s = s.select(*[F.col(c).alias(f"_new_{c}") for c in s.columns])
    joined = t.join(s, match_keys([f"_key_{k}" for k in keys], "_new_"), "full_outer")
    out = []
    for c in dict.fromkeys([*target.columns, *source.columns]):
        if c not in target.columns:
            value = F.col(f"_new_{c}")
        elif c not in source.columns:
            value = F.col(c)
        elif c in keys:
            value = F.coalesce(F.col(c), F.col(f"_new_{c}"))
        elif update_cols is not None and c not in update_cols:
            value = F.when(F.col("_in_t").isNotNull(), F.col(c)).otherwise(F.col(f"_new_{c}"))
        else:
            value = F.coalesce(F.col(f"_new_{c}"), F.col(c))
        out.append(value.alias(c))
    return joined.select(*out)


def merge(target: DataFrame, source: DataFrame, key, policy: Policy, ts: str | None = "timestamp",
          ties: tuple[str, ...] = (), history: bool = False, update_cols: list[str] | None = None,
          fold_case: bool = False) -> DataFrame:
    """Target after the batch: insert unseen keys, apply what the policy permits.

    ``ties`` order source rows of one key that share a timestamp.
    """
    rows = admitted(target, source, key, policy, ts, history, fold_case)
    if history:
        return target.unionByName(rows, allowMissingColumns=True)
    return applied(target, rows, key, ts, ties, update_cols, fold_case)


def applied(target: DataFrame, rows: DataFrame, key, ts: str | None = "timestamp", ties: tuple[str, ...] = (),
            update_cols: list[str] | None = None, fold_case: bool = False) -> DataFrame:
    """Target after rows that the policy let through."""
    order = ([ts] if ts else []) + list(ties)
    if not order:
        raise ValueError("a merge needs a timestamp or tie columns to order rows of one key")
    return patch(target, reduce_batch(rows, key, order, fold_case), key, update_cols, fold_case)


def merge_users(target, source, delay: float, history: bool = False, **kw):
    return merge(target, source, "username", policy_users(delay), history=history, **kw)


def merge_threads(target, source, delay: float, history: bool = False, **kw):
    return merge(target, source, "id", policy_threads(delay), history=history, **kw)


def merge_comments(target, source, history: bool = False, **kw):
    return merge(target, source, "id", policy_comments(), history=history, **kw)


def merge_subreddits(target, source, history: bool = False, **kw):
    """Group names are one key whatever their case."""
    return merge(target, source, "subreddit", policy_always(), history=history, fold_case=True, **kw)


def merge_traffic(target, source, **kw):
    return merge(target, source, ["subreddit", "period_type", "time"], policy_always(), **kw)


def upsert_award_counts(target, source, owner: str, **kw):
    """A known (owner, award) gets the new count, nothing else changes."""
    return merge(target, source, [owner, "award_name"], policy_always(), update_cols=["award_count"], **kw)


def missing_rows(target: DataFrame, new: DataFrame, key) -> DataFrame:
    """Rows of ``new`` whose key is not stored; NULL keys match NULL keys."""
    keys = columns(key)
    stored = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
    return new.join(stored, match_keys(keys, "_old_"), "left_anti")


def first_of(df: DataFrame, key, order: list[Column] | None = None) -> DataFrame:
    """First row of every key in ``order``; without one the least row, so the survivor is always the same."""
    plain = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return first_by_key(df, key, [*(order or []), *plain])


def append_missing(target: DataFrame, new: DataFrame, key, order: list[Column] | None = None) -> DataFrame:
    """Insert-or-ignore: the stored row of a known key wins, then the first new one in ``order``."""
    fresh = first_of(missing_rows(target, new, key), key, order)
    return target.unionByName(fresh, allowMissingColumns=True)


def append(history: DataFrame, observations: DataFrame) -> DataFrame:
    return history.unionByName(observations, allowMissingColumns=True)
