"""Exact ranking and top-n that never funnel a whole group through one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import freeze

# Spark pre-trims ``row_number() <= n`` inside every map task up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold); larger n goes through exact_rank.
WINDOW_LIMIT = 1000


def columns(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def match_keys(keys: list[str], other: str) -> Column:
    """Null-safe equality of ``k`` with ``other + k``; still planned as an equi-join.

    One side is renamed first, so both may stem from the same table.
    """
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other + k)) for k in keys])


def exact_rank(df: DataFrame, order: list[Column], by=(), name: str = "rn") -> DataFrame:
    """``row_number()`` per ``by`` (1-based) without a per-group task.

    Rows are range-partitioned on (by, order), so one hot group is spread over as many
    partitions as its size needs.  Position inside a partition comes from the row id; the
    offset of each partition comes from a table with one row per (partition, group).
    The placed rows are frozen first because both steps must see the same placement.
    ``order`` should be total; ties otherwise rank arbitrarily, as in SQL.
    """
    by = columns(by)
    sort_keys = [F.col(k) for k in by] + list(order)
    placed = freeze(
        df.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_part", F.shiftright("_slot", 33))
    runs = placed.groupBy("_part", *by).agg(F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_len"))
    # One row per partition that a group touches, so this window stays small.
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    keys = ["_part", *by]
    before = F.coalesce(F.sum("_len").over(earlier), F.lit(0))
    shifts = runs.select(*[F.col(k).alias(f"_of_{k}") for k in keys], (before - F.col("_first") + 1).alias("_shift"))
    joined = placed.join(shifts, match_keys(keys, "_of_"))
    return joined.select(*df.columns, (F.col("_slot") + F.col("_shift")).alias(name))


def top_per_group(df: DataFrame, group, order: list[Column], n: int, name: str = "rn") -> DataFrame:
    """First ``n`` rows of every group; small n is trimmed map-side by Spark itself."""
    if n > WINDOW_LIMIT:
        return exact_rank(df, order, group, name).filter(F.col(name) <= n)
    window = Window.partitionBy(*columns(group)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def first_by_key(df: DataFrame, key, order: list[Column]) -> DataFrame:
    """Keep the earliest row of every key (a key seen before is ignored)."""
    return top_per_group(df, key, order, 1, "_first").drop("_first")


def latest(df: DataFrame, key, ts: str = "timestamp", ties: tuple[str, ...] = ()) -> DataFrame:
    """Current-state view of a history table: the newest observation per key."""
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in ties]
    return first_by_key(df, key, order)


def ordinal(df: DataFrame, key: str, by: Column, name: str = "ordinal", descending: bool = True) -> DataFrame:
    """Dense rank of ``key`` by a summary value: equal values share an ordinal."""
    valued = df.withColumn("_by", by)
    values = valued.filter(F.col("_by").isNotNull()).select("_by").distinct()
    order = F.col("_by").desc() if descending else F.col("_by").asc()
    return valued.join(exact_rank(values, [order], (), name), "_by", "left").drop("_by")
