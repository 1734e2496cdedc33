"""Turning raw nested records into flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.scalars import MENTION_PATTERN, epoch_utc
from forumlens.operators.merge import first_of, missing_rows
from forumlens.operators.ranking import columns, exact_rank

# Map keys of the three gildings.
GILDING_KEYS = {"gid_1": "silver", "gid_2": "gold", "gid_3": "platinum"}


def sum_maps(df: DataFrame, by, col: str, prefix: str = "") -> DataFrame:
    """Sum the gilding maps per member, one column per metal.

    Summed key by key without exploding, so a hot member is combined before the shuffle.
    """
    value = lambda key: F.coalesce(F.try_element_at(F.col(col), F.lit(key)), F.lit(0))
    return df.groupBy(*columns(by)).agg(
        *[F.sum(value(key)).alias(f"{prefix}{metal}") for key, metal in GILDING_KEYS.items()]
    )


def award_facts(df: DataFrame, key: str, awards: str = "awards") -> DataFrame:
    """(owner, award_name, subreddit_id, award_count) from an array of award structs."""
    return df.select(key, F.explode(awards).alias("_a")).select(
        key,
        F.col("_a.name").alias("award_name"),
        F.col("_a.subreddit_id").alias("subreddit_id"),
        F.col("_a.count").alias("award_count"),
    )


def new_awards(definitions: DataFrame, dim: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Award definitions not stored yet, the first of each in ``order``; a site-wide award has a NULL subreddit_id."""
    key = ["name", "subreddit_id"]
    return missing_rows(dim, first_of(definitions, key, order), key)


def traffic(df: DataFrame, key: str = "subreddit") -> DataFrame:
    """(epoch, unique, total) arrays for days and hours to one row per period."""
    periods = F.explode(
        F.array(
            F.struct(F.lit("day").alias("period_type"), F.col("day").alias("points")),
            F.struct(F.lit("hour").alias("period_type"), F.col("hour").alias("points")),
        )
    )
    point = df.select(key, periods.alias("_p")).select(key, "_p.period_type", F.explode("_p.points").alias("_v"))
    at = lambda i: F.try_element_at("_v", F.lit(i + 1))
    return point.select(
        key,
        "period_type",
        epoch_utc(at(0)).alias("time"),
        at(1).alias("unique_visits"),
        at(2).alias("total_visits"),
    )


def mentions(df: DataFrame, text: str, pattern: str = MENTION_PATTERN, kind: str = "sidebar",
             page: Column | None = None, group: int = 1) -> DataFrame:
    """One row per mention in the text, lower-cased, tagged with where it was found."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)))
    name = page if page is not None else F.lit(None).cast("string")
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, name.alias("wiki_name"), found.alias("_m")).select(
        *kept, F.lower("_m").alias("related_subreddit"), F.lit(kind).alias("relationship_type"), "wiki_name"
    )


def wiki_pages(df: DataFrame, max_pages: int | None = None, key: str = "subreddit", content: str = "content") -> DataFrame:
    """Non-empty pages; with ``max_pages`` only of groups whose wiki has at most so many.

    The page count is an aggregation joined back, not a window, so a huge wiki is never
    gathered in one task only to be dropped.
    """
    if max_pages is None:
        return df.filter(F.length(content) > 0)
    small = df.groupBy(key).agg(F.count(F.lit(1)).alias("_pages")).filter(F.col("_pages") <= max_pages).select(key)
    return df.filter(F.length(content) > 0).join(small, key, "left_semi")


def with_pos(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """0-based position of every row in its group's ordered list."""
    return exact_rank(df, order, [group], "_rn").withColumn("pos", F.col("_rn") - 1).drop("_rn")
