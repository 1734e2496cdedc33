"""Schemas of the stored entities (superset of what older snapshots hold)."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, BIG, DBL, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TIME, SHORT = T.TimestampNTZType(), T.ShortType()


def fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(n, kind, True) for n in names.split()]


def stamped(names: str) -> list[T.StructField]:
    """A local time column and its ``_utc`` twin for every name."""
    return fields(TIME, " ".join(f"{n} {n}_utc" for n in names.split()))


# Entity, columns by type.
SCHEMAS: dict[str, T.StructType] = {
    "threads": T.StructType(
        fields(STR, "id title subreddit subreddit_id author_name author_id author_flair author_flair_css_class "
                    "link_flair_text link_flair_css_class url self_text permalink self_text_html domain scrape_mode")
        + stamped("created edited timestamp")
        + fields(INT, "score gold silver platinum num_comments comments_deleted comments_navigated "
                      "num_duplicates num_crossposts")
        + fields(DBL, "percentage")
        + fields(BOOL, "is_distinguished is_spoiler is_self is_stickied is_pinned over_18 in_contest_mode is_video "
                       "is_original_content is_reddit_media_domain is_robot_indexable is_meta is_crosspostable "
                       "locked archived contest_mode")
    ),
    "comments": T.StructType(
        fields(STR, "id author_name author_id parent_id text thread_id subreddit subreddit_id scrape_mode")
        + stamped("created edited timestamp")
        + fields(TIME, "thread_begin_timestamp")
        + fields(INT, "gold silver platinum score nreplies")
        + fields(SHORT, "controversiality")
        + fields(BOOL, "is_root is_stickied is_distinguished is_locked is_submitter")
        + [T.StructField("absolute_position", T.ArrayType(INT), True)]
    ),
    "users": T.StructType(
        fields(STR, "username id")
        + fields(INT, "comment_karma post_karma awarder_karma awardee_karma submissions_silver submissions_gold "
                      "submissions_platinum comments_silver comments_gold comments_platinum")
        + stamped("account_created shadowbanned_by_date suspended_by_date timestamp")
        + fields(TIME, "deleted_by_date")
        + fields(BOOL, "is_mod is_gold is_employee verified gilded_visible")
    ),
    "subreddits": T.StructType(
        fields(STR, "subreddit description rules submit_text submit_link_label subreddit_type title")
        + fields(INT, "accounts_active subscribers")
        + fields(BOOL, "has_wiki public_traffic")
        + stamped("created timestamp")
    ),
    "moderators": T.StructType(fields(STR, "subreddit username") + fields(INT, "pos") + fields(TIME, "timestamp")),
    "traffic": T.StructType(
        fields(STR, "subreddit period_type") + stamped("time timestamp") + fields(INT, "total_visits unique_visits")
    ),
    "related_subreddits": T.StructType(
        fields(STR, "subreddit related_subreddit relationship_type wiki_name")
        + fields(BOOL, "related_is_private") + stamped("timestamp")
    ),
    "wikis": T.StructType(fields(STR, "subreddit content name") + stamped("timestamp")),
    "awards": T.StructType(
        fields(STR, "name description award_type award_sub_type subreddit_id static_icon_url")
        + fields(INT, "coin_price coin_reward giver_coin_reward subreddit_coin_reward days_of_premium "
                      "awardings_required_to_grant_benefits days_of_drip_extension")
    ),
    "user_awards": T.StructType(fields(STR, "username award_name subreddit_id") + fields(INT, "award_count")),
    "thread_awards": T.StructType(fields(STR, "thread_id award_name subreddit_id") + fields(INT, "award_count")),
    "comment_awards": T.StructType(fields(STR, "comment_id award_name subreddit_id") + fields(INT, "award_count")),
    "trophies": T.StructType(fields(STR, "trophy_name username") + stamped("granted_at")),
}

KEYS: dict[str, list[str]] = {
    "threads": ["id"],
    "users": ["username"],
    "comments": ["id"],
    "subreddits": ["subreddit"],
    "traffic": ["subreddit", "period_type", "time"],
    "awards": ["name", "subreddit_id"],
    "user_awards": ["username", "award_name"],
    "thread_awards": ["thread_id", "award_name"],
    "comment_awards": ["comment_id", "award_name"],
    "trophies": ["trophy_name", "username"],
}
