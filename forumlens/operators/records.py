"""Whole raw records (nested, as an API returns them) to typed rows that the merges take.

A mapping says for each stored column where its value comes from; what a record lacks is NULL, so records of
older and newer sources go through the same mapping.  The row has exactly the entity's stored columns and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions.scalars import bare_id, edited, epoch_pair, flag, map_get, rules_json, scrub
from forumlens.operators.normalize import sum_maps
from forumlens.sources.schemas import SCHEMAS

Field = Callable[[str], Column]


def has(schema: T.DataType, path: str) -> bool:
    """Whether a dotted path leads somewhere in a schema."""
    for name in path.split("."):
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return False
        schema = schema[name].dataType
    return True


def field_of(raw: DataFrame) -> Field:
    """Reads a dotted path, NULL where the records have none."""
    return lambda path: F.col(path) if has(raw.schema, path) else F.lit(None)


def _plain(get: Field, names: str) -> dict[str, Column]:
    """Columns stored as they come: ``name`` or ``stored=raw``."""
    pairs = [(n.split("=") * 2)[:2] if "=" not in n else n.split("=") for n in names.split()]
    return {stored: get(raw) for stored, raw in pairs}


def _stamped(name: str, seconds: Column, zone: str) -> dict[str, Column]:
    local, utc = epoch_pair(seconds.cast("decimal(18,6)"), zone, name)
    return {name: local, f"{name}_utc": utc}


def _edited(get: Field, zone: str) -> dict[str, Column]:
    """A false or missing edit mark is no edit; sources write it as false, 0 or a time."""
    seconds = get("edited").cast("string").try_cast("decimal(18,6)")
    utc = edited(seconds)
    return {"edited": F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "edited_utc": utc}


def _metals(get: Field, known: bool) -> dict[str, Column]:
    gildings = get("gildings").cast("map<string,int>")
    zero = lambda key: map_get(gildings, key) if known else F.lit(0)
    return {"gold": get("gilded"), "silver": zero("gid_1"), "platinum": zero("gid_3")}


def _text(value: Column) -> Column:
    return scrub(value.cast("string"))


# Stored columns that keep the raw name, and those that have another one.
THREAD_PLAIN = (
    "id score author_flair_css_class link_flair_text link_flair_css_class url permalink domain num_comments num_duplicates "
    "num_crossposts is_self is_video is_original_content is_reddit_media_domain is_robot_indexable is_meta is_crosspostable "
    "locked archived contest_mode over_18 author_flair=author_flair_text is_spoiler=spoiler is_stickied=stickied is_pinned=pinned "
    "subreddit=subreddit.display_name author_name=author.name")
COMMENT_PLAIN = (
    "id parent_id score controversiality is_root is_submitter is_stickied=stickied is_locked=locked "
    "subreddit=subreddit.display_name author_name=author.name")
USER_PLAIN = (
    "id comment_karma is_mod is_gold is_employee awarder_karma awardee_karma verified username=name post_karma=link_karma")
GROUP_PLAIN = (
    "accounts_active description submit_text submit_link_label subreddit_type subscribers title public_traffic "
    "subreddit=display_name has_wiki=wiki_enabled")


def _row(raw: DataFrame, entity: str, columns: dict[str, Column]) -> DataFrame:
    return raw.select(*(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[entity].fields))


def thread_rows(raw: DataFrame, mode: str, zone: str = "UTC", seen: str = "seen_utc", ratio: bool | None = None) -> DataFrame:
    """Stored thread rows.  The vote ratio is kept from full records, or always or never if asked."""
    get = field_of(raw)
    ratio = mode == "thread" if ratio is None else ratio
    return _row(raw, "threads", {
        **_plain(get, THREAD_PLAIN), **_edited(get, zone), **_stamped("created", get("created_utc"), zone),
        **_stamped("timestamp", get(seen), zone), **_metals(get, has(raw.schema, "gildings")),
        "title": _text(get("title")), "self_text": _text(get("selftext")), "self_text_html": _text(get("selftext_html")),
        "is_distinguished": flag(get("distinguished")), "scrape_mode": F.lit(mode),
        "percentage": get("upvote_ratio") if ratio else F.lit(None)})


def comment_rows(raw: DataFrame, mode: str, zone: str = "UTC", seen: str = "seen_utc") -> DataFrame:
    """Stored comment rows; place, replies and author id are filled in by later steps."""
    get = field_of(raw)
    return _row(raw, "comments", {
        **_plain(get, COMMENT_PLAIN), **_edited(get, zone), **_stamped("created", get("created_utc"), zone),
        **_stamped("timestamp", get(seen), zone), **_metals(get, has(raw.schema, "gildings")),
        "text": _text(get("body")), "thread_id": bare_id(get("link_id").cast("string")),
        "is_distinguished": flag(get("distinguished")), "scrape_mode": F.lit(mode)})


def user_rows(raw: DataFrame, zone: str = "UTC", seen: str = "seen_utc", gilded: DataFrame | None = None) -> DataFrame:
    """Stored user rows.  ``gilded``: (name, kind 'comments' or 'submissions', gildings map) of the users' gilded items; with it
    every user's counts are known (0 where nothing was found), without it they are NULL."""
    get = field_of(raw)
    counts: dict[str, Column] = {}
    if gilded is not None:
        metals = ("silver", "gold", "platinum")
        summed = sum_maps(gilded, ["name", "kind"], "gildings")
        kinds = ("submissions", "comments")
        wide = summed.groupBy(F.col("name").alias("_name")).agg(
            *(F.max(F.when(F.col("kind") == k, F.col(m))).alias(f"_{k}_{m}") for k in kinds for m in metals))
        raw = raw.join(wide, F.col("name") == F.col("_name"), "left")
        counts = {f"{k}_{m}": F.coalesce(f"_{k}_{m}", F.lit(0)) for k in kinds for m in metals} | {"gilded_visible": F.lit(True)}
    return _row(raw, "users", {
        **_plain(get, USER_PLAIN), **_stamped("account_created", get("created_utc"), zone), **_stamped("timestamp", get(seen), zone), **counts})


def group_rows(raw: DataFrame, zone: str = "UTC", seen: str = "seen_utc") -> DataFrame:
    """Stored community rows; the rules are kept as JSON text."""
    get = field_of(raw)
    rules = rules_json("rules") if has(raw.schema, "rules") else F.lit(None)
    return _row(raw, "subreddits", {
        **_plain(get, GROUP_PLAIN), "rules": rules, **_stamped("created", get("created_utc"), zone), **_stamped("timestamp", get(seen), zone)})


def award_rows(raw: DataFrame, owner: str) -> DataFrame:
    """(owner, award_name, subreddit_id, award_count) of all records, for ``upsert_award_counts``."""
    return raw.select(F.col("id").alias(owner), F.inline(F.transform("all_awardings", lambda a: F.struct(
        a["name"].alias("award_name"), a["subreddit_id"].alias("subreddit_id"), a["count"].cast("int").alias("award_count")))))
