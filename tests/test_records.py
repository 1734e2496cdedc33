"""Raw API records to typed rows, and into a merge."""

import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from forumlens.operators import merge as mg
from forumlens.operators import records as rec
from forumlens.sources.schemas import SCHEMAS

RAW_COMMENTS = [
    {"id": "c1", "author": {"name": "ann"}, "parent_id": "t3_x1", "is_root": True, "body": "a\u0000b", "created_utc": 86400.5, "edited": False,
     "gilded": 2, "gildings": {"gid_1": 3}, "stickied": False, "score": 5, "distinguished": "moderator", "link_id": "t3_x1",
     "subreddit": {"display_name": "Pics"}, "controversiality": 1, "locked": True, "is_submitter": False, "seen_utc": 172800,
     "all_awardings": [{"name": "Helpful", "subreddit_id": None, "count": 2}, {"name": "Own", "subreddit_id": "s1", "count": 1}]},
    {"id": "c2", "author": None, "parent_id": "t1_c1", "is_root": False, "body": None, "created_utc": 0, "edited": 90000.0,
     "gilded": 0, "gildings": {}, "score": -1, "distinguished": None, "link_id": "t3_x1", "subreddit": {"display_name": "Pics"}, "seen_utc": 172800},
]
COMMENTS = ("id string, author struct<name:string>, parent_id string, is_root boolean, body string, created_utc double, edited string, gilded int, "
            "gildings map<string,int>, stickied boolean, score int, distinguished string, link_id string, subreddit struct<display_name:string>, "
            "controversiality int, locked boolean, is_submitter boolean, seen_utc double, all_awardings array<struct<name:string,subreddit_id:string,count:int>>")


def raw(spark, records, schema):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "j string").select(F.from_json("j", schema).alias("r")).select("r.*")


def test_comment_records_become_rows_of_the_stored_schema_and_merge(spark):
    got = rec.comment_rows(raw(spark, RAW_COMMENTS, COMMENTS), "thread", "-05:00")
    assert got.schema.simpleString() == SCHEMAS["comments"].simpleString()
    a, b = sorted(got.collect(), key=lambda r: r["id"])
    t = lambda s, ms=0: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s, microseconds=ms)
    assert (a["author_name"], a["text"], a["thread_id"], a["parent_id"]) == ("ann", "a <NULL_CHARACTER_REPLACEMENT> b", "x1", "t3_x1")
    assert (a["created_utc"], a["created"], a["timestamp_utc"]) == (t(86400, 500000), t(68400, 500000), t(172800))
    assert (a["edited"], a["edited_utc"], b["edited"], b["edited_utc"]) == (None, None, t(72000), t(90000))
    assert (a["gold"], a["silver"], a["platinum"], b["silver"]) == (2, 3, 0, 0)
    assert (a["is_distinguished"], b["is_distinguished"], a["is_locked"], b["is_locked"]) == (True, False, True, None)
    assert (b["author_name"], b["text"], a["absolute_position"], a["author_id"], a["scrape_mode"]) == (None, None, None, None, "thread")
    assert mg.merge_comments(got.limit(0), got).count() == 2
    later = rec.comment_rows(raw(spark, [{**RAW_COMMENTS[1], "score": 9, "seen_utc": 200000}], COMMENTS), "thread", "-05:00")
    assert {r["id"]: r["score"] for r in mg.merge_comments(got, later).collect()} == {"c1": 5, "c2": 9}
    assert rows(rec.award_rows(raw(spark, RAW_COMMENTS, COMMENTS), "comment_id")) == [("c1", "Helpful", None, 2), ("c1", "Own", "s1", 1)]


def test_records_that_lack_fields_give_nulls(spark):
    bare = spark.createDataFrame([("x1", 12.0, 99.0)], "id string, created_utc double, seen_utc double")
    thread = rec.thread_rows(bare, "minimal").first()
    assert (thread["id"], thread["title"], thread["percentage"], thread["silver"], thread["is_distinguished"]) == ("x1", None, None, 0, False)
    assert rec.group_rows(bare).first()["rules"] is None
    assert rec.user_rows(bare).first()["comments_gold"] is None


def test_thread_ratio_is_kept_from_full_records_only(spark):
    one = spark.createDataFrame([("x1", 0.75, 1.0, 2.0)], "id string, upvote_ratio double, created_utc double, seen_utc double")
    assert [rec.thread_rows(one, m).first()["percentage"] for m in ("thread", "list")] == [0.75, None]
    assert rec.thread_rows(one, "list", ratio=True).first()["percentage"] == 0.75


def test_user_records_sum_the_gildings_of_their_items(spark):
    users = spark.createDataFrame([("ann", "i1", 5, 7, 10.0, 20.0), ("bob", "i2", 1, 2, 10.0, 20.0)],
                                  "name string, id string, comment_karma int, link_karma int, created_utc double, seen_utc double")
    items = spark.createDataFrame([("ann", "comments", {"gid_1": 2, "gid_2": 1}), ("ann", "comments", {"gid_1": 1}), ("ann", "submissions", {"gid_3": 4})],
                                  "name string, kind string, gildings map<string,int>")
    got = {r["username"]: r for r in rec.user_rows(users, gilded=items).collect()}
    assert (got["ann"]["comments_silver"], got["ann"]["comments_gold"], got["ann"]["submissions_platinum"], got["ann"]["post_karma"]) == (3, 1, 4, 7)
    assert (got["bob"]["comments_silver"], got["bob"]["gilded_visible"]) == (0, True)


def test_group_records_keep_rules_as_json(spark):
    groups = spark.createDataFrame([("Pics", 10, [("be kind", 1)], 10.0, 20.0)],
                                   "display_name string, subscribers int, rules array<struct<name:string,n:int>>, created_utc double, seen_utc double")
    got = rec.group_rows(groups).first()
    assert (got["subreddit"], got["subscribers"], json.loads(got["rules"])) == ("Pics", 10, [{"name": "be kind", "n": 1}])
