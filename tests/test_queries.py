"""Registered queries against their SQL, and the shape of their plans.

FORUMLENS_QUERIES=all checks every query; the default is a sample of each kind.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "scripts"))

import __spark_entry__ as entry_points
from check import canonical
from forumlens.workload import QUERIES as REGISTERED
from forumlens.workload import oracle_texts, runner
from forumlens.workload.views import BASE_TABLES, Tables

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "mg_all", "top_n_wide", "user_profile", "risk_by_comment_group", "not_in_null_aware", "merge_comments",
    "merge_subreddits", "award_dim", "traffic_rows", "batch_ids", "expand_related", "rescrape_threads",
    "tree_path", "term_freq_regex", "wilson_interval", "five_number", "ngram_df", "profile_similarity",
    "adjusted_rand", "complete_link_check", "stream_totals",
]
ALL = os.environ.get("FORUMLENS_QUERIES") == "all"
QUERIES, ORACLES = {n: runner(n) for n in REGISTERED}, oracle_texts()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in BASE_TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", list(QUERIES) if ALL else SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        assert got
        return
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == canonical(cursor.fetchall(), names)


def test_entry_runs(spark):
    assert entry_points.entry(spark).columns == ["subreddit", "count", "shadowban_count", "suspended_count", "bad_count"]


def test_entry_registers_all():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_only_cluster_k_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == {"cluster_k"}


@pytest.mark.parametrize("name", ["mg_all", "risk_by_comment_group", "user_profile", "merge_comments", "term_freq_surface",
                                  "dense_grid", "ngram_df", "group_ngram_counts", "jaccard", "round_robin"])
def test_plans_have_no_cross_join_and_no_row_udf(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan


def test_top_n_is_trimmed_before_the_shuffle(spark):
    plan = QUERIES["top_n_per_user"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_gram_queries_cover_the_whole_vocabulary(spark):
    grams = lambda name, *cols: {tuple(r) for r in QUERIES[name](spark, SF).select(*cols).collect()}
    whole = grams("ngram_vocab", "n", "gram")
    assert len(whole) == 7000
    assert grams("group_ngram_counts", "n", "gram") == whole
    assert grams("gram_share", "gram") == {(gram,) for _, gram in whole}


def test_membership_awards_and_profiles_are_whole(spark):
    t = Tables(spark, SF)
    pairs = lambda df, *cols: {tuple(r) for r in df.dropna(subset=list(cols)).select(*cols).collect()}
    whole = pairs(t.comments, "subreddit", "author_name")
    assert pairs(t.moderators, "subreddit", "username") == whole
    assert pairs(QUERIES["drop_bots"](spark, SF), "subreddit", "username") == {p for p in whole if p[1] not in ("u7", "u13")}
    awards = {(r["username"], r["award_name"]): r["award_count"] for r in QUERIES["upsert_award_counts"](spark, SF).collect()}
    for r in t.comments.filter("author_name IS NOT NULL").groupBy("author_name").agg({"gold": "sum", "silver": "sum"}).collect():
        assert (awards[r["author_name"], "gold"], awards[r["author_name"], "silver"]) == (r["sum(gold)"], r["sum(silver)"])
    for name in ("user_profile", "profile_incremental"):
        columns = QUERIES[name](spark, SF).columns
        first = [c for c in columns if c.startswith(("subreddit_1_", "domain_1_"))]
        assert first and all(c.replace("_1_", "_5_") in columns for c in first)
