"""Selection, ranking, merge, sources, statistics and profile."""

import datetime as dt
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from forumlens.operators import merge as mg
from forumlens.operators import normalize as nz
from forumlens.operators import ranking as rk
from forumlens.operators import select as sel
from forumlens.operators import stats
from forumlens.plans import profile as prof
from forumlens.plans import risk
from forumlens.sources import files
from forumlens.sources.schemas import KEYS, SCHEMAS
from forumlens.workload.views import Tables

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2020, 1, 1)


# ---- ranking --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one group; some groups are NULL."""
    rng = random.Random(5)
    data = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"g{rng.randrange(40)}", rng.randrange(500), i)
            for i in range(3000)]
    return data, spark.createDataFrame(data, "g string, v int, id int").repartition(5)


def test_exact_rank_matches_brute_force_with_a_hot_group(skewed):
    data, df = skewed
    want, seen = {}, {}
    for g, v, i in sorted(data, key=lambda r: (str(r[0]), -r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    got = rk.exact_rank(df, [F.col("v").desc(), F.col("id")], ["g"])
    assert {r["id"]: r["rn"] for r in got.collect()} == want


def test_exact_rank_without_groups_is_a_total_numbering(skewed):
    _, df = skewed
    got = rk.exact_rank(df, [F.col("id")]).orderBy("id").select("rn").collect()
    assert [r[0] for r in got] == list(range(1, 3001))


def test_large_and_small_limits_agree(skewed):
    _, df = skewed
    order = [F.col("v"), F.col("id")]
    small = rows(rk.top_per_group(df, "g", order, 7))
    big = rk.top_per_group(df, "g", order, rk.WINDOW_LIMIT + 1).filter("rn <= 7")
    assert rows(big) == small


def test_ordinal_shares_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)], "k string, v double")
    assert rows(rk.ordinal(df, "k", F.col("v")).select("k", "ordinal")) == [("a", 2), ("b", 1), ("c", 1), ("d", None)]


# ---- selection ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "listed,want", [([], ["a", None]), (["b"], ["a"]), (["b", None], []), (["a"], []), ([None], [])]
)
def test_not_in_follows_sql_null_rules(spark, listed, want):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    lst = spark.createDataFrame([(v,) for v in listed], "y string")
    assert sorted((r[0] for r in sel.not_in(df, "x", lst).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("listed,count", [([], 3), (["random"], 3), (["random", "randnsfw"], 3), (["g1"], 2), (["no"], 0)])
def test_in_list(spark, listed, count):
    df = spark.createDataFrame([("g1",), ("g1",), ("g2",)], "g string")
    assert sel.in_list(df, "g", spark.createDataFrame([(v,) for v in listed], "n string")).count() == count


def test_groups_min_is_strict_by_default(spark):
    c = spark.createDataFrame([("a",), ("a",), ("b",)], "subreddit string")
    t = spark.createDataFrame([("b",), ("b",)], "subreddit string")
    assert rows(sel.groups_min(c, t, 2)) == [("b",)]
    assert rows(sel.groups_min(c, t, 2, strict=False)) == [("a",), ("b",)]


def test_batches_and_turns(skewed):
    _, df = skewed
    sizes = sel.batches(df.select("id"), 100).groupBy("batch").count().collect()
    assert len(sizes) == 30 and {r["count"] for r in sizes} == {100}
    turns = [(r["turn"], r["g"]) for r in sel.interleave(df.dropna(), "g", [F.col("id")], 5).collect()]
    assert turns == sorted(turns) and max(t for t, _ in turns) == 5


def test_shuffle_is_a_stable_permutation(skewed):
    _, df = skewed
    one = [r["id"] for r in sel.shuffle(df, 1).collect()]
    assert one == [r["id"] for r in sel.shuffle(df.repartition(3), 1).collect()]
    assert one != [r["id"] for r in sel.shuffle(df, 2).collect()] and sorted(one) == list(range(3000))


def test_stale(spark):
    users = spark.createDataFrame([("old", T0), ("new", T0 + 9 * DAY)], "username string, timestamp timestamp_ntz")
    wanted = spark.createDataFrame([("old",), ("new",), ("none",)], "username string")
    assert rows(sel.stale(wanted, users, 5, T0 + 10 * DAY)) == [("none",), ("old",)]
    assert rows(sel.stale(wanted, users, -1, T0 + 10 * DAY)) == [("none",)]


def test_resample_waits(spark):
    u1 = spark.createDataFrame([("a", T0), ("b", T0 + 8 * DAY), ("c", T0 - 90 * DAY), ("d", T0)],
                               "username string, timestamp timestamp_ntz")
    u2 = spark.createDataFrame([("d",)], "username string")
    got = [(r[0], r[2]) for r in sel.resample(u1, u2, 5, 30, T0 + 10 * DAY).collect()]
    assert got == [("a", 0.0), ("b", 3 * 86400.0)]


def test_k_hop_with_cycle_exclusion_and_size(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "x"), ("c", "d"), ("b", "tiny")],
                                  "subreddit string, related_subreddit string")
    seeds = spark.createDataFrame([("a",)], "s string")
    sizes = spark.createDataFrame([(g, 1 if g == "tiny" else 50) for g in ("a", "b", "c", "d", "x", "tiny")],
                                  "subreddit string, subscribers int")
    got = sel.k_hop(edges, seeds, 2, spark.createDataFrame([("x",)], "s string"), sizes, 10, 100)
    assert rows(got) == [("a", 0), ("b", 1), ("c", 2)]


# ---- merge ----------------------------------------------------------------------------------------

USERS = "username string, karma int, timestamp timestamp_ntz"


@pytest.mark.parametrize("days,karma", [(3, 1), (8, 2)])
def test_merge_users_respects_delay(spark, days, karma):
    old = spark.createDataFrame([("u", 1, T0)], USERS)
    new = spark.createDataFrame([("u", 2, T0 + days * DAY), ("v", 5, T0)], USERS)
    got = {r["username"]: r["karma"] for r in mg.merge_users(old, new, delay=7).collect()}
    assert got == {"u": karma, "v": 5}
    assert {r["username"]: r["karma"] for r in mg.merge_users(old, new, delay=-1).collect()} == {"u": 1, "v": 5}
    assert mg.merge_users(old, new, delay=7, history=True).count() == 2 + (days == 8)


COMMENTS = "id int, text string, score int, scrape_mode string, timestamp timestamp_ntz"


def test_merge_comments_policy_patch_and_idempotence(spark):
    old = spark.createDataFrame([(1, "x", 1, "profile", T0), (2, "y", 1, "profile", T0)], COMMENTS)
    new = spark.createDataFrame(
        [(1, None, 7, "thread", T0 + DAY), (1, None, None, "thread", T0 + 2 * DAY), (2, "no", 9, "profile", T0 + DAY),
         (3, "z", 3, "profile", T0), (3, "zz", None, "profile", T0 + DAY)], COMMENTS)
    once = mg.merge_comments(old, new)
    assert {r["id"]: (r["text"], r["score"]) for r in once.collect()} == {1: ("x", 7), 2: ("y", 1), 3: ("zz", 3)}
    assert rows(mg.merge_comments(once, new)) == rows(once)
    assert mg.merge_comments(old, new, history=True).count() == 7


def test_merge_threads_table(spark):
    old = spark.createDataFrame([(1, "x", 1, "thread", T0), (2, "y", 1, "thread", T0)], COMMENTS)
    new = spark.createDataFrame([(1, "a", 2, "thread", T0), (2, "b", 2, "list", T0 + 30 * DAY)], COMMENTS)
    got = {r["id"]: r["text"] for r in mg.merge_threads(old, new, delay=5).collect()}
    assert got == {1: "a", 2: "y"}
    assert mg.merge_threads(old, new, delay=5, history=True).count() == 4
    assert mg.merge_threads(old, new, delay=60, history=True).count() == 3


def test_merge_accepts_one_lineage(spark):
    df = spark.createDataFrame([("u", 1, T0)], USERS)
    assert rows(mg.patch(df.filter("karma = 1"), df, "username")) == rows(df)
    assert mg.append_missing(df, df.filter("karma = 1"), "username").count() == 1


def test_merge_groups_ignores_case(spark):
    old = spark.createDataFrame([("News", 1, T0)], "subreddit string, n int, timestamp timestamp_ntz")
    new = spark.createDataFrame([("news", 4, T0), ("Art", 2, T0)], old.schema)
    assert {(r[0], r[1]) for r in mg.merge_subreddits(old, new).collect()} == {("News", 4), ("Art", 2)}


def test_award_dim_treats_null_scope_as_a_value(spark):
    dim = spark.createDataFrame([("gold", None)], "name string, subreddit_id string")
    new = spark.createDataFrame([("gold", None), ("gold", "g1"), ("gold", "g1")], dim.schema)
    assert rows(nz.new_awards(new, dim)) == [("gold", "g1")]


def test_history_latest(spark):
    h = spark.createDataFrame([("u", 1, T0), ("u", 2, T0 + DAY), ("v", 3, None)], USERS)
    assert {r["username"]: r["karma"] for r in rk.latest(h, "username").collect()} == {"u": 2, "v": 3}


# ---- sources ------------------------------------------------------------------------------------------


def test_read_list(spark, tmp_path):
    (tmp_path / "names.txt").write_text("a\n\n   \n" + "x" * 35 + "\n  b \n" + "y" * 29 + "\n" + "z" * 30 + "\n")
    assert rows(files.read_list(spark, str(tmp_path / "names.txt"), limit=30)) == [("a",), ("b",), ("y" * 29,)]


def test_csv_round_trip_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a, "b"', 1), ("line\\x", 2)], "n string, k int")
    files.export_csv(df, str(tmp_path / "csv"))
    assert rows(files.load_csv(spark, str(tmp_path / "csv"), "n string, k int")) == rows(df)


def test_materialize_modes(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    assert files.materialize(one, "t", path=str(tmp_path)).count() == 1
    assert files.materialize(two, "t", path=str(tmp_path)).count() == 1
    assert files.materialize(two, "t", "overwrite", str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.materialize(one, "t", "error", str(tmp_path))


def test_load_fills_columns_an_old_file_lacks(spark, tmp_path):
    spark.createDataFrame([("u", "i")], "username string, id string").write.parquet(str(tmp_path / "users"))
    got = files.load(spark, str(tmp_path / "users"), "users")
    assert got.schema == SCHEMAS["users"] and got.first()["awarder_karma"] is None


def test_every_key_is_a_declared_column():
    assert all(set(key) <= set(SCHEMAS[name].names) for name, key in KEYS.items())


# ---- statistics, profile, risk ------------------------------------------------------------------------


def test_score_bands_differ_between_summary_and_profile(spark):
    df = spark.createDataFrame([("g", "u", s, 0, "ab", T0) for s in (0, 1, 2)],
                               "subreddit string, author_name string, score int, gold int, text string, created timestamp_ntz")
    s = stats.member_group(df).first()
    assert (s["pos_count"], s["neg_count"], s["neg_sum"]) == (2, 1, 0)
    p = prof.ug_comments(df).first()
    assert (p["total_negative_comments"], p["total_positive_comments"], p["average_comment_length"]) == (1, 1, 2.0)


def test_flags_of_users_gone_by_snapshot_two(spark):
    df = spark.createDataFrame([(None, None), (1, 0), (0, 0)], "shadowban_flag int, suspended_flag int")
    assert [r[0] for r in df.select(prof.bad_flag()).collect()] == [0, 1, 0]


def test_risk_counts_unmatched_members_but_adds_null(spark):
    activity = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "b"), ("g", None)], "subreddit string, author_name string")
    u1 = spark.createDataFrame([("a", "1"), ("b", "2"), ("z", None)], "username string, id string")
    u2 = spark.createDataFrame([("a", None, T0, None)],
                               "username string, id string, shadowbanned_by_date timestamp_ntz, suspended_by_date timestamp_ntz")
    got = {r[0]: tuple(r)[1:] for r in risk.risk(activity, u1, u2, n=5, min_count=1).collect()}
    assert got == {"g": (2, 1, 0, 1), "h": (1, None, None, None)}


def test_csv_round_trip_keeps_blanks_breaks_and_empties(spark, tmp_path):
    data = [(1, ""), (2, None), (3, " pad "), (4, "two\nlines"), (5, 'a "quote", comma'), (6, "\\N x")]
    df = spark.createDataFrame(data, "id int, text string")
    files.export_csv(df, str(tmp_path / "out"))
    assert rows(files.load_csv(spark, str(tmp_path / "out"), df.schema)) == sorted(data, key=repr)


def test_insert_or_ignore_keeps_the_first_in_order(spark):
    from forumlens.operators.merge import append_missing

    new = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 9, "a"), (2, 1, "c")], "id int, at int, v string")
    target = new.limit(0)
    for parts in (1, 2, 4):
        got = append_missing(target, new.repartition(parts), "id", [F.col("at")])
        assert rows(got) == [(1, 3, "z"), (2, 1, "c")]


def test_profile_deals_each_activity_table_by_member_once(spark):
    users = spark.createDataFrame(
        [(f"u{k}", f"i{k}", 1, 1, False, False, T0, None, None, *[0] * 6, T0) for k in range(9)],
        "username string, id string, comment_karma int, post_karma int, is_mod boolean, is_gold boolean, account_created timestamp_ntz, "
        "shadowbanned_by_date timestamp_ntz, suspended_by_date timestamp_ntz, " + ", ".join(f"{g} int" for g in prof.GILDINGS) + ", timestamp timestamp_ntz")
    rows_ = [(f"u{k % 9}", f"g{k % 5}", f"d{k % 3}", k % 7, 0, 0, 0, "x" * (k % 4), T0) for k in range(200)]
    acts = spark.createDataFrame(rows_, "author_name string, subreddit string, domain string, score int, gold int, silver int, platinum int, text string, created timestamp_ntz")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prof.profile(users, users, acts, acts)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 4  # two snapshots, two activity tables
        got = {r["username"]: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    mine = [r for r in rows_ if r[0] == "u0"]
    by_group = sorted(((-sum(r[1] == g for r in mine), g) for g in {r[1] for r in mine}))
    by_domain = sorted(((-sum(r[2] == d for r in mine), d) for d in {r[2] for r in mine}))
    assert (got["u0"]["comment_count"], got["u0"]["total_thread_score"]) == (len(mine), sum(r[3] for r in mine))
    assert [(-got["u0"][f"subreddit_{k}_comment_count"], got["u0"][f"subreddit_{k}_comments"]) for k in (1, 2, 3)] == by_group[:3]
    assert [(-got["u0"][f"domain_{k}_thread_count"], got["u0"][f"domain_{k}"]) for k in range(1, len(by_domain) + 1)] == by_domain


def test_profile_tasks_grow_with_the_summaries(spark, monkeypatch):
    """Memory of a task is bounded by the rows dealt to it, not by the shuffle partitions that happen to be set."""
    t = Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(prof, "MEMBER_ROWS", 100)
    plan = prof.profile(t.users_t1, t.users_t2, t.comments, t.threads)._jdf.queryExecution().executedPlan().toString()
    tasks = [int(n) for n in re.findall(r"hashpartitioning\(username#\d+, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert tasks and min(tasks) > 20
