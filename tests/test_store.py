"""Stored tables: batches rewrite only files that can hold their keys, and are seen whole or not at all."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from forumlens.operators import merge as mg
from forumlens.session import scratch_path
from forumlens.sources.store import Conflict, Store

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id string, score int, scrape_mode string, timestamp timestamp_ntz, tags map<string,int>"


def frame(spark, ids, score, mode="thread", days=0):
    return spark.createDataFrame([(i, score, mode, T0 + dt.timedelta(days), None) for i in ids], SCHEMA)


def store_of(spark, ids, **kw):
    first = frame(spark, ids, 1)
    store = Store(spark, scratch_path(spark, "store"), first.schema, "id", **{"rows_per_file": 100, **kw})
    store.append(first)
    return store, first


def plain(df):
    return rows(df.drop("tags"))


def names(store, version=None):
    return {r["file"] for r in store.files(version).collect()}


@pytest.mark.parametrize("batch_ids", [
    [f"k{i:04d}" for i in range(100, 130)], ["k0500", "new", None], [], [f"k{i:04d}" for i in range(0, 1200, 90)]])
def test_merge_gives_the_rows_of_the_plain_merge(spark, batch_ids):
    store, first = store_of(spark, [f"k{i:04d}" for i in range(1000)] + [None])
    batch = frame(spark, batch_ids, 2, days=1).unionAll(frame(spark, batch_ids[:2], 9, "profile", 2))
    store.merge(batch, mg.policy_comments())
    assert plain(store.read()) == plain(mg.merge_comments(first, batch))
    assert plain(store.read(1)) == plain(first)  # the older version is still there


def test_untouched_files_keep_their_names(spark):
    store, _ = store_of(spark, [f"k{i:04d}" for i in range(1000)])
    before = names(store)
    assert len(before) >= 8
    touched = {r["file"] for r in store.touched(frame(spark, ["k0100", "k0101"], 2)).collect()}
    store.merge(frame(spark, ["k0100", "k0101"], 2, days=1), mg.policy_comments())
    assert 1 <= len(touched) <= 2 and names(store) & before == before - touched


def test_filter_spares_files_whose_range_would_admit_a_key(spark):
    """Keys of even number in one lot, absent odd keys of the same range in the batch."""
    store, _ = store_of(spark, [f"k{i:04d}" for i in range(0, 2000, 2)])
    before = names(store)
    store.merge(frame(spark, [f"k{i:04d}" for i in range(1, 2000, 200)], 2), mg.policy_comments())
    assert len(names(store) & before) >= len(before) - 2
    assert store.read().count() == 1010


def test_files_hold_every_key_the_index_is_asked_for(spark):
    ids = [f"k{i:04d}" for i in range(1000)]
    store, _ = store_of(spark, ids, rows_per_file=70)
    where = {r["id"]: r["f"] for r in store.read().select("id", store._file().alias("f")).collect()}
    for part in (ids[::37], ids[5:9], ids):
        got = {r["file"] for r in store.touched(frame(spark, part, 2)).collect()}
        assert {where[i] for i in part} <= got


def test_one_lead_of_a_composite_key_is_split(spark):
    data = spark.range(1000).select(
        F.when(F.col("id") < 900, F.lit("hot")).otherwise(F.concat(F.lit("g"), "id")).alias("subreddit"),
        F.lit("day").alias("period_type"), F.col("id").alias("time"), F.lit(1).alias("seen"), F.lit(1).alias("n"))
    store = Store(spark, scratch_path(spark, "store"), data.schema, ["subreddit", "period_type", "time"], rows_per_file=100)
    store.append(data)
    assert store.files().agg(F.max("rows")).first()[0] < 400
    batch = data.filter("time % 300 = 7").withColumn("seen", F.lit(5)).withColumn("n", F.lit(2))
    store.merge(batch, mg.policy_always(), ts=None, ties=("n",))
    assert rows(store.read()) == rows(mg.merge_traffic(data, batch, ts=None, ties=("n",)))


def test_case_folds_and_history_appends(spark):
    data = spark.createDataFrame([(f"Group{i}", i, T0) for i in range(300)], "subreddit string, subscribers int, timestamp timestamp_ntz")
    batch = spark.createDataFrame([("GROUP7", 1000, T0 + dt.timedelta(1)), ("gnew", 1, T0)], data.schema)
    store = Store(spark, scratch_path(spark, "store"), data.schema, "subreddit", fold_case=True, rows_per_file=50)
    store.append(data)
    store.merge(batch, mg.policy_always())
    assert rows(store.read()) == rows(mg.merge_subreddits(data, batch))
    before = names(store)
    store.merge(batch, mg.policy_always(), history=True)
    assert before < names(store) and store.read().count() == 303


def test_batch_killed_before_publishing_leaves_the_table_and_can_be_repeated(spark, monkeypatch):
    store, first = store_of(spark, [f"k{i:04d}" for i in range(300)])
    batch = frame(spark, ["k0001", "new"], 5, days=1)
    want = plain(mg.merge_comments(first, batch))

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            store.merge(batch, mg.policy_comments(), writer="feed", batch_id=7)
    assert plain(store.read()) == plain(first) and store.committed("feed") is None
    version = store.merge(batch, mg.policy_comments(), writer="feed", batch_id=7)
    assert plain(store.read()) == want and store.committed("feed") == 7
    assert store.merge(frame(spark, ["k0002"], 99, days=5), mg.policy_comments(), writer="feed", batch_id=7) == version
    assert plain(store.read()) == want


def test_a_writer_that_loses_the_race_starts_from_the_newer_version(spark, monkeypatch):
    store, _ = store_of(spark, ["a", "b"])
    other = Store(spark, store.path, store.schema, "id")
    write, raced = Store._write, []

    def slow(self, new):
        out = write(self, new)
        if self is store and not raced:
            raced.append(other.merge(frame(spark, ["b", "c"], 2, days=1), mg.policy_comments()))
        return out

    monkeypatch.setattr(Store, "_write", slow)
    assert store.merge(frame(spark, ["c", "d"], 3, days=2), mg.policy_comments()) == raced[0] + 1
    assert sorted((r["id"], r["score"]) for r in store.read().collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 3)]
    with pytest.raises(Conflict):
        store._publish(0, store._manifest(1))


def test_expired_versions_take_only_their_own_files_along(spark):
    store, _ = store_of(spark, [f"k{i:04d}" for i in range(500)])
    for k in range(3):
        store.merge(frame(spark, [f"k{k:04d}"], 5 + k, days=1 + k), mg.policy_comments())
    want = plain(store.read())
    assert store.expire(keep=1) >= 3 and store.expire(keep=1) == 0
    assert plain(store.read()) == want and len(store.versions()) == 1


def test_insert_missing_and_empty_tables(spark):
    empty = frame(spark, [], 0)
    store = Store(spark, scratch_path(spark, "store"), empty.schema, "id")
    assert store.read().count() == 0 and store.versions() == []
    store.insert_missing(frame(spark, ["a", "a", None], 1))
    store.insert_missing(frame(spark, ["a", None, "b"], 2))
    assert sorted(((r["id"], r["score"]) for r in store.read().collect()), key=repr) == [("a", 1), ("b", 2), (None, 1)]
    store.merge(empty, mg.policy_comments(), writer="w", batch_id=0)
    assert store.read().count() == 3 and store.committed("w") == 0


def test_integer_keys_lie_in_their_own_order(spark):
    """As text, 100 to 999 lie between 10 and 99: a batch of them would reach files that hold none of its keys."""
    data = spark.range(-50, 950).select(F.col("id"), F.lit(1).alias("score"), F.lit("thread").alias("scrape_mode"),
                                        F.lit(T0).cast("timestamp_ntz").alias("timestamp"))
    store = Store(spark, scratch_path(spark, "store"), data.schema, "id", rows_per_file=100)
    store.append(data)
    spans = sorted((r["least"], r["most"], r["rows"]) for r in store.files().collect())
    assert len(spans) >= 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    ids = lambda *k: data.filter(F.col("id").isin(*k))
    lowest = min(store.files().collect(), key=lambda r: r["least"])
    assert [r["file"] for r in store.touched(ids(-50, -49)).collect()] == [lowest["file"]]


def test_files_without_admitted_rows_are_not_written_anew(spark):
    store, first = store_of(spark, [f"k{i:04d}" for i in range(1000)] + [None])
    before = names(store)
    refused = frame(spark, [f"k{i:04d}" for i in range(0, 1000, 10)], 2, "profile", 1)
    store.merge(refused.unionAll(frame(spark, ["new", "k0105"], 3, days=1)), mg.policy_comments())
    assert len(before - names(store)) == 1
    assert store.read().count() == 1002 and store.read().filter("score = 3").count() == 2
