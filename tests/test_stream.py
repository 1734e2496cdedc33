"""Streaming: the drained stream equals the batch result."""

import datetime as dt

from conftest import rows

from forumlens.operators import merge as mg
from forumlens.session import scratch_path
from forumlens.sources.store import Store
from forumlens.streaming import feed as st

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id int, text string, score int, scrape_mode string, timestamp timestamp_ntz, author_name string, day string"


def polls(spark):
    path = scratch_path(spark, "test-polls")
    batches = [
        [(i, f"t{i}", i, "profile", T0, f"u{i % 4}", f"d{i % 3}") for i in range(20)],
        [(i, None, 100 + i, "thread", T0 + dt.timedelta(1), None, f"d{i % 3}") for i in range(5, 25)],
        [(i, "late", 1, "profile", T0 + dt.timedelta(2), "u9", f"d{i % 3}") for i in range(30)],
    ]
    frames = [spark.createDataFrame(b, SCHEMA).coalesce(1) for b in batches]
    for frame in frames:
        frame.write.mode("append").parquet(path)
    return path, frames


def test_upsert_stream_equals_batches_and_is_idempotent(spark):
    path, frames = polls(spark)
    store = Store(spark, scratch_path(spark, "test-target"), frames[0].schema, "id")
    sdf = st.feed(spark, path, frames[0].schema, files_per_batch=1)
    st.upsert(sdf, store, scratch_path(spark, "test-state")).awaitTermination()
    want = frames[0].limit(0)
    for frame in frames:
        want = mg.merge_comments(want, frame)
    assert rows(store.read()) == rows(want)
    st.upsert_to(store)(frames[2], 2)
    assert rows(store.read()) == rows(want)


def test_upsert_batch_killed_before_it_is_published_is_repeated(spark, monkeypatch):
    path, frames = polls(spark)
    store = Store(spark, scratch_path(spark, "test-target"), frames[0].schema, "id")
    each = st.upsert_to(store)
    each(frames[0], 0)
    before = rows(store.read())

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", killed)
        try:
            each(frames[1], 1)
        except KeyboardInterrupt:
            pass
    assert rows(store.read()) == before
    each(frames[1], 1)
    assert rows(store.read()) == rows(mg.merge_comments(frames[0], frames[1]))


def test_upsert_leaves_other_files_alone(spark):
    path, frames = polls(spark)
    store = Store(spark, scratch_path(spark, "test-target"), frames[0].schema, "id", rows_per_file=5)
    st.upsert_to(store)(frames[0], 0)
    before = {r["file"] for r in store.files().collect()}
    st.upsert_to(store)(frames[1].filter("id = 7"), 1)
    after = {r["file"] for r in store.files().collect()}
    assert len(before) >= 3 and len(before - after) == 1 and store.read().count() == 20


def test_dedupe_into_a_store_is_exact_without_state(spark):
    path, frames = polls(spark)
    store = Store(spark, scratch_path(spark, "test-target"), frames[0].schema, "id", rows_per_file=5)
    state = scratch_path(spark, "test-state")
    sdf = st.feed(spark, path, frames[0].schema, files_per_batch=1)
    query = st.dedupe_into(sdf, store, state)
    query.awaitTermination()
    assert all(not p["stateOperators"] for p in query.recentProgress)
    got = {r["id"]: r["text"] for r in store.read().collect()}
    assert got == {**{i: f"t{i}" for i in range(20)}, **{i: None for i in range(20, 25)}, **{i: "late" for i in range(25, 30)}}
    assert store.read().count() == 30


def test_dedupe_totals_and_new_members(spark):
    path, frames = polls(spark)
    feed = lambda: st.feed(spark, path, frames[0].schema, files_per_batch=1)
    assert st.drain(st.dedupe(feed()), label="a").count() == 30
    assert rows(st.drain(st.totals(feed(), "scrape_mode"), "complete", "b")) == [("profile", 50), ("thread", 20)]
    users = spark.createDataFrame([("u1",)], "username string")
    assert rows(st.drain(st.new_members(feed(), users), label="c")) == [("u0",), ("u2",), ("u3",), ("u9",)]
