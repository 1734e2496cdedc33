"""Queries that run as streams over the event feed until it is drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.session import scratch_path
from forumlens.sources.store import Store
from forumlens.streaming import feed as st
from forumlens.workload.registry import query


def event_feed(t, **kw):
    return st.feed(t.spark, t.sf_dir, t.events.schema, glob="events.parquet", **kw)


def polled(t, name: str = "polls"):
    """Feed files in which every poll repeats part of the poll before it."""
    path = scratch_path(t.spark, name)
    t.events.write.parquet(path)
    t.events.filter("event_type <> 'click'").write.mode("append").parquet(path)
    return st.feed(t.spark, path, t.events.schema, files_per_batch=4)


@query("stream_ingest", "SELECT * FROM events")
def stream_ingest(t):
    return st.drain(event_feed(t))


@query("stream_dedupe", "SELECT * FROM events")
def stream_dedupe(t):
    return st.drain(st.dedupe(polled(t), "event_id"))


@query("stream_dedupe_stored", "SELECT * FROM events")
def stream_dedupe_stored(t):
    """Exact however late a duplicate comes, without state: batches are compared with what is stored."""
    store = Store(t.spark, scratch_path(t.spark, "deduped"), t.events.schema, "event_id")
    st.dedupe_into(polled(t), store, scratch_path(t.spark, "dedupe-state")).awaitTermination()
    return store.read()


@query("stream_dedupe_horizon", "SELECT event_id, user_id, value FROM events")
def stream_dedupe_horizon(t):
    timed = polled(t).withColumn("at", F.col("ts").cast("timestamp"))
    return st.drain(st.dedupe(timed, "event_id", "at", "400 days").select("event_id", "user_id", "value"))


@query(
    "stream_upsert",
    """SELECT event_id AS id, event_type AS text,
      CASE WHEN event_type = 'click' THEN CAST(FLOOR(value) AS INT) ELSE CAST(FLOOR(value) AS INT) + 100 END AS score,
      CASE WHEN event_type = 'click' THEN 'profile' ELSE 'thread' END AS scrape_mode,
      CASE WHEN event_type = 'click' THEN ts ELSE ts + INTERVAL 1 DAY END AS timestamp, CAST(ts AS DATE) AS day FROM events""",
)
def stream_upsert(t):
    """First poll: profile records.  Second poll: thread records without text update some.

    Third poll: late profile records of known ids change nothing.
    """
    path = scratch_path(t.spark, "comment-polls")
    record = lambda df, text, bonus, mode, days: df.select(
        F.col("event_id").alias("id"), text.cast("string").alias("text"),
        (F.floor("value").cast("int") + bonus).alias("score"), F.lit(mode).alias("scrape_mode"),
        (F.col("ts") + F.make_dt_interval(F.lit(days))).alias("timestamp"), F.col("ts").cast("date").alias("day"),
    )
    first = record(t.events, F.col("event_type"), 0, "profile", 0)
    first.write.parquet(path)
    record(t.events.filter("event_type <> 'click'"), F.lit(None), 100, "thread", 1).write.mode("append").parquet(path)
    record(t.events, F.lit("late"), 500, "profile", 2).write.mode("append").parquet(path)
    store = Store(t.spark, scratch_path(t.spark, "comments"), first.schema, "id")
    # Files are read in the order they were written, so polls stay in order.
    records = st.feed(t.spark, path, first.schema, files_per_batch=1)
    st.upsert(records, store, scratch_path(t.spark, "upsert-state")).awaitTermination()
    return store.read()


@query("stream_totals", "SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type")
def stream_totals(t):
    return st.drain(st.totals(event_feed(t), "event_type"), mode="complete")


@query(
    "stream_new_members",
    """SELECT DISTINCT CONCAT('u', user_id) AS username FROM events
    WHERE CONCAT('u', user_id) NOT IN (SELECT username FROM users_t2)""",
)
def stream_new_members(t):
    named = polled(t).select(F.concat(F.lit("u"), "user_id").alias("author_name"))
    return st.drain(st.new_members(named, t.users_t2))
