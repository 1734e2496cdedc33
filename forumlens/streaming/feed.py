"""Comment feed as Structured Streaming: ingest, dedupe, upsert, totals, new members."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from forumlens.operators.merge import Policy, policy_comments
from forumlens.session import scratch_path
from forumlens.sources.store import Store


def feed(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
         glob: str | None = None) -> DataFrame:
    """Endless source of record files that appear under ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def dedupe(sdf: DataFrame, key: str = "id", ts: str | None = None, horizon: str | None = None) -> DataFrame:
    """Drop ids already seen.

    With a horizon the remembered ids are bounded: duplicates further apart than it may
    pass.  Without one every id is remembered for good; ``dedupe_into`` does that without state.
    """
    if horizon is None:
        return sdf.dropDuplicates([key])
    return sdf.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def run(sdf: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
        poll: str | None = None) -> StreamingQuery:
    """Start a stream that hands every micro-batch to ``each``.

    ``poll`` keeps it running at that interval; without it everything available is
    processed and the stream ends.
    """
    writer = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return writer.trigger(**trigger).start()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch under its own id: a repeated batch replaces itself."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def upsert_to(store: Store, policy: Policy | None = None, ts: str = "timestamp", ties: tuple[str, ...] = (),
              writer: str = "feed") -> Callable[[DataFrame, int], None]:
    """Merge each batch into a store, rewriting only the files that can hold its keys.

    The manifest that names the new files carries the batch's number and is published last, so a driver lost at any
    point leaves the old rows in sight, and a batch that is repeated after it was published changes nothing.
    """
    rule = policy or policy_comments()

    def each(batch: DataFrame, batch_id: int) -> None:
        store.merge(batch.select(store.schema.names), rule, ts, ties, writer=writer, batch_id=batch_id)

    return each


def upsert(sdf: DataFrame, store: Store, checkpoint: str, poll: str | None = None, **kw) -> StreamingQuery:
    return run(sdf, upsert_to(store, **kw), checkpoint, poll=poll)


def insert_new_to(store: Store, writer: str = "feed") -> Callable[[DataFrame, int], None]:
    """Exact deduplication without state: each batch adds the rows whose key the store does not hold yet.

    Stored keys are looked up in the files whose key range and filter admit a key of the batch.  Memory holds one batch
    however long the stream runs, and a duplicate is dropped however late it comes.
    """
    return lambda batch, batch_id: store.insert_missing(batch.select(store.schema.names), writer=writer, batch_id=batch_id)


def dedupe_into(sdf: DataFrame, store: Store, checkpoint: str, poll: str | None = None) -> StreamingQuery:
    return run(sdf, insert_new_to(store), checkpoint, poll=poll)


def totals(sdf: DataFrame, *by: str) -> DataFrame:
    """Running number of processed records."""
    return sdf.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def new_members(sdf: DataFrame, users: DataFrame, member: str = "author_name") -> DataFrame:
    """Members of the feed that are no stored users, each reported once."""
    named = sdf.filter(F.col(member).isNotNull()).select(F.col(member).alias("username"))
    return named.join(users.select("username"), "username", "left_anti").dropDuplicates(["username"])


def drain(sdf: DataFrame, mode: str = "append", label: str = "stream") -> DataFrame:
    """Process what is available and return it as a table (the newest result if complete)."""
    spark = sdf.sparkSession
    path = scratch_path(spark, label)
    run(sdf, append_to(path), scratch_path(spark, f"{label}-state"), mode).awaitTermination()
    out = spark.read.schema(T.StructType([*sdf.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    if mode == "complete":
        newest = out.agg(F.max("batch")).scalar()
        out = out.filter(F.col("batch") == newest)
    return out.drop("batch")
