"""Discussion-site tables derived from the given star schema.

The same text runs in Spark and in the checking engine.  ``{name}`` marks a table.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TEXT_TABLES = ("documents", "pages")

VIEWS: dict[str, str] = {
    "comments": """
SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CONCAT('u', o_custkey) END AS author_name,
  CONCAT('g', l_suppkey) AS subreddit, l_orderkey AS thread_id,
  CAST(FLOOR(l_quantity) AS INT) - 10 AS score,
  CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS gold,
  CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END AS silver,
  CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END AS platinum,
  CONCAT(l_returnflag, REPEAT('x', l_linenumber)) AS text,
  CASE WHEN l_linestatus = 'F' THEN 'thread' ELSE 'profile' END AS scrape_mode,
  l_shipdate AS created, o_orderdate AS timestamp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "threads": """
SELECT o_orderkey AS id,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CONCAT('u', o_custkey) END AS author_name,
  CONCAT('g', o_orderkey % 97) AS subreddit, CONCAT('d', o_orderkey % 41) AS domain,
  CAST(FLOOR(o_totalprice / 10000) AS INT) - 5 AS score,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS gold,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS silver,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS platinum,
  CAST(o_orderkey % 13 AS INT) AS num_comments,
  CASE WHEN o_orderstatus = 'F' THEN 'thread' ELSE 'minimal' END AS scrape_mode,
  o_orderdate AS created, o_orderdate AS timestamp
FROM {orders}""",
    "users_t1": """
SELECT CONCAT('u', c_custkey) AS username,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CONCAT('i', c_custkey) END AS id,
  CAST(FLOOR(c_acctbal) AS INT) AS comment_karma, CAST(FLOOR(c_acctbal / 2) AS INT) AS post_karma,
  c_nationkey = 0 AS is_mod, c_mktsegment = 'BUILDING' AS is_gold,
  CASE WHEN c_nationkey < 12 THEN TIMESTAMP_NTZ '1994-01-01 18:00:00'
       ELSE TIMESTAMP_NTZ '1995-03-05 06:00:00' END AS account_created,
  CASE WHEN c_nationkey = 3 THEN TIMESTAMP_NTZ '1995-06-01 00:00:00' END AS shadowbanned_by_date,
  CASE WHEN c_nationkey = 4 THEN TIMESTAMP_NTZ '1995-07-01 00:00:00' END AS suspended_by_date,
  CASE WHEN c_nationkey = 5 THEN 1 ELSE 0 END AS submissions_silver,
  CASE WHEN c_nationkey = 6 THEN 1 ELSE 0 END AS submissions_gold,
  CASE WHEN c_nationkey = 7 THEN 1 ELSE 0 END AS submissions_platinum,
  CASE WHEN c_nationkey = 8 THEN 1 ELSE 0 END AS comments_silver,
  CASE WHEN c_nationkey = 9 THEN 1 ELSE 0 END AS comments_gold,
  CASE WHEN c_nationkey = 10 THEN 1 ELSE 0 END AS comments_platinum,
  TIMESTAMP_NTZ '1996-01-01 12:00:00' AS timestamp
FROM {customer}""",
    # The second snapshot has lost the users of one market segment.
    "users_t2": """
SELECT CONCAT('u', c_custkey) AS username,
  CASE WHEN c_custkey % 17 = 0 OR c_acctbal < 0 THEN NULL ELSE CONCAT('i', c_custkey) END AS id,
  CAST(FLOOR(c_acctbal) AS INT) + 5 AS comment_karma, CAST(FLOOR(c_acctbal / 2) AS INT) + 3 AS post_karma,
  c_nationkey <= 1 AS is_mod,
  CASE WHEN c_custkey % 17 = 0 THEN TIMESTAMP_NTZ '1997-01-01 00:00:00' END AS shadowbanned_by_date,
  CASE WHEN c_acctbal < 0 THEN TIMESTAMP_NTZ '1997-06-01 00:00:00' END AS suspended_by_date,
  CASE WHEN c_nationkey = 11 THEN TIMESTAMP_NTZ '1997-06-15 00:00:00' END AS deleted_by_date,
  CASE WHEN c_nationkey = 5 THEN 2 ELSE 0 END AS submissions_silver,
  CASE WHEN c_nationkey = 6 THEN 2 ELSE 0 END AS submissions_gold,
  CASE WHEN c_nationkey = 7 THEN 2 ELSE 0 END AS submissions_platinum,
  CASE WHEN c_nationkey = 8 THEN 2 ELSE 0 END AS comments_silver,
  CASE WHEN c_nationkey = 9 THEN 2 ELSE 0 END AS comments_gold,
  CASE WHEN c_nationkey = 10 THEN 2 ELSE 0 END AS comments_platinum,
  CASE WHEN c_nationkey < 10 THEN TIMESTAMP_NTZ '1996-01-05 00:00:00'
       ELSE TIMESTAMP_NTZ '1997-07-01 00:00:00' END AS timestamp
FROM {customer} WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "moderators": """
SELECT subreddit, author_name AS username, score AS pos
FROM {comments} WHERE author_name IS NOT NULL""",
    "texts": """
SELECT doc_id AS id, source AS subreddit,
  CASE WHEN doc_id % 40 = 0 THEN NULL ELSE CONCAT('u', doc_id % 40) END AS author_name, lang, text
FROM {documents}""",
    "nodes": """
SELECT event_id AS id, CAST(FLOOR(event_id / 200.0) AS BIGINT) AS thread_id,
  CASE WHEN event_id % 97 = 96 THEN -1
       WHEN event_id % 200 < 5 THEN NULL
       ELSE CAST(FLOOR(event_id / 200.0) * 200 + FLOOR((event_id % 200 - 2) / 3.0) AS BIGINT) END AS parent_id,
  CASE WHEN user_id % 20 = 0 THEN NULL ELSE CONCAT('u', user_id) END AS author_name,
  CAST(FLOOR(value) AS INT) AS score, ts AS created
FROM {events}""",
    "mention_pages": "SELECT page_id, url, html AS text FROM {pages}",
}

# A caller's lexicon: neutral words; 'zzqx' never occurs and tests the zero cells.
LEXICON = [
    ("the", "article", "specific"), ("a", "article", "specific"), ("is", "be", "specific"),
    ("was", "be", "specific"), ("are", "be", "specific"), ("of", "of", "general"),
    ("with", "with", "general"), ("that", "that", "general"), ("zzqx", "zzqx", "general"),
]


def view_sql(name: str) -> str:
    """View text for the checking engine, whose plain TIMESTAMP is already zone-less."""
    text = re.sub(r"\{(\w+)\}", r"\1", VIEWS[name]).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return text.strip()


class Tables:
    """Given tables and derived views of one scale-factor folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            df = self.spark.read.parquet(self.path(name))
            return self.spread(df) if name in TEXT_TABLES else df
        if name in VIEWS:
            used = re.findall(r"\{(\w+)\}", VIEWS[name])
            return self.spark.sql(VIEWS[name], **{u: getattr(self, u) for u in used})
        raise AttributeError(name)

    def spread(self, df: DataFrame) -> DataFrame:
        """Use all cores on a table whose few row groups would occupy only some of them.

        A table of many files has more splits than cores and is left as it is.
        """
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    @cached_property
    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(LEXICON, "term string, canonical string, list string")
