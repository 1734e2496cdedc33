"""Queries that choose what to process next."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.functions import scalars as sc
from forumlens.operators import normalize as nz
from forumlens.operators import select as sel
from forumlens.operators.ranking import top_per_group
from forumlens.workload.registry import query

NOW = "1998-08-01 00:00:00"
AUTHORS = "(SELECT author_name FROM comments UNION SELECT author_name FROM threads)"
LISTED = "SELECT CONCAT('g', s_suppkey) FROM supplier WHERE s_acctbal > 8000"


# An empty request list filters nothing.
IN_LISTED = f"(subreddit IN ({LISTED}) OR NOT EXISTS ({LISTED}))"


def listed_groups(t):
    return t.supplier.filter("s_acctbal > 8000").select(F.concat(F.lit("g"), "s_suppkey").alias("subreddit"))


@query(
    "unscraped_members",
    f"SELECT author_name FROM {AUTHORS} a WHERE author_name NOT IN (SELECT username FROM users_t2)",
)
def unscraped_members(t):
    return sel.unseen(t.comments, t.threads, t.users_t2)


@query(
    "unscraped_members_sample",
    f"""SELECT COUNT(*) AS picked, COUNT(DISTINCT author_name) AS members, 0 AS stored FROM (SELECT author_name
    FROM {AUTHORS} a WHERE author_name NOT IN (SELECT username FROM users_t2) LIMIT 50) s""",
)
def unscraped_members_sample(t):
    """Which members are drawn is random, so the draw itself is described."""
    drawn = sel.unseen(t.comments, t.threads, t.users_t2, 50, seed=3)
    stored = t.users_t2.select(F.col("username").alias("author_name"), F.lit(1).alias("hit"))
    return drawn.join(stored, "author_name", "left").agg(
        F.count(F.lit(1)).alias("picked"),
        F.countDistinct("author_name").alias("members"),
        F.count("hit").alias("stored"),
    )


@query(
    "stale_members",
    f"""SELECT a.author_name AS username FROM {AUTHORS} a LEFT JOIN users_t2 u ON u.username = a.author_name
    WHERE a.author_name IS NOT NULL AND (u.username IS NULL
      OR EPOCH(TIMESTAMP '{NOW}') - EPOCH(u.timestamp) >= 500 * 86400)""",
)
def stale_members(t):
    wanted = sel.members_of(t.comments, t.threads).filter("author_name IS NOT NULL")
    return sel.stale(wanted.select(F.col("author_name").alias("username")), t.users_t2, 500, NOW)


@query(
    "valid_posts",
    f"""SELECT p.id, p.num_comments FROM threads p
    LEFT JOIN (SELECT id, MAX(timestamp) AS seen FROM threads WHERE scrape_mode = 'thread' GROUP BY id) k USING (id)
    WHERE num_comments BETWEEN 2 AND 9
      AND EPOCH(TIMESTAMP '{NOW}') - EPOCH(created) BETWEEN 100 * 86400 AND 1000 * 86400
      AND (seen IS NULL OR EPOCH(TIMESTAMP '{NOW}') - EPOCH(seen) > 400 * 86400)""",
)
def valid_posts(t):
    return sel.valid(t.threads, t.threads, NOW, 2, 9, (100, 1000), 400).select("id", "num_comments")


@query(
    "rescrape_members",
    f"""SELECT username FROM users_t2 WHERE EPOCH(TIMESTAMP '{NOW}') - EPOCH(timestamp) > 500 * 86400
    AND username IN (SELECT author_name FROM comments WHERE {IN_LISTED}
      UNION SELECT author_name FROM threads WHERE {IN_LISTED})""",
)
def rescrape_members(t):
    return sel.members_in_groups(t.users_t2, t.comments, t.threads, listed_groups(t), 500, NOW, seed=1)


REFRESH = f"""created BETWEEN TIMESTAMP '{NOW}' - INTERVAL 900 DAY AND TIMESTAMP '{NOW}' - INTERVAL 30 DAY
  AND timestamp < TIMESTAMP '{NOW}' - INTERVAL 60 DAY AND {IN_LISTED}"""


@query(
    "rescrape_threads",
    f"SELECT id FROM threads WHERE {REFRESH} AND scrape_mode = 'thread' AND num_comments >= 1 AND num_comments <= 9",
)
def rescrape_threads(t):
    return sel.threads_to_refresh(t.threads, NOW, (30, 900), 60, listed_groups(t), "thread", 1, 9)


@query(
    "rescrape_threads_from_comments",
    f"""SELECT id FROM threads WHERE {REFRESH} AND scrape_mode = 'thread'
    UNION SELECT thread_id FROM comments WHERE {REFRESH} AND scrape_mode = 'thread'""",
)
def rescrape_threads_from_comments(t):
    return sel.threads_to_refresh(t.threads, NOW, (30, 900), 60, listed_groups(t), "thread", comments=t.comments)


@query(
    "resample_members",
    """SELECT username, timestamp, CASE WHEN EPOCH(TIMESTAMP '1996-06-01 00:00:00') - EPOCH(timestamp) < 200 * 86400
      THEN 200 * 86400 - (EPOCH(TIMESTAMP '1996-06-01 00:00:00') - EPOCH(timestamp)) ELSE 0 END AS wait_seconds
    FROM users_t1 u WHERE NOT EXISTS (SELECT 1 FROM users_t2 s WHERE s.username = u.username)
      AND EPOCH(TIMESTAMP '1996-06-01 00:00:00') - EPOCH(timestamp) <= 400 * 86400""",
)
def resample_members(t):
    return sel.resample(t.users_t1, t.users_t2, 200, 400, "1996-06-01 00:00:00").withColumn(
        "wait_seconds", F.round("wait_seconds", 3)
    )


@query(
    "groups_without_members",
    """SELECT DISTINCT subreddit FROM threads
    WHERE subreddit NOT IN (SELECT subreddit FROM moderators
      WHERE username IN (SELECT username FROM users_t1 WHERE is_mod))""",
)
def groups_without_members(t):
    stored = t.moderators.join(t.users_t1.filter("is_mod"), "username", "left_semi")
    return sel.missing_groups(t.threads.select("subreddit"), stored)


ACTIVITY = """SELECT subreddit, COUNT(*) AS count FROM (SELECT subreddit FROM comments
  UNION ALL SELECT subreddit FROM threads) a {where} GROUP BY subreddit"""


@query("groups_by_activity", ACTIVITY.format(where=f"WHERE subreddit NOT IN ({LISTED})"))
def groups_by_activity(t):
    return sel.group_activity(t.comments, t.threads, listed_groups(t))


@query("groups_min_count", ACTIVITY.format(where="") + " HAVING COUNT(*) > (SELECT COUNT(*) FROM orders) / 20")
def groups_min_count(t):
    # The threshold is a plain number for the operator; here it follows the table size.
    counts = sel.group_activity(t.comments, t.threads)
    kept = sel.groups_min(t.comments, t.threads, t.orders.count() // 20)
    return counts.join(kept, "subreddit", "left_semi")


@query("groups_seen", "SELECT subreddit FROM comments UNION SELECT subreddit FROM threads")
def groups_seen(t):
    return sel.groups_min(t.comments, t.threads)


@query("drop_existing_ids", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def drop_existing_ids(t):
    return sel.new_ids(t.documents.select("doc_id"), t.labels, "doc_id")


@query(
    "batch_ids",
    """SELECT o_orderkey, CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) / 100) AS BIGINT) AS batch FROM orders""",
)
def batch_ids(t):
    return sel.batches(t.orders.select("o_orderkey"), 100, [F.col("o_orderkey")])


TURNS = """SELECT id, subreddit, turn FROM (SELECT id, subreddit, ROW_NUMBER() OVER (PARTITION BY subreddit
  ORDER BY created DESC, id) AS turn FROM threads) r"""


@query("round_robin", TURNS + " WHERE turn <= 15000")
def round_robin(t):
    order = [F.col("created").desc(), F.col("id")]
    queued = sel.interleave(t.threads.select("id", "subreddit", "created"), "subreddit", order, 15000)
    return queued.select("id", "subreddit", "turn")


@query("shuffle", "SELECT id, author_name FROM threads")
def shuffle(t):
    return sel.shuffle(t.threads.select("id", "author_name"), seed=7)


@query(
    "member_threads",
    """SELECT thread_id FROM comments WHERE author_name IN (SELECT username FROM users_t1 WHERE is_mod)
    UNION SELECT id FROM threads WHERE author_name IN (SELECT username FROM users_t1 WHERE is_mod)""",
)
def member_threads(t):
    return sel.threads_of(t.users_t1.filter("is_mod").select("username"), t.comments, t.threads)


HOST_SQL = "REGEXP_EXTRACT(url, '^[a-z]+://([^/:?#]+)', 1)"
LINK = 'href="/([^"]+)"'
MENTIONS = f"""SELECT {HOST_SQL} AS subreddit, LOWER(UNNEST(REGEXP_EXTRACT_ALL(text, '{LINK}', 1))) AS related_subreddit,
  'wiki' AS relationship_type, url AS wiki_name FROM mention_pages"""


def page_mentions(t):
    rows = t.mention_pages.select(sc.domain("url").alias("subreddit"), "url", "text")
    return nz.mentions(rows, "text", LINK, "wiki", F.col("url")).drop("url")


@query("related_edges", f"SELECT DISTINCT * FROM ({MENTIONS}) m")
def related_edges(t):
    return sel.related(page_mentions(t))


# Host -> mentioned word and word -> host, so that more than one hop exists.
EDGES = f"""e AS (SELECT DISTINCT subreddit AS a, related_subreddit AS b FROM ({MENTIONS}) m
    UNION SELECT related_subreddit, subreddit FROM ({MENTIONS}) n)"""


@query(
    "expand_related",
    f"""WITH RECURSIVE {EDGES}, walk(subreddit, hop) AS (
      SELECT DISTINCT {HOST_SQL}, 0 FROM pages WHERE url LIKE '%page=2%'
      UNION SELECT e.b, walk.hop + 1 FROM walk JOIN e ON e.a = walk.subreddit
        WHERE walk.hop < 3 AND e.b NOT IN ('und', 'der', 'the'))
    SELECT subreddit, CAST(MIN(hop) AS INT) AS hop FROM walk GROUP BY subreddit""",
)
def expand_related(t):
    rows = page_mentions(t).select("subreddit", "related_subreddit")
    both = rows.unionByName(
        rows.select(F.col("related_subreddit").alias("subreddit"), F.col("subreddit").alias("related_subreddit"))
    )
    seeds = t.pages.filter(F.col("url").contains("page=2")).select(sc.domain("url").alias("subreddit"))
    exclude = t.spark.createDataFrame([("und",), ("der",), ("the",)], "name string")
    return sel.k_hop(both, seeds, 3, exclude)


@query(
    "expand_related_in_range",
    f"""WITH RECURSIVE {EDGES}, s AS (SELECT a AS subreddit, COUNT(DISTINCT b) AS subscribers FROM e GROUP BY a),
      walk(subreddit, hop) AS (
      SELECT DISTINCT {HOST_SQL}, 0 FROM pages WHERE url LIKE '%page=2%'
      UNION SELECT e.b, walk.hop + 1 FROM walk JOIN e ON e.a = walk.subreddit JOIN s ON s.subreddit = e.b
        WHERE walk.hop < 3 AND s.subscribers BETWEEN 2 AND 60)
    SELECT subreddit, CAST(MIN(hop) AS INT) AS hop FROM walk GROUP BY subreddit""",
)
def expand_related_in_range(t):
    """Only groups whose size (here: groups they are linked to) is in a range are returned and expanded."""
    rows = page_mentions(t).select("subreddit", "related_subreddit")
    both = rows.unionByName(
        rows.select(F.col("related_subreddit").alias("subreddit"), F.col("subreddit").alias("related_subreddit")))
    seeds = t.pages.filter(F.col("url").contains("page=2")).select(sc.domain("url").alias("subreddit"))
    sizes = both.dropna().groupBy("subreddit").agg(F.count_distinct("related_subreddit").alias("subscribers"))
    return sel.k_hop(both, seeds, 3, sizes=sizes, min_size=2, max_size=60)


@query("newest_per_group", TURNS + " WHERE turn <= 10")
def newest_per_group(t):
    order = [F.col("created").desc(), F.col("id")]
    return top_per_group(t.threads, "subreddit", order, 10, "turn").select("id", "subreddit", "turn")


@query("page_limit", "SELECT id, score FROM threads ORDER BY score DESC, id LIMIT 100")
def page_limit(t):
    return sel.limit(t.threads.select("id", "score"), 100, F.col("score").desc(), F.col("id"))


@query("known_groups", f"SELECT subreddit FROM threads UNION {LISTED}")
def known_groups(t):
    return sel.known(t.threads, listed_groups(t))
