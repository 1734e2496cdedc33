"""Queries on comment trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.operators import tree
from forumlens.workload.registry import query

TREE = """ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY thread_id, parent_id
      ORDER BY score DESC, created, id) - 1 AS idx FROM nodes),
    walk(thread_id, id, parent_id, level, path) AS (
      SELECT thread_id, id, parent_id, 0, [idx] FROM ranked WHERE parent_id IS NULL
      UNION ALL SELECT r.thread_id, r.id, r.parent_id, w.level + 1, LIST_APPEND(w.path, r.idx)
      FROM walk w JOIN ranked r ON r.parent_id = w.id AND r.thread_id = w.thread_id)"""
PATTERN = [1, 2, 1, 0]
VISITED = """visited AS (SELECT * FROM walk WHERE level < 4 AND path[1] <= 1 AND (level < 1 OR path[2] <= 2)
    AND (level < 2 OR path[3] <= 1) AND (level < 3 OR path[4] <= 0))"""


@query("tree_levels", f"WITH RECURSIVE {TREE} SELECT thread_id, id, parent_id, level FROM walk")
def tree_levels(t):
    return tree.levels(t.nodes)


@query("tree_levels_chains", "SELECT conv_id, turn AS id, turn AS level FROM conversations")
def tree_levels_chains(t):
    """A conversation is one long chain: every turn answers the previous one."""
    turn = F.col("turn")
    chain = t.conversations.select("conv_id", turn.alias("id"), F.when(turn > 0, turn - 1).alias("parent_id"))
    return tree.levels(chain, [F.col("id")], thread="conv_id").select("conv_id", "id", F.col("level").cast("bigint"))


@query(
    "tree_spans",
    f"""WITH RECURSIVE {TREE}, placed AS (SELECT thread_id, id, parent_id, path,
      ROW_NUMBER() OVER (PARTITION BY thread_id ORDER BY path) - 1 AS position FROM walk)
    SELECT a.thread_id, a.id, a.parent_id, a.position, COUNT(*) AS size FROM placed a
    JOIN placed b ON a.thread_id = b.thread_id AND b.path[1 : LEN(a.path)] = a.path GROUP BY ALL""",
)
def tree_spans(t):
    """Place of every comment in its thread read from top to bottom, and the size of its subtree."""
    return tree.spans(t.nodes)


def joined(path):
    return F.array_join(F.transform(path, lambda x: x.cast("string")), "_")


@query(
    "tree_path",
    f"""WITH RECURSIVE {TREE} SELECT thread_id, id,
      ARRAY_TO_STRING(path, '_') || REPEAT('_-1', 6 - LEN(path)) AS absolute_position FROM walk""",
)
def tree_path(t):
    return tree.paths(t.nodes, width=6).select("thread_id", "id", joined(F.col("absolute_position")).alias("absolute_position"))


@query(
    "tree_nreplies",
    f"""WITH RECURSIVE {TREE}, {VISITED} SELECT v.thread_id, v.id, COUNT(c.id) AS nreplies FROM visited v
    LEFT JOIN visited c ON c.parent_id = v.id AND c.thread_id = v.thread_id GROUP BY v.thread_id, v.id""",
)
def tree_nreplies(t):
    return tree.nreplies(tree.prune(t.nodes, PATTERN)).select("thread_id", "id", "nreplies")


@query(
    "tree_prune",
    f"WITH RECURSIVE {TREE}, {VISITED} SELECT thread_id, id, ARRAY_TO_STRING(path, '_') AS path FROM visited",
)
def tree_prune(t):
    return tree.prune(t.nodes, PATTERN).select("thread_id", "id", joined(F.col("path")).alias("path"))


@query(
    "tree_counters",
    """SELECT thread_id, COUNT(DISTINCT id) AS comments_navigated,
      COUNT(DISTINCT CASE WHEN author_name IS NULL THEN id END) AS comments_deleted FROM nodes GROUP BY thread_id""",
)
def tree_counters(t):
    return tree.counters(t.nodes)


@query("tree_orphans", f"WITH RECURSIVE {TREE} SELECT n.* FROM nodes n JOIN walk w ON w.id = n.id AND w.thread_id = n.thread_id")
def tree_orphans(t):
    return tree.drop_orphans(t.nodes)


@query(
    "thread_authors",
    """SELECT thread_id, author_name FROM comments WHERE author_name IS NOT NULL
    UNION SELECT id, author_name FROM threads WHERE author_name IS NOT NULL""",
)
def thread_authors(t):
    return tree.authors(t.comments, t.threads)
