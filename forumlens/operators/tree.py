"""Comment trees: levels, absolute positions, pruning, orphans and counters.

A node is (thread_id, id, parent_id); roots have a NULL parent_id.  An id that comes up
several times in a thread counts once: its first row in sibling order.  Ancestor chains are
resolved by pointer doubling: each round replaces a node's ancestor by that ancestor's
ancestor, so a tree of depth d takes about log2(d) joins instead of d.  Levels carry only the
number of steps; whole paths are built where they are the result, or up to a bounded depth.
Places in the whole thread come from ranking its Euler tour by the same doubling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.operators.ranking import exact_rank, first_by_key
from forumlens.session import freeze

# Fixed value: depth of a full traversal, for callers who want that width.
FULL_DEPTH = 30


def default_order() -> list[Column]:
    return [F.col("score").desc_nulls_last(), F.col("created").asc_nulls_last(), F.col("id")]


def unique_nodes(nodes: DataFrame, order: list[Column] | None = None, thread: str = "thread_id") -> DataFrame:
    """First row of every (thread, id) in sibling order, then by parent (a root first)."""
    order = default_order() if order is None else order
    return first_by_key(nodes, [thread, "id"], [*order, F.col("parent_id").asc_nulls_first()])


def depths(nodes: DataFrame, order: list[Column] | None = None, thread: str = "thread_id") -> DataFrame:
    """(thread, id, parent_id, level) of every node that hangs on a root; a row keeps its width however long its chain is."""
    return _depths(unique_nodes(nodes, order, thread), thread)


def _depths(unique: DataFrame, thread: str) -> DataFrame:
    """``depths`` of nodes that come up once each."""
    hops = unique.select(
        F.col(thread).alias("_thread"), F.col("id").alias("_id"), F.col("parent_id").alias("_parent"),
        F.col("parent_id").alias("_up"), F.lit(0).alias("level"))
    hops = freeze(hops, "depths")
    active = hops.filter(F.col("_up").isNotNull()).count()
    while active:
        above = hops.select(F.col("_thread").alias("_athread"), F.col("_id").alias("_aid"), F.col("_up").alias("_aup"), F.col("level").alias("_steps"))
        moving = hops.filter(F.col("_up").isNotNull())
        stepped = moving.join(above, (F.col("_thread") == F.col("_athread")) & (F.col("_up") == F.col("_aid"))).select(
            "_thread", "_id", "_parent", F.col("_aup").alias("_up"), (F.col("level") + F.col("_steps") + 1).alias("level"))
        hops = freeze(hops.filter(F.col("_up").isNull()).unionByName(stepped), "depths")
        left = hops.filter(F.col("_up").isNotNull()).count()
        if left == active:  # only cycles never finish
            break
        active = left
    return hops.filter(F.col("_up").isNull()).select(F.col("_thread").alias(thread), F.col("_id").alias("id"), F.col("_parent").alias("parent_id"), "level")


def spans(nodes: DataFrame, order: list[Column] | None = None, thread: str = "thread_id") -> DataFrame:
    """(thread, id, parent_id, position, size): place in the thread read from top to bottom, from 0, and nodes of the subtree.

    A subtree takes the places ``position`` to ``position + size - 1``.  Every node is entered and left once on a
    tour of its thread; each of the two steps points to the next one, and doubling these pointers
    counts the nodes entered from a step to the end of the tour.
    """
    order = default_order() if order is None else order
    unique = freeze(unique_nodes(nodes, order, thread), "nodes")
    rooted = _depths(unique, thread).select(F.col(thread).alias("_t"), F.col("id").alias("_i"))
    hanging = unique.join(rooted, (F.col(thread) == F.col("_t")) & F.col("id").eqNullSafe(F.col("_i")), "left_semi")
    ranked = exact_rank(hanging, order, [thread, "parent_id"], "_rn")
    ranked = freeze(ranked.select(F.col(thread).alias("t"), "id", F.col("parent_id").alias("parent"), F.col("_rn").alias("rn")), "siblings")
    child = ranked.filter((F.col("rn") == 1) & F.col("parent").isNotNull()).select("t", F.col("parent").alias("id"), F.col("id").alias("child"))
    after = ranked.select(F.col("t").alias("_t"), F.col("parent").alias("_p"), (F.col("rn") - 1).alias("_rn"), F.col("id").alias("sibling"))
    siblings = ranked.join(after, (F.col("t") == F.col("_t")) & F.col("parent").eqNullSafe(F.col("_p")) & (F.col("rn") == F.col("_rn")), "left")
    enter = ranked.join(child, ["t", "id"], "left").select(
        "t", "id", F.lit(True).alias("enters"), F.coalesce("child", "id").alias("next"), F.col("child").isNotNull().alias("next_enters"),
        F.lit(1).cast("bigint").alias("entered"))
    leave = siblings.select(
        "t", "id", F.lit(False), F.coalesce("sibling", "parent"), F.col("sibling").isNotNull(), F.lit(0).cast("bigint"))
    steps = freeze(enter.unionAll(leave), "tour")
    while not steps.filter(F.col("next").isNotNull()).isEmpty():
        ahead = steps.select(F.col("t").alias("_t"), F.col("id").alias("_i"), F.col("enters").alias("_e"), F.col("next").alias("_next"),
                             F.col("next_enters").alias("_next_enters"), F.col("entered").alias("_entered"))
        moved = steps.filter(F.col("next").isNotNull()).join(
            ahead, (F.col("t") == F.col("_t")) & (F.col("next") == F.col("_i")) & (F.col("next_enters") == F.col("_e")))
        moved = moved.select("t", "id", "enters", F.col("_next").alias("next"), F.col("_next_enters").alias("next_enters"),
                             (F.col("entered") + F.col("_entered")).alias("entered"))
        steps = freeze(steps.filter(F.col("next").isNull()).unionByName(moved), "tour")
    both = steps.groupBy("t", "id").agg(F.max(F.when(F.col("enters"), F.col("entered"))).alias("_in"), F.max(F.when(~F.col("enters"), F.col("entered"))).alias("_out"))
    total = ranked.groupBy(F.col("t").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    placed = ranked.join(both, ["t", "id"]).join(total, F.col("t") == F.col("_t"))
    return placed.select(F.col("t").alias(thread), "id", F.col("parent").alias("parent_id"), (F.col("_n") - F.col("_in")).alias("position"),
                         (F.col("_in") - F.col("_out")).alias("size"))


def expand(nodes: DataFrame, order: list[Column] | None = None, max_depth: int | None = None,
           thread: str = "thread_id") -> DataFrame:
    """(thread, id, parent_id, path) of every node that hangs on a root.

    ``path`` holds the 0-based sibling index per level.  Nodes below a missing parent and
    nodes on a parent cycle hang on no root and are left out, as are nodes deeper than
    ``max_depth`` levels.
    """
    order = default_order() if order is None else order
    ranked = exact_rank(unique_nodes(nodes, order, thread), order, [thread, "parent_id"], "_rn")
    hops = ranked.select(
        F.col(thread).alias("_thread"),
        F.col("id").alias("_id"),
        F.col("parent_id").alias("_parent"),
        F.col("parent_id").alias("_up"),
        F.array((F.col("_rn") - 1).cast("int")).alias("path"),
    )
    hops = freeze(hops, "hops")
    active = hops.filter(F.col("_up").isNotNull()).count()
    reach = 1
    while active and (max_depth is None or reach < max_depth):
        above = hops.select(
            F.col("_thread").alias("_athread"), F.col("_id").alias("_aid"),
            F.col("_up").alias("_aup"), F.col("path").alias("_apath"),
        )
        moving = hops.filter(F.col("_up").isNotNull())
        stepped = moving.join(
            above, (F.col("_thread") == F.col("_athread")) & (F.col("_up") == F.col("_aid"))
        ).select("_thread", "_id", "_parent", F.col("_aup").alias("_up"), F.concat("_apath", "path").alias("path"))
        hops = freeze(hops.filter(F.col("_up").isNull()).unionByName(stepped), "hops")
        reach *= 2
        left = hops.filter(F.col("_up").isNotNull()).count()
        if left == active:
            # Of any unfinished chain some node finishes in every round, so what no
            # longer shrinks lies on cycles.
            break
        active = left
    rooted = hops.filter(F.col("_up").isNull())
    if max_depth is not None:
        rooted = rooted.filter(F.size("path") <= max_depth)
    return rooted.select(
        F.col("_thread").alias(thread), F.col("_id").alias("id"), F.col("_parent").alias("parent_id"), "path"
    )


def levels(nodes: DataFrame, order: list[Column] | None = None, thread: str = "thread_id") -> DataFrame:
    """Depth of every node; roots are level 0."""
    return depths(nodes, order, thread)


def absolute_position(path: Column | str, width: int) -> Column:
    """Sibling index per level, padded with -1 to the traversal depth."""
    path = F.col(path) if isinstance(path, str) else path
    return F.concat(path, F.array_repeat(F.lit(-1), F.lit(width) - F.size(path)))


def paths(nodes: DataFrame, order: list[Column] | None = None, width: int | None = None,
          thread: str = "thread_id") -> DataFrame:
    """Padded positions; without a ``width`` to the deepest path found, with one without deeper nodes."""
    tree = expand(nodes, order, width, thread)
    if width is None:
        tree = freeze(tree, "tree")
        width = tree.agg(F.max(F.size("path"))).first()[0] or 0
    return tree.select(thread, "id", "parent_id", absolute_position("path", width).alias("absolute_position"))


def within(path: Column, pattern: Sequence[int]) -> Column:
    """Whether a traversal with this pattern reaches the path.

    At level L it visits siblings 0..pattern[L], one more than the number says.  A path
    lists all its ancestors, so a pruned ancestor prunes the whole subtree.
    """
    limits = F.array(*[F.lit(int(p)) for p in pattern])
    too_far = F.filter(path, lambda x, i: x > F.get(limits, i))
    return (F.size(path) <= len(pattern)) & (F.size(too_far) == 0)


def prune(nodes: DataFrame, pattern: Sequence[int], order: list[Column] | None = None,
          thread: str = "thread_id") -> DataFrame:
    """Nodes a traversal with ``pattern`` visits, with their paths."""
    return expand(nodes, order, len(pattern), thread).filter(within(F.col("path"), pattern))


def nreplies(visited: DataFrame, thread: str = "thread_id") -> DataFrame:
    """Visited direct children of every visited node."""
    counts = (
        visited.filter(F.col("parent_id").isNotNull())
        .groupBy(F.col(thread).alias("_t"), F.col("parent_id").alias("_p"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    joined = visited.join(counts, (F.col(thread) == F.col("_t")) & (F.col("id") == F.col("_p")), "left")
    return joined.select(*visited.columns, F.coalesce("_n", F.lit(0)).alias("nreplies"))


def counters(visited: DataFrame, thread: str = "thread_id") -> DataFrame:
    """Distinct comments per thread, and how many of them have no author any more."""
    once = visited.groupBy(thread, "id").agg(F.count("author_name").alias("_named"))
    return once.groupBy(thread).agg(
        F.count(F.lit(1)).alias("comments_navigated"), F.count_if(F.col("_named") == 0).alias("comments_deleted")
    )


def drop_orphans(nodes: DataFrame, order: list[Column] | None = None, thread: str = "thread_id") -> DataFrame:
    """Nodes whose chain of parents reaches a root, each once."""
    nodes = freeze(unique_nodes(nodes, order, thread), "nodes")
    rooted = _depths(nodes, thread).select(F.col(thread).alias("_t"), F.col("id").alias("_i"))
    return nodes.join(rooted, (F.col(thread) == F.col("_t")) & (F.col("id") == F.col("_i")), "left_semi")


def authors(comments: DataFrame, threads: DataFrame | None = None, thread: str = "thread_id") -> DataFrame:
    """Distinct authors met per thread, with the thread's own author if threads are given."""
    met = comments.select(thread, "author_name")
    if threads is not None:
        met = met.unionByName(threads.select(F.col("id").alias(thread), "author_name"))
    return met.filter(F.col("author_name").isNotNull()).distinct()

