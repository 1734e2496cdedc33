"""Clusters of groups from pair distances."""

from __future__ import annotations

from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.ranking import exact_rank
from forumlens.operators.similarity import numbered
from forumlens.session import freeze


def _neighbour_min(links: DataFrame) -> DataFrame:
    """Least node in every node's neighbourhood, itself included."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _unfinished(links: DataFrame) -> DataFrame:
    """Nodes linked to several others, or both linked to one and linked from one; none once all links are stars."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 and up > 0")


def components(distances: DataFrame, h: float, groups: DataFrame | None = None) -> DataFrame:
    """Label of every group: the least group it is linked to by steps of at most ``h``.

    ``groups`` (one column ``group``) names all groups where the pairs are only those within reach; without it
    the groups are those of the pairs.  That is single linkage cut at height h.  Alternating star contraction (large star, then
    small star) needs a logarithmic number of rounds, where passing labels along edges
    would need as many as the longest chain.  Both steps are a min per node, combined
    before the shuffle, and a join back to the edges.
    """
    if groups is None:
        distances = freeze(distances, "distances")
        groups = distances.select(F.col("i").alias("group")).unionAll(distances.select("j")).distinct()
    groups = freeze(groups, "labels")
    links = distances.filter((F.col("distance") <= h) & (F.col("i") != F.col("j")))
    links = freeze(
        links.select(F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).distinct(), "links"
    )
    while True:
        # Large star: link every greater neighbour to the least node around.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_neighbour_min(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: link a node and its lesser neighbours to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct()
        )
        links = freeze(small, "links")
        if _unfinished(links).isEmpty():
            break
    labels = links.select(F.col("u").alias("group"), F.col("v").alias("_least"))
    return groups.join(labels, "group", "left").select("group", F.coalesce("_least", "group").alias("cluster"))


# Pairs a task of ``thinned`` holds at once.
THIN_PAIRS = 1 << 20


def thinned(pairs: DataFrame, size: int = THIN_PAIRS) -> DataFrame:
    """The pairs (i, j, distance) without some that no least spanning forest has, ties by i, then j.

    Each task keeps the least spanning forest of the pairs it reads, some ``size`` at a time: the greatest pair of a cycle is in no
    least forest of more pairs either.  Nothing is moved, and pairs that lie together thin out most.
    """

    def forest(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def thin(table):
            names = pc.unique(pa.chunked_array([*table["i"].chunks, *table["j"].chunks], type=pa.string()))
            names = names.take(pc.sort_indices(names))  # by bytes, as Spark orders
            i, j = (pc.index_in(table[c], value_set=names).to_numpy().astype(np.int64) for c in ("i", "j"))
            order = np.lexsort((j, i, table["distance"].to_numpy()))
            a, b, at = i[order], j[order], np.arange(len(order))
            kept = []
            while len(at):
                # Nearest pair of every cluster; pairs are in order, so the first one.
                nearest = np.full(len(names), len(order), dtype=np.int64)
                nearest[b[::-1]] = at[::-1]
                first = np.full(len(names), len(order), dtype=np.int64)
                first[a[::-1]] = at[::-1]
                picked = np.unique(np.minimum(nearest, first))
                picked = picked[picked < len(order)]
                kept.append(picked)
                place = np.searchsorted(at, picked)
                root = np.arange(len(names))
                ends = a[place], b[place]
                while True:  # least label over the picked pairs, with pointers halved
                    low = np.minimum(root[ends[0]], root[ends[1]])
                    before = root.copy()
                    for end in ends:
                        np.minimum.at(root, before[end], low)
                        np.minimum.at(root, end, low)
                    root = root[root]
                    if (root == before).all():
                        break
                a, b = root[a], root[b]
                left = a != b
                a, b, at = a[left], b[left], at[left]
            return table.take(order[np.sort(np.concatenate(kept))]) if kept else table.slice(0, 0)

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= size:
                table = thin(pa.Table.from_batches(held))
                if len(table) > size // 2:  # a forest too large to be held
                    yield from table.to_batches()
                    table = table.slice(0, 0)
                held, rows = table.to_batches(), len(table)
        if held:
            yield from thin(pa.Table.from_batches(held)).to_batches()

    return pairs.mapInArrow(forest, "i string, j string, distance double")


def merge_tree(distances: DataFrame) -> DataFrame:
    """(i, j, distance) of the merges of single linkage: the least spanning forest of the pairs, ties by i, then j.

    Tasks first drop the pairs that no tree has as far as they can tell (``thinned``).  Then rounds of picking every cluster's
    nearest neighbour and merging along the picks; each round at least halves the clusters.  Between two clusters only
    their nearest pair goes on, so the pairs shrink with the clusters.
    A pair without a row has no merge: a forest over several trees leaves as many clusters.
    """
    order = F.struct("distance", "i", "j")
    pair = [F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")]
    pairs = thinned(distances.filter(F.col("i") != F.col("j")).select(*pair, F.col("distance").cast("double").alias("distance")))
    pairs = pairs.groupBy("i", "j").agg(F.min("distance").alias("distance"))
    open_ = freeze(pairs.select(F.col("i").alias("a"), F.col("j").alias("b"), "i", "j", "distance"), "open")
    merges: DataFrame | None = None
    while not open_.isEmpty():
        ends = open_.select(F.col("a").alias("c"), order.alias("e")).unionAll(open_.select("b", order))
        picked = freeze(ends.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct(), "picked")
        merges = freeze(picked if merges is None else merges.unionByName(picked), "merges")
        # Clusters so far, from all merges: names stay the least member's.
        labels = components(merges.withColumn("distance", F.lit(0.0)), 0.0)
        side = lambda end, to: labels.select(F.col("group").alias(end), F.col("cluster").alias(to))
        moved = open_.drop("a", "b").join(side("i", "a"), "i").join(side("j", "b"), "j").filter(F.col("a") != F.col("b"))
        nearest = moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(order).alias("e"))
        open_ = freeze(nearest.select("a", "b", "e.*"), "open")
    return pairs.limit(0).unionByName(merges) if merges is not None else pairs


def cut(tree: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(group, cluster): the tree of merges undone from the top until ``k`` clusters are left, named by their least group.

    Trees that never merge are at distance 1 of each other and join in the order of their names.
    """
    groups = freeze(groups.select("group").distinct(), "groups")
    tree = freeze(tree, "tree")
    n, merged = groups.count(), tree.count()
    trees = n - merged
    if trees <= k:
        undo = min(k, n) - trees
        ranked = exact_rank(tree, [F.col("distance").desc(), F.col("i").desc(), F.col("j").desc()], (), "_rn")
        return components(ranked.filter(F.col("_rn") > undo).select("i", "j", F.lit(0.0).alias("distance")), 0.0, groups)
    found = components(tree.select("i", "j", F.lit(0.0).alias("distance")), 0.0, groups)
    first = exact_rank(found.select("cluster").distinct(), [F.col("cluster")], (), "_rn")
    joining = freeze(first.filter(F.col("_rn") <= trees - k + 1).select("cluster"), "joining")
    least = joining.agg(F.min("cluster").alias("_least"))
    named = joining.join(F.broadcast(least))  # one row
    return found.join(named, "cluster", "left").select("group", F.coalesce("_least", "cluster").alias("cluster"))


def clusters(similarity: DataFrame, k: int, value: str, rounds: int = 20) -> DataFrame:
    """``k`` clusters by power iteration on the similarity graph (approximate)."""
    edges = similarity.filter(F.col(value) > 0)
    keys = numbered(edges.select(F.col("i").alias("group")).unionAll(edges.select("j")), "group", "k")
    side = lambda col, name: keys.select(F.col("group").alias(col), F.col("k").alias(name))
    graph = edges.join(side("i", "src"), "i").join(side("j", "dst"), "j").select("src", "dst", F.col(value).alias("weight"))
    model = PowerIterationClustering(k=k, maxIter=rounds, initMode="degree", srcCol="src", dstCol="dst", weightCol="weight")
    found = model.assignClusters(freeze(graph, "graph"))
    return found.join(keys, found["id"] == keys["k"]).select("group", "cluster")


def diameter(labels: DataFrame, distances: DataFrame) -> DataFrame:
    """Greatest distance inside every cluster (the complete-linkage height of the cluster).

    Pairs without a row are at distance 1: a cluster with fewer rows than pairs has one.
    """
    one = labels.select(F.col("group").alias("i"), F.col("cluster").alias("_ci"))
    two = labels.select(F.col("group").alias("j"), F.col("cluster").alias("_cj"))
    inside = distances.join(one, "i").join(two, "j").filter(F.col("_ci") == F.col("_cj"))
    widest = inside.groupBy(F.col("_ci").alias("cluster")).agg(
        F.max("distance").alias("_max"), F.count(F.lit(1)).alias("_known")
    )
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    joined = sizes.join(widest, "cluster", "left")
    pairs = F.col("size") * (F.col("size") - 1) / 2
    missing = F.coalesce("_known", F.lit(0)) < pairs
    value = F.when(missing, F.greatest(F.lit(1.0), F.coalesce("_max", F.lit(1.0)))).otherwise(F.coalesce("_max", F.lit(0.0)))
    return joined.select("cluster", "size", value.alias("diameter"))
