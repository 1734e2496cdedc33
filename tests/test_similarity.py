"""Membership similarity, clusters and the shapes of the plans."""

import random
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from forumlens.operators import cluster as cl
from forumlens.operators import similarity as sim


@pytest.fixture(scope="module")
def membership(spark):
    """Member 'bot' is in every group and group 'g0' holds a third of all rows."""
    rng = random.Random(11)
    sets = {f"g{k}": {f"u{rng.randrange(60)}" for _ in range(rng.randrange(1, 12))} | {"bot"} for k in range(25)}
    sets["g0"] |= {f"u{k}" for k in range(60)}
    sets["alone"] = {"hermit"}
    data = [(g, u) for g, us in sets.items() for u in us]
    return sets, spark.createDataFrame(data, "group string, member string")


def brute(sets):
    pairs = {tuple(sorted(p)): len(sets[p[0]] & sets[p[1]]) for p in combinations(sets, 2)}
    return {p: n for p, n in pairs.items() if n}


@pytest.mark.parametrize("few,block,panel", [(1000, 8, 8), (3, 7, 4), (0, 5, 16), (0, 1000, 1000)])
def test_overlap_is_exact_however_members_are_split(membership, few, block, panel):
    sets, m = membership
    got = {(r["i"], r["j"]): r["common"] for r in sim.overlap(m, few, block, panel).collect()}
    assert got == brute(sets)


def test_jaccard_range_and_requested_pairs(spark, membership):
    sets, m = membership
    got = {(r["i"], r["j"]): r["jaccard"] for r in sim.jaccard(m).collect()}
    want = {(a, b): n / len(sets[a] | sets[b]) for (a, b), n in brute(sets).items()}
    assert got == pytest.approx(want) and all(0 < v <= 1 for v in got.values())
    asked = spark.createDataFrame([("g1", "alone"), ("g2", "g1")], "i string, j string")
    picked = {(r["i"], r["j"]): r["jaccard"] for r in sim.jaccard(m, asked).collect()}
    assert picked == pytest.approx({("alone", "g1"): 0.0, ("g1", "g2"): want[("g1", "g2")]})


def test_rand_of_disjoint_pair_is_not_zero(spark, membership):
    sets, m = membership
    asked = spark.createDataFrame([("alone", "g1")], "i string, j string")
    universe = len(set().union(*sets.values()))
    c = lambda n: n * (n - 1) / 2
    want = c(universe - 1 - len(sets["g1"])) / c(universe)
    assert sim.rand_index(m, universe, asked).first()["rand_index"] == pytest.approx(want)


def test_edges_go_both_ways(spark):
    m = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1"), ("B", "2"), ("C", "3")], "group string, member string")
    assert rows(sim.edges(m)) == [("A", "B", 2, "undirected"), ("B", "A", 2, "undirected")]


def test_signed_membership(spark):
    mg = spark.createDataFrame([("g", "u", 1, 2), ("g", "v", 0, 1), ("g", None, 1, 1)],
                               "subreddit string, username string, pos_count int, neg_count int")
    assert rows(sim.members_signed(mg)) == [("+ g", "u"), ("- g", "u"), ("- g", "v")]


def test_dice_form(spark):
    shares = spark.createDataFrame([("x", "a", 1.0), ("y", "a", 1.0), ("y", "b", 1.0)], "subreddit string, gram string, share double")
    assert [(r[0], r[1], round(r[2], 6)) for r in sim.dice_pairs(shares).collect()] == [("x", "y", 0.666667)]


def test_compound_fills_missing_pairs(spark):
    d = lambda r: spark.createDataFrame(r, "i string, j string, distance double")
    got = sim.compound(d([("a", "b", 0.5)]), d([("a", "b", 0.25), ("a", "c", 0.5)]))
    assert rows(got) == [("a", "b", 0.75), ("a", "c", 1.5)]


def test_components_are_single_linkage(spark):
    rng = random.Random(2)
    names = [f"n{k:03}" for k in range(120)]
    pairs = {tuple(sorted(rng.sample(names, 2))): rng.random() for _ in range(260)}
    # A long chain and a hub as well.
    pairs |= {(f"p{k:03}", f"p{k + 1:03}"): 0.1 for k in range(60)} | {("hub", f"z{k}"): 0.1 for k in range(60)}
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for (a, b), d in pairs.items():
        if d <= 0.3:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    df = spark.createDataFrame([(a, b, d) for (a, b), d in pairs.items()], "i string, j string, distance double")
    got = {r["group"]: r["cluster"] for r in cl.components(df, 0.3).collect()}
    assert got == {n: find(n) for n in root}


def test_diameter_sees_missing_pairs(spark):
    labels = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e"), ("f", "e")], "group string, cluster string")
    dist = spark.createDataFrame([("a", "b", 0.1), ("b", "c", 0.2), ("e", "f", 0.4)], "i string, j string, distance double")
    assert rows(cl.diameter(labels, dist)) == [("a", 3, 1.0), ("d", 1, 0.0), ("e", 2, 0.4)]


def test_power_iteration_splits_two_cliques(spark):
    def clique(prefix):
        return [(f"{prefix}{a}", f"{prefix}{b}", 1.0) for a, b in combinations(range(6), 2)]

    df = spark.createDataFrame(clique("a") + clique("b") + [("a0", "b0", 0.01)], "i string, j string, s double")
    got = {r["group"]: r["cluster"] for r in cl.clusters(df, 2, "s").collect()}
    assert len(got) == 12 and len(set(got.values())) == 2


@pytest.mark.parametrize("pruning", [0, 1e18])
@pytest.mark.parametrize("least", [0.02, 0.25, 0.6, 1.0])
def test_threshold_join_equals_the_filtered_full_result(membership, least, pruning):
    sets, m = membership
    got = {(r["i"], r["j"]): r["jaccard"] for r in sim.jaccard(m, least=least, pruning=pruning, panel=8, block=5).collect()}
    want = {(a, b): n / len(sets[a] | sets[b]) for (a, b), n in brute(sets).items()}
    assert got == pytest.approx({p: v for p, v in want.items() if v >= least})


def test_threshold_join_makes_ten_times_fewer_pairs(spark):
    """Everybody shares a frequent member; only neighbours are similar."""
    data = [(f"g{k}", f"u{5 * (k // 2) + j}") for k in range(300) for j in range(5)] + [(f"g{k}", f"all{j}") for k in range(300) for j in range(3)]
    m = spark.createDataFrame(data, "group string, member string")
    groups = sim.numbered(m, "group", "k")
    base = m.join(groups, "group").select("member", "k")
    sized = base.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    made = sim._prefix_pairs(sim._ranked_members(base, sized), 0.8).count()
    full = sim.jaccard(m)
    assert made * 10 <= full.count() == 300 * 299 // 2
    assert rows(sim.jaccard(m, least=0.8)) == rows(full.filter("jaccard >= 0.8"))


def single_linkage(names, pairs, k):
    """Clusters after merging the nearest pair until k are left; missing pairs are at distance 1."""
    every = sorted((pairs.get(p, 1.0), *p) for p in combinations(sorted(names), 2))
    label = {n: n for n in names}
    for _, a, b in every:
        if len(set(label.values())) <= k:
            break
        low, high = sorted((label[a], label[b]))
        label = {n: low if c == high else c for n, c in label.items()}
    return label


def test_tree_cut_equals_brute_force_for_every_k(spark, membership):
    sets, m = membership
    found = {p: 1 - n / len(sets[p[0]] | sets[p[1]]) for p, n in brute(sets).items()}
    found = {p: d for p, d in found.items() if "g3" not in p}  # two groups apart from all others
    distances = spark.createDataFrame([(*p, d) for p, d in found.items()], "i string, j string, distance double")
    groups = spark.createDataFrame([(g,) for g in sets], "group string")
    tree = cl.merge_tree(distances)
    assert tree.count() == len(sets) - 3  # 'alone', 'g3' and the rest
    for k in (1, 2, 3, 4, 9, len(sets), 99):
        got = {r["group"]: r["cluster"] for r in cl.cut(tree, groups, k).collect()}
        assert got == single_linkage(list(sets), found, k), k
