"""Results and shapes that only inputs larger than the given ones show."""

import random

import pytest
from pyspark.sql import functions as F

from forumlens.operators import cluster as cl
from forumlens.operators import ngrams as ng
from forumlens.operators import similarity as sim
from forumlens.session import freeze
from forumlens.workload import QUERIES
from forumlens.workload.views import Tables


def test_round_robin_keeps_the_turns_of_its_sql(spark, tmp_path):
    orders = spark.range(15_003).select(
        (F.col("id") * 97).alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["round_robin"](Tables(spark, str(tmp_path)))
    assert got.agg(F.count(F.lit(1)), F.max("turn"), F.min("id")).first() == (15_000, 15_000, 97 * 3)



def communities(spark, n: int = 12, groups: int = 5):
    """Names that mix the communities, so that neighbours by name are strangers."""
    data = [(f"g{k % groups}-{k // groups}", f"u{c}-{(c * 7 + k + j) % 9}") for c in range(n) for k in range(c, n * groups, n) for j in range(4)]
    return spark.createDataFrame(sorted(set(data)), "group string, member string")


def counted(m):
    sets = {}
    for g, u in m.collect():
        sets.setdefault(g, set()).add(u)
    pairs = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b}
    return sets, {p: n for p, n in pairs.items() if n}


def test_groups_that_share_members_have_neighbouring_numbers(spark):
    m = communities(spark)
    at = {r["group"]: r["k"] for r in sim.located(m).collect()}
    assert sorted(at.values()) == list(range(len(at)))
    _, pairs = counted(m)
    assert all(abs(at[a] - at[b]) < 5 for a, b in pairs)


@pytest.mark.parametrize("members", [3, 1 << 18])
def test_product_of_split_block_pairs_is_exact(spark, monkeypatch, members):
    monkeypatch.setattr(sim, "MEMBERS_A_TASK", members)
    m = communities(spark)
    sets, pairs = counted(m)
    got = {(r["i"], r["j"]): r["common"] for r in sim.overlap(m, 0, 4, 2).collect()}
    assert got == pairs
    near = {(r["i"], r["j"]) for r in sim.jaccard(m, least=0.3, block=4, panel=2).collect()}
    assert near == {(a, b) for (a, b), n in pairs.items() if n >= 0.3 * len(sets[a] | sets[b]) - 1e-9}


def test_edges_multiply_once(spark):
    plan = sim.edges(communities(spark), few=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("size", [7, 60, 1 << 20])
def test_thinned_pairs_keep_the_tree(spark, size):
    rng = random.Random(5)
    names = [f"n{k}" for k in range(30)] + ["é", "z\U0001f600", "z￮"]
    pairs = {tuple(sorted(rng.sample(names, 2))): rng.randrange(4) / 4 for _ in range(300)}
    df = spark.createDataFrame([(*p, d) for p, d in pairs.items()], "i string, j string, distance double").coalesce(1)
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    tree = set()
    for d, i, j in sorted((d, *p) for p, d in pairs.items()):
        if find(i) != find(j):
            root[find(i)] = find(j)
            tree.add((i, j, d))
    thin = {tuple(r) for r in cl.thinned(df, size).collect()}
    assert tree <= thin and (size < 100 or thin == tree)
    assert {tuple(r) for r in cl.merge_tree(df).collect()} == tree


def test_vocabulary_stores_only_grams_that_can_be_in_it(spark, monkeypatch):
    texts = [(" ".join(f"w{k % m}" for m in (1, 2, 3, 5, 7, 400)),) for k in range(400)]
    df = spark.createDataFrame(texts, "text string")
    stored = []
    monkeypatch.setattr(ng, "freeze", lambda d, label: stored.append(freeze(d, label)) or stored[-1])
    sizes = {1: 4, 2: 3, 3: 10_000}
    plain = ng.vocab(ng.doc_freq(df), sizes)
    bounded = ng.vocab(ng.doc_freq(df), sizes, ng.doc_freq(df.limit(40)))
    assert [tuple(r) for r in bounded.collect()] == [tuple(r) for r in plain.collect()]
    count = lambda d, n: d.filter(F.col("n") == n).count()
    assert count(stored[-1], 1) * 5 < count(stored[0], 1) and count(stored[-1], 3) == count(stored[0], 3)


def memberships(spark, tmp_path):
    """Tables in which only g1 and g2 share a member; a member comes twice and one is unknown."""
    orders = [(1, 1), (2, 2), (3, 3), (4, 50), (5, 1)]
    lines = [(1, 1, 1), (2, 1, 2), (3, 3, 1), (4, 4, 1), (5, 2, 1), (5, 2, 2)]
    stamp = "TIMESTAMP_NTZ '1995-01-01 00:00:00'"
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").selectExpr("*", f"{stamp} AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int").selectExpr(
        "*", "20.0D AS l_quantity", "'N' AS l_returnflag", "'F' AS l_linestatus", f"{stamp} AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 100.0, 0, "BUILDING") for k in range(1, 6)],
                          "c_custkey long, c_acctbal double, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return Tables(spark, str(tmp_path))


def test_rand_index_has_all_pairs_of_groups(spark, tmp_path):
    t = memberships(spark, tmp_path)
    got = {(r["i"], r["j"]): r["rand_index"] for r in QUERIES["rand_index"](t).collect()}
    # Five users: g1 has u1 and u2, g2 has u1, g3 has u3; g4 has nobody known.
    assert got == {("g1", "g2"): 0.3, ("g1", "g3"): 0.1, ("g2", "g3"): 0.3}


@pytest.mark.parametrize("block", [2, 5, 1024])
def test_all_and_requested_pairs_by_blocks(spark, block):
    m = communities(spark, 5, 3)
    sets, shared = counted(m)
    rows_of = lambda df: {(r["i"], r["j"]): (r["common"], r["n_i"], r["n_j"]) for r in df.collect()}
    want = {(a, b): (shared.get((a, b), 0), len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b}
    every = sim.with_sizes(m, every=True, block=block)
    assert every.count() == len(want) and rows_of(every) == want
    listed = [*want][::3]
    asked = spark.createDataFrame([p[::-1] for p in listed] + listed[:4] + [("g0-0", "nowhere")], "i string, j string")
    some = sim.with_sizes(m, asked, block=block)
    assert some.count() == len(listed) and rows_of(some) == {p: want[p] for p in listed}


def test_repeated_rows_count_once(spark):
    m = communities(spark, 4, 3)
    sets, shared = counted(m)
    twice = m.unionByName(m)
    assert {(r["i"], r["j"]): r["common"] for r in sim.overlap(twice).collect()} == shared
    assert {r["group"]: r["n"] for r in sim.located(twice).collect()} == {g: len(us) for g, us in sets.items()}
    assert {r["group"] for r in sim.connected_groups(twice).collect()} == {g for p in shared for g in p}


def test_scattered_members_are_summed_apart_only_where_that_spares_cells(spark, monkeypatch):
    m = communities(spark)
    _, pairs = counted(m)
    index = sim.indexed(m)
    found = lambda: {(r["i"], r["j"]): r["common"] for r in sim.overlap(index, block=2, panel=4).collect()}
    assert found() == pairs and sim.member_cells(index, None, 2).filter("b1 < 0").isEmpty()
    monkeypatch.setattr(sim, "SPARED", 0)
    assert found() == pairs and not sim.member_cells(index, None, 2).filter("b1 < 0").isEmpty()
