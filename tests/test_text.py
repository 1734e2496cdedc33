"""Lexicon frequencies, n-grams and comment trees."""

import collections
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from forumlens.operators import lexicon as lx
from forumlens.operators import ngrams as ng
from forumlens.operators import tree

LEX = [("the", "article", "s"), ("A ", "article", "s"), ("hello there", "hi", "s"), ("zz", "zz", "g")]


@pytest.fixture(scope="module")
def texts(spark):
    data = [(1, "g1", "u", "the cat. the"), (2, "g1", "u", "a a dog"), (3, "g2", None, "Hello there"), (4, "g2", "b", None)]
    return spark.createDataFrame(data, "id int, subreddit string, author_name string, text string")


@pytest.fixture(scope="module")
def lex(spark):
    return spark.createDataFrame(LEX, "term string, canonical string, list string")


def test_tokenise(spark):
    df = spark.createDataFrame([(1, "g", 'Hello, it\'s "A" test: yes? ok. ')], "id int, subreddit string, text string")
    assert [r["word"] for r in lx.tokens(df).collect()] == ["hello", "it", "s", "a", "test", "yes", "ok", ""]


def test_source_drops_bots_and_unknown_authors(texts):
    assert [r["id"] for r in lx.source(texts, bots=["b"]).collect()] == [1, 2]


def test_token_and_canonical_frequencies(texts, lex):
    words = lx.tokens(texts)
    assert rows(lx.term_freq(words, lex)) == [("g1", "a", 1), ("g1", "the", 1)]
    assert rows(lx.term_freq(words, lex, canonical=True)) == [("g1", "article", 2)]
    assert [r["term"] for r in lx.unsupported_terms(lex).collect()] == ["hello there"]


def test_pattern_modes(spark):
    df = spark.createDataFrame([("g", "the cat. the"), ("g", "see the, x"), ("h", "x")], "subreddit string, text string")
    lex = spark.createDataFrame([("the",), ("a.b",)], "term string")
    count = lambda **kw: {(r[0], r[1]): r[2] for r in lx.term_freq_regex(df, lex, **kw).collect()}
    assert count() == {("g", "the"): 2, ("g", "a.b"): 0, ("h", "the"): 0, ("h", "a.b"): 0}
    assert count(faithful=True)[("g", "the")] == 1


def test_grid_is_complete_and_row_counts_add_up(texts, lex):
    freq = lx.relative(lx.term_freq(lx.tokens(texts), lex), texts)
    terms = ["a", "the", "zz"]
    grid = lx.densify(freq, texts, terms)
    assert grid.count() == 2 * len(terms) and grid.agg(F.sum("count")).first()[0] == 2
    assert lx.row_counts(texts).agg(F.sum("count")).first()[0] == texts.count()


def test_stop_words(spark, texts):
    stop = lx.stop_words(spark, ["the"])
    assert sorted(r["word"] for r in lx.remove_stop(lx.tokens(texts), stop).collect()) == ["cat", "dog", "hello", "there"]


def test_five_number_interpolates(spark):
    df = spark.createDataFrame([("t", float(v)) for v in (1, 2, 3, 10)] + [("s", 5.0), ("s", None)], "term string, ratio double")
    got = {r[0]: tuple(r)[1:] for r in lx.five_number(df).collect()}
    assert got == {"t": (1.0, 1.75, 2.5, 4.75, 10.0), "s": (5.0,) * 5}


# ---- n-grams -------------------------------------------------------------------------------------


def test_clean_keeps_empty_edges(spark):
    df = spark.createDataFrame([("!a b!",), ("É",)], "t string")
    assert [r[0] for r in df.select(ng.clean("t")).collect()] == [["", "a", "b", ""], [""]]


def test_ngrams_against_brute_force(spark):
    stop = {"the", "of", ""}
    docs = ["the end of the road", "one", "", "of the of the x", "a a a a"]
    want = Counter()
    for doc in docs:
        words = doc.split(" ")
        for n in (1, 2, 3):
            grams = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
            keep = {g for g in grams if not (n < 3 and all(w in stop for w in g))}
            want.update((n, "_".join(g)) for g in keep)
    df = spark.createDataFrame([(d,) for d in docs], "text string")
    assert {(r[0], r[1]): r[2] for r in ng.doc_freq(df, sorted(stop)).collect()} == dict(want)


def test_vocabulary_breaks_ties_by_name(spark):
    freq = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "x_y", 1)], "n int, gram string, count bigint")
    assert rows(ng.vocab(freq, {1: 2, 2: 5})) == [(1, "a", 5), (1, "c", 9), (2, "x_y", 1)]


def test_matrix_has_every_group(spark):
    counts = spark.createDataFrame([("g", 1, "a", 2)], "subreddit string, n int, gram string, count bigint")
    groups = spark.createDataFrame([("g",), ("h",)], "subreddit string")
    assert rows(ng.matrix(counts, groups, ["a", "b"])) == [("g", 2, 0), ("h", 0, 0)]


@pytest.mark.parametrize("faithful", [False, True])
def test_patterns_by_join_equal_patterns_in_the_plan(spark, faithful):
    rng = random.Random(4)
    pieces = ["cat", "Cat", "the cat", ":)", "!!", "^_^", "c++", "über", "x", "$", "", " ", ",", "cat.", "a.b", "日本", "\\d", "the"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "  ", "\t", "", ", ", "!", ".", "?", "$", "^", "\n"]) for _ in range(rng.randrange(9)))
             for _ in range(250)] + [None, ""]
    df = spark.createDataFrame([(f"g{k % 3}", t) for k, t in enumerate(texts)], "subreddit string, text string")
    terms = [*pieces, "the  cat", " cat", "cat ", "cat the cat", "! !", "\\E", "missing", "(", "cat cat"]
    lexicon = spark.createDataFrame([(t, t, "x") for t in terms], "term string, canonical string, list string")
    few, many = (rows(lx.term_freq_regex(df, lexicon, faithful=faithful, plan_terms=n)) for n in (1000, 0))
    assert many == few and sum(r[2] for r in many) > 300


def test_twenty_thousand_terms_in_one_query(spark):
    rng = random.Random(8)
    terms = [f"w{k}" if k % 3 else f"w{k} w{k + 1}" for k in range(20_000)]
    texts = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(30)) + f" w{3 * k} w{3 * k + 1}." for k in range(300)]
    df = spark.createDataFrame([("g0" if k % 2 else "g1", t) for k, t in enumerate(texts)], "subreddit string, text string")
    lexicon = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {(r["subreddit"], r["term"]): r["count"] for r in lx.term_freq_regex(df, lexicon).collect()}
    assert len(got) == 40_000
    want = collections.Counter()
    for k, t in enumerate(texts):
        padded = " " + t.replace(".", " ") + " "
        words = padded.split()
        pairs = {f"{a} {b}" for a, b in zip(words, words[1:])} | set(words)
        want.update(("g0" if k % 2 else "g1", p) for p in pairs & set(terms))
    assert {k: n for k, n in got.items() if n} == dict(want)


# ---- trees ---------------------------------------------------------------------------------------------

NODES = "thread_id int, id int, parent_id int, score int, created int, author_name string"


def make_tree(spark, size=400, seed=3):
    import random

    rng = random.Random(seed)
    data, parent = [], {}
    for i in range(size):
        # Every third node answers node 0: one parent holds a third of all rows.
        p = None if i in (0, 5) else 0 if i % 3 == 0 else -7 if i % 41 == 40 else rng.randrange(max(0, i - 4), i)
        parent[i] = p
        data.append((1, i, p, rng.randrange(5), i, None if i % 10 == 0 else f"u{i % 7}"))
    data += [(2, 1000, 1001, 1, 1, "c"), (2, 1001, 1000, 1, 1, "c"), (2, 1002, 1001, 1, 1, "c")]
    return data, parent, spark.createDataFrame(data, NODES)


def brute_paths(data):
    children = {}
    for t, i, p, s, c, _ in data:
        children.setdefault((t, p), []).append((-s, c, i))
    out, stack = {}, [(t, None, []) for t in {r[0] for r in data}]
    while stack:
        t, p, path = stack.pop()
        for k, (_, _, i) in enumerate(sorted(children.get((t, p), []))):
            out[i] = path + [k]
            stack.append((t, i, out[i]))
    return out


def test_paths_match_a_walk_with_hot_parent_orphans_and_cycles(spark):
    data, _, df = make_tree(spark)
    want = brute_paths(data)
    got = {r["id"]: list(r["path"]) for r in tree.expand(df).collect()}
    assert got == want and 1000 not in got and max(map(len, want.values())) > 8
    assert len(set(map(tuple, got.values()))) == len(got)


def test_levels_and_depth_limit(spark):
    data, _, df = make_tree(spark)
    want = brute_paths(data)
    assert {r["id"]: r["level"] for r in tree.levels(df).collect()} == {i: len(p) - 1 for i, p in want.items()}
    cut = {r["id"] for r in tree.expand(df, max_depth=5).collect()}
    assert cut == {i for i, p in want.items() if len(p) <= 5}


def test_prune_and_replies(spark):
    data, parent, df = make_tree(spark)
    pattern = [1, 3, 2, 0]
    want = {i: p for i, p in brute_paths(data).items() if len(p) <= 4 and all(x <= m for x, m in zip(p, pattern))}
    visited = tree.prune(df, pattern)
    assert {r["id"] for r in visited.collect()} == set(want)
    replies = Counter(parent[i] for i in want if parent[i] is not None)
    assert {r["id"]: r["nreplies"] for r in tree.nreplies(visited).collect()} == {i: replies.get(i, 0) for i in want}


def test_absolute_position_golden(spark):
    data = [(1, 1, None, 9, 1, "a"), (1, 2, None, 5, 1, "b"), (1, 3, 2, 1, 1, None)]
    got = {r["id"]: r["absolute_position"] for r in tree.paths(spark.createDataFrame(data, NODES), width=3).collect()}
    assert got == {1: [0, -1, -1], 2: [1, -1, -1], 3: [1, 0, -1]}


def test_counters_count_ids_once(spark):
    data = [(1, 1, None, 0, 0, "a"), (1, 1, None, 0, 0, "a"), (1, 2, 1, 0, 0, None), (1, 2, 1, 0, 0, None)]
    assert rows(tree.counters(spark.createDataFrame(data, NODES))) == [(1, 2, 1)]


def test_paths_without_a_width_keep_every_level(spark):
    data = [(1, k, k - 1 if k else None) for k in range(40)]
    frame = spark.createDataFrame(data, "thread_id long, id long, parent_id long").selectExpr("*", "0 AS score", "0 AS created")
    got = {r["id"]: r["absolute_position"] for r in tree.paths(frame).collect()}
    assert got == {k: [0] * (k + 1) + [-1] * (39 - k) for k in range(40)}


def test_repeated_ids_count_once_and_spans_follow_reading_order(spark):
    data, parent, df = make_tree(spark)
    doubled = df.unionAll(df.filter("id % 3 = 0"))
    want = brute_paths(data)
    assert rows(tree.levels(doubled)) == rows(tree.levels(df))
    assert rows(tree.expand(doubled).select("id", "path")) == rows(tree.expand(df).select("id", "path"))
    assert rows(tree.drop_orphans(doubled)) == rows(tree.drop_orphans(df))
    got = {r["id"]: (r["position"], r["size"]) for r in tree.spans(doubled).collect()}
    by_thread = {}
    for row in data:
        if row[1] in want:
            by_thread.setdefault(row[0], []).append(row[1])
    expected = {}
    for ids in by_thread.values():
        for place, i in enumerate(sorted(ids, key=lambda i: want[i])):
            expected[i] = (place, sum(want[j][: len(want[i])] == want[i] for j in ids))
    assert got == expected


def test_a_chain_of_a_hundred_thousand_comments(spark):
    n = 100_000
    chain = spark.range(n).select(F.lit(1).alias("thread_id"), "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    got = tree.levels(chain, [F.col("id")])
    assert [t for _, t in got.dtypes if t.startswith("array")] == []
    assert got.filter("level = id").count() == n


def test_word_counts_of_repeated_ids_and_without_shuffling_rows(spark):
    data = spark.createDataFrame(
        [(1, "g", "a b a"), (2, "g", "a"), (2, "g", "a c"), (2, "h", "a"), (None, "g", "a b"), (3, "g", None)],
        "id bigint, subreddit string, text string")
    assert rows(lx.word_counts(data)) == [("g", "a", 5, 2), ("g", "b", 2, 1), ("g", "c", 1, 1), ("h", "a", 1, 1)]
    many = spark.range(2000).select("id", F.lit("g").alias("subreddit"), F.lit("a b c").alias("text"))
    plan = lx.word_counts(many)._jdf.queryExecution().executedPlan().toString()
    placed = [line for line in plan.splitlines() if "hashpartitioning" in line and "word" in line and "id#" in line]
    assert len(placed) <= 1  # only that of the rows that share an id


def test_grams_of_all_lengths_are_made_in_one_pass_each(spark):
    """Arrays were paired once per place, which made the shorter grams again for every longer one."""
    texts = ["", "a", "a b", "the of a b the of", " lead and trail ", "x y z x y z", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for stop, sizes in (((), (1, 2, 3)), (("the", "of"), (1, 2, 3)), (("the",), (3, 1)), ((), (2, 5))):
        got = ng.all_grams(df, stop, sizes, keep=["id"])
        want = set()
        for i, t in enumerate(texts):
            w = [] if t is None else t.split(" ")
            for n in sizes:
                grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
                want |= {(i, n, "_".join(g)) for g in grams if not (n < 3 and all(x in stop for x in g))}
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert "zip_with" not in got._jdf.queryExecution().optimizedPlan().toString()
