"""Corpus operators against brute force, round trips and planted cases; edge cases of every operator."""

import collections
import os
import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from forumlens.llm import (
    hash_ring, histogram_topk, html_blocks, license_join, line_suffixes, order_minhash, queries, rollups, toxicity, unigram, winnowing)
from forumlens.llm.text import words, words_of
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


def docs(spark, texts, extra=""):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", "1 AS node", "'x' AS th", "2 AS shard", "3 AS score", "4 AS start")  # clashing names


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n)]


def test_words_agree_with_the_rule(spark):
    texts = ["Ab-cÉÀ ß9_Z", "", None, "...", "A\x00b", "日本 Ünï\tX"]
    rule = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = {k: k + 32 for k in range(65, 91)}
    want = [rule.findall((t or "").translate(fold)) for t in texts]
    assert [[w.decode() for w in words_of(t)] for t in texts] == want
    assert [r[0] for r in docs(spark, texts).orderBy("doc_id").select(words(F.col("text"))).collect()] == want


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, cur.fetchall()))


def test_near_duplicates_equal_brute_force(spark):
    base = prose(1, 300)
    texts = [" ".join(base)]
    for k in range(30):  # near copies, close to the threshold on either side
        near = list(base)
        for j in range(k % 8):
            near[(37 * (k + 1) * (j + 1)) % 300] = f"new{k}x{j}"
        texts.append(" ".join(near))
    texts += [" ".join(prose(2, 40)), " ".join(prose(3, 3)), " ".join(prose(3, 3)).upper(), "", "", "!!!", None, None, texts[0]]
    frame = docs(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(frame).collect()}
    parent = list(range(len(texts)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    for a in range(len(texts)):
        for b in range(a):
            if texts[a] is None or texts[b] is None:
                continue
            x, y = words_of(texts[a]), words_of(texts[b])
            alike = texts[a] == texts[b] if not x or not y else len(grams(x) & grams(y)) >= 0.8 * len(grams(x) | grams(y))
            if alike:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in range(len(texts))}
    kept = [r["doc_id"] for r in order_minhash.drop_near_duplicates(frame.unionAll(frame)).collect()]
    assert sorted(kept) == sorted([i for i in range(len(texts)) if find(i) == i and texts[i] is not None] + [i for i, t in enumerate(texts) if t is None] * 2)


def test_near_duplicates_of_different_repetition_equal_brute_force(spark):
    texts = []
    for k in range(12):  # the same shingles, in pairs 10 times and 40 times or once and 30 times
        base = prose(100 + k, 40)
        texts += [" ".join(base * n + base[:4]) for n in ((10, 40) if k % 2 else (1, 30))]
    texts += [" ".join((prose(200, 40)) * 10), " ".join((prose(201, 40)) * 10)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == {i: i - i % 2 if i < 24 else i for i in range(26)}


def test_order_matters_to_the_alignment():
    a = order_minhash.shingles(order_minhash.word_hashes(" ".join(prose(5, 200))))
    assert order_minhash.similarity(a, a) == 1
    assert order_minhash.similarity(a, a[::-1].copy()) < 0.1


def brute_lines(texts, least):
    lines = [[x.strip(" ") for x in t.split("\n") if x.strip(" ")] for t in texts]
    at = collections.defaultdict(list)
    for a, d in enumerate(lines):
        for b, x in enumerate(d):
            at[x].append((a, b))
    out = []
    for a, d in enumerate(lines):
        gone = set()
        for b in range(len(d)):
            best = 0
            for a2, b2 in at[d[b]]:
                if (a2, b2) >= (a, b):
                    break
                n = 0
                while b + n < len(d) and b2 + n < len(lines[a2]) and d[b + n] == lines[a2][b2 + n]:
                    n += 1
                best = max(best, n)
            if best and sum(x.count(" ") + 1 for x in d[b : b + best]) >= least:
                gone.update(range(b, b + best))
        out.append([x for b, x in enumerate(d) if b not in gone])
    return out


def test_line_runs_equal_brute_force(spark):
    rng = random.Random(7)
    pool = [" ".join(prose(k, 4)) for k in range(6)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 25))) for _ in range(25)]
    texts += ["\n".join(["again and again"] * 40), "", "one line", "  \n\n ", "\n".join(f"own {i}" for i in range(9))]
    frame = docs(spark, texts)
    got = {r["doc_id"]: r["text"] for r in line_suffixes.drop_repeated_runs(frame.union(frame.limit(3)), min_words=12).collect()}
    want = brute_lines(texts, 12)
    assert [[x.strip(" ") for x in got[i].split("\n") if x.strip(" ")] for i in range(len(texts))] == want
    empty = docs(spark, [None])
    assert [r["text"] for r in line_suffixes.drop_repeated_runs(empty).collect()] == [None]
    assert line_suffixes.drop_repeated_runs(empty.limit(0)).count() == 0


def test_licenses_across_block_edges(spark):
    filler = lambda n: " ".join(["word"] * n)
    texts = [filler(n) + " under The\nMIT license " + filler(3) for n in (0, 62, 63, 126, 127, 500)] + [None, "", "under the mit"]
    texts.append(license_join.TEMPLATES["bsd"].upper().replace("FORMS", "kinds"))
    got = sorted(license_join.license_labels(docs(spark, texts)).collect())
    assert [(r["n_base"], r["first_word"], r["base_labels"]) for r in got[:6]] == [(1, n, "mit") for n in (0, 62, 63, 126, 127, 500)]
    assert [(r["n_words"], r["n_base"], r["labels"], r["score"]) for r in got[6:9]] == [(0, 0, "", 0), (0, 0, "", 0), (3, 0, "", 0)]
    assert got[9]["labels"] == "bsd" and 0.8 <= got[9]["score"] < 1


needs_model = pytest.mark.skipif(not os.path.exists(unigram.MODEL), reason="no model file")


@needs_model
def test_pieces_round_trip_and_are_the_best_path(spark):
    texts = ["  Hello  wörld\n", "", None, "▁ mark ▁▁x", "日本語 naïve\t" + "z" * 3000, "a" * 70, " "]
    coded = unigram.decode(unigram.encode(docs(spark, texts).select("doc_id", "text"))).orderBy("doc_id").collect()
    assert [r["decoded"] for r in coded] == texts
    pieces, decoded = unigram.load()
    known = {d: pieces for d in decoded}
    score = {}
    for s in range(len(pieces.check)):
        if pieces.piece[s] >= 0:
            score[decoded[pieces.piece[s]].replace(b" ", "▁".encode())] = float(pieces.score[s])
    for word in ["▁thanedble", "zzqé", "▁▁▁x", "ſtrange"]:
        best = [0.0] + [-1e18] * len(word)
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                s = score.get(word[i:j].encode(), pieces.unknown if j == i + 1 else None)
                if s is not None:
                    best[j] = max(best[j], best[i] + s)
        ids = pieces.paths([word.encode()])[0]
        total, k = 0.0, 0
        while k < len(ids):
            text = decoded[ids[k]].replace(b" ", "▁".encode())
            if text in score:
                total, k = total + score[text], k + 1
            else:  # the bytes of one character
                n = 1
                while b"".join(decoded[i] for i in ids[k : k + n]).decode(errors="ignore") == "":
                    n += 1
                total, k = total + pieces.unknown, k + n
        assert abs(total - best[-1]) < 1e-6
    assert known


def test_shards_are_even_and_equal_the_walk_row_by_row(spark):
    texts = [f"t{i}" for i in range(203)] + [None, "", "hot"]
    frame = docs(spark, texts)
    frame = frame.union(frame.filter("text = 'hot'").crossJoin(spark.range(100)).drop("id"))
    rows = hash_ring.assign(frame).collect()
    assert len(rows) == 306
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert hash_ring.assign(frame.limit(0)).count() == 0


def test_few_rows_move_when_a_shard_is_added(spark):
    frame = docs(spark, [f"t{i}" for i in range(2000)])
    one = {r["doc_id"]: r["shard"] for r in hash_ring.assign(frame, 8).collect()}
    two = {r["doc_id"]: r["shard"] for r in hash_ring.assign(frame, 9).collect()}
    assert sum(one[k] != two[k] for k in one) < 0.4 * len(one)


def test_rollups_are_idempotent(spark, tmp_path):
    frame = docs(spark, ["a b", "c", None, ""])
    store = rollups.Store(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    one = rollups.facts(frame, "v1", rollups.word_tokens)
    assert store.commit("b1", rollups.changes(one, 1)) and not store.commit("b1", rollups.changes(one, 1))
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v1", 4, 3, 4)]
    with pytest.raises(ValueError):
        store.commit("b1", rollups.changes(one, -1))
    two = rollups.facts(frame.withColumn("text", F.lit("x y z")), "v1", rollups.word_tokens)
    store.commit("b2", rollups.revision(one, two))
    assert [r["n_tokens"] for r in store.totals().collect()] == [12]
    store.commit("b3", rollups.changes(two, -1))
    store.commit("b4", rollups.changes(two.limit(0), 1))
    assert store.totals().count() == 0


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("<p>a &amp; b", "a & b"), ("plain <b>te</b>xt", "plain text"),
    ("<nav><ul><li>Home</li></ul></nav><article><h1>T</h1><p>x<br>y</p><aside>no</aside><p>z</p></article><footer>f</footer>", "T\n\nx y\n\nz"),
    ("<main><header><h1>T</h1></header><p>one</p><div class='comments'><p>me too</p></div></main>", "T\n\none"),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><div id='cookie-notice'>ok?</div><article><p>body</article><form><p>mail</form>", "body"),
    ("<div class='menu'><a href=x>a</a></div><div><p>" + "long text " * 20 + "</p><p>s</p></div><div class=footer>c</div>", "long text " * 19 + "long text\n\ns"),
])
def test_main_text(html, want):
    assert html_blocks.main_text(html) == want


BODY, CARD = "long text " * 30 + "end", "a card of some words"


@pytest.mark.parametrize("html,want", [
    (f"<main class='has-sidebar'><p>{BODY}</p></main>", BODY),
    (f"<div class='content no-sidebar'><p>{BODY}</p></div>", BODY),
    (f"<article class='post comments-open'><p>{BODY}</p></article>", BODY),
    (f"<article class=widget><p>{BODY}</p></article>", BODY),
    (f"<div class=widget><p>{BODY}</p></div><p>x</p>", BODY + "\n\nx"),
    (f"<div class=modal><article><p>{BODY}</p></article></div><div><p>{CARD}</p></div>", BODY),
    (f"<div><p>{BODY}</p></div>" + f"<article><p>{CARD}</p></article>" * 9, BODY),
    (f"<article><p>{BODY}</p></article><div class='cookie-notice'><p>{BODY * 3}</p></div>", BODY),
    (f"<article><p>{BODY}</p><article class=comment><p>{CARD}</p></article></article><div><p>{CARD}</p></div>", BODY),
    (f"<p>{BODY}</p><div id=site-comments><p>{BODY * 5}</p></div>", BODY),
    (f"<p>{BODY}</p>" + "<div class=ad>ad</div>" * 3 + "<p>short</p>" + "<div class=ad>ad</div>" * 3 + f"<p>{BODY}</p>", BODY + "\n\nshort\n\n" + BODY),
])
def test_main_text_of_other_pages(html, want):
    assert html_blocks.main_text(html) == want


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(300, 8)).tolist()
    rows = [(i, v) for i, v in enumerate(vecs)] + [(i, vecs[7]) for i in range(300, 420)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 6), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (1020, [1e6] * 8), (0, vecs[0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = histogram_topk.integers(frame)
    got = collections.defaultdict(list)
    for r in histogram_topk.top_k(v, v.filter("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    fine = {i: [int(np.floor(64 * x)) for x in e] for i, e in rows if i < 1000 or i == 1020}
    for q in [i for i in fine if i % 20 == 0]:
        scores = sorted(((sum(a * b for a, b in zip(fine[q], fine[c])), c) for c in fine if c != q), key=lambda s: (-s[0], s[1]))[:20]
        assert got[q] == [(c, s) for s, c in scores]
    assert len(got) == len([i for i in fine if i % 20 == 0])
    few = v.filter("vec_id < 3")
    assert histogram_topk.top_k(few, few, 20).count() == 6


@needs_tables
def test_top_k_of_very_different_spans_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    vecs = rng.normal(size=(500, 8))
    vecs *= (1 / np.linalg.norm(vecs, axis=1) * 10.0 ** rng.integers(-2, 4, 500))[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    table = histogram_topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = collections.defaultdict(list)
    for r in sorted(histogram_topk.top_k(table, table.filter("vec_id < 40"), 20).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(vecs * histogram_topk.SCALE).astype(np.int64)
    scores = whole[:40] @ whole.T
    assert len({int(np.log2(s.max() - s.min()) // np.log2(histogram_topk.BINS)) for s in scores}) > 1  # numbers of passes differ
    for q in range(40):
        best = sorted((-int(scores[q, c]), c) for c in range(500) if c != q)[:20]
        assert got[q] == [(n + 1, c, -s) for n, (s, c) in enumerate(best)]


def test_toxicity_is_learned_and_ignores_identity(spark):
    data = "/root/testdata/sf0.01"
    frame, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op9_toxicity(spark, data).join(labels, "doc_id").filter("held_out")
    right, n = got.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert right / n > 0.9
    assert frame.count() == queries.op9_toxicity(spark, data).count()


def test_swapped_identity_terms_move_scores_less():
    rng = random.Random(1)
    # Feature 0: an insult; 1 and 2: two groups, the first of them named in most toxic rows.
    rows = []
    for _ in range(600):
        bad = rng.random() < 0.5
        group = 1 if rng.random() < (0.9 if bad else 0.2) else 2
        insult = [0] if bad and rng.random() < 0.7 else []
        rows.append((int(bad), [*insult, group], [*insult, 3 - group]))
    plain, _ = toxicity.fit(rows, 3, counterfactual=0.0)
    fair, _ = toxicity.fit(rows, 3, counterfactual=4.0)
    assert abs(fair[1] - fair[2]) < 0.3 * abs(plain[1] - plain[2]) and fair[0] > 1


def test_toxicity_without_labels(spark):
    frame = docs(spark, ["a", None, ""])
    model = toxicity.train(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["predicted"] for r in toxicity.score(frame, model).collect()} == {0}
    assert toxicity.drop_toxic(frame, spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")).count() == 3


def test_contamination_with_short_items_and_edges(spark):
    passage = prose(11, 14)
    items = [(1, " ".join(passage)), (2, "Tiny Item"), (3, None), (4, "..."), (11, " ".join(passage).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["x " + " ".join(passage[2:13]) + " y", " ".join(passage[:9]), "a tiny, item tiny item", None, "", " ".join(passage * 2), "tiny"]
    got = {r["doc_id"]: r for r in winnowing.contamination(docs(spark, texts), bench).collect()}
    assert [(got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) for i in range(7)] == [
        (13, 11, 2), (9, 0, 0), (5, 4, 1), (0, 0, 0), (0, 0, 0), (28, 28, 2), (1, 0, 0)]
    assert winnowing.contamination(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0
    assert sorted(r["doc_id"] for r in winnowing.drop_contaminated(docs(spark, texts), bench).collect()) == [1, 3, 4, 6]


@needs_tables
def test_pipeline_runs_and_keeps_document_columns(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == frame.columns, name
    done = corpus_pipeline.run(spark, SF).collect()
    assert done and all(r["round_trip"] for r in done)
