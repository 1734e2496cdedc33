"""Nothing of a text or label is cut off or dropped: white space, long words, unusual labels, very many lines."""

import random
import time

from forumlens.llm import html_blocks, line_suffixes, order_minhash, toxicity, unigram, winnowing
from forumlens.llm.text import words_of
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def test_copies_with_other_white_space_are_removed(spark):
    lines = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(3)]
    texts = ["\n".join(lines), "\r\n".join(lines) + "\r\n", "\t\n".join(lines) + "\t", "\n".join(x.replace(" ", "\t") for x in lines),
             "\n".join(x.replace(" ", "\u00a0") for x in lines), "\n".join(x.replace(" ", "  ") for x in lines), "own\n" + lines[0]]
    got = {r["doc_id"]: (r["n_removed"], r["n_left"]) for r in line_suffixes.drop_repeated_runs(docs(spark, texts)).collect()}
    assert got == {0: (0, 3), **{k: (3, 0) for k in range(1, 6)}, 6: (0, 2)}
    long_line = "\t".join(f"v{i}" for i in range(60))
    got = {r["doc_id"]: r["n_left"] for r in line_suffixes.drop_repeated_runs(docs(spark, [long_line, "a\n" + long_line + "\r"])).collect()}
    assert got == {0: 1, 1: 1}


def test_words_equal_in_their_first_64_bytes_are_two_features():
    features = toxicity.Features()
    a, b = b"q" * 99 + b"a", b"q" * 99 + b"b"
    assert features.of_word(a) != features.of_word(b)


def test_labels_other_than_0_and_1(spark):
    frame = docs(spark, ["bad word here", "good word there", "bad again", "fine"] * 10)
    labels = spark.createDataFrame([(i, 1, [7, 0, 2, -1][i % 4]) for i in range(40)], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model).collect()}
    assert len(got) == 40 and got[0] > got[1] and got[2] > got[3]


def test_many_lines_take_linear_time():
    page = lambda n: "<html><body><article>" + "<p>one line of text here</p>" * n + "</article></body></html>"
    seconds = []
    for n in (5_000, 50_000):
        began = time.process_time()
        assert html_blocks.main_text(page(n)).count("one line") == n
        seconds.append(time.process_time() - began)
    assert seconds[1] < 30 * seconds[0]


def brute_contamination(texts, items):
    out = []
    for t in texts:
        ws, hit, found = words_of(t), set(), set()
        for item, content in items:
            own = words_of(content)
            n = min(10, len(own))
            windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
            for i in range(len(ws) - n + 1 if n else 0):
                if tuple(ws[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((len(ws), len(hit), len(found)))
    return out


def test_contamination_equals_brute_force_at_every_item_length(spark):
    base = [f"b{k % 17}" for k in range(60)]
    items = [(n, " ".join(base[n : 2 * n])) for n in range(1, 15)] + [(20, None), (21, " ".join(base[:30])), (22, " ".join(base[:30]))]
    texts = [" ".join(base), " ".join(base[5:16]), " ".join(base[3:12]), "b1", None, "", "x " * 5000 + " ".join(base[:12]), " ".join(base[:9]) + " z " + " ".join(base[9:])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(spark, texts)
    got = sorted(winnowing.contamination(frame, bench).select("doc_id", "n_words", "n_hit", "n_items").collect())
    assert [tuple(r)[1:] for r in got] == brute_contamination(texts, items)
    assert winnowing.contamination(frame.limit(0), bench).count() == 0
    assert winnowing.contamination(frame.unionAll(frame), bench).count() == 2 * len(texts)


def test_long_and_short_cuts_have_the_same_best_path(spark):
    pieces, decoded = unigram.load()
    cuts = ["▁" + "the" * 100, "▁日本語" * 60, "▁" + "zq" * 250, "x" * 500]
    raw = [c.encode() for c in cuts]
    assert [p.tolist() for p in pieces.paths(raw)] == [memoryview(pieces._path(c)).cast("i").tolist() for c in raw]
    text = "日本語のテキスト" * 3000 + " plain words " + "a" * 40_000
    encoder = unigram.Encoder(pieces)
    flat, ends = encoder.encode([text, "", "plain words", text])
    assert unigram.decode_ids(flat[: ends[0]].tolist(), decoded) == text and ends[0] == ends[1]
    assert flat[ends[2] :].tolist() == flat[: ends[0]].tolist()
    coded = unigram.encode(docs(spark, [text, None, ""] * 3), decoded="decoded").collect()
    assert [r["decoded"] for r in coded] == [text, None, ""] * 3
    assert unigram.encode(docs(spark, [])).count() == 0


def test_near_copies_around_the_threshold_equal_brute_force(spark):
    """One base, edited so that many pairs are just above or below the threshold: bounds must not lose a link."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    texts = []
    for k in range(140):
        ws = list(base)
        for at in rng.sample(range(150), 1 + k % 7):
            ws[at] = f"x{k}y{at}" if k % 3 else f"z{at}"  # some edits are shared
        texts.append(" ".join(ws[: 150 - k % 11]))
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(words_of, texts)]
    label = list(range(len(texts)))
    find = lambda x: x if label[x] == x else find(label[x])
    links = 0
    for a in range(len(texts)):
        for b in range(a):
            if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                links += 1
                label[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == {k: find(k) for k in range(len(texts))} and links > 100 and len(set(got.values())) > 3


def test_leaders_and_members_make_a_pair_once_in_however_many_buckets_they_meet(spark):
    """60 nodes meet in 16 buckets: a join by bucket made each pair up to 32 times."""
    members = spark.range(60).selectExpr(
        "CAST(id AS STRING) AS node", "10L AS n", "10L AS nd", "0L AS u", "0L AS ud", "CAST(NULL AS ARRAY<BIGINT>) AS b", "CAST(NULL AS ARRAY<BIGINT>) AS bd",
        "0L AS p", "0L AS pd", "CAST(id AS STRING) AS label", "explode(sequence(0L, 15L)) AS bucket").filter(
        "(bucket + CAST(node AS INT)) % 5 > 0")
    for led, most in ((members, 1), (members.filter("CAST(node AS INT) < bucket"), 2)):
        led = led.select("bucket", "node")
        got = order_minhash._leader_pairs(order_minhash._meetings(members, led), 0.8)
        a, b = led.toDF("bucket", "i"), members.select("bucket", F.col("node").alias("j"))
        want = {tuple(sorted(r)) for r in a.join(b, "bucket").filter("i != j").select("i", "j").collect()}
        rows = [tuple(r) for r in got.collect()]
        assert set(rows) == want and len(rows) <= most * len(want)
