"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import (
    chunked_bpe,
    hash_ring,
    hat_trie,
    histogram_topk,
    html_blocks,
    importance,
    license_join,
    line_suffixes,
    order_minhash,
    rollups,
    toxicity,
    unigram,
    winnowing,
)
from forumlens.llm.text import table
from forumlens.session import scratch_path


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; ``keep`` marks the one that stays."""
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated line runs."""
    return line_suffixes.drop_repeated_runs(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed", "n_left")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.license_labels(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to the very text."""
    coded = unigram.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_ring.assign(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: load, a recount of all documents under a second version that keeps the first, a revision
    of the second version's counts from blank-separated to word counts for English, and the deletion of later exact copies;
    each batch is committed twice."""
    docs = table(spark, sf_dir, "documents")
    store = rollups.Store(spark, scratch_path(spark, "token_counts"))
    one = rollups.facts(docs, "words-1", rollups.word_tokens)
    blank = rollups.facts(docs, "mixed-1", rollups.blank_tokens)
    worded = one.withColumn("version", F.lit("mixed-1"))
    keys = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), F.col("text").isNull().alias("none"))
    first = keys.groupBy("h1", "h2", "none").agg(F.min("doc_id").alias("_first"))
    copies = keys.join(first, ["h1", "h2", "none"]).filter(F.col("doc_id") > F.col("_first")).select(F.col("doc_id").alias("_id"))
    gone = one.join(copies, F.col("doc_id") == F.col("_id"), "left_semi")
    english = F.col("lang") == "en"
    batches = {
        "load": rollups.changes(one, 1),
        "second-version": rollups.changes(blank, 1),
        "english-words": rollups.revision(blank.filter(english), worded.filter(english)),
        "copies": rollups.changes(gone, -1),
    }
    for batch, signed in batches.items():
        store.commit(batch, signed)
    store.commit("load", batches["load"])
    return store.totals()


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = histogram_topk.integers(table(spark, sf_dir, "embeddings"))
    return histogram_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("th")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return hat_trie.collocations(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark, and the rank of those drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    coded = chunked_bpe.decode(chunked_bpe.encode(table(spark, sf_dir, "documents"), ["doc_id"]))
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_line_dedup, op3_license_scan, op4_sentencepiece, op5_sharding, op6_token_counts,
    op7_html_text, op8_top_k, op9_toxicity, op10_decontamination, op11_collocations, op12_importance, op13_byte_bpe)}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_FOLD}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

_TEN = "[word, " + ", ".join(f"lead(word, {k}) OVER o" for k in range(1, 10)) + "]"


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = [(label, license_join.template_words(p), 1.0, True) for p, label in license_join.BASE.items()]
    rows += [(label, license_join.template_words(t), license_join.THRESHOLD, False) for label, t in license_join.TEMPLATES.items()]
    listed = ", ".join(f"({quote(a)}, [{', '.join(map(quote, w))}], {t}, {str(b).lower()})" for a, w, t, b in rows)
    step = license_join.STRIDE
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d),
t(label, ws, threshold, base) AS (VALUES {listed}),
tw AS (SELECT DISTINCT label, unnest(ws) AS word FROM t WHERE NOT base),
need AS (SELECT label, len(list_distinct(ws)) AS m, ceil(threshold * len(list_distinct(ws)) - 1e-9) AS need FROM t WHERE NOT base),
held AS (SELECT doc_id, label, b, count(DISTINCT word) AS common
  FROM (SELECT doc_id, label, word, unnest([i // {step}, i // {step} - 1]) AS b FROM w JOIN tw USING (word)) WHERE b >= 0 GROUP BY ALL),
hit AS (SELECT doc_id, label, max(common / CAST(m AS DOUBLE)) AS share FROM held JOIN need USING (label) WHERE common >= need GROUP BY ALL),
run AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o] AS next
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
place AS (SELECT doc_id, label, i FROM run JOIN t ON base AND next[1 : len(ws)] = ws),
found AS (SELECT doc_id, label, share FROM hit UNION ALL SELECT DISTINCT doc_id, label, 1.0 FROM place)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(p.n, 0) AS n_base, p.a AS first_word, p.z AS last_word,
  coalesce(p.l, '') AS base_labels, coalesce(f.l, '') AS labels, coalesce(f.s, 0.0) AS score
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS l FROM place GROUP BY doc_id) p USING (doc_id)
  LEFT JOIN (SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS l, max(share) AS s FROM found GROUP BY doc_id) f USING (doc_id)"""


ORACLES = {
    "op3_license_scan": _license_sql(),
    "op6_token_counts": f"""
WITH c AS (SELECT *, len({_WORDS}) AS words, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda x: x <> '')) AS blanks,
    coalesce(length(text), 0) AS chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS copy FROM documents)
SELECT source, lang, 'words-1' AS version, count(*) AS n_docs, CAST(sum(words) AS BIGINT) AS n_tokens, CAST(sum(chars) AS BIGINT) AS n_chars
FROM c WHERE NOT copy GROUP BY ALL
UNION ALL
SELECT source, lang, 'mixed-1', count(*), CAST(sum(CASE WHEN lang = 'en' THEN words ELSE blanks END) AS BIGINT), CAST(sum(chars) AS BIGINT)
FROM c GROUP BY ALL""",
    "op8_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bp AS (SELECT item_id, least(len(ws), 10) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM b),
bw AS (SELECT DISTINCT item_id, n, win FROM (SELECT item_id, n, {_TEN} [1 : n] AS win FROM bp WINDOW o AS (PARTITION BY item_id ORDER BY i))
  WHERE win[n] IS NOT NULL),
dp AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d),
dt AS (SELECT doc_id, i, {_TEN} AS ten FROM dp WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
dw AS (SELECT doc_id, i, n, ten[1 : n] AS win FROM dt, (SELECT DISTINCT n FROM bw)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_collocations": f"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLD}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
q AS (SELECT lang, row_number() OVER () AS piece_id, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
w AS (SELECT lang, piece_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM q),
r AS (SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY piece_id ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM r GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM r WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM r WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
cut AS (
  SELECT two.lang, two.w1 || ' ' || w2 AS phrase, two.f AS a, 1 AS k, x.f AS l, y.f AS r FROM two
  JOIN one x ON x.lang = two.lang AND x.w1 = two.w1 JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
  WHERE NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.w1 = two.w1 AND t.w2 = two.w2 AND 100 * t.f >= 50 * two.f)
    AND NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.w2 = two.w1 AND t.w3 = two.w2 AND 100 * t.f >= 50 * two.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f FROM three t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f FROM three t
  JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best JOIN total USING (lang) QUALIFY rank <= 2000""",
    "op12_importance": f"""
WITH both_ AS (SELECT doc_id AS id, 's' AS side, {_WORDS} AS ws FROM documents UNION ALL SELECT NULL, 't', {_WORDS} FROM benchmark),
x AS (SELECT row_number() OVER () AS row_id, * FROM both_),
w AS (SELECT row_id, side, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM x),
r AS (SELECT row_id, side, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY row_id ORDER BY i)),
f AS (SELECT row_id, side, word AS feature FROM r UNION ALL SELECT row_id, side, word || ' ' || w2 FROM r WHERE w2 IS NOT NULL
  UNION ALL SELECT row_id, side, word || ' ' || w2 || ' ' || w3 FROM r WHERE w3 IS NOT NULL),
table_ AS (SELECT list(v ORDER BY b) AS v FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b))),
names AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM f)),
hashed AS (SELECT feature, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2),
    lambda k: CAST('0x' || h[2 * k + 1 : 2 * k + 2] AS BIGINT))), lambda c, y: xor(c >> 8, v[1 + (xor(c, y) & 255)])), 4294967295) AS BIGINT) % 10000 AS bucket
  FROM names, table_),
b AS (SELECT row_id, side, bucket, count(*) AS n FROM f JOIN hashed USING (feature) GROUP BY ALL),
s AS (SELECT bucket, sum(n) AS s FROM b WHERE side = 's' GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM b WHERE side = 't' GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s_all, coalesce((SELECT sum(t) FROM t), 0) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), total),
weight AS (SELECT row_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM b JOIN gain USING (bucket) WHERE side = 's' GROUP BY row_id),
d AS (SELECT id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || id)[1 : 8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM x LEFT JOIN weight USING (row_id) WHERE side = 's'),
e AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM d WHERE n_words >= 20)
SELECT d.doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM d LEFT JOIN e USING (doc_id)""",
}
