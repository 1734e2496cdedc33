"""Queries on n-grams, membership similarity and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.operators import cluster as cl
from forumlens.operators import ngrams as ng
from forumlens.operators import similarity as sim
from forumlens.operators import stats
from forumlens.session import freeze
from forumlens.workload.registry import query

# ---- n-grams -------------------------------------------------------------------------------

# The caller's stop words.
STOP = ["", "the", "of", "and", "in", "to", "is", "on", "der", "die", "de", "le", "und", "la"]
VOCAB = ng.VOCAB_SIZES
COLUMNS = sum(VOCAB.values())
# Grams a task of the profiles' product takes: its keys are some fifty, not the seven of the default.
GRAM_PANEL = 128

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
WORDS = r"""words AS (SELECT id, subreddit, STRING_SPLIT(REGEXP_REPLACE(LOWER(REGEXP_REPLACE(text, '[^\x00-\x7F]', '', 'g')),
    '[!?_^.*|`\[\] \n\r,():/]+', ' ', 'g'), ' ') AS w FROM texts)"""


def gram_sql(n: int, stop: bool) -> str:
    starts = f"RANGE(1, LEN(w) - {n} + 2)"
    if stop and n == 1:
        starts = f"LIST_FILTER({starts}, lambda i: NOT LIST_CONTAINS({STOP_SQL}, w[i]))"
    if stop and n == 2:
        starts = f"LIST_FILTER({starts}, lambda i: NOT (LIST_CONTAINS({STOP_SQL}, w[i]) AND LIST_CONTAINS({STOP_SQL}, w[i + 1])))"
    return f"LIST_DISTINCT(LIST_TRANSFORM({starts}, lambda i: ARRAY_TO_STRING(w[i:i + {n - 1}], '_')))"


def exploded(stop: bool) -> str:
    parts = [f"SELECT id, subreddit, {n} AS n, UNNEST({gram_sql(n, stop)}) AS gram FROM words" for n in (1, 2, 3)]
    return " UNION ALL ".join(parts)


DF = f"df AS (SELECT n, gram, COUNT(*) AS count FROM ({exploded(True)}) g GROUP BY n, gram)"


def vocab_sql(sizes: dict[int, int]) -> str:
    limit = "CASE n " + " ".join(f"WHEN {n} THEN {k}" for n, k in sizes.items()) + " END"
    return f"""voc AS (SELECT n, gram, count FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY n ORDER BY count DESC, gram) AS rk
      FROM df) r WHERE rk <= {limit})"""


COUNTS = f"""cnt AS (SELECT g.subreddit, g.n, g.gram, COUNT(*) AS count FROM ({exploded(False)}) g
    JOIN voc v ON v.n = g.n AND v.gram = g.gram GROUP BY g.subreddit, g.n, g.gram)"""
SHARE = "shr AS (SELECT subreddit, gram, count / CAST(SUM(count) OVER (PARTITION BY gram) AS DOUBLE) AS share FROM cnt)"
DICE = """norm AS (SELECT subreddit, SUM(share * share) AS q FROM shr GROUP BY subreddit),
    dice AS (SELECT a.subreddit AS i, b.subreddit AS j, 2 * SUM(a.share * b.share) / (MIN(p.q) + MIN(q.q)) AS similarity
      FROM shr a JOIN shr b ON a.gram = b.gram AND a.subreddit < b.subreddit
      JOIN norm p ON p.subreddit = a.subreddit JOIN norm q ON q.subreddit = b.subreddit GROUP BY 1, 2)"""
UP_TO_COUNTS = f"WITH {WORDS}, {DF}, {vocab_sql(VOCAB)}, {COUNTS}"


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def vocabulary(t, sizes=VOCAB):
    """All texts are counted; the frequencies in a sixteenth of them only bound how rare a vocabulary gram can be."""
    some = t.texts.filter(F.pmod(F.xxhash64("text"), F.lit(16)) == 0)
    return ng.vocab(ng.doc_freq(t.texts, STOP), sizes, ng.doc_freq(some, STOP))


def counted(t, sizes=VOCAB):
    return ng.group_counts(t.texts, vocabulary(t, sizes))


@query("clean_tokens", f"WITH {WORDS} SELECT id, ARRAY_TO_STRING(w, ' ') AS words, LEN(w) AS size FROM words")
def clean_tokens(t):
    words = t.texts.select("id", ng.clean("text").alias("w"))
    return words.select("id", F.array_join("w", " ").alias("words"), F.size("w").cast("bigint").alias("size"))


@query("ngrams_distinct", f"WITH {WORDS} SELECT id, n, COUNT(*) AS grams, SUM(LENGTH(gram)) AS chars FROM ({exploded(False)}) g GROUP BY id, n")
def ngrams_distinct(t):
    rows = [ng.grams(t.texts, n, keep=["id"]) for n in (1, 2, 3)]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.groupBy("id", "n").agg(F.count(F.lit(1)).alias("grams"), F.sum(F.length("gram")).alias("chars"))


@query("ngram_stop_rules", f"WITH {WORDS} SELECT id, n, COUNT(*) AS grams, SUM(LENGTH(gram)) AS chars FROM ({exploded(True)}) g GROUP BY id, n")
def ngram_stop_rules(t):
    rows = [ng.grams(t.texts, n, STOP, keep=["id"]) for n in (1, 2, 3)]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.groupBy("id", "n").agg(F.count(F.lit(1)).alias("grams"), F.sum(F.length("gram")).alias("chars"))


query("ngram_df", f"WITH {WORDS}, {DF} SELECT * FROM df")(lambda t: ng.doc_freq(t.texts, STOP))
query("ngram_vocab", f"WITH {WORDS}, {DF}, {vocab_sql(VOCAB)} SELECT * FROM voc")(
    vocabulary
)
query("group_ngram_counts", f"{UP_TO_COUNTS} SELECT * FROM cnt")(counted)


@query(
    "group_ngram_matrix",
    f"""WITH {WORDS}, {DF}, {vocab_sql(VOCAB)}, {COUNTS},
    cells AS (SELECT s.subreddit, v.rk, COALESCE(c.count, 0) AS count FROM (SELECT DISTINCT subreddit FROM texts) s
      CROSS JOIN (SELECT gram, n, ROW_NUMBER() OVER (ORDER BY n, count DESC, gram) AS rk FROM voc) v
      LEFT JOIN cnt c ON c.subreddit = s.subreddit AND c.gram = v.gram AND c.n = v.n)
    SELECT subreddit, {', '.join(f'CAST(SUM(CASE WHEN rk = {k} THEN count END) AS BIGINT) AS gram_{k}' for k in range(1, COLUMNS + 1))}
    FROM cells GROUP BY subreddit""",
)
def group_ngram_matrix(t):
    """The gram names depend on the data, so the columns are numbered for the comparison."""
    voc = vocabulary(t)
    names = ng.vocab_columns(voc)
    wide = ng.matrix(ng.group_counts(t.texts, voc), t.texts, names)
    missing = [F.lit(None).cast("bigint").alias(f"gram_{k}") for k in range(len(names) + 1, COLUMNS + 1)]
    return wide.toDF("subreddit", *[f"gram_{k}" for k in range(1, len(names) + 1)]).select("*", *missing)


query("gram_share", f"{UP_TO_COUNTS}, {SHARE} SELECT subreddit, gram, ROUND(share, 6) AS share FROM shr")(
    lambda t: rounded(ng.share(counted(t)), "share")
)
query("profile_similarity", f"{UP_TO_COUNTS}, {SHARE}, {DICE} SELECT i, j, ROUND(similarity, 6) AS similarity FROM dice")(
    lambda t: rounded(sim.dice_pairs(ng.share(counted(t)), panel=GRAM_PANEL), "similarity")
)

# ---- membership similarity -------------------------------------------------------------------

MEMBERS = 'm AS (SELECT DISTINCT subreddit AS "group", author_name AS member FROM comments WHERE author_name IS NOT NULL)'
MODS = """mods AS (SELECT DISTINCT subreddit, username FROM moderators WHERE username NOT IN ('u7', 'u13'))"""
MOD_MEMBERS = f'{MODS}, m AS (SELECT subreddit AS "group", username AS member FROM mods)'
PAIRS = """p AS (SELECT a."group" AS i, b."group" AS j, COUNT(*) AS common FROM m a
      JOIN m b ON a.member = b.member AND a."group" < b."group" GROUP BY 1, 2),
    s AS (SELECT "group" AS g, COUNT(*) AS n FROM m GROUP BY "group")"""
SIZED = "z AS (SELECT i, j, common, a.n AS ni, b.n AS nj, a.n + b.n - common AS u FROM p JOIN s a ON a.g = i JOIN s b ON b.g = j)"
JACCARD = "jac AS (SELECT i, j, common / CAST(u AS DOUBLE) AS jaccard FROM z)"
UP_TO_PAIRS = f"WITH {MEMBERS}, {PAIRS}, {SIZED}"
UP_TO_JACCARD = f"{UP_TO_PAIRS}, {JACCARD}"


def choose(n: str) -> str:
    return f"(CASE WHEN {n} < 2 THEN 0.0 ELSE CAST({n} AS DOUBLE) * ({n} - 1) / 2 END)"


UNIVERSE = "(SELECT COUNT(*) FROM users_t1)"
RAND = f"({choose('common')} + {choose(f'({UNIVERSE} - u)')}) / {choose(UNIVERSE)}"
EXPECTED = f"({choose('ni')} * {choose('nj')} / {choose(UNIVERSE)})"
ADJUSTED = f"({choose('common')} - {EXPECTED}) / (({choose('ni')} + {choose('nj')}) / 2 - {EXPECTED})"


def membership(t, repeats: bool = False):
    return sim.members(t.comments, member="author_name", repeats=repeats)


def staff(t, repeats: bool = False):
    return sim.members(sim.moderators(t.moderators, ["u7", "u13"], repeats), repeats=repeats)


def universe(t) -> int:
    return t.users_t1.count()


query("membership_unsigned", f"WITH {MEMBERS} SELECT * FROM m")(membership)


@query(
    "membership_signed",
    """SELECT DISTINCT CONCAT('+ ', subreddit) AS "group", author_name AS member FROM comments
      WHERE score > 0 AND author_name IS NOT NULL
    UNION ALL SELECT DISTINCT CONCAT('- ', subreddit), author_name FROM comments WHERE score < 1 AND author_name IS NOT NULL""",
)
def membership_signed(t):
    return sim.members_signed(stats.member_group(t.comments, ["pos_count", "neg_count"]))


query("pair_overlap", f"{UP_TO_PAIRS} SELECT i, j, common FROM p")(lambda t: sim.overlap(membership(t, repeats=True)))
query("jaccard", f"{UP_TO_JACCARD} SELECT i, j, ROUND(jaccard, 6) AS jaccard FROM jac")(
    lambda t: rounded(sim.jaccard(membership(t, repeats=True)), "jaccard")
)
EVERY_PAIR = """p AS (SELECT a.g AS i, b.g AS j, COALESCE(common, 0) AS common FROM s a JOIN s b ON a.g < b.g
      LEFT JOIN q ON q.i = a.g AND q.j = b.g)"""
query(
    "rand_index",
    f"WITH {MEMBERS}, {PAIRS.replace('p AS', 'q AS', 1)}, {EVERY_PAIR}, {SIZED} SELECT i, j, ROUND({RAND}, 6) AS rand_index FROM z",
)(
    lambda t: rounded(sim.rand_index(membership(t, repeats=True), universe(t)), "rand_index")
)
query("adjusted_rand", f"{UP_TO_PAIRS} SELECT i, j, ROUND({ADJUSTED}, 6) AS adjusted_rand FROM z")(
    lambda t: rounded(sim.adjusted_rand(membership(t, repeats=True), universe(t)), "adjusted_rand")
)


@query(
    "rand_index_requested",
    f"""WITH {MEMBERS.replace('m AS', 'c AS')}, asked AS (SELECT DISTINCT a."group" AS i, b."group" AS j FROM c a
        JOIN c b ON a.member = b.member AND a."group" < b."group"), {MOD_MEMBERS},
      {PAIRS.replace('p AS', 'q AS', 1)}, p AS (SELECT a.i, a.j, COALESCE(common, 0) AS common FROM asked a LEFT JOIN q ON q.i = a.i AND q.j = a.j),
      {SIZED} SELECT i, j, ROUND({RAND}, 6) AS rand_index FROM z""",
)
def rand_index_requested(t):
    """Moderator overlap for all pairs of groups that share a commenter, also disjoint ones."""
    asked = sim.overlap(membership(t, repeats=True)).select("i", "j")
    return rounded(sim.rand_index(staff(t, repeats=True), universe(t), asked), "rand_index")


query("distance", f"{UP_TO_JACCARD} SELECT i, j, ROUND(1 - jaccard, 6) AS distance FROM jac")(
    lambda t: rounded(sim.distance(sim.jaccard(membership(t, repeats=True)), "jaccard"), "distance")
)
query(
    "comembership_edges",
    f"""WITH {MOD_MEMBERS}, {PAIRS} SELECT i AS Source, j AS Target, common AS Weight, 'undirected' AS Type FROM p
    UNION ALL SELECT j, i, common, 'undirected' FROM p""",
)(lambda t: sim.edges(staff(t, repeats=True)))
query("group_sizes", f'WITH {MOD_MEMBERS} SELECT "group" AS Id, COUNT(*) AS count FROM m GROUP BY 1')(
    lambda t: sim.sizes(staff(t))
)
query("drop_bots", f"WITH {MODS} SELECT * FROM mods")(lambda t: sim.moderators(t.moderators, ["u7", "u13"]))

TEXT_MEMBERS = 'm AS (SELECT DISTINCT subreddit AS "group", author_name AS member FROM texts WHERE author_name IS NOT NULL)'


@query(
    "compound_distance",
    f"""{UP_TO_COUNTS}, {SHARE}, {DICE}, {TEXT_MEMBERS}, {PAIRS}, {SIZED}, {JACCARD}
    SELECT i, j, ROUND(COALESCE(1 - similarity, 1) + COALESCE(1 - jaccard, 1), 6) AS distance
    FROM dice FULL JOIN jac USING (i, j)""",
)
def compound_distance(t):
    grams = sim.distance(sim.dice_pairs(ng.share(counted(t)), panel=GRAM_PANEL), "similarity")
    people = sim.distance(sim.jaccard(sim.members(t.texts, member="author_name")), "jaccard")
    return rounded(sim.compound(grams, people), "distance")


# ---- clusters -----------------------------------------------------------------------------------

CUT = 0.945
LEAST = 0.1
LABELS = f"""d AS (SELECT i, j, 1 - common / CAST(u AS DOUBLE) AS distance FROM z),
    nodes2 AS (SELECT i AS g FROM d UNION SELECT j FROM d),
    link AS (SELECT i AS a, j AS b FROM d WHERE distance <= {CUT} UNION SELECT j, i FROM d WHERE distance <= {CUT}),
    reach(g, r) AS (SELECT g, g FROM nodes2 UNION SELECT reach.g, link.b FROM reach JOIN link ON link.a = reach.r),
    lab AS (SELECT g AS "group", MIN(r) AS cluster FROM reach GROUP BY g)"""
UP_TO_LABELS = f"WITH RECURSIVE {MOD_MEMBERS}, {PAIRS}, {SIZED}, {LABELS}"


@query("cluster_threshold", f"{UP_TO_LABELS} SELECT * FROM lab")
def cluster_threshold(t):
    """Only pairs within the cut are made; groups without one are named apart."""
    m = sim.indexed(staff(t, repeats=True))
    near = sim.distance(sim.jaccard(m, least=1 - CUT - 1e-9), "jaccard")
    return cl.components(near, CUT, sim.connected_groups(m))


query("similarity_join", f"{UP_TO_JACCARD} SELECT i, j, ROUND(jaccard, 6) AS jaccard FROM jac WHERE jaccard >= {LEAST}")(
    lambda t: rounded(sim.jaccard(membership(t, repeats=True), least=LEAST), "jaccard")
)

# The whole tree by joining the nearest group outside, one at a time; then its top K - 1 merges are undone.
K = 12
TREE = """pair AS (SELECT i, j, 1 - common / CAST(u AS DOUBLE) AS d FROM z),
    named AS (SELECT i AS g FROM pair UNION SELECT j FROM pair),
    full_ AS (SELECT a.g AS i, b.g AS j, COALESCE(pair.d, 1.0) AS d FROM named a JOIN named b ON a.g < b.g
      LEFT JOIN pair ON pair.i = a.g AND pair.j = b.g),
    ranked AS (SELECT i, j, ROW_NUMBER() OVER (ORDER BY d, i, j) AS r FROM full_),
    grown(inside, r) AS (SELECT [MIN(g)], CAST(0 AS BIGINT) FROM named UNION ALL
      SELECT * FROM (SELECT LIST_APPEND(inside, CASE WHEN LIST_CONTAINS(inside, i) THEN j ELSE i END), ranked.r
        FROM grown, ranked WHERE LIST_CONTAINS(inside, i) <> LIST_CONTAINS(inside, j) ORDER BY ranked.r LIMIT 1) nearest),
    kept AS (SELECT i AS a, j AS b FROM ranked WHERE r IN (SELECT r FROM grown WHERE r > 0 ORDER BY r DESC OFFSET {undone})),
    link AS (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
    reach(g, r) AS (SELECT g, g FROM named UNION SELECT reach.g, link.b FROM reach JOIN link ON link.a = reach.r)"""


@query(
    "cluster_k",
    f"""WITH RECURSIVE {MOD_MEMBERS}, {PAIRS}, {SIZED}, {TREE.format(undone=K - 1)}
    SELECT g AS "group", MIN(r) AS cluster FROM reach GROUP BY g""",
)
def cluster_k(t):
    m = sim.indexed(staff(t, repeats=True))
    found = sim.distance(sim.jaccard(m), "jaccard")
    return cl.cut(cl.merge_tree(found), sim.connected_groups(m), K)


@query(
    "complete_link_check",
    f"""{UP_TO_LABELS}, size AS (SELECT cluster, COUNT(*) AS size FROM lab GROUP BY cluster)
    SELECT s.cluster, MIN(s.size) AS size, ROUND(CASE WHEN COUNT(d.i) < MIN(s.size) * (MIN(s.size) - 1) / 2 THEN 1
      ELSE COALESCE(MAX(d.distance), 0) END, 6) AS diameter
    FROM size s LEFT JOIN (SELECT a.cluster, d.* FROM d JOIN lab a ON a."group" = d.i JOIN lab b ON b."group" = d.j
      WHERE a.cluster = b.cluster) d ON d.cluster = s.cluster GROUP BY s.cluster""",
)
def complete_link_check(t):
    m = sim.indexed(staff(t, repeats=True))
    found = freeze(sim.distance(sim.jaccard(m), "jaccard"), "distances")
    return rounded(cl.diameter(cl.components(found, CUT, sim.connected_groups(m)), found), "diameter")
