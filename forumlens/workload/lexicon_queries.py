"""Queries on lexicon frequencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.functions import scalars as sc
from forumlens.operators import lexicon as lx
from forumlens.workload.registry import query
from forumlens.workload.views import LEXICON

# The caller's word list; single characters and the empty token are added by the operator.
STOP = ["of", "and", "in", "to", "der", "die", "de", "und", "www", "http", "https", "com"]
ALL_STOP = [*STOP, *lx.SINGLE_CHARACTERS, ""]
TERMS = [t for t, _, _ in LEXICON]
CANONICAL = sorted({c for _, c, _ in LEXICON})

LEX = "lex(term, canonical, list) AS (VALUES " + ", ".join(str(row) for row in LEXICON) + ")"
SPLIT_SQL = """'[. ''",.:\\s?]+'"""
SOURCE = "src AS (SELECT * FROM texts WHERE author_name IS NOT NULL AND author_name NOT IN ('u7', 'u13'))"
TOKENS = f"tok AS (SELECT id, subreddit, UNNEST(STRING_SPLIT_REGEX(LOWER(text), {SPLIT_SQL})) AS word FROM src)"
HITS = """hit AS (SELECT DISTINCT id, subreddit, {label} AS term FROM tok JOIN lex ON tok.word = lex.term)"""
FREQ = "freq AS (SELECT subreddit, term, COUNT(*) AS count FROM hit GROUP BY subreddit, term)"
TOTAL = "tot AS (SELECT subreddit, COUNT(*) AS n FROM src GROUP BY subreddit)"
SURFACE, FORMS = HITS.format(label="lex.term"), HITS.format(label="lex.canonical")
REL = "rel AS (SELECT f.subreddit, term, count, CAST(count AS DOUBLE) / n AS relative FROM freq f JOIN tot USING (subreddit))"
GRID = """grid AS (SELECT t.subreddit, l.term, COALESCE(r.count, 0) AS count, COALESCE(r.relative, 0) AS relative
    FROM tot t CROSS JOIN (SELECT DISTINCT term FROM lex) l
    LEFT JOIN rel r ON r.subreddit = t.subreddit AND r.term = l.term)"""
RATIO = "rat AS (SELECT *, relative / NULLIF(AVG(relative) OVER (PARTITION BY term), 0) AS ratio FROM grid)"
HEAD = f"WITH {LEX}, {SOURCE}, {TOKENS}"
UP_TO_REL = f"{HEAD}, {SURFACE}, {FREQ}, {TOTAL}, {REL}"
UP_TO_RATIO = f"{UP_TO_REL}, {GRID}, {RATIO}"


def source_rows(t):
    return lx.source(t.texts, bots=["u7", "u13"])


def words(t, distinct: bool = True):
    # Frequencies count rows, so repeated tokens of a row are dropped before the explode.
    return lx.tokens(source_rows(t), distinct=distinct)


def surface_freq(t):
    return lx.term_freq(words(t), t.lexicon)


def relative_freq(t):
    return lx.relative(surface_freq(t), source_rows(t))


def grid(t):
    return lx.densify(relative_freq(t), source_rows(t), TERMS)


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(
    "text_source",
    """SELECT id, subreddit, author_name, created FROM comments WHERE created >= TIMESTAMP '1996-10-01 00:00:00'
    AND author_name NOT IN ('u7', 'u13') AND subreddit IN (SELECT CONCAT('g', s_suppkey) FROM supplier WHERE s_acctbal > 0)""",
)
def text_source(t):
    groups = t.supplier.filter("s_acctbal > 0").select(F.concat(F.lit("g"), "s_suppkey"))
    return lx.source(t.comments, "1996-10-01", groups, ["u7", "u13"]).select("id", "subreddit", "author_name", "created")


@query("tokenize", f"{HEAD} SELECT subreddit, word, COUNT(*) AS count, COUNT(DISTINCT id) AS docs FROM tok GROUP BY subreddit, word")
def tokenize(t):
    return lx.word_counts(source_rows(t))


STOP_SQL = ", ".join(f"'{w}'" for w in ALL_STOP)


@query(
    "drop_stopwords",
    f"{HEAD} SELECT subreddit, word, COUNT(*) AS count FROM tok WHERE word NOT IN ({STOP_SQL}) GROUP BY subreddit, word",
)
def drop_stopwords(t):
    kept = lx.remove_stop(words(t, distinct=False), lx.stop_words(t.spark, STOP))
    return kept.groupBy("subreddit", "word").agg(F.count(F.lit(1)).alias("count"))


query("term_freq_surface", f"{HEAD}, {SURFACE}, {FREQ} SELECT * FROM freq")(surface_freq)
query("term_freq_canonical", f"{HEAD}, {FORMS}, {FREQ} SELECT * FROM freq")(
    lambda t: lx.term_freq(words(t), t.lexicon, canonical=True)
)


def regex_sql(faithful: bool) -> str:
    before, after = (r"[\s^]", r"[\s,.!?$]") if faithful else (r"(^|\s)", r"($|[\s,.!?])")
    return f"""WITH {LEX} SELECT subreddit, term,
      COUNT(CASE WHEN REGEXP_MATCHES(LOWER(text), '{before}' || term || '{after}') THEN 1 END) AS count
    FROM texts CROSS JOIN (SELECT DISTINCT term FROM lex) l GROUP BY subreddit, term"""


query("term_freq_regex", regex_sql(False))(lambda t: lx.term_freq_regex(t.texts, t.lexicon, fold_case=True))
query("term_freq_join", regex_sql(False))(lambda t: lx.term_freq_regex(t.texts, t.lexicon, fold_case=True, plan_terms=0))
query("term_freq_regex_faithful", regex_sql(True))(
    lambda t: lx.term_freq_regex(t.texts, t.lexicon, faithful=True, fold_case=True)
)
query("relative_freq", f"{UP_TO_REL} SELECT subreddit, term, count, ROUND(relative, 6) AS relative FROM rel")(
    lambda t: rounded(relative_freq(t), "relative")
)


def flagged(t, kind: str):
    return lx.flag_rows(source_rows(t), words(t), t.lexicon.filter(F.col("list") == kind))


FLAGGED = """SELECT s.*, s.id IN (SELECT tok.id FROM tok JOIN lex ON tok.word = lex.term WHERE lex.list = '{}') AS has_any FROM src s"""
ROW_SUMMARY = """SELECT subreddit, CAST(COUNT(CASE WHEN has_any THEN 1 END) AS BIGINT) AS total,
  ROUND(CAST(COUNT(CASE WHEN has_any THEN 1 END) AS DOUBLE) / COUNT(*), 6) AS share FROM ({}) f GROUP BY subreddit"""

query(
    "presence_flags",
    f"""{HEAD} SELECT g.id, g.subreddit, g.has_any AS has_general, s.has_any AS has_specific
    FROM ({FLAGGED.format('general')}) g JOIN ({FLAGGED.format('specific')}) s ON g.id = s.id""",
)(
    lambda t: lx.flag_rows(
        lx.flag_rows(source_rows(t), words(t), t.lexicon.filter("list = 'general'"), "has_general"),
        words(t), t.lexicon.filter("list = 'specific'"), "has_specific",
    ).select("id", "subreddit", "has_general", "has_specific")
)
query(
    "group_summary_sum",
    f"""{UP_TO_REL} SELECT subreddit, CAST(SUM(count) AS BIGINT) AS total, ROUND(SUM(relative), 6) AS share
    FROM rel GROUP BY subreddit""",
)(lambda t: rounded(lx.summary_sum(relative_freq(t)), "share"))
query("group_summary_rows", f"{HEAD} {ROW_SUMMARY.format(FLAGGED.format('general'))}")(
    lambda t: rounded(lx.summary_rows(flagged(t, "general")), "share")
)
query("dense_grid", f"{UP_TO_REL}, {GRID} SELECT subreddit, term, count, ROUND(relative, 6) AS relative FROM grid")(
    lambda t: rounded(grid(t), "relative")
)

WILSON = f"""SELECT *, CASE WHEN n > 0 THEN ROUND(1 / (1 + z2 / n) * (p + z2 / (2 * n) - z * SQRT(p * (1 - p) / n + z2 / (4 * n * n))), 6) END AS lower_p,
  CASE WHEN n > 0 THEN ROUND(1 / (1 + z2 / n) * (p + z2 / (2 * n) + z * SQRT(p * (1 - p) / n + z2 / (4 * n * n))), 6) END AS upper_p FROM (
  SELECT subreddit, term, count, CAST(relative AS DOUBLE) AS p, CAST({sc.Z_95} AS DOUBLE) AS z, CAST({sc.Z_95} AS DOUBLE) * {sc.Z_95} AS z2,
    ROUND_EVEN(count / NULLIF(CAST(relative AS DOUBLE), 0), 0) AS n FROM grid) w"""
query("wilson_interval", f"{UP_TO_REL}, {GRID} SELECT subreddit, term, count, n, lower_p, upper_p FROM ({WILSON}) x")(
    lambda t: rounded(lx.wilson(grid(t)), "lower_p", "upper_p").drop("relative")
)
query(
    "low_count_filter",
    f"""{UP_TO_REL} SELECT subreddit, term, count FROM rel WHERE term IN
    (SELECT term FROM rel GROUP BY term HAVING SUM(count) > 200)""",
)(lambda t: lx.min_total(relative_freq(t), 200).select("subreddit", "term", "count"))
query("term_ranking", f"{UP_TO_REL}, {GRID} SELECT term, ROUND(AVG(relative), 6) AS mean_relative FROM grid GROUP BY term")(
    lambda t: rounded(lx.rank_terms(grid(t)), "mean_relative")
)
query("ratio_to_mean", f"{UP_TO_RATIO} SELECT subreddit, term, ROUND(ratio, 6) AS ratio FROM rat")(
    lambda t: rounded(lx.ratio(grid(t)), "ratio").select("subreddit", "term", "ratio")
)
query(
    "labelled_union",
    f"""{HEAD} SELECT *, 'Specific' AS source FROM ({ROW_SUMMARY.format(FLAGGED.format('specific'))}) a
    UNION ALL SELECT *, 'Overzealous' FROM ({ROW_SUMMARY.format(FLAGGED.format('general'))}) b""",
)(
    lambda t: rounded(
        lx.tag_union(lx.summary_rows(flagged(t, "specific")), lx.summary_rows(flagged(t, "general"))), "share"
    )
)
query("outlier_labels", f"{UP_TO_RATIO} SELECT subreddit, term, ROUND(ratio, 6) AS ratio FROM rat WHERE ratio > 1.237 AND relative > 0.015")(
    lambda t: rounded(lx.outliers(lx.ratio(grid(t)), 1.237, 0.015), "ratio").select("subreddit", "term", "ratio")
)
query(
    "five_number",
    f"""{UP_TO_RATIO} SELECT term, ROUND(q[1], 6) AS "min", ROUND(q[2], 6) AS q1, ROUND(q[3], 6) AS median,
      ROUND(q[4], 6) AS q3, ROUND(q[5], 6) AS "max" FROM (SELECT term,
      QUANTILE_CONT(ratio, [0, 0.25, 0.5, 0.75, 1]) AS q FROM rat WHERE ratio IS NOT NULL GROUP BY term) x""",
)(lambda t: rounded(lx.five_number(lx.ratio(grid(t))), "min", "q1", "median", "q3", "max"))
query("floor_clamp", f"{UP_TO_RATIO} SELECT subreddit, term, ROUND(CASE WHEN ratio < 0.9 THEN 0.9 ELSE ratio END, 6) AS ratio FROM rat")(
    lambda t: lx.ratio(grid(t)).select("subreddit", "term", F.round(sc.clamp("ratio", 0.9), 6).alias("ratio"))
)
query("group_row_counts", "SELECT subreddit, COUNT(*) AS count FROM texts GROUP BY subreddit")(
    lambda t: lx.row_counts(t.texts)
)
query(
    "label_order",
    f"""{UP_TO_REL}, {GRID} SELECT term, DENSE_RANK() OVER (ORDER BY m DESC) AS ordinal FROM
    (SELECT term, AVG(count) AS m FROM grid GROUP BY term) x""",
)(lambda t: lx.label_order(grid(t), "term", "count"))
