"""Term frequencies per group: tokens or patterns, normalised, densified, with intervals.

The lexicon is data: (term, canonical, list).  It is joined to the tokens once; there is no
query per term.  Spark broadcasts it if it measures it as small and shuffles it otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.scalars import Z_95, ratio as ratio_of, wilson_bounds
from forumlens.operators.ranking import ordinal as dense_ordinal
from forumlens.operators.select import as_ntz, in_list
from forumlens.operators.selection import five_number  # noqa: F401
from forumlens.session import freeze

# Characters that separate tokens.
TOKEN_SPLIT = r"[. '\",.:\s?]+"
SINGLE_CHARACTERS = list("abcdefghijklmnopqrstuvwxyz0123456789")
# Up to this many terms are compiled into the plan as patterns; more are matched by a join.  The rows are the same.
PLAN_TERMS = 200
# Terms of a grid are dealt in lists of about this size.
TERM_LIST = 1000


def source(df: DataFrame, since=None, groups: DataFrame | None = None, bots: list[str] | None = None) -> DataFrame:
    """Rows of listed groups since a date, without bots; a NULL author drops out with them."""
    rows = df
    if since is not None:
        rows = rows.filter(F.col("created") >= as_ntz(since))
    if bots is not None:
        rows = rows.filter(F.col("author_name").isNotNull())
        if bots:
            rows = rows.filter(~F.col("author_name").isin(*bots))
    return in_list(rows, "subreddit", groups)


def tokens(df: DataFrame, text: str = "text", distinct: bool = False) -> DataFrame:
    """One row per token of the lower-cased text (per distinct token if asked)."""
    parts = F.split(F.lower(text), TOKEN_SPLIT)
    return df.select("id", "subreddit", F.explode(F.array_distinct(parts) if distinct else parts).alias("word"))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Tokens per (group, word), and the distinct ids of the rows they stand in (a NULL id is none).

    A row with an id of its own adds one to ``docs`` for each of its words, so tasks add up groups and words
    before anything is shuffled.  Only rows that share their id are compared by (group, word, id).
    """
    repeated = df.groupBy("id").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1 AND id IS NOT NULL")
    repeated = freeze(repeated.select(F.col("id").alias("_id"), F.lit(True).alias("_again")), "repeated-ids")
    parts = df.select("id", "subreddit", F.split(F.lower(text), TOKEN_SPLIT).alias("_parts"))
    parts = parts.join(repeated, F.col("id") == F.col("_id"), "left")
    own = F.col("id").isNotNull() & F.col("_again").isNull()
    # In a sorted row a word comes up first where its neighbour differs.  From a plain explode Spark would infer a filter on the
    # array and split the texts where they are read too.
    placed = parts.select("subreddit", own.alias("_own"), F.sort_array("_parts").alias("_parts"))
    placed = placed.select("subreddit", "_own", "_parts", F.posexplode_outer("_parts").alias("_at", "word")).filter("word IS NOT NULL")
    new = (F.col("_at") == 0) | (F.col("word") != F.get("_parts", F.col("_at") - 1))
    found = placed.select("subreddit", "word", F.lit(1).cast("bigint").alias("count"), (F.col("_own") & new).cast("bigint").alias("docs"))
    shared = parts.filter("_again").select("subreddit", F.explode_outer(F.array_distinct("_parts")).alias("word"), "id")
    shared = shared.filter("word IS NOT NULL").distinct()
    shared = shared.groupBy("subreddit", "word").agg(F.lit(0).cast("bigint").alias("count"), F.count(F.lit(1)).alias("docs"))
    return found.unionByName(shared).groupBy("subreddit", "word").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def stop_words(spark, words: list[str]) -> DataFrame:
    """Stop list: the caller's words, single characters and the empty token."""
    every = dict.fromkeys([*words, *SINGLE_CHARACTERS, ""])
    return spark.createDataFrame([(w,) for w in every], "word string")


def remove_stop(words: DataFrame, stop: DataFrame) -> DataFrame:
    return words.join(stop, "word", "left_anti")


def normal_terms(lexicon: DataFrame) -> DataFrame:
    """Lexicon in the form tokens have: lower-cased and trimmed."""
    return lexicon.withColumn("term", F.lower(F.trim("term"))).distinct()


def unsupported_terms(lexicon: DataFrame) -> DataFrame:
    """Terms that can never equal a token (they contain a separator); use the pattern mode."""
    return normal_terms(lexicon).filter(F.col("term").rlike(TOKEN_SPLIT))


def hits(words: DataFrame, lexicon: DataFrame, canonical: bool = False) -> DataFrame:
    """Distinct (row, term) matches."""
    label = F.col("canonical") if canonical else F.col("term")
    listed = normal_terms(lexicon).select(F.col("term").alias("word"), label.alias("term")).distinct()
    return words.join(listed, "word").select("id", "subreddit", "term").distinct()


def term_freq(words: DataFrame, lexicon: DataFrame, canonical: bool = False) -> DataFrame:
    """Rows per (group, term) that contain the term or, if canonical, any of its forms."""
    return hits(words, lexicon, canonical).groupBy("subreddit", "term").agg(F.count(F.lit(1)).alias("count"))


def term_edges(faithful: bool) -> tuple[str, str]:
    """Anchored patterns let a term start or end the text; faithful ones need a neighbour."""
    return (r"[\s^]", r"[\s,.!?$]") if faithful else (r"(?:^|\s)", r"(?:$|[\s,.!?])")


def term_patterns(terms: list[str], faithful: bool) -> list[str]:
    before, after = term_edges(faithful)
    return [f"{before}{re.escape(term)}{after}" for term in terms]


def term_freq_regex(df: DataFrame, lexicon: DataFrame, text: str = "text", faithful: bool = False,
                    fold_case: bool = False, plan_terms: int = PLAN_TERMS) -> DataFrame:
    """Rows per (group, term) whose text matches the term as a word; zero rows are kept.

    A few terms become literal patterns, so a text is read once and emits only the terms it holds.  Any
    number of terms is matched by a join: see ``matched_terms``.  Zero cells come from the groups, not from rows times terms.
    """
    listed = lexicon.select("term").filter(F.col("term").isNotNull()).distinct()
    terms = [r[0] for r in listed.orderBy("term").limit(plan_terms + 1).collect()]
    value = F.lower(text) if fold_case else F.col(text)
    if len(terms) <= plan_terms:
        found = [F.when(value.rlike(p), F.lit(t)) for t, p in zip(terms, term_patterns(terms, faithful))]
        matched = df.select("subreddit", F.explode(F.array_compact(F.array(*found))).alias("term"))
    else:
        matched, terms = matched_terms(df.select("subreddit", value.alias("text")), listed, faithful), listed
    counts = matched.groupBy("subreddit", "term").agg(F.count(F.lit(1)).alias("count"))
    return densify(counts, df.select("subreddit"), terms).select("subreddit", "term", "count")


# Runs of letters and digits.  A term stands between blanks, marks or the ends of the text, so every run of it is a whole run of the text.
RUN = r"[\p{L}\p{N}]+"


def matched_terms(rows: DataFrame, terms: DataFrame, faithful: bool = False) -> DataFrame:
    """(subreddit, term) for every row and term that its ``text`` matches.

    Each term looks for the rarest of its runs of letters and digits; rows that have this run are checked against the term's
    own pattern.  A term without such runs looks by its first word, which begins a word of the text and ends before a
    mark or at its end; a blank term by nothing at all.
    """
    rows = freeze(rows.withColumn("_row", F.monotonically_increasing_id()), "texts")
    gaps = r"[\s^]+" if faithful else r"\s+"
    blank_cut = lambda c: F.filter(F.split(c, gaps), lambda w: w != "")
    marks = r"(?=[,.!?$])" if faithful else r"(?=[,.!?])"

    def starts(word: Column) -> Column:
        """Beginnings of a word up to a mark or its end."""
        parts = F.split(word, marks)
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ""))

    bare = lambda c: ~c.rlike(RUN)
    first = F.flatten(F.transform(blank_cut(F.col("text")), starts))
    keys = F.array_distinct(F.concat(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)), F.filter(first, bare), F.array(F.lit(""))))
    held = rows.select("_row", F.explode(keys).alias("key"))

    run_keys = F.array_distinct(F.regexp_extract_all("term", F.lit(RUN), F.lit(0)))
    words = blank_cut(F.col("term"))
    own = F.when(F.col("term").rlike(RUN), run_keys).when(F.size(words) > 0, F.slice(words, 1, 1)).otherwise(F.array(F.lit("")))
    offered = freeze(terms.select("term", F.explode(own).alias("key")), "term_keys")
    known = held.join(offered.select("key").distinct(), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        offered.join(known, "key", "left")
        .groupBy("term").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("k"))
        .filter(F.col("k.n") > 0).select("term", F.col("k.key").alias("key")))
    near = held.join(rarest, "key").select("_row", "term")
    before, after = term_edges(faithful)
    pattern = F.concat(F.lit(before), F.regexp_replace("term", r"([^\p{L}\p{N}_])", r"\\$1"), F.lit(after))
    return near.join(rows, "_row").filter(F.regexp_like("text", pattern)).select("subreddit", "term")


def relative(freq: DataFrame, rows: DataFrame) -> DataFrame:
    """Count divided by all rows of the group."""
    totals = rows.groupBy("subreddit").agg(F.count(F.lit(1)).alias("_rows"))
    joined = freq.join(totals, "subreddit", "left")
    return joined.withColumn("relative", ratio_of("count", "_rows")).drop("_rows")


def flag_rows(rows: DataFrame, words: DataFrame, lexicon: DataFrame, name: str = "has_any") -> DataFrame:
    """Mark the rows that hold at least one listed term."""
    found = hits(words, lexicon).select("id").distinct().withColumn("_hit", F.lit(True))
    return rows.join(found, "id", "left").withColumn(name, F.col("_hit").isNotNull()).drop("_hit")


def summary_sum(freq: DataFrame) -> DataFrame:
    """Sums over terms; a row with two terms counts twice, so the share may exceed 1."""
    return freq.groupBy("subreddit").agg(F.sum("count").alias("total"), F.sum("relative").alias("share"))


def summary_rows(flagged: DataFrame, flag: str = "has_any") -> DataFrame:
    """Rows with at least one term, and their share of the group."""
    hit = F.count_if(F.col(flag))
    return flagged.groupBy("subreddit").agg(hit.alias("total"), ratio_of(hit, F.count(F.lit(1))).alias("share"))


def densify(freq: DataFrame, groups: DataFrame, terms: list[str] | DataFrame) -> DataFrame:
    """A row for every (group, term); cells nobody wrote become 0.

    Terms (a list, or a table with a column ``term``) are dealt in lists, which meet every group and are exploded there.
    """
    names = groups.select("subreddit").filter(F.col("subreddit").isNotNull()).distinct()
    if isinstance(terms, DataFrame):
        terms = freeze(terms.select("term").distinct(), "terms")
        n = -(-terms.count() // TERM_LIST) or 1
        lists = terms.groupBy(F.pmod(F.xxhash64("term"), F.lit(n)).alias("_list")).agg(F.collect_list("term").alias("_terms"))
        grid = names.select("subreddit", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("_list")).join(lists, "_list")
        grid = grid.select("subreddit", F.explode("_terms").alias("term"))
    else:
        grid = names.select("subreddit", F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in freq.columns if c not in ("subreddit", "term")]
    return grid.join(freq, ["subreddit", "term"], "left").select("subreddit", "term", *filled)


def wilson(df: DataFrame, count: str = "count", p: str = "relative", z: float = Z_95) -> DataFrame:
    n, lower, upper = wilson_bounds(count, p, z)
    return df.withColumns({"n": n, "lower_p": lower, "upper_p": upper})


def _per_term(df: DataFrame, value: Column, name: str, term: str = "term") -> DataFrame:
    """Attach a per-term aggregate by joining the small per-term table back.

    A window would gather all groups of a term in one task.
    """
    totals = df.groupBy(term).agg(value.alias(name))
    return df.join(totals, term)


def min_total(df: DataFrame, minimum: int = 30, term: str = "term", count: str = "count") -> DataFrame:
    """Keep terms whose total count exceeds ``minimum``."""
    return _per_term(df, F.sum(count), "_total", term).filter(F.col("_total") > minimum).select(*df.columns)


def rank_terms(df: DataFrame, term: str = "term", value: str = "relative") -> DataFrame:
    """Mean share per term, largest first."""
    return df.groupBy(term).agg(F.avg(value).alias("mean_relative")).orderBy(F.col("mean_relative").desc(), term)


def ratio(df: DataFrame, term: str = "term", value: str = "relative") -> DataFrame:
    """Share relative to the term's mean share over the groups."""
    return _per_term(df, F.avg(value), "_mean", term).select(*df.columns, ratio_of(value, "_mean").alias("ratio"))


def tag_union(specific: DataFrame, general: DataFrame) -> DataFrame:
    """Both summaries in one table, tagged by origin."""
    tag = lambda df, name: df.withColumn("source", F.lit(name))
    return tag(specific, "Specific").unionByName(tag(general, "Overzealous"))


def outliers(df: DataFrame, r: float, p: float) -> DataFrame:
    """Cells whose ratio and share both stand out, e.g. (2.5, 0.015) or (4, 0.001)."""
    return df.filter((F.col("ratio") > r) & (F.col("relative") > p))


def row_counts(df: DataFrame, group: str = "subreddit") -> DataFrame:
    """Rows per group, largest first."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), group)


def label_order(df: DataFrame, key: str, value: str) -> DataFrame:
    """Position of every label when labels are ordered by their mean value."""
    means = df.groupBy(key).agg(F.avg(value).alias("_value"))
    return dense_ordinal(means, key, F.col("_value")).select(key, "ordinal")
