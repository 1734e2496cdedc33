"""Two-snapshot user profile: account data, activity totals and top-n groups and domains.

Every part is reduced to one row per username before it is joined, so the joins see no
hot key, and all of them share the username as their only key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.scalars import whole_days
from forumlens.operators.ranking import top_per_group
from forumlens.operators.stats import count_where
from forumlens.session import freeze


@dataclass(frozen=True)
class ProfileOptions:
    """Sizes of the top-n parts, score bands and optional columns of the profile."""

    n_comment_groups: int = 5
    n_thread_groups: int = 5
    n_domains: int = 5
    comment_low: int = -4
    comment_high: int = 20
    thread_low: int = -4
    thread_high: int = 50
    gilded: bool = False
    historic_gildings: bool = False
    account_age: bool = True
    group: str = "subreddit"
    ts: str = "timestamp"


# Rows of the summaries, once for each kind, that a task ranks and widens.
MEMBER_ROWS = 250_000

GILDINGS = [f"{kind}_{metal}" for kind in ("submissions", "comments") for metal in ("silver", "gold", "platinum")]


SUMS = ["n", "score_sum", "neg", "pos", "strong_neg", "strong_pos", "gold", "silver", "platinum",
        "length_sum", "length_n"]


def summarise(df: DataFrame, keys: list[str], low: int = 0, high: int = 0) -> DataFrame:
    """Additive measures per (keys, username); every coarser total is a sum of these rows."""
    score = F.col("score")
    optional = lambda c: F.sum(c) if c in df.columns else F.lit(None).cast("bigint")
    length = F.length("text") if "text" in df.columns else F.lit(None).cast("int")
    return df.groupBy(*keys, F.col("author_name").alias("username")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(score).alias("score_sum"),
        count_where(score < 1).alias("neg"),
        count_where(score > 1).alias("pos"),
        count_where(score <= low).alias("strong_neg"),
        count_where(score >= high).alias("strong_pos"),
        F.sum("gold").alias("gold"),
        optional("silver").alias("silver"),
        optional("platinum").alias("platinum"),
        F.sum(length).alias("length_sum"),
        F.count(length).alias("length_n"),
        F.max("created").alias("last"),
    )


def rollup(summary: DataFrame, keys: list[str]) -> DataFrame:
    return summary.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last"))


def _mean_length():
    return F.try_divide(F.col("length_sum").cast("double"), F.col("length_n")).alias("average_comment_length")


def _activity(rows: DataFrame, group: str, unit: str, count_name: str, gilded: bool) -> DataFrame:
    cols = [
        F.col(group),
        F.col("username"),
        F.col("score_sum").alias("total_score"),
        F.col("n").alias(count_name),
        F.col("neg").alias(f"total_negative_{unit}"),
        F.col("pos").alias(f"total_positive_{unit}"),
        F.col("gold").alias("total_gold"),
    ]
    if unit == "comments":
        cols.append(_mean_length())
    if gilded:
        cols += [F.col("silver").alias("total_silver"), F.col("platinum").alias("total_platinum")]
    return rows.select(*cols)


def ug_comments(comments: DataFrame, gilded: bool = False, group: str = "subreddit") -> DataFrame:
    return _activity(summarise(comments, [group]), group, "comments", "comment_count", gilded)


def ug_threads(threads: DataFrame, gilded: bool = False, group: str = "subreddit") -> DataFrame:
    return _activity(summarise(threads, [group]), group, "threads", "thread_count", gilded)


def ug_domains(threads: DataFrame, gilded: bool = False) -> DataFrame:
    return _activity(summarise(threads, ["domain"]), "domain", "threads", "domain_count", gilded)


def top_n(stats: DataFrame, n: int, count: str, tie: str, member: str = "username",
          name: str = "subreddit_rank") -> DataFrame:
    """A member's ``n`` largest rows by ``count``; equal counts rank by ``tie``."""
    return top_per_group(stats, member, [F.col(count).desc(), F.col(tie).asc_nulls_last()], n, name)


def widen(ranked: DataFrame, n: int, names: dict[str, str], rank: str, member: str = "username") -> DataFrame:
    """Ranks 1..n as columns, one aggregation for all of them.

    ``names`` maps an input column to its output name, in which ``{n}`` is the rank.
    """
    cells = [
        F.max(F.when(F.col(rank) == k, F.col(source))).alias(target.format(n=k))
        for k in range(1, n + 1)
        for source, target in names.items()
    ]
    return ranked.groupBy(member).agg(*cells)


def comment_names(gilded: bool = False, group: str = "subreddit") -> dict[str, str]:
    names = {
        group: "subreddit_{n}_comments",
        "total_score": "subreddit_{n}_total_comment_score",
        "comment_count": "subreddit_{n}_comment_count",
        "total_negative_comments": "subreddit_{n}_total_negative_comments",
        "total_positive_comments": "subreddit_{n}_total_positive_comments",
        "total_gold": "subreddit_{n}_comment_gold",
        "average_comment_length": "subreddit_{n}_average_comment_length",
    }
    if gilded:
        names |= {"total_silver": "subreddit_{n}_comment_silver", "total_platinum": "subreddit_{n}_comment_platinum"}
    return names


def _thread_names(key: str, prefix: str, label: str, count: str, gilded: bool) -> dict[str, str]:
    names = {
        key: label,
        "total_score": prefix + "_total_thread_score",
        count: prefix + "_thread_count",
        "total_negative_threads": prefix + "_total_negative_threads",
        "total_positive_threads": prefix + "_total_positive_threads",
        "total_gold": prefix + "_thread_gold",
    }
    if gilded:
        names |= {"total_silver": prefix + "_thread_silver", "total_platinum": prefix + "_thread_platinum"}
    return names


def thread_names(gilded: bool = False, group: str = "subreddit") -> dict[str, str]:
    return _thread_names(group, "subreddit_{n}", "subreddit_{n}_threads", "thread_count", gilded)


def domain_names(gilded: bool = False) -> dict[str, str]:
    return _thread_names("domain", "domain_{n}", "domain_{n}", "domain_count", gilded)


def _totals(rows: DataFrame, unit: str, more: list[str] = []) -> DataFrame:
    cols = [
        F.col("username"),
        F.col("score_sum").alias(f"total_{unit}_score"),
        F.col("n").alias(f"{unit}_count"),
        F.col("neg").alias(f"total_negative_{unit}s"),
        F.col("strong_neg").alias(f"total_strongly_negative_{unit}s"),
        F.col("strong_pos").alias(f"total_strongly_positive_{unit}s"),
        F.col("pos").alias(f"total_positive_{unit}s"),
        F.col("gold").alias(f"historic_total_{unit}_gold"),
    ]
    length = [_mean_length()] if unit == "comment" else []
    return rows.select(*cols, *length, F.col("last").alias(f"last_{unit}_timestamp"), *more)


def user_comments(comments: DataFrame, low: int = -4, high: int = 20) -> DataFrame:
    return _totals(summarise(comments, [], low, high), "comment").drop("last_comment_timestamp")


def user_threads(threads: DataFrame, low: int = -4, high: int = 50) -> DataFrame:
    return _totals(summarise(threads, [], low, high), "thread").drop("last_thread_timestamp")


def last_activity(comments: DataFrame, threads: DataFrame) -> DataFrame:
    """Newest comment and newest thread time per member."""
    rows = comments.select("author_name", F.col("created").alias("_c"), F.lit(None).cast("timestamp_ntz").alias("_t"))
    rows = rows.unionByName(
        threads.select("author_name", F.lit(None).cast("timestamp_ntz").alias("_c"), F.col("created").alias("_t"))
    )
    return rows.groupBy(F.col("author_name").alias("username")).agg(
        F.max("_c").alias("last_comment_timestamp"), F.max("_t").alias("last_thread_timestamp")
    )


def bad_flag():
    """1 if shadowbanned or suspended, else 0, also when both flags are NULL."""
    return F.when((F.col("shadowban_flag") == 1) | (F.col("suspended_flag") == 1), 1).otherwise(0)


def account_age(ts: str = "timestamp", created: str = "account_created"):
    return whole_days(ts, created)


def historic(users1: DataFrame, opts: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Snapshot-1 side: accounts that still had an id."""
    cols = [
        F.col("username"),
        F.col("comment_karma").alias("historic_comment_karma"),
        F.col("post_karma").alias("historic_post_karma"),
        F.col("is_mod").alias("historic_is_mod"),
        F.col("account_created"),
        F.col("is_gold").alias("historic_gold"),
    ]
    if opts.historic_gildings:
        cols += [F.col(g).alias(f"historic_{g}") for g in GILDINGS]
    cols += [
        F.col(opts.ts).alias("historic_timestamps"),
        F.col("shadowbanned_by_date").alias("historic_shadowbanned_by_date"),
        F.col("suspended_by_date").alias("historic_suspended_by_date"),
    ]
    if opts.account_age:
        cols.append(account_age(opts.ts).alias("account_age"))
    return users1.filter(F.col("id").isNotNull()).select(*cols)


def followup(users2: DataFrame, opts: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Snapshot-2 side with its 0/1 flags."""
    gildings = GILDINGS if opts.gilded else [g for g in GILDINGS if g.endswith("_gold")]
    return users2.select(
        "username",
        "shadowbanned_by_date",
        "suspended_by_date",
        F.col("shadowbanned_by_date").isNotNull().cast("int").alias("shadowban_flag"),
        F.col("suspended_by_date").isNotNull().cast("int").alias("suspended_flag"),
        *gildings,
        F.col(opts.ts).alias("followup_timestamp"),
        "is_mod",
        "comment_karma",
        "post_karma",
    )


def compare(users1: DataFrame, users2: DataFrame, opts: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Snapshot 1 left-joined to snapshot 2; flags are NULL for users gone by then."""
    return historic(users1, opts).join(followup(users2, opts), "username", "left")


def _cells(kind: str, key: str, n: int, count: str, names: dict[str, str]) -> list:
    """Output columns of the ``n`` first ranks of one kind of row."""
    sources = {
        count: F.col("n"), key: F.col(f"_{kind}"), "total_score": F.col("score_sum"), "total_gold": F.col("gold"),
        "total_silver": F.col("silver"), "total_platinum": F.col("platinum"),
        "average_comment_length": F.try_divide(F.col("length_sum").cast("double"), F.col("length_n")),
        **{f"total_{sign}_{unit}": F.col(sign[:3]) for sign in ("negative", "positive") for unit in ("comments", "threads")}}
    return [
        F.max(F.when((F.col("_kind") == kind) & (F.col("_rank") == k), sources[source])).alias(target.format(n=k))
        for k in range(1, n + 1) for source, target in names.items()]


def _per_member(summary: DataFrame, unit: str, kinds: dict[str, str], cells: list, tasks: int) -> DataFrame:
    """Totals and ranked columns of every member, from a summary that is dealt by member to ``tasks`` once.

    Every row counts in each of ``kinds`` (name to key column); the first one's rows make the totals.  Grouping, ranking and the
    last aggregation all keep the member's placement, and so does the join that follows.
    """
    null = lambda c: F.lit(None).cast(summary.schema[c].dataType)
    views = [F.struct(F.lit(kind).alias("_kind"), *((F.col(c) if other == kind else null(c)).alias(f"_{other}") for other, c in kinds.items()))
             for kind in kinds]
    placed = summary.repartition(tasks, "username")
    keyed = placed.select("username", *SUMS, "last", F.inline(F.array(*views)))
    rows = rollup(keyed, ["username", "_kind", *(f"_{k}" for k in kinds)])
    order = [F.col("n").desc(), *(F.col(f"_{k}").asc_nulls_last() for k in kinds)]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("username", "_kind").orderBy(*order)))
    main = F.col("_kind") == next(iter(kinds))
    sums = [F.sum(F.when(main, F.col(c))).alias(c) for c in SUMS]
    wide = ranked.groupBy("username").agg(*sums, F.max("last").alias("last"), *cells)
    names = [c for c in wide.columns if c not in ("username", "last", *SUMS)]
    return _totals(wide, unit, names)


def profile(users1: DataFrame, users2: DataFrame, comments: DataFrame, threads: DataFrame,
            opts: ProfileOptions = ProfileOptions(), existing: DataFrame | None = None) -> DataFrame:
    """One wide row per snapshot-1 user; with ``existing`` only users not in it yet."""
    base = users1
    if existing is not None:
        # The new users are found first, and only their activity is aggregated.
        base = base.join(existing.select("username"), "username", "left_anti")
        new = base.select(F.col("username").alias("_new")).distinct()
        comments = comments.join(new, F.col("author_name") == F.col("_new"), "left_semi")
        threads = threads.join(new, F.col("author_name") == F.col("_new"), "left_semi")
    # A NULL author joins no user, so it need not be shuffled at all.
    comments = comments.filter(F.col("author_name").isNotNull())
    threads = threads.filter(F.col("author_name").isNotNull())
    # One scan of each activity table, combined before its shuffle; the much smaller summary is then dealt by member
    # once, for its totals, its ranks and the join.
    group = opts.group
    c = freeze(summarise(comments, [group], opts.comment_low, opts.comment_high), "comment-summary")
    t = freeze(summarise(threads, [group, "domain"], opts.thread_low, opts.thread_high), "thread-summary")
    by_comment = _cells("group", group, opts.n_comment_groups, "comment_count", comment_names(opts.gilded, group))
    by_thread = _cells("group", group, opts.n_thread_groups, "thread_count", thread_names(opts.gilded, group))
    by_domain = _cells("domain", "domain", opts.n_domains, "domain_count", domain_names(opts.gilded))
    # As many tasks as bound the rows of each, both alike so that the join keeps the placement.
    tasks = max(int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(c.count() + 2 * t.count()) // MEMBER_ROWS))
    out = compare(base, users2, opts)
    out = out.join(_per_member(c, "comment", {"group": group}, by_comment, tasks), "username", "left")
    out = out.join(_per_member(t, "thread", {"group": group, "domain": "domain"}, by_thread + by_domain, tasks), "username", "left")
    return out.withColumn("bad_flag", bad_flag())


def profile_incremental(existing: DataFrame, users1, users2, comments, threads,
                        opts: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Profiles to append: users of snapshot 1 that the stored profile lacks."""
    return profile(users1, users2, comments, threads, opts, existing)
