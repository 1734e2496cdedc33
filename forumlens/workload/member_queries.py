"""Queries on member-by-group statistics, user profiles and account risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.operators import stats
from forumlens.operators.select import not_in
from forumlens.plans import profile as prof
from forumlens.plans import risk as risk_plans
from forumlens.workload.registry import query

# ---- member x group statistics -------------------------------------------------------

STAT_SQL = {
    "count": "COUNT(*)",
    "pos_count": "COUNT(CASE WHEN score > 0 THEN 1 END)",
    "neg_count": "COUNT(CASE WHEN score < 1 THEN 1 END)",
    "score_sum": "CAST(SUM(score) AS BIGINT)",
    "pos_sum": "CAST(SUM(CASE WHEN score > 0 THEN score ELSE 0 END) AS BIGINT)",
    "neg_sum": "CAST(SUM(CASE WHEN score < 0 THEN score ELSE 0 END) AS BIGINT)",
    "score_min": "MIN(score)",
    "score_max": "MAX(score)",
}


def stat_query(name: str, wanted: list[str]):
    cols = ", ".join(f"{STAT_SQL[w]} AS {w}" for w in wanted)
    sql = f"SELECT subreddit, author_name AS username, {cols} FROM comments GROUP BY subreddit, author_name"
    query(name, sql)(lambda t: stats.member_group(t.comments, wanted))


stat_query("mg_count", ["count"])
stat_query("mg_signed_counts", ["pos_count", "neg_count"])
stat_query("mg_sums", ["score_sum"])
stat_query("mg_signed_sums", ["pos_sum", "neg_sum"])
stat_query("mg_min_max", ["score_min", "score_max"])
stat_query("mg_all", list(STAT_SQL))


@query("mg_presence", "SELECT DISTINCT subreddit, author_name AS username FROM comments")
def mg_presence(t):
    return stats.member_group(t.comments, [])


@query(
    "date_group_filter",
    """SELECT id, subreddit, score, created FROM comments
    WHERE created BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1997-06-30 00:00:00'
      AND subreddit IN (SELECT CONCAT('g', s_suppkey) FROM supplier WHERE s_acctbal > 5000)""",
)
def date_group_filter(t):
    groups = t.supplier.filter("s_acctbal > 5000").select(F.concat(F.lit("g"), "s_suppkey"))
    return stats.where_range(t.comments, "1996-01-01", "1997-06-30", groups).select(
        "id", "subreddit", "score", "created"
    )


# ---- profile --------------------------------------------------------------------------


def activity_sql(table: str, group: str, unit: str, count: str, gilded: bool = True) -> str:
    length = ", AVG(LENGTH(text)) AS average_comment_length" if unit == "comments" else ""
    gilds = ", CAST(SUM(silver) AS BIGINT) AS total_silver, CAST(SUM(platinum) AS BIGINT) AS total_platinum"
    return f"""SELECT {group}, author_name AS username, CAST(SUM(score) AS BIGINT) AS total_score, COUNT(*) AS {count},
      COUNT(CASE WHEN score < 1 THEN 1 END) AS total_negative_{unit},
      COUNT(CASE WHEN score > 1 THEN 1 END) AS total_positive_{unit},
      CAST(SUM(gold) AS BIGINT) AS total_gold{length}{gilds if gilded else ''}
    FROM {table} GROUP BY {group}, author_name"""


UG_COMMENTS = activity_sql("comments", "subreddit", "comments", "comment_count")
UG_THREADS = activity_sql("threads", "subreddit", "threads", "thread_count")
UG_DOMAINS = activity_sql("threads", "domain", "threads", "domain_count")


def rounded(df, *cols, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def rounded_sql(sql: str, *cols: str) -> str:
    exprs = ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({exprs}) FROM ({sql}) q"


query("user_group_comment_stats", rounded_sql(UG_COMMENTS, "average_comment_length"))(
    lambda t: rounded(prof.ug_comments(t.comments, gilded=True), "average_comment_length")
)
query("user_group_thread_stats", UG_THREADS)(lambda t: prof.ug_threads(t.threads, gilded=True))
query("user_domain_stats", UG_DOMAINS)(lambda t: prof.ug_domains(t.threads, gilded=True))


def ranked_sql(stats_sql: str, n: int, count: str, tie: str, rank: str) -> str:
    return f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY username
      ORDER BY {count} DESC, {tie} ASC NULLS LAST) AS {rank} FROM ({stats_sql}) s) r WHERE {rank} <= {n}"""


@query(
    "top_n_per_user",
    rounded_sql(ranked_sql(UG_COMMENTS, 5, "comment_count", "subreddit", "subreddit_rank"), "average_comment_length"),
)
def top_n_per_user(t):
    ranked = prof.top_n(prof.ug_comments(t.comments, gilded=True), 5, "comment_count", "subreddit")
    return rounded(ranked, "average_comment_length")


def wide_sql(stats_sql: str, n: int, count: str, tie: str, names: dict[str, str]) -> str:
    cells = []
    for k in range(1, n + 1):
        for source, target in names.items():
            value = f"MAX(CASE WHEN rk = {k} THEN {source} END)"
            if source == "average_comment_length":
                value = f"ROUND({value}, 6)"
            cells.append(f"{value} AS {target.format(n=k)}")
    return f"SELECT username, {', '.join(cells)} FROM ({ranked_sql(stats_sql, n, count, tie, 'rk')}) w GROUP BY username"


def wide(stats_df, n, count, tie, names):
    out = prof.widen(prof.top_n(stats_df, n, count, tie, name="rk"), n, names, "rk")
    return rounded(out, *[c for c in out.columns if c.endswith("average_comment_length")])


query("top_n_wide", wide_sql(UG_COMMENTS, 3, "comment_count", "subreddit", prof.comment_names()))(
    lambda t: wide(prof.ug_comments(t.comments), 3, "comment_count", "subreddit", prof.comment_names())
)
query("top_n_wide_gilded", wide_sql(UG_THREADS, 3, "thread_count", "subreddit", prof.thread_names(True)))(
    lambda t: wide(prof.ug_threads(t.threads, True), 3, "thread_count", "subreddit", prof.thread_names(True))
)
query("top_n_wide_domains", wide_sql(UG_DOMAINS, 3, "domain_count", "domain", prof.domain_names(True)))(
    lambda t: wide(prof.ug_domains(t.threads, True), 3, "domain_count", "domain", prof.domain_names(True))
)


def totals_sql(table: str, unit: str, low: int, high: int) -> str:
    length = ", ROUND(AVG(LENGTH(text)), 6) AS average_comment_length" if unit == "comment" else ""
    return f"""SELECT author_name AS username, CAST(SUM(score) AS BIGINT) AS total_{unit}_score, COUNT(*) AS {unit}_count,
      COUNT(CASE WHEN score < 1 THEN 1 END) AS total_negative_{unit}s,
      COUNT(CASE WHEN score <= {low} THEN 1 END) AS total_strongly_negative_{unit}s,
      COUNT(CASE WHEN score >= {high} THEN 1 END) AS total_strongly_positive_{unit}s,
      COUNT(CASE WHEN score > 1 THEN 1 END) AS total_positive_{unit}s,
      CAST(SUM(gold) AS BIGINT) AS historic_total_{unit}_gold{length}
    FROM {table} GROUP BY author_name"""


query("user_comment_totals", totals_sql("comments", "comment", -4, 20))(
    lambda t: rounded(prof.user_comments(t.comments), "average_comment_length")
)
query("user_thread_totals", totals_sql("threads", "thread", -4, 50))(lambda t: prof.user_threads(t.threads))

LAST_ACTIVITY = """SELECT username, MAX(c) AS last_comment_timestamp, MAX(t) AS last_thread_timestamp FROM (
  SELECT author_name AS username, created AS c, CAST(NULL AS TIMESTAMP) AS t FROM comments
  UNION ALL SELECT author_name, NULL, created FROM threads) u GROUP BY username"""

query("last_activity", LAST_ACTIVITY)(lambda t: prof.last_activity(t.comments, t.threads))


def historic_sql(gildings: bool) -> str:
    extra = "".join(f", {g} AS historic_{g}" for g in prof.GILDINGS) if gildings else ""
    return f"""SELECT username, comment_karma AS historic_comment_karma, post_karma AS historic_post_karma,
      is_mod AS historic_is_mod, account_created, is_gold AS historic_gold{extra}, timestamp AS historic_timestamps,
      shadowbanned_by_date AS historic_shadowbanned_by_date, suspended_by_date AS historic_suspended_by_date,
      EXTRACT(DAY FROM timestamp - account_created) AS account_age
    FROM users_t1 WHERE id IS NOT NULL"""


def followup_sql(gilded: bool) -> str:
    gildings = prof.GILDINGS if gilded else ["submissions_gold", "comments_gold"]
    return f"""SELECT username, shadowbanned_by_date, suspended_by_date,
      CASE WHEN shadowbanned_by_date IS NOT NULL THEN 1 ELSE 0 END AS shadowban_flag,
      CASE WHEN suspended_by_date IS NOT NULL THEN 1 ELSE 0 END AS suspended_flag, {', '.join(gildings)},
      timestamp AS followup_timestamp, is_mod, comment_karma, post_karma FROM users_t2"""


def compare_sql(gilded: bool = False, historic: bool = False) -> str:
    return f"SELECT * FROM ({historic_sql(historic)}) h LEFT JOIN ({followup_sql(gilded)}) f USING (username)"


query("snapshot_compare", compare_sql())(lambda t: prof.compare(t.users_t1, t.users_t2))
query(
    "bad_flag",
    f"""SELECT username, shadowban_flag, suspended_flag,
      CASE WHEN shadowban_flag = 1 OR suspended_flag = 1 THEN 1 ELSE 0 END AS bad_flag FROM ({compare_sql()}) c""",
)(
    lambda t: prof.compare(t.users_t1, t.users_t2)
    .withColumn("bad_flag", prof.bad_flag())
    .select("username", "shadowban_flag", "suspended_flag", "bad_flag")
)
query("account_age", "SELECT username, EXTRACT(DAY FROM timestamp - account_created) AS account_age FROM users_t1")(
    lambda t: t.users_t1.select("username", prof.account_age().alias("account_age"))
)
GILDED = prof.ProfileOptions(gilded=True, historic_gildings=True)
query("historic_gildings", compare_sql(True, True))(lambda t: prof.compare(t.users_t1, t.users_t2, GILDED))


def profile_sql(opts: prof.ProfileOptions, where: str = "") -> str:
    g = opts.gilded
    comments = activity_sql("comments", "subreddit", "comments", "comment_count", g)
    threads = activity_sql("threads", "subreddit", "threads", "thread_count", g)
    domains = activity_sql("threads", "domain", "threads", "domain_count", g)
    parts = [
        LAST_ACTIVITY,
        totals_sql("comments", "comment", opts.comment_low, opts.comment_high),
        totals_sql("threads", "thread", opts.thread_low, opts.thread_high),
        wide_sql(comments, opts.n_comment_groups, "comment_count", "subreddit", prof.comment_names(g)),
        wide_sql(threads, opts.n_thread_groups, "thread_count", "subreddit", prof.thread_names(g)),
        wide_sql(domains, opts.n_domains, "domain_count", "domain", prof.domain_names(g)),
    ]
    joins = " ".join(f"LEFT JOIN ({part}) p{i} USING (username)" for i, part in enumerate(parts))
    return f"""SELECT *, CASE WHEN shadowban_flag = 1 OR suspended_flag = 1 THEN 1 ELSE 0 END AS bad_flag
    FROM ({compare_sql(g, opts.historic_gildings)}) base {joins} {where}"""


def with_rounded_lengths(df):
    return rounded(df, *[c for c in df.columns if c.endswith("average_comment_length")])


PLAIN = prof.ProfileOptions()


@query("user_profile", profile_sql(GILDED))
def user_profile(t):
    return with_rounded_lengths(prof.profile(t.users_t1, t.users_t2, t.comments, t.threads, GILDED))


@query(
    "profile_incremental",
    profile_sql(PLAIN, "WHERE username NOT IN (SELECT username FROM users_t2 WHERE is_mod)"),
)
def profile_incremental(t):
    existing = t.users_t2.filter("is_mod").select("username")
    return with_rounded_lengths(
        prof.profile_incremental(existing, t.users_t1, t.users_t2, t.comments, t.threads, PLAIN)
    )


# ---- risk ------------------------------------------------------------------------------


def risk_sql(table: str, group: str, n: int, minimum: int) -> str:
    return f"""WITH counted AS (SELECT {group}, author_name AS username, COUNT(*) AS c FROM {table} GROUP BY {group}, author_name),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY username ORDER BY c DESC, {group} ASC NULLS LAST) AS rk
      FROM counted WHERE username NOT IN (SELECT username FROM users_t1 WHERE id IS NULL))
    SELECT {group}, COUNT(*) AS count,
      CAST(SUM(CASE WHEN u.username IS NULL THEN NULL WHEN u.shadowbanned_by_date IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS shadowban_count,
      CAST(SUM(CASE WHEN u.username IS NULL THEN NULL WHEN u.suspended_by_date IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS suspended_count,
      CAST(SUM(CASE WHEN u.username IS NULL THEN NULL WHEN u.id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_count
    FROM ranked r LEFT JOIN users_t2 u ON r.username = u.username
    WHERE rk <= {n} GROUP BY {group} HAVING COUNT(*) >= {minimum}"""


query("risk_by_comment_group", risk_sql("comments", "subreddit", 20, 30))(
    lambda t: risk_plans.risk_by_comment_group(t.comments, t.users_t1, t.users_t2, 20, 30)
)
query("risk_by_thread_group", risk_sql("threads", "subreddit", 10, 30))(
    lambda t: risk_plans.risk_by_thread_group(t.threads, t.users_t1, t.users_t2, 10, 30)
)
query("risk_by_domain", risk_sql("threads", "domain", 10, 30))(
    lambda t: risk_plans.risk_by_domain(t.threads, t.users_t1, t.users_t2, 10, 30)
)


@query(
    "not_in_null_aware",
    """SELECT id, author_name FROM comments
    WHERE author_name NOT IN (SELECT username FROM users_t1 WHERE id IS NULL)""",
)
def not_in_null_aware(t):
    listed = t.users_t1.filter("id IS NULL").select("username")
    return not_in(t.comments, "author_name", listed).select("id", "author_name")
