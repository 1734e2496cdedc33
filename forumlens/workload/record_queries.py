"""Queries on sources, record normalisation and merges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions import scalars as sc
from forumlens.operators import merge as mg
from forumlens.operators import normalize as nz
from forumlens.operators import records as rec
from forumlens.operators.ranking import first_by_key, latest
from forumlens.operators.select import in_list, last_seen
from forumlens.session import scratch_path
from forumlens.sources import files
from forumlens.sources.store import Store
from forumlens.workload.registry import query

# ---- sources and sinks -------------------------------------------------------------------

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)


@query("scan_typed", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def scan_typed(t):
    return files.load(t.spark, t.path("orders"), ORDERS_SCHEMA)


@query(
    "read_line_list",
    """SELECT TRIM(p_name) AS name FROM part WHERE LENGTH(p_name) + 1 <= 11 AND TRIM(p_name) <> ''""",
)
def read_line_list(t):
    path = scratch_path(t.spark, "names")
    t.part.select("p_name").write.text(path)
    return files.read_list(t.spark, path, limit=11)


@query(
    "list_filter",
    """SELECT id, subreddit, author_name FROM threads WHERE subreddit IN
    (SELECT CONCAT('g', s_suppkey) FROM supplier WHERE s_acctbal > 0)""",
)
def list_filter(t):
    wanted = t.supplier.filter("s_acctbal > 0").select(F.concat(F.lit("g"), "s_suppkey").alias("name"))
    return in_list(t.threads, "subreddit", wanted).select("id", "subreddit", "author_name")


SUMMARY_SQL = """SELECT subreddit, author_name AS username, COUNT(*) AS count, CAST(SUM(score) AS BIGINT) AS score_sum
FROM comments WHERE author_name IS NOT NULL GROUP BY subreddit, author_name"""


def summary(t):
    return (
        t.comments.filter("author_name IS NOT NULL")
        .groupBy("subreddit", F.col("author_name").alias("username"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("score").alias("score_sum"))
    )


@query("read_csv", SUMMARY_SQL)
def read_csv(t):
    path = scratch_path(t.spark, "csv-in")
    files.export_csv(summary(t), path)
    return files.load_csv(t.spark, path, "subreddit string, username string, count bigint, score_sum bigint")


@query(
    "write_csv",
    """SELECT CONCAT(p_name, ', "', p_brand, '"') AS name, p_partkey AS part, p_retailprice AS price FROM part""",
)
def write_csv(t):
    path = scratch_path(t.spark, "csv-out")
    name = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    rows = t.part.select(name.alias("name"), F.col("p_partkey").alias("part"), F.col("p_retailprice").alias("price"))
    files.export_csv(rows, path)
    return files.load_csv(t.spark, path, "name string, part bigint, price double")


@query("create_table_as", SUMMARY_SQL)
def create_table_as(t):
    return files.materialize(summary(t), "summary", path=scratch_path(t.spark, "tables"))


@query(
    "insert_new_members",
    """SELECT username, comment_karma FROM users_t2
    UNION ALL SELECT username, comment_karma FROM users_t1 WHERE username NOT IN (SELECT username FROM users_t2)""",
)
def insert_new_members(t):
    path = scratch_path(t.spark, "members")
    cols = ["username", "comment_karma"]
    t.users_t2.select(cols).write.parquet(path)
    files.insert_new(path, t.users_t1.select(cols), "username")
    return t.spark.read.parquet(path)


@query(
    "snapshot_schema_union",
    """SELECT username, id, comment_karma, post_karma, is_gold, NULL AS deleted_by_date, 1 AS snapshot FROM users_t1
    UNION ALL SELECT username, id, comment_karma, post_karma, FALSE, deleted_by_date, 2 FROM users_t2""",
)
def snapshot_schema_union(t):
    old = t.users_t1.select("username", "id", "comment_karma", "post_karma", "is_gold", F.lit(1).alias("snapshot"))
    new = t.users_t2.select("username", "id", "comment_karma", "post_karma", "deleted_by_date", F.lit(2).alias("snapshot"))
    return files.align_union(old, new, {"is_gold": F.lit(False)})


# ---- record normalisation ------------------------------------------------------------------


@query(
    "scrub_nulls",
    """SELECT id, author_name, CASE WHEN score > 30 THEN NULL
      ELSE CONCAT(text, ' <NULL_CHARACTER_REPLACEMENT> ', subreddit) END AS text FROM comments""",
)
def scrub_nulls(t):
    raw = F.when(F.col("score") <= 30, F.concat("text", F.lit("\u0000"), "subreddit"))
    return t.comments.select("id", "author_name", sc.scrub(raw).alias("text"))


@query(
    "epoch_pair",
    """SELECT id, created - INTERVAL 5 HOUR AS created, created AS created_utc FROM comments""",
)
def epoch_pair(t):
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("created"))
    return t.comments.select("id", epoch.alias("epoch")).select("id", *sc.epoch_pair("epoch", "-05:00"))


def seconds(c: str):
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c)).cast("double")


@query(
    "comment_records",
    """SELECT CAST(id AS VARCHAR) AS id, author_name, subreddit, CONCAT('x', thread_id) AS thread_id, CONCAT('t3_x', thread_id) AS parent_id,
      text, score, gold, silver, platinum, gold = 1 AS is_distinguished, CASE WHEN silver = 1 THEN created - INTERVAL 5 HOUR END AS edited,
      created - INTERVAL 5 HOUR AS created, created AS created_utc, timestamp - INTERVAL 5 HOUR AS timestamp, 'thread' AS scrape_mode FROM comments""",
)
def comment_records(t):
    """Whole nested records, as an API returns them, to rows of the stored schema."""
    name = F.concat(F.lit("t3_x"), "thread_id")
    raw = t.comments.select(
        F.col("id").cast("string").alias("id"), F.when(F.col("author_name").isNotNull(), F.struct(F.col("author_name").alias("name"))).alias("author"),
        F.struct(F.col("subreddit").alias("display_name")).alias("subreddit"), name.alias("link_id"), name.alias("parent_id"),
        F.col("text").alias("body"), "score", F.col("gold").alias("gilded"),
        F.create_map(F.lit("gid_1"), "silver", F.lit("gid_3"), "platinum").alias("gildings"),
        F.when(F.col("gold") == 1, "moderator").alias("distinguished"),
        F.when(F.col("silver") == 1, seconds("created").cast("string")).otherwise("false").alias("edited"),
        seconds("created").alias("created_utc"), seconds("timestamp").alias("seen_utc"))
    rows = rec.comment_rows(raw, "thread", "-05:00")
    return rows.select("id", "author_name", "subreddit", "thread_id", "parent_id", "text", "score", "gold", "silver", "platinum",
                       "is_distinguished", "edited", "created", "created_utc", "timestamp", "scrape_mode")


@query(
    "thread_records",
    """SELECT CAST(id AS VARCHAR) AS id, author_name, subreddit, domain, score, num_comments, gold, silver, platinum,
      'minimal' AS scrape_mode, created, timestamp AS timestamp_utc FROM threads""",
)
def thread_records(t):
    raw = t.threads.select(
        F.col("id").cast("string").alias("id"), F.when(F.col("author_name").isNotNull(), F.struct(F.col("author_name").alias("name"))).alias("author"),
        F.struct(F.col("subreddit").alias("display_name")).alias("subreddit"), "domain", "score", "num_comments", F.col("gold").alias("gilded"),
        F.create_map(F.lit("gid_1"), "silver", F.lit("gid_3"), "platinum").alias("gildings"),
        seconds("created").alias("created_utc"), seconds("timestamp").alias("seen_utc"))
    rows = rec.thread_rows(raw, "minimal")
    return rows.select("id", "author_name", "subreddit", "domain", "score", "num_comments", "gold", "silver", "platinum",
                       "scrape_mode", "created", "timestamp_utc")


@query(
    "edited_nullable",
    """SELECT id, CASE WHEN gold = 1 THEN NULL WHEN silver = 1 THEN NULL ELSE created END AS edited FROM comments""",
)
def edited_nullable(t):
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("created"))
    raw = F.when(F.col("gold") == 1, F.lit(0)).when(F.col("silver") == 0, epoch)
    return t.comments.select("id", sc.edited(raw).alias("edited"))


@query(
    "strip_kind_prefix",
    """SELECT CAST(id AS VARCHAR) AS id, CONCAT('t3_', thread_id) AS thread_name, gold = 1 OR silver = 1 AS parent_ok FROM comments""",
)
def strip_kind_prefix(t):
    named = F.concat(F.lit("t1_"), F.col("id").cast("string"))
    parent = F.when(F.col("gold") == 1, named).when(F.col("silver") == 1, F.col("id").cast("string")).otherwise("t1_x")
    return t.comments.select(
        sc.bare_id(named).alias("id"),
        sc.prefixed_id(F.col("thread_id").cast("string"), 3).alias("thread_name"),
        sc.is_parent(parent, F.col("id").cast("string")).alias("parent_ok"),
    )


@query("presence_flag", "SELECT id, author_name IS NOT NULL AS has_author FROM comments")
def presence_flag(t):
    return t.comments.select("id", sc.flag("author_name").alias("has_author"))


def gildings(silver: str = "silver", gold: str = "gold", platinum: str = "platinum"):
    """Raw record form: only the metals that were given appear in the map."""
    full = F.create_map(F.lit("gid_1"), F.col(silver), F.lit("gid_2"), F.col(gold), F.lit("gid_3"), F.col(platinum))
    return F.map_filter(full, lambda k, v: v > 0)


@query("map_default", "SELECT id, silver, gold, platinum FROM comments")
def map_default(t):
    m = t.comments.select("id", gildings().alias("m"))
    return m.select("id", *[sc.map_get("m", k).alias(v) for k, v in nz.GILDING_KEYS.items()])


@query(
    "map_sum_by_member",
    """SELECT * FROM (SELECT author_name, CAST(SUM(silver) AS BIGINT) AS comments_silver,
      CAST(SUM(gold) AS BIGINT) AS comments_gold, CAST(SUM(platinum) AS BIGINT) AS comments_platinum
      FROM comments WHERE author_name IS NOT NULL GROUP BY author_name) c
    FULL JOIN (SELECT author_name, CAST(SUM(silver) AS BIGINT) AS submissions_silver,
      CAST(SUM(gold) AS BIGINT) AS submissions_gold, CAST(SUM(platinum) AS BIGINT) AS submissions_platinum
      FROM threads WHERE author_name IS NOT NULL GROUP BY author_name) s USING (author_name)""",
)
def map_sum_by_member(t):
    raw = lambda df: df.filter("author_name IS NOT NULL").select("author_name", gildings().alias("m"))
    c = nz.sum_maps(raw(t.comments), "author_name", "m", "comments_")
    s = nz.sum_maps(raw(t.threads), "author_name", "m", "submissions_")
    return c.join(s, "author_name", "full_outer")


def award_records(t):
    """Raw comment records: an array of the awards that were given."""
    site = F.lit(None).cast("string")
    award = lambda col, where: F.struct(
        F.lit(col).alias("name"), where.alias("subreddit_id"), F.col(col).alias("count")
    )
    given = F.array(award("gold", site), award("silver", F.col("subreddit")), award("platinum", site))
    return t.comments.select(
        F.col("id").alias("comment_id"), F.filter(given, lambda a: a["count"] > 0).alias("awards")
    )


AWARD_FACTS = """SELECT id AS comment_id, 'gold' AS award_name, CAST(NULL AS VARCHAR) AS subreddit_id, gold AS award_count
  FROM comments WHERE gold > 0
UNION ALL SELECT id, 'silver', subreddit, silver FROM comments WHERE silver > 0
UNION ALL SELECT id, 'platinum', NULL, platinum FROM comments WHERE platinum > 0"""


query("award_facts", AWARD_FACTS)(lambda t: nz.award_facts(award_records(t), "comment_id"))


@query(
    "award_dim",
    f"""SELECT DISTINCT award_name AS name, subreddit_id FROM ({AWARD_FACTS}) f
    WHERE award_name <> 'gold' AND NOT EXISTS (SELECT 1 FROM supplier
      WHERE s_acctbal > 3000 AND award_name = 'silver' AND CONCAT('g', s_suppkey) = f.subreddit_id)""",
)
def award_dim(t):
    found = nz.award_facts(award_records(t), "comment_id").select(F.col("award_name").alias("name"), "subreddit_id")
    stored = t.supplier.filter("s_acctbal > 3000").select(
        F.lit("silver").alias("name"), F.concat(F.lit("g"), "s_suppkey").alias("subreddit_id")
    )
    site_wide = t.spark.createDataFrame([("gold", None)], "name string, subreddit_id string")
    return nz.new_awards(found, stored.unionByName(site_wide))


@query(
    "traffic_rows",
    """SELECT subreddit, 'day' AS period_type, created AS time, CAST(num_comments AS BIGINT) AS unique_visits,
      CAST(num_comments + 7 AS BIGINT) AS total_visits FROM threads
    UNION ALL SELECT subreddit, 'hour', created + INTERVAL 1 HOUR, num_comments, num_comments + 1 FROM threads
    UNION ALL SELECT subreddit, 'hour', created + INTERVAL 2 HOUR, num_comments, num_comments + 2 FROM threads""",
)
def traffic_rows(t):
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("created"))
    visits = F.col("num_comments").cast("bigint")
    records = t.threads.select(
        "subreddit",
        F.array(F.array(epoch, visits, visits + 7)).alias("day"),
        F.array(F.array(epoch + 3600, visits, visits + 1), F.array(epoch + 7200, visits, visits + 2)).alias("hour"),
    )
    return nz.traffic(records)


@query(
    "rules_json",
    """SELECT event_id, CONCAT('{"name":"', event_type, '","limit":', CAST(props->>'$.k' AS BIGINT), '}') AS rules,
      CAST(props->>'$.k' AS BIGINT) AS parsed FROM events""",
)
def rules_json(t):
    k = F.from_json("props", "k bigint")["k"]
    return t.events.select(
        "event_id",
        sc.rules_json(F.struct(F.col("event_type").alias("name"), k.alias("limit"))).alias("rules"),
        k.alias("parsed"),
    )


@query(
    "account_status",
    """SELECT username, CASE WHEN deleted_by_date IS NOT NULL THEN 'deleted' WHEN suspended_by_date IS NOT NULL
      THEN 'suspended' WHEN shadowbanned_by_date IS NOT NULL THEN 'shadowbanned' ELSE 'active' END AS status FROM users_t2""",
)
def account_status(t):
    status = sc.account_status("deleted_by_date", "suspended_by_date", "shadowbanned_by_date")
    return t.users_t2.select("username", status.alias("status"))


LINK = 'href="/([^"]+)"'


@query(
    "extract_mentions",
    f"""SELECT page_id, LOWER(m) AS related_subreddit, 'wiki' AS relationship_type, url AS wiki_name FROM (
      SELECT page_id, url, UNNEST(REGEXP_EXTRACT_ALL(text, '{LINK}', 1)) AS m FROM mention_pages) x""",
)
def extract_mentions(t):
    return nz.mentions(t.mention_pages, "text", LINK, "wiki", F.col("url")).drop("url")


HOST_SQL = "REGEXP_EXTRACT(url, '^[a-z]+://([^/:?#]+)', 1)"


@query(
    "drop_empty_pages",
    f"""WITH p AS (SELECT {HOST_SQL} AS subreddit, page_id,
      CASE WHEN html LIKE '%<pre>%' OR LENGTH(html) < 2500 THEN '' ELSE html END AS content FROM pages)
    SELECT page_id, subreddit, LENGTH(content) AS size FROM p WHERE content <> ''
      AND subreddit IN (SELECT subreddit FROM p GROUP BY subreddit HAVING COUNT(*) <= 6)""",
)
def drop_empty_pages(t):
    blank = F.col("html").contains("<pre>") | (F.length("html") < 2500)
    pages = t.pages.select(
        sc.domain("url").alias("subreddit"), "page_id", F.when(blank, "").otherwise(F.col("html")).alias("content")
    )
    return nz.wiki_pages(pages, 6).select("page_id", "subreddit", F.length("content").alias("size"))


@query("url_domain", f"SELECT page_id, {HOST_SQL} AS domain FROM pages")
def url_domain(t):
    return t.pages.select("page_id", sc.domain("url").alias("domain"))


@query(
    "position_rank",
    """SELECT subreddit, username, ROW_NUMBER() OVER (PARTITION BY subreddit ORDER BY top DESC, username) - 1 AS pos
    FROM (SELECT subreddit, username, MAX(pos) AS top FROM moderators GROUP BY subreddit, username) m""",
)
def position_rank(t):
    ranked = t.moderators.groupBy("subreddit", "username").agg(F.max("pos").alias("top"))
    return nz.with_pos(ranked, "subreddit", [F.col("top").desc(), F.col("username")]).drop("top")


# ---- merge, freshness and history ------------------------------------------------------------


@query(
    "last_seen",
    """SELECT id, MAX(timestamp) AS last_seen FROM threads WHERE scrape_mode = 'thread' GROUP BY id""",
)
def last_seen_threads(t):
    return last_seen(t.threads, "id", cond=F.col("scrape_mode") == "thread")


@query("last_seen_groups", "SELECT LOWER(subreddit) AS subreddit, MAX(timestamp) AS last_seen FROM comments GROUP BY 1")
def last_seen_groups(t):
    return last_seen(t.comments, "subreddit", case_insensitive=True)


USER_COLS = ["username", "id", "comment_karma", "post_karma", "is_mod", "timestamp"]


def patched(cols: list[str], key: str) -> str:
    return ", ".join(c if c == key else f"COALESCE(s.{c}, t.{c}) AS {c}" for c in cols)


@query(
    "merge_users",
    f"""WITH t AS (SELECT * FROM users_t1 WHERE comment_karma > 0 OR is_mod)
    SELECT {patched(USER_COLS, 'username')} FROM t FULL JOIN (SELECT n.* FROM users_t2 n LEFT JOIN t o
      ON n.username = o.username
      WHERE o.username IS NULL OR EPOCH(n.timestamp) - EPOCH(o.timestamp) >= 7 * 86400) s USING (username)""",
)
def merge_users(t):
    # Second-snapshot rows are three and a half days younger (fresh) or a year and a half.
    target = t.users_t1.filter("comment_karma > 0 OR is_mod").select(USER_COLS)
    return mg.merge_users(target, t.users_t2.select(USER_COLS), delay=7)


THREAD_COLS = ["id", "author_name", "subreddit", "domain", "score", "num_comments", "scrape_mode", "timestamp"]
STORED_THREADS = "SELECT * FROM threads WHERE gold = 0"
NEW_THREADS = """SELECT id, author_name, subreddit, CASE WHEN silver = 1 THEN NULL ELSE domain END AS domain,
  CASE WHEN platinum = 1 THEN NULL ELSE score + 100 END AS score, num_comments + 1 AS num_comments, scrape_mode,
  timestamp + INTERVAL 3 DAY AS timestamp FROM threads"""


def stored_threads(t):
    return t.threads.filter("gold = 0").select(THREAD_COLS)


def new_threads(t):
    return t.threads.select(
        "id",
        "author_name",
        "subreddit",
        F.when(F.col("silver") == 0, F.col("domain")).alias("domain"),
        F.when(F.col("platinum") == 0, F.col("score") + 100).alias("score"),
        (F.col("num_comments") + 1).alias("num_comments"),
        "scrape_mode",
        (F.col("timestamp") + F.make_dt_interval(F.lit(3))).alias("timestamp"),
    )


@query(
    "merge_threads",
    f"""SELECT {patched(THREAD_COLS, 'id')} FROM ({STORED_THREADS}) t FULL JOIN (SELECT * FROM ({NEW_THREADS}) n
      WHERE scrape_mode = 'thread' OR id NOT IN (SELECT id FROM ({STORED_THREADS}) k)) s USING (id)""",
)
def merge_threads(t):
    return mg.merge_threads(stored_threads(t), new_threads(t), delay=2)


@query(
    "merge_threads_history",
    f"""SELECT {', '.join(THREAD_COLS)} FROM ({STORED_THREADS}) t UNION ALL
    SELECT {', '.join(THREAD_COLS)} FROM ({NEW_THREADS}) n
      WHERE scrape_mode = 'thread' OR id NOT IN (SELECT id FROM ({STORED_THREADS}) k)""",
)
def merge_threads_history(t):
    return mg.merge_threads(stored_threads(t), new_threads(t), delay=5, history=True)


COMMENT_COLS = ["id", "author_name", "subreddit", "score", "text", "scrape_mode", "created", "timestamp"]
TIES = ("created", "score", "subreddit", "text")


# Rows of one id in the order of their age; the newest non-NULL value of a column counts.
NUMBERED = "SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY timestamp, created, score, subreddit, text) AS n FROM ({}) b"


def reduced(rows: str) -> str:
    newest = ", ".join(f"ARG_MAX({c}, n) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in COMMENT_COLS if c != "id")
    return f"SELECT id, {newest} FROM ({NUMBERED.format(rows)}) c GROUP BY id"


STORED_COMMENTS = reduced("SELECT * FROM comments WHERE score < 10")


def stored_comments(t):
    rows = t.comments.filter("score < 10").select(COMMENT_COLS)
    return mg.reduce_batch(rows, "id", ["timestamp", *TIES])


@query(
    "merge_comments",
    f"""WITH stored AS ({STORED_COMMENTS}), batch AS (
      {reduced("SELECT * FROM comments WHERE scrape_mode = 'thread' OR id NOT IN (SELECT id FROM stored)")})
    SELECT {patched(COMMENT_COLS, 'id')} FROM stored t FULL JOIN batch s USING (id)""",
)
def merge_comments(t):
    return mg.merge_comments(stored_comments(t), t.comments.select(COMMENT_COLS), ties=TIES)


FILE_ROWS = 250_000


def by_files(t, target, source, key, policy, ties=()):
    """The same merge into a stored table of several files; only those that can hold a key of the batch are written anew."""
    store = Store(t.spark, scratch_path(t.spark, "merged"), target.schema, key, rows_per_file=FILE_ROWS)
    store.append(target)
    store.merge(source, policy, ties=ties)
    return store.read()


@query("merge_users_by_files", like="merge_users")
def merge_users_by_files(t):
    target = t.users_t1.filter("comment_karma > 0 OR is_mod").select(USER_COLS)
    return by_files(t, target, t.users_t2.select(USER_COLS), "username", mg.policy_users(7))


@query("merge_threads_by_files", like="merge_threads")
def merge_threads_by_files(t):
    return by_files(t, stored_threads(t), new_threads(t), "id", mg.policy_threads(2))


@query("merge_comments_by_files", like="merge_comments")
def merge_comments_by_files(t):
    return by_files(t, stored_comments(t), t.comments.select(COMMENT_COLS), "id", mg.policy_comments(), TIES)


GROUP_COLS = ["subreddit", "subscribers", "title", "timestamp"]


@query(
    "merge_subreddits",
    """WITH s AS (SELECT s_suppkey % 60 AS k, CONCAT('G', s_suppkey % 60) AS subreddit, CAST(FLOOR(s_acctbal) AS BIGINT) AS subscribers,
        CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS title, s_suppkey AS n FROM supplier),
      b AS (SELECT k, ARG_MAX(subreddit, n) AS subreddit, ARG_MAX(subscribers, n) AS subscribers,
        ARG_MAX(title, n) FILTER (WHERE title IS NOT NULL) AS title, MAX(n) AS n FROM s GROUP BY k),
      o AS (SELECT n_nationkey AS k, CONCAT('g', n_nationkey) AS subreddit, CAST(0 AS BIGINT) AS subscribers, n_name AS title,
        CAST(-1 AS BIGINT) AS n FROM nation)
    SELECT COALESCE(o.subreddit, b.subreddit) AS subreddit, COALESCE(b.subscribers, o.subscribers) AS subscribers,
      COALESCE(b.title, o.title) AS title, COALESCE(b.n, o.n) AS n FROM o FULL JOIN b ON o.k = b.k""",
)
def merge_subreddits(t):
    stored = t.nation.select(
        F.concat(F.lit("g"), "n_nationkey").alias("subreddit"), F.lit(0).cast("bigint").alias("subscribers"),
        F.col("n_name").alias("title"), F.lit(-1).cast("bigint").alias("n"),
    )
    source = t.supplier.select(
        F.concat(F.lit("G"), F.col("s_suppkey") % 60).alias("subreddit"),
        F.floor("s_acctbal").alias("subscribers"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("title"),
        F.col("s_suppkey").alias("n"),
    )
    return mg.merge_subreddits(stored, source, ts=None, ties=("n",))


TRAFFIC = """SELECT subreddit, 'day' AS period_type, created AS time, CAST({agg}(num_comments) AS BIGINT) AS total_visits,
  {agg}(id) AS seen FROM threads {where} GROUP BY subreddit, created"""


@query(
    "merge_traffic",
    f"""SELECT subreddit, period_type, time, COALESCE(s.total_visits, t.total_visits) AS total_visits,
      COALESCE(s.seen, t.seen) AS seen
    FROM ({TRAFFIC.format(agg='MIN', where="WHERE scrape_mode = 'thread'")}) t
    FULL JOIN (SELECT subreddit, 'day' AS period_type, created AS time,
      ARG_MAX(CAST(num_comments AS BIGINT), id) AS total_visits, MAX(id) AS seen
      FROM threads WHERE score > 10 GROUP BY subreddit, created) s USING (subreddit, period_type, time)""",
)
def merge_traffic(t):
    stored = (
        t.threads.filter("scrape_mode = 'thread'")
        .groupBy("subreddit", F.lit("day").alias("period_type"), F.col("created").alias("time"))
        .agg(F.min("num_comments").cast("bigint").alias("total_visits"), F.min("id").alias("seen"))
    )
    source = t.threads.filter("score > 10").select(
        "subreddit", F.lit("day").alias("period_type"), F.col("created").alias("time"),
        F.col("num_comments").cast("bigint").alias("total_visits"), F.col("id").alias("seen"),
    )
    return mg.merge_traffic(stored, source, ts=None, ties=("seen",))


@query(
    "upsert_award_counts",
    """WITH o AS (SELECT author_name AS username, 'gold' AS award_name, 'old' AS subreddit_id, CAST(1 AS BIGINT) AS award_count
        FROM threads WHERE author_name IS NOT NULL GROUP BY author_name),
      n AS (SELECT author_name AS username, 'gold' AS award_name, 'new' AS subreddit_id, CAST(SUM(gold) AS BIGINT) AS award_count
        FROM comments WHERE author_name IS NOT NULL GROUP BY author_name
        UNION ALL SELECT author_name, 'silver', 'new', CAST(SUM(silver) AS BIGINT) FROM comments
        WHERE author_name IS NOT NULL GROUP BY author_name)
    SELECT username, award_name, COALESCE(o.subreddit_id, n.subreddit_id) AS subreddit_id,
      COALESCE(n.award_count, o.award_count) AS award_count FROM o FULL JOIN n USING (username, award_name)""",
)
def upsert_award_counts(t):
    owner = F.col("author_name").alias("username")
    stored = t.threads.filter("author_name IS NOT NULL").select(
        owner, F.lit("gold").alias("award_name"), F.lit("old").alias("subreddit_id"),
        F.lit(1).cast("bigint").alias("award_count"),
    ).distinct()
    given = lambda metal: (
        t.comments.filter("author_name IS NOT NULL").groupBy(owner, F.lit(metal).alias("award_name"))
        .agg(F.sum(metal).alias("award_count"))
        .select("username", "award_name", F.lit("new").alias("subreddit_id"), "award_count")
    )
    source = given("gold").unionByName(given("silver"))
    return mg.upsert_award_counts(stored, source, "username", ts=None, ties=("award_count",))


@query(
    "insert_ignore",
    """SELECT username, post_karma FROM users_t2 UNION ALL
    SELECT username, post_karma FROM users_t1 WHERE username NOT IN (SELECT username FROM users_t2)""",
)
def insert_ignore(t):
    cols = ["username", "post_karma"]
    return mg.append_missing(t.users_t2.select(cols), t.users_t1.select(cols), "username")


PATCH_COLS = ["username", "id", "comment_karma", "shadowbanned_by_date", "suspended_by_date"]


@query(
    "patch_non_null",
    f"SELECT {patched(PATCH_COLS, 'username')} FROM users_t1 t FULL JOIN users_t2 s USING (username)",
)
def patch_non_null(t):
    return mg.patch(t.users_t1.select(PATCH_COLS), t.users_t2.select(PATCH_COLS), "username")


@query(
    "append_history",
    """SELECT username, timestamp, comment_karma FROM users_t1 UNION ALL
    SELECT username, timestamp, comment_karma FROM users_t2""",
)
def append_history(t):
    cols = ["username", "timestamp", "comment_karma"]
    return mg.append(t.users_t1.select(cols), t.users_t2.select(cols))


@query(
    "latest_view",
    """SELECT username, timestamp, comment_karma FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY username
      ORDER BY timestamp DESC) AS rn FROM (SELECT username, timestamp, comment_karma FROM users_t1 UNION ALL
      SELECT username, timestamp, comment_karma FROM users_t2) h) r WHERE rn = 1""",
)
def latest_view(t):
    return latest(append_history(t), "username")


FIRST_COLS = ["id", "author_name", "subreddit", "score", "text", "created"]


@query(
    "first_wins_dedupe",
    f"""SELECT {', '.join(FIRST_COLS)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id
      ORDER BY created, score, subreddit, text) AS rn FROM comments) r WHERE rn = 1""",
)
def first_wins_dedupe(t):
    order = [F.col(c) for c in ("created", "score", "subreddit", "text")]
    return first_by_key(t.comments.select(FIRST_COLS), "id", order)
