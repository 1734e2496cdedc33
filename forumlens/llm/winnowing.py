"""Benchmark passages in documents by winnowed fingerprints, in DataFrame operations only.

Every ``WINDOW`` consecutive words hold ``WINDOW - GRAM + 1`` grams of ``GRAM`` words; the least of
their hashes is the window's fingerprint.  Neighbouring windows mostly share theirs, so a document
emits one row per run of equal fingerprints, with the hashes of the run's windows.  A shared span of
``WINDOW`` words has one fingerprint wherever it stands: joining the fingerprints of documents and
items misses none.  A hit is extended over the windows of its run by comparing the windows' own
hashes (independent 64 bits on top of the fingerprint's 64), and hit windows are merged into spans.

Items shorter than a window are one window of their own length: for each such length the grams of
that length are joined directly.

Equal fingerprints and windows of many items are joined once and spread to items at the end, so a
passage that many items share doesn't multiply the rows of the documents.

Defined results: null or empty text: no words, not contaminated; items without words never occur;
rows equal in doc_id and text get one result; an item_id on several rows counts once per document;
null item ids are left out of ``items_sha256`` and count as one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.text import same, words
from forumlens.session import freeze

WINDOW = 10
GRAM = 6
DOC = ["doc_id", "th"]


def _after(values: str, n: int) -> Column:
    return F.slice(values, n + 1, F.greatest(F.size(values) - n, F.lit(0)))


def _grams(df: DataFrame, n: int, name: str, base: str = "_h") -> DataFrame:
    """Hash of every n consecutive words, from grams of half the length (tail values are void)."""
    if n == 1:
        return df.withColumn(name, F.col(base))
    half = n // 2
    df = _grams(df, half, f"{name}_{half}", base)
    low = f"{name}_{half}"
    if n % 2:
        df = df.withColumn(f"{name}_e", F.zip_with(low, _after(low, half), lambda a, b: F.xxhash64(a, b)))
        return df.withColumn(name, F.zip_with(f"{name}_e", _after(base, n - 1), lambda a, b: F.xxhash64(b, a)))
    return df.withColumn(name, F.zip_with(low, _after(low, half), lambda a, b: F.xxhash64(a, b)))


def _least(df: DataFrame, n: int, of: str, name: str) -> DataFrame:
    """Least of every n consecutive values (tail values are void)."""
    have, reach = of, 1
    while reach < n:
        by = min(reach, n - reach)
        step = f"{name}_{reach}"
        df = df.withColumn(step, F.zip_with(have, _after(have, by), lambda a, b: F.least(a, b)))
        have, reach = step, reach + by
    return df.withColumn(name, F.col(have))


def hashed(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_words and the word hashes of every row, stored: all that follows is made of them."""
    split = df.select(*keys, words(F.col("text")).alias("_w"))
    return freeze(split.select(*keys, F.size("_w").cast("long").alias("n_words"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h")), "word_hashes")


def fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per run of equal fingerprints: keys, fp, start (first window), _h (word hashes of its windows)."""
    df = df.filter(F.col("n_words") >= WINDOW)
    df = _least(_grams(df, GRAM, "_g"), WINDOW - GRAM + 1, "_g", "_m")
    n = (F.col("n_words") - WINDOW + 1).cast("int")
    df = df.select(*keys, "_h", F.slice("_m", F.lit(1), n).alias("_m"))
    starts = F.filter(F.sequence(F.lit(1), F.size("_m")), lambda i: (i == 1) | (F.get("_m", i - 1) != F.get("_m", i - 2)))
    df = df.withColumn("_s", starts)
    runs = F.transform("_s", lambda s, k: F.struct(
        s.alias("start"), F.get("_m", s - 1).alias("fp"),
        F.slice("_h", s, F.coalesce(F.get("_s", k + 1), F.size("_m") + 1) - s + WINDOW - 1).alias("_h")))
    return df.select(*keys, F.explode(runs).alias("_r")).select(*keys, "_r.start", "_r.fp", "_r._h")


def _windows(df: DataFrame) -> DataFrame:
    """Adds the hashes of a run's windows."""
    return _grams(df, WINDOW, "_x").withColumn("windows", F.slice("_x", F.lit(1), F.size("_h") - WINDOW + 1)).drop("_x")


def _short(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """Every gram of the given lengths, in one reading: keys, start, len, x."""
    df = df.filter(F.col("n_words") >= min(lengths))
    for n in lengths:
        df = _grams(df, n, f"_x{n}")
    of_length = lambda n: F.transform(
        F.slice(f"_x{n}", F.lit(1), F.greatest(F.col("n_words") - n + 1, F.lit(0)).cast("int")),
        lambda x, k: F.struct((k + 1).alias("start"), F.lit(n).alias("len"), x.alias("x")))
    return df.select(*keys, F.inline(F.concat(*map(of_length, lengths))))


def item_windows(items: DataFrame) -> DataFrame:
    """fp, x (hash of the window), len, item_id of items of a window or more."""
    runs = _windows(fingerprints(items, ["item_id"]))
    return runs.select("fp", F.explode("windows").alias("x"), F.lit(WINDOW).alias("len"), "item_id").distinct()


def short_lengths(items: DataFrame) -> list[int]:
    """Lengths below WINDOW that some item has (at most WINDOW - 1 of them)."""
    sized = items.filter((F.col("n_words") > 0) & (F.col("n_words") < WINDOW))
    return sorted(r[0] for r in sized.select("n_words").distinct().collect())


def hits(source: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hit windows (doc_id, th, start, len, x) and the items of every window (x, len, item_id), from the stored word hashes."""
    wanted = freeze(item_windows(items), "item_windows")
    known = wanted.select(F.col("fp").alias("_fp"), "x").distinct().groupBy("_fp").agg(F.collect_set("x").alias("_xs"))
    # Windows are hashed for runs whose fingerprint is an item's, and for no others.
    met = _windows(fingerprints(source, DOC).join(known, F.col("fp") == F.col("_fp")))
    inside = F.filter(
        F.transform("windows", lambda x, k: F.struct((F.col("start") + k).alias("start"), x.alias("x"))),
        lambda w: F.array_contains("_xs", w["x"]))
    found = met.select(*DOC, F.inline(inside)).select(*DOC, "start", F.lit(WINDOW).alias("len"), "x")
    owners = wanted.select("x", "len", "item_id")
    lengths = short_lengths(items)
    if lengths:
        few = _short(items, ["item_id", "n_words"], lengths).filter(F.col("len") == F.col("n_words")).select("x", "len", "item_id").distinct()
        known = few.select(F.col("x").alias("_x"), F.col("len").alias("_len")).distinct()
        grams = _short(source, DOC, lengths).join(known, (F.col("x") == F.col("_x")) & (F.col("len") == F.col("_len")), "left_semi")
        found = found.unionByName(grams.select(*DOC, "start", "len", "x"))
        owners = owners.unionByName(few)
    return found, owners


def _hashed_both(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    source = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return hashed(source, DOC), hashed(items.select("item_id", "text"), ["item_id"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    source, items = _hashed_both(docs, items)
    found, owners = hits(source, items)
    found = freeze(found, "hits")
    spans = found.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("stop")))).alias("s"))
    # The windows stand in order of their start: each adds what lies beyond the furthest stop so far.
    covered = F.aggregate(
        "s", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, w: F.struct(
            (a["n"] + F.greatest(w["stop"] - F.greatest(w["start"], a["upto"]), F.lit(0))).alias("n"),
            F.greatest(a["upto"], w["stop"]).alias("upto")),
        lambda a: a["n"])
    spans = spans.select(*DOC, covered.cast("long").alias("n_hit"))
    present = found.select(*DOC, "x", "len").distinct()
    owners = owners.select(F.col("x").alias("_x"), F.col("len").alias("_len"), F.coalesce(F.col("item_id").cast("string"), F.lit("\0")).alias("item"))
    named = present.join(owners, (F.col("x") == F.col("_x")) & (F.col("len") == F.col("_len"))).groupBy(*DOC).agg(F.collect_set("item").alias("i"))
    named = named.select(
        F.col("doc_id").alias("_d2"), F.col("th").alias("_t2"), F.size("i").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.array_remove("i", "\0")), ",").alias("ids"))
    rows = source.select(*DOC, "n_words")
    spans = spans.select(F.col("doc_id").alias("_d1"), F.col("th").alias("_t1"), "n_hit")
    both = spans.join(named, same(["_d1", "_t1"], ["_d2", "_t2"]))
    joined = rows.join(both, same(DOC, ["_d1", "_t1"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "th", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without any benchmark window."""
    found, _ = hits(*_hashed_both(docs, items))
    bad = found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct()
    return docs.withColumn("_th", F.xxhash64("text")).join(bad, same(["doc_id", "_th"], ["_d", "_t"]), "left_anti").drop("_th")
