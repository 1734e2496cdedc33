"""Removal of repeated line runs by a suffix array over line ids, in DataFrame operations only.

Non-blank lines become 128-bit ids; white space at their ends doesn't count, and any run of it within is one blank.  Only ids that occur twice can belong to a repeated
run, so a suffix reaches from such a line to the end of its unbroken stretch of such lines.

* Suffix ranks by prefix doubling: round k orders the suffixes of one class (equal first 2^k lines)
  by the rank of the suffix 2^k lines on.  Ranks are (line id, offset); a class keeps its range of
  offsets, so no global sort is needed, and counts are combined per class pair before they are
  ordered.  Stretches shorter than 2^k leave the rounds.
* Common prefixes of neighbours in the array: the round in which two ranks part bounds them within
  a factor of two; pairs whose predecessors are neighbours too inherit theirs less one, the others
  compare the lines in question.
* Every suffix then finds the longest prefix interval that holds an earlier suffix, by halving the
  positions (``longest_earlier``).  Equal suffixes, the hot case, are one entry of the array; all but
  the first of them have an earlier copy to the end.

A run of at least ``min_words`` words (parted by white space) that occurred before (documents in order of
doc_id, then of the text's hash) is deleted; its first copy stays.  Blank lines inside a deleted run
go with it.

Defined results: null text stays null; empty text stays; rows equal in doc_id and text are one
document and get one result; a document may lose all its lines (``n_left`` 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.text import same
from forumlens.session import freeze

MIN_WORDS = 50
DOC = ["doc_id", "th"]
LINE = ["h1", "h2"]
# White space of any kind within a line, and any beyond single blanks.
SPACE = r"[\s\p{Z}\x85\x1c-\x1f&&[^\n]]+"
ODD_SPACE = r"  |[\s\p{Z}\x85\x1c-\x1f&&[^\n ]]"


def _plain(text: Column) -> Column:
    """Every run of white space but line ends as one blank; most texts have none but single blanks."""
    return F.when(text.rlike(ODD_SPACE), F.regexp_replace(text, SPACE, " ")).otherwise(text)


def line_table(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: doc_id, th, pos (among such lines), raw (among all), id, words."""
    lines = F.transform(F.split(_plain(F.col("text")), "\n", -1), lambda x, i: F.struct(F.trim(x).alias("s"), i.alias("raw")))
    named = F.transform(
        F.filter(lines, lambda x: x["s"] != ""),
        lambda x: F.struct(
            x["raw"].alias("raw"), F.xxhash64(x["s"]).alias("h1"), F.xxhash64(F.lit(7), x["s"]).alias("h2"),
            (F.length(x["s"]) - F.length(F.replace(x["s"], F.lit(" "), F.lit(""))) + 1).alias("w")))
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(named).alias("pos", "_line"))
    return rows.select(*DOC, "pos", "_line.raw", "_line.h1", "_line.h2", F.col("_line.w").cast("long").alias("w"))


def stretches(lines: DataFrame) -> DataFrame:
    """Lines whose id occurs twice, with their stretch, what is left of it, and words up to here."""
    twice = lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    twice = twice.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), "size")
    hit = lines.join(twice, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))).drop("_1", "_2")
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    once = hit.withColumn("_before", F.lag("pos").over(by_doc)).filter(F.col("_before").isNull() | (F.col("_before") != F.col("pos")))
    starts = F.when(F.col("_before").isNull() | (F.col("_before") != F.col("pos") - 1), F.col("pos"))
    upto = by_doc.rowsBetween(Window.unboundedPreceding, 0)
    cut = once.withColumn("seg", F.last(starts, ignorenulls=True).over(upto)).withColumn("words", F.sum("w").over(upto))
    whole = Window.partitionBy(*DOC, "seg")
    return cut.withColumn("end", F.max("pos").over(whole)).select(
        *DOC, "pos", "raw", "seg", "end", *LINE, "size", "w", "words")


def suffix_ranks(active: DataFrame) -> DataFrame:
    """Rank (line id, off) of every suffix, with the offsets it had after each round in ``past``."""
    state = active.withColumn("off", F.lit(0).cast("long")).withColumn("past", F.array("off"))
    along = Window.partitionBy(*DOC, "seg").orderBy("pos")
    settled, k = None, 0
    while True:
        step = 1 << k
        length = F.col("end") - F.col("seg") + 1
        done = state.filter(length <= step)
        settled = done if settled is None else settled.unionByName(done)
        going = state.filter(length > step)
        second = F.lead(F.struct(*LINE, "off"), step).over(along)
        looked = going.withColumn("_s", second).withColumns({"s1": F.col("_s.h1"), "s2": F.col("_s.h2"), "s3": F.col("_s.off")}).drop("_s")
        looked = freeze(looked, "suffixes")
        moving = looked.filter(F.col("s1").isNotNull() & (F.col("size") > 1))
        keys = [*LINE, "off", "s1", "s2", "s3"]
        classes = moving.groupBy(*keys, "size").agg(F.count(F.lit(1)).alias("c"))
        inside = Window.partitionBy(*LINE, "off").orderBy("s1", "s2", "s3")
        smaller = F.coalesce(F.sum("c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        total = F.sum("c").over(Window.partitionBy(*LINE, "off"))
        # Suffixes that end here keep the front of the class's range.
        classes = classes.select(
            *[F.col(x).alias(f"_{x}") for x in keys], F.col("c").alias("_c"),
            (F.col("off") + F.col("size") - total + smaller).alias("_to"))
        classes = freeze(classes, "classes")
        if classes.isEmpty():
            return settled.unionByName(looked.drop("s1", "s2", "s3"))
        on = F.col("h1") == F.col("_h1")
        for x in keys[1:]:
            on = on & (F.col(x) == F.col(f"_{x}"))
        moved = moving.join(classes, on).select(
            *[F.col(x) for x in active.columns if x != "size"], F.col("_c").alias("size"), F.col("_to").alias("off"), "past")
        still = looked.filter(F.col("s1").isNull() | (F.col("size") <= 1)).drop("s1", "s2", "s3")
        state = moved.unionByName(still).withColumn("past", F.array_append("past", F.col("off")))
        state = freeze(state, "suffixes")
        k += 1


def neighbour_prefixes(heads: DataFrame, active: DataFrame) -> DataFrame:
    """Adds ``lcp``: lines that a suffix shares with its predecessor in the array (0: none)."""
    order = Window.partitionBy(*LINE).orderBy("off")
    before = F.lag(F.struct(F.col("f.doc_id").alias("doc_id"), F.col("f.th").alias("th"), F.col("f.pos").alias("pos"), "left", "past")).over(order)
    pairs = heads.withColumn("_b", before)
    flat = pairs.filter(F.col("_b").isNotNull()).select(
        *LINE, "off", F.col("f.doc_id").alias("doc_id"), F.col("f.th").alias("th"), F.col("f.pos").alias("pos"),
        F.col("_b.doc_id").alias("d2"), F.col("_b.th").alias("t2"), F.col("_b.pos").alias("p2"),
        F.least("left", "_b.left").alias("_most"), "past", F.col("_b.past").alias("past2"))
    levels = F.sequence(F.lit(0), F.greatest(F.size("past"), F.size("past2")) - 1)
    at = lambda past, k: F.coalesce(F.get(past, k), F.element_at(past, -1))
    parted = F.array_min(F.filter(levels, lambda k: at("past", k) != at("past2", k)))
    flat = flat.withColumn("low", F.shiftright(F.call_function("shiftleft", F.lit(1), parted), 1))
    flat = flat.withColumn("high", F.least("_most", F.col("low") * 2 - 1)).drop("past", "past2", "_most")
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    follows = (
        (F.lag("pos").over(by_doc) == F.col("pos") - 1) & F.lag("d2").over(by_doc).eqNullSafe(F.col("d2"))
        & (F.lag("t2").over(by_doc) == F.col("t2")) & (F.lag("p2").over(by_doc) == F.col("p2") - 1))
    flat = flat.withColumn("_fresh", F.when(F.coalesce(follows, F.lit(False)), None).otherwise(F.col("pos")))
    flat = flat.withColumn("head", F.last("_fresh", ignorenulls=True).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    flat = freeze(flat.drop("_fresh"), "neighbours")
    asked = flat.filter((F.col("head") == F.col("pos")) & (F.col("high") > F.col("low")))
    probes = asked.select(*DOC, "pos", "d2", "t2", "p2", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("t"))
    here = active.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("pos").alias("_p"), F.struct(*LINE).alias("_one"))
    there = active.select(F.col("doc_id").alias("_d2"), F.col("th").alias("_t2"), F.col("pos").alias("_p2"), F.struct(*LINE).alias("_two"))
    met = (
        probes.withColumns({"q": F.col("pos") + F.col("t"), "q2": F.col("p2") + F.col("t")})
        .join(here, same([*DOC, "q"], ["_d", "_t", "_p"])).join(there, same(["d2", "t2", "q2"], ["_d2", "_t2", "_p2"])))
    differ = met.filter(F.col("_one") != F.col("_two")).groupBy(*DOC, "pos").agg(F.min("t").alias("_stop"))
    differ = differ.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("pos").alias("_p"), "_stop")
    heads_lcp = flat.filter(F.col("head") == F.col("pos")).join(differ, same([*DOC, "pos"], ["_d", "_t", "_p"]), "left")
    heads_lcp = heads_lcp.select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("pos").alias("_p"), F.coalesce("_stop", "high").alias("_lcp"))
    known = flat.join(heads_lcp, same([*DOC, "head"], ["_d", "_t", "_p"])).select(
        F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("off").alias("_o"),
        (F.col("_lcp") - (F.col("pos") - F.col("head"))).cast("long").alias("lcp"))
    on = (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")) & (F.col("off") == F.col("_o"))
    return heads.join(known, on, "left").select(*LINE, "n", "off", "f", F.coalesce("lcp", F.lit(0)).alias("lcp"))


def earlier_copies(active: DataFrame) -> DataFrame:
    """Runs with an earlier copy, longest per start: doc_id, th, start, end, before (words ahead of it)."""
    ranked = freeze(suffix_ranks(active), "ranked")
    first = F.struct(*DOC, "pos", (F.col("words") - F.col("w")).alias("before"))
    heads = ranked.groupBy(*LINE, "off").agg(
        F.min(first).alias("f"), F.first(F.col("end") - F.col("pos") + 1).alias("left"), F.max_by("past", F.size("past")).alias("past"))
    heads = freeze(heads, "heads")
    named = heads.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("off").alias("_o"), "f")
    on = (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")) & (F.col("off") == F.col("_o"))
    runs = ranked.join(named, on).filter(F.struct(*DOC, "pos", (F.col("words") - F.col("w")).alias("before")) > F.col("f")).select(
        *DOC, F.col("pos").alias("start"), "end", (F.col("words") - F.col("w")).alias("before"))
    several = heads.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = several.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), "n")
    contested = heads.join(several, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))).drop("_1", "_2")
    array = neighbour_prefixes(contested, active)
    found = longest_earlier(array).select(
        F.col("f.doc_id").alias("doc_id"), F.col("f.th").alias("th"), F.col("f.pos").alias("start"),
        (F.col("f.pos") + F.col("best") - 1).cast("int").alias("end"), F.col("f.before").alias("before"))
    return runs.unionByName(found)


def longest_earlier(array: DataFrame) -> DataFrame:
    """``best``: the longest prefix that a suffix shares with any suffix of an earlier position.

    The suffixes of a line id are halved by position, again and again.  In each block a suffix of the
    later half meets its nearest suffixes of the earlier half on both sides of the array; the least
    ``lcp`` in between is what they share.  Any earlier suffix is in the earlier half of just one block,
    so the rounds are the logarithm of the suffixes per id.
    """
    key = Window.partitionBy(*LINE)
    array = freeze(array.withColumn("rank", F.row_number().over(key.orderBy("f")) - 1).withColumn("best", F.lit(0).cast("long")), "array")
    most = array.agg(F.max("n")).first()[0]
    state, out = None, None
    for b in reversed(range((most - 1).bit_length() if most else 0)):
        entering = array.filter((F.col("n") > 1 << b) & (F.col("n") <= 2 << b))
        state = entering if state is None else state.unionByName(entering)
        earlier = F.shiftright("rank", b) % 2 == 0
        block = [*LINE, "block"]
        upto = Window.partitionBy(*block).orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
        one = F.when(F.col("first"), 1).otherwise(0)
        step = state.withColumn("block", F.shiftright("rank", b + 1)).withColumn("first", earlier)
        step = step.withColumn("firsts", F.sum(one).over(upto)).withColumn("seconds", F.sum(1 - one).over(upto))
        step = step.withColumn("gap", F.col("firsts") - one).withColumn("gap2", F.col("seconds") - (1 - one))
        # Suffixes of one gap lie between two of the earlier half; the second of these ends the gap.
        gap = Window.partitionBy(*block, "gap").orderBy("off")
        since = F.min("lcp").over(gap.rowsBetween(Window.unboundedPreceding, 0))
        until = F.min("lcp").over(gap.rowsBetween(1, Window.unboundedFollowing))
        closed = F.max("first").over(Window.partitionBy(*block, "gap"))
        back = F.when(F.col("gap") > 0, since).otherwise(0)
        ahead = F.when(closed, until).otherwise(0)
        met = F.when(F.col("first"), F.col("best")).otherwise(F.greatest("best", back, ahead))
        step = step.withColumn("_met", met).withColumn("_back", back)
        gap2 = Window.partitionBy(*block, "gap2").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
        own = F.when(F.col("first"), F.col("_back")).otherwise(F.when(F.col("gap2") > 0, F.min("lcp").over(gap2)).otherwise(0))
        state = freeze(step.withColumn("_own", own).select(
            *LINE, "n", "off", "f", "rank", F.col("_own").cast("long").alias("lcp"), F.col("_met").cast("long").alias("best")), "halves")
    return array.limit(0) if state is None else state.filter("best > 0")


def deleted_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Raw line ranges to delete per document: doc_id, th, cuts (array of from, to), n_removed."""
    lines = freeze(line_table(docs), "lines")
    active = freeze(stretches(lines), "stretches")
    longest = earlier_copies(active).groupBy(*DOC, "end").agg(F.min(F.struct("start", "before")).alias("s"))
    ends = active.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("pos").alias("_p"), "words")
    long = longest.join(ends, same([*DOC, "end"], ["_d", "_t", "_p"])).filter(F.col("words") - F.col("s.before") >= min_words)
    long = long.select(*DOC, F.col("s.start").alias("start"), "end")
    by_doc = Window.partitionBy(*DOC).orderBy("start", "end")
    reach = F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    isle = long.withColumn("_new", F.when(F.col("start") <= reach + 1, 0).otherwise(1))
    isle = isle.withColumn("_isle", F.sum("_new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    merged = isle.groupBy(*DOC, "_isle").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    places = active.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("pos").alias("_p"), "raw")
    one = merged.join(places, same([*DOC, "start"], ["_d", "_t", "_p"])).select(*DOC, "start", "end", F.col("raw").alias("from"))
    two = one.join(places, same([*DOC, "end"], ["_d", "_t", "_p"])).select(
        *DOC, F.struct("from", F.col("raw").alias("to")).alias("cut"), (F.col("end") - F.col("start") + 1).alias("n"))
    return two.groupBy(*DOC).agg(F.collect_list("cut").alias("cuts"), F.sum("n").alias("n_removed"))


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted, and n_removed, n_left (non-blank lines)."""
    cuts = deleted_runs(docs.select("doc_id", "text"), min_words).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("cuts").alias("_cuts"), F.col("n_removed").alias("_removed"))
    hashed = docs.drop("n_removed", "n_left").withColumn("_th", F.xxhash64("text"))
    joined = hashed.join(cuts, same(["doc_id", "_th"], ["_d", "_t"]), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.exists("_cuts", lambda c: (i >= c["from"]) & (i <= c["to"])))
    text = F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(F.concat_ws("\n", kept))
    cut = joined.withColumn("text", text).withColumn("n_removed", F.coalesce("_removed", F.lit(0)).cast("long"))
    left = F.size(F.filter(F.split(_plain(F.coalesce("text", F.lit(""))), "\n", -1), lambda x: F.trim(x) != "")).cast("long")
    return cut.withColumn("n_left", left).drop("_d", "_t", "_th", "_cuts", "_removed")
