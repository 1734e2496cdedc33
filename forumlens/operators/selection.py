"""Exact order statistics by refining histograms; no value is sorted or gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.operators.ranking import match_keys
from forumlens.session import freeze

BINS = 256


def _magnitude(v: Column) -> Column:
    """Order of size with sign: monotone over all doubles, even where values span hundreds of decades."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + 746))  # above -ln of the least double


def _bin(value: Column, low: Column, high: Column, bins: int, by_magnitude: bool) -> Column:
    """Monotone in ``value``; the ends have bins of their own, so every pass narrows a range."""
    scale = _magnitude if by_magnitude else (lambda v: v / 2)  # halves can't overflow
    share = F.coalesce(F.try_divide(scale(value) - scale(low), scale(high) - scale(low)), F.lit(0.0))
    inner = 1 + F.least(F.greatest(F.floor(F.nanvl(share, F.lit(0.0)) * (bins - 2)), F.lit(0)), F.lit(bins - 3))
    return F.when(value == low, 0).when(value == high, bins - 1).otherwise(inner)


def values_at(rows: DataFrame, ranks: DataFrame, key: str, value: str, bins: int = BINS) -> DataFrame:
    """(key, rank, value): the value at each 0-based rank of its key's values in ascending order (NaN last, NULL values aside).

    ``ranks`` has (key, rank).  Each pass counts, per key, how many values fall into the bins of the ranges that ranks are
    known to lie in, and keeps for each rank the bin that holds it, tightened to its least and greatest value.  Counts are combined
    in the tasks, so a hot key moves no more rows than others; ranges shrink by a factor of about ``bins`` a pass, by value and by
    magnitude in turn, and a rank is done when its range is one value.  Ranks a key doesn't have give no row.
    """
    rows = freeze(rows.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull()), "values")
    ends = rows.groupBy("k").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    asked = ranks.select(F.col(key).alias("_k"), F.col("rank").cast("long").alias("rank")).distinct()
    state = ends.join(asked, F.col("k").eqNullSafe(F.col("_k"))).filter((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    state = freeze(state.select("k", "rank", "low", "high", F.lit(0).cast("long").alias("before")), "ranks")
    span = ["k", "low", "high", "before"]
    by_magnitude = False
    while not (open_ := state.filter(F.col("low") < F.col("high"))).isEmpty():
        ranges = open_.select(*(F.col(c).alias(f"_{c}") for c in span)).distinct()
        met = rows.join(ranges, F.col("k").eqNullSafe(F.col("_k")) & F.col("v").between(F.col("_low"), F.col("_high")))
        counted = met.groupBy("_k", "_low", "_high", "_before", _bin(F.col("v"), F.col("_low"), F.col("_high"), bins, by_magnitude).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("from"), F.max("v").alias("to"))
        # At most ``bins`` rows a range.
        order = Window.partitionBy("_k", "_low", "_high").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        upto = counted.withColumn("upto", F.col("_before") + F.sum("c").over(order))
        held = open_.join(upto, match_keys(["k", "low", "high"], "_")).filter(
            (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
        narrowed = held.select("k", "rank", F.col("from").alias("low"), F.col("to").alias("high"), (F.col("upto") - F.col("c")).alias("before"))
        state = freeze(state.filter(~(F.col("low") < F.col("high"))).unionByName(narrowed), "ranks")
        by_magnitude = not by_magnitude
    return state.select(F.col("k").alias(key), "rank", F.col("low").alias(value))


def five_number(df: DataFrame, key: str = "term", value: str = "ratio") -> DataFrame:
    """Minimum, quartiles and maximum per key, interpolated between ranks."""
    present = freeze(df.filter(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias(value)), "present")
    sizes = freeze(present.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    quartiles = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    at = {name: F.lit(q) * (F.col("_n") - 1) for name, q in quartiles.items()}
    wanted = F.array(*(f(a).cast("long") for a in at.values() for f in (F.floor, F.ceil)))
    found = values_at(present, sizes.select(key, F.explode(wanted).alias("rank")), key, value)
    joined = sizes.join(found.select(F.col(key).alias("_of"), "rank", F.col(value).alias("_v")), F.col(key).eqNullSafe(F.col("_of")))

    def cell(name: str) -> Column:
        pick = lambda f: F.max(F.when(F.col("rank") == f(at[name]), F.col("_v")))
        low, high = pick(F.floor), pick(F.ceil)
        return (low + (high - low) * F.max(at[name] - F.floor(at[name]))).alias(name)

    return joined.groupBy(key).agg(*map(cell, quartiles))
