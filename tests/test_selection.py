"""Order statistics by refined histograms against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from forumlens.operators.selection import five_number, values_at


def data():
    rng = random.Random(6)
    out = {"ints": [float(rng.randrange(50)) for _ in range(700)], "one": [3.5], "same": [2.0] * 90, "two": [1.0, 9.0],
           "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(400)],
           "close": [1.0 + k * 2.0**-52 for k in range(300)], "edges": [-math.inf, math.inf, 0.0, -1e308, 1e308, 5.0, math.inf],
           None: [rng.random() for _ in range(50)]}
    return {k: rng.sample(v, len(v)) for k, v in out.items()}


@pytest.mark.parametrize("bins", [16, 256])
def test_every_rank_equals_sorting(spark, bins):
    values = data()
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("ints", None), ("none", None)]
    frame = spark.createDataFrame(rows, "term string, ratio double")
    asked = [(k, r) for k, vs in values.items() for r in {0, 1, len(vs) // 3, len(vs) // 2, len(vs) - 1, len(vs)}]
    asked += [("none", 0), ("ints", -1)]
    got = values_at(frame, spark.createDataFrame(asked, "term string, rank long"), "term", "ratio", bins).collect()
    want = {(k, r): sorted(values[k])[r] for k, r in asked if k in values and 0 <= r < len(values[k])}
    assert {(x["term"], x["rank"]): x["ratio"] for x in got} == want and len(got) == len(want)


def test_five_numbers_make_no_range_exchange(spark):
    values = {k: v for k, v in data().items() if k != "edges"}
    frame = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("x", None)], "term string, ratio double")
    out = five_number(frame)
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["term"]: tuple(r)[1:] for r in out.collect()}

    def quantile(vs, q):
        at = q * (len(vs) - 1)
        low, high = sorted(vs)[math.floor(at)], sorted(vs)[math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    assert got == {k: pytest.approx([quantile(vs, q) for q in (0, 0.25, 0.5, 0.75, 1)]) for k, vs in values.items()}
    assert five_number(frame.filter(F.lit(False))).count() == 0
