"""Hand-made goldens of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumlens.functions import scalars as sc


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(df, col):
    return df.select(col.alias("v")).first()[0]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_scrub_replaces_zero_characters_only(one):
    assert value(one, sc.scrub(F.lit("a\u0000b"))) == "a <NULL_CHARACTER_REPLACEMENT> b"
    assert value(one, sc.scrub(F.lit(None).cast("string"))) is None


def test_epoch_pair_and_edit_mark(one):
    local, utc = one.select(*sc.epoch_pair(F.lit(86400), "-05:00")).first()
    assert utc == dt.datetime(1970, 1, 2) and local == dt.datetime(1970, 1, 1, 19)
    assert value(one, sc.edited(F.lit(0))) is None
    assert value(one, sc.edited(F.lit(None).cast("long"))) is None
    assert value(one, sc.edited(F.lit(60))) == dt.datetime(1970, 1, 1, 0, 1)


def test_ids(one):
    assert value(one, sc.bare_id(F.lit("t3_abc"))) == "abc"
    assert value(one, sc.bare_id(F.lit("abc"))) == "abc"
    assert value(one, sc.prefixed_id(F.lit("t1_abc"), 1)) == "t1_abc"
    assert value(one, sc.is_parent(F.lit("t1_abc"), F.lit("abc")))


def test_map_default(one):
    m = F.create_map(F.lit("gid_1"), F.lit(3))
    assert value(one, sc.map_get(m, "gid_1")) == 3 and value(one, sc.map_get(m, "gid_2")) == 0


def test_domain_survives_bad_urls(one):
    assert value(one, sc.domain(F.lit("https://a.example.org:80/x?y"))) == "a.example.org"
    assert value(one, sc.domain(F.lit("ht!tp://[bad"))) is None


def test_age_is_whole_elapsed_days(one):
    assert value(one, sc.whole_days(ntz("2020-03-05 00:00:00"), ntz("2020-01-01 12:00:00"))) == 63
    assert value(one, sc.elapsed_days(ntz("2020-01-02 12:00:00"), ntz("2020-01-01 00:00:00"))) == 1.5


def test_wilson(one):
    n, low, high = one.select(*sc.wilson_bounds(F.lit(5), F.lit(0.5))).first()
    assert (n, round(low, 6), round(high, 6)) == (10, 0.236593, 0.763407)
    assert tuple(one.select(*sc.wilson_bounds(F.lit(0), F.lit(0.0))).first()) == (None, None, None)


def test_wilson_contains_share(spark):
    df = spark.range(1, 200).select(F.col("id").alias("c"), (F.col("id") / 250).alias("p"))
    n, low, high = sc.wilson_bounds("c", "p")
    assert df.select((low <= F.col("p")) & (F.col("p") <= high)).distinct().collect() == [(True,)]


def test_similarity_formulas(one):
    c, a, b, u = F.lit(2), F.lit(3), F.lit(3), F.lit(5)
    assert value(one, sc.jaccard_value(c, a, b)) == 0.5
    assert round(value(one, sc.rand_value(c, a, b, u)), 6) == 0.1
    assert round(value(one, sc.adjusted_rand_value(c, a, b, u)), 6) == 0.047619


def test_clamp_keeps_null(one):
    assert value(one, sc.clamp(F.lit(0.01), 0.03)) == 0.03
    assert value(one, sc.clamp(F.lit(None).cast("double"), 0.03)) is None


@pytest.mark.parametrize(
    "deleted,suspended,shadow,status",
    [("x", "x", "x", "deleted"), (None, "x", "x", "suspended"), (None, None, "x", "shadowbanned"),
     (None, None, None, "active")],
)
def test_account_status(spark, deleted, suspended, shadow, status):
    df = spark.createDataFrame([(deleted, suspended, shadow)], "d string, s string, b string")
    assert value(df, sc.account_status("d", "s", "b")) == status
