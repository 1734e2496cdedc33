"""Column expressions: record normalisation, ages, intervals and similarity formulas.

Everything here is a built-in expression, so it stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_CHAR_REPLACEMENT = " <NULL_CHARACTER_REPLACEMENT> "
Z_95 = 1.959963984540054
MENTION_PATTERN = r"/r/([\w\-]+)"

SECONDS_PER_DAY = 86400.0


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def scrub(text: Column | str) -> Column:
    """Replace the zero character, which most stores refuse inside text."""
    return F.replace(as_column(text), F.lit("\u0000"), F.lit(NULL_CHAR_REPLACEMENT))


def epoch_utc(seconds: Column | str) -> Column:
    """Epoch seconds to a zone-less UTC timestamp, whatever the session zone is."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), as_column(seconds).cast("decimal(18,6)"))


def epoch_pair(seconds: Column | str, zone: str, name: str = "created") -> list[Column]:
    """Local timestamp ``name`` and its ``name_utc`` twin."""
    utc = epoch_utc(seconds)
    return [F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).alias(name), utc.alias(f"{name}_utc")]


def edited(seconds: Column | str) -> Column:
    """A missing, zero or false edit mark is NULL, otherwise the edit time."""
    value = as_column(seconds)
    return F.when(value > 0, epoch_utc(value))


def bare_id(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), r"^t[0-9]_", "")


def prefixed_id(value: Column | str, kind: int) -> Column:
    return F.concat(F.lit(f"t{kind}_"), bare_id(value))


def is_parent(parent: Column | str, node_id: Column | str) -> Column:
    """Parent test that accepts bare and prefixed ids on either side."""
    return bare_id(parent) == bare_id(node_id)


def flag(value: Column | str) -> Column:
    return as_column(value).isNotNull()


def map_get(mapping: Column | str, key: str, default: int = 0) -> Column:
    return F.coalesce(F.try_element_at(as_column(mapping), F.lit(key)), F.lit(default))


def rules_json(value: Column | str) -> Column:
    return F.to_json(as_column(value))


def account_status(deleted: str, suspended: str, shadowbanned: str) -> Column:
    return (
        F.when(F.col(deleted).isNotNull(), "deleted")
        .when(F.col(suspended).isNotNull(), "suspended")
        .when(F.col(shadowbanned).isNotNull(), "shadowbanned")
        .otherwise("active")
    )


def domain(url: Column | str) -> Column:
    """Host of a URL; NULL for a malformed one."""
    return F.try_parse_url(as_column(url), F.lit("HOST"))


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed time in fractional days."""
    span = as_column(later) - as_column(earlier)
    part = lambda unit: F.extract(F.lit(unit), span).cast("double")
    return part("DAY") + (part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")) / SECONDS_PER_DAY


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole elapsed days; a half day does not count (63, not 64)."""
    return F.extract(F.lit("DAY"), as_column(later) - as_column(earlier)).cast("bigint")


def ratio(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def clamp(value: Column | str, low: float) -> Column:
    """Raise values below ``low``; NULL stays NULL."""
    value = as_column(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def wilson_bounds(count: Column | str, share: Column | str, z: float = Z_95) -> tuple[Column, Column, Column]:
    """(n, lower, upper) of the Wilson score interval, n = round-half-even(count / share)."""
    p = as_column(share).cast("double")
    n = F.bround(F.try_divide(as_column(count).cast("double"), p), 0)
    z2 = z * z
    scale = F.try_divide(n, n + z2)
    centre = p + F.try_divide(F.lit(z2), 2 * n)
    spread = z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z2), 4 * n * n))
    return n, scale * (centre - spread), scale * (centre + spread)


def pairs_of(n: Column | str) -> Column:
    """Number of 2-subsets as a double; 0 below two elements."""
    n = as_column(n).cast("double")
    return F.when(n < 2, F.lit(0.0)).otherwise(n * (n - 1) / 2)


def jaccard_value(common: Column, n_a: Column, n_b: Column) -> Column:
    return F.try_divide(common.cast("double"), (n_a + n_b - common).cast("double"))


def rand_value(common: Column, n_a: Column, n_b: Column, universe: Column) -> Column:
    together = pairs_of(common)
    apart = pairs_of(universe - (n_a + n_b - common))
    return F.try_divide(together + apart, pairs_of(universe))


def adjusted_rand_value(common: Column, n_a: Column, n_b: Column, universe: Column) -> Column:
    a, b = pairs_of(n_a), pairs_of(n_b)
    expected = F.try_divide(a * b, pairs_of(universe))
    return F.try_divide(pairs_of(common) - expected, (a + b) / 2 - expected)
