"""Words, folding and table access shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A-Z fold to a-z; digits, a-z and everything beyond ASCII make words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _word_byte(b: int) -> int:
    if 65 <= b <= 90:
        return b + 32
    return b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32


WORD_BYTES = bytes(_word_byte(b) for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes, A-Z folded."""
    return (text or "").encode().translate(WORD_BYTES).split()


def folded(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does that alone where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words of a text column as an array (null text: none)."""
    return F.array_remove(F.split(folded(F.coalesce(text, F.lit(""))), WORD_GAP), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns; still an equi-join."""
    out = F.col(left[0]).eqNullSafe(F.col(right[0]))
    for a, b in zip(left[1:], right[1:]):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out
