"""Token totals kept up by signed changes, in idempotent batches.

``facts`` turns documents into counts under a tokenizer version.  A batch of changes is a table of
(sign, source, lang, version, n_docs, n_tokens, n_chars): an insert is +1, a delete -1 of what was
inserted, a revised count the delete of the old and the insert of the new.  A batch is summed per key
before it is written, so a hot source costs one row a task in the shuffle.

A store is a folder: ``deltas/<batch>`` holds the sums of a batch, ``commits/<batch>`` one row with the
batch's digest, written last.  Totals add the deltas of committed batches only.  Committing a batch id again
changes nothing if its sums are the same, replaces what an interrupted attempt left, and is an
error if a committed batch comes back with other sums.  Keys whose documents are all gone have no row.

Defined results: null text counts no tokens and no characters; null source or lang are keys of their own;
repeated rows count each; an empty batch commits and adds nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.text import words

KEYS = ["source", "lang", "version"]
SUMS = ["n_docs", "n_tokens", "n_chars"]
_DELTA = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long"
_COMMIT = "batch string, digest long"


def word_tokens(text: Column) -> Column:
    return F.size(words(text))


def blank_tokens(text: Column) -> Column:
    """Stretches without blanks, tabs or line ends."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\r]+"), ""))


def ranked_tokens(path: str, pattern: str) -> "callable":
    """Counter for a file of byte-pair ranks (one base64 piece and rank a line), as a Spark function."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("int")
    def count(texts: "pandas.Series") -> "pandas.Series":
        import base64

        import pandas as pd
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int32")

    return count


def facts(docs: DataFrame, version: str, tokens) -> DataFrame:
    """doc_id, source, lang, version, n_tokens, n_chars."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.lit(version).alias("version"),
        tokens(F.col("text")).cast("long").alias("n_tokens"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))


def changes(counted: DataFrame, sign: int) -> DataFrame:
    """Signed rows of ``facts``: 1 inserts, -1 deletes."""
    return counted.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens"), (F.col("n_chars") * sign).alias("n_chars"))


def revision(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts leave, the new ones come."""
    return changes(old, -1).unionByName(changes(new, 1))


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, kind: str, schema: str) -> DataFrame:
        files = self.spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        try:
            return files.parquet(f"{self.path}/{kind}")
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return self.spark.createDataFrame([], schema)

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows once; False if it was committed before."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"batch id {batch!r}")
        sums = signed.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        known = self._read("commits", _COMMIT).filter(F.col("batch") == batch).select("digest").collect()
        attempt = f"{self.path}/{'replays' if known else 'deltas'}/{batch}"
        sums.write.mode("overwrite").parquet(attempt)
        written = self.spark.read.schema(_DELTA).parquet(attempt)
        digest = written.agg(F.coalesce(F.sum(F.xxhash64(*KEYS, *SUMS).cast("decimal(38,0)")), F.lit(0)) % F.lit(2**61 - 1)).first()[0]
        if known:
            if int(known[0][0]) != int(digest):
                raise ValueError(f"batch {batch} was committed with other sums")
            return False
        done = self.spark.createDataFrame([(batch, int(digest))], _COMMIT)
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Sums per source, language and version over the committed batches."""
        batches = [r[0] for r in self._read("commits", _COMMIT).select("batch").distinct().collect()]
        if not batches:
            return self.spark.createDataFrame([], _DELTA)
        deltas = self.spark.read.schema(_DELTA).parquet(*[f"{self.path}/deltas/{b}" for b in sorted(batches)])
        return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).filter(F.col("n_docs") != 0)
