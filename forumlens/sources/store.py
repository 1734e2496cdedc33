"""A Parquet table whose batches rewrite only the files that can hold their keys, published by numbered manifests.

Layout under ``path``:

* ``data/<lot>/``: Parquet files, never changed once written; a lot is what one commit wrote.
* ``index/<lot>/``: a table with one row per file of the lot: the filter words of its keys (Bloom filter).
* ``manifests/v-<number>/``: a small table with one row per live file (lot, rows, least and greatest key, whether a NULL key is in it)
  and one row per writer with the last batch it committed.  A version is written aside and renamed to its place last.

Readers resolve the newest manifest and read exactly its files, so they see a batch as a whole or not at all, and a job that is
lost at any point leaves the table as it was.  A commit names its writer and batch; a batch that is committed already is skipped.
Two writers that race for a number: the rename of one fails and it starts again from the newer version.
The rename has to be atomic for folders (HDFS, local and network file systems).

Files of a lot are dealt by ranges of the first key column, integers in their order and others as text, so batches of neighbouring
keys touch few files.  Of these only files that hold the key of a row the policy admits are written anew.  Keys are compared as ``merge`` does: NULL is a key like others, and upper and lower case are one with ``fold_case``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.operators.merge import Policy, admitted, applied, first_of, missing_rows
from forumlens.operators.ranking import columns, match_keys
from forumlens.session import freeze

MANIFEST = "kind string, file string, lot string, rows long, least string, most string, nulls boolean, writer string, batch long"
INDEX = "file string, words array<long>"
ROWS_PER_FILE = 1_000_000
# Filter: bits per key, and probes of a key, all in one word.
KEY_BITS = 10
PROBES = 4
# A batch's keys are probed in ranges of about equal size, at most so many and of at least so many rows, so a file meets only
# the ranges it overlaps.
RANGES = 256
RANGE_ROWS = 16384
# Hashes of one range that are probed as one row.
PACK = 4096


class Conflict(RuntimeError):
    """Another writer published the version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key, fold_case: bool = False,
                 rows_per_file: int = ROWS_PER_FILE):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = columns(key)
        self.fold_case = fold_case
        self.rows_per_file = rows_per_file

    # Versions

    def _fs(self, path: str):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        fs, place = self._fs(f"{self.path}/manifests")
        if not fs.exists(place):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n[2:]) for n in names if n.startswith("v-"))

    def _manifest(self, version: int | None) -> DataFrame:
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/v-{version:09d}")

    def files(self, version: int | None = None) -> DataFrame:
        """Live files with their rows and key range."""
        return self._manifest(version).filter("kind = 'file'").drop("kind", "writer", "batch")

    def committed(self, writer: str, version: int | None = None) -> int | None:
        """Last batch of ``writer``."""
        row = self._manifest(version).filter((F.col("kind") == "batch") & (F.col("writer") == writer)).first()
        return row and row["batch"]

    def _publish(self, base: int, manifest: DataFrame) -> int:
        aside = f"{self.path}/manifests/aside-{uuid.uuid4().hex}"
        manifest.write.parquet(aside)
        fs, place = self._fs(aside)
        _, final = self._fs(f"{self.path}/manifests/v-{base + 1:09d}")
        # A rename into an existing folder would move below it.
        if fs.exists(final) or not fs.rename(place, final):
            raise Conflict(f"version {base + 1} exists")
        return base + 1

    # Reading

    def _read_files(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/{f}" for f in files))

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version, the newest by default."""
        return self._read_files([r["file"] for r in self.files(version).select("file").collect()])

    def _spread(self, batch: DataFrame) -> DataFrame:
        """A batch of few partitions, as a large file is, over all cores."""
        cores = self.spark.sparkContext.defaultParallelism
        return batch.repartition(cores) if batch.rdd.getNumPartitions() < cores else batch

    # Keys

    def _key(self) -> list[Column]:
        return [F.lower(k) if self.fold_case else F.col(k) for k in self.key]

    def _first(self) -> Column:
        """First key column, as text unless it is an integer: a least and greatest integer need no sort."""
        return self._key()[0] if isinstance(self.schema[self.key[0]].dataType, T.IntegralType) else self._key()[0].cast("string")

    def _text(self, first: Column) -> Column:
        """Text in the order of ``_first``: an integer's bits with the sign turned, as 16 hex digits."""
        if not isinstance(self.schema[self.key[0]].dataType, T.IntegralType):
            return first
        return F.lpad(F.hex(first.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")

    def _lead(self) -> Column:
        return self._text(self._first())

    def _hash(self) -> Column:
        return F.xxhash64(*(c.cast("string") for c in self._key()))

    @staticmethod
    def _bits(h: Column) -> Column:
        """The bits that a key sets in its word."""
        second = F.xxhash64(h, F.lit(1))
        ones = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * p).bitwiseAND(63).cast("int"))
                for p in range(PROBES)]
        return reduce(lambda a, b: a.bitwiseOR(b), ones)

    def _file(self) -> Column:
        """``<lot>/<name>`` of the file that a row stands in."""
        return F.substring_index("_metadata.file_path", "/", -2)

    # Writing

    def _write(self, rows: DataFrame) -> DataFrame:
        """Writes rows as a lot, indexes it, and returns its manifest rows."""
        lot = uuid.uuid4().hex
        rows = freeze(rows.select([F.col(f.name).cast(f.dataType) for f in self.schema.fields]), "rows")
        parts = -(-rows.count() // self.rows_per_file)
        if not parts:
            return self.spark.createDataFrame([], MANIFEST)
        plain = [f.name for f in self.schema.fields if "map<" not in f.dataType.simpleString()]
        # The hashes split what has one lead, or one key.
        dealt = rows.repartitionByRange(parts, self._lead(), self._hash(), F.xxhash64(*plain)) if parts > 1 else rows.coalesce(1)
        dealt.write.parquet(f"{self.path}/data/{lot}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{lot}")
        written = written.select(self._file().alias("file"), self._first().alias("first"), self._hash().alias("h"))
        listed = written.groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.min("first").alias("_least"), F.max("first").alias("_most"),
            F.bool_or(F.col("first").isNull()).alias("nulls"))
        listed = freeze(listed.select("file", "rows", self._text(F.col("_least")).alias("least"),
                                      self._text(F.col("_most")).alias("most"), "nulls"), "files")
        sized = listed.select(F.col("file").alias("_file"), F.ceil(F.col("rows") * KEY_BITS / 64).cast("long").alias("n_words"))
        ones = (
            written.join(sized, F.col("file") == F.col("_file"))
            .select("file", F.pmod("h", "n_words").alias("word"), self._bits(F.col("h")).alias("bits")))
        zeros = sized.select(F.col("_file").alias("file"), F.explode(F.sequence(F.lit(0), F.col("n_words") - 1)).alias("word"),
                             F.lit(0).cast("long").alias("bits"))
        filled = ones.unionAll(zeros).groupBy("file", "word").agg(F.bit_or("bits").alias("bits"))
        words = filled.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
        words.select("file", F.col("words.bits").alias("words")).write.parquet(f"{self.path}/index/{lot}")
        return listed.select(F.lit("file").alias("kind"), "file", F.lit(lot).alias("lot"), "rows", "least", "most", "nulls",
                             F.lit(None).cast("string").alias("writer"), F.lit(None).cast("long").alias("batch"))

    def touched(self, batch: DataFrame, version: int | None = None) -> DataFrame:
        """Names of the files that can hold a key of ``batch``: by key range, then by filter."""
        files = self.files(version)
        live = files.select("file", "lot", "nulls").collect()
        if not live:
            return files.select("file")
        keys = batch.select(self._lead().alias("lead"), self._hash().alias("h"))
        n_ranges = min(RANGES, -(-batch.count() // RANGE_ROWS) or 1)
        keys = freeze(keys.distinct().repartitionByRange(n_ranges, "lead", "h").withColumn("range", F.spark_partition_id()), "keys")
        named = keys.filter(F.col("lead").isNotNull())
        ranges = keys.groupBy("range").agg(F.min("lead").alias("first"), F.count("lead").alias("n"), F.count(F.lit(1)).alias("all"))
        ranges = ranges.orderBy("range").collect()
        nulls = files.filter("nulls").select("file") if any(r["all"] > r["n"] for r in ranges) else files.limit(0).select("file")
        ranges = [r for r in ranges if r["n"]]
        lots = sorted({r["lot"] for r in live})
        if not ranges:
            return nulls
        # At most RANGES ranges: number, first key, and lots of hashes that each is dealt in.
        number = {r["range"]: k for k, r in enumerate(ranges)}
        numbers = F.lit([number.get(k, -1) for k in range(max(number) + 1)])
        packs = F.lit([-(-r["n"] // PACK) for r in ranges])
        firsts = F.lit([r["first"] for r in ranges])
        at = lambda c: F.size(F.filter(firsts, lambda f: f <= c)) - 1
        numbered = named.withColumn("range", F.get(numbers, F.col("range")))
        packed = (
            numbered.groupBy("range", F.pmod("h", F.get(packs, F.col("range"))).alias("pack"))
            .agg(F.min("lead").alias("first"), F.max("lead").alias("last"), F.collect_list(F.struct("lead", "h")).alias("keys")))
        # Ranges that begin with one lead overlap: the file's least key may stand in an earlier one.
        below = lambda c: F.size(F.filter(firsts, lambda f: f < c)) - 1
        spans = files.filter(F.col("least").isNotNull() & (at(F.col("most")) >= 0)).select(
            "file", "least", "most", F.explode(F.sequence(F.greatest(below(F.col("least")), F.lit(0)), at(F.col("most")))).alias("range"))
        index = self.spark.read.schema(INDEX).parquet(*(f"{self.path}/index/{lot}" for lot in lots))
        near = spans.join(packed, "range").filter((F.col("first") <= F.col("most")) & (F.col("last") >= F.col("least")))
        near = near.select("file", "least", "most", "keys").join(index, "file")
        n_words = F.size("words").cast("long")

        def held(k: Column) -> Column:
            bits = self._bits(k["h"])
            word = F.get(F.col("words"), F.pmod(k["h"], n_words).cast("int"))
            return (k["lead"] >= F.col("least")) & (k["lead"] <= F.col("most")) & (word.bitwiseAND(bits) == bits)

        return near.filter(F.exists("keys", held)).select("file").unionAll(nulls).distinct()

    def merge(self, batch: DataFrame, policy: Policy, ts: str | None = "timestamp", ties: tuple[str, ...] = (),
              history: bool = False, update_cols: list[str] | None = None, writer: str | None = None,
              batch_id: int | None = None) -> int:
        """Merges a batch as ``operators.merge.merge`` does and returns the version that holds it.

        Only files that can hold a key of the batch are read, and only those that hold a key of an admitted row are written
        anew; a history is appended to.
        """
        rows = freeze(self._spread(batch), "batch")

        def change(base: int) -> tuple[DataFrame, DataFrame]:
            near = [r["file"] for r in self.touched(rows, base).collect()]
            passed = freeze(admitted(self._read_files(near), rows, self.key, policy, ts, history, self.fold_case), "admitted")
            if history:
                return self._manifest(base), self._read_files([]).unionByName(passed, allowMissingColumns=True)
            held = self._holding(near, passed)
            new = applied(self._read_files(held), passed, self.key, ts, ties, update_cols, self.fold_case)
            gone = self.spark.createDataFrame([(f,) for f in held], "_gone string")
            return self._manifest(base).join(gone, F.col("file") == F.col("_gone"), "left_anti"), new

        return self._committing(change, writer, batch_id)

    def _holding(self, files: list[str], rows: DataFrame) -> list[str]:
        """The files that hold a key of ``rows``."""
        if not files:
            return []
        names = [f"_key_{k}" for k in self.key]
        stored = self._read_files(files).select(self._file().alias("file"), *(c.alias(n) for c, n in zip(self._key(), names)))
        keys = rows.select(*(c.alias(f"_of_{n}") for c, n in zip(self._key(), names)))
        return [r["file"] for r in stored.join(keys, match_keys(names, "_of_"), "left_semi").select("file").distinct().collect()]

    def insert_missing(self, batch: DataFrame, order: list[Column] | None = None, writer: str | None = None,
                       batch_id: int | None = None) -> int:
        """Adds the rows whose key is not stored, one for each key (the first in ``order``); no file is written anew."""
        rows = freeze(first_of(self._spread(batch), self.key, order), "batch")

        def change(base: int) -> tuple[DataFrame, DataFrame]:
            stored = self._read_files([r["file"] for r in self.touched(rows, base).collect()])
            return self._manifest(base), stored.limit(0).unionByName(missing_rows(stored, rows, self.key), allowMissingColumns=True)

        return self._committing(change, writer, batch_id)

    def append(self, rows: DataFrame, writer: str | None = None, batch_id: int | None = None) -> int:
        """Adds rows without looking at their keys."""
        return self._committing(lambda base: (self._manifest(base), rows), writer, batch_id)

    def _committing(self, change: Callable[[int], tuple[DataFrame, DataFrame]], writer: str | None, batch_id: int | None) -> int:
        """Publishes what ``change`` makes of the newest version: the manifest rows that stay, and new rows."""
        while True:
            base = max(self.versions(), default=0)
            if writer is not None and (last := self.committed(writer, base)) is not None and last >= batch_id:
                return base
            live, rows = change(base)
            try:
                return self._commit(base, live, self._write(rows), writer, batch_id)
            except Conflict:
                continue

    def _commit(self, base: int, live: DataFrame, new: DataFrame, writer: str | None, batch_id: int | None) -> int:
        if writer is not None:
            live = live.filter(~((F.col("kind") == "batch") & (F.col("writer") == writer)))
            new = new.unionByName(self.spark.createDataFrame([("batch", writer, batch_id)], "kind string, writer string, batch long"),
                                  allowMissingColumns=True)
        return self._publish(base, live.unionByName(new))

    def expire(self, keep: int = 10) -> int:
        """Drops all but the newest versions, and the files that only those dropped had; returns how many files went."""
        dropped = self.versions()[:-keep]
        if not dropped:
            return 0
        kept = self.spark.read.schema(MANIFEST).parquet(*(f"{self.path}/manifests/v-{v:09d}" for v in self.versions()[-keep:]))
        old = self.spark.read.schema(MANIFEST).parquet(*(f"{self.path}/manifests/v-{v:09d}" for v in dropped))
        gone = old.filter("kind = 'file'").select("file").distinct().join(kept.select("file").distinct(), "file", "left_anti").collect()
        for path in [*(f"data/{r['file']}" for r in gone), *(f"manifests/v-{v:09d}" for v in dropped)]:
            fs, place = self._fs(f"{self.path}/{path}")
            fs.delete(place, True)
        return len(gone)
