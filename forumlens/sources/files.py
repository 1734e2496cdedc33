"""Reading and writing entity tables, name lists and CSV hand-overs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.operators.merge import first_of, missing_rows
from forumlens.sources.schemas import SCHEMAS


# Stands for NULL in CSV files, which keeps it apart from the empty string.
CSV_NULL = "\\N"


def load(spark: SparkSession, path: str, entity: str | T.StructType) -> DataFrame:
    """Entity table with its declared schema, so nothing is inferred and old files still fit."""
    schema = SCHEMAS[entity] if isinstance(entity, str) else entity
    return spark.read.schema(schema).parquet(path)


def read_list(spark: SparkSession, path: str, limit: int | None = None, name: str = "name") -> DataFrame:
    """Names from a text file, one per line, without blank lines; with ``limit`` also without longer ones.

    A line's length includes its line end, as the limit was defined on raw lines.
    """
    lines = spark.read.text(path)
    return clean_list(lines, "value", limit, name)


def clean_list(lines: DataFrame, col: str, limit: int | None = None, name: str = "name") -> DataFrame:
    raw = F.length(col) + 1
    stripped = F.trim(F.regexp_replace(col, r"^\s+|\s+$", ""))
    kept = lines if limit is None else lines.filter(raw <= limit)
    return kept.select(stripped.alias(name)).filter(F.col(name) != "")


def load_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Reads what ``export_csv`` writes: line breaks, outer blanks and empty strings come back as they were."""
    return spark.read.csv(
        path, header=True, schema=schema, mode="FAILFAST", quote='"', escape='"', multiLine=True, nullValue=CSV_NULL, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', nullValue=CSV_NULL, emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def materialize(df: DataFrame, name: str, if_exists: str = "ignore", path: str | None = None,
                partition_by: tuple[str, ...] = (), buckets: tuple[int, str] | None = None) -> DataFrame:
    """Create a table from a query; ``if_exists``: ignore, overwrite (drop first) or error.

    ``path`` stores it as plain Parquet there instead of in the catalog.  ``buckets``
    lays the table out by a key so that later joins on that key need no shuffle.
    """
    writer = df.write.mode({"ignore": "ignore", "overwrite": "overwrite", "error": "errorifexists"}[if_exists])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer.parquet(f"{path.rstrip('/')}/{name}")
        return df.sparkSession.read.parquet(f"{path.rstrip('/')}/{name}")
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    writer.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def insert_new(target_path: str, new: DataFrame, key, order: list[Column] | None = None) -> None:
    """Append to a Parquet table the rows whose key it does not hold yet, the first of each key in ``order``."""
    target = new.sparkSession.read.parquet(target_path)
    first_of(missing_rows(target, new, key), key, order).write.mode("append").parquet(target_path)


def align_union(old: DataFrame, new: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Union of an older and a newer snapshot; columns the older one lacks become NULL.

    ``defaults`` fills columns that the newer schema declares with a default value.
    """
    out = old.unionByName(new, allowMissingColumns=True)
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in (defaults or {}).items()})
