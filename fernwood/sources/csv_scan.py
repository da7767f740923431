"""Headerless CSV scans with positional names and an explicit schema (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fernwood.schema import COLUMN_NAMES, connection_schema


def scan_headerless_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                        encoding: str = "ISO-8859-1", mode: str = "FAILFAST",
                        timestamp_format: str | None = None) -> DataFrame:
    """Read headerless CSV files; names come from ``schema`` by position.

    A missing path raises ``AnalysisException`` naming the path (PATH_NOT_FOUND).
    ``FAILFAST`` turns a malformed row into an error instead of a silent null.
    Many files or one large file are split across tasks by Spark.
    """
    schema = schema or connection_schema()
    reader = spark.read.schema(schema).option("header", "false") \
        .option("encoding", encoding).option("mode", mode)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format) \
            .option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """A2/A3: one official split, tagged with a ``split`` column (never reshuffled)."""
    from pyspark.sql import functions as F
    return scan_headerless_csv(spark, path).withColumn("split", F.lit(split))


def check_columns(df: DataFrame, expected: list[str] = COLUMN_NAMES) -> None:
    """A5: the column contract (41 features, then ``label``, ``difficulty``)."""
    got = [c for c in df.columns if c != "split"]
    if got != expected:
        raise ValueError(f"column contract broken: expected {len(expected)} columns "
                         f"ending in {expected[-2:]}, got {got}")
