"""Numbering the lines of text files that Spark reads in independent blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.operators.joins import spread_join
from locusflow.operators.scans import before


def split_fields(lines: DataFrame, column: str = "value", name: str = "__f", sep: str = "\t") -> DataFrame:
    """Replace a text column by the array of its fields.

    The one-element ``explode`` keeps the optimizer from copying the split, and the
    expression that built the line, into every later use of a field.
    """
    others = [c for c in lines.columns if c != column]
    return lines.select(*others, F.explode(F.array(F.split(F.col(column), sep))).alias(name))


def plain_path(path: str | Column) -> Column:
    """File URI with one slash after the scheme, so that the spellings of a local path agree."""
    col = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(col, "^file:/+", "file:/")


def qualified(spark: SparkSession, path: str) -> str:
    """Path as Spark reports it for rows of the file, in the spelling of ``plain_path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop_path).toString()


def raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines as ``(value, path, block, __id)``.  A split file is read in blocks, and ids rise within a block."""
    return spark.read.text(paths).select(
        "value",
        plain_path("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("__id", F.monotonically_increasing_id())


def first_lines(raw: DataFrame) -> DataFrame:
    """``path, block, first, __shift``: for each block the number of its first line in the file, and what to add to an id."""
    blocks = raw.groupBy("path", "block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(before(["path"], ["block"])), F.lit(0))
    return blocks.select("path", "block", earlier.alias("first"), (earlier - F.col("__first")).alias("__shift"))


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines as ``(path, line_no, value)`` with 0-based numbers within each file.

    The number of a line is its place in its block plus the lines of all earlier blocks; the table of
    blocks (one row each) is aggregated from the same scan and joined back.
    """
    raw = raw_lines(spark, paths)
    shifts = first_lines(raw).drop("first")
    numbered = spread_join(raw, shifts, ["path", "block"], "inner", salt_on=["__id"])
    return numbered.select("path", (F.col("__id") + F.col("__shift")).alias("line_no"), "value")
