"""Pairing the two files of a sample and cutting reads into bounded pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from locusflow.operators.scans import running_sum_before

#: Default size of an output piece.
PIECE_BYTES = 60_000_000


def _bare_name(name: str) -> Column:
    """Read name without the mate suffix and comment."""
    return F.regexp_replace(F.col(name), "(/[12])?(\\s.*)?$", "")


def pair_mates(r1: DataFrame, r2: DataFrame, check_names: bool = False) -> DataFrame:
    """First and second reads matched by ``(sample, ordinal)``; the longer file is cut to the shorter.

    One row per pair with ``name, seq1, qual1, seq2, qual2``.  ``check_names`` fails on
    a pair whose names differ.
    """
    left = r1.select("sample", "ordinal", "name", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    right = r2.select(
        "sample", "ordinal", F.col("name").alias("__name2"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2")
    )
    paired = left.join(right, ["sample", "ordinal"])
    if check_names:
        message = F.concat(F.lit("mates differ in name: "), F.col("name"), F.lit(" / "), F.col("__name2"))
        differs = _bare_name("name") != _bare_name("__name2")
        paired = paired.withColumn("name", F.when(differs, F.raise_error(message)).otherwise(F.col("name")))
    return paired.drop("__name2")


def interleave(pairs: DataFrame) -> DataFrame:
    """One row per mate: first reads ``mate = 1``, second reads ``mate = 2``."""
    mates = F.array(
        F.struct(F.lit(1).alias("mate"), F.col("seq1").alias("seq"), F.col("qual1").alias("qual")),
        F.struct(F.lit(2).alias("mate"), F.col("seq2").alias("seq"), F.col("qual2").alias("qual")),
    )
    return pairs.select("sample", "ordinal", "name", F.explode(mates).alias("__m")).select(
        "sample", "ordinal", "name", "__m.*"
    )


def assign_chunks(
    df: DataFrame,
    size: Column,
    group: list[str],
    order: str,
    target_bytes: int = PIECE_BYTES,
    scan_rows: int = 100_000,
) -> DataFrame:
    """Add ``chunk_id``: bytes before the row in its group divided by ``target_bytes``.

    ``order`` is a non-negative integer that is unique in the group, such as the
    ordinal of a read.  A piece closes once it is full, so it exceeds the target by
    one record at most.  Sums run inside stretches of ``scan_rows`` ordinals and are
    carried across them.
    """
    sized = df.withColumns({"__size": size.cast("long"), "__cell": F.expr(f"bigint({order}) div {scan_rows}")})
    summed = running_sum_before(sized, group, "__cell", [order], "__size", "__before")
    return summed.withColumn("chunk_id", F.expr(f"__before div {target_bytes}")).drop("__size", "__cell", "__before")
