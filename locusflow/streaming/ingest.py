"""Aligned reads that keep arriving as SAM text files in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from locusflow.operators.filters import filter_mapped, stage_counters
from locusflow.sources.sam import parse_sam_lines, to_alignments


def stream_alignments(spark: SparkSession, path: str, contigs: DataFrame, files_per_batch: int = 100) -> DataFrame:
    """Streaming DataFrame of alignments from the SAM files that appear in ``path``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return to_alignments(parse_sam_lines(lines), contigs)


def stream_stage_metrics(alignments: DataFrame, paired: bool = True, keep_cross_contig: bool = True) -> DataFrame:
    """Running filter counters per contig; state is one row per contig."""
    return alignments.groupBy("contig_idx").agg(*stage_counters(paired, keep_cross_contig))


def stream_to_parquet(alignments: DataFrame, path: str, checkpoint: str, **filter_options) -> StreamingQuery:
    """Append mapped reads to Parquet, exactly once, until the folder is worked off."""
    return (
        filter_mapped(alignments, **filter_options)
        .withColumn("contig", F.col("contig_idx"))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("contig")
        .trigger(availableNow=True)
        .start(path)
    )
