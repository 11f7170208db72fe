"""Writers for alignments, interval lists and size-bounded pieces."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from locusflow.functions.locus import bed_region
from locusflow.operators.filters import filter_mapped
from locusflow.operators.pairs import PIECE_BYTES, assign_chunks
from locusflow.session import materialize
from locusflow.sources.fastq import fastq_text

#: Bytes of text that a task sorts and writes, at about; with fewer tasks than shuffle partitions, it is less.
TASK_BYTES = 32 << 20


def write_alignments(
    alignments: DataFrame, path: str, paired: bool = True, keep_cross_contig: bool = True, partition: str = "contig_idx"
) -> None:
    """Mapped reads as Parquet by contig: the result when nothing is called.

    Ranges of ``(contig, start)`` split a contig over many files and keep each file sorted.
    """
    kept = filter_mapped(alignments, paired, keep_cross_contig)
    ranged = kept.repartitionByRange(partition, "start").sortWithinPartitions(partition, "start")
    ranged.write.partitionBy(partition).parquet(path)


def write_bed(intervals: DataFrame, path: str) -> None:
    """Intervals with a ``contig`` name as BED text in coordinate order."""
    intervals.orderBy("contig", "start", "end_pos").select(bed_region().alias("value")).write.text(path)


def write_chunks(
    reads: DataFrame, path: str, target_bytes: int = PIECE_BYTES, compression: str = "gzip", order: str = "ordinal"
) -> DataFrame:
    """FASTQ pieces of bounded uncompressed size, in folders ``sample=…/chunk_id=…``.

    ``reads`` has ``sample, mate, name, seq, qual`` and the integer ``order``; mates
    stay next to each other in one piece.  Returns ``(sample, chunk_id, reads,
    bytes)``.  A piece is ``target_bytes`` at most plus one record and lies in one task; the number of tasks follows the
    bytes, so that a task holds about ``TASK_BYTES`` or one piece.  The records are written once before (eager).
    """
    # A template has one record or two, so the group stays small.
    mates = F.array_sort(F.collect_list(F.struct("mate", fastq_text().alias("text"))))
    pairs = (
        reads.groupBy("sample", F.col(order).alias("__order"))
        .agg(mates.alias("__mates"))
        .select("sample", "__order", F.array_join("__mates.text", "\n").alias("value"), F.size("__mates").alias("__n"))
    )
    size = F.octet_length("value") + 1
    chunked = materialize(assign_chunks(pairs, size, ["sample"], "__order", target_bytes))
    # Repetitive text is small in a shuffle and large in a sort, so partitions are not left to be joined by shuffled size.
    total = chunked.agg(F.sum(size)).first()[0] or 0
    tasks = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    ranged = chunked.repartition(tasks, "sample", "chunk_id").sortWithinPartitions("sample", "chunk_id", "__order")
    ranged.select("sample", "chunk_id", "value").write.partitionBy("sample", "chunk_id").option(
        "compression", compression
    ).text(path)
    return chunked.groupBy("sample", "chunk_id").agg(F.sum("__n").alias("reads"), F.sum(size).alias("bytes"))
