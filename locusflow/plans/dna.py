"""Reads to variants, for DNA and for RNA."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from locusflow.functions.cigar import split_n_reads
from locusflow.functions.quality import normalize_quality
from locusflow.operators.duplicates import mark_duplicates
from locusflow.operators.features import count_features
from locusflow.operators.filters import ReadGroup, clean_alignments, filter_mapped_observed, primary_reads, set_read_group
from locusflow.operators.intervals import filter_intervals, interval_semi_join, merge_intervals
from locusflow.operators.piece_sums import merge_pieces
from locusflow.operators.pileup import call_snps_of_pieces, mark_touching
from locusflow.operators.recalibrate import recalibrate_reads, recalibration_table_of_pieces
from locusflow.operators.sequence import read_pieces
from locusflow.operators.targets import realign_targets
from locusflow.operators.variants import DNA_CONFIDENCE, RNA_CONFIDENCE, annotate_variants, filter_variants
from locusflow.session import materialize


@dataclass(frozen=True)
class Calls:
    """Results of a chain; every member is lazy except where noted by the chain.

    ``counts`` are fragments per exon where exons were given.  ``counters`` are observations of the chain's nodes: those
    of the preparation are there at once, those of ``variants`` once it has been consumed.
    """

    variants: DataFrame
    reads: DataFrame
    islands: DataFrame
    targets: DataFrame
    counts: DataFrame | None = None
    counters: dict[str, Observation] = field(default_factory=dict)


@dataclass(frozen=True)
class Preparation:
    """What happens to reads before they are used.

    ``read_group`` is stamped where a read has none; ``fix_encoding`` converts old base qualities, judged by library;
    ``contigs`` clips reads that hang over a contig's end; duplicates stay marked, or go with ``remove_duplicates``.
    """

    paired: bool = True
    keep_cross_contig: bool = True
    read_group: ReadGroup | None = None
    fix_encoding: bool = False
    contigs: DataFrame | None = None
    remove_duplicates: bool = False

    def run(self, reads: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
        """Prepared reads with duplicates decided, a written table, and the observations of the two nodes."""
        if self.read_group is not None:
            reads = set_read_group(reads, self.read_group, overwrite=False)
        if self.fix_encoding:
            reads = normalize_quality(reads, by="library")
        if self.contigs is not None:
            reads = clean_alignments(reads, self.contigs)
        mapped, filtered = filter_mapped_observed(reads, self.paired, self.keep_cross_contig)
        decided = Observation("duplicates")
        marked = mark_duplicates(primary_reads(mapped)).observe(
            decided, F.count(F.lit(1)).alias("reads"), F.count_if(F.col("is_duplicate") == 1).alias("duplicates")
        )
        rows = materialize(marked.filter("is_duplicate = 0") if self.remove_duplicates else marked)
        return rows, {"filter_mapped": filtered, "duplicates": decided}


def _evidence(
    reads: DataFrame, reference: DataFrame, known_sites: DataFrame | None, targets: DataFrame | None, merge_mates: bool
) -> DataFrame:
    """Pieces of ``reads`` as evidence; with known sites their qualities are recalibrated, and with ``merge_mates`` bases
    that do not count are marked in ``sites``.

    The reads are cut and meet the reference once: the pieces are written, counted for the table, and read again with
    their qualities rewritten.  Pieces outside the targets are counted but give no evidence.
    """
    keep = ("read_id", "library", "contig_idx", "is_reverse", "mapq")
    if merge_mates:
        reads, keep = mark_touching(reads), (*keep, "template_id", "touching")
    pieces = read_pieces(reads, reference, exclude=known_sites, keep=keep)
    if known_sites is not None:
        pieces = materialize(pieces)
        pieces = recalibrate_reads(pieces, recalibration_table_of_pieces(pieces))
    if targets is not None:
        within = interval_semi_join(pieces.withColumns({"start": F.col("lo"), "end_pos": F.col("hi")}), targets)
        pieces = within.drop("start", "end_pos")
    return merge_pieces(pieces) if merge_mates else pieces


def _within(variants: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Variants on targets, or all without targets."""
    if targets is None:
        return variants
    return interval_semi_join(variants.withColumns({"start": F.col("pos"), "end_pos": F.col("pos")}), targets).drop("start", "end_pos")


def _observed(variants: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation("variants")
    return variants.observe(seen, F.count(F.lit(1)).alias("variants"), F.count_if(F.col("filter") == "PASS").alias("passed")), seen


def run_dna(
    reads: DataFrame,
    reference: DataFrame,
    known_sites: DataFrame | None = None,
    call_conf: float = DNA_CONFIDENCE,
    emit_conf: float = DNA_CONFIDENCE,
    min_base_quality: int = 17,
    min_mapq: int = 20,
    targets: DataFrame | None = None,
    exons: DataFrame | None = None,
    merge_mates: bool = False,
    **preparation,
) -> Calls:
    """Mapped reads, duplicates marked, qualities recalibrated, SNPs called.

    Without known sites there is nothing to recalibrate against and the step is left
    out.  Marked reads, and with known sites their pieces, are written once (eager); all else stays lazy.
    ``targets`` restricts islands and calls to intervals, ``exons`` adds fragment counts, ``merge_mates`` lets mates
    that overlap count once; further options are those of :class:`Preparation`.
    """
    marked, counters = Preparation(**preparation).run(reads)
    unique = marked.filter("is_duplicate = 0")
    pieces = _evidence(unique, reference, known_sites, targets, merge_mates)
    called = _within(call_snps_of_pieces(pieces, call_conf, emit_conf, min_base_quality, min_mapq, masked=merge_mates), targets)
    variants, seen = _observed(called)
    islands = merge_intervals(marked)
    return Calls(
        variants=variants,
        reads=marked,
        islands=islands if targets is None else filter_intervals(targets, islands),
        targets=realign_targets(unique),
        counts=None if exons is None else count_features(marked, exons),
        counters={**counters, "variants": seen},
    )


def run_rna(
    reads: DataFrame,
    reference: DataFrame,
    known_sites: DataFrame | None = None,
    call_conf: float = RNA_CONFIDENCE,
    emit_conf: float = RNA_CONFIDENCE,
    min_base_quality: int = 17,
    min_mapq: int = 20,
    targets: DataFrame | None = None,
    exons: DataFrame | None = None,
    merge_mates: bool = False,
    annotate: bool = False,
    label: bool = False,
    **preparation,
) -> Calls:
    """As ``run_dna`` with spliced reads cut at introns after duplicates are marked.

    ``label`` adds strand bias ``fs`` and quality by depth ``qd`` with the labels by them
    and by clustering; ``annotate`` attaches known-site ids (``site_id`` in ``known_sites``).
    """
    marked, counters = Preparation(**preparation).run(reads)
    segments = split_n_reads(marked.filter("is_duplicate = 0"), with_sequence=True)
    pieces = _evidence(segments, reference, known_sites, targets, merge_mates)
    called = _within(call_snps_of_pieces(pieces, call_conf, emit_conf, min_base_quality, min_mapq, strand_bias=label, masked=merge_mates), targets)
    if label:
        scored = called.withColumn("qd", F.col("qual") / F.greatest(F.col("depth"), F.lit(1)))
        called = filter_variants(scored.withColumnRenamed("filter", "confidence"))
    if annotate and known_sites is not None:
        called = annotate_variants(called, known_sites)
    variants, seen = _observed(called)
    islands = merge_intervals(segments)
    return Calls(
        variants=variants,
        reads=marked,
        islands=islands if targets is None else filter_intervals(targets, islands),
        targets=realign_targets(segments),
        counts=None if exons is None else count_features(marked, exons),
        counters={**counters, "variants": seen},
    )
