"""Locus keys and region text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_locus_key(contig_idx: str | Column = "contig_idx", pos: str | Column = "pos") -> Column:
    """One long that sorts by contig and position: contig in the high half, 0-based position in the low."""
    contig = F.col(contig_idx) if isinstance(contig_idx, str) else contig_idx
    place = F.col(pos) if isinstance(pos, str) else pos
    return F.shiftleft(contig.cast("long"), 32).bitwiseOR((place - 1).cast("long"))


def picard_region(contig: str = "contig", start: str = "start", end: str = "end_pos") -> Column:
    """``contig:start-end``, 1-based inclusive."""
    return F.concat(F.col(contig), F.lit(":"), F.col(start).cast("string"), F.lit("-"), F.col(end).cast("string"))


def bed_region(contig: str = "contig", start: str = "start", end: str = "end_pos") -> Column:
    """Tab-separated BED line, 0-based half-open."""
    return F.concat_ws("\t", F.col(contig), (F.col(start) - 1).cast("string"), F.col(end).cast("string"))
