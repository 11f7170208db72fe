"""Aligned bases of real reads against reference cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from locusflow.functions.cigar import placed_operators
from locusflow.functions.quality import quality_at
from locusflow.operators.joins import spread_join
from locusflow.operators.pileup import PILEUP_BIN, pack_sites
from locusflow.session import materialize


def aligned_blocks(reads: DataFrame) -> DataFrame:
    """One row per ungapped stretch: ``block_start, block_end`` on the reference, ``skip`` bases before it in the read."""
    blocks = reads.withColumn("__b", F.explode(F.filter(placed_operators("cigar"), lambda b: b["op"].isin("M", "=", "X"))))
    return blocks.withColumns(
        {
            "block_start": F.col("start") + F.col("__b.ref"),
            "block_end": F.col("start") + F.col("__b.ref") + F.col("__b.len") - 1,
            "skip": F.col("__b.query"),
        }
    ).drop("__b")


def site_marks(sites: DataFrame, width: int) -> DataFrame:
    """``contig_idx, cell, marks``: for each cell with sites a text with a 1 at every site and a 0 elsewhere.

    Marks line up with the cell's letters: cell 0 starts at position 1.
    """
    packed = pack_sites(sites, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for cell, places in zip(batch.column("cell").to_pylist(), batch.column("__sites"), strict=True):
                own = np.full(width, ord("0"), np.uint8)
                own[np.array(places.as_py(), np.int64) - cell * width] = ord("1")
                marks.append(own[1 if cell == 0 else 0 :].tobytes().decode())
            yield pa.RecordBatch.from_arrays([batch.column("contig_idx"), batch.column("cell"), pa.array(marks, pa.string())], ["contig_idx", "cell", "marks"])

    kind = packed.schema["contig_idx"].dataType.simpleString()
    return packed.filter("__bin IS NOT NULL").select("contig_idx", F.col("__bin").alias("cell"), "__sites").mapInArrow(run, f"contig_idx {kind}, cell long, marks string")


def read_pieces(
    reads: DataFrame,
    reference: DataFrame,
    exclude: DataFrame | None = None,
    keep: tuple[str, ...] = ("read_id", "library", "contig_idx", "is_reverse", "mapq"),
    width: int = PILEUP_BIN,
    **join_options,
) -> DataFrame:
    """Mapped reads cut into ungapped pieces that lie in one reference cell, with that cell's letters.

    ``reads`` carries the text columns ``seq`` and ``qual``, which every piece holds whole; ``reference`` holds
    cells of ``width`` bases as returned by ``read_reference``.  A piece covers ``lo`` to ``hi``; ``skip`` bases stand in
    the read before ``block_start``, ``ref`` holds the piece's letters of the reference from ``ref_start`` (its ``lo``) on, and
    ``sites`` has a 1 for each of them that lies on ``exclude`` (null: none does).  Pieces meet their cell and its sites
    by one join each and take along no more of them than they cover.
    Reads on a contig or past an end that ``reference`` does not hold are an error, not
    a silent loss; ``clean_alignments`` clips those that hang over a contig's end.
    """
    mapped = reads.filter((F.col("is_unmapped").cast("int") == 0) & (F.col("cigar") != "*"))
    blocks = aligned_blocks(mapped.select(*keep, "start", "cigar", "seq", "qual")).drop("cigar")
    pieces = blocks.withColumn(
        "cell", F.explode(F.sequence(F.expr(f"block_start div {width}"), F.expr(f"block_end div {width}")))
    )
    cells = reference.select("contig_idx", "cell", F.col("seq").alias("ref"))
    joined = spread_join(pieces, cells, ["contig_idx", "cell"], "left", **join_options)
    lost = F.raise_error(F.concat(F.lit("no reference sequence for contig "), F.col("contig_idx").cast("string"), F.lit(" cell "), F.col("cell").cast("string")))
    joined = joined.withColumn("ref", F.coalesce("ref", lost))
    if exclude is not None:
        packed = materialize(site_marks(exclude, width))
        joined = spread_join(joined, packed, ["contig_idx", "cell"], "left", **join_options)
    joined = joined.withColumns(
        {
            "lo": F.greatest(F.col("block_start"), F.col("cell") * width),
            "hi": F.least(F.col("block_end"), F.col("cell") * width + (width - 1)),
        }
    )
    # Cell 0 starts at position 1, every other cell at its own multiple of the width.
    first = F.col("lo") - F.greatest(F.lit(1), F.col("cell") * width) + 1

    def covered(text: str) -> Column:
        # Bytes are reached directly, characters only by walking the text.
        return F.substring(F.col(text).cast("binary"), first.cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")).cast("string")

    return joined.select(
        *keep, "seq", "qual", "block_start", "skip", covered("ref").alias("ref"), "lo", "hi", F.col("lo").cast("long").alias("ref_start"),
        (F.lit(None).cast("string") if exclude is None else covered("marks")).alias("sites"),
    )


#: Columns of a piece that its bases do not keep.
PIECE_COLUMNS = ("seq", "qual", "block_start", "skip", "ref", "lo", "hi", "ref_start", "sites")


def piece_bases(pieces: DataFrame, masked: bool = False) -> DataFrame:
    """Base rows of pieces; ``masked`` leaves out those on ``sites``."""
    exploded = pieces.withColumn("pos", F.explode(F.sequence("lo", "hi")))
    off = F.col("skip") + F.col("pos") - F.col("block_start")

    def letter(text: str, index: Column) -> Column:
        # Bytes are reached directly, characters only by walking the text.
        return F.substring(F.col(text).cast("binary"), (index + 1).cast("int"), F.lit(1)).cast("string")

    if masked:
        exploded = exploded.filter(F.coalesce(letter("sites", F.col("pos") - F.col("ref_start")), F.lit("")) != "1")
    before = off + F.when(F.col("is_reverse").cast("int") == 1, 1).otherwise(-1)
    length = F.length("seq")
    return exploded.select(
        *[c for c in pieces.columns if c not in PIECE_COLUMNS],
        length.cast("long").alias("read_len"),
        off.alias("off"),
        "pos",
        letter("seq", off).alias("base"),
        F.when((before >= 0) & (before < length), letter("seq", before)).alias("prev_base"),
        letter("ref", F.col("pos") - F.col("ref_start")).alias("ref_base"),
        quality_at("qual", off).cast("long").alias("qual"),
    )


def read_bases(reads: DataFrame, reference: DataFrame, exclude: DataFrame | None = None, **options) -> DataFrame:
    """Base rows ``(*keep, read_len, off, pos, base, prev_base, ref_base, qual)`` of mapped reads, but those on sites to
    ``exclude``: :func:`read_pieces` exploded, so bases themselves are never shuffled."""
    return piece_bases(read_pieces(reads, reference, exclude, **options), masked=exclude is not None)
