"""FASTQ files and their manifest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.session import materialize
from locusflow.sources.lines import first_lines, numbered_lines, plain_path, qualified, raw_lines

#: Measured bytes of the table of blocks (a path and two numbers each) up to which it is broadcast; with more, lines are
#: numbered by a join and grouped.
BLOCK_TABLE_BYTES = 32 << 20
_FRAMES = "path string, record long, name string, seq string, qual string, lines int"


def parse_manifest(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(path1, path2)`` per input; one field means a single or interleaved file, other counts are ignored."""
    fields = F.split(F.col(column), "\t")
    return (
        lines.select(fields.alias("f"))
        .filter(F.size("f").isin(1, 2) & (F.col("f")[0] != ""))
        .select(F.col("f")[0].alias("path1"), F.get("f", F.lit(1)).alias("path2"))
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def parse_fastq_lines(lines: DataFrame, group: tuple[str, ...] = ("path",), line_no: str = "line_no") -> DataFrame:
    """Numbered lines to records ``(*group, record, name, seq, qual)``.

    Each record is four lines; they usually share a task and merge before the
    shuffle.  A record with lines missing at the end of the file drops out.
    """
    place = F.pmod(F.col(line_no), F.lit(4))
    record = F.expr(f"{line_no} div 4").alias("record")

    def line(n: int, name: str) -> Column:
        return F.max(F.when(place == n, F.col("value"))).alias(name)

    return (
        lines.groupBy(*group, record)
        .agg(line(0, "__name"), line(1, "seq"), line(3, "qual"), F.count(F.lit(1)).alias("__lines"))
        .filter(F.col("__lines") == 4)
        .select(*group, "record", F.regexp_replace("__name", "^@", "").alias("name"), "seq", "qual")
    )


def frame_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that come block by block in file order (``path, block, first, value``), as ``_FRAMES`` rows.

    ``first`` is the number of the block's first line in its file.  A record that lies in one block is complete
    (``lines`` 4); of one cut by the block's edge this row holds the lines that are here.  At most three lines are held.
    """
    block, line, held = None, 0, []

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [()] * 6
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "record", "name", "seq", "qual", "lines"])

    def framed(path: str, last: int, lines: list[str]) -> tuple:
        """The row of ``lines``, of which the last has the number ``last``; they are of one record."""
        at = (last - len(lines) + 1) % 4
        place = [None] * at + lines + [None] * (4 - at - len(lines))
        return path, last // 4, place[0], place[1], place[3], len(lines)

    for batch in batches:
        paths, blocks, firsts, values = (batch.column(c).to_pylist() for c in ("path", "block", "first", "value"))
        out = []
        for path, start, first, value in zip(paths, blocks, firsts, values, strict=True):
            if (path, start) != block:
                if held:
                    out.append(framed(block[0], line - 1, held))
                block, line, held = (path, start), first, []
            held.append(value)
            if line % 4 == 3:
                out.append(framed(path, line, held))
                held = []
            line += 1
        yield rows(out)
    if held:
        yield rows([framed(block[0], line - 1, held)])


def fastq_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, record, name, seq, qual`` of FASTQ files, as :func:`parse_fastq_lines` gives them.

    A first scan counts the lines of each block.  The second builds records where their block is read and writes them
    once; only the few lines at the edges of blocks are shuffled.  Eager: it counts, and writes the records.
    """
    raw = raw_lines(spark, paths)
    first = materialize(first_lines(raw).select("path", "block", "first"))
    if (first.agg(F.sum(F.octet_length("path") + 16)).first()[0] or 0) > BLOCK_TABLE_BYTES:
        return parse_fastq_lines(numbered_lines(spark, paths))
    # A broadcast join keeps the order of the lines.
    placed = raw.join(F.broadcast(first), ["path", "block"]).select("path", "block", "first", "value")
    frames = materialize(placed.mapInArrow(frame_records, _FRAMES))
    cut = frames.filter("lines < 4").groupBy("path", "record").agg(
        F.max("name").alias("name"), F.max("seq").alias("seq"), F.max("qual").alias("qual"), F.sum("lines").cast("int").alias("lines")
    )
    whole = frames.filter("lines = 4").unionByName(cut.filter("lines = 4"))
    return whole.select("path", "record", F.regexp_replace("name", "^@", "").alias("name"), "seq", "qual")


def read_fastq(spark: SparkSession, inputs: list[tuple[str, ...]], interleaved: bool = False) -> DataFrame:
    """Reads ``(sample, path, ordinal, mate, name, seq, qual)`` of plain, gzip or bzip2 files.

    ``inputs`` holds ``(sample, path)`` or ``(sample, path1, path2)``; it is a list of
    file names, not data.  In an interleaved file records alternate between mates.  Eager, see :func:`fastq_records`.
    """
    rows = []
    for sample, *paths in inputs:
        for mate, path in enumerate(paths, start=1):
            rows.append((sample, path, qualified(spark, path), mate if len(paths) == 2 else 0))
    files = spark.createDataFrame(rows, "sample string, given string, path string, role int").select(
        "sample", plain_path("path").alias("path"), "role"
    )
    records = fastq_records(spark, [r[1] for r in rows])
    # One row per input file, held in this process already.
    named = records.join(F.broadcast(files), "path")
    alternating = F.lit(interleaved) & (F.col("role") == 0)
    ordinal = F.when(alternating, F.expr("record div 2")).otherwise(F.col("record"))
    mate = F.when(alternating, F.col("record") % 2 + 1).otherwise(F.greatest("role", F.lit(1)))
    return named.select("sample", "path", ordinal.alias("ordinal"), mate.cast("int").alias("mate"), "name", "seq", "qual")


def fastq_text() -> Column:
    """One record as its four lines."""
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col("name")), F.col("seq"), F.lit("+"), F.col("qual"))
