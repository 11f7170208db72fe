"""Tab-separated interval, annotation, junction and count files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from locusflow.operators.joins import spread_join
from locusflow.operators.pileup import PILEUP_BIN
from locusflow.operators.scans import carry_into_bins, running_sum_before, up_to
from locusflow.sources.lines import numbered_lines, split_fields

# Fixed column order of a splice-junction file.
JUNCTION_COLUMNS = (
    ("contig", "string"), ("start", "bigint"), ("end_pos", "bigint"), ("strand", "int"), ("motif", "int"),
    ("annotated", "int"), ("n_unique", "bigint"), ("n_multi", "bigint"), ("max_overhang", "int"),
)


def parse_bed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """BED to 1-based inclusive ``(contig, start, end_pos)``; other lines drop out."""
    f = F.col("__f")
    start, end = F.get(f, F.lit(1)).try_cast("long"), F.get(f, F.lit(2)).try_cast("long")
    return split_fields(lines, column).select(
        F.get(f, F.lit(0)).alias("contig"), (start + 1).alias("start"), end.alias("end_pos")
    ).filter("start IS NOT NULL AND end_pos IS NOT NULL")


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return parse_bed_lines(spark.read.text(path))


def parse_gff_lines(lines: DataFrame, feature: str | None = "exon", column: str = "value") -> DataFrame:
    """GTF or GFF rows of one feature type: ``(contig, start, end_pos, strand, gene_id)``."""
    f = F.col("__f")
    attributes = F.get(f, F.lit(8))
    quoted = F.regexp_extract(attributes, 'gene_id "([^"]*)"', 1)
    plain = F.regexp_extract(attributes, "(?:^|;)\\s*(?:gene_id|gene|Parent)=([^;]*)", 1)
    rows = split_fields(lines.filter(~F.col(column).startswith("#")), column).select(
        F.get(f, F.lit(0)).alias("contig"),
        F.get(f, F.lit(2)).alias("__feature"),
        F.get(f, F.lit(3)).try_cast("long").alias("start"),
        F.get(f, F.lit(4)).try_cast("long").alias("end_pos"),
        F.get(f, F.lit(6)).alias("strand"),
        F.when(quoted != "", quoted).otherwise(F.nullif(plain, F.lit(""))).alias("gene_id"),
    )
    if feature is not None:
        rows = rows.filter(F.col("__feature") == feature)
    return rows.filter("start IS NOT NULL AND end_pos IS NOT NULL").drop("__feature")


def read_gff(spark: SparkSession, path: str, feature: str | None = "exon") -> DataFrame:
    return parse_gff_lines(spark.read.text(path), feature)


def parse_junction_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Splice junctions, nine columns; lines that do not parse drop out."""
    f = F.col("__f")
    parsed = split_fields(lines, column).filter(F.size(f) == len(JUNCTION_COLUMNS)).select(
        *[F.get(f, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(JUNCTION_COLUMNS)]
    )
    return parsed.filter(" AND ".join(f"{name} IS NOT NULL" for name, _ in JUNCTION_COLUMNS))


def read_junctions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_junction_lines(spark.read.text(path))


def parse_bin_count_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``contig:start-end<TAB>count`` to ``(contig, start, end_pos, reads)``."""
    pattern = "^(.+):(\\d+)-(\\d+)\\t(\\d+)$"

    def part(i: int):
        return F.regexp_extract(F.col(column), pattern, i)

    return lines.filter(F.col(column).rlike(pattern)).select(
        part(1).alias("contig"), part(2).cast("long").alias("start"),
        part(3).cast("long").alias("end_pos"), part(4).cast("long").alias("reads"),
    )


def read_bin_counts(spark: SparkSession, path: str) -> DataFrame:
    return parse_bin_count_lines(spark.read.text(path))


def read_reference(spark: SparkSession, path: str, contigs: DataFrame, width: int = PILEUP_BIN) -> DataFrame:
    """FASTA sequence in fixed cells ``(contig_idx, cell, seq)``; cell ``c`` starts at position ``c * width``.

    Cell 0 has one base fewer, as positions count from 1.  Line offsets come from a
    running sum over line numbers; a cell is assembled from at most ``width`` bases.
    """
    lines = numbered_lines(spark, [path]).withColumn("__cell", F.expr("line_no div 100000"))
    name = F.regexp_extract("value", "^>(\\S+)", 1).alias("contig")
    lines = lines.withColumn("__head", F.when(F.col("value").startswith(">"), F.struct("line_no", name)))
    # The header above a line is the latest one in its stretch of lines, else in an earlier stretch.
    carried = carry_into_bins(lines, ["path"], "__cell", F.max("__head"), F.max, "__carry")
    above = F.coalesce(F.max("__head").over(up_to(["path", "__cell"], ["line_no"])), F.col("__carry"))
    body = carried.withColumn("contig", above["contig"]).filter(F.col("__head").isNull())
    located = spread_join(
        body.select("contig", "line_no", "__cell", "value", F.length("value").cast("long").alias("__size")),
        contigs.select("contig", "contig_idx"), ["contig"], salt_on=["line_no"],
    )
    placed = running_sum_before(located, ["contig_idx"], "__cell", ["line_no"], "__size", "__before")
    first, last = F.col("__before") + 1, F.col("__before") + F.col("__size")
    cut = placed.filter("__size > 0").select(
        "contig_idx", "value", first.alias("__first"), last.alias("__last"),
        F.explode(F.sequence(F.expr(f"(__before + 1) div {width}"), F.expr(f"(__before + __size) div {width}"))).alias("cell"),
    )
    begin = F.greatest(F.col("__first"), F.col("cell") * width)
    stop = F.least(F.col("__last"), F.col("cell") * width + (width - 1))
    text = F.substring(F.col("value"), (begin - F.col("__first") + 1).cast("int"), (stop - begin + 1).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct(begin.alias("at"), F.upper(text).alias("seq"))))
    return cut.groupBy("contig_idx", "cell").agg(parts.alias("__p")).select(
        "contig_idx", "cell", F.array_join("__p.seq", "").alias("seq")
    )
