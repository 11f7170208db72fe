"""VCF text in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from locusflow.sources.lines import split_fields

# Fixed values of the VCF format: column order and the format line.
VCF_COLUMNS = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
VCF_FIRST_LINE = "##fileformat=VCFv4.2"


def _missing(col: Column) -> Column:
    return F.when((col != ".") & (col != ""), col)


def _info(text: Column) -> Column:
    """INFO as a map; a flag without value maps to ``true``, a repeated key keeps its first value."""
    entries = F.filter(F.split(F.coalesce(_missing(text), F.lit("")), ";"), lambda e: e != "")
    names = F.transform(entries, lambda e: F.substring_index(e, "=", 1))
    first = F.filter(entries, lambda e, i: F.array_position(names, F.substring_index(e, "=", 1)) == i + 1)
    return F.map_from_entries(
        F.transform(
            first,
            lambda e: F.struct(
                F.substring_index(e, "=", 1),
                F.when(F.instr(e, "=") > 0, F.substring(e, F.instr(e, "=") + 1, F.length(e))).otherwise("true"),
            ),
        )
    )


def parse_vcf_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Variants ``(contig, pos, id, ref, alt, qual, filter, info, info_text, format, samples, sample, gt)``; header lines dropped.

    ``samples`` holds the text of every sample column, ``info_text`` that of INFO; ``sample`` and ``gt`` are the first sample's.
    """
    body = split_fields(lines.filter(~F.col(column).startswith("#")), column)
    place = F.get("__f", F.lit(1)).try_cast("long")

    def at(i: int) -> Column:
        return F.get("__f", F.lit(i))

    return body.filter((F.size("__f") >= 8) & place.isNotNull()).select(
        *[c for c in body.columns if c != "__f"],
        at(0).alias("contig"), place.alias("pos"), _missing(at(2)).alias("id"), at(3).alias("ref"), at(4).alias("alt"),
        at(5).try_cast("double").alias("qual"), _missing(at(6)).alias("filter"), _info(at(7)).alias("info"),
        _missing(at(7)).alias("info_text"), at(8).alias("format"),
        F.slice("__f", F.lit(10), F.greatest(F.size("__f") - 9, F.lit(0))).alias("samples"), at(9).alias("sample"),
        F.when(at(8).startswith("GT"), F.substring_index(at(9), ":", 1)).alias("gt"),
    )


#: Names of files that are read: call sets, plain or compressed, and the parts that ``write_vcf`` leaves in its folder.
VCF_FILES = "{*.vcf,*.vcf.gz,*.vcf.bz2,part-*}"


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All ``.vcf`` files below the paths, and the part files of ``write_vcf``, with the file of each variant in ``shard``."""
    lines = spark.read.option("pathGlobFilter", VCF_FILES).option("recursiveFileLookup", "true").text(paths)
    return parse_vcf_lines(lines.select("value", F.col("_metadata.file_name").alias("shard")))


def read_vcf_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Header lines ``(line_no, value)`` of the first file by name; a header is small."""
    lines = spark.read.option("pathGlobFilter", VCF_FILES).option("recursiveFileLookup", "true").text(paths)
    named = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    head = named.filter(F.col("value").startswith("#")).withColumn("id", F.monotonically_increasing_id())
    first = head.agg(F.min("path").alias("path"))
    order = Window.partitionBy("path").orderBy("block", "id")
    return head.join(F.broadcast(first), "path").select((F.row_number().over(order) - 1).cast("long").alias("line_no"), "value")


def vcf_lines(variants: DataFrame, sample: str = "SAMPLE1") -> DataFrame:
    """Variants as ``(contig_idx, pos, value)`` text lines with two decimals of quality.

    INFO, FORMAT and all samples come from ``info_text``, ``format`` and ``samples`` where there are such
    columns; else ``depth`` and ``gt`` are written.
    """

    def text(name: str, default: str = ".") -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in variants.columns else F.lit(default)

    quality = F.when(F.col("qual").isNotNull(), F.format_string("%.2f", "qual")).otherwise(".") if "qual" in variants.columns else F.lit(".")
    info = F.lit(".")
    if "depth" in variants.columns:
        info = F.concat(F.lit("DP="), F.col("depth").cast("string"))
    if "info_text" in variants.columns:
        info = F.coalesce("info_text", info)
    values = [text("format", "GT"), text("gt", "./.")]
    if "samples" in variants.columns:
        values = [F.coalesce("format", F.when(F.size("samples") > 0, "GT")), F.when(F.size("samples") > 0, F.array_join("samples", "\t"))]
    fields = [
        text("contig"), text("pos"), text("id"), text("ref"), text("alt"), quality, text("filter"), info,
        *values,
    ]
    return variants.select("contig_idx", "pos", F.concat_ws("\t", *fields).alias("value"))


def header_lines(spark: SparkSession, contigs: DataFrame, sample: str = "SAMPLE1") -> DataFrame:
    """Header as rows that sort before every variant; one line per dictionary entry."""
    first = spark.createDataFrame([(-3, VCF_FIRST_LINE)], "rank int, value string")
    last = spark.createDataFrame([(-1, "#" + "\t".join([*VCF_COLUMNS, sample]))], "rank int, value string")
    named = contigs.select(
        F.lit(-2).alias("rank"), F.col("contig_idx").cast("long").alias("pos"),
        F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), F.col("length").cast("string"), F.lit(">")).alias("value"),
    )
    ends = first.unionByName(last).select("rank", F.lit(0).cast("long").alias("pos"), "value")
    return ends.unionByName(named).select(F.col("rank").cast("long").alias("contig_idx"), "pos", "value")


def write_vcf(
    variants: DataFrame, path: str, contigs: DataFrame, sample: str = "SAMPLE1", header: DataFrame | None = None
) -> None:
    """One ordered call set: header and variants in a single range sort, part files in order.

    Parts are not forced into one task; concatenated by name they form one file.
    ``header`` (as ``read_vcf_header`` returns it) is written instead of a made one.  A
    variant on a contig that ``contigs`` does not name is an error.
    """
    spark = variants.sparkSession
    named = variants
    if "contig" not in variants.columns:
        unknown = F.raise_error(F.concat(F.lit("unknown contig index "), F.col("contig_idx").cast("string")))
        named = variants.join(contigs.select("contig_idx", "contig"), "contig_idx", "left")
        named = named.withColumn("contig", F.coalesce("contig", unknown))
    head = header_lines(spark, contigs, sample) if header is None else header.select(
        F.lit(-3).cast("long").alias("contig_idx"), F.col("line_no").alias("pos"), "value"
    )
    lines = head.unionByName(
        vcf_lines(named, sample).withColumn("contig_idx", F.col("contig_idx").cast("long"))
    )
    ordered = lines.orderBy("contig_idx", "pos", "value").select("value")
    ordered.write.mode("errorifexists").text(path)
