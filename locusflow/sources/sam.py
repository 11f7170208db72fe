"""SAM text and the sequence dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.functions.cigar import alignment_end
from locusflow.operators.joins import spread_join
from locusflow.operators.scans import running_sum_before
from locusflow.sources.lines import numbered_lines, split_fields

# Fixed values of the SAM format: column order and flag bits.
SAM_FIELDS = (
    ("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "bigint"), ("mapq", "int"),
    ("cigar", "string"), ("rnext", "string"), ("pnext", "bigint"), ("tlen", "bigint"), ("seq", "string"), ("qual", "string"),
)
PAIRED, UNMAPPED, REVERSE = 0x1, 0x4, 0x10


def parse_dict_lines(lines: DataFrame, column: str = "value", order: str = "line_no") -> DataFrame:
    """``(contig_idx, contig, length)`` in file order; a length that is no number becomes 0."""
    entries = lines.filter(F.col(column).startswith("@SQ")).select(F.col(order).alias("__line"), column)
    names = split_fields(entries, column).select(
        "__line",
        F.regexp_extract(F.get("__f", F.lit(1)), "^SN:(.*)$", 1).alias("contig"),
        F.coalesce(
            F.regexp_extract(F.get("__f", F.lit(2)), "^LN:(.*)$", 1).try_cast("long"), F.lit(0)
        ).alias("length"),
        F.lit(1).alias("__one"),
        F.expr("__line div 100000").alias("__cell"),
    ).withColumn("__file", F.lit(0))
    ranked = running_sum_before(names, ["__file"], "__cell", ["__line"], "__one", "contig_idx")
    return ranked.select("contig_idx", "contig", "length")


def read_dict(spark: SparkSession, path: str) -> DataFrame:
    return parse_dict_lines(numbered_lines(spark, [path]))


def _tags(fields: Column) -> Column:
    """Optional fields as a map from tag to text; a repeated tag keeps its first value."""
    optional = F.filter(
        F.slice(fields, F.lit(12), F.greatest(F.size(fields) - 11, F.lit(0))),
        lambda t: t.rlike("^[A-Za-z][A-Za-z0-9]:[AifZHB]:"),
    )
    names = F.transform(optional, lambda t: F.substring(t, 1, 2))
    values = F.transform(optional, lambda t: F.substring(t, F.lit(6), F.length(t)))
    distinct = F.array_distinct(names)
    firsts = F.transform(distinct, lambda n: F.element_at(values, F.array_position(names, n).cast("int")))
    # The format forbids repeated tags, so the second form is rarely evaluated.
    return F.when(F.size(distinct) == F.size(names), F.map_from_arrays(names, values)).otherwise(
        F.map_from_arrays(distinct, firsts)
    )


def _split_sam(lines: DataFrame, column: str) -> tuple[DataFrame, Column]:
    body = lines.select(column).filter(~F.col(column).startswith("@") & (F.col(column) != ""))
    well_formed = F.size("__f") >= len(SAM_FIELDS)
    for i, (_, kind) in enumerate(SAM_FIELDS):
        if kind != "string":
            well_formed = well_formed & F.get("__f", F.lit(i)).try_cast(kind).isNotNull()
    return split_fields(body, column), well_formed


def parse_sam_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Header lines dropped, eleven fixed fields typed, optional fields in ``tags``; bad lines left out."""
    fields, well_formed = _split_sam(lines, column)
    return fields.filter(well_formed).select(
        *[F.col("__f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(SAM_FIELDS)],
        _tags(F.col("__f")).alias("tags"),
    )


def rejected_sam_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that ``parse_sam_lines`` leaves out, for counting or inspection."""
    fields, well_formed = _split_sam(lines, column)
    rejected = fields.filter(~F.coalesce(well_formed, F.lit(False)))
    return rejected.select(F.array_join("__f", "\t").alias(column))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_sam_lines(spark.read.text(path))


def parse_read_groups(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(rg_id, rg_lb, rg_sm, rg_pl, rg_pu)`` of the ``@RG`` header lines; an absent field is null."""
    entries = split_fields(lines.select(column).filter(F.col(column).startswith("@RG\t")), column)

    def field(tag: str) -> Column:
        return F.get(F.transform(F.filter("__f", lambda f: f.startswith(f"{tag}:")), lambda f: F.substring(f, F.lit(4), F.length(f))), F.lit(0))

    names = ("ID", "LB", "SM", "PL", "PU")
    groups = entries.select(*[field(n).alias(f"rg_{n.lower()}") for n in names]).filter("rg_id IS NOT NULL")
    return groups.groupBy("rg_id").agg(*[F.min(f"rg_{n.lower()}").alias(f"rg_{n.lower()}") for n in names[1:]])


def read_groups(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_read_groups(spark.read.text(path))


def to_alignments(sam: DataFrame, contigs: DataFrame, groups: DataFrame | None = None, **join_options) -> DataFrame:
    """Parsed SAM records in the column names the operators use; contigs become dictionary indexes.

    An unknown or absent contig gets index -1.  The read name is the template.  The
    library is that of the read's group in ``groups`` (see ``parse_read_groups``), else the
    group itself.
    """
    index = contigs.select(F.col("contig").alias("rname"), F.col("contig_idx").alias("__own"))
    mates = contigs.select(F.col("contig").alias("__mate"), F.col("contig_idx").alias("__other"))
    found = spread_join(sam, index, ["rname"], "left", **join_options)
    found = found.withColumn("__mate", F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext")))
    found = spread_join(found, mates, ["__mate"], "left", **join_options)
    flag = F.col("flag")

    def bit(mask: int) -> Column:
        return (flag.bitwiseAND(F.lit(mask)) != 0).cast("int")

    found = found.withColumn("rg_id", F.try_element_at("tags", F.lit("RG")))
    library = F.col("rg_id")
    if groups is not None:
        found = spread_join(found, groups.select("rg_id", F.col("rg_lb").alias("__lb")), ["rg_id"], "left", **join_options)
        library = F.coalesce("__lb", "rg_id")
    return found.select(
        F.concat_ws("/", "qname", F.when(bit(0x40) == 1, "1").when(bit(0x80) == 1, "2").otherwise("0")).alias("read_id"),
        F.col("qname").alias("template_id"),
        "flag",
        F.coalesce("__own", F.lit(-1)).alias("contig_idx"),
        F.col("pos").alias("start"),
        F.when(F.col("cigar") == "*", F.col("pos")).otherwise(alignment_end("pos", "cigar")).alias("end_pos"),
        F.coalesce("__other", F.lit(-1)).alias("mate_contig_idx"),
        F.col("pnext").alias("mate_start"),
        F.length("seq").cast("long").alias("read_len"),
        "mapq",
        bit(REVERSE).alias("is_reverse"),
        bit(UNMAPPED).alias("is_unmapped"),
        "cigar", "seq", "qual",
        "rg_id",
        library.alias("library"),
    )
