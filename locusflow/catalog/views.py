"""Sequencing tables derived from the test tables; all arithmetic is on integers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.functions.staging import computed_once
from locusflow.operators.pileup import explode_positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Share out rows that heavy per-row work follows, where the input has fewer parts than there are cores.

    The test tables are single Parquet row groups; input of real size is left alone.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots, *keys)


def text_lines(df: DataFrame, text: str) -> DataFrame:
    """A column of lines, built once per row as if it had been read from a file."""
    return computed_once(df, value=F.expr(text)).select("value")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five long contigs and twenty-five short ones."""
    long_ones = table(spark, sf_dir, "region").selectExpr(
        "bigint(r_regionkey) AS contig_idx",
        "concat('chr', r_regionkey + 1) AS contig",
        "bigint(1000000 - 200000 * r_regionkey) AS length",
    )
    short_ones = table(spark, sf_dir, "nation").selectExpr(
        "bigint(5 + n_nationkey) AS contig_idx",
        "concat('scf', n_nationkey) AS contig",
        "bigint(500 + 40 * n_nationkey) AS length",
    )
    return long_ones.unionByName(short_ones)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contigs and one scaffold per customer."""
    scaffolds = table(spark, sf_dir, "customer").selectExpr(
        "30 + c_custkey AS contig_idx", "concat('un', c_custkey) AS contig", "500 + (c_custkey * 37) % 1500 AS length"
    )
    return contigs(spark, sf_dir).unionByName(scaffolds)


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aligned read per line item, 51 to 100 bases long."""
    span = "(1000000 - 200000 * (l_suppkey % 5) - 200)"
    mate_idx = "(CASE WHEN l_orderkey % 20 = 0 THEN (l_suppkey + 1) % 5 ELSE l_suppkey % 5 END)"
    scatter = "(l_partkey * 7919 + l_orderkey * 104729 + l_linenumber * 31"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "((l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) * 100000 + l_partkey AS read_id",
        "l_orderkey AS template_id",
        "l_suppkey % 5 AS contig_idx",
        f"1 + {scatter}) % {span} AS start",
        f"{scatter}) % {span} + 50 + bigint(l_quantity) AS end_pos",
        f"{mate_idx} AS mate_contig_idx",
        f"1 + {scatter} + 150) % (1000000 - 200000 * {mate_idx} - 200) AS mate_start",
        "50 + bigint(l_quantity) AS read_len",
        "l_partkey % 61 AS mapq",
        "l_linenumber % 2 AS is_reverse",
        "CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS is_unmapped",
        "l_linenumber AS mate_no",
        "concat('lib', l_suppkey % 3) AS library",
    )


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variant per order, written by one of seven shards."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS variant_id", "o_custkey % 7 AS shard", "o_custkey % 5 AS contig_idx",
        "1 + (o_orderkey * 104729) % 5000 AS pos", "o_totalprice AS qual",
        "substr('ACGT', int(1 + o_orderkey % 4), 1) AS ref",
        "substr('ACGT', int(1 + (o_orderkey + 1 + o_custkey % 3) % 4), 1) AS alt",
        "(o_custkey % 400) / 10.0D AS fs", "(o_orderkey % 100) / 10.0D AS qd",
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exon per customer in fifty genes."""
    start = "1 + (c_custkey * 7919) % (1000000 - 200000 * (c_custkey % 5) - 400)"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey % 50 AS gene_id", "c_custkey AS exon_id", "c_custkey % 5 AS contig_idx",
        f"{start} AS start", f"{start} + 60 + c_custkey % 140 AS end_pos",
    )


def known_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One known variant site per part."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS site_id", "p_partkey % 5 AS contig_idx",
        "1 + (p_partkey * 7919) % (1000000 - 200000 * (p_partkey % 5)) AS pos",
    )


def _base_at(off: Column, complement: Column | None = None) -> tuple[Column, Column]:
    """Reference and read base at an offset; planted SNPs and errors as in the fixture."""
    pos = F.col("start") + off
    code = F.pmod(F.pmod(pos * 37 + F.col("contig_idx") * 13, F.lit(11)), F.lit(4))
    step = (
        F.when(F.pmod(F.col("read_id") + off, F.lit(97)) == 0, 1)
        .when((F.pmod(pos, F.lit(211)) == 0) & (F.pmod("read_id", F.lit(2)) == 0), 2)
        .otherwise(0)
    )

    def letter(index: Column) -> Column:
        return F.substring(F.lit("ACGT"), (1 + index).cast("int"), F.lit(1))

    return letter(code), letter(F.pmod(code + step, F.lit(4)))


def with_bases(positions: DataFrame) -> DataFrame:
    """Bases of exploded read positions (columns ``read_id, contig_idx, start, off, pos, read_len``)."""
    ref, base = _base_at(F.col("off"))
    qual = 2 + F.pmod(F.col("read_id") + F.col("off") * 7, F.lit(39))
    return positions.withColumns({"ref_base": ref, "base": base, "qual": qual})


def with_previous_base(bases: DataFrame) -> DataFrame:
    """The base read before this one in sequencing direction; null at the first cycle."""
    step = F.when(F.col("is_reverse") == 1, 1).otherwise(-1)
    off = F.col("off") + step
    return bases.withColumn("prev_base", F.when((off >= 0) & (off < F.col("read_len")), _base_at(off)[1]))


def bases(spark: SparkSession, sf_dir: str, min_mapq: int = 0, **explode_options) -> DataFrame:
    """One row per aligned base of the mapped reads."""
    reads = (
        alignments(spark, sf_dir)
        .filter((F.col("is_unmapped") == 0) & (F.col("mapq") >= min_mapq))
        .select("read_id", "template_id", "library", "contig_idx", "start", "end_pos", "read_len", "is_reverse", "mapq")
    )
    if not explode_options.get("cluster", True):
        reads = spread_small(reads, "read_id")
    return with_bases(explode_positions(reads, **explode_options))


def quality_text(first: int = 35) -> Column:
    """Quality text of the fixture: ``(read_id + off * 7) % 39`` at each offset, as characters from ``first`` on.

    It repeats every 39 bases, and 28 is the inverse of 7 modulo 39.  Ids are reduced before they are multiplied, as they
    take up to 60 bits on large tables.
    """
    text = F.lit("".join(chr(first + k * 7 % 39) for k in range(39)))
    return F.substring(F.repeat(text, F.lit(4)), (1 + F.pmod(F.pmod("read_id", F.lit(39)) * 28, F.lit(39))).cast("int"), F.col("read_len").cast("int"))


def _with_text(reads: DataFrame, first: Column, period: int, code: Callable[[Column], Column], pattern: Column) -> DataFrame:
    """Add ``seq``: ``read_len`` letters from position ``first`` on, a piece of a repeated pattern with the planted SNPs and errors in it.

    Each change is made to a text that is there; nested in one expression, its code would double with every change.
    """
    text = F.substring(F.repeat(pattern, F.lit(100 // period + 2)), (1 + F.pmod(first, F.lit(period))).cast("int"), F.col("read_len").cast("int"))
    reads = computed_once(reads, seq=text)
    snp, wrong = F.pmod(-first, F.lit(211)), F.pmod(-F.col("read_id"), F.lit(97))
    for off, step, where in ((snp, 2, F.pmod("read_id", F.lit(2)) == 0), (wrong, 1, F.lit(True)), (wrong + 97, 1, F.lit(True))):
        letter = F.substring(F.lit("ACGT"), (1 + F.pmod(code(first + off) + step, F.lit(4))).cast("int"), F.lit(1))
        changed = F.when(where & (off < F.col("read_len")), F.overlay("seq", letter, (off + 1).cast("int"))).otherwise(F.col("seq"))
        reads = computed_once(reads, seq=changed)
    return reads


def _patterns(period: int, code: Callable[[int, int], int]) -> Column:
    """One period of the letters of each contig."""
    texts = [F.lit("".join("ACGT"[code(p, c)] for p in range(period))) for c in range(30)]
    return F.element_at(F.array(*texts), (F.col("contig_idx") + 1).cast("int"))


def with_read_text(reads: DataFrame) -> DataFrame:
    """Add ``seq`` and ``qual`` of whole reads: the letters and qualities of ``with_bases`` as text."""
    code = lambda pos: F.pmod(F.pmod(pos * 37 + F.col("contig_idx") * 13, F.lit(11)), F.lit(4))
    read = _with_text(reads, F.col("start"), 11, code, _patterns(11, lambda p, c: (p * 37 + c * 13) % 11 % 4))
    return read.withColumn("qual", quality_text())


def read_records(spark: SparkSession, sf_dir: str, fold: int) -> DataFrame:
    """Full reads of pairs: CIGAR and quality text, starts folded so that copies occur.

    Mates are the line items 1 and 2, 3 and 4, 5 and 6 of an order; one without its partner is an unpaired read.
    """
    return (
        spread_small(alignments(spark, sf_dir), "read_id")
        .withColumn("template_id", F.expr("template_id * 4 + (mate_no - 1) div 2"))
        .withColumns(
            {
                "contig_idx": F.expr("template_id % 5"),
                "mate_contig_idx": F.expr("template_id % 5"),
                "library": F.expr("concat('lib', template_id % 3)"),
                "start": F.expr(f"1 + start % {fold}"),
                "clip": F.expr("read_id % 4"),
            }
        )
        .withColumn("end_pos", F.expr("start + read_len - clip - 1"))
        .withColumn("lead", F.expr("CASE WHEN is_reverse = 1 THEN 0 ELSE clip END"))
        .withColumn(
            "cigar",
            F.expr(
                "CASE WHEN clip = 0 THEN concat(read_len, 'M') "
                "WHEN is_reverse = 1 THEN concat(read_len - clip, 'M', clip, 'S') "
                "ELSE concat(clip, 'S', read_len - clip, 'M') END"
            ),
        )
        .withColumn("qual", quality_text())
        .withColumn("flag", F.expr("int(CASE WHEN is_unmapped = 1 THEN 4 ELSE 0 END + 16 * is_reverse)"))
        .drop("clip")
    )


def _varied(period: int = 251) -> Column:
    """One period of the varied reference of each contig."""
    return _patterns(period, lambda p, c: (p * p * 37 + c * 13 + 7919) % 251 % 4)


def with_sequence(records: DataFrame) -> DataFrame:
    """Add ``seq``: bases of a varied reference at each read offset, with the fixture's errors and SNPs."""
    code = lambda pos: F.pmod((pos * pos * 37 + F.col("contig_idx") * 13 + 7919) % 251, F.lit(4))
    return _with_text(records, F.col("start") - F.col("lead"), 251, code, _varied())


def reference_cells(spark: SparkSession, sf_dir: str, width: int, varied: bool = True) -> DataFrame:
    """The reference sequence behind ``with_sequence`` in cells of ``width`` bases, or the one behind ``with_read_text``."""
    period = 251 if varied else 11
    pattern = _varied() if varied else _patterns(period, lambda p, c: (p * 37 + c * 13) % 11 % 4)
    first = F.greatest(F.lit(1), F.col("cell") * width)
    size = F.least(F.col("length"), F.col("cell") * width + (width - 1)) - first + 1
    text = F.substring(F.repeat(pattern, F.lit(width // period + 2)), (1 + first % period).cast("int"), size.cast("int"))
    return (
        contigs(spark, sf_dir)
        .withColumn("cell", F.expr(f"explode(sequence(0L, length div {width}))"))
        .select("contig_idx", "cell", text.alias("seq"))
    )
