"""Read-level predicates and projections that run before any shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from locusflow.functions.cigar import clip_cigar
from locusflow.operators.joins import spread_join

#: SAM flag bit of a duplicate read.
NOT_PRIMARY = 0x100 | 0x200 | 0x800
DUPLICATE_FLAG = 0x400


def _fates(paired: bool, keep_cross_contig: bool) -> tuple[Column, Column]:
    """Conditions ``(unmapped, other_contig)``; a read failing neither is kept."""
    unmapped = F.col("is_unmapped").cast("int") == 1
    if not paired:
        return unmapped, F.lit(False)
    same = F.col("contig_idx") == F.col("mate_contig_idx")
    placed = (F.col("contig_idx") >= 0) | (F.col("mate_contig_idx") >= 0)
    return unmapped, ~unmapped & ~((same | F.lit(keep_cross_contig)) & placed)


def filter_mapped(df: DataFrame, paired: bool = True, keep_cross_contig: bool = True) -> DataFrame:
    """Keep mapped reads; paired input may also drop pairs whose mates lie on different contigs."""
    unmapped, other = _fates(paired, keep_cross_contig)
    return df.filter(~unmapped & ~other)


def stage_counters(paired: bool = True, keep_cross_contig: bool = True) -> list[Column]:
    """Aggregates for reads in, out, unmapped and cross-contig."""
    unmapped, other = _fates(paired, keep_cross_contig)
    return [
        F.count(F.lit(1)).alias("reads_in"),
        F.count_if(~unmapped & ~other).alias("reads_out"),
        F.count_if(unmapped).alias("unmapped"),
        F.count_if(other).alias("different_contig"),
    ]


def stage_metrics(df: DataFrame, by: list[str] | None = None, paired: bool = True, keep_cross_contig: bool = True) -> DataFrame:
    """The filter counters as a table, one row per ``by`` group (or one in all)."""
    return df.groupBy(*(by or [])).agg(*stage_counters(paired, keep_cross_contig))


def filter_mapped_observed(
    df: DataFrame, paired: bool = True, keep_cross_contig: bool = True, name: str = "filter_mapped"
) -> tuple[DataFrame, Observation]:
    """``filter_mapped`` whose counters come with the action that consumes the result."""
    seen = Observation(name)
    watched = df.observe(seen, *stage_counters(paired, keep_cross_contig))
    return filter_mapped(watched, paired, keep_cross_contig), seen


def primary_reads(df: DataFrame, flag: str = "flag") -> DataFrame:
    """Drop secondary and supplementary alignments and reads that failed quality checks, where ``flag`` tells."""
    if flag not in df.columns:
        return df
    return df.filter(F.coalesce(F.col(flag).cast("int"), F.lit(0)).bitwiseAND(F.lit(NOT_PRIMARY)) == 0)


def remove_duplicates(df: DataFrame, flag: str = "flag") -> DataFrame:
    """Drop reads whose duplicate flag is set."""
    return df.filter(F.col(flag).bitwiseAND(F.lit(DUPLICATE_FLAG)) == 0)


def clean_alignments(df: DataFrame, contigs: DataFrame, keep_unmapped: bool = True, **join_options) -> DataFrame:
    """Mapping quality 0 for unmapped reads; alignments end at the contig end at the latest.

    Where there is a ``cigar``, the bases past the end become a soft clip.
    """
    lengths = contigs.select("contig_idx", F.col("length").alias("__length"))
    known = spread_join(df, lengths, ["contig_idx"], "left", **join_options)
    unmapped = F.col("is_unmapped").cast("int") == 1
    over = (F.col("end_pos") > F.col("__length")) & (F.col("cigar") != "*")
    clipped = F.when(over, clip_cigar("cigar", F.col("__length") - F.col("start") + 1)).otherwise(F.col("cigar"))
    cleaned = known.withColumns(
        {
            "mapq": F.when(unmapped, F.lit(0)).otherwise(F.col("mapq")),
            "end_pos": F.least("end_pos", F.coalesce("__length", "end_pos")),
            **({"cigar": clipped} if "cigar" in df.columns else {}),
        }
    ).drop("__length")
    return cleaned if keep_unmapped else cleaned.filter(~unmapped)


@dataclass(frozen=True)
class ReadGroup:
    """Read-group fields with the documented defaults."""

    id: str = "GROUP1"
    lb: str = "LIB1"
    pl: str = "ILLUMINA"
    pu: str = "UNIT1"
    sm: str = "SAMPLE1"

    @classmethod
    def parse(cls, text: str) -> ReadGroup:
        """From ``ID:x LB:y ...``; absent fields keep their default."""
        pairs = dict(part.split(":", 1) for part in text.split() if ":" in part)
        return cls(**{k.lower(): v for k, v in pairs.items() if k.lower() in cls.__dataclass_fields__})


def set_read_group(df: DataFrame, group: ReadGroup = ReadGroup(), overwrite: bool = True) -> DataFrame:
    """Stamp ``rg_id, rg_lb, rg_pl, rg_pu, rg_sm``; without ``overwrite`` only where missing."""
    stamped = {}
    for field in ReadGroup.__dataclass_fields__:
        name, value = f"rg_{field}", F.lit(getattr(group, field))
        stamped[name] = value if overwrite or name not in df.columns else F.coalesce(F.col(name), value)
    return df.withColumns(stamped)


def sample_reads(df: DataFrame, fraction: float, seed: int = 0, key: str = "template_id") -> DataFrame:
    """Keep a fraction of templates, mates together, the same ones on every run.

    The decision is a digest of the template name, so it needs no state or shuffle.
    """
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")
    return df.filter(bucket < F.lit(int(fraction * 2**28)))
