"""Every operator run over whole test tables, with its SQL counterpart where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from locusflow.catalog import oracle as sql
from locusflow.catalog import views as v
from locusflow.functions import cigar, locus, quality
from locusflow.operators import (
    duplicates, features, filters, intervals, pairs, piece_sums, pileup, pipe, recalibrate, regions, sequence, targets, variants,
)
from locusflow.plans import dna
from locusflow.session import materialize, shared_dir
from locusflow.sources import fastq, sam, sinks, tables, vcf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return keep


READ = "read_id, template_id, contig_idx, start, end_pos, mate_contig_idx, mate_start, read_len, mapq, is_reverse, is_unmapped"
READ_COLUMNS = READ.split(", ")


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return v.alignments(spark, sf).filter("is_unmapped = 0")


def covered(spark: SparkSession, sf: str) -> DataFrame:
    """Islands of the mapped reads, computed once."""
    return materialize(intervals.merge_intervals(mapped(spark, sf)))


# Filters and counters ---------------------------------------------------------------


@registered("filter_mapped", sql.with_ctes(sql.ALIGN, select=f"SELECT {READ} FROM alignments WHERE is_unmapped = 0"))
def _(spark, sf):
    return filters.filter_mapped(v.alignments(spark, sf)).select(READ_COLUMNS)


@registered(
    "filter_mapped_same_contig",
    sql.with_ctes(
        sql.ALIGN, select=f"SELECT {READ} FROM alignments WHERE is_unmapped = 0 AND contig_idx = mate_contig_idx"
    ),
)
def _(spark, sf):
    return filters.filter_mapped(v.alignments(spark, sf), keep_cross_contig=False).select(READ_COLUMNS)


@registered(
    "filter_mapped_single", sql.with_ctes(sql.ALIGN, select=f"SELECT {READ} FROM alignments WHERE is_unmapped = 0")
)
def _(spark, sf):
    return filters.filter_mapped(v.alignments(spark, sf), paired=False).select(READ_COLUMNS)


_COUNTERS = """count(*) AS reads_in, count(*) FILTER (WHERE is_unmapped = 0 AND contig_idx = mate_contig_idx) AS reads_out,
 count(*) FILTER (WHERE is_unmapped = 1) AS unmapped,
 count(*) FILTER (WHERE is_unmapped = 0 AND contig_idx <> mate_contig_idx) AS different_contig FROM alignments"""


@registered("stage_metrics", sql.with_ctes(sql.ALIGN, select=f"SELECT {_COUNTERS}"))
def _(spark, sf):
    return filters.stage_metrics(v.alignments(spark, sf), keep_cross_contig=False)


@registered(
    "stage_metrics_by_contig", sql.with_ctes(sql.ALIGN, select=f"SELECT contig_idx, {_COUNTERS} GROUP BY contig_idx")
)
def _(spark, sf):
    return filters.stage_metrics(v.alignments(spark, sf), by=["contig_idx"], keep_cross_contig=False)


@registered(
    "clean_alignments",
    sql.with_ctes(
        sql.CONTIGS, sql.ALIGN,
        select="""SELECT read_id, start + 150 AS start, least(end_pos + 150, length) AS end_pos,
 CASE WHEN is_unmapped = 1 THEN 0 ELSE mapq END AS mapq,
 CASE WHEN end_pos + 150 <= length THEN concat('3S', CAST(read_len AS VARCHAR), 'M2I')
      ELSE concat('3S', CAST(length - start - 150 + 1 AS VARCHAR), 'M', CAST(end_pos + 150 - length + 2 AS VARCHAR), 'S') END AS cigar
 FROM alignments JOIN contigs USING (contig_idx)""",
    ),
)
def _(spark, sf):
    moved = v.alignments(spark, sf).withColumns(
        {"start": F.col("start") + 150, "end_pos": F.col("end_pos") + 150, "cigar": F.expr("concat('3S', read_len, 'M2I')")}
    )
    return filters.clean_alignments(moved, v.contigs(spark, sf)).select("read_id", "start", "end_pos", "mapq", "cigar")


@registered(
    "set_read_group",
    sql.with_ctes(
        sql.ALIGN,
        select="""SELECT read_id, CASE WHEN read_id % 3 = 0 THEN 'GROUP1' ELSE library END AS rg_id, 'LIB1' AS rg_lb,
 'ILLUMINA' AS rg_pl, 'UNIT1' AS rg_pu, 'NA1' AS rg_sm FROM alignments""",
    ),
)
def _(spark, sf):
    given = v.alignments(spark, sf).withColumn("rg_id", F.when(F.col("read_id") % 3 != 0, F.col("library")))
    group = filters.ReadGroup.parse("SM:NA1")
    return filters.set_read_group(given, group, overwrite=False).select(
        "read_id", "rg_id", "rg_lb", "rg_pl", "rg_pu", "rg_sm"
    )


@registered(
    "sample_reads",
    sql.with_ctes(
        sql.ALIGN,
        select="""SELECT read_id, template_id FROM alignments
 WHERE CAST('0x' || substr(md5(concat('7-', CAST(template_id AS VARCHAR))), 1, 7) AS BIGINT) < 67108864""",
    ),
)
def _(spark, sf):
    return filters.sample_reads(v.alignments(spark, sf), 0.25, seed=7).select("read_id", "template_id")


# Intervals --------------------------------------------------------------------------


@registered(
    "merge_intervals", sql.with_ctes(sql.ALIGN, sql.MAPPED, sql.ISLANDS, select="SELECT * FROM islands")
)
def _(spark, sf):
    return intervals.merge_intervals(mapped(spark, sf))


@registered(
    "pad_and_merge", sql.with_ctes(sql.ALIGN, sql.MAPPED, sql.ISLANDS, sql.PADDED, select="SELECT * FROM padded")
)
def _(spark, sf):
    return intervals.pad_and_merge(covered(spark, sf))


@registered(
    "interval_join",
    sql.with_ctes(
        sql.ALIGN, sql.EXONS,
        select="""SELECT a.read_id, e.exon_id, least(a.end_pos, e.end_pos) - greatest(a.start, e.start) + 1 AS shared
 FROM alignments a JOIN exons e ON a.contig_idx = e.contig_idx AND a.start <= e.end_pos AND e.start <= a.end_pos
 WHERE a.is_unmapped = 0""",
    ),
)
def _(spark, sf):
    reads = mapped(spark, sf).select("read_id", "contig_idx", "start", "end_pos")
    pairs_found = intervals.interval_join(reads, v.exons(spark, sf), salt_on=["read_id"])
    shared = F.least("end_pos", "b_end_pos") - F.greatest("start", "b_start") + 1
    return pairs_found.select("read_id", F.col("b_exon_id").alias("exon_id"), shared.alias("shared"))


def _overlap_exists(negate: str) -> str:
    return sql.with_ctes(
        sql.ALIGN, sql.EXONS,
        select=f"""SELECT read_id, contig_idx, start, end_pos FROM alignments a WHERE {negate} EXISTS (
 SELECT 1 FROM exons e WHERE a.contig_idx = e.contig_idx AND a.start <= e.end_pos AND e.start <= a.end_pos)""",
    )


@registered("interval_semi_join", _overlap_exists(""))
def _(spark, sf):
    reads = v.alignments(spark, sf).select("read_id", "contig_idx", "start", "end_pos")
    return intervals.interval_semi_join(reads, v.exons(spark, sf))


@registered("interval_anti_join", _overlap_exists("NOT"))
def _(spark, sf):
    reads = v.alignments(spark, sf).select("read_id", "contig_idx", "start", "end_pos")
    return intervals.interval_anti_join(reads, v.exons(spark, sf))


@registered(
    "filter_intervals",
    sql.with_ctes(
        sql.ALIGN, sql.EXONS, sql.MAPPED, sql.ISLANDS,
        select="""SELECT e.exon_id, e.gene_id, e.contig_idx, greatest(e.start, i.start) AS start, least(e.end_pos, i.end_pos) AS end_pos
 FROM exons e JOIN islands i ON e.contig_idx = i.contig_idx AND e.start <= i.end_pos AND i.start <= e.end_pos""",
    ),
)
def _(spark, sf):
    return intervals.filter_intervals(v.exons(spark, sf), covered(spark, sf))


@registered(
    "filter_known_sites",
    sql.with_ctes(
        sql.ALIGN, sql.SITES, sql.MAPPED, sql.ISLANDS, sql.PADDED,
        select="""SELECT site_id, contig_idx, pos FROM known_sites s WHERE EXISTS (
 SELECT 1 FROM padded p WHERE p.contig_idx = s.contig_idx AND s.pos BETWEEN p.start AND p.end_pos)""",
    ),
)
def _(spark, sf):
    return intervals.filter_known_sites(v.known_sites(spark, sf), covered(spark, sf))


@registered(
    "exclude_known_sites",
    sql.with_ctes(
        sql.VARIANTS, sql.SITES,
        select="""SELECT variant_id, contig_idx, pos FROM variants x WHERE NOT EXISTS (
 SELECT 1 FROM known_sites s WHERE s.contig_idx = x.contig_idx AND s.pos = x.pos)""",
    ),
)
def _(spark, sf):
    sites = intervals.merge_intervals(
        v.known_sites(spark, sf).select("contig_idx", F.col("pos").alias("start"), F.col("pos").alias("end_pos")), gap=0
    )
    found = v.variants(spark, sf).select("variant_id", "contig_idx", "pos")
    return intervals.point_join(found, sites, "left_anti")


# Regions ----------------------------------------------------------------------------

_UNIFORM = """asked AS (SELECT step, greatest(1, CAST(floor(total / ({n} * pow(0.95, step))) AS BIGINT)) AS target
  FROM (SELECT sum(length)::BIGINT AS total FROM {source}) t, (SELECT unnest(range(0, {steps})) AS step) r),
short AS (SELECT step, target, contig_idx, length, row_number() OVER (PARTITION BY step ORDER BY contig_idx) AS i,
    coalesce(sum(length) OVER (PARTITION BY step ORDER BY contig_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM {source}, asked WHERE length < target),
walk AS (SELECT step, i AS first, before AS at, 0 AS key FROM short WHERE i = 1
  UNION ALL SELECT w.step, min(s.i), min(s.before)::BIGINT, w.key + 1 FROM walk w JOIN short s ON s.step = w.step AND s.i > w.first AND s.before - w.at > s.target / 5.0
  GROUP BY w.step, w.key),
packs AS (SELECT s.step, s.contig_idx, s.length, w.key FROM short s ASOF JOIN walk w ON s.step = w.step AND s.i >= w.first),
long_ones AS (SELECT step, contig_idx, length, (length + target - 1) // target AS k FROM {source}, asked WHERE length >= target),
counted AS (SELECT step, coalesce((SELECT max(key) + 1 FROM packs p WHERE p.step = a.step), 0) AS packed,
    coalesce((SELECT sum(k) FROM long_ones l WHERE l.step = a.step), 0)::BIGINT AS cut FROM asked a),
chosen AS (SELECT step, packed FROM counted WHERE {fits} ORDER BY step LIMIT 1),
regions AS (SELECT key AS region_key, contig_idx, 1 AS start, length AS end_pos FROM packs JOIN chosen USING (step)
  UNION ALL SELECT first_key + piece, contig_idx, 1 + piece * (length // k + 1), least((piece + 1) * (length // k + 1), length)
  FROM (SELECT *, unnest(range(0, k)) AS piece FROM (SELECT contig_idx, length, k,
    packed + coalesce(sum(k) OVER (ORDER BY contig_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_key
    FROM long_ones JOIN chosen USING (step)) l) c),
plan AS (SELECT * FROM regions WHERE start <= end_pos)"""


def _uniform(n: int, source: str = "contigs") -> str:
    return _UNIFORM.format(n=n, source=source, steps=1, fits="true")


def _uniform_retry(n: int, source: str) -> str:
    return _UNIFORM.format(n=n, source=source, steps=200, fits=f"packed + cut <= {n}")


@registered(
    "plan_regions_uniform",
    sql.with_ctes(sql.CONTIGS, sql.DICTIONARY, _uniform(40, "dictionary"), select="SELECT * FROM plan"),
)
def _(spark, sf):
    return regions.plan_regions_uniform(v.dictionary(spark, sf), 40)


@registered(
    "plan_regions_uniform_retry",
    sql.with_ctes(sql.CONTIGS, sql.DICTIONARY, _uniform_retry(40, "dictionary"), select="SELECT * FROM plan"),
)
def _(spark, sf):
    return regions.plan_regions_uniform(v.dictionary(spark, sf), 40, retry=True)


@registered(
    "plan_regions_by_genes",
    sql.with_ctes(
        sql.CONTIGS, sql.EXONS, sql.islands("exons", "clusters", 299),
        """target AS (SELECT sum(length)::BIGINT // 60 AS t FROM contigs),
walk AS (SELECT contig_idx, 1::BIGINT AS start, 0::BIGINT AS seen FROM contigs
  UNION ALL SELECT contig_idx, last + (next - last) // 2 + 1, last FROM (
    SELECT w.contig_idx, min(c.end_pos) AS last, (SELECT min(n.start) FROM clusters n WHERE n.contig_idx = w.contig_idx AND n.start > min(c.end_pos)) AS next
    FROM walk w, target JOIN clusters c ON c.contig_idx = w.contig_idx AND c.end_pos > w.seen AND c.end_pos - w.start + 1 >= t
    GROUP BY w.contig_idx) x WHERE next IS NOT NULL)""",
        select="""SELECT row_number() OVER (ORDER BY s.contig_idx, start) - 1 AS region_key, s.contig_idx, start,
 coalesce(lead(start) OVER (PARTITION BY s.contig_idx ORDER BY start) - 1, length) AS end_pos
 FROM walk s JOIN contigs c ON s.contig_idx = c.contig_idx""",
    ),
)
def _(spark, sf):
    return regions.plan_regions_by_genes(v.contigs(spark, sf), v.exons(spark, sf), 60, min_gap=300)


_BINS = """bins AS (SELECT contig_idx, (start - 1) // 5000 * 5000 + 1 AS start, ((start - 1) // 5000 + 1) * 5000 AS end_pos,
  count(*) AS reads FROM mapped GROUP BY contig_idx, (start - 1) // 5000)"""


@registered("bin_reads", sql.with_ctes(sql.ALIGN, sql.MAPPED, _BINS, select="SELECT * FROM bins"))
def _(spark, sf):
    return regions.bin_reads(mapped(spark, sf), 5000)


@registered(
    "plan_regions_by_load",
    sql.with_ctes(
        sql.CONTIGS, sql.ALIGN, sql.MAPPED, _BINS,
        """every AS (SELECT contig_idx, start, reads FROM bins UNION ALL SELECT contig_idx, 1, 0 FROM contigs WHERE contig_idx NOT IN (SELECT contig_idx FROM bins)),
numbered AS (SELECT *, row_number() OVER (ORDER BY contig_idx, start) AS i, (SELECT sum(reads)::BIGINT // 30 FROM bins) AS target FROM every),
walk AS (SELECT i, 0 AS key, reads AS load FROM numbered WHERE i = 1
  UNION ALL SELECT n.i, CASE WHEN w.load + n.reads > target THEN w.key + 1 ELSE w.key END, CASE WHEN w.load + n.reads > target THEN n.reads ELSE w.load + n.reads END
  FROM walk w JOIN numbered n ON n.i = w.i + 1),
cut AS (SELECT key, contig_idx, min(start) AS start, sum(reads)::BIGINT AS reads FROM numbered JOIN walk USING (i) GROUP BY key, contig_idx)""",
        select="""SELECT key AS region_key, contig_idx, CASE WHEN row_number() OVER w = 1 THEN 1 ELSE start END AS start,
 coalesce(lead(start) OVER w - 1, length) AS end_pos, reads FROM cut JOIN contigs USING (contig_idx) WINDOW w AS (PARTITION BY contig_idx ORDER BY key)""",
    ),
)
def _(spark, sf):
    bins = regions.bin_reads(mapped(spark, sf), 5000)
    return regions.plan_regions_by_load(bins, v.contigs(spark, sf), 30, scan_rows=100_000)


@registered(
    "rank_regions_by_load",
    sql.with_ctes(
        sql.CONTIGS, sql.ALIGN, sql.MAPPED, _BINS, _uniform(40),
        """loads AS (SELECT r.region_key, coalesce(sum(b.reads), 0)::BIGINT AS load FROM plan r LEFT JOIN bins b
  ON r.contig_idx = b.contig_idx AND b.start <= r.end_pos AND r.start <= b.end_pos GROUP BY r.region_key),
ranked AS (SELECT *, row_number() OVER (ORDER BY load DESC, region_key) - 1 AS rank FROM loads)""",
        select="SELECT p.region_key, contig_idx, start, end_pos, load, rank FROM plan p JOIN ranked USING (region_key)",
    ),
)
def _(spark, sf):
    plan = regions.plan_regions_uniform(v.contigs(spark, sf), 40)
    return regions.rank_regions_by_load(plan, regions.bin_reads(mapped(spark, sf), 5000))


def _assigned(paired: bool) -> str:
    mate = """ UNION SELECT read_id, a.contig_idx, a.start, a.end_pos, r2.region_key FROM placed a JOIN plan r2 ON a.mate_contig_idx = r2.contig_idx AND a.mate_start BETWEEN r2.start2 AND r2.end2
  UNION SELECT read_id, a.contig_idx, a.start, a.end_pos, r2.region_key FROM placed a JOIN plan r2 ON a.mate_contig_idx = r2.contig_idx AND a.mate_start + a.read_len BETWEEN r2.start2 AND r2.end2"""
    return f"""placed AS (SELECT read_id, contig_idx, start, end_pos, mate_contig_idx, mate_start, read_len FROM alignments WHERE is_unmapped = 0),
hits AS (
  SELECT read_id, a.contig_idx, a.start, a.end_pos, r2.region_key FROM placed a JOIN plan r2 ON a.contig_idx = r2.contig_idx AND a.start BETWEEN r2.start2 AND r2.end2
  UNION SELECT read_id, a.contig_idx, a.start, a.end_pos, r2.region_key FROM placed a JOIN plan r2 ON a.contig_idx = r2.contig_idx AND a.end_pos BETWEEN r2.start2 AND r2.end2
  {mate if paired else ''}),
assigned AS (
  SELECT h.read_id, h.contig_idx, h.start, h.region_key, CASE WHEN o.region_key = h.region_key THEN 1 ELSE 0 END AS is_owner
  FROM hits h JOIN plan o ON h.contig_idx = o.contig_idx AND h.start BETWEEN o.start2 AND o.end2)"""


_PLAN = _uniform(40).replace(
    "plan AS (SELECT * FROM regions WHERE start <= end_pos)",
    "plan AS (SELECT region_key, contig_idx, start AS start2, end_pos AS end2 FROM regions WHERE start <= end_pos)",
)


def _assign(spark, sf, paired):
    plan = regions.plan_regions_uniform(v.contigs(spark, sf), 40)
    return regions.assign_regions(mapped(spark, sf), plan, paired)


@registered(
    "assign_regions",
    sql.with_ctes(sql.CONTIGS, sql.ALIGN, _PLAN, _assigned(True), select="SELECT read_id, region_key, is_owner FROM assigned"),
)
def _(spark, sf):
    return _assign(spark, sf, True).select("read_id", "region_key", "is_owner")


@registered(
    "assign_regions_single",
    sql.with_ctes(sql.CONTIGS, sql.ALIGN, _PLAN, _assigned(False), select="SELECT read_id, region_key, is_owner FROM assigned"),
)
def _(spark, sf):
    return _assign(spark, sf, False).select("read_id", "region_key", "is_owner")


@registered(
    "count_reads_by_region",
    sql.with_ctes(
        sql.CONTIGS, sql.ALIGN, _PLAN, _assigned(True),
        """per_key AS (SELECT region_key, count(*) AS reads, max(contig_idx * 10000000000 + start) AS last FROM assigned GROUP BY region_key)""",
        select="""SELECT region_key, reads, concat(contig, '-', CAST(region_key AS VARCHAR), '-', CAST(last % 10000000000 AS VARCHAR)) AS label
 FROM per_key JOIN contigs ON contig_idx = last // 10000000000""",
    ),
)
def _(spark, sf):
    return regions.count_reads_by_region(_assign(spark, sf, True), v.contigs(spark, sf))


@registered(
    "region_sort",
    sql.with_ctes(sql.CONTIGS, sql.ALIGN, _PLAN, _assigned(True), select="SELECT region_key, contig_idx, start, read_id FROM assigned"),
)
def _(spark, sf):
    return regions.region_sort(_assign(spark, sf, True)).select("region_key", "contig_idx", "start", "read_id")


def _out_of_order(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Rows of each ``by`` value, and how many of them come after a greater row, as the partitions hold them."""
    held = materialize(df.select(*order, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    key = F.struct(*order)
    own = Window.partitionBy("part").orderBy("at")
    inside = held.withColumn("late", (key < F.lag(key).over(own)).cast("int"))
    ends = held.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    between = ends.withColumn("late", (F.col("low") < F.max("high").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).cast("int"))
    rows = inside.select(by, "late", F.lit(1).alias("n")).unionByName(between.select(F.col(f"low.{by}").alias(by), "late", F.lit(0).alias("n")))
    return rows.groupBy(by).agg(F.sum("n").alias("n"), F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"))


@registered(
    "region_sort_order",
    sql.with_ctes(sql.CONTIGS, sql.ALIGN, _PLAN, _assigned(True), select="SELECT region_key, count(*) AS n, 0 AS out_of_order FROM assigned GROUP BY region_key"),
)
def _(spark, sf):
    return _out_of_order(regions.region_sort(_assign(spark, sf, True)), "region_key", ["region_key", "contig_idx", "start", "read_id"])


@registered(
    "merge_sorted_order", sql.with_ctes(sql.ALIGN, select="SELECT contig_idx, count(*) AS n, 0 AS out_of_order FROM alignments WHERE is_unmapped = 0 GROUP BY contig_idx")
)
def _(spark, sf):
    return _out_of_order(regions.merge_sorted(mapped(spark, sf)), "contig_idx", ["contig_idx", "start", "read_id"])


@registered(
    "merge_sorted",
    sql.with_ctes(
        sql.ALIGN,
        select="SELECT read_id, contig_idx, start, 'GROUP1' AS rg_id, 'LIB1' AS rg_lb, 'SAMPLE1' AS rg_sm FROM alignments WHERE is_unmapped = 0",
    ),
)
def _(spark, sf):
    return filters.set_read_group(regions.merge_sorted(mapped(spark, sf))).select(
        "read_id", "contig_idx", "start", "rg_id", "rg_lb", "rg_sm"
    )


# Features, counts and junctions -----------------------------------------------------

_HITS = """hits AS (SELECT DISTINCT a.template_id, e.exon_id FROM mapped a JOIN exons e
  ON a.contig_idx = e.contig_idx AND a.start <= e.end_pos AND e.start <= a.end_pos)"""


@registered(
    "count_features",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED, sql.EXONS, _HITS,
        "lone AS (SELECT template_id, min(exon_id) AS exon_id FROM hits GROUP BY template_id HAVING count(*) = 1)",
        select="SELECT e.*, (SELECT count(*) FROM lone l WHERE l.exon_id = e.exon_id) AS n FROM exons e",
    ),
)
def _(spark, sf):
    return features.count_features(v.alignments(spark, sf), v.exons(spark, sf))


@registered(
    "count_features_ambiguous",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED, sql.EXONS, _HITS,
        select="SELECT e.*, (SELECT count(*) FROM hits h WHERE h.exon_id = e.exon_id) AS n FROM exons e",
    ),
)
def _(spark, sf):
    return features.count_features(v.alignments(spark, sf), v.exons(spark, sf), ambiguous="count")


@registered(
    "count_features_multi",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED, sql.EXONS, _HITS,
        "elsewhere AS (SELECT DISTINCT template_id FROM alignments WHERE read_id % 23 = 0 OR read_id % 17 = 0)",
        """lone AS (SELECT template_id, min(exon_id) AS exon_id FROM hits WHERE template_id NOT IN (SELECT template_id FROM elsewhere)
  GROUP BY template_id HAVING count(*) = 1)""",
        select="SELECT e.*, (SELECT count(*) FROM lone l WHERE l.exon_id = e.exon_id) AS n FROM exons e",
    ),
)
def _(spark, sf):
    reads = v.alignments(spark, sf).withColumns(
        {"flag": F.when(F.col("read_id") % 23 == 0, 0x100).otherwise(0), "nh": F.when(F.col("read_id") % 17 == 0, 3).otherwise(1)}
    )
    return features.count_features(reads, v.exons(spark, sf))


def _count_lines(spark, sf):
    """Count files of three shards with their comment and column-name lines."""
    rows = v.exons(spark, sf).withColumn("shard", F.expr("explode(sequence(0L, 2L))"))
    fields = ["gene_id", "contig_idx", "start", "end_pos", "'+'", "end_pos - start + 1", "(exon_id * 31 + shard * 17) % 101"]
    text = F.expr(f"concat_ws('\t', {', '.join(fields)})")
    noise = F.when(F.col("exon_id") % 100 == 0, "Geneid\tChr\tStart\tEnd\tStrand\tLength\tsample.bam").otherwise(text)
    return rows.select(noise.alias("value"))


@registered(
    "combine_counts",
    sql.with_ctes(
        sql.EXONS,
        select="""SELECT CAST(gene_id AS VARCHAR) AS gene_id, CAST(contig_idx AS VARCHAR) AS contig, start, end_pos, '+' AS strand,
 max((exon_id * 31 + shard * 17) % 101) AS n FROM exons, (SELECT unnest(range(0, 3)) AS shard) s WHERE exon_id % 100 <> 0
 GROUP BY gene_id, contig_idx, start, end_pos""",
    ),
)
def _(spark, sf):
    return features.combine_counts(features.parse_count_lines(_count_lines(spark, sf)))


_JUNCTION_LINE = """'chr' || CAST(l_suppkey % 5 AS VARCHAR) AS contig, 1000 + l_partkey % 200 * 50 AS start,
 1500 + l_partkey % 200 * 50 + l_linenumber % 3 * 20 AS end_pos, 1 + l_linenumber % 2 AS strand"""


def _junction_lines(spark, sf):
    fields = [
        "concat('chr', l_suppkey % 5)", "1000 + l_partkey % 200 * 50", "1500 + l_partkey % 200 * 50 + l_linenumber % 3 * 20",
        "1 + l_linenumber % 2", "l_partkey % 7", "l_partkey % 2", "l_orderkey % 11", "l_orderkey % 4", "10 + bigint(l_quantity)",
    ]
    text = f"if(l_partkey % 50 = 0, 'not a junction', concat_ws('\t', {', '.join(fields)}))"
    return v.text_lines(v.table(spark, sf, "lineitem"), text)


@registered(
    "collect_junctions",
    f"""SELECT contig, start, end_pos, strand, max(motif) AS motif, max(annotated) AS annotated, sum(u)::BIGINT AS n_unique,
 sum(m)::BIGINT AS n_multi, max(overhang) AS max_overhang FROM (
 SELECT {_JUNCTION_LINE}, l_partkey % 7 AS motif, l_partkey % 2 AS annotated, l_orderkey % 11 AS u, l_orderkey % 4 AS m,
 10 + CAST(l_quantity AS BIGINT) AS overhang FROM lineitem WHERE l_partkey % 50 <> 0) GROUP BY contig, start, end_pos, strand""",
)
def _(spark, sf):
    return features.collect_junctions(tables.parse_junction_lines(_junction_lines(spark, sf)))


@registered("junction_overhang", sql.with_ctes(sql.ALIGN, select="SELECT max(read_len) - 1 AS overhang FROM alignments"))
def _(spark, sf):
    return features.junction_overhang(v.alignments(spark, sf))


# Variants ---------------------------------------------------------------------------

_VARIANT_COLUMNS = ["variant_id", "shard", "contig_idx", "pos", "qual"]


@registered(
    "combine_variants",
    sql.with_ctes(
        sql.VARIANTS,
        select="""SELECT variant_id, shard, contig_idx, pos, qual FROM (SELECT *, row_number() OVER (PARTITION BY contig_idx, pos
 ORDER BY qual DESC, shard, variant_id) AS rn FROM variants) t WHERE rn = 1""",
    ),
)
def _(spark, sf):
    return variants.combine_variants(v.variants(spark, sf).select(_VARIANT_COLUMNS))


@registered(
    "combine_variants_all", sql.with_ctes(sql.VARIANTS, select="SELECT variant_id, shard, contig_idx, pos, qual FROM variants")
)
def _(spark, sf):
    return variants.combine_variants(v.variants(spark, sf).select(_VARIANT_COLUMNS), report_all=True)


@registered(
    "union_sites",
    sql.with_ctes(
        sql.VARIANTS,
        select="""SELECT contig_idx, pos, ref, alt, string_agg(CAST(shard AS VARCHAR), ',' ORDER BY shard) AS sources FROM (
 SELECT DISTINCT contig_idx, pos, ref, alt, shard FROM variants) t GROUP BY contig_idx, pos, ref, alt""",
    ),
)
def _(spark, sf):
    rows = v.variants(spark, sf)
    shards = [rows.filter(F.col("shard") == i) for i in range(7)]
    return variants.union_sites(shards).withColumn("sources", F.array_join("sources", ","))


@registered(
    "filter_variants",
    sql.with_ctes(
        sql.VARIANTS,
        """placed AS (SELECT *, row_number() OVER (PARTITION BY contig_idx ORDER BY pos, variant_id) AS rn FROM variants),
runs AS (SELECT a.contig_idx, a.pos AS first_pos, b.pos AS last_pos FROM placed a JOIN placed b
  ON a.contig_idx = b.contig_idx AND b.rn = a.rn + 2 AND b.pos - a.pos <= 35),
inside AS (SELECT DISTINCT x.variant_id FROM variants x JOIN runs r ON x.contig_idx = r.contig_idx AND x.pos BETWEEN r.first_pos AND r.last_pos)""",
        select="""SELECT variant_id, contig_idx, pos, CASE WHEN label = '' THEN 'PASS' ELSE label END AS filter FROM (
 SELECT v.variant_id, v.contig_idx, v.pos, concat_ws(';', CASE WHEN fs > 30 THEN 'FS' END, CASE WHEN qd < 2 THEN 'QD' END,
 CASE WHEN i.variant_id IS NOT NULL THEN 'SnpCluster' END) AS label FROM variants v LEFT JOIN inside i ON v.variant_id = i.variant_id) t""",
    ),
)
def _(spark, sf):
    return variants.filter_variants(v.variants(spark, sf)).select("variant_id", "contig_idx", "pos", "filter")


@registered(
    "call_threshold",
    sql.with_ctes(
        sql.VARIANTS,
        select="""SELECT variant_id, qual, CASE WHEN qual < 200000 THEN 'LowQual' ELSE 'PASS' END AS filter
 FROM variants WHERE qual >= 100000""",
    ),
)
def _(spark, sf):
    found = variants.call_threshold(v.variants(spark, sf), call_conf=200_000, emit_conf=100_000)
    return found.select("variant_id", "qual", "filter")


@registered(
    "annotate_variants",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED, sql.VARIANTS, sql.SITES,
        "ids AS (SELECT contig_idx, pos, min(site_id) AS site_id FROM known_sites GROUP BY contig_idx, pos)",
        """loci AS (SELECT DISTINCT contig_idx, pos FROM variants),
depths AS (SELECT l.contig_idx, l.pos, count(*) AS depth FROM loci l JOIN mapped a
  ON a.contig_idx = l.contig_idx AND l.pos BETWEEN a.start AND a.end_pos GROUP BY l.contig_idx, l.pos)""",
        select="""SELECT v.variant_id, v.contig_idx, v.pos, i.site_id, coalesce(d.depth, 0) AS depth FROM variants v
 LEFT JOIN ids i ON v.contig_idx = i.contig_idx AND v.pos = i.pos LEFT JOIN depths d ON v.contig_idx = d.contig_idx AND v.pos = d.pos""",
    ),
)
def _(spark, sf):
    found = v.variants(spark, sf).select("variant_id", "contig_idx", "pos")
    depth = pileup.depth(mapped(spark, sf), only=found)
    return variants.annotate_variants(found, v.known_sites(spark, sf), depth)


# Locus text -------------------------------------------------------------------------


@registered(
    "to_locus_key",
    sql.with_ctes(sql.VARIANTS, select="SELECT variant_id, contig_idx * 4294967296 + pos - 1 AS locus_key FROM variants"),
)
def _(spark, sf):
    return v.variants(spark, sf).select("variant_id", locus.to_locus_key().alias("locus_key"))


@registered(
    "region_text",
    sql.with_ctes(
        sql.CONTIGS, sql.ALIGN, sql.MAPPED, sql.ISLANDS,
        select="""SELECT concat(contig, ':', CAST(start AS VARCHAR), '-', CAST(end_pos AS VARCHAR)) AS picard,
 concat(contig, chr(9), CAST(start - 1 AS VARCHAR), chr(9), CAST(end_pos AS VARCHAR)) AS bed
 FROM islands JOIN contigs USING (contig_idx)""",
    ),
)
def _(spark, sf):
    named = intervals.merge_intervals(mapped(spark, sf)).join(v.contigs(spark, sf), "contig_idx")
    return named.select(locus.picard_region().alias("picard"), locus.bed_region().alias("bed"))


# Duplicates -------------------------------------------------------------------------

_RECORDS = sql.with_ctes(sql.ALIGN, sql.records(10), select="")


@registered("mark_duplicates", _RECORDS + "SELECT read_id, template_id, is_duplicate FROM marked")
def _(spark, sf):
    return duplicates.mark_duplicates(v.read_records(spark, sf, 10)).select("read_id", "template_id", "is_duplicate")


@registered("remove_duplicates", _RECORDS + "SELECT read_id, template_id FROM marked WHERE is_duplicate = 0")
def _(spark, sf):
    marked = duplicates.mark_duplicates(v.read_records(spark, sf, 10))
    return filters.remove_duplicates(marked).select("read_id", "template_id")


@registered(
    "duplicate_metrics",
    _RECORDS
    + """SELECT library, count(*) FILTER (WHERE is_pair) AS pairs_examined, count(*) FILTER (WHERE NOT is_pair) AS singles_examined,
 count(*) FILTER (WHERE is_pair AND is_duplicate) AS pair_duplicates, count(*) FILTER (WHERE NOT is_pair AND is_duplicate) AS single_duplicates,
 round((2 * count(*) FILTER (WHERE is_pair AND is_duplicate) + count(*) FILTER (WHERE NOT is_pair AND is_duplicate)) * 100.0::DOUBLE
   / (2 * count(*) FILTER (WHERE is_pair) + count(*) FILTER (WHERE NOT is_pair)), 6) AS percent_duplication
 FROM decided GROUP BY library""",
)
def _(spark, sf):
    return duplicates.duplicate_metrics(v.read_records(spark, sf, 10))


# Pileup, calling and recalibration --------------------------------------------------


@registered(
    "pileup",
    sql.with_ctes(
        sql.ALIGN, sql.bases(),
        select="""SELECT contig_idx, pos, min(ref_base) AS ref_base, count(*) AS depth, count(*) FILTER (WHERE base = 'A') AS n_a,
 count(*) FILTER (WHERE base = 'C') AS n_c, count(*) FILTER (WHERE base = 'G') AS n_g, count(*) FILTER (WHERE base = 'T') AS n_t
 FROM bases GROUP BY contig_idx, pos""",
    ),
)
def _(spark, sf):
    return pileup.pileup(v.bases(spark, sf))


@registered(
    "depth",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED,
        select="""SELECT contig_idx, pos, count(*) AS depth FROM (
 SELECT contig_idx, unnest(range(start, end_pos + 1)) AS pos FROM mapped) t GROUP BY contig_idx, pos""",
    ),
)
def _(spark, sf):
    return pileup.depth(mapped(spark, sf))


#: Every read as two halves around an intron of 300 bases.
_HALVES = """halves AS (SELECT read_id, template_id, contig_idx, start, start + read_len // 2 - 1 AS end_pos FROM mapped
  UNION ALL SELECT read_id, template_id, contig_idx, start + read_len // 2 + 300, start + read_len + 299 FROM mapped)"""


def _spliced(spark, sf):
    text = "concat(read_len div 2, 'M300N', read_len - read_len div 2, 'M')"
    return mapped(spark, sf).withColumns({"cigar": F.expr(text), "end_pos": F.expr("start + read_len + 299")})


@registered(
    "depth_spliced",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED, _HALVES,
        select="SELECT contig_idx, pos, count(*) AS depth FROM (SELECT contig_idx, unnest(range(start, end_pos + 1)) AS pos FROM halves) t GROUP BY contig_idx, pos",
    ),
)
def _(spark, sf):
    return pileup.depth(_spliced(spark, sf))


@registered(
    "count_features_spliced",
    sql.with_ctes(
        sql.ALIGN, sql.EXONS, sql.MAPPED, _HALVES,
        """hits AS (SELECT h.template_id, min(e.exon_id) AS exon_id FROM halves h JOIN exons e
  ON h.contig_idx = e.contig_idx AND h.start <= e.end_pos AND e.start <= h.end_pos GROUP BY h.template_id HAVING count(DISTINCT e.exon_id) = 1)""",
        select="SELECT e.exon_id, count(h.template_id) AS n FROM exons e LEFT JOIN hits h USING (exon_id) GROUP BY e.exon_id",
    ),
)
def _(spark, sf):
    return features.count_features(_spliced(spark, sf), v.exons(spark, sf)).select("exon_id", "n")


def _call_sql(call_conf: float, emit_conf: float) -> str:
    return sql.with_ctes(
        sql.ALIGN, sql.bases("is_unmapped = 0 AND mapq >= 20"),
        "strong AS (SELECT * FROM bases WHERE qual >= 17)", sql.calls("strong", call_conf, emit_conf),
        select="SELECT contig_idx, pos, ref, alt, qual, gt, depth, alt_count, filter FROM called",
    )


def call_snps_from_reads(spark: SparkSession, sf: str, call_conf: float = 30, emit_conf: float = 30) -> DataFrame:
    """Reads filtered, exploded to bases, piled up and called."""
    reads = filters.filter_mapped(v.alignments(spark, sf).filter("mapq >= 20"))
    columns = ["read_id", "contig_idx", "start", "end_pos", "read_len", "mapq"]
    return pileup.call_snps(v.with_bases(pileup.explode_positions(reads.select(columns))), call_conf, emit_conf)


@registered("call_snps", _call_sql(30, 30))
def _(spark, sf):
    return call_snps_from_reads(spark, sf)


@registered("call_snps_low_confidence", _call_sql(20, 10))
def _(spark, sf):
    return call_snps_from_reads(spark, sf, 20, 10)


_BASES_AND_COVARIATES = (sql.ALIGN, sql.SITES, sql.bases(), sql.COVARIATES)


def _recalibration(spark, sf):
    """Observations of whole pieces of reads, which never become base rows."""
    reads = v.with_read_text(v.spread_small(mapped(spark, sf), "read_id")).withColumn("cigar", F.expr("concat(read_len, 'M')"))
    cells = materialize(v.reference_cells(spark, sf, pileup.PILEUP_BIN, varied=False))
    pieces = sequence.read_pieces(reads, cells, exclude=v.known_sites(spark, sf), keep=("library", "contig_idx", "is_reverse"))
    return recalibrate.recalibration_table_of_pieces(pieces)


@registered("recalibration_table", sql.with_ctes(*_BASES_AND_COVARIATES, select="SELECT * FROM recal"))
def _(spark, sf):
    return _recalibration(spark, sf)


def _quality_sums(reads: DataFrame) -> DataFrame:
    """Bases of each read, the sum of their qualities, and that weighted by place."""
    rows = reads.select("read_id", F.posexplode(F.split("qual", "")).alias("off", "c"))
    q = F.ascii("c") - quality.TEXT_OFFSET
    return rows.groupBy("read_id").agg(F.count(F.lit(1)).alias("n"), F.sum(q).alias("total"), F.sum(q * (F.col("off") + 1)).alias("weighted"))


@registered(
    "apply_recalibration",
    sql.with_ctes(
        *_BASES_AND_COVARIATES, sql.RECALIBRATED,
        select="""SELECT read_id, count(*) AS n, sum(new_qual)::BIGINT AS total, sum(new_qual * (off + 1))::BIGINT AS weighted
 FROM fresh GROUP BY read_id""",
    ),
)
def _(spark, sf):
    reads = v.with_read_text(v.spread_small(mapped(spark, sf), "read_id"))
    fresh = recalibrate.recalibrate_reads(reads.select("read_id", "library", "is_reverse", "seq", "qual"), _recalibration(spark, sf))
    return _quality_sums(fresh)


@registered(
    "apply_recalibration_to_bases",
    sql.with_ctes(
        *_BASES_AND_COVARIATES, sql.RECALIBRATED,
        select="""SELECT read_id, count(*) AS n, sum(new_qual)::BIGINT AS total, sum(new_qual * (off + 1))::BIGINT AS weighted
 FROM fresh GROUP BY read_id""",
    ),
)
def _(spark, sf):
    table = materialize(_recalibration(spark, sf))
    rows = v.with_previous_base(v.bases(spark, sf, cluster=False))
    fresh = recalibrate.apply_recalibration(rows, table)
    return fresh.groupBy("read_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("new_qual").alias("total"),
        F.sum(F.col("new_qual") * (F.col("off") + 1)).alias("weighted"),
    )


_RECORD_BASES = f"""unique_reads AS (SELECT * FROM marked WHERE is_unmapped = 0 AND is_duplicate = 0),
offsets AS (SELECT *, unnest(range(lead_clip, lead_clip + read_len - clip)) AS off FROM unique_reads),
bases AS (
  SELECT *, start - lead_clip + off AS pos, 2 + (read_id + off * 7) % 39 AS qual,
         {sql.varied_letter("start - lead_clip + off")} AS ref_base,
         {sql.varied_letter("start - lead_clip + off", step=sql.step("start - lead_clip + off", "off"))} AS base,
         {sql.varied_letter("start - lead_clip + off - 1", step=sql.step("start - lead_clip + off - 1", "off - 1"))} AS last_base,
         {sql.varied_letter("start - lead_clip + off + 1", step=sql.step("start - lead_clip + off + 1", "off + 1"))} AS next_base
  FROM offsets),
obs AS (
  SELECT library AS rg, qual, contig_idx, pos, base, ref_base, read_id, off, mapq,
         CASE WHEN is_reverse = 1 THEN read_len - off ELSE off + 1 END AS cycle,
         CASE WHEN is_reverse = 1 AND off < read_len - 1 THEN translate(concat(next_base, base), 'ACGT', 'TGCA')
              WHEN is_reverse = 0 AND off > 0 THEN concat(last_base, base) END AS context
  FROM bases),
recal AS (
  SELECT rg, qual, cycle, context, count(*) AS observations, count(*) FILTER (WHERE base <> ref_base) AS mismatches
  FROM obs WHERE (contig_idx, pos) NOT IN (SELECT (contig_idx, pos) FROM known_sites) GROUP BY ALL)"""


@registered(
    "run_dna",
    sql.with_ctes(
        sql.ALIGN, sql.SITES, sql.records(4000), _RECORD_BASES.replace("NOT IN (SELECT (contig_idx, pos) FROM known_sites)", "NOT IN (SELECT (contig_idx, pos) FROM known_sites) AND pos % 211 <> 0"), sql.RECALIBRATED,
        "strong AS (SELECT * FROM fresh WHERE new_qual >= 10 AND mapq >= 20)", sql.calls("strong", 30, 30, "new_qual"),
        select="SELECT contig_idx, pos, ref, alt, qual, gt, depth, alt_count, filter FROM called",
    ),
)
def _(spark, sf):
    reads = v.with_sequence(v.read_records(spark, sf, 4000))
    cells = materialize(v.reference_cells(spark, sf, pileup.PILEUP_BIN))
    planted = v.contigs(spark, sf).selectExpr("contig_idx", "explode(sequence(211L, length, 211L)) AS pos")
    sites = v.known_sites(spark, sf).select("contig_idx", "pos").unionByName(planted)
    return dna.run_dna(reads, cells, sites, min_base_quality=10).variants


_FRAGMENTS = """best AS (
  SELECT template_id, contig_idx, pos, ref_base, arg_max(base, qual) AS base, max(qual) AS qual, min(base) = max(base) AS agree,
         CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS merged FROM bases GROUP BY template_id, contig_idx, pos, ref_base)"""


def _mates(spark, sf):
    """Pieces of mates, half of which overlap: every second template has its mates at one place."""
    reads = v.with_sequence(v.read_records(spark, sf, 4000)).filter("is_unmapped = 0")
    cells = materialize(v.reference_cells(spark, sf, pileup.PILEUP_BIN))
    keep = ("read_id", "template_id", "library", "contig_idx", "is_reverse", "mapq", "touching")
    return piece_sums.merge_pieces(sequence.read_pieces(pileup.mark_touching(reads), cells, keep=keep))


@registered(
    "pileup_fragments",
    sql.with_ctes(
        sql.ALIGN, sql.records(4000), _RECORD_BASES.split(",\nobs AS")[0].replace(" AND is_duplicate = 0", ""), _FRAGMENTS,
        select="""SELECT contig_idx, pos, ref_base, count(*) AS depth, count(*) FILTER (WHERE base = 'A') AS n_a, count(*) FILTER (WHERE base = 'C') AS n_c,
 count(*) FILTER (WHERE base = 'G') AS n_g, count(*) FILTER (WHERE base = 'T') AS n_t FROM best WHERE agree GROUP BY contig_idx, pos, ref_base""",
    ),
)
def _(spark, sf):
    return piece_sums.locus_sums(_mates(spark, sf), likelihoods=False, masked=True)


@registered(
    "call_snps_fragments",
    sql.with_ctes(
        sql.ALIGN, sql.records(4000), _RECORD_BASES.split(",\nobs AS")[0].replace(" AND is_duplicate = 0", ""), _FRAGMENTS,
        "strong AS (SELECT * FROM best WHERE agree AND qual >= 10)", sql.calls("strong", 30, 30),
        select="SELECT contig_idx, pos, ref, alt, qual, gt, depth, alt_count, filter FROM called",
    ),
)
def _(spark, sf):
    return pileup.call_snps_of_pieces(_mates(spark, sf), min_base_quality=10, min_mapq=0, masked=True)


@registered(
    "split_n_reads",
    sql.with_ctes(
        sql.ALIGN,
        """parts AS (SELECT read_id, start, is_unmapped, CASE WHEN mapq % 2 = 0 THEN 60 ELSE mapq END AS mapq, 20 + mate_no AS m1,
  100 + read_id % 50 AS n1, 200 + read_id % 9 AS n2, 5 + read_id % 20 AS m3 FROM alignments)""",
        select="""SELECT read_id, 0 AS segment, start, start + m1 - 1 AS end_pos, concat(CAST(m1 AS VARCHAR), 'M') AS cigar, mapq FROM parts
 UNION ALL SELECT read_id, 1, start + m1 + n1, start + m1 + n1 + 24, '15M1I10M', mapq FROM parts
 UNION ALL SELECT read_id, 2, start + m1 + n1 + 25 + n2, start + m1 + n1 + 25 + n2 + m3 - 1, concat(CAST(m3 AS VARCHAR), 'M'), mapq FROM parts""",
    ),
)
def _(spark, sf):
    text = F.expr(
        "concat(20 + mate_no, 'M', 100 + read_id % 50, 'N15M1I10M', 200 + read_id % 9, 'N', 5 + read_id % 20, 'M')"
    )
    reads = v.spread_small(v.alignments(spark, sf), "read_id").withColumns(
        {"cigar": text, "mapq": F.when(F.col("mapq") % 2 == 0, 255).otherwise(F.col("mapq"))}
    )
    return cigar.split_n_reads(reads).select("read_id", "segment", "start", "end_pos", "cigar", "mapq")


# The aligned part of each read is cut in half by an intron of 500 bases, while its letters run on; clips stay outside.
_SPLICED_BASES = f"""offsets AS (SELECT *, unnest(range(lead_clip, lead_clip + read_len - clip)) AS off FROM marked WHERE is_unmapped = 0 AND is_duplicate = 0),
placed AS (SELECT *, start - lead_clip + off + CASE WHEN off - lead_clip < (read_len - clip) // 2 THEN 0 ELSE 500 END AS pos,
  2 + (read_id + off * 7) % 39 AS qual FROM offsets),
bases AS (SELECT contig_idx, pos, qual, {sql.varied_letter("pos")} AS ref_base,
         {sql.varied_letter("start - lead_clip + off", step=sql.step("start - lead_clip + off", "off"))} AS base FROM placed)"""


@registered(
    "run_rna",
    sql.with_ctes(
        sql.ALIGN, sql.records(4000, intron=500), _SPLICED_BASES,
        "strong AS (SELECT * FROM bases WHERE qual >= 10)", sql.calls("strong", 20, 20),
        select="SELECT contig_idx, pos, ref, alt, qual, gt, depth, alt_count, filter FROM called",
    ),
)
def _(spark, sf):
    reads = v.with_sequence(v.read_records(spark, sf, 4000))
    clip = F.col("read_id") % 4
    half = F.floor((F.col("read_len") - clip) / 2)
    clipped = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    text = F.concat(
        clipped(F.col("lead")), half.cast("string"), F.lit("M500N"), (F.col("read_len") - clip - half).cast("string"), F.lit("M"), clipped(clip - F.col("lead"))
    )
    spliced = reads.withColumns({"cigar": text, "end_pos": F.col("end_pos") + 500})
    cells = materialize(v.reference_cells(spark, sf, pileup.PILEUP_BIN))
    return dna.run_rna(spliced, cells, min_base_quality=10, min_mapq=0).variants


@registered(
    "realign_targets",
    sql.with_ctes(
        sql.ALIGN, sql.MAPPED,
        """events AS (
  SELECT contig_idx, start + 19 AS s, start + 20 AS e FROM mapped WHERE read_id % 5 = 0
  UNION ALL SELECT contig_idx, start + 30, start + 32 FROM mapped WHERE read_id % 5 IN (0, 1)),
around AS (SELECT contig_idx, greatest(s - 10, 1) AS start, e + 10 AS end_pos FROM events)""",
        sql.islands("around", "found", 0),
        select="SELECT * FROM found",
    ),
)
def _(spark, sf):
    shape = F.expr(
        "CASE read_id % 5 WHEN 0 THEN concat('5S20M2I10M3D', read_len, 'M') WHEN 1 THEN concat('30M3D', read_len, 'M') "
        "ELSE concat(read_len, 'M') END"
    )
    return targets.realign_targets(mapped(spark, sf).withColumn("cigar", shape))


@registered(
    "parse_cigar",
    sql.with_ctes(
        sql.ALIGN,
        select="""SELECT read_id, CASE WHEN is_reverse = 1 THEN 6 ELSE 5 END AS ops, 3 + read_id % 4 AS first_len,
 start + read_len + 20 + read_id % 7 - 1 AS end_pos,
 CASE WHEN is_reverse = 1 THEN start + read_len + 20 + read_id % 7 - 1 + 6 ELSE start - 3 - read_id % 4 END AS five_prime
 FROM alignments""",
    ),
)
def _(spark, sf):
    text = F.expr(
        "concat(3 + read_id % 4, 'S', read_len, 'M4I', read_id % 7, 'D20=', if(is_reverse = 1, '6H', ''))"
    )
    reads = v.alignments(spark, sf).withColumn("cigar", text)
    reads = reads.withColumn("end_pos", cigar.alignment_end("start", "cigar"))
    parsed = cigar.parse_cigar("cigar")
    return reads.select(
        "read_id", F.size(parsed).alias("ops"), parsed[0]["len"].alias("first_len"), "end_pos",
        cigar.unclipped_5p("start", "end_pos", "cigar", "is_reverse").alias("five_prime"),
    )


def _old_quality(spark, sf):
    """Reads whose libraries 1 and 2 use the old quality encoding."""
    reads = v.spread_small(v.alignments(spark, sf), "read_id")
    text = F.when(F.col("library") == "lib0", v.quality_text()).otherwise(v.quality_text(66))
    return reads.withColumns({"rg_id": F.col("library"), "qual": text})


_QUALITIES = """quals AS (SELECT library, read_id, list_max([2 + (read_id + o * 7) % 39 FOR o IN range(0, read_len)]) AS q_max,
  list_sum([2 + (read_id + o * 7) % 39 FOR o IN range(0, read_len)])::BIGINT AS q_sum FROM alignments)"""


@registered(
    "guess_quality_encoding",
    sql.with_ctes(
        sql.ALIGN, _QUALITIES,
        """shifted AS (SELECT library AS rg_id, max(q_max + CASE WHEN library = 'lib0' THEN 0 ELSE 31 END) AS max_quality FROM quals GROUP BY library)""",
        select="SELECT rg_id, max_quality, CASE WHEN max_quality <= 60 THEN 'sanger' ELSE 'illumina' END AS encoding FROM shifted",
    ),
)
def _(spark, sf):
    return quality.guess_quality_encoding(_old_quality(spark, sf))


@registered("fix_quality", sql.with_ctes(sql.ALIGN, _QUALITIES, select="SELECT read_id, q_sum FROM quals"))
def _(spark, sf):
    fixed = quality.normalize_quality(_old_quality(spark, sf))
    total = F.aggregate(quality.phred("qual"), F.lit(0).cast("long"), lambda t, q: t + q)
    return fixed.select("read_id", total.alias("q_sum"))


# Files, as lines derived from the tables --------------------------------------------


def _fastq_lines(spark, sf):
    """Three files of records; some end in a record without its quality line."""
    names = "concat('@r', o_orderkey, '/1')"
    seq, qual = "repeat('ACGT', int(5 + o_custkey % 7))", "repeat('@III', int(5 + o_custkey % 7))"
    return (
        v.table(spark, sf, "orders")
        .selectExpr(
            "concat('file', o_orderkey % 3) AS path", "o_orderkey",
            f"posexplode(array({names}, {seq}, '+', {qual})) AS (place, value)",
        )
        .filter("NOT (o_orderkey % 97 = 0 AND place = 3)")
        .selectExpr("path", "(o_orderkey div 3) * 4 + place AS line_no", "value")
    )


@registered(
    "read_fastq",
    """SELECT concat('file', CAST(o_orderkey % 3 AS VARCHAR)) AS path, o_orderkey // 3 AS record, concat('r', CAST(o_orderkey AS VARCHAR), '/1') AS name,
 repeat('ACGT', CAST(5 + o_custkey % 7 AS INT)) AS seq, repeat('@III', CAST(5 + o_custkey % 7 AS INT)) AS qual
 FROM orders WHERE o_orderkey % 97 <> 0""",
)
def _(spark, sf):
    return fastq.parse_fastq_lines(_fastq_lines(spark, sf))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes and reads back."""
    return f"{shared_dir(spark)}/locusflow/{name}-{uuid.uuid4().hex}"


@registered(
    "read_fastq_files",
    """SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS name, repeat('ACGT', CAST(5 + o_custkey % 7 AS INT)) AS seq,
 repeat('@III', CAST(5 + o_custkey % 7 AS INT)) AS qual, 1 AS mate, 'S' AS sample FROM orders""",
)
def _(spark, sf):
    path = _folder(spark, "fastq")
    records = v.table(spark, sf, "orders").selectExpr(
        "concat_ws('\n', concat('@r', o_orderkey), repeat('ACGT', int(5 + o_custkey % 7)), '+', repeat('@III', int(5 + o_custkey % 7))) AS value"
    )
    records.write.text(path)
    # Every part file is one input; their names are a list, not data.
    files = [r["p"] for r in spark.read.text(path).select(F.input_file_name().alias("p")).distinct().collect()]
    return fastq.read_fastq(spark, [("S", f) for f in files]).select("name", "seq", "qual", "mate", "sample")


@registered(
    "write_chunks",
    """SELECT 'S' || CAST(o_orderkey % 4 AS VARCHAR) AS sample, 2 * o_orderkey + m.mate - 1 AS line, 'r' || CAST(o_orderkey AS VARCHAR) AS name,
 repeat(CASE WHEN m.mate = 1 THEN 'AC' ELSE 'GT' END, CAST(3 + o_custkey % 5 AS INT)) AS seq FROM orders, (SELECT unnest([1, 2]) AS mate) m""",
)
def _(spark, sf):
    rows = v.table(spark, sf, "orders").selectExpr(
        "concat('S', o_orderkey % 4) AS sample", "o_orderkey AS ordinal", "concat('r', o_orderkey) AS name",
        "explode(array(1, 2)) AS mate", "o_custkey",
    ).withColumns(
        {"seq": F.expr("repeat(if(mate = 1, 'AC', 'GT'), int(3 + o_custkey % 5))"), "qual": F.expr("repeat('II', int(3 + o_custkey % 5))")}
    )
    path = _folder(spark, "chunks")
    sinks.write_chunks(rows, path, target_bytes=200_000).collect()
    # Records are numbered within a sample by their order in the pieces, then tied to the order they were written in.
    back = spark.read.text(path).select("sample", "chunk_id", "value", F.monotonically_increasing_id().alias("id"), F.col("_metadata.file_path").alias("path"))
    first = back.groupBy("path").agg(F.min("id").alias("first"))
    lines = back.join(first, "path").select("sample", "path", (F.col("id") - F.col("first")).alias("line_no"), "value")
    found = fastq.parse_fastq_lines(lines, ("sample", "path"))
    mate = F.when(F.col("seq").startswith("A"), 0).otherwise(1)
    return found.select("sample", (F.substring("name", 2, 20).cast("long") * 2 + mate).alias("line"), "name", "seq")


@registered(
    "write_alignments",
    sql.with_ctes(sql.ALIGN, select="SELECT read_id, contig_idx, start, end_pos, mapq FROM alignments WHERE is_unmapped = 0 AND contig_idx = mate_contig_idx"),
)
def _(spark, sf):
    path = _folder(spark, "alignments")
    sinks.write_alignments(v.alignments(spark, sf), path, keep_cross_contig=False)
    back = spark.read.parquet(path).select("read_id", "contig_idx", "start", "end_pos", "mapq")
    return back.withColumn("contig_idx", F.col("contig_idx").cast("long"))


@registered(
    "read_reference",
    sql.with_ctes(
        sql.CONTIGS,
        "positions AS (SELECT contig_idx, unnest(range(1, length + 1)) AS p FROM contigs)",
        select="""SELECT contig_idx, p // 1024 AS cell, count(*) AS size,
 md5(string_agg(substr('ACGT', CAST(1 + (p * p * 37 + contig_idx * 13 + 7919) % 251 % 4 AS INT), 1), '' ORDER BY p)) AS digest
 FROM positions GROUP BY contig_idx, p // 1024""",
    ),
)
def _(spark, sf):
    cells = v.reference_cells(spark, sf, pileup.PILEUP_BIN).join(v.contigs(spark, sf), "contig_idx")
    # One text per contig: the fixture's contigs are short; lines of up to 1,024 bases.
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell", "seq"))), lambda c: c["seq"]), "\n")
    fasta = cells.groupBy("contig").agg(ordered.alias("body")).select(F.concat_ws("\n", F.concat(F.lit(">"), "contig"), "body").alias("value"))
    path = _folder(spark, "fasta")
    fasta.coalesce(1).write.text(path)
    found = tables.read_reference(spark, path, v.contigs(spark, sf))
    return found.select("contig_idx", "cell", F.length("seq").cast("long").alias("size"), F.md5("seq").alias("digest"))


@registered(
    "pair_mates",
    """SELECT 'S' || CAST(a.o_orderkey % 4 AS VARCHAR) AS sample, a.o_orderkey AS ordinal, m.mate, 'r' || CAST(a.o_orderkey AS VARCHAR) AS name,
 repeat(CASE WHEN m.mate = 1 THEN 'AC' ELSE 'GT' END, CAST(3 + a.o_custkey % 5 AS INT)) AS seq, repeat('II', CAST(3 + a.o_custkey % 5 AS INT)) AS qual
 FROM orders a, (SELECT unnest([1, 2]) AS mate) m WHERE a.o_orderkey % 10 <> 9""",
)
def _(spark, sf):
    def mate(letters: str) -> DataFrame:
        return v.table(spark, sf, "orders").selectExpr(
            "concat('S', o_orderkey % 4) AS sample", "o_orderkey AS ordinal", "concat('r', o_orderkey) AS name",
            f"repeat('{letters}', int(3 + o_custkey % 5)) AS seq", "repeat('II', int(3 + o_custkey % 5)) AS qual",
        )

    return pairs.interleave(pairs.pair_mates(mate("AC"), mate("GT").filter("ordinal % 10 <> 9"), check_names=True))


@registered(
    "read_manifest",
    """SELECT path1, path2 FROM (SELECT concat('r1_', CAST(s_suppkey AS VARCHAR)) AS path1,
 CASE WHEN s_suppkey % 3 = 0 THEN concat('r2_', CAST(s_suppkey AS VARCHAR)) END AS path2, s_suppkey FROM supplier) t WHERE s_suppkey % 3 <> 2""",
)
def _(spark, sf):
    lines = v.table(spark, sf, "supplier").selectExpr(
        "concat_ws('\t', concat('r1_', s_suppkey), if(s_suppkey % 3 <> 1, concat('r2_', s_suppkey), NULL), "
        "if(s_suppkey % 3 = 2, 'extra', NULL)) AS value"
    )
    return fastq.parse_manifest(lines)


@registered(
    "read_dict",
    sql.with_ctes(
        sql.CONTIGS, sql.DICTIONARY,
        select="""SELECT row_number() OVER (ORDER BY contig_idx) - 1 AS contig_idx, contig,
 CASE WHEN contig_idx % 50 = 7 THEN 0 ELSE length END AS length FROM dictionary""",
    ),
)
def _(spark, sf):
    lines = v.dictionary(spark, sf).selectExpr(
        "contig_idx + 1 AS line_no", "concat('@SQ\tSN:', contig, '\tLN:', if(contig_idx % 50 = 7, 'unknown', string(length)), '\tM5:0') AS value"
    )
    head = v.contigs(spark, sf).filter("contig_idx = 0").selectExpr("0L AS line_no", "'@HD\tVN:1.4' AS value")
    return sam.parse_dict_lines(head.unionByName(lines))


def _sam_lines(spark, sf):
    """Alignments as SAM text with a tag; every 41st line is broken, one header line per contig."""
    fields = [
        "concat('t', template_id)", "if(is_unmapped = 1, 4, 0) + 16 * is_reverse + 1 + if(mate_no % 2 = 1, 64, 128)",
        "concat('chr', contig_idx + 1)", "if(read_id % 41 = 0, 'x', string(start))", "mapq", "concat(read_len, 'M')",
        "if(mate_contig_idx = contig_idx, '=', concat('chr', mate_contig_idx + 1))", "mate_start", "0",
        "substr(repeat('ACGT', 25), 1, int(read_len))", "substr(repeat('I', 100), 1, int(read_len))", "concat('RG:Z:', library)",
        "'NM:i:1'",
    ]
    body = v.text_lines(v.spread_small(v.alignments(spark, sf), "read_id"), f"concat_ws('\t', {', '.join(fields)})")
    return v.contigs(spark, sf).selectExpr("concat('@SQ\tSN:', contig, '\tLN:', length) AS value").unionByName(body)


@registered(
    "read_sam",
    sql.with_ctes(
        sql.ALIGN,
        select="""SELECT concat('t', CAST(template_id AS VARCHAR)) AS template_id, contig_idx, start, start + read_len - 1 AS end_pos,
 mate_contig_idx, mate_start, read_len, mapq, is_reverse, is_unmapped, library, repeat('I', CAST(read_len AS INT)) AS qual,
 CASE WHEN is_unmapped = 1 THEN 4 ELSE 0 END + 16 * is_reverse + 1 + CASE WHEN mate_no % 2 = 1 THEN 64 ELSE 128 END AS flag
 FROM alignments WHERE read_id % 41 <> 0""",
    ),
)
def _(spark, sf):
    found = sam.to_alignments(sam.parse_sam_lines(_sam_lines(spark, sf)), v.contigs(spark, sf))
    return found.select(
        "template_id", "contig_idx", "start", "end_pos", "mate_contig_idx", "mate_start", "read_len", "mapq",
        "is_reverse", "is_unmapped", "library", "qual", "flag",
    )


@registered(
    "sam_libraries",
    sql.with_ctes(
        sql.ALIGN,
        select="""SELECT concat('t', CAST(template_id AS VARCHAR)) AS template_id, start, library AS rg_id,
 CASE library WHEN 'lib0' THEN 'L1' WHEN 'lib1' THEN 'L1' ELSE library END AS library FROM alignments WHERE read_id % 41 <> 0""",
    ),
)
def _(spark, sf):
    heads = v.contigs(spark, sf).filter("contig_idx < 2").selectExpr("concat('@RG\tID:lib', contig_idx, '\tSM:S\tLB:L1') AS value")
    lines = heads.unionByName(_sam_lines(spark, sf))
    found = sam.to_alignments(sam.parse_sam_lines(lines), v.contigs(spark, sf), sam.parse_read_groups(lines))
    return found.select("template_id", "start", "rg_id", "library")


@registered(
    "rejected_sam_lines", sql.with_ctes(sql.ALIGN, select="SELECT count(*) AS rejected FROM alignments WHERE read_id % 41 = 0")
)
def _(spark, sf):
    return sam.rejected_sam_lines(_sam_lines(spark, sf)).agg(F.count(F.lit(1)).alias("rejected"))


def _vcf_lines(spark, sf):
    rows = v.variants(spark, sf).withColumns(
        {"contig": F.expr("concat('chr', contig_idx + 1)"), "depth": F.expr("variant_id % 60"), "gt": F.lit("0/1")}
    )
    return vcf.vcf_lines(rows.withColumn("qual", F.expr("double(variant_id % 1000)")))


@registered(
    "write_vcf_lines",
    sql.with_ctes(
        sql.VARIANTS,
        select="""SELECT concat('chr', CAST(contig_idx + 1 AS VARCHAR), chr(9), CAST(pos AS VARCHAR), chr(9), '.', chr(9), ref, chr(9), alt, chr(9),
 CAST(variant_id % 1000 AS VARCHAR), '.00', chr(9), '.', chr(9), 'DP=', CAST(variant_id % 60 AS VARCHAR), chr(9), 'GT', chr(9), '0/1') AS value FROM variants""",
    ),
)
def _(spark, sf):
    return _vcf_lines(spark, sf).orderBy("contig_idx", "pos", "value").select("value")


@registered(
    "read_vcf",
    sql.with_ctes(
        sql.VARIANTS,
        select="""SELECT concat('chr', CAST(contig_idx + 1 AS VARCHAR)) AS contig, pos, ref, alt, (variant_id % 1000)::DOUBLE AS qual,
 CAST(variant_id % 60 AS BIGINT) AS depth, '0/1' AS gt FROM variants""",
    ),
)
def _(spark, sf):
    lines = _vcf_lines(spark, sf).select("value").unionByName(
        vcf.header_lines(spark, v.contigs(spark, sf)).select("value")
    )
    return vcf.parse_vcf_lines(lines).select(
        "contig", "pos", "ref", "alt", "qual", F.try_element_at("info", F.lit("DP")).cast("long").alias("depth"), "gt"
    )


@registered(
    "write_vcf",
    sql.with_ctes(
        sql.CONTIGS, sql.VARIANTS,
        select="""SELECT concat('chr', CAST(contig_idx + 1 AS VARCHAR)) AS contig, count(*) AS n, sum(pos)::BIGINT AS positions,
 sum(variant_id % 1000)::DOUBLE AS qualities, 0 AS out_of_order, (SELECT count(*) FROM contigs) AS named FROM variants GROUP BY contig_idx""",
    ),
)
def _(spark, sf):
    path = f"{shared_dir(spark)}/locusflow/vcf-{uuid.uuid4().hex}"
    rows = v.variants(spark, sf).withColumns({"qual": (F.col("variant_id") % 1000).cast("double"), "depth": F.lit(7), "gt": F.lit("0/1")})
    vcf.write_vcf(rows, path, v.contigs(spark, sf))
    back = vcf.read_vcf(spark, path)
    per = back.groupBy("contig").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("positions"), F.sum("qual").alias("qualities"))
    # Files in the order of their names are one ordered file that begins with the header.
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("part"), F.monotonically_increasing_id().alias("at"))
    kind = F.when(F.col("value").startswith("##fileformat"), 0).when(F.col("value").startswith("##"), 1).when(F.col("value").startswith("#"), 2).otherwise(3)
    parts = F.split("value", "\t")
    keyed = lines.select("part", "at", F.struct(kind.alias("kind"), F.get(parts, F.lit(0)).alias("c"), F.get(parts, F.lit(1)).try_cast("long").alias("p")).alias("key"))
    keyed = materialize(keyed.withColumn("key", F.struct("key.kind", F.when(F.col("key.kind") == 3, F.col("key.c")).alias("c"), F.col("key.p").alias("p"))))
    late = keyed.withColumn("late", F.col("key") < F.lag("key").over(Window.partitionBy("part").orderBy("at"))).filter("late")
    ends = keyed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    apart = ends.withColumn("late", F.col("low") < F.lag("high").over(Window.orderBy("part"))).filter("late")
    wrong = late.select("late").unionByName(apart.select("late")).agg(F.count(F.lit(1)).cast("int").alias("out_of_order"))
    named = keyed.filter("key.kind = 1").agg(F.count(F.lit(1)).alias("named"))
    return per.crossJoin(F.broadcast(wrong)).crossJoin(F.broadcast(named))


_TWO_SAMPLES = """concat('chr', {t}(contig_idx + 1), {tab}, {t}(pos), {tab}, 'v', {t}(variant_id), {tab}, ref, {tab}, alt, {tab},
 {t}(variant_id % 1000), '.00', {tab}, 'q10', {tab}, 'DP=', {t}(variant_id % 60), ';DB;FS=1.5', {tab}, 'GT:AD', {tab}, '0/1:3,',
 {t}(variant_id % 9), {tab}, '1/1:0,', {t}(shard))"""


@registered(
    "vcf_round_trip",
    sql.with_ctes(
        sql.VARIANTS,
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY contig_idx, pos ORDER BY variant_id % 1000 DESC, shard, variant_id) AS rn FROM variants)""",
        select=f"SELECT {_TWO_SAMPLES.format(t='', tab='chr(9)')} AS value FROM ranked WHERE rn = 1",
    ),
)
def _(spark, sf):
    text = F.expr(_TWO_SAMPLES.format(t="string", tab="char(9)"))
    lines = v.variants(spark, sf).select("shard", text.alias("value"))
    named = vcf.parse_vcf_lines(lines).withColumns(
        {"contig_idx": F.substring("contig", 4, 9).cast("long") - 1, "variant_id": F.substring("id", 2, 20).cast("long")}
    )
    return vcf.vcf_lines(variants.combine_variants(named)).select("value")


@registered(
    "read_bed", sql.with_ctes(sql.EXONS, select="SELECT concat('c', CAST(contig_idx AS VARCHAR)) AS contig, start, end_pos FROM exons")
)
def _(spark, sf):
    lines = v.exons(spark, sf).selectExpr("concat_ws('\t', concat('c', contig_idx), start - 1, end_pos, exon_id) AS value")
    return tables.parse_bed_lines(lines)


@registered(
    "read_gff",
    sql.with_ctes(
        sql.EXONS,
        select="""SELECT concat('c', CAST(contig_idx AS VARCHAR)) AS contig, start, end_pos, '-' AS strand, concat('g', CAST(gene_id AS VARCHAR)) AS gene_id
 FROM exons WHERE exon_id % 4 <> 0""",
    ),
)
def _(spark, sf):
    attributes = "if(exon_id % 2 = 0, concat('gene_id \"g', gene_id, '\"; n \"1\";'), concat('ID=x;gene_id=g', gene_id))"
    kind = "if(exon_id % 4 = 0, 'gene', 'exon')"
    lines = v.exons(spark, sf).selectExpr(
        f"concat_ws('\t', concat('c', contig_idx), 'src', {kind}, start, end_pos, '.', '-', '.', {attributes}) AS value"
    )
    return tables.parse_gff_lines(lines)


@registered("read_bin_counts", sql.with_ctes(sql.ALIGN, sql.MAPPED, _BINS, select="SELECT concat('c', CAST(contig_idx AS VARCHAR)) AS contig, start, end_pos, reads FROM bins"))
def _(spark, sf):
    lines = regions.bin_reads(mapped(spark, sf), 5000).selectExpr(
        "concat('c', contig_idx, ':', start, '-', end_pos, '\t', reads) AS value"
    )
    return tables.parse_bin_count_lines(lines)


@registered(
    "read_junctions",
    f"""SELECT {_JUNCTION_LINE}, l_partkey % 7 AS motif, l_partkey % 2 AS annotated, l_orderkey % 11 AS n_unique, l_orderkey % 4 AS n_multi,
 10 + CAST(l_quantity AS BIGINT) AS max_overhang FROM lineitem WHERE l_partkey % 50 <> 0""",
)
def _(spark, sf):
    return tables.parse_junction_lines(_junction_lines(spark, sf))


@registered(
    "assign_chunks",
    """SELECT doc_id, source, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 20000 AS chunk_id
 FROM documents""",
)
def _(spark, sf):
    documents = v.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    chunked = pairs.assign_chunks(documents, F.col("n_chars"), ["source"], "doc_id", 20_000, scan_rows=100)
    return chunked.select("doc_id", "source", "chunk_id")


@registered(
    "pipe_partitions", sql.with_ctes(sql.ALIGN, select="SELECT concat('r', CAST(read_id AS VARCHAR), chr(9), CAST(start AS VARCHAR)) AS value FROM alignments")
)
def _(spark, sf):
    lines = v.alignments(spark, sf).selectExpr("concat('r', read_id, '\t', start) AS value")
    return pipe.pipe_partitions(lines, pipe.build_command("copy", {"copy": ["cat"]}, {"copy": "-u"}))
