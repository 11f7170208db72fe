"""SQL counterparts of the registered queries, written from the definitions for DuckDB.

They share no code with the operators: islands by one window per contig, interval
joins by plain inequality, duplicates by ranking.  Fragments below are the derived
tables as common table expressions.
"""

from __future__ import annotations

_SPAN = "(1000000 - 200000 * (l_suppkey % 5) - 200)"
_MATE = "(CASE WHEN l_orderkey % 20 = 0 THEN (l_suppkey + 1) % 5 ELSE l_suppkey % 5 END)"
_SCATTER = "(l_partkey * 7919 + l_orderkey * 104729 + l_linenumber * 31"

CONTIGS = """contigs AS (
  SELECT CAST(r_regionkey AS BIGINT) AS contig_idx, concat('chr', CAST(r_regionkey + 1 AS VARCHAR)) AS contig,
         CAST(1000000 - 200000 * r_regionkey AS BIGINT) AS length FROM region
  UNION ALL
  SELECT CAST(5 + n_nationkey AS BIGINT), concat('scf', CAST(n_nationkey AS VARCHAR)), CAST(500 + 40 * n_nationkey AS BIGINT)
  FROM nation)"""

DICTIONARY = """dictionary AS (
  SELECT contig_idx, contig, length FROM contigs
  UNION ALL
  SELECT 30 + c_custkey, concat('un', CAST(c_custkey AS VARCHAR)), 500 + (c_custkey * 37) % 1500 FROM customer)"""

ALIGN = f"""alignments AS (
  SELECT ((l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) * 100000 + l_partkey AS read_id,
         l_orderkey AS template_id, l_suppkey % 5 AS contig_idx,
         1 + {_SCATTER}) % {_SPAN} AS start,
         {_SCATTER}) % {_SPAN} + 50 + CAST(l_quantity AS BIGINT) AS end_pos,
         {_MATE} AS mate_contig_idx,
         1 + {_SCATTER} + 150) % (1000000 - 200000 * {_MATE} - 200) AS mate_start,
         50 + CAST(l_quantity AS BIGINT) AS read_len, l_partkey % 61 AS mapq, l_linenumber % 2 AS is_reverse,
         CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS is_unmapped,
         l_linenumber AS mate_no, concat('lib', CAST(l_suppkey % 3 AS VARCHAR)) AS library
  FROM lineitem)"""

VARIANTS = """variants AS (
  SELECT o_orderkey AS variant_id, o_custkey % 7 AS shard, o_custkey % 5 AS contig_idx,
         1 + (o_orderkey * 104729) % 5000 AS pos, o_totalprice AS qual,
         substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref,
         substr('ACGT', CAST(1 + (o_orderkey + 1 + o_custkey % 3) % 4 AS INT), 1) AS alt,
         (o_custkey % 400) / 10.0::DOUBLE AS fs, (o_orderkey % 100) / 10.0::DOUBLE AS qd
  FROM orders)"""

EXONS = """exons AS (
  SELECT c_custkey % 50 AS gene_id, c_custkey AS exon_id, c_custkey % 5 AS contig_idx,
         1 + (c_custkey * 7919) % (1000000 - 200000 * (c_custkey % 5) - 400) AS start,
         1 + (c_custkey * 7919) % (1000000 - 200000 * (c_custkey % 5) - 400) + 60 + c_custkey % 140 AS end_pos
  FROM customer)"""

SITES = """known_sites AS (
  SELECT p_partkey AS site_id, p_partkey % 5 AS contig_idx,
         1 + (p_partkey * 7919) % (1000000 - 200000 * (p_partkey % 5)) AS pos FROM part)"""

MAPPED = "mapped AS (SELECT * FROM alignments WHERE is_unmapped = 0)"


def islands(source: str, name: str, gap: int, start: str = "start", end: str = "end_pos") -> str:
    """Islands of ``source`` by one running maximum per contig."""
    return f"""{name}_r AS (
  SELECT contig_idx, {start} AS start, {end} AS end_pos,
         max({end}) OVER (PARTITION BY contig_idx ORDER BY {start}, {end} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM {source}),
{name}_f AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + ({gap}) THEN 1 ELSE 0 END)
            OVER (PARTITION BY contig_idx ORDER BY start, end_pos ROWS UNBOUNDED PRECEDING) AS island FROM {name}_r),
{name} AS (
  SELECT contig_idx, min(start) AS start, max(end_pos) AS end_pos, count(*) AS n FROM {name}_f GROUP BY contig_idx, island)"""


ISLANDS = islands("mapped", "islands", 51)
PADDED = islands("(SELECT contig_idx, greatest(start - 301, 1) AS start, end_pos FROM islands)", "padded", -1)


def letter(pos: str, contig: str = "contig_idx", step: str = "0") -> str:
    """Fixture base at a position, moved on by ``step`` letters."""
    return f"substr('ACGT', CAST(1 + ((({pos}) * 37 + {contig} * 13) % 11 % 4 + {step}) % 4 AS INT), 1)"


def varied_letter(pos: str, step: str = "0") -> str:
    """Base of the reference behind the full reads."""
    return f"substr('ACGT', CAST(1 + ((({pos}) * ({pos}) * 37 + contig_idx * 13 + 7919) % 251 % 4 + {step}) % 4 AS INT), 1)"


def step(pos: str, off: str) -> str:
    return (
        f"(CASE WHEN (read_id + {off}) % 97 = 0 THEN 1 WHEN ({pos}) % 211 = 0 AND read_id % 2 = 0 THEN 2 ELSE 0 END)"
    )


def bases(where: str = "is_unmapped = 0") -> str:
    """One row per aligned base."""
    return f"""bases AS (
  SELECT read_id, template_id, library, contig_idx, off, start + off AS pos, is_reverse, mapq, read_len,
         {letter("start + off")} AS ref_base, {letter("start + off", step=step("start + off", "off"))} AS base,
         2 + (read_id + off * 7) % 39 AS qual
  FROM (SELECT *, unnest(range(0, read_len)) AS off FROM alignments WHERE {where}) t)"""


COVARIATES = """cov AS (
  SELECT *, library AS rg,
         CASE WHEN is_reverse = 1 THEN read_len - off ELSE off + 1 END AS cycle,
         CASE WHEN is_reverse = 1 THEN translate(concat(next_base, base), 'ACGT', 'TGCA') ELSE concat(last_base, base) END AS pair,
         CASE WHEN is_reverse = 1 THEN next_base ELSE last_base END AS neighbour
  FROM (SELECT *, lag(base) OVER w AS last_base, lead(base) OVER w AS next_base FROM bases
        WINDOW w AS (PARTITION BY read_id, read_len ORDER BY off)) x),
obs AS (
  SELECT rg, qual, cycle, CASE WHEN neighbour IS NULL THEN NULL ELSE pair END AS context,
         base, ref_base, contig_idx, pos, read_id, off, mapq FROM cov),
recal AS (
  SELECT rg, qual, cycle, context, count(*) AS observations, count(*) FILTER (WHERE base <> ref_base) AS mismatches
  FROM obs WHERE (contig_idx, pos) NOT IN (SELECT (contig_idx, pos) FROM known_sites) GROUP BY ALL)"""

_EMP = "-10 * log10((sum(mismatches) + 1)::DOUBLE / (sum(observations) + 2)::DOUBLE)"

RECALIBRATED = f"""q_rg AS (SELECT rg, {_EMP} AS q0 FROM recal GROUP BY rg),
q_rep AS (SELECT rg, qual, {_EMP} AS q1 FROM recal GROUP BY rg, qual),
q_cyc AS (SELECT rg, qual, cycle, {_EMP} AS q2 FROM recal GROUP BY rg, qual, cycle),
q_ctx AS (SELECT rg, qual, context, {_EMP} AS q3 FROM recal WHERE context IS NOT NULL GROUP BY rg, qual, context),
fresh AS (
  SELECT o.*, greatest(1, least(93, CAST(floor(r + coalesce(q2 - r, 0) + coalesce(q3 - r, 0) + 0.5 + 1e-9) AS INT))) AS new_qual
  FROM (SELECT o.*, coalesce(q1, q0, o.qual::DOUBLE) AS r, q2, q3 FROM obs o
        LEFT JOIN q_rg ON o.rg = q_rg.rg
        LEFT JOIN q_rep ON o.rg = q_rep.rg AND o.qual = q_rep.qual
        LEFT JOIN q_cyc ON o.rg = q_cyc.rg AND o.qual = q_cyc.qual AND o.cycle = q_cyc.cycle
        LEFT JOIN q_ctx ON o.rg = q_ctx.rg AND o.qual = q_ctx.qual AND o.context = q_ctx.context) o)"""


def calls(source: str, call_conf: float, emit_conf: float, qual: str = "qual") -> str:
    """Diploid calls from base rows by the textbook sums, one genotype at a time."""
    e = f"least(pow(10.0, -{qual} / 10.0), 0.75)"

    def nano(p: str) -> str:
        return f"CAST(round(log10({p}) * 1e9) AS BIGINT)"

    return f"""scored AS (
  SELECT contig_idx, pos, ref_base, base, {nano(f"{e} / 3")} AS miss, {nano(f"1 - {e}")} AS hit,
         {nano(f"((1 - {e}) + {e} / 3) / 2")} AS half FROM {source}),
alts AS (
  SELECT contig_idx, pos, ref_base, base AS alt, count(*) AS alt_count,
         row_number() OVER (PARTITION BY contig_idx, pos, ref_base ORDER BY count(*) DESC, base) AS rn
  FROM scored WHERE base <> ref_base GROUP BY contig_idx, pos, ref_base, base),
likely AS (
  SELECT s.contig_idx, s.pos, s.ref_base, a.alt, a.alt_count, count(*) AS depth,
         sum(CASE WHEN base = s.ref_base THEN hit ELSE miss END) * 1e-9 + log10(1 - 1.5 * 1e-3) AS l_rr,
         sum(CASE WHEN base = s.ref_base OR base = a.alt THEN half ELSE miss END) * 1e-9 + log10(1e-3) AS l_ra,
         sum(CASE WHEN base = a.alt THEN hit ELSE miss END) * 1e-9 + log10(1e-3 / 2) AS l_aa
  FROM scored s JOIN alts a ON s.contig_idx = a.contig_idx AND s.pos = a.pos AND s.ref_base = a.ref_base AND a.rn = 1
  GROUP BY ALL),
graded AS (
  SELECT *, greatest(l_rr, l_ra, l_aa) AS top FROM likely),
genotyped AS (
  SELECT contig_idx, pos, ref_base AS ref, alt, depth, alt_count,
         round(greatest(0.0, -10 * (l_rr - (top + log10(pow(10.0, l_rr - top) + pow(10.0, l_ra - top) + pow(10.0, l_aa - top))))), 6) AS qual,
         CASE WHEN l_rr >= l_ra AND l_rr >= l_aa THEN '0/0' WHEN l_ra >= l_aa THEN '0/1' ELSE '1/1' END AS gt FROM graded),
called AS (
  SELECT *, CASE WHEN qual < {call_conf} THEN 'LowQual' ELSE 'PASS' END AS filter
  FROM genotyped WHERE gt <> '0/0' AND qual >= {emit_conf})"""


def records(fold: int, where: str = "true", intron: int = 0) -> str:
    """Full reads of pairs, with the duplicate decision by ranking; ``intron`` lengthens the alignment."""
    return f"""records AS (
  SELECT *, CASE WHEN is_reverse = 1 THEN 0 ELSE clip END AS lead_clip, start + read_len - clip - 1 AS end_pos,
         CASE WHEN is_reverse = 1 THEN start + read_len - 1 + {intron} ELSE start - clip END AS five,
         list_sum([CASE WHEN 2 + (read_id + o * 7) % 39 >= 15 THEN 2 + (read_id + o * 7) % 39 ELSE 0 END FOR o IN range(0, read_len)]) AS score
  FROM (SELECT read_id, template AS template_id, template % 5 AS contig_idx, concat('lib', CAST(template % 3 AS VARCHAR)) AS library,
               1 + start % {fold} AS start, read_id % 4 AS clip, read_len, mapq, is_reverse, is_unmapped
        FROM (SELECT *, template_id * 4 + (mate_no - 1) // 2 AS template FROM alignments) x WHERE {where}) a),
ends AS (
  SELECT template_id, library, score, (contig_idx * 100000 + five + 1000) * 2 + is_reverse AS e FROM records WHERE is_unmapped = 0),
templates AS (
  SELECT template_id, library, min(e) AS e1, max(e) AS e2, sum(score) AS score, count(*) >= 2 AS is_pair FROM ends GROUP BY ALL),
pair_ends AS (
  SELECT library, e1 AS e FROM templates WHERE is_pair UNION SELECT library, e2 FROM templates WHERE is_pair),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_pair, library, e1, e2 ORDER BY score DESC, template_id) AS rn FROM templates),
decided AS (
  SELECT r.template_id, r.library, r.is_pair, r.rn > 1 OR (NOT r.is_pair AND p.e IS NOT NULL) AS is_duplicate
  FROM ranked r LEFT JOIN pair_ends p ON r.library = p.library AND r.e1 = p.e),
marked AS (
  SELECT r.*, CASE WHEN r.is_unmapped = 0 AND d.is_duplicate THEN 1 ELSE 0 END AS is_duplicate
  FROM records r LEFT JOIN decided d ON r.template_id = d.template_id AND r.library = d.library)"""


def with_ctes(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select
