import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locusflow.functions import cigar, quality
from locusflow.operators import duplicates, features, filters, pileup, recalibrate, regions, sequence, targets, variants
from locusflow.plans import dna
from locusflow.session import materialize
from locusflow.streaming import ingest

READ = (
    "read_id string, template_id string, library string, contig_idx long, start long, end_pos long, "
    "cigar string, is_reverse int, is_unmapped int, mapq int, flag int, seq string, qual string"
)


def read(name, mate, start, text="20M", rev=0, unmapped=0, q="I", lib="L", flag=0, contig=0, seq=None):
    span = sum(int(n) for n, op in __import__("re").findall(r"(\d+)([MIDNSHP=X])", text) if op in "MDN=X")
    return (f"{name}/{mate}", name, lib, contig, start, start + span - 1, text, rev, unmapped, 60, flag, seq or "A" * 20, q * 20)


def test_cigar(spark):
    df = spark.createDataFrame(
        [(100, "5H3S10M2I4D6M2N1=1X7S", 0), (100, "10M4S2H", 1), (100, "9M", 0)], "start long, cigar string, is_reverse int"
    ).withColumn("end_pos", cigar.alignment_end("start", "cigar"))
    got = df.select(
        "end_pos", cigar.unclipped_5p("start", "end_pos", "cigar", "is_reverse").alias("p"),
        cigar.query_length("cigar").alias("q"), F.size(cigar.parse_cigar("cigar")).alias("k"),
    ).collect()
    assert list(map(tuple, got)) == [(123, 92, 30, 10), (109, 115, 14, 3), (108, 100, 9, 1)]


def test_split_n_reads(spark):
    seq = "ABCDEFGHIJ"
    df = spark.createDataFrame(
        [(1, 100, 300, "2S3M10N1M1I2M5N1M", 255, seq, seq), (2, 7, 9, "3M", 30, "XYZ", "XYZ")],
        "read_id long, start long, end_pos long, cigar string, mapq int, seq string, qual string",
    )
    got = cigar.split_n_reads(df, with_sequence=True).orderBy("read_id", "segment")
    assert list(map(tuple, got.select("segment", "start", "end_pos", "cigar", "mapq", "seq").collect())) == [
        (0, 100, 102, "2S3M", 60, "ABCDE"), (1, 113, 115, "1M1I2M", 60, "FGHI"), (2, 121, 121, "1M", 60, "J"),
        (0, 7, 9, "3M", 30, "XYZ"),
    ]


def test_quality_encodings(spark):
    df = spark.createDataFrame([("a", "I!5"), ("b", "h@^"), ("b", "hh@")], "rg_id string, qual string")
    assert dict(map(tuple, quality.guess_quality_encoding(df).select("rg_id", "encoding").collect())) == {
        "a": "sanger", "b": "illumina"
    }
    assert sorted(r["qual"] for r in quality.normalize_quality(df).collect()) == ["I!5", "I!?", "II!"]
    assert quality.fix_quality(df, mode="reject").count() == 2 and quality.rejected_quality(df).count() == 1
    with pytest.raises(Exception, match="below zero"):
        quality.fix_quality(df).collect()
    assert df.select(quality.phred_text(quality.phred("qual")).alias("q")).collect() == df.select(F.col("qual").alias("q")).collect()


def test_mark_duplicates(spark):
    rows = [
        *[read("best", m, s, rev=r, q="I") for m, s, r in ((1, 100, 0), (2, 300, 1))],
        *[read("copy", m, s, rev=r, q="5") for m, s, r in ((1, 100, 0), (2, 300, 1))],
        # Clipped differently, yet the same fragment; mates in the other order.
        read("clip", 2, 103, "3S17M", q="5"), read("clip", 1, 300, "18M2S", rev=1, q="5"),
        *[read("otherlib", m, s, rev=r, q="5", lib="M") for m, s, r in ((1, 100, 0), (2, 300, 1))],
        read("single", 1, 100, q="I"), read("single", 2, 100, unmapped=1, q="I"),
        read("lone1", 1, 500, q="5"), read("lone2", 1, 500, q="I"), read("lone3", 1, 500, rev=1),
        read("secondary", 1, 500, flag=0x100),
    ]
    reads = spark.createDataFrame(rows, READ)
    marked = duplicates.mark_duplicates(reads)
    once = sorted(map(tuple, marked.select("read_id", "flag").collect()))
    copies = {r for r, flag in once if flag & 0x400}
    assert copies == {"copy/1", "copy/2", "clip/1", "clip/2", "single/1", "lone1/1"}
    again = duplicates.mark_duplicates(marked.drop("is_duplicate"))
    assert sorted(map(tuple, again.select("read_id", "flag").collect())) == once
    assert filters.remove_duplicates(marked).count() == len(rows) - len(copies)


def test_read_bases_follow_the_cigar(spark):
    genome = "".join(random.Random(1).choice("ACGT") for _ in range(200))
    cells = spark.createDataFrame(
        [(0, c, genome[max(c * 16, 1) - 1 : c * 16 + 15]) for c in range(13)], "contig_idx long, cell long, seq string"
    )
    # Two clipped bases, six aligned, two inserted, five aligned, three deleted, five aligned.
    seq = "NN" + genome[9:15] + "TT" + genome[15:20] + genome[23:28]
    row = read("r", 1, 10, "2S6M2I5M3D5M", seq=seq)
    bases = sequence.read_bases(spark.createDataFrame([row], READ), cells, width=16).orderBy("off").collect()
    assert [b["off"] for b in bases] == [*range(2, 8), *range(10, 20)]
    assert [b["pos"] for b in bases] == [*range(10, 16), *range(16, 21), *range(24, 29)]
    assert all(b["base"] == b["ref_base"] == genome[b["pos"] - 1] for b in bases)
    assert bases[0]["prev_base"] == "N" and bases[6]["prev_base"] == "T" and bases[0]["qual"] == 40
    masked = spark.createDataFrame([(0, 12), (0, 18), (1, 10)], "contig_idx long, pos long")
    left = sequence.read_bases(spark.createDataFrame([row], READ), cells, exclude=masked, width=16)
    assert {b["pos"] for b in bases} - {b["pos"] for b in left.collect()} == {12, 18}


def brute_call(column, ref):
    """Textbook diploid likelihoods for one locus."""
    counts = {b: sum(x == b for x, _ in column) for b in "ACGT" if b != ref}
    alt = min(counts, key=lambda b: (-counts[b], b))

    def log(genotype):
        total = 0.0
        for base, q in column:
            e = 10 ** (-q / 10)
            total += math.log10(sum((1 - e if base == g else e / 3) for g in genotype) / 2)
        return total

    scores = {
        "0/0": log(ref + ref) + math.log10(1 - 0.0015), "0/1": log(ref + alt) + math.log10(0.001),
        "1/1": log(alt + alt) + math.log10(0.0005),
    }
    top = max(scores.values())
    total = top + math.log10(sum(10 ** (s - top) for s in scores.values()))
    return alt, max(scores, key=scores.get), max(0.0, -10 * (scores["0/0"] - total))


def test_call_snps_against_textbook(spark):
    rng, rows, want = random.Random(7), [], {}
    for pos in range(1, 120):
        ref, alt = rng.sample("ACGT", 2)
        share = rng.choice([0.0, 0.1, 0.5, 1.0])
        column = [(alt if rng.random() < share else ref, rng.randint(17, 40)) for _ in range(rng.randint(1, 30))]
        rows += [(0, pos, ref, b, q, 60) for b, q in column]
        rows.append((0, pos, ref, alt, 5, 60))  # Weak base, ignored.
        rows.append((0, pos, ref, alt, 40, 3))  # Badly placed read, ignored.
        if any(b != ref for b, _ in column):
            alt_, gt, qual = brute_call(column, ref)
            if gt != "0/0" and qual >= 10:
                want[pos] = (alt_, gt, "LowQual" if qual < 30 else "PASS", qual)
    bases = spark.createDataFrame(rows, "contig_idx long, pos long, ref_base string, base string, qual long, mapq int")
    got = {r["pos"]: r for r in pileup.call_snps(bases, 30, 10).collect()}
    assert got.keys() == want.keys() and len(want) > 30
    for pos, (alt, gt, label, qual) in want.items():
        assert (got[pos]["alt"], got[pos]["gt"], got[pos]["filter"]) == (alt, gt, label)
        assert got[pos]["qual"] == pytest.approx(qual, abs=1e-4)


def test_calls_do_not_depend_on_partitions(spark):
    rows = [(0, p, "A", "C" if i % 2 else "A", 17 + (i * 7) % 20, 60) for p in range(1, 40) for i in range(25)]
    bases = spark.createDataFrame(rows, "contig_idx long, pos long, ref_base string, base string, qual long, mapq int")
    one, many = bases.coalesce(1), bases.repartition(13, "qual")
    assert sorted(map(tuple, pileup.call_snps(one).collect())) == sorted(map(tuple, pileup.call_snps(many).collect()))


def test_explode_positions_masks_and_selects(spark):
    reads = spark.createDataFrame([(1, 0, 10, 30), (2, 0, 28, 40), (3, 1, 5, 6)], "read_id long, contig_idx long, start long, end_pos long")
    sites = spark.createDataFrame([(0, 29), (0, 29), (1, 6), (2, 1)], "contig_idx long, pos long")
    full = {tuple(r) for r in pileup.explode_positions(reads).select("read_id", "pos", "off").collect()}
    for options in ({}, {"broadcast_limit": 0, "rows_per_task": 1}):
        kept = {tuple(r) for r in pileup.explode_positions(reads, exclude=sites, bin_width=8, **options).select("read_id", "pos", "off").collect()}
        only = {tuple(r) for r in pileup.explode_positions(reads, only=sites, bin_width=8, **options).select("read_id", "pos", "off").collect()}
        assert only == {(1, 29, 19), (2, 29, 1), (3, 6, 1)} and kept == full - only


def test_recalibration_restores_regular_errors(spark):
    # Group g reports 40 throughout but errs in one base of ten.
    rows = [("r", "g", 0, i, i % 10, 0, 10, "A", "C" if i % 10 == 3 else "A", "A", 40) for i in range(5000)]
    bases = spark.createDataFrame(
        rows, "read_id string, library string, contig_idx long, pos long, off long, is_reverse int, read_len long, "
        "ref_base string, base string, prev_base string, qual long",
    )
    table = recalibrate.recalibration_table(bases)
    fresh = recalibrate.apply_recalibration(bases, table)
    by_cycle = {r["off"]: r["q"] for r in fresh.groupBy("off").agg(F.max("new_qual").alias("q")).collect()}
    assert by_cycle[3] <= 2 and all(by_cycle[o] > 25 for o in range(10) if o != 3)
    small = recalibrate.apply_recalibration(bases, table, limit=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, fresh.collect()))
    masked = recalibrate.recalibration_table(bases, bases.filter("base = 'C'").select("contig_idx", "pos"))
    assert masked.agg(F.sum("mismatches")).first()[0] == 0


@pytest.mark.parametrize("limit", [256 << 20, 1])
def test_reads_get_the_qualities_of_their_bases(spark, limit):
    chance = random.Random(3)
    text = lambda letters, n: "".join(chance.choice(letters) for _ in range(n))
    rows = []
    for i in range(400):
        n = chance.randint(1, 30)
        rows.append((f"r{i}", chance.choice(["g", "h", "i", None]), i % 2, 0, text("ACGTN", n), text("#5?I", n)))
    learned = rows[:300] if limit > 1 else [r for r in rows[:300] if r[1]]
    odd = [("x", "g", 0, 0, "ACGT", "*"), ("y", "g", 0, 0, None, "II"), ("z", "g", 1, 0, "AC", None), ("w", "new", 0, 0, "ACGT", "#5?I")]
    schema = "read_id string, library string, is_reverse int, contig_idx long, seq string, qual string"

    def bases(reads):
        flat = []
        for name, lib, rev, _, seq, qual in reads:
            for o, (c, q) in enumerate(zip(seq, qual, strict=True)):
                prev = o + 1 if rev else o - 1
                flat.append((name, lib, rev, len(seq), o, c, seq[prev] if 0 <= prev < len(seq) else None, "A", ord(q) - 33))
        return spark.createDataFrame(flat, "read_id string, library string, is_reverse int, read_len long, off long, base string, prev_base string, ref_base string, qual long")

    table = recalibrate.recalibration_table(bases(learned))
    reads = spark.createDataFrame(rows + odd, schema).repartition(3)
    got = {r["read_id"]: r["qual"] for r in recalibrate.recalibrate_reads(reads, table, limit=limit).collect()}
    assert len(got) == len(rows) + len(odd)
    want: dict[str, dict] = {}
    known = [r for r in rows if r[1] or limit > 1]
    for r in recalibrate.apply_recalibration(bases(known), table).collect():
        want.setdefault(r["read_id"], {})[r["off"]] = chr(r["new_qual"] + 33)
    for name, lib, *_, qual in rows:
        if lib is not None:  # a null group matches nothing in the join of bases
            assert got[name] == "".join(want[name][o] for o in range(len(qual))), name
    assert [got[n] for n in "xyzw"] == ["*", "II", None, "#5?I"]


def test_recalibrated_qualities(spark):
    df = spark.createDataFrame([("r", 1, 9), ("r", 0, 7), ("s", 0, 3)], "read_id string, off long, new_qual int")
    got = {r["read_id"]: r["qual"] for r in recalibrate.recalibrated_qualities(df).collect()}
    assert got == {"r": [7, 9], "s": [3]}


def test_realign_targets(spark):
    df = spark.createDataFrame([(0, 100, "10M2I10M"), (0, 100, "30M5D9M"), (0, 500, "40M")], "contig_idx long, start long, cigar string")
    assert sorted(map(tuple, targets.realign_targets(df, 5).collect())) == [(0, 104, 115, 1), (0, 125, 139, 1)]


def test_clustered_loci(spark):
    rng = random.Random(3)
    rows = [(i % 2, rng.randint(1, 900)) for i in range(90)] + [(0, 700)] * 3
    df = spark.createDataFrame(rows, "contig_idx long, pos long")
    want = set()
    for contig in (0, 1):
        places = sorted(p for c, p in rows if c == contig)
        for a, b in zip(places, places[2:]):
            if b - a <= 10:
                want |= {(contig, p) for p in places if a <= p <= b}
    for scan_bin in (16, 16_384):
        assert {tuple(r) for r in variants.clustered_loci(df, 10, 3, scan_bin).collect()} == want


def test_combine_variants_prefers_known_quality(spark):
    df = spark.createDataFrame(
        [(0, 5, None, 1, 1), (0, 5, 3.0, 2, 2), (0, 5, 3.0, 1, 3), (0, 6, None, 1, 4)],
        "contig_idx long, pos long, qual double, shard long, variant_id long",
    )
    assert sorted(r["variant_id"] for r in variants.combine_variants(df).collect()) == [3, 4]


def test_count_features_counts_fragments(spark):
    reads = spark.createDataFrame(
        [("a/1", "a", 0, 10, 20, 0), ("a/2", "a", 0, 25, 30, 0), ("b/1", "b", 0, 18, 120, 0), ("c/1", "c", 0, 10, 12, 1)],
        "read_id string, template_id string, contig_idx long, start long, end_pos long, is_unmapped int",
    )
    exons = spark.createDataFrame([(1, 0, 5, 40), (2, 0, 100, 140), (3, 1, 1, 9)], "exon_id long, contig_idx long, start long, end_pos long")
    counted = lambda mode: dict(map(tuple, features.count_features(reads, exons, mode).select("exon_id", "n").collect()))
    assert counted("drop") == {1: 1, 2: 0, 3: 0} and counted("count") == {1: 2, 2: 1, 3: 0}


def test_regions(spark):
    contigs = spark.createDataFrame([(0, "a", 1000), (1, "b", 30), (2, "c", 20)], "contig_idx long, contig string, length long")
    plan = regions.plan_regions_uniform(contigs, 5)
    spans = sorted(map(tuple, plan.select("contig_idx", "start", "end_pos").collect()))
    assert sum(e - s + 1 for _, s, e in spans) == 1050  # No gaps and no overlap.
    fitted = regions.plan_regions_uniform(contigs, 5, retry=True)
    assert fitted.agg(F.max("region_key")).first()[0] < 5
    reads = spark.createDataFrame([(1, 9, 5, 6, 0, 9, 2)], "read_id long, contig_idx long, start long, end_pos long, mate_contig_idx long, mate_start long, read_len long")
    with pytest.raises(Exception, match="no region for contig 9"):
        regions.assign_regions(reads, plan).collect()
    assert regions.assign_regions(reads, plan, unknown="drop").isEmpty()


def test_region_sort_and_merge_sorted_are_ordered(spark):
    df = spark.range(3000).selectExpr(
        "id AS read_id", "if(id % 3 = 0, 0, id % 11) AS region_key", "0L AS contig_idx", "(id * 7919) % 1000 AS start"
    )
    parts = regions.region_sort(df, 6).rdd.glom().collect()
    flat = [(r["region_key"], r["contig_idx"], r["start"], r["read_id"]) for part in parts for r in part]
    assert flat == sorted(flat) and len(flat) == 3000
    assert max(map(len, parts)) < 1000  # The region with a third of the reads spans several partitions.
    merged = [(r["start"], r["read_id"]) for r in regions.merge_sorted(df).collect()]
    assert merged == sorted(merged)


def test_observed_counters(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (1, 1, 1)], "contig_idx long, mate_contig_idx long, is_unmapped int")
    kept, seen = filters.filter_mapped_observed(df, keep_cross_contig=False)
    assert kept.count() == 1
    assert seen.get == {"reads_in": 3, "reads_out": 1, "unmapped": 1, "different_contig": 1}


def test_sampling_keeps_mates_together(spark):
    df = spark.range(4000).selectExpr("id div 2 AS template_id", "id % 2 AS mate")
    kept = filters.sample_reads(df, 0.3, seed=1)
    assert kept.groupBy("template_id").count().filter("count <> 2").isEmpty()
    assert 1000 < kept.count() < 1400
    assert sorted(kept.collect()) == sorted(filters.sample_reads(df.repartition(7), 0.3, seed=1).collect())


def simulated(spark, splice=False):
    """Reads over a random genome with two planted variants, and copies that vote against them."""
    rng = random.Random(11)
    genome = "".join(rng.choice("ACGT") for _ in range(400))
    snp = {120: "ACGT"[("ACGT".index(genome[119]) + 1) % 4], 260: "ACGT"[("ACGT".index(genome[259]) + 2) % 4]}
    rows = []
    for i in range(500):
        start = 1 + (i * 37) % 330
        seq = [snp.get(p, genome[p - 1]) if (i % 2 or p == 260) else genome[p - 1] for p in range(start, start + 20)]
        text, q = "20M", "I"
        if splice:
            seq = seq[:10] + [genome[p - 1] for p in range(start + 60, start + 70) if p <= 400]
            seq += ["A"] * (20 - len(seq))
            text = "10M50N10M"
        rows.append(read(f"t{i}", 1, start, text, rev=i % 2, q=q, seq="".join(seq), lib=f"L{i}"))
    cells = spark.createDataFrame([(0, 0, genome)], "contig_idx long, cell long, seq string")
    return spark.createDataFrame(rows, READ), cells, snp


def test_dna_chain_finds_planted_variants(spark):
    reads, cells, snp = simulated(spark)
    found = dna.run_dna(reads, cells, paired=False)
    got = {r["pos"]: (r["alt"], r["gt"]) for r in found.variants.collect()}
    assert got == {120: (snp[120], "0/1"), 260: (snp[260], "1/1")}
    assert found.islands.count() == 1 and found.targets.isEmpty()


def test_rna_chain_calls_through_introns(spark):
    reads, cells, snp = simulated(spark, splice=True)
    sites = spark.createDataFrame([(5, 0, 260)], "site_id long, contig_idx long, pos long")
    plain = dna.run_rna(reads.filter("start < 320"), cells, paired=False, annotate=True, label=True)
    got = {r["pos"]: r["alt"] for r in plain.variants.collect()}
    assert got.get(120) == snp[120]
    assert dna.run_rna(reads.limit(50), cells, sites, paired=False, annotate=True).variants.columns[-1] == "site_id"


def test_streaming_ingest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    contigs = spark.createDataFrame([(0, "chr1", 100)], "contig_idx long, contig string, length long")
    line = "r{}\t{}\tchr1\t7\t30\t3M\t=\t37\t39\tTTA\tIII\n"
    (folder / "a.sam").write_text("@HD\n" + line.format(1, 99) + line.format(2, 4))
    stream = ingest.stream_alignments(spark, str(folder), contigs)
    ingest.stream_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    (folder / "b.sam").write_text(line.format(3, 99))
    again = ingest.stream_alignments(spark, str(folder), contigs)
    ingest.stream_to_parquet(again, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert sorted(r["template_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["r1", "r3"]
    counters = ingest.stream_stage_metrics(ingest.stream_alignments(spark, str(folder), contigs))
    query = counters.writeStream.format("memory").queryName("counters").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert tuple(spark.table("counters").first()) == (0, 3, 2, 1, 0)


BASE_ROW = "contig_idx long, pos long, ref_base string, base string, qual long, mapq int, is_reverse int"


def test_no_calls_are_neither_evidence_nor_observations(spark):
    rows = [(0, 1, "N", "A", 40, 60, 0)] * 10 + [(0, 2, "C", "N", 40, 60, 0)] * 5 + [(0, 2, "C", "G", 40, 60, i % 2) for i in range(10)]
    called = pileup.call_snps(spark.createDataFrame(rows, BASE_ROW)).collect()
    assert [(r["pos"], r["alt"], r["depth"]) for r in called] == [(2, "G", 10)]
    seen = spark.createDataFrame(
        [("L", 30, 0, 20, 0, "N", None, "A"), ("L", 30, 1, 20, 0, "A", "N", "N"), ("L", 30, 2, 20, 0, "A", "A", "A")],
        "library string, qual long, off long, read_len long, is_reverse int, base string, prev_base string, ref_base string",
    )
    table = recalibrate.recalibration_table(seen).collect()
    assert [(r["observations"], r["mismatches"]) for r in table] == [(1, 0)]


def test_quality_of_deep_loci_has_no_cap(spark):
    rows = [(0, p, "A", "C", 40, 60, i % 2) for p, n in ((1, 900), (2, 1800)) for i in range(n)]
    got = {r["pos"]: r["qual"] for r in pileup.call_snps(spark.createDataFrame(rows, BASE_ROW)).collect()}
    assert 3000 < got[1] < got[2]


def test_strand_bias(spark):
    def fisher(a, b, c, d):
        row, column, n = a + b, a + c, a + b + c + d

        def chance(k):
            return math.comb(row, k) * math.comb(n - row, column - k) / math.comb(n, column)

        ks = range(max(0, column - (n - row)), min(row, column) + 1)
        return -10 * math.log10(min(1.0, sum(p for p in map(chance, ks) if p <= chance(a) * (1 + 1e-9))))

    tables = [(10, 10, 10, 10), (20, 0, 0, 20), (7, 3, 2, 9), (0, 0, 5, 6), (30, 1, 2, 3)]
    rows = [
        (0, p, "A", base, 40, 60, strand)
        for p, (a, b, c, d) in enumerate(tables)
        for base, strand, n in (("A", 0, a), ("A", 1, b), ("G", 0, c), ("G", 1, d))
        for _ in range(n)
    ]
    got = {r["pos"]: r["fs"] for r in pileup.call_snps(spark.createDataFrame(rows, BASE_ROW), 0, 0, strand_bias=True).collect()}
    assert got.keys() >= {0, 1, 2, 3} and all(abs(fisher(*tables[p]) - fs) < 1e-5 for p, fs in got.items())


def test_clipping_at_the_contig_end(spark):
    contigs = spark.createDataFrame([(0, 100)], "contig_idx long, length long")
    cases = {
        "30M": "10M20S", "5S30M2H": "5S10M20S2H", "5M3D22M": "5M3D2M20S", "8M4I22M": "8M4I2M20S", "10M5I20M": "10M25S",
        "9M3N21M": "9M21S", "2H4S10M": "2H4S10M", "10M3D4M": "10M4S",
    }
    rows = [(i, 0, 91, text, 0, 60) for i, text in enumerate(cases)] + [(50, 0, 120, "3H5S20M", 0, 60), (51, 0, 95, "*", 1, 9)]
    reads = spark.createDataFrame(rows, "i int, contig_idx long, start long, cigar string, is_unmapped int, mapq int")
    reads = reads.withColumn("end_pos", F.when(F.col("cigar") == "*", F.col("start")).otherwise(cigar.alignment_end("start", "cigar")))
    got = {r["i"]: r for r in filters.clean_alignments(reads, contigs).collect()}
    assert [got[i]["cigar"] for i in range(len(cases))] == list(cases.values())
    assert all(got[i]["end_pos"] <= 100 for i in range(len(cases)))
    assert got[50]["cigar"] == "3H25S" and got[51]["cigar"] == "*" and got[51]["mapq"] == 0


def test_spliced_reads_cover_their_blocks_only(spark):
    reads = spark.createDataFrame([read("a", 1, 1, "10M100N10M"), read("b", 1, 5, "5M2D5M")], READ)
    depth = {r["pos"]: r["depth"] for r in pileup.depth(reads).collect()}
    assert depth == {p: 1 + (p in range(5, 10)) for p in [*range(1, 11), *range(111, 121), *range(12, 17)]} | {}
    exons = spark.createDataFrame([(1, 0, 1, 4), (2, 0, 50, 60), (3, 0, 300, 310)], "exon_id long, contig_idx long, start long, end_pos long")
    one = spark.createDataFrame([read("a", 1, 1, "10M100N10M")], READ)
    assert {r["exon_id"]: r["n"] for r in features.count_features(one, exons).collect()} == {1: 1, 2: 0, 3: 0}


def test_depth_comes_from_the_ends_of_reads(spark, monkeypatch):
    def never(*_, **__):
        raise AssertionError("reads are exploded")

    monkeypatch.setattr(pileup, "explode_positions", never)
    rows = [(0, 16_380, 16_390), (0, 16_380, 16_384), (0, 16_383, 16_383), (0, 32_768, 32_767), (1, 1, 40_000), (1, 5, 5), (None, 7, 8), (2, -3, 2)] * 3
    reads = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "read_id long, contig_idx long, start long, end_pos long").repartition(3)
    got = {(r["contig_idx"], r["pos"]): r["depth"] for r in pileup.depth(reads).collect()}
    want = Counter((c, p) for c, a, b in rows for p in range(a, b + 1))
    assert got == want and pileup.depth(reads).count() == len(want)


def test_reads_without_reference_are_an_error(spark):
    cells = spark.createDataFrame([(0, 0, "A" * 99)], "contig_idx long, cell long, seq string")
    with pytest.raises(Exception, match="no reference sequence for contig 3"):
        sequence.read_bases(spark.createDataFrame([read("a", 1, 1, contig=3)], READ), cells, width=100).collect()


def test_chain_reads_primary_alignments_only(spark):
    flags = (0, 0x100, 0x200, 0x800, 16)
    kept = filters.primary_reads(spark.createDataFrame([read(str(f), 1, 1, flag=f) for f in flags], READ)).collect()
    assert sorted(r["flag"] for r in kept) == [0, 16]


def test_regions_of_equal_contigs_fit_after_retries(spark):
    contigs = spark.createDataFrame([(i, 100) for i in range(50)], "contig_idx long, length long")
    for n in (1, 2, 3):
        assert regions.plan_regions_uniform(contigs, n, retry=True).select("region_key").distinct().count() <= n


def test_load_plan_does_not_depend_on_the_scan(spark):
    bins = spark.createDataFrame([(c, 1 + 10**6 * b, 10**6 * (b + 1), 5 + (b + c) % 3) for c in range(2) for b in range(100)], "contig_idx long, start long, end_pos long, reads long")
    contigs = spark.createDataFrame([(c, 10**8) for c in range(2)], "contig_idx long, length long")
    plans = [sorted(map(tuple, regions.plan_regions_by_load(bins, contigs, 9, scan_rows=s).collect())) for s in (100, 10**6, 10**9)]
    assert plans[0] == plans[1] == plans[2]


@pytest.mark.parametrize("seed", range(3))
def test_plans_equal_greedy_walks(spark, seed):
    chance = random.Random(seed)
    lengths = [chance.choice([chance.randint(1, 40), chance.randint(1, 400), 15]) for _ in range(60)]
    contigs = spark.createDataFrame(list(enumerate(lengths)), "contig_idx long, length long")
    n = chance.randint(3, 40)
    target = max(1, sum(lengths) // n)

    key, size, want = 0, 0, []
    for c, length in enumerate(lengths):
        if length < target:
            want.append((key, c, 1, length))
            size += length
            if 5 * size > target:
                key, size = key + 1, 0
    got = sorted(map(tuple, regions.plan_regions_uniform(contigs, n).collect()))
    assert [r for r in got if lengths[r[1]] < target] == want
    assert sorted((c, p) for _, c, a, b in got for p in range(a, b + 1)) == [(c, p) for c, x in enumerate(lengths) for p in range(1, x + 1)]

    bins = [(c, 10 * b + 1, 10 * b + 10, chance.choice([0, 1, 3, 50])) for c in range(6) if c != 2 for b in range(30) if chance.random() < 0.7]
    sizes = spark.createDataFrame([(c, 301) for c in range(6)], "contig_idx long, length long")
    rows = spark.createDataFrame([*bins, (99, 1, 10, 1000)], "contig_idx long, start long, end_pos long, reads long")
    most = max(1, sum(b[3] for b in bins) // n)
    key, load, want = 0, 0, {}
    for i, (c, start, reads) in enumerate(sorted([b[:2] + b[3:] for b in bins] + [(2, 1, 0)])):
        if i and load + reads > most:
            key, load = key + 1, 0
        load += reads
        first, many = want.get((key, c), (start, 0))
        want[key, c] = first, many + reads
    got = {(r["region_key"], r["contig_idx"]): r for r in regions.plan_regions_by_load(rows, sizes, n).collect()}
    assert {k: r["reads"] for k, r in got.items()} == {k: m for k, (_, m) in want.items()}
    for c in range(6):
        spans = sorted((r["start"], r["end_pos"]) for k, r in got.items() if k[1] == c)
        assert spans[0][0] == 1 and spans[-1][1] == 301 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert [a for a, _ in spans][1:] == sorted(s for k, (s, _) in want.items() if k[1] == c)[1:]

    genes = sorted((c, s := chance.randint(1, 5000), s + chance.randint(1, 60)) for c in range(2) for _ in range(60))
    sizes = spark.createDataFrame([(c, 6000) for c in range(3)], "contig_idx long, length long")
    want, least = [], max(1, 18000 // n)
    for c in range(3):
        start, end = 1, None
        for _, a, b in [g for g in genes if g[0] == c]:
            if end is not None and end - start + 1 >= least and a >= end + 20:
                want.append((c, start, cut := end + (a - end) // 2))
                start, end = cut + 1, b
            else:
                end = max(b, end or 0)
        want.append((c, start, 6000))
    rows = spark.createDataFrame([*genes, (77, 1, 5)], "contig_idx long, start long, end_pos long")
    got = sorted(map(tuple, regions.plan_regions_by_genes(sizes, rows, n, min_gap=20).collect()))
    assert got == [(k, *w) for k, w in enumerate(want)]


def test_table_of_pieces_equals_that_of_bases(spark):
    chance = random.Random(8)
    text = lambda letters, n: "".join(chance.choice(letters) for _ in range(n))
    rows = []
    for i in range(500):
        m, gap, n = chance.randint(1, 12), chance.randint(1, 9), chance.randint(1, 12)
        cigar = chance.choice([f"{m + n}M", f"{m}M{gap}D{n}M", f"{m}M{gap}N{n}M", f"{m}S{n}M", f"{m}={n}X"])
        start = chance.randint(1, 80)
        rows.append((f"r{i}", chance.choice([*"abcdefghijkl", None]), chance.randint(0, 1), start, cigar, i % 2, 0, 60, text("ACGTNR", m + n), text("#5?I", m + n)))
    reads = spark.createDataFrame(rows, "read_id string, library string, contig_idx long, start long, cigar string, is_reverse int, is_unmapped int, mapq int, seq string, qual string")
    cells = spark.createDataFrame([(c, k, text("ACGTN", 16 - (k == 0))) for c in range(2) for k in range(10)], "contig_idx long, cell long, seq string")
    sites = spark.createDataFrame([(c, p) for c in range(2) for p in (3, 17, 40, 41, 42, 64)], "contig_idx long, pos long")
    for exclude in (None, sites):
        want = recalibrate.recalibration_table(sequence.read_bases(reads, cells, exclude, width=16))
        got = recalibrate.recalibration_table_of_pieces(sequence.read_pieces(reads.repartition(2), cells, exclude, width=16))
        order = lambda df: sorted(map(str, df.select("rg", "qual", "cycle", "context", "observations", "mismatches").collect()))
        assert order(got) == order(want)


def test_operators_are_placed_in_one_pass(spark):
    cigar_text = "3S" + "5M2I4D1N" * 2500 + "2S"
    df = spark.createDataFrame([(cigar_text,), ("*",), ("10M",)], "cigar string")
    rows = df.select(cigar.placed_operators("cigar").alias("o")).collect()
    assert len(rows[0]["o"]) == 10_002 and rows[1]["o"] == []
    assert tuple(rows[0]["o"][-1]) == (2, "S", 2500 * 10, 3 + 2500 * 7)


def test_multi_mapped_fragments_count_nowhere(spark):
    rows = [
        ("a/1", "a", 0, 10, 20, 0, 0, {}), ("a/1", "a", 0, 500, 510, 0, 0x100, {}),  # a secondary line far from exons
        ("b/1", "b", 0, 10, 20, 0, 0, {"NH": "2"}), ("c/1", "c", 0, 10, 20, 0, 16, {"NH": "1"}), ("c/2", "c", 0, 30, 40, 0, 0x800, {"NH": "x"}),
        ("d/1", "d", 0, 10, 20, 0, 0, {}), ("d/2", "d", 1, 1, 5, 0, 0, {"NH": "4"}),  # the mate says so
    ]
    reads = spark.createDataFrame(rows, "read_id string, template_id string, contig_idx long, start long, end_pos long, is_unmapped int, flag int, tags map<string,string>")
    exons = spark.createDataFrame([(1, 0, 5, 45)], "exon_id long, contig_idx long, start long, end_pos long")
    assert features.count_features(reads, exons).first()["n"] == 1
    assert features.count_features(reads, exons, multi="count").first()["n"] == 4
    assert features.count_features(reads.withColumn("nh", F.lit(1)).drop("tags", "flag"), exons).first()["n"] == 4
    with pytest.raises(ValueError, match="multi"):
        features.count_features(reads, exons, multi="best")


def test_mates_that_overlap_are_one_observation(spark):
    chance = random.Random(5)
    rows = []
    for t in range(60):
        for m in range(chance.randint(1, 3)):
            start, n = chance.randint(1, 30), chance.randint(1, 20)
            rows.append((f"{t}/{m}", f"t{t}", "L", chance.randint(0, 1), start, start + n - 1, f"{n}M", m % 2, 0, 60, "".join(chance.choice("AC") for _ in range(n)), "".join(chance.choice("#5I") for _ in range(n))))
    reads = spark.createDataFrame(rows, "read_id string, template_id string, library string, contig_idx long, start long, end_pos long, cigar string, is_reverse int, is_unmapped int, mapq int, seq string, qual string")
    cells = spark.createDataFrame([(c, k, "A" * (64 - (k == 0))) for c in range(2) for k in range(2)], "contig_idx long, cell long, seq string")
    keep = ("read_id", "template_id", "library", "contig_idx", "is_reverse", "mapq", "touching")
    marked = pileup.mark_touching(reads.repartition(3))
    got = sorted((r["template_id"], r["contig_idx"], r["pos"], r["base"], r["qual"]) for r in pileup.merge_fragments(sequence.read_bases(marked, cells, keep=keep, width=64)).collect())
    seen: dict[tuple, list] = {}
    for _, t, _, c, start, *_, seq, qual in rows:
        for o, (b, q) in enumerate(zip(seq, qual, strict=True)):
            seen.setdefault((t, c, start + o), []).append((b, ord(q) - 33))
    assert got == sorted((*k, v[0][0], max(q for _, q in v)) for k, v in seen.items() if len({b for b, _ in v}) == 1)
    assert any(len(v) > 1 for v in seen.values())


def test_chain_options_and_counters(spark):
    from locusflow.catalog import views as v

    sf = "/root/testdata/sf0.001"
    reads = v.with_sequence(v.read_records(spark, sf, 4000))
    cells, sites = v.reference_cells(spark, sf, pileup.PILEUP_BIN), v.known_sites(spark, sf).select("contig_idx", "pos")
    wide = spark.createDataFrame([(0, 1000, 1999), (3, 1, 50)], "contig_idx long, start long, end_pos long")
    exons = spark.createDataFrame([(1, 0, 1, 4200)], "exon_id long, contig_idx long, start long, end_pos long")
    full = dna.run_dna(reads, cells, sites, min_base_quality=10, call_conf=10, emit_conf=10)
    part = dna.run_dna(
        reads, cells, sites, min_base_quality=10, call_conf=10, emit_conf=10, targets=wide, exons=exons, remove_duplicates=True,
        read_group=filters.ReadGroup(), contigs=v.contigs(spark, sf),
    )
    inside = lambda r: any(c == r["contig_idx"] and a <= r["pos"] <= b for c, a, b in ((0, 1000, 1999), (3, 1, 50)))
    rows = full.variants.collect()
    got = part.variants.collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in rows if inside(r)) and 0 < len(got) < len(rows)
    assert part.counters["variants"].get["variants"] == len(got)
    kept = part.counters["filter_mapped"].get
    decided = part.counters["duplicates"].get
    assert (kept["reads_in"], kept["reads_out"]) == (reads.count(), decided["reads"])
    assert full.reads.filter("is_duplicate = 1").count() == decided["duplicates"] > 0
    assert part.reads.count() == decided["reads"] - decided["duplicates"] and "rg_id" in part.reads.columns
    assert part.counts.first()["n"] == part.reads.filter("contig_idx = 0").select("template_id").distinct().count()
    spans = {(r["contig_idx"], r["start"], r["end_pos"]) for r in part.islands.collect()}
    assert spans and all(any(c == x and a >= y and b <= z for x, y, z in ((0, 1000, 1999), (3, 1, 50))) for c, a, b in spans)


def test_recalibration_query_makes_no_base_rows(spark, monkeypatch):
    from locusflow.catalog import queries

    def exploded(*_, **__):
        raise AssertionError("bases became rows")

    monkeypatch.setattr(queries.pileup, "explode_positions", exploded)
    assert queries.QUERIES["recalibration_table"](spark, "/root/testdata/sf0.001").columns == ["rg", "qual", "cycle", "context", "observations", "mismatches"]


def _merged_pieces(spark):
    chance = random.Random(9)
    rows = []
    for t in range(80):
        for m in range(chance.randint(1, 3)):
            start, n = chance.randint(1, 30), chance.randint(2, 20)
            cigar = f"{n}M" if n < 6 else f"3M2D{n - 3}M"
            rows.append((f"{t}/{m}", t % 60, "L", chance.randint(0, 1), start, start + n - 1 + 2 * (n >= 6), cigar, m % 2, 0, chance.randint(10, 60), "".join(chance.choice("ACCN") for _ in range(n)), "".join(chance.choice("#5I") for _ in range(n))))
    reads = spark.createDataFrame(rows, "read_id string, template_id long, library string, contig_idx long, start long, end_pos long, cigar string, is_reverse int, is_unmapped int, mapq int, seq string, qual string")
    cells = spark.createDataFrame([(c, k, "ACGTN" * 3 + "A" * (k > 0)) for c in range(2) for k in range(5)], "contig_idx long, cell long, seq string")
    keep = ("read_id", "template_id", "library", "contig_idx", "is_reverse", "mapq", "touching")
    return sequence.read_pieces(pileup.mark_touching(reads.repartition(3)), cells, keep=keep, width=16)


def test_sums_of_pieces_equal_those_of_base_rows(spark, monkeypatch):
    from locusflow.operators import piece_sums

    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)
    pieces = materialize(_merged_pieces(spark))
    bases = pileup.merge_fragments(sequence.piece_bases(pieces))
    merged = materialize(piece_sums.merge_pieces(pieces))
    for held in (piece_sums.LOCI_HELD, 3):
        monkeypatch.setattr(piece_sums, "LOCI_HELD", held)
        assert rows(piece_sums.locus_sums(merged, likelihoods=False, masked=True)) == rows(pileup.pileup(bases))
        for strands in (False, True):
            strong = bases.filter(F.col("base").isin(*"ACGT") & F.col("ref_base").isin(*"ACGT") & (F.col("qual") >= 10))
            assert rows(piece_sums.locus_sums(merged, True, strands, 10, masked=True)) == rows(pileup.genotype_sums(strong, strands))


def test_chains_and_fragment_queries_make_no_base_rows(spark, monkeypatch):
    from locusflow.catalog import queries

    def exploded(*_, **__):
        raise AssertionError("bases became rows")

    for module in (sequence, dna):
        monkeypatch.setattr(module, "piece_bases", exploded, raising=False)
    for name in ("run_dna", "run_rna", "pileup_fragments", "call_snps_fragments"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_sums_of_pieces_with_two_reference_letters_at_a_place(spark):
    from locusflow.operators import piece_sums

    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)
    chance = random.Random(3)
    spots = [(c, lo, n) for c in range(2) for lo in (1, 5, 4090, 70_000, 10**9) for n in (3, 9, 0)] * 6
    text = lambda n, letters: "".join(chance.choice(letters) for _ in range(n))
    made = [(i, c, lo, lo + n - 1, lo, 0, text(n, "ACGTN"), text(n, "#5I~"), text(n, "ACN"), lo, None, i % 2, 60) for i, (c, lo, n) in enumerate(spots)]
    made.append((999, 0, 1, 9, 1, 0, "ACG", "5", "ACGTACGTA", 1, None, 0, 60))  # texts that end early
    kinds = "read_id long, contig_idx long, lo long, hi long, block_start long, skip long, seq string, qual string, ref string, ref_start long, sites string, is_reverse int, mapq int"
    pieces = spark.createDataFrame(made, kinds).coalesce(1)
    whole = pieces.filter("read_id < 999 AND hi >= lo")
    bases = sequence.piece_bases(whole)
    assert rows(piece_sums.locus_sums(whole, likelihoods=False)) == rows(pileup.pileup(bases))
    strong = bases.filter(F.col("base").isin(*"ACGT") & F.col("ref_base").isin(*"ACGT") & (F.col("qual") >= 10))
    assert rows(piece_sums.locus_sums(whole, True, True, 10)) == rows(pileup.genotype_sums(strong, True))
    depth = {r["pos"]: r["depth"] for r in piece_sums.locus_sums(pieces.filter("read_id = 999"), True, False, 0).collect()}
    assert depth == {1: 1}


def test_chains_do_not_write_the_reads_they_are_given(spark, monkeypatch):
    from locusflow.catalog import queries

    def written(df):
        assert "seq" not in df.columns or "template_id" not in df.columns
        return materialize(df)

    monkeypatch.setattr(queries, "materialize", written)
    for name in ("run_dna", "run_rna", "pileup_fragments", "call_snps_fragments"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns
