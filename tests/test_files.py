import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from locusflow.operators import pairs, pipe
from locusflow.sources import fastq, sam, sinks, tables, vcf

CONTIGS = "contig_idx long, contig string, length long"


def record(i, mate=1, length=20):
    # Quality lines start with the character that also starts a record.
    return f"@read{i}/{mate}\n{'ACGTA' * (length // 5)}\n+\n{'@' + 'I' * (length - 1)}\n"


@pytest.mark.parametrize("packing", ["plain", "gz", "bz2"])
def test_read_fastq(spark, tmp_path, packing):
    text = "".join(record(i) for i in range(500)) + "@cut\nACGT\n+\n"
    path = tmp_path / ("r.fastq" + ("" if packing == "plain" else f".{packing}"))
    data = text.encode()
    path.write_bytes({"plain": bytes, "gz": gzip.compress, "bz2": bz2.compress}[packing](data))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        reads = fastq.read_fastq(spark, [("s", str(path))])
        rows = reads.orderBy("ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # The record without a quality line is dropped.
    assert [(r["ordinal"], r["name"]) for r in rows] == [(i, f"read{i}/1") for i in range(500)]
    assert {(r["sample"], r["mate"], r["seq"], r["qual"]) for r in rows} == {("s", 1, "ACGTA" * 4, "@" + "I" * 19)}


def test_records_are_built_where_their_block_is_read(spark, tmp_path, monkeypatch):
    """Any block size gives the records of the whole file, and only the edges of blocks are left to be joined."""
    for f, n in enumerate((0, 1, 9, 31)):
        (tmp_path / f"f{f}.fq").write_text("".join(record(i, f, 5 + 5 * (i % 9)) for i in range(n)) + ("@cut\nAC" if f == 3 else ""))
    paths = [str(tmp_path / f"f{f}.fq") for f in range(4)]
    columns = ["record", "name", "seq", "qual"]
    want = sorted((i, f"read{i}/{f}", "ACGTA" * (1 + i % 9), "@" + "I" * (4 + 5 * (i % 9))) for f, n in enumerate((0, 1, 9, 31)) for i in range(n))
    written = []
    plain = fastq.materialize
    monkeypatch.setattr(fastq, "materialize", lambda df: written.append(plain(df)) or written[-1])
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for size in (25, 300, 10**6):
            written.clear()
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = fastq.fastq_records(spark, paths).select(columns)
            assert sorted(map(tuple, got.collect())) == want
            blocks, frames = written
            assert frames.filter("lines < 4").count() <= 2 * blocks.count()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        monkeypatch.setattr(fastq, "BLOCK_TABLE_BYTES", 0)
        assert sorted(map(tuple, fastq.fastq_records(spark, paths).select(columns).collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_paired_and_interleaved_files_agree(spark, tmp_path):
    (tmp_path / "r1.fq").write_text("".join(record(i, 1) for i in range(30)))
    (tmp_path / "r2.fq").write_text("".join(record(i, 2) for i in range(25)))
    (tmp_path / "both.fq").write_text("".join(record(i, 1) + record(i, 2) for i in range(25)))
    two = fastq.read_fastq(spark, [("s", str(tmp_path / "r1.fq"), str(tmp_path / "r2.fq"))])
    one = fastq.read_fastq(spark, [("s", str(tmp_path / "both.fq"))], interleaved=True)
    columns = ["sample", "ordinal", "mate", "name", "seq", "qual"]
    paired = pairs.pair_mates(two.filter("mate = 1"), two.filter("mate = 2"), check_names=True)
    assert paired.count() == 25  # The longer file is cut to the shorter.
    key = F.concat("name", F.lit("/"), "mate")
    split = pairs.interleave(paired.withColumn("name", F.regexp_replace("name", "/1$", ""))).withColumn("name", key)
    assert sorted(map(tuple, split.select(columns).collect())) == sorted(map(tuple, one.select(columns).collect()))


def test_pair_mates_checks_names(spark):
    schema = "sample string, ordinal long, name string, seq string, qual string"
    r1 = spark.createDataFrame([("s", 0, "a/1", "A", "I")], schema)
    r2 = spark.createDataFrame([("s", 0, "b/2", "A", "I")], schema)
    with pytest.raises(Exception, match="mates differ in name"):
        pairs.pair_mates(r1, r2, check_names=True).collect()


def test_write_chunks(spark, tmp_path):
    (tmp_path / "in.fq").write_text("".join(record(i, 1) + record(i, 2) for i in range(100)))
    reads = fastq.read_fastq(spark, [("s", str(tmp_path / "in.fq"))], interleaved=True)
    sizes = sinks.write_chunks(reads, str(tmp_path / "out"), target_bytes=1500).collect()
    largest_pair = len(record(99, 1) + record(99, 2))
    assert sum(s["reads"] for s in sizes) == 200
    assert len(sizes) > 5 and all(0 < s["bytes"] <= 1500 + largest_pair for s in sizes)
    parts = sorted((tmp_path / "out").glob("sample=s/chunk_id=*/*.gz"))
    assert len(parts) == len(sizes)
    text = "".join(
        gzip.decompress(p.read_bytes()).decode() for p in sorted(parts, key=lambda p: int(p.parent.name.split("=")[1]))
    )
    assert text == "".join(record(i, 1) + record(i, 2) for i in range(100))


def test_manifest(lines):
    got = fastq.parse_manifest(lines("a\tb", "c", "x\ty\tz", "")).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "b"), ("c", None)]


def test_read_dict(spark, tmp_path):
    (tmp_path / "d.dict").write_text("@HD\tVN:1.4\n@SQ\tSN:chr1\tLN:100\tM5:x\n@SQ\tSN:HLA:1\tLN:abc\n")
    got = sam.read_dict(spark, str(tmp_path / "d.dict")).orderBy("contig_idx").collect()
    assert list(map(tuple, got)) == [(0, "chr1", 100), (1, "HLA:1", 0)]


def test_read_sam(spark, tmp_path):
    good = "r1\t99\tchr1\t7\t30\t8M2I4M1D3M\t=\t37\t39\tTTAGATAAAGGATACTG\tIIIIIIIIIIIIIIIII\tRG:Z:lib\tXX:Z:a:b\tXX:Z:again"
    unmapped = "r2\t77\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII"
    bad = "r3\tno\tchr1\t7\t30\t3M\t=\t37\t39\tTTA\tIII"
    (tmp_path / "a.sam").write_text("\n".join(["@HD\tVN:1.6", good, unmapped, bad, "short\tline"]) + "\n")
    parsed = sam.read_sam(spark, str(tmp_path / "a.sam"))
    first = parsed.filter("qname = 'r1'").first()
    assert (first["pos"], first["tags"]) == (7, {"RG": "lib", "XX": "a:b"})
    rejected = sam.rejected_sam_lines(spark.read.text(str(tmp_path / "a.sam"))).collect()
    assert sorted(r["value"] for r in rejected) == [bad, "short\tline"]
    contigs = spark.createDataFrame([(0, "chr1", 100)], CONTIGS)
    rows = {r["template_id"]: r for r in sam.to_alignments(parsed, contigs).collect()}
    assert (rows["r1"]["end_pos"], rows["r1"]["mate_contig_idx"], rows["r1"]["library"], rows["r1"]["read_id"]) == (22, 0, "lib", "r1/1")
    assert (rows["r2"]["is_unmapped"], rows["r2"]["contig_idx"]) == (1, -1)


def test_vcf_round_trip_is_ordered(spark, tmp_path):
    contigs = spark.createDataFrame([(0, "chr1", 5000), (1, "chr2", 900)], CONTIGS)
    rows = [(i % 2, 1 + (i * 37) % 800, "A", "C", float(i), "PASS", "0/1", 5) for i in range(400)]
    calls = spark.createDataFrame(
        rows, "contig_idx long, pos long, ref string, alt string, qual double, filter string, gt string, depth int"
    )
    out = tmp_path / "shard.vcf"
    vcf.write_vcf(calls, str(out), contigs)
    text = [line for part in sorted(out.glob("part-*")) for line in part.read_text().splitlines()]
    assert text[0].startswith("##fileformat") and text[3].startswith("#CHROM")
    placed = [(line.split("\t")[0], int(line.split("\t")[1])) for line in text[4:]]
    assert placed == sorted(placed) and len(placed) == 400
    back = vcf.parse_vcf_lines(spark.read.text(str(out)))
    got = back.select("contig", "pos", "ref", "alt", "qual", "filter", "gt").collect()
    assert sorted(map(tuple, got)) == sorted((f"chr{r[0] + 1}", *r[1:7]) for r in rows)


def test_read_vcf_takes_only_vcf_files(spark, tmp_path):
    line = "chr1\t5\trs1\tA\tC,G\t.\t.\tDB;DP=7;DP=8\tGT:DP\t1/2:7\n"
    for name in ("a.vcf", "b.vcf", "b.vcf.idx"):
        (tmp_path / name).write_text("##x\n" + line)
    got = vcf.read_vcf(spark, str(tmp_path)).orderBy("shard").collect()
    assert [r["shard"] for r in got] == ["a.vcf", "b.vcf"]
    assert got[0]["info"] == {"DB": "true", "DP": "7"} and got[0]["qual"] is None and got[0]["gt"] == "1/2"


def test_interval_files(spark, tmp_path, lines):
    (tmp_path / "x.bed").write_text("track name=x\nchr1\t0\t10\nchr1\t20\t30\tname\n")
    assert sorted(map(tuple, tables.read_bed(spark, str(tmp_path / "x.bed")).collect())) == [("chr1", 1, 10), ("chr1", 21, 30)]
    rows = spark.createDataFrame([("chr1", 1, 10)], "contig string, start long, end_pos long")
    sinks.write_bed(rows, str(tmp_path / "out.bed"))
    assert list(map(tuple, tables.read_bed(spark, str(tmp_path / "out.bed")).collect())) == [("chr1", 1, 10)]
    gff = lines(
        "#c", 'chr1\ts\texon\t5\t9\t.\t+\t.\tgene_id "g1"; x "y";', "chr1\ts\tCDS\t5\t9\t.\t+\t.\tgene_id=g2",
        "chr1\ts\texon\t6\t9\t.\t-\t.\tID=e;Parent=t1",
    )
    assert sorted(map(tuple, tables.parse_gff_lines(gff).collect())) == [("chr1", 5, 9, "+", "g1"), ("chr1", 6, 9, "-", "t1")]
    assert tables.parse_bin_count_lines(lines("chr1:1-50\t7", "bad")).collect()[0]["reads"] == 7
    assert tables.parse_junction_lines(lines("chr1\t1\t9\t1\t1\t0\t3\t2\t30", "chr1\t1")).count() == 1


def test_read_reference(spark, tmp_path):
    one, two = "acgtn" * 31, "GGGTTTAA" * 9
    fold = lambda s: "\n".join(s[i : i + 10] for i in range(0, len(s), 10))
    (tmp_path / "g.fa").write_text(f">chr1 first\n{fold(one)}\n>chr2\n{fold(two)}\n")
    contigs = spark.createDataFrame([(0, "chr1", len(one)), (1, "chr2", len(two))], CONTIGS)
    cells = tables.read_reference(spark, str(tmp_path / "g.fa"), contigs, width=16).orderBy("contig_idx", "cell").collect()
    assert "".join(c["seq"] for c in cells if c["contig_idx"] == 0) == one.upper()
    assert "".join(c["seq"] for c in cells if c["contig_idx"] == 1) == two
    assert [len(c["seq"]) for c in cells][:2] == [15, 16]


def test_write_alignments(spark, tmp_path):
    rows = [(i, i % 3, i % 2, i, i + 9, int(i % 5 == 0)) for i in range(1, 40)]
    reads = spark.createDataFrame(
        rows, "read_id long, contig_idx long, mate_contig_idx long, start long, end_pos long, is_unmapped int"
    )
    sinks.write_alignments(reads, str(tmp_path / "out"), keep_cross_contig=False)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["read_id"] for r in back.collect()) == [r[0] for r in rows if not r[5] and r[1] == r[2]]


def test_pipe(spark):
    df = spark.range(5000).selectExpr("concat('v', id) AS value").repartition(3)
    out = pipe.pipe_partitions(df, ["sed", "s/^v/w/"])
    assert sorted(r["value"] for r in out.collect()) == sorted(f"w{i}" for i in range(5000))
    with pytest.raises(Exception, match="exited with 3"):
        pipe.pipe_partitions(df, ["sh", "-c", "cat >/dev/null; exit 3"]).collect()
    assert pipe.build_command("x", {"x": ["tool"]}, {"x": "-k 'a b'"}) == ["tool", "-k", "a b"]
    with pytest.raises(ValueError, match="unknown tool"):
        pipe.build_command("x", {"x": ["tool"]}, {"y": "-k"})


def test_pipe_keeps_carriage_returns(spark):
    df = spark.createDataFrame([("a\rb",), ("c\r",), ("",)], "value string").coalesce(1)
    assert [r["value"] for r in pipe.pipe_partitions(df, ["cat"]).collect()] == ["a\rb", "c\r", ""]


def test_vcf_keeps_header_info_format_and_samples(spark, tmp_path):
    body = ["c1\t5\tx\tA\tC\t7.00\tPASS\tDP=5;FS=1.5;DB\tGT:AD\t0/1:3,2\t1/1:0,9", "c1\t9\t.\tG\tT\t.\t.\t.\t.\t."]
    head = ["##fileformat=VCFv4.2", "##INFO=<ID=DP>", "##contig=<ID=c1,length=50>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.vcf").write_text("\n".join([*head, *body]) + "\n")
    (tmp_path / "in" / "b.vcf").write_text("##other\n#CHROM\n")
    contigs = spark.createDataFrame([(0, "c1", 50)], "contig_idx long, contig string, length long")
    found = vcf.read_vcf(spark, str(tmp_path / "in")).join(contigs.select("contig", "contig_idx"), "contig")
    assert found.orderBy("pos").first()["samples"] == ["0/1:3,2", "1/1:0,9"]
    vcf.write_vcf(found, str(tmp_path / "out"), contigs, header=vcf.read_vcf_header(spark, str(tmp_path / "in")))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines() == [*head, *body]


def test_libraries_come_from_the_header(spark, lines):
    header = lines("@RG\tID:a\tLB:one\tSM:s", "@RG\tID:b\tPL:X\tLB:one", "@SQ\tSN:c1\tLN:9")
    groups = {r["rg_id"]: (r["rg_lb"], r["rg_sm"], r["rg_pl"]) for r in sam.parse_read_groups(header).collect()}
    assert groups == {"a": ("one", "s", None), "b": ("one", None, "X")}
