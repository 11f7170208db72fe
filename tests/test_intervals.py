import random

import pytest
from pyspark.sql import functions as F

from locusflow.operators import intervals as I
from locusflow.operators.joins import spread_join

FALLBACK = {"broadcast_limit": 0, "rows_per_task": 40}


def make(spark, n, seed, span=3000, longest=120, contigs=3, hot=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        contig = 0 if hot and rng.random() < hot else rng.randrange(contigs)
        start = 500 if hot and contig == 0 and rng.random() < 0.8 else rng.randint(1, span)
        rows.append((i, contig, start, start + rng.randint(0, longest)))
    return rows, spark.createDataFrame(rows, "id long, contig_idx long, start long, end_pos long")


def overlaps(a, b):
    return a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]


def brute_islands(rows, gap):
    out = []
    for _, contig, start, end in sorted(rows, key=lambda r: r[1:]):
        if out and out[-1][0] == contig and start <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], end)
            out[-1][3] += 1
        else:
            out.append([contig, start, end, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("options", [{}, FALLBACK])
@pytest.mark.parametrize("width", [None, 16, 257, 5000])
def test_interval_join_is_independent_of_bins_and_strategy(spark, options, width):
    a_rows, a = make(spark, 300, 1, hot=0.4)
    b_rows, b = make(spark, 60, 2, longest=900)
    got = I.interval_join(a, b, bin_width=width, **options).select("id", "b_id").collect()
    assert sorted(map(tuple, got)) == sorted((x[0], y[0]) for x in a_rows for y in b_rows if overlaps(x, y))


@pytest.mark.parametrize("options", [{}, FALLBACK])
@pytest.mark.parametrize("width", [8, 100_000])
def test_semi_and_anti_join(spark, options, width):
    a_rows, a = make(spark, 400, 3, longest=700, contigs=4)
    b_rows, b = make(spark, 25, 4, span=2500, longest=60)
    hit = {x[0] for x in a_rows if any(overlaps(x, y) for y in b_rows)}
    semi = [r["id"] for r in I.interval_semi_join(a, b, width, **options).collect()]
    anti = [r["id"] for r in I.interval_anti_join(a, b, width, **options).collect()]
    assert sorted(semi) == sorted(hit)
    assert sorted(anti) == sorted({x[0] for x in a_rows} - hit)


@pytest.mark.parametrize("gap", [-1, 0, 51])
@pytest.mark.parametrize("scan_bin", [32, 16_384])
def test_merge_intervals(spark, gap, scan_bin):
    rows, df = make(spark, 250, 5, span=20_000, longest=300)
    rows = [(i, c, s, e + 1) for i, c, s, e in rows]
    df = df.withColumn("end_pos", F.col("end_pos") + 1)
    got = I.merge_intervals(df, gap, scan_bin).select("contig_idx", "start", "end_pos", "n").collect()
    assert sorted(map(tuple, got)) == brute_islands(rows, gap)


def test_merge_edges(spark):
    rows = [(0, 10, 20), (0, 71, 80), (0, 132, 140), (1, 141, 150), (1, 5, 4), (2, 1, 1000), (2, 5, 6), (2, 1051, 1060)]
    df = spark.createDataFrame(rows, "contig_idx long, start long, end_pos long")
    got = sorted(map(tuple, I.merge_intervals(df).collect()))
    # 51 apart joins, 52 apart does not; an interval that ends before it starts drops out; nested ones vanish.
    assert got == [(0, 10, 80, 2), (0, 132, 140, 1), (1, 141, 150, 1), (2, 1, 1060, 3)]


def test_pad_and_merge(spark):
    df = spark.createDataFrame([(0, 100, 200), (0, 500, 600), (0, 902, 950)], "contig_idx long, start long, end_pos long")
    assert sorted(map(tuple, I.pad_and_merge(df).select("start", "end_pos").collect())) == [(1, 600), (601, 950)]


def test_filter_intervals_clips_and_empty_input_gives_nothing(spark):
    targets = spark.createDataFrame([("a", 0, 10, 50), ("b", 0, 90, 95)], "id string, contig_idx long, start long, end_pos long")
    covered = spark.createDataFrame([(0, 1, 20), (0, 40, 60)], "contig_idx long, start long, end_pos long")
    got = I.filter_intervals(targets, covered).select("id", "start", "end_pos").collect()
    assert sorted(map(tuple, got)) == [("a", 10, 20), ("a", 40, 50)]
    assert I.filter_intervals(targets, covered.filter("contig_idx > 5")).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    # Nine in ten left rows share one key and are copies of one another.
    left = spark.range(2000).select((F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99)).alias("k"))
    right = spark.createDataFrame([(99, "x"), (99, "y"), (1, "z")], "k long, tag string")
    plain = left.join(right, "k", how)
    salted = spread_join(left, right, ["k"], how, broadcast_limit=0, rows_per_task=50)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(4000).withColumn("k", F.lit(1).cast("long"))
    right = spark.createDataFrame([(1, "x")], "k long, tag string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(left, right, ["k"], broadcast_limit=0, rows_per_task=100)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(s["count"] for s in sizes) == 4000 and len(sizes) > 1


@pytest.mark.parametrize("options", [{}, FALLBACK])
def test_interval_join_of_short_and_huge_intervals(spark, options):
    rng, schema = random.Random(5), "id long, contig_idx long, start long, end_pos long"

    def some(n, base):
        spans = [rng.choice([50, 50, 50, 400, 30_000, 10_000_000, 250_000_000]) for _ in range(n)]
        return [(base + i, i % 2, s := rng.randint(1, 3 * 10**8), s + span - rng.randint(0, 40)) for i, span in enumerate(spans)]

    a_rows, b_rows = some(300, 0), some(80, 1000)
    a_rows += [(2000, 0, 5, 4), (2001, 0, b_rows[0][2], b_rows[0][2])]
    a, b = spark.createDataFrame(a_rows, schema), spark.createDataFrame(b_rows, schema)
    got = I.interval_join(a, b, **options).select("id", "b_id").collect()
    assert sorted(map(tuple, got)) == sorted((x[0], y[0]) for x in a_rows for y in b_rows if overlaps(x, y) and x[3] >= x[2])
    widths = I._widths(100)
    copies = I._explode_levels(a, widths, list(range(len(widths))), "start", "end_pos").groupBy("id").count()
    assert copies.agg(F.max("count")).first()[0] <= 2 * len(widths)


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}])
def test_interval_join_looks_bins_up_once(spark, monkeypatch, options):
    seen = []

    def watched(left, right, *rest, **kept):
        seen.append((left.count(), right.count()))
        return spread_join(left, right, *rest, **kept)

    monkeypatch.setattr(I, "spread_join", watched)
    monkeypatch.setattr(I, "PACKED_ROWS", 100, raising=False)
    # Three hundred intervals inside one bin, and one elsewhere; the last two of the other side are in no bin of theirs.
    b_rows = [(i, 1, 1005 + i % 40, 1010 + i % 50) for i in range(300)] + [(300, 2, 70, 90), (301, None, 5, 9)]
    a_rows = [(i, 1, 1000 + i, 1003 + i) for i in range(60)] + [(60, 2, 85, 95), (61, 3, 85, 95), (62, None, 5, 9)]
    a, b = (spark.createDataFrame(rows, "id long, contig_idx long, start long, end_pos long") for rows in (a_rows, b_rows))
    got = I.interval_join(a, b, bin_width=1000, **options)
    assert got.columns == ["id", "contig_idx", "start", "end_pos", "b_id", "b_start", "b_end_pos"]
    pairs = sorted((x[0], y[0]) for x in a_rows for y in b_rows if None not in (x[1], y[1]) and overlaps(x, y))
    assert sorted((r["id"], r["b_id"]) for r in got.collect()) == pairs
    assert seen == [(len(a_rows), 5)]  # one copy of each interval, and the bins of the other side in arrays of 100


@pytest.mark.parametrize("ambiguous", ["drop", "count"])
def test_features_counted_without_pairs_of_reads_and_exons(spark, monkeypatch, ambiguous):
    from locusflow.operators import features

    made = []

    def watched(a, b, **options):
        pairs = I.interval_join(a, b, **options)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(features, "interval_join", watched)
    # Two hundred exons on one place, a lone one, one long one around another, and one without reads.
    spots = [(i, 1, 1000, 1100 + i) for i in range(200)] + [(200, 1, 5000, 5100), (201, 2, 1, 90_000), (202, 2, 40_000, 40_100), (203, 3, 1, 50)]
    exons = spark.createDataFrame(spots, "exon_id long, contig_idx long, start long, end_pos long")
    # Templates of three reads: apart inside one exon, overlapping, and on two exons.
    places = [(t, 1, 1000 + t % 50 + 40 * m) for t in range(60) for m in range(3)] + [(60, 1, 5010), (60, 1, 5060), (61, 2, 100), (61, 2, 300), (62, 2, 39_990), (62, 1, 5090)]
    rows = [(i, t, c, s, s + 19, 0) for i, (t, c, s) in enumerate(places)]
    reads = spark.createDataFrame(rows, "read_id long, template_id long, contig_idx long, start long, end_pos long, is_unmapped int")
    touched = {(t, x) for _, t, c, s, e, _ in rows for x, xc, xs, xe in spots if xc == c and xs <= e and s <= xe}
    several = {t for t, _ in touched if sum(1 for u, _ in touched if u == t) > 1}
    expected = {x: sum(1 for t, y in touched if y == x and (ambiguous == "count" or t not in several)) for x, *_ in spots}
    found = {r["exon_id"]: r["n"] for r in features.count_features(reads, exons, ambiguous=ambiguous).collect()}
    assert found == expected
    assert sum(made) <= 3 * len(rows)


@pytest.mark.parametrize("ambiguous", ["drop", "count"])
def test_features_of_several_intervals_count_a_template_once(spark, ambiguous):
    from locusflow.operators.features import count_features

    exons = spark.createDataFrame([("a", 1, 100, 200), ("a", 1, 150, 250), ("a", 1, 400, 500), ("b", 1, 450, 600)], "exon_id string, contig_idx long, start long, end_pos long")
    reads = spark.createDataFrame(
        [(1, 1, 1, 190, 210, 0), (2, 1, 1, 410, 430, 0), (3, 2, 1, 440, 460, 0)],
        "read_id long, template_id long, contig_idx long, start long, end_pos long, is_unmapped int",
    )
    counts = sorted((r["exon_id"], r["start"], r["n"]) for r in count_features(reads, exons, ambiguous=ambiguous).collect())
    a, b = (1, 0) if ambiguous == "drop" else (2, 1)
    assert counts == [("a", 100, a), ("a", 150, a), ("a", 400, a), ("b", 450, b)]


def test_hot_keys_are_counted_by_buckets_first(spark):
    from locusflow.operators.joins import hot_keys

    df = spark.createDataFrame([(i % 50, 1) for i in range(500)] + [(None, 1)] * 95 + [(7, 1)] * 40, "k long, m int")
    counts = {(r["k"], r["m"]): r["__salts"] for r in hot_keys(df, ["k", "m"], 30).collect()}
    assert counts == {(None, 1): 4, (7, 1): 2}
    none = hot_keys(df, ["k", "m"], 500)
    assert none.columns == ["k", "m", "__salts"] and none.isEmpty()
    assert "Aggregate" not in none._jdf.queryExecution().optimizedPlan().toString()
