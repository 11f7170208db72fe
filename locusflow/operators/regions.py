"""Planning balanced genome regions and placing reads in them.

Plans are small tables: one row per region and contig, bounded by the sequence
dictionary plus the requested number of regions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from locusflow.operators.greedy import greedy_groups
from locusflow.operators.intervals import explode_bins, interval_join, merge_intervals
from locusflow.operators.joins import broadcast_if_small, fits_broadcast, spread_join
from locusflow.session import materialize

#: Short contigs share a region until they fill this fraction of the target length.
PACK_FACTOR = 5
#: Genes closer than this stay in one region.
GENE_SEPARATION = 100_000
#: Lookup cells per region side; wide because regions are long.
REGION_BIN = 65_536
#: Dictionary entries per stretch of the packing sum.
DICT_CELL = 65_536
#: Gene starts are numbered in stretches of so many bases.
GENE_CELL = 10_000_000
#: Each retry lowers the number of regions to this fraction; at most so many retries are planned in one go.
RETRY, TRIES = 0.95, 16


def _packed(lengths: DataFrame, total: int, tries: list[tuple[int, int]]) -> DataFrame:
    """Contigs under each try ``(number, target length)``: ``pieces``, and the ``pack`` of those shorter than the target.

    A pack takes contigs in dictionary order and closes once its length is above ``target / PACK_FACTOR``.
    """
    asked = F.explode(F.array(*[F.struct(F.lit(t).alias("try"), F.lit(n).cast("long").alias("target")) for t, n in tries])).alias("t")
    sized = lengths.select("*", asked).select("contig_idx", "length", "t.*").withColumn("cell", F.expr(f"contig_idx div {DICT_CELL}"))
    packs = greedy_groups(
        sized.filter("length < target"), ["try"], "cell", ["contig_idx"], "length",
        lambda before: (PACK_FACTOR * before, PACK_FACTOR * before + F.col("target")), "pack", PACK_FACTOR * total,
    )
    long_ones = sized.filter("length >= target").withColumn("pack", F.lit(None).cast("long"))
    pieces = F.when(F.col("pack").isNull(), F.ceil(F.col("length") / F.col("target"))).otherwise(1).cast("long")
    return packs.drop("cell").unionByName(long_ones.drop("cell")).withColumn("pieces", pieces)


def _may_fit(sizes: DataFrame, total: int, n: int) -> list[int]:
    """Steps of a retry among which the first that gives at most ``n`` keys is, and the last of them gives that for certain.

    ``sizes`` has the number ``c`` of contigs of each ``length``.  A pack, but for the last, is longer than a fifth of the target, and by
    no more than its last contig; so the packs of a step lie between two numbers that sums alone give.
    """
    steps: list[int] = []
    at = 0
    while True:
        targets = {s: max(1, math.floor(total / (n * RETRY**s))) for s in range(at, at + TRIES)}
        asked = F.explode(F.array(*[F.struct(F.lit(s).alias("try"), F.lit(t).cast("long").alias("target")) for s, t in targets.items()])).alias("t")
        short = F.col("length") < F.col("target")
        sums = sizes.select("length", "c", asked).select("length", "c", "t.*").groupBy("try").agg(
            F.sum(F.when(short, F.col("length") * F.col("c"))).alias("short"), F.max(F.when(short, F.col("length"))).alias("longest"),
            F.sum(F.when(~short, F.ceil(F.col("length") / F.col("target")) * F.col("c"))).alias("cut"),
        )
        found = {r["try"]: r for r in sums.collect()}
        for s, target in targets.items():
            row = found.get(s)
            cut = (row["cut"] or 0) if row else 0
            least = most = 0
            if row and row["longest"] is not None:
                least = -(-PACK_FACTOR * row["short"] // (target + PACK_FACTOR * row["longest"]))
                most = max(1, -(-PACK_FACTOR * row["short"] // target))
            if cut + least <= n:
                steps.append(s)
            if cut + most <= n:
                return steps
        at += TRIES


def plan_regions_uniform(contigs: DataFrame, n: int, retry: bool = False) -> DataFrame:
    """Regions ``(region_key, contig_idx, start, end_pos)`` of about ``total / n`` bases.

    Contigs shorter than the target are packed in dictionary order, greedily; longer ones are cut into equal pieces.
    Packed keys come first.  With ``retry`` the number asked for is lowered in steps of 5 % until at most ``n`` keys
    result; only steps that sums of lengths do not rule out are planned, a few at once, and one always fits, as in the end
    all contigs fit one pack.  Eager.
    """
    lengths = materialize(contigs.select("contig_idx", F.col("length").cast("long").alias("length")))
    sizes = materialize(lengths.groupBy("length").agg(F.count(F.lit(1)).alias("c")))
    total = sizes.agg(F.coalesce(F.sum(F.col("length") * F.col("c")), F.lit(0))).first()[0]
    left = _may_fit(sizes, total, n) if retry else [0]
    while True:
        steps, left = left[:TRIES], left[TRIES:]
        tried = materialize(_packed(lengths, total, [(s, max(1, math.floor(total / (n * RETRY**s)))) for s in steps]))
        packs = F.coalesce(F.max("pack") + 1, F.lit(0))
        keys = tried.groupBy("try").agg(packs.alias("packs"), F.sum(F.when(F.col("pack").isNull(), F.col("pieces"))).alias("cut"))
        found = {r["try"]: (r["packs"], r["packs"] + (r["cut"] or 0)) for r in keys.collect()}
        chosen = next((s for s in steps if not retry or found.get(s, (0, 0))[1] <= n), None)
        if chosen is not None:
            break
    kept = tried.filter(F.col("try") == chosen)
    one = F.lit(1).cast("long")
    short = kept.filter("pack IS NOT NULL").select(F.col("pack").alias("region_key"), "contig_idx", one.alias("start"), F.col("length").alias("end_pos"))
    # At most n contigs are as long as the target, so this window is small.
    earlier = Window.partitionBy().orderBy("contig_idx").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("pieces").over(earlier), F.lit(0)) + found.get(chosen, (0, 0))[0]
    long_ones = kept.filter("pack IS NULL").withColumn("first", first)
    cut = long_ones.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    size = F.floor(F.col("length") / F.col("pieces")) + 1
    cut = cut.select(
        (F.col("first") + F.col("piece")).alias("region_key"), "contig_idx",
        (1 + F.col("piece") * size).alias("start"), F.least((F.col("piece") + 1) * size, F.col("length")).alias("end_pos"),
    )
    return short.unionByName(cut).filter("start <= end_pos")


def plan_regions_by_genes(contigs: DataFrame, genes: DataFrame, n: int, min_gap: int = GENE_SEPARATION) -> DataFrame:
    """Regions of at least ``total / n`` bases whose borders lie midway between gene clusters.

    Genes closer than ``min_gap`` form one cluster and are never separated.  A region takes clusters until it reaches
    from its start to the last one's end over the target length, and ends midway to the next.  The first region of a
    contig starts with it and the last one ends with it; contigs without genes are one region, genes on unknown contigs
    are ignored.  Eager.
    """
    lengths = materialize(contigs.select("contig_idx", F.col("length").cast("long").alias("length")))
    total = lengths.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    target = max(1, total // n)
    clusters = merge_intervals(genes.select("contig_idx", "start", "end_pos"), gap=min_gap - 1).select("contig_idx", "start", "end_pos")
    clusters = materialize(clusters.join(broadcast_if_small(lengths.select("contig_idx")), "contig_idx", "left_semi"))
    # Where a region would start if this cluster were its first: midway from the cluster before.
    along = Window.partitionBy("contig_idx").orderBy("start")
    gap = F.floor((F.col("start") - F.lag("end_pos").over(along)) / 2)
    placed = clusters.withColumn("from", F.coalesce(F.lag("end_pos").over(along) + gap + 1, F.lit(1).cast("long")))
    placed = placed.withColumn("cell", F.expr(f"start div {GENE_CELL}"))
    # The region goes on while its length is below the target: up to and with the first cluster that ends beyond that.
    ends_before = F.coalesce(F.lag("end_pos").over(along), F.lit(0).cast("long"))
    grouped = greedy_groups(
        placed.withColumns({"reach": ends_before, "n": F.lit(1)}), ["contig_idx"], "cell", ["start"], "n",
        lambda _: (F.col("reach"), F.col("from") + target - 2), "group", total,
    )
    borders = grouped.groupBy("contig_idx", "group").agg(F.min("from").alias("start")).select("contig_idx", "start")
    starts = borders.unionByName(lengths.join(borders, "contig_idx", "left_anti").select("contig_idx", F.lit(1).cast("long").alias("start")))
    ordered = starts.join(broadcast_if_small(lengths), "contig_idx")
    region = ordered.withColumn("end_pos", F.coalesce(F.lead("start").over(along) - 1, F.col("length")))
    # About n rows are numbered here.
    key = F.row_number().over(Window.partitionBy().orderBy("contig_idx", "start")) - 1
    return region.select(key.cast("long").alias("region_key"), "contig_idx", "start", "end_pos")


def bin_reads(reads: DataFrame, width: int) -> DataFrame:
    """Reads per axis bin of ``width`` bases: ``(contig_idx, start, end_pos, reads)``."""
    cell = F.expr(f"(bigint(start) - 1) div {width}")
    return (
        reads.groupBy("contig_idx", cell.alias("__b"))
        .agg(F.count(F.lit(1)).alias("reads"))
        .select(
            "contig_idx", (F.col("__b") * width + 1).alias("start"), ((F.col("__b") + 1) * width).alias("end_pos"), "reads"
        )
    )


def plan_regions_by_load(bin_counts: DataFrame, contigs: DataFrame, n: int, scan_rows: int = 10_000_000) -> DataFrame:
    """Regions holding at most about ``total / n`` reads: ``(region_key, contig_idx, start, end_pos, reads)``.

    A key takes bins in genome order until the next one would lift it above the target, also across contigs; a bin above
    the target has a key of its own.  Every position of every contig lies in one region: a region reaches to the next
    one's start, the first of a contig starts with it, the last one ends with it, and a contig without reads belongs to
    the key at its place.  Bins on unknown contigs are ignored.  Eager.
    """
    lengths = materialize(contigs.select("contig_idx", F.col("length").cast("long").alias("length")))
    known = broadcast_if_small(lengths)
    bins = bin_counts.select("contig_idx", F.col("start").cast("long").alias("start"), F.col("reads").cast("long").alias("reads"))
    bins = materialize(bins.join(known, "contig_idx").drop("length"))
    bare = lengths.join(bins.select("contig_idx").distinct(), "contig_idx", "left_anti")
    bins = bins.unionByName(bare.select("contig_idx", F.lit(1).cast("long").alias("start"), F.lit(0).cast("long").alias("reads")))
    total = bins.agg(F.coalesce(F.sum("reads"), F.lit(0))).first()[0]
    target = max(1, total // n)
    cells = bins.withColumns(
        {"all": F.lit(0), "cell": F.struct(F.col("contig_idx").cast("long"), F.expr(f"start div {scan_rows}"))}
    )
    keyed = greedy_groups(
        cells, ["all"], "cell", ["contig_idx", "start"], "reads",
        lambda before: (before + F.col("reads"), before + target), "region_key", total,
    )
    region = keyed.groupBy("region_key", "contig_idx").agg(F.min("start").alias("start"), F.sum("reads").alias("reads"))
    along = Window.partitionBy("contig_idx").orderBy("region_key")
    ends = F.coalesce(F.lead("start").over(along) - 1, F.col("length"))
    begins = F.when(F.lag("start").over(along).isNull(), 1).otherwise(F.col("start")).cast("long")
    return region.join(known, "contig_idx").select("region_key", "contig_idx", begins.alias("start"), ends.alias("end_pos"), "reads")


def rank_regions_by_load(regions: DataFrame, bin_counts: DataFrame, **join_options) -> DataFrame:
    """Regions renumbered by descending load, so that the heaviest come first.

    The load of a key sums the reads of every bin that overlaps one of its intervals.
    """
    pairs = interval_join(bin_counts, regions.select("region_key", "contig_idx", "start", "end_pos"), **join_options)
    loads = pairs.groupBy(F.col("b_region_key").alias("region_key")).agg(F.sum("reads").alias("load"))
    keys = regions.select("region_key").distinct().join(loads, "region_key", "left")
    ranked = keys.select(
        "region_key",
        F.coalesce("load", F.lit(0)).alias("load"),
        (
            F.row_number().over(Window.partitionBy().orderBy(F.coalesce("load", F.lit(0)).desc(), "region_key")) - 1
        ).cast("long").alias("rank"),
    )
    return regions.join(ranked, "region_key")


def _lookup(reads: DataFrame, cells: DataFrame, contig: str, position: Column, name: str, small: bool) -> DataFrame:
    """Add the region key of one position of every read; null outside all regions."""
    probe = reads.withColumns({"__p": position.cast("long"), "__c": F.col(contig)})
    probe = probe.withColumn("__cell", F.expr(f"__p div {REGION_BIN}"))
    table = cells.select(
        F.col("contig_idx").alias("__rc"), F.col("__bin").alias("__rb"),
        F.col("start").alias("__from"), F.col("end_pos").alias("__to"), F.col("region_key").alias(name),
    )
    test = (
        (F.col("__c") == F.col("__rc")) & (F.col("__cell") == F.col("__rb"))
        & (F.col("__from") <= F.col("__p")) & (F.col("__p") <= F.col("__to"))
    )
    side = F.broadcast(table) if small else table
    return probe.join(side, test, "left").drop("__p", "__c", "__cell", "__rc", "__rb", "__from", "__to")


def assign_regions(
    reads: DataFrame, regions: DataFrame, paired: bool = True, unknown: str = "error", broadcast_limit: int | None = None
) -> DataFrame:
    """Copies of each read, one per region that its ends or its mate touch.

    Adds ``region_key`` and ``is_owner`` (the region of the read's own start), so
    totals over owners count every read once.  Each position is looked up in a
    broadcast table of region cells, without a shuffle; keys are made distinct inside
    the row.  ``unknown='error'`` fails on a read whose start lies in no region,
    ``'drop'`` leaves it out.
    """
    # The plan is small and looked up once per position, so it is computed once.
    cells = materialize(explode_bins(regions.select("region_key", "contig_idx", "start", "end_pos"), REGION_BIN, "__bin"))
    small = fits_broadcast(cells, broadcast_limit)
    points = [("contig_idx", F.col("start"), "__k0"), ("contig_idx", F.col("end_pos"), "__k1")]
    if paired:
        # The mate's end is not in the record; its length is taken to be the read's own.
        points += [
            ("mate_contig_idx", F.col("mate_start"), "__k2"),
            ("mate_contig_idx", F.col("mate_start") + F.col("read_len"), "__k3"),
        ]
    found = reads
    for contig, position, name in points:
        found = _lookup(found, cells, contig, position, name, small)
    names = [name for _, _, name in points]
    if unknown == "error":
        message = F.concat(F.lit("no region for contig "), F.col("contig_idx").cast("string"))
        found = found.withColumn("__k0", F.coalesce("__k0", F.raise_error(message).cast("long")))
    else:
        found = found.filter(F.col("__k0").isNotNull())
    keys = F.array_distinct(F.array_compact(F.array(*names)))
    return (
        found.withColumn("region_key", F.explode(keys))
        .withColumn("is_owner", (F.col("region_key") == F.col("__k0")).cast("int"))
        .drop(*names)
    )


def count_reads_by_region(assigned: DataFrame, contigs: DataFrame | None = None, **join_options) -> DataFrame:
    """Reads per region with the label ``contig-region-lastPosition``."""
    last = F.max(F.struct("contig_idx", "start"))
    counted = assigned.groupBy("region_key").agg(F.count(F.lit(1)).alias("reads"), last.alias("__last"))
    flat = counted.select(
        "region_key", "reads", F.col("__last.contig_idx").alias("contig_idx"), F.col("__last.start").alias("last_start")
    )
    name = F.col("contig_idx").cast("string")
    if contigs is not None:
        flat = spread_join(flat, contigs.select("contig_idx", "contig"), ["contig_idx"], "left", **join_options)
        name = F.coalesce(F.col("contig"), name)
    label = F.concat_ws("-", name, F.col("region_key").cast("string"), F.col("last_start").cast("string"))
    return flat.select("region_key", "reads", label.alias("label"))


def region_sort(
    assigned: DataFrame, partitions: int | None = None, tie_break: tuple[str, ...] = ("read_id",)
) -> DataFrame:
    """Reads grouped by region and sorted by position inside every partition.

    Ranges of ``(region, contig, start, id)`` replace one task per region, so a region
    with very many reads continues in the next partition.
    """
    order = ["region_key", "contig_idx", "start", *tie_break]
    ranged = assigned.repartitionByRange(partitions, *order) if partitions else assigned.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def merge_sorted(reads: DataFrame, tie_break: tuple[str, ...] = ("read_id",)) -> DataFrame:
    """All reads in one global coordinate order, by a range shuffle."""
    return reads.orderBy("contig_idx", "start", *tie_break)
