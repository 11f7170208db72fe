"""Interval joins, merging and filtering on 1-based inclusive coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from locusflow.operators.joins import fits_broadcast, spread_join
from locusflow.operators.scans import before, up_to
from locusflow.session import materialize

#: Gap up to which neighbouring reads belong to one covered island.
ISLAND_GAP = 51
#: Padding of islands when selecting known sites.
SITE_PAD = 301
#: Axis bin of the merging scan; a task sorts at most this many start positions.
SCAN_BIN = 16_384
#: Each level of join bins is so many times as wide as the one below; the widest spans any contig.
LEVEL_FACTOR, LONGEST_INTERVAL = 16, 1 << 33
#: Rows of one bin that travel in one array.
PACKED_ROWS = 4_096
#: Join bin when no width is given and the right side is empty.
JOIN_BIN = 1_024


def axis_bin(position: str, width: int) -> Column:
    """Bin of a position, declared never null: the optimizer then adds no null checks to one of two equal subplans."""
    return F.coalesce(F.expr(f"bigint({position}) div {width}"), F.lit(0).cast("long"))


def explode_bins(df: DataFrame, width: int, name: str = "bin", start: str = "start", end: str = "end_pos") -> DataFrame:
    """One copy of each interval per axis bin it touches; intervals that end before they start drop out."""
    return df.filter(F.col(end) >= F.col(start)).withColumn(
        name, F.explode(F.sequence(F.expr(f"bigint({start}) div {width}"), F.expr(f"bigint({end}) div {width}")))
    )


def median_bin_width(intervals: DataFrame) -> int:
    """Twice the median interval length, from one approximate aggregate."""
    length = F.col("end_pos") - F.col("start") + 1
    median = intervals.agg(F.percentile_approx(length, 0.5, 1000).alias("m")).first()["m"]
    return max(16, 2 * int(median)) if median else JOIN_BIN


def _widths(base: int) -> list[int]:
    """Bin widths of all levels, up to one that spans any contig."""
    widths = [base]
    while widths[-1] < LONGEST_INTERVAL:
        widths.append(widths[-1] * LEVEL_FACTOR)
    return widths


def _level(start: str, end: str, widths: list[int]) -> Column:
    """Lowest level whose bins are as wide as the interval is long."""
    length = F.col(end).cast("long") - F.col(start).cast("long") + 1
    level = F.lit(len(widths) - 1)
    for i in range(len(widths) - 2, -1, -1):
        level = F.when(length <= widths[i], F.lit(i)).otherwise(level)
    return level


def _levels_in_use(df: DataFrame, widths: list[int]) -> list[int]:
    """Levels at which intervals of ``df`` lie, from one aggregate; all levels of a stream."""
    if df.isStreaming:
        return list(range(len(widths)))
    return sorted(df.filter("end_pos >= start").agg(F.collect_set(_level("start", "end_pos", widths)).alias("l")).first()["l"])


def _explode_levels(
    df: DataFrame, widths: list[int], others: list[int], start: str, end: str, own: list[int] | None = None, mark: str = "__mark"
) -> DataFrame:
    """Copies of each interval in the bins it touches, two at most per level: at its own level, one of ``own`` (default: any),
    and at each higher one in ``others``.

    ``mark`` has bit 1 set in the copies at the interval's own level and bit 2 in those in the first bin it touches.
    """
    levels = sorted({*(range(len(widths)) if own is None else own), *others}) or [0]
    lies = _level(start, end, widths)
    wanted = [F.when((lies == i) | ((lies < i) & F.lit(i in others)), F.lit(i)) for i in levels]
    placed = df.filter(F.col(end) >= F.col(start))
    placed = placed.withColumn("__level", F.lit(levels[0]) if len(levels) == 1 else F.explode(F.array_compact(F.array(*wanted))))
    width = f"element_at(array({', '.join(f'{w}L' for w in widths)}), __level + 1)" if len(levels) > 1 else str(widths[levels[0]])
    first, last = (F.expr(f"bigint({c}) div {width}") for c in (start, end))
    placed = placed.withColumn("__bin", F.explode(F.sequence(first, last)))
    own_level = F.when(lies == F.col("__level"), 1).otherwise(0)
    return placed.withColumn(mark, own_level.bitwiseOR(F.when(F.col("__bin") == first, 2).otherwise(0)))


def _packed(right: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """``key, __lo, __hi, __rows``: the rows of each key as arrays of at most ``PACKED_ROWS``, in order of ``start``, and what each array spans."""
    number = F.row_number().over(Window.partitionBy(*key).orderBy(start)) - 1
    rows = F.collect_list(F.struct(*[c for c in right.columns if c not in key])).alias("__rows")
    parted = right.withColumn("__part", F.floor(number / F.lit(PACKED_ROWS)))
    return parted.groupBy(*key, "__part").agg(F.min(start).alias("__lo"), F.max(end).alias("__hi"), rows).drop("__part")


def interval_join(
    a: DataFrame,
    b: DataFrame,
    bin_width: int | None = None,
    prefix: str = "b_",
    salt_on: list[str] | None = None,
    broadcast_limit: int | None = None,
    **join_options,
) -> DataFrame:
    """All overlapping pairs of ``a`` and ``b`` (columns ``contig_idx, start, end_pos``).

    Both sides are cut into bins of several levels of width and joined on ``(contig,
    level, bin)``.  An interval lies at the level of its own length, where it touches two
    bins at most, and at the higher levels of the other side: a pair meets at the level of
    its longer member, in the first bin both touch.  So an interval of any length is
    copied a few times only, no ``distinct`` is needed, and the result does not depend on
    ``bin_width``, the width of the lowest level.  One aggregate over ``b`` finds that
    width, one over each side the levels in use.  The rows of ``b`` in a bin travel as
    arrays: an interval of ``a`` finds them by one look-up and runs along them, which
    takes a tenth of the time of a look-up for every pair.  Columns of ``b`` come out with
    ``prefix``.
    """
    widths = _widths(bin_width or median_bin_width(b))
    levels_a, levels_b = _levels_in_use(a, widths), _levels_in_use(b, widths)
    bs, be, key = f"{prefix}start", f"{prefix}end_pos", ["contig_idx", "__level", "__bin"]
    right = b.withColumnsRenamed({c: f"{prefix}{c}" for c in b.columns})
    right = _explode_levels(right, widths, levels_a, bs, be, levels_b, "__b_mark").withColumnRenamed(f"{prefix}contig_idx", "contig_idx")
    left = _explode_levels(a, widths, levels_b, "start", "end_pos", levels_a, "__a_mark")
    packed = _packed(right, key, bs, be)
    small = not a.isStreaming and fits_broadcast(right, broadcast_limit)
    packed = packed if a.isStreaming else packed.hint("broadcast" if small else "merge")
    met = spread_join(
        left, packed, key, "inner", (F.col("start") <= F.col("__hi")) & (F.col("__lo") <= F.col("end_pos")), salt_on,
        broadcast_limit=0, may_salt=not small, **join_options,
    )
    pairs = met.select(*a.columns, "__a_mark", F.inline("__rows"))
    # No copy lies below its own level or before its first bin: the longer member's level and the first shared bin are
    # those that one of the two has marked.
    here = F.col("__a_mark").bitwiseOR(F.col("__b_mark")) == 3
    overlap = (F.col("start") <= F.col(be)) & (F.col(bs) <= F.col("end_pos")) & here
    return pairs.filter(overlap).drop("__a_mark", "__b_mark")


def merge_intervals(df: DataFrame, gap: int = ISLAND_GAP, scan_bin: int = SCAN_BIN) -> DataFrame:
    """Islands ``(contig_idx, start, end_pos, n)``: join while ``start <= running end + gap``.

    Intervals with equal start collapse first (map-side), so copies and deep loci
    cost nothing later and a bin holds at most ``scan_bin`` rows.  Pieces of islands
    form inside bins.  A scan over one row per bin then tells each bin how far
    earlier bins reach and which island that reach belongs to; a piece within the
    reach joins that island, any other piece opens its own.
    """
    cell = ["contig_idx", "__bin"]
    starts = (
        df.filter(F.col("end_pos") >= F.col("start"))
        .groupBy("contig_idx", "start")
        .agg(F.max("end_pos").alias("end_pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("__bin", axis_bin("start", scan_bin))
        .withColumn("__reach", F.max("end_pos").over(before(cell, ["start"])))
    )

    def opens(start: str, reach: str) -> Column:
        return F.when(F.col(reach).isNull() | (F.col(start) > F.col(reach) + gap), F.col(start))

    pieces = (
        starts.withColumn("__open", opens("start", "__reach"))
        .withColumn("__piece", F.last("__open", ignorenulls=True).over(up_to(cell, ["start"])))
        .groupBy(*cell, "__piece")
        .agg(F.max("end_pos").alias("end_pos"), F.sum("n").alias("n"))
    )
    # The last piece of a bin is the only one whose island can continue in later bins
    # unless the reach from before covers it too.
    earlier = before(["contig_idx"], ["__bin"])
    # Counts are never zero: naming them keeps both uses of the pieces one plan, whose shuffle is shared.
    bins = (
        pieces.filter("n > 0")
        .groupBy(*cell)
        .agg(F.max("end_pos").alias("__end"), F.max("__piece").alias("__last"))
        .withColumn("__carry", F.max("__end").over(earlier))
        .withColumn("__from", F.last(opens("__last", "__carry"), ignorenulls=True).over(earlier))
        .select(*cell, "__carry", "__from")
    )
    island = F.coalesce(opens("__piece", "__carry"), F.col("__from"))
    return (
        pieces.join(bins, cell)
        .groupBy("contig_idx", island.alias("start"))
        .agg(F.max("end_pos").alias("end_pos"), F.sum("n").alias("n"))
    )


def pad_and_merge(islands: DataFrame, pad: int = SITE_PAD) -> DataFrame:
    """Move starts back by ``pad`` (not below 1) and merge while ``start < current end``."""
    padded = islands.select(
        "contig_idx", F.greatest(F.col("start") - pad, F.lit(1)).alias("start"), "end_pos"
    )
    return merge_intervals(padded, gap=-1)


def _segments(islands: DataFrame, scan_bin: int = SCAN_BIN) -> DataFrame:
    """Disjoint islands with ``__until``: the last position before the next island of the contig.

    The last island of a contig covers its start only; lookups are clamped to it.
    """
    binned = islands.select("contig_idx", "start", "end_pos", axis_bin("start", scan_bin).alias("__bin"))
    cell = ["contig_idx", "__bin"]
    firsts = binned.groupBy(*cell).agg(F.min("start").alias("__first"))
    following = firsts.select(
        *cell, F.lead("__first").over(Window.partitionBy("contig_idx").orderBy("__bin")).alias("__next_bin")
    )
    inside = F.lead("start").over(Window.partitionBy(*cell).orderBy("start"))
    return binned.join(following, cell).select(
        "contig_idx",
        F.col("start").alias("__seg_start"),
        F.col("end_pos").alias("__reach"),
        (F.coalesce(inside, "__next_bin", F.col("start") + 1) - 1).alias("__until"),
    )


def _with_reach(a: DataFrame, b: DataFrame, bin_width: int, **join_options) -> DataFrame:
    """``a`` plus ``__reach``: end of the last merged ``b`` island starting at or before ``a.end_pos``.

    Islands are disjoint, so ``a`` overlaps some island exactly when that end is at
    or after ``a.start``.  Each row of ``a`` is looked up in one bin and matches at
    most one segment, so it is never copied.  The islands are computed eagerly, once.
    """
    islands = materialize(merge_intervals(b, gap=0))
    tails = islands.groupBy("contig_idx").agg(F.max("start").alias("__tail"))
    segments = explode_bins(_segments(islands), bin_width, "__bin", "__seg_start", "__until")
    probed = spread_join(a, tails, ["contig_idx"], "left", **join_options).withColumn(
        "__probe", F.least("end_pos", F.coalesce("__tail", "end_pos"))
    )
    probed = probed.withColumn("__bin", F.expr(f"bigint(__probe) div {bin_width}"))
    within = (F.col("__seg_start") <= F.col("__probe")) & (F.col("__probe") <= F.col("__until"))
    looked_up = spread_join(probed, segments, ["contig_idx", "__bin"], "left", within, **join_options)
    return looked_up.drop("__tail", "__probe", "__bin", "__seg_start", "__until")


def interval_semi_join(a: DataFrame, b: DataFrame, bin_width: int = SCAN_BIN, **join_options) -> DataFrame:
    """Rows of ``a`` that overlap at least one row of ``b``, each once."""
    return _with_reach(a, b, bin_width, **join_options).filter(F.col("__reach") >= F.col("start")).drop("__reach")


def interval_anti_join(a: DataFrame, b: DataFrame, bin_width: int = SCAN_BIN, **join_options) -> DataFrame:
    """Rows of ``a`` that overlap no row of ``b``."""
    missed = F.col("__reach").isNull() | (F.col("__reach") < F.col("start"))
    return _with_reach(a, b, bin_width, **join_options).filter(missed).drop("__reach")


def point_join(points: DataFrame, islands: DataFrame, how: str, bin_width: int = JOIN_BIN, **join_options) -> DataFrame:
    """``left_semi`` / ``left_anti`` of points (``pos``) against disjoint intervals."""
    cells = explode_bins(
        islands.select("contig_idx", F.col("start").alias("__from"), F.col("end_pos").alias("__to")),
        bin_width, "__bin", "__from", "__to",
    )
    located = points.withColumn("__bin", F.expr(f"bigint(pos) div {bin_width}"))
    inside = (F.col("__from") <= F.col("pos")) & (F.col("pos") <= F.col("__to"))
    return spread_join(located, cells, ["contig_idx", "__bin"], how, inside, **join_options).drop("__bin")


def filter_intervals(targets: DataFrame, islands: DataFrame, **join_options) -> DataFrame:
    """Target intervals cut down to their covered parts; one row per target and island."""
    pairs = interval_join(targets, islands.select("contig_idx", "start", "end_pos"), **join_options)
    return pairs.withColumns(
        {"start": F.greatest("start", "b_start"), "end_pos": F.least("end_pos", "b_end_pos")}
    ).drop("b_start", "b_end_pos")


def filter_known_sites(sites: DataFrame, islands: DataFrame, pad: int = SITE_PAD, **join_options) -> DataFrame:
    """Known sites (``contig_idx, pos``) that fall in the padded, merged islands.

    Unordered; a writer sorts by range when order matters.  The padded islands are
    computed eagerly.
    """
    return point_join(sites, materialize(pad_and_merge(islands, pad)), "left_semi", **join_options)
