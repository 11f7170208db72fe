"""Running values over an ordered axis without putting the axis in one task.

The axis is cut into bins.  A window runs inside each bin, one row per bin is
carried across bins by a second window over bin summaries, and the two are
combined.  No task ever sorts more than one bin or one list of bin summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def before(group: Sequence[str], order: Sequence[str | Column]) -> Window:
    """Rows strictly before the current one."""
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def up_to(group: Sequence[str], order: Sequence[str | Column]) -> Window:
    """Rows up to and including the current one."""
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_into_bins(
    df: DataFrame, group: Sequence[str], bin_col: str, summary: Column, combine, name: str
) -> DataFrame:
    """Attach to each row of ``df`` the combination of ``summary`` over all earlier bins.

    ``combine`` is an aggregate such as ``F.sum`` or ``F.max``; the value is null
    in the first bin.  Per group the carrying window sees one row per bin.
    """
    bins = df.groupBy(*group, bin_col).agg(summary.alias("__s"))
    carried = bins.select(
        *group, bin_col, combine("__s").over(before(group, [bin_col])).alias(name)
    )
    return df.join(carried, [*group, bin_col])


def running_sum_before(
    df: DataFrame, group: Sequence[str], bin_col: str, order: Sequence[str], value: str | Sequence[str], name: str | Sequence[str]
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, in ``(bin, order)`` order; several values in one pass.

    Bins must be monotone in the order; ``(bin, order)`` must be a total order.
    """
    values, names = ([value], [name]) if isinstance(value, str) else (list(value), list(name))
    keys = [*group, bin_col]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"__carry{i}") for i, v in enumerate(values)])
    earlier = before(group, [bin_col])
    carried = totals.select(*keys, *[F.sum(f"__carry{i}").over(earlier).alias(f"__carry{i}") for i in range(len(values))])
    inside = before(keys, order)
    sums = [
        (F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.coalesce(f"__carry{i}", F.lit(0))).alias(n)
        for i, (v, n) in enumerate(zip(values, names, strict=True))
    ]
    return df.join(carried, keys).select(*[F.col(c) for c in df.columns if c not in names], *sums)
