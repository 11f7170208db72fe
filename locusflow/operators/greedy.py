"""Greedy cuts of an ordered axis without a loop over its rows.

A greedy walk closes a group at the first row that meets a condition on running sums and starts the next one there.
Where the next group would start depends on the row at which this one starts, and on nothing else.  So every row gets a
pointer to that place, found for all rows at once by counting along the axis of running sums.  The rows that the walk
really reaches from the first one are found by doubling: each round joins the reached rows and the pointers with the
pointers, which then skip twice as many cuts.  A plan of ``c`` cuts takes ``log2(c)`` rounds of equi-joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from locusflow.operators.scans import running_sum_before
from locusflow.session import materialize

#: Stretches of the axis of sums that are counted on their own.
STRETCHES = 1024


def count_up_to(rows: DataFrame, group: Sequence[str], value: Column, bound: Column, name: str, span: int) -> DataFrame:
    """Add the number of rows of the group whose ``value`` is at most this row's ``bound``.

    Values and bounds are laid on one axis of about ``span`` units and counted along it, in stretches.
    """
    columns = [F.col(c) for c in rows.columns]
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in group else F.col(f.name) for f in rows.schema.fields]
    data = rows.select(*nulls, value.alias("__at"), F.lit(0).alias("__asks"), F.lit(1).alias("__one"))
    asked = rows.select(*columns, bound.alias("__at"), F.lit(1).alias("__asks"), F.lit(0).alias("__one"))
    both = data.unionByName(asked).withColumn("__cell", F.floor(F.col("__at") / max(1, span // STRETCHES)))
    counted = running_sum_before(both, group, "__cell", ["__at", "__asks"], "__one", name)
    return counted.filter("__asks = 1").select(*columns, F.col(name))


def _written(df: DataFrame) -> tuple[DataFrame, bool]:
    """The rows as a written table, and whether some seen row still points on."""
    watch = Observation()
    rows = materialize(df.observe(watch, F.max(F.col("seen") & F.col("to").isNotNull()).alias("on")))
    return rows, bool(watch.get["on"])


def reached(pointers: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group``, ``i``, ``seen``: whether a walk from row 0 of the group along ``to`` visits row ``i``.

    ``to`` is greater than ``i``; a walk ends where there is no row ``to``.  Eager: each round is a written table.
    """
    now, on = _written(pointers.select(*group, "i", "to", (F.col("i") == 0).alias("seen")))
    while on:
        # Rows seen so far lie fewer than 2**k cuts from the first one, and ``to`` skips 2**k.
        onward = now.select(*group, F.col("i").alias("to"), F.col("to").alias("__further"))
        hit = now.filter("seen").select(*group, F.col("to").alias("i"), F.lit(True).alias("__hit"))
        both = now.join(onward, [*group, "to"], "left").join(hit, [*group, "i"], "left")
        now, on = _written(both.select(*group, "i", F.col("__further").alias("to"), (F.col("seen") | F.col("__hit").isNotNull()).alias("seen")))
    return now.select(*group, "i", "seen")


def greedy_groups(
    rows: DataFrame, group: Sequence[str], cell: str, order: Sequence[str], weight: str, upto: Callable[[Column], tuple[Column, Column]], name: str, span: int
) -> DataFrame:
    """Number the greedy groups of every ``group`` from 0, in column ``name``.

    ``upto`` takes the sum of ``weight`` over the rows before and gives two columns, a value and a bound: a group that
    starts at a row holds the rows after it whose value is at most that row's bound.  Values must not fall along the
    order, which is ``(cell, *order)`` as in :func:`~locusflow.operators.scans.running_sum_before`; they lie on an axis
    of about ``span`` units.  Eager.
    """
    own = rows.withColumn("__one", F.lit(1).cast("long"))
    numbered = materialize(running_sum_before(own, group, cell, order, ["__one", weight], ["i", "__before"]).drop("__one"))
    value, bound = upto(F.col("__before"))
    lookup = numbered.select(*group, "i", value.alias("__value"), bound.alias("__bound"))
    found = count_up_to(lookup, group, F.col("__value"), F.col("__bound"), "__n", span)
    pointers = found.select(*group, "i", F.greatest(F.col("__n"), F.col("i") + 1).alias("to"))
    marked = numbered.join(reached(pointers, group), [*group, "i"]).withColumn("__cut", F.col("seen").cast("long"))
    before = running_sum_before(marked, group, cell, order, "__cut", name)
    return before.withColumn(name, F.col(name) + F.col("__cut") - 1).drop("__cut", "__before", "seen", "i")
