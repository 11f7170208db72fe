"""Mixing sources to target weights by temperature (operator 4).  DataFrame functions only.

Weights are the sources' token shares raised to an exponent and normalised.  Exponent 1 keeps the natural mix, 0 gives
every source the same weight; the entropy falls and repetition of small sources lessens as it rises.  The exponent
is found by bisection.  A weight becomes passes over the source: whole passes take all of its blocks, in a new
permutation each, and the last pass takes blocks in permuted order until its budget is met.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from locusflow.llm.batches import broadcast_if_few
from locusflow.session import materialize

#: Blocks that a source is dealt over, and parts of the block in which its budget ends.
BLOCKS, PARTS = 512, 512
#: Exponents tried at once and rounds: the exponent is found to 1 / 16 ** 6.
WAYS, TURNS = 16, 6


def source_totals(docs: DataFrame, tokens: Column, source: str) -> DataFrame:
    """``__source, t, share``: tokens of each source and their share, a written table with one row per source.

    Null is a source of its own.  Sources without tokens are left out.  Sums are pre-aggregated in each task.
    """
    per = docs.select(F.col(f"`{source}`").alias("__source"), tokens.cast("long").alias("t")).groupBy("__source").agg(F.sum("t").alias("t"))
    per = materialize(per.filter("t > 0"))
    whole = per.agg(F.sum("t").alias("whole"))
    return materialize(per.join(F.broadcast(whole)).select("__source", "t", (F.col("t") / F.col("whole")).alias("share")))


def _least_exponent(totals: DataFrame, good: Callable[[Column], Column]) -> float:
    """The least exponent in [0, 1] that is ``good``, given that larger ones are; 1 if none below it is.

    ``good`` gets aggregates over sources: ``z`` the sum of share^a, ``s`` that of share^a ln(share), ``r`` the largest
    share^(a - 1), ``a`` itself and ``n`` sources.  Each round is one job over the totals.
    """
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        step = (high - low) / WAYS
        tried = totals.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(WAYS))))
        a = F.lit(low) + F.col("i") * F.lit(step)
        per = tried.select("i", a.alias("a"), "share").groupBy("i", "a").agg(
            F.sum(F.pow("share", F.col("a"))).alias("z"), F.sum(F.pow("share", F.col("a")) * F.log("share")).alias("s"),
            F.max(F.pow("share", F.col("a") - 1)).alias("r"), F.min(F.pow("share", F.col("a") - 1)).alias("q"), F.count(F.lit(1)).alias("n"),
        )
        first = per.filter(good).agg(F.min("i")).first()[0]
        if first is None:
            return 1.0
        if first == 0:
            return low
        low, high = low + (first - 1) * step, low + first * step
    return high


def exponent(totals: DataFrame, entropy: float | None = None, max_passes: float | None = None, budget: float | None = None) -> float:
    """The exponent in [0, 1] whose mix has the target ``entropy``, a share of the logarithm of the number of sources,
    raised where needed until no source is repeated more than ``max_passes`` times.

    A natural mix that is more even than the target stays (1); without a target the flattest mix is meant (0).
    Without a ``budget``, passes are counted with the least repeated source passed over once.
    """
    found = 0.0
    if entropy is not None:
        bits = F.log("z") - F.col("a") * F.col("s") / F.col("z")
        found = max(found, _least_exponent(totals, (bits <= F.lit(entropy) * F.log("n") + 1e-12)))
    if max_passes is not None:
        if budget is None:
            passes = F.col("r") / F.col("q")
        else:
            whole = totals.agg(F.sum("t")).first()[0] or 1
            passes = F.col("r") / F.col("z") * F.lit(budget / whole)
        found = max(found, _least_exponent(totals, passes <= F.lit(max_passes) + 1e-9))
    return found


def mix(docs: DataFrame, tokens: Column, entropy: float | None = None, max_passes: float | None = None, budget: float | None = None, source: str = "source", doc_id: str = "doc_id", seed: int = 7) -> DataFrame:
    """``docs`` mixed to target weights: every row as often as its blocks are taken, with ``mix_pass`` and ``mix_at``.

    ``tokens`` is the size of a row (a column expression; null counts as 0).  See :func:`exponent` for the targets.
    Without ``budget`` (in tokens) no row is lost: the least repeated source is passed over once.  Budgets are met up to
    the tokens of one part of a block per source, ``1 / (BLOCKS * PARTS)`` of it or one row.  ``mix_at`` in [0, 1) is the
    place of the row's block in its source's passes; reading all rows by it keeps the weights throughout.

    Blocks are dealt by a hash of ``doc_id`` and the seed.  Rows that repeat an id share its fate; null ids are one
    id.  Null is a source of its own.  Rows of sources without tokens stay once, with ``mix_at`` 0.  Existing columns named
    ``mix_pass`` and ``mix_at`` are replaced.  An empty table returns no row.  Eager: it measures the sources.
    """
    size = F.coalesce(tokens.cast("long"), F.lit(0))
    totals = source_totals(docs, size, source)
    a = exponent(totals, entropy, max_passes, budget)
    sums = totals.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.min(F.pow("share", F.lit(a - 1))).alias("q"), F.sum("t").alias("whole"))
    # Passes over a source are share^(a - 1) times a factor that all sources have in common.
    common = 1 / F.col("q") if budget is None else F.lit(float(budget)) / (F.col("z") * F.col("whole"))
    want = totals.join(F.broadcast(sums)).select("__source", "t", F.round(F.pow("share", F.lit(a - 1)) * common, 9).alias("want"))

    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    block = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(BLOCKS)).cast("int")
    part = F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(PARTS)).cast("int")
    kept = [c for c in docs.columns if c not in ("mix_pass", "mix_at")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias("__source"), block.alias("__block"), part.alias("__part"), size.alias("__size"))

    blocks = materialize(rows.groupBy("__source", "__block").agg(F.sum("__size").alias("b")))
    turns = want.withColumn("mix_pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("want") - 1, F.lit(0)).cast("int"))))
    turn = turns.select(F.col("__source").alias("__s"), "t", "want", "mix_pass")
    shuffled = Window.partitionBy("__source", "mix_pass").orderBy(F.xxhash64("__block", "mix_pass", F.lit(seed + 2)), "__block")
    order = blocks.join(turn, F.col("__source").eqNullSafe(F.col("__s"))).withColumn("before", F.sum("b").over(shuffled) - F.col("b"))
    room = F.least(F.col("want") - F.col("mix_pass"), F.lit(1.0)) * F.col("t") - F.col("before")
    order = materialize(order.withColumn("room", F.round(room, 3)).filter("room > 0 OR b = 0").drop("__s"))
    at = ((F.col("mix_pass") + F.col("before") / F.col("t")) / F.col("want")).alias("mix_at")

    # In the block where a budget ends, parts are taken in permuted order while they fit; the first is taken if it begins inside.
    ending = order.filter("room < b").select(F.col("__source").alias("__s"), F.col("__block").alias("__b"), "mix_pass", "room")
    parts = rows.join(broadcast_if_few(ending.select("__s", "__b").distinct()), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")), "left_semi")
    parts = parts.groupBy("__source", "__block", "__part").agg(F.sum("__size").alias("p"))
    inside = Window.partitionBy("__source", "__block", "mix_pass").orderBy(F.xxhash64("__part", "mix_pass", F.lit(seed + 3)), "__part")
    cut = parts.join(ending, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")))
    cut = cut.withColumn("ends", F.sum("p").over(inside)).filter("ends <= room").groupBy("__s", "__b", "mix_pass").agg(F.collect_list("__part").alias("parts"))
    cut = cut.withColumnsRenamed({"__s": "__cs", "__b": "__cb", "mix_pass": "__cp"})
    plan = order.join(cut, F.col("__source").eqNullSafe(F.col("__cs")) & (F.col("__block") == F.col("__cb")) & (F.col("mix_pass") == F.col("__cp")), "left")
    none = F.array().cast("array<int>")
    taken = F.when(F.col("room") < F.col("b"), F.coalesce("parts", none)).alias("__parts")  # null: the whole block
    plan = materialize(plan.select(F.col("__source").alias("__ps"), F.col("__block").alias("__pb"), "mix_pass", at, taken))

    same = F.col("__source").eqNullSafe(F.col("__ps")) & (F.col("__block") == F.col("__pb"))
    mixed = rows.join(broadcast_if_few(plan), same).filter(F.col("__parts").isNull() | F.array_contains("__parts", F.col("__part")))
    out = mixed.select(*[F.col(f"`{c}`") for c in kept], "mix_pass", "mix_at")
    empty = rows.join(broadcast_if_few(totals.select(F.col("__source").alias("__ts"))), F.col("__source").eqNullSafe(F.col("__ts")), "left_anti")
    return out.unionByName(empty.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("mix_pass"), F.lit(0.0).alias("mix_at")))
