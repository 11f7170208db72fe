"""CIGAR text as columns: parsing, reference span, clipped ends, splitting at introns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the SAM format: operators that consume the reference, the read, or clip.
REFERENCE_OPS = "MDN=X"
QUERY_OPS = "MIS=X"
CLIP_OPS = "SH"
#: Mapping quality that a spliced aligner gives unique reads, and its replacement.
UNIQUE_SPLICED_MAPQ, UNIQUE_MAPQ = 255, 60


def _lengths(cigar: Column, ops: str) -> Column:
    """Lengths of the operators in ``ops`` as an array."""
    return F.regexp_extract_all(cigar, F.lit(f"(\\d+)[{ops}]"), F.lit(1)).cast("array<bigint>")


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)


def running_sums(lengths: Column) -> Column:
    """Sum of the entries before each entry, as an array of equal length, in one pass."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("done"))
    step = lambda s, n: F.struct((s["sum"] + n).alias("sum"), F.concat(s["done"], F.array(s["sum"])).alias("done"))
    return F.aggregate(lengths, start, step, lambda s: s["done"])


def parse_cigar(cigar: str | Column) -> Column:
    """Array of ``struct(len, op)`` in order."""
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    tokens = F.regexp_extract_all(text, F.lit("(\\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(
        tokens,
        lambda t: F.struct(
            F.regexp_extract(t, "^(\\d+)", 1).cast("long").alias("len"), F.right(t, F.lit(1)).alias("op")
        ),
    )


def placed_operators(cigar: str | Column) -> Column:
    """Array of ``struct(len, op, ref, query)``: each operator with the reference and read bases consumed before it.

    One pass: the running sums are the state, and the text is cut into its operators once.
    """
    longs = "bigint"
    start = F.struct(F.lit(0).cast(longs).alias("ref"), F.lit(0).cast(longs).alias("query"), F.array().cast(f"array<struct<len:{longs},op:string,ref:{longs},query:{longs}>>").alias("done"))

    def step(state: Column, o: Column) -> Column:
        moves = lambda ops: F.when(o["op"].isin(*ops), o["len"]).otherwise(0)
        here = F.struct(o["len"].alias("len"), o["op"].alias("op"), state["ref"].alias("ref"), state["query"].alias("query"))
        return F.struct(
            (state["ref"] + moves(REFERENCE_OPS)).alias("ref"), (state["query"] + moves(QUERY_OPS)).alias("query"), F.concat(state["done"], F.array(here)).alias("done")
        )

    return F.aggregate(parse_cigar(cigar), start, step, lambda state: state["done"])


def reference_length(cigar: str | Column) -> Column:
    """Bases of the reference that the alignment spans."""
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    return _total(_lengths(text, REFERENCE_OPS))


def query_length(cigar: str | Column) -> Column:
    """Bases of the read that the CIGAR accounts for, soft clips included."""
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    return _total(_lengths(text, QUERY_OPS))


def alignment_end(start: str | Column, cigar: str | Column) -> Column:
    """Last reference position of the alignment."""
    first = F.col(start) if isinstance(start, str) else start
    return first + reference_length(cigar) - 1


def leading_clip(cigar: str | Column) -> Column:
    """Clipped bases before the first aligned one."""
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    return _total(_lengths(F.regexp_extract(text, f"^((?:\\d+[{CLIP_OPS}])+)", 1), CLIP_OPS))


def trailing_clip(cigar: str | Column) -> Column:
    """Clipped bases after the last aligned one."""
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    return _total(_lengths(F.regexp_extract(text, f"((?:\\d+[{CLIP_OPS}])+)$", 1), CLIP_OPS))


def unclipped_5p(start: str, end: str, cigar: str, is_reverse: str) -> Column:
    """Position of the first sequenced base, as if nothing had been clipped."""
    reverse = F.col(is_reverse).cast("int") == 1
    return F.when(reverse, F.col(end) + trailing_clip(cigar)).otherwise(F.col(start) - leading_clip(cigar))


def clip_cigar(cigar: str | Column, allowed: Column) -> Column:
    """The CIGAR with at most ``allowed`` bases of the reference; what lies beyond is soft-clipped.

    Insertions beyond count as clipped bases, deletions and introns there go.  An
    alignment without an aligned base left is one soft clip; hard clips stay.
    """
    text = F.col(cigar) if isinstance(cigar, str) else cigar
    placed = F.transform(placed_operators(text), lambda o, i: F.struct(o["op"].alias("op"), o["len"].alias("len"), o["ref"].alias("ref"), i.alias("i")))
    aligned = F.filter(placed, lambda o: o["op"].isin("M", "=", "X") & (o["ref"] < allowed))
    last = F.coalesce(F.array_max(F.transform(aligned, lambda o: o["i"])), F.lit(-1))
    kept = F.filter(placed, lambda o: (o["i"] <= last) | ((last < 0) & (o["op"] == "H") & (o["i"] == 0)))
    trimmed = F.transform(kept, lambda o: F.when(o["i"] == last, F.least(o["len"], allowed - o["ref"])).otherwise(o["len"]))
    used = F.aggregate(
        F.zip_with(kept, trimmed, lambda o, n: F.when(o["op"].isin(*QUERY_OPS), n).otherwise(0)), F.lit(0).cast("long"), lambda total, n: total + n
    )
    clipped = query_length(text) - used
    body = F.array_join(F.zip_with(kept, trimmed, lambda o, n: F.concat(n.cast("string"), o["op"])), "")
    tail = F.regexp_extract(text, "[MIDNSP=X](\\d+H)$", 1)
    return F.concat(body, F.when(clipped > 0, F.concat(clipped.cast("string"), F.lit("S"))).otherwise(""), tail)


def split_n_reads(reads: DataFrame, with_sequence: bool = False) -> DataFrame:
    """One row per stretch between introns (``N``), with its own ``start``, ``end_pos`` and ``cigar``.

    ``segment`` numbers the stretches; mapping quality 255 becomes 60.  With
    ``with_sequence`` the text columns ``seq`` and ``qual`` are cut too.
    """
    stretches = F.split("cigar", "\\d+N")
    introns = F.concat(F.array(F.lit(0).cast("long")), _lengths(F.col("cigar"), "N"))

    columns = {"__ref": F.transform(stretches, reference_length), "__introns": introns, "__cigars": stretches}
    if with_sequence:
        columns["__query"] = F.transform(stretches, query_length)
    prepared = reads.withColumns(columns)
    shifted = prepared.withColumns({"__shift": running_sums(F.col("__ref")), "__gap": running_sums(F.col("__introns"))})
    if with_sequence:
        shifted = shifted.withColumn("__skip", running_sums(F.col("__query")))
    pieces = shifted.select("*", F.posexplode("__cigars").alias("segment", "__cigar"))

    def at(column: str) -> Column:
        return F.get(F.col(column), F.col("segment"))

    # The introns before a stretch and the one it follows.
    begin = F.col("start") + at("__shift") + at("__gap") + at("__introns")
    changed = {
        "start": begin,
        "end_pos": begin + at("__ref") - 1,
        "cigar": F.col("__cigar"),
        "mapq": F.when(F.col("mapq") == UNIQUE_SPLICED_MAPQ, UNIQUE_MAPQ).otherwise(F.col("mapq")),
    }
    if with_sequence:
        first, count = (at("__skip") + 1).cast("int"), at("__query").cast("int")
        for name in ("seq", "qual"):
            changed[name] = F.substring(F.col(name), first, count)
    helpers = [c for c in pieces.columns if c.startswith("__")]
    return pieces.withColumns(changed).drop(*helpers)
