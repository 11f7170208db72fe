"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 3).

Equal vectors are one node.  A node keeps its nearest other nodes; the lists begin from runs of rows that lie together
under random projections, and then improve by joins of neighbours of neighbours: the members around every node are
compared with each other, and each takes over those nearer than its farthest neighbour.  Searches walk the finished
graph from the query's own node, best nodes first.  All of this works on the vectors as they are, in single precision
where that holds every component of the table and in double precision otherwise, so near copies of any fineness keep
their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from locusflow.llm.batches import rows_per_batch
from locusflow.llm.vectors import matrix, usable
from locusflow.session import materialize

#: Neighbours kept per node, reverse neighbours joined per node, rounds of NN-descent, and width of a search.
NEIGHBOURS, REVERSE, ROUNDS, BEAM = 24, 20, 4, 256
#: Projections that start the graph, bits of each, and rows compared together there.
STARTS, BITS, RUN_ROWS = 3, 16, 512
#: Nodes with all around them, and searches with all nodes met, handed to Python at once.
LISTS, SEARCHES = 256, 4
#: Pairs measured at once, and the share of the squared norms below which a product's distance is mostly rounding.
PAIRS, ROUNDING = 8192, 1e-6
_LIST = "array<struct<d:double,b:long>>"


def _codes(column: pa.Array, kind: str) -> np.ndarray:
    """Binary values of components of type ``kind`` as a matrix of doubles, short ones filled up with zeros."""
    rows = column.to_pylist()
    width = max(map(len, rows), default=0)
    flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), kind)
    return flat.reshape(len(rows), width // np.dtype(kind).itemsize).astype(np.float64)


def _exact(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the rows ``i`` from the rows ``j``, from their differences."""
    parts = [((rows[i[a : a + PAIRS]] - rows[j[a : a + PAIRS]]) ** 2).sum(1) for a in range(0, len(i), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _gaps(rows: np.ndarray) -> np.ndarray:
    """Squared distances between all rows, infinite to themselves.  Products give those of distant rows; near ones,
    where products cancel, are taken from differences."""
    norms = (rows**2).sum(1)
    sums = norms[:, None] + norms
    out = sums - 2 * (rows @ rows.T)
    i, j = np.nonzero(~(out > ROUNDING * sums))
    out[i, j] = _exact(rows, i, j)
    np.fill_diagonal(out, np.inf)
    return out


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, key, single`` of the rows that take part: ``key`` holds the components as doubles, ``single`` says
    whether single precision holds them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = usable(batch.column("embedding")) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            some = batch.take(pa.array(np.flatnonzero(good)))
            lists = some.column("embedding").cast(pa.list_(pa.float64()))
            flat = lists.flatten().to_numpy(zero_copy_only=False) + 0.0  # one form of zero
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            own = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            peak = np.array([np.abs(v).max(initial=0.0) for v in own])
            kept = np.flatnonzero(peak > 0)
            with np.errstate(over="ignore", under="ignore"):
                single = [bool((own[i].astype(np.float32) == own[i]).all()) for i in kept]
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id").take(pa.array(kept)), pa.array([own[i].tobytes() for i in kept], pa.binary()), pa.array(single, pa.bool_())],
                ["vec_id", "key", "single"],
            )

    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    found = plain.mapInArrow(run, "vec_id long, key binary, single boolean")
    return found.groupBy("vec_id").agg(F.min(F.struct("key", "single")).alias("v")).select("vec_id", "v.key", "v.single")


def _with_codes(nodes: DataFrame, kind: str) -> DataFrame:
    """Add ``code``: the components as numbers of type ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(k, np.float64).astype(kind).tobytes() for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "code"])

    return nodes.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in nodes.schema.fields)}, code binary")


def _start(nodes: DataFrame, seed: int, keep: int, kind: str) -> DataFrame:
    """``node, found``: nearest nodes within runs of rows sorted by the signs of random projections."""

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch.column("code"), kind)
            rng = np.random.default_rng(seed)
            # One draw per component, so that short vectors meet the same directions as long ones.
            lines = np.stack([rng.standard_normal(BITS) for _ in range(codes.shape[1])]) if codes.shape[1] else np.zeros((0, BITS))
            along = codes @ lines
            place = ((along > 0) @ (1 << np.arange(BITS)[::-1])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), pa.array(along.sum(1))], ["node", "code", "place", "along"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.RecordBatch) -> pa.RecordBatch:
            ids, codes = rows.column("node").to_numpy(), _codes(rows.column("code"), kind)
            gaps = _gaps(codes)
            k = min(keep, len(ids) - 1)
            best = np.argpartition(gaps, k - 1, 1)[:, :k] if k else np.zeros((len(ids), 0), np.int64)
            near = _exact(codes, np.repeat(np.arange(len(ids)), k), best.ravel())
            items = pa.StructArray.from_arrays([pa.array(near), pa.array(ids[best].ravel())], ["d", "b"])
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * k, pa.int32()), items)], ["node", "found"])

        for batch in batches:
            held.append(batch.select(["node", "code"]))
            while sum(b.num_rows for b in held) >= 2 * RUN_ROWS:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield flush(rows.slice(0, RUN_ROWS))
                held = [rows.slice(RUN_ROWS)]
        if held and sum(b.num_rows for b in held):
            yield flush(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    placed = nodes.select("node", "code").mapInArrow(signs, "node long, code binary, place long, along double")
    ordered = placed.repartitionByRange("place", "along", "node").sortWithinPartitions("place", "along", "node")
    return ordered.mapInArrow(compare, f"node long, found {_LIST}")


def _nearest(found: Column, keep: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(found)), 1, keep)


def _reverse(graph: DataFrame, most: int, seed: int) -> DataFrame:
    """``u, m``: up to ``most`` nodes ``m`` that have ``u`` in their list, chosen by hash."""
    pairs = graph.select(F.explode("near.b").alias("u"), F.col("node").alias("m"))
    order = Window.partitionBy("u").orderBy(F.xxhash64("m", F.lit(seed)), "m")
    return pairs.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= most).drop("__r")


def _around(graph: DataFrame, most: int, seed: int) -> DataFrame:
    """``u, m``: neighbours and some reverse neighbours of each node, each pair once."""
    ahead = graph.select(F.col("node").alias("u"), F.explode("near.b").alias("m"))
    return ahead.unionByName(_reverse(graph, most, seed)).dropDuplicates(["u", "m"])


def _join_locally(kind: str):
    """Compare the members around each node; a member takes those nearer than its farthest neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("around")
            ends, flat = lists.offsets.to_numpy(), lists.values
            members, limits = flat.field("m").to_numpy(), flat.field("limit").to_numpy()
            codes = _codes(flat.field("code"), kind)
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in zip(ends, ends[1:], strict=False):
                gaps = _gaps(codes[a:b])
                i, j = np.nonzero(gaps <= limits[a:b, None] * (1 + ROUNDING))
                other = i != j
                left.append(a + i[other])
                right.append(a + j[other])
            i, j = np.concatenate(left), np.concatenate(right)
            # The same pair comes up around many nodes: once per batch is enough.
            order = np.lexsort((members[j], members[i]))
            i, j = i[order], j[order]
            a, b = members[i], members[j]
            fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
            i, j = i[fresh], j[fresh]
            d = _exact(codes, i, j)
            nearer = d < limits[i]
            yield pa.RecordBatch.from_arrays([pa.array(members[i][nearer]), pa.array(members[j][nearer]), pa.array(d[nearer])], ["node", "b", "d"])

    return run


def build_graph(nodes: DataFrame, keep: int = NEIGHBOURS, reverse: int = REVERSE, rounds: int = ROUNDS, kind: str = "f8") -> DataFrame:
    """``node, code, near`` for the written table ``nodes`` (``node, code``): lists of ``(d, b)``, nearest first.

    Codes hold components of type ``kind``.

    Each round is one job that ends in a written table.  Hubs are cut to ``reverse`` reverse neighbours before any
    grouping, so a group has at most ``keep + reverse`` members.
    """
    starts = _start(nodes, 1, keep, kind)
    for seed in range(2, STARTS + 1):
        starts = starts.unionByName(_start(nodes, seed, keep, kind))
    lists = starts.groupBy("node").agg(_nearest(F.flatten(F.collect_list("found")), keep).alias("near"))
    graph = materialize(nodes.select("node", "code").join(lists, "node"))
    for turn in range(rounds):
        known = graph.select(F.col("node").alias("m"), "code", F.coalesce(F.try_element_at("near.d", F.lit(keep)), F.lit(float("inf"))).alias("limit"))
        around = _around(graph, reverse, turn).join(known, "m").groupBy("u").agg(F.collect_list(F.struct("m", "limit", "code")).alias("around"))
        offered = around.select("around").mapInArrow(_join_locally(kind), "node long, b long, d double").dropDuplicates(["node", "b"])
        order = Window.partitionBy("node").orderBy("d", "b")
        better = offered.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= keep).groupBy("node").agg(F.collect_list(F.struct("d", "b")).alias("found"))
        merged = F.when(F.col("found").isNull(), F.col("near")).otherwise(_nearest(F.concat("near", "found"), keep))
        with rows_per_batch(nodes.sparkSession, LISTS):
            graph = materialize(graph.join(better, "node", "left").select("node", "code", merged.alias("near")))
    return graph


def _advance(beam: int, kind: str):
    """Merge the nodes met in this round into every search's best ``beam``; their own turn is still to come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                best, met = one.column("best").flatten(), one.column("met").flatten()
                b0, d0 = best.field("b").to_numpy(), best.field("d").to_numpy()
                b1 = met.field("b").to_numpy()
                new = ~np.isin(b1, b0)
                b1, at = b1[new], np.arange(1, 1 + new.sum())
                codes = _codes(pa.concat_arrays([one.column("code"), met.field("code").filter(pa.array(new))]), kind)
                d1 = _exact(codes, np.zeros_like(at), at)
                b, d, done = np.concatenate([b0, b1]), np.concatenate([d0, d1]), np.arange(len(b0) + len(b1)) < len(b0)
                order = np.lexsort((b, d))[:beam]
                items = pa.StructArray.from_arrays([pa.array(d[order]), pa.array(b[order]), pa.array(done[order])], ["d", "b", "done"])
                yield pa.RecordBatch.from_arrays(
                    [one.column("q"), one.column("code"), pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), items)], ["q", "code", "best"]
                )

    return run


def search_graph(graph: DataFrame, asked: DataFrame, beam: int = BEAM, reverse: int = REVERSE, kind: str = "f8") -> DataFrame:
    """``q, b``: the ``beam`` nearest nodes met by a greedy walk from each node ``q`` in ``asked``, itself included.

    In each round a search opens those of its best nodes that it has not opened yet: their neighbours are joined, then
    their codes.  It ends when no new node is among the best.  All searches run side by side, one job per round.
    """
    near = materialize(_around(graph, reverse, ROUNDS).groupBy("u").agg(F.collect_list("m").alias("next")))
    codes = graph.select(F.col("node").alias("b"), "code")
    own = F.array(F.struct(F.lit(0.0).alias("d"), F.col("node").alias("b"), F.lit(False).alias("done")))
    state = materialize(graph.join(asked.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("q"), "code", own.alias("best")))
    while not state.filter(F.exists("best", lambda x: ~x["done"])).isEmpty():
        front = state.select("q", F.explode(F.filter("best", lambda x: ~x["done"])["b"]).alias("u"))
        reached = front.join(near, "u").select("q", F.explode("next").alias("b")).dropDuplicates(["q", "b"])
        met = reached.join(codes, "b").groupBy("q").agg(F.collect_list(F.struct("b", "code")).alias("met"))
        nothing = F.array().cast("array<struct<b:bigint,code:binary>>")
        step = state.join(met, "q", "left").select("q", "code", "best", F.coalesce("met", nothing).alias("met"))
        with rows_per_batch(graph.sparkSession, SEARCHES):
            state = materialize(step.mapInArrow(_advance(beam, kind), "q long, code binary, best array<struct<d:double,b:long,done:boolean>>"))
    return state.select("q", F.explode("best.b").alias("b"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = np.empty(batch.num_rows)
        for i, (a, b) in enumerate(zip(batch.column("key").to_pylist(), batch.column("other").to_pylist(), strict=True)):
            size = max(len(a), len(b))
            x, y = (np.frombuffer(v.ljust(size, b"\0"), np.float64) for v in (a, b))
            score[i] = np.sqrt(((x - y) ** 2).sum())
        yield pa.RecordBatch.from_arrays([batch.column("q"), pa.array(score), batch.column("members")], ["q", "score", "members"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, keep: int = NEIGHBOURS, reverse: int = REVERSE, rounds: int = ROUNDS, beam: int = BEAM) -> DataFrame:
    """Each query's ``k`` nearest rows found by Euclidean distance: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``.  Rows whose ``vec_id`` is null, or whose vector is null, zero, empty or
    holds null or non-finite components, take no part.  Rows that repeat a ``vec_id`` count once, by their smallest
    vector.  Vectors of unequal length are compared as if filled up with zeros.  Ties go to the smaller
    ``vec_id``.  Every row is in the graph; equal vectors share a node and all answer.  A query with fewer candidates gets
    all of them; an empty table gives no row.  Distances are exact; which rows are found is approximate, and a wider
    ``beam``, larger ``keep`` or more ``rounds`` find more.  Other columns are ignored.  Eager.
    """
    asks = vectors.filter(is_query).select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    clean = materialize(clean_vectors(vectors))
    # A vector carried by many rows keeps its smallest ids only: no answer needs more.
    few = Window.partitionBy("key").orderBy("vec_id")
    some = clean.withColumn("__r", F.row_number().over(few)).filter(F.col("__r") <= k + 1)
    grouped = some.groupBy("key").agg(F.min("vec_id").alias("node"), F.first("single").alias("single"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    plain = materialize(grouped)
    single = plain.agg(F.min("single")).first()[0]
    if single is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "f4" if single else "f8"
    nodes = materialize(_with_codes(plain.select("node", "key", "members"), kind))
    graph = build_graph(nodes.select("node", "code"), keep, reverse, rounds, kind)
    queries = materialize(clean.join(asks, "vec_id", "left_semi").join(plain.select("key", "node"), "key").select(F.col("vec_id").alias("query_id"), "node"))
    found = search_graph(graph, queries, beam, reverse, kind)
    pairs = found.join(nodes.select(F.col("node").alias("b"), F.col("key").alias("other"), "members"), "b")
    pairs = pairs.join(nodes.select(F.col("node").alias("q"), "key"), "q").select("q", "key", "other", "members")
    rows = pairs.mapInArrow(_measure, "q long, score double, members array<long>").select("q", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    best = rows.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k + 1).drop("__r")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = queries.join(best, F.col("node") == F.col("q")).filter("query_id <> vec_id").withColumn("rank", F.row_number().over(final))
    return answers.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
