"""Exact search for the largest inner products with ball trees (operator 5).

Vectors are dealt over coarse balls, and large balls over shards of one size; each task builds one ball tree per shard
and searches it by branch and bound.  The bound of a ball with centre c and radius r for a query q is q.c + |q| r.  Balls
are visited by falling bound and left out once their bound lies below the query's k-th score.  That score is shared:
the first round searches the most promising coarse ball of each query, the second the next ones, the last all others, and a
query is sent only to coarse balls whose bound reaches the k-th score of the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from locusflow.llm.vectors import matrix, usable, widened
from locusflow.session import materialize

#: Vectors per shard, queries per task and shard, and vectors per leaf.
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 65_536, 128
#: Queries searched at once inside a task.
QUERY_BATCH = 1024
#: Coarse balls at most, vectors and components of the sample that places them at most, balls searched in the first two rounds.
BALLS, SAMPLE_ROWS, SAMPLE_COMPONENTS, NEAR = 1024, 16_384, 4 << 20, 8
_HITS = "query_id long, vec_id long, score long"
_LONG = 2**63 - 1
_LARGEST = np.finfo(np.float64).max


class Tree(NamedTuple):
    """Balls in an array, children of ball i at ``kids[i]`` (0: a leaf over rows ``first[i]`` to ``last[i]``)."""

    rows: np.ndarray
    ids: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    kids: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _gaps(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances to the centre; infinite where double precision cannot hold them."""
    with np.errstate(over="ignore", invalid="ignore"):
        gaps = np.sqrt(((rows - centre) ** 2).sum(1))
    return np.where(np.isnan(gaps), np.inf, gaps)


def _bound(dots: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """No score of a ball lies above it: ``dots`` with its centre, ``reach`` its radius times the query's length.

    Rounding is covered; what overflowed bounds nothing.  Scores stop at the least long, and so does the bound.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        high = dots + reach * (1 + 1e-9) + 1e-9 * (1 + np.abs(dots) + reach)
    return np.maximum(np.where(np.isnan(high), np.inf, high), -float(2**63))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact whatever their size, stopped at the ends of the long range.

    Double precision is exact below 2**53; queries that could go beyond with these rows take Python's integers.
    """
    with np.errstate(over="ignore"):
        largest = np.abs(queries).max(1, initial=0) * max(1.0, np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    plain = largest < 2**52
    out = np.empty((len(queries), len(rows)), np.int64)
    out[plain] = (queries[plain] @ rows.T).astype(np.int64)
    if not plain.all():
        whole = [[int(x) for x in row] for row in rows]
        for i in np.flatnonzero(~plain):
            own = [int(x) for x in queries[i]]
            out[i] = [min(max(sum(a * b for a, b in zip(own, row, strict=True)), -_LONG), _LONG) for row in whole]
    return out


def build(ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS) -> Tree:
    """Split rows at the median along the line between two far points, until a ball holds ``leaf`` rows."""
    order = np.arange(len(rows))
    centres, radii, kids, first, last = [], [], [], [], []

    def ball(a: int, b: int) -> int:
        own = rows[order[a:b]]
        centre = own.mean(0) if b > a else np.zeros(rows.shape[1])
        gaps = _gaps(own, centre)
        centres.append(centre)
        radii.append(gaps.max(initial=0.0))
        kids.append(0)
        first.append(a)
        last.append(b)
        return int(gaps.argmax()) if b > a else 0

    todo = [(0, len(rows), ball(0, len(rows)), 0)]
    while todo:
        a, b, far, node = todo.pop()
        if b - a <= leaf or radii[node] == 0:
            continue
        own = rows[order[a:b]]
        with np.errstate(over="ignore", invalid="ignore"):
            along = own @ (own[_gaps(own, own[far]).argmax()] - own[far])
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(along, half)]
        kids[node] = len(centres)
        for x, y in ((a, a + half), (a + half, b)):
            far_in = ball(x, y)
            todo.append((x, y, far_in, len(centres) - 1))
    return Tree(rows[order], ids[order], np.array(centres), np.array(radii), np.array(kids), np.array(first), np.array(last))


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` largest scores, ties to smaller ids, sorted by query and rank."""
    order = np.lexsort((ids, -score, query))  # scores lie above the least long, so each has a negative
    own = query[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(own)]])))
    return order[rank < k]


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query place, vec_id, score)`` of each query's best ``k`` rows of the tree that reach its ``floor``."""
    norms, floor = _gaps(queries, np.zeros(queries.shape[1])), floor.copy()

    def bound(q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return _bound(np.einsum("ij,ij->i", queries[q], tree.centres[nodes]), norms[q] * tree.radii[nodes])

    q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    leaves_q, leaves_n, leaves_b = [], [], []
    while len(q):  # down the tree, all queries together; balls below a query's floor go
        high = bound(q, node)
        alive = high >= floor[q]
        q, node, high = q[alive], node[alive], high[alive]
        inner = tree.kids[node] > 0
        leaves_q.append(q[~inner])
        leaves_n.append(node[~inner])
        leaves_b.append(high[~inner])
        q, node = np.repeat(q[inner], 2), np.stack([tree.kids[node[inner]], tree.kids[node[inner]] + 1], 1).ravel()
    q, node, high = map(np.concatenate, (leaves_q, leaves_n, leaves_b))
    order = np.lexsort((-high, q))  # by query, falling bound
    q, node, high = q[order], node[order], high[order]
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    turn = np.arange(len(q)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(q)]])))
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for step in range(int(turn.max(initial=-1)) + 1):
        now = np.flatnonzero((turn == step) & (high >= floor[q]))
        if not len(now):
            continue
        now = now[np.argsort(node[now], kind="stable")]
        new = [found]
        for own in np.split(now, np.flatnonzero(np.diff(node[now])) + 1):
            a, b = tree.first[node[own[0]]], tree.last[node[own[0]]]
            own_scores = scores(queries[q[own]], tree.rows[a:b])
            hit = (own_scores >= floor[q[own], None]) & (query_ids[q[own], None] != tree.ids[None, a:b])
            i, j = np.nonzero(hit)
            new.append([q[own][i], tree.ids[a + j], own_scores[i, j]])
        found = [np.concatenate(x) for x in zip(*new, strict=True)]
        keep = _best(*found, k)
        found = [x[keep] for x in found]
        count = np.bincount(found[0], minlength=len(queries))
        ends = np.cumsum(count)
        full = count >= k
        floor[full] = np.maximum(floor[full], found[2][ends[full] - 1])
    return found[0], found[1], found[2]


class Coarse(NamedTuple):
    """Half-spaces that deal vectors over coarse balls: node i sends a vector to ``kids[i]`` plus one if its product with
    ``along[i]`` is above ``cut[i]``; without kids (0) it is the ball ``ball[i]`` around ``centres[ball[i]]``."""

    along: np.ndarray
    cut: np.ndarray
    kids: np.ndarray
    ball: np.ndarray
    centres: np.ndarray


def coarse(rows: np.ndarray, balls: int) -> Coarse:
    """At most ``balls`` coarse balls: the part with most rows is halved along the line between two far points."""
    width = rows.shape[1]
    parts, along, cut, kids = {0: rows}, [np.zeros(width)], [0.0], [0]
    while len(parts) < balls:
        node = max((i for i in parts if len(parts[i]) > 1), key=lambda i: (len(parts[i]), -i), default=None)
        if node is None:
            break
        own = parts[node]
        with np.errstate(over="ignore", invalid="ignore"):
            far = own[_gaps(own, own.mean(0)).argmax()]
            line = own[_gaps(own, far).argmax()] - far
            line = line / (np.abs(line).max() or 1)
            at = np.nan_to_num(own @ line)
        above = at > np.median(at)
        if not above.any():  # equal rows, or more than half of them at the end of the line
            above = at >= at.max()
        if above.all():
            parts[node] = own[:1]  # nothing to halve
            continue
        along[node], cut[node], kids[node] = line, at[~above].max(), len(kids)
        del parts[node]
        for side in (own[~above], own[above]):
            parts[len(kids)] = side
            along.append(np.zeros(width))
            cut.append(0.0)
            kids.append(0)
    ball = np.zeros(len(kids), np.int64)
    ball[list(parts)] = np.arange(len(parts))
    with np.errstate(over="ignore"):
        centres = np.nan_to_num(np.array([own.mean(0) if len(own) else np.zeros(width) for own in parts.values()]))
    return Coarse(np.array(along), np.array(cut), np.array(kids), ball, centres)


def dealt_to(plan: Coarse, rows: np.ndarray) -> np.ndarray:
    """The coarse ball of each row.  Components beyond the plan's width do not count."""
    rows = widened(rows, plan.along.shape[1])[:, : plan.along.shape[1]]
    node = np.zeros(len(rows), np.int64)
    while (inner := np.flatnonzero(plan.kids[node] > 0)).size:
        with np.errstate(over="ignore", invalid="ignore"):
            at = np.nan_to_num(np.einsum("ij,ij->i", rows[inner], plan.along[node[inner]]))
        node[inner] = plan.kids[node[inner]] + (at > plan.cut[node[inner]])
    return plan.ball[node]


def _bounds(asked: np.ndarray, plan: Coarse, radii: np.ndarray) -> np.ndarray:
    """The bound of every query for every coarse ball; balls without vectors (radius below 0) have none."""
    width = max(asked.shape[1], plan.centres.shape[1])
    asked, centres = widened(asked, width), widened(plan.centres, width)
    with np.errstate(over="ignore", invalid="ignore"):
        high = _bound(asked @ centres.T, _gaps(asked, np.zeros(width))[:, None] * np.maximum(radii, 0))
    return np.where(radii < 0, -np.inf, high)


def _round(vectors: DataFrame, queries: DataFrame, k: int, sizes: list[int], shard_rows: int, query_rows: int) -> DataFrame:
    """Search ``queries`` (``query_id``, ``vector``, ``floor``, and the ``balls`` to search) in ``vectors`` (with ``ball``).

    ``sizes`` are the vectors of each ball.  A ball is cut into shards of about ``shard_rows`` by a hash of the id, and the
    queries of a ball into groups of about ``query_rows``; only balls that are asked are read.  A task gets the vectors
    of a shard first and then its queries, in batches; the vectors of a shard are copied once per group of queries.
    Memory: one shard and one batch.
    """
    asks = dict(queries.select(F.explode("balls").alias("ball")).groupBy("ball").count().collect())  # a row per ball
    groups = F.lit([-(-asks.get(i, 0) // query_rows) for i in range(len(sizes))] or [0])
    shards = F.lit([-(-n // shard_rows) for n in sizes] or [0])
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    own = vectors.withColumn("groups", F.get(groups, F.col("ball"))).filter("groups > 0").select(
        "ball", F.pmod(F.xxhash64("vec_id"), F.get(shards, F.col("ball"))).cast("int").alias("shard"), F.explode(up_to(F.col("groups"))).alias("part"),
        F.lit(0).alias("side"), F.col("vec_id").alias("id"), "vector", F.lit(None).cast("long").alias("floor"),
    )
    each = queries.select("query_id", "vector", "floor", F.explode("balls").alias("ball"))
    asked = each.select(
        "ball", F.explode(up_to(F.get(shards, F.col("ball")))).alias("shard"), F.pmod(F.xxhash64("query_id"), F.get(groups, F.col("ball"))).cast("int").alias("part"),
        F.lit(1).alias("side"), F.col("query_id").alias("id"), "vector", "floor",
    )
    both = own.unionByName(asked).repartition("ball", "shard", "part").sortWithinPartitions("ball", "shard", "part", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, tree = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("ball", "shard", "part", "side")), strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if keys[a][:3] != key:
                    key, held, tree = keys[a][:3], [], None
                part = batch.slice(a, b - a)
                if keys[a][3] == 0:
                    held.append((part.column("id").to_numpy(), matrix(part.column("vector"))))
                    continue
                if not held and tree is None:
                    continue  # a shard without vectors
                for i in range(0, part.num_rows, QUERY_BATCH):
                    some = part.slice(i, QUERY_BATCH)
                    asked = matrix(some.column("vector"))
                    width = max(asked.shape[1], *(m.shape[1] for _, m in held)) if held else max(asked.shape[1], tree.rows.shape[1])
                    if held:
                        rows = np.concatenate([widened(m, width) for _, m in held])
                        tree, held = build(np.concatenate([x for x, _ in held]), rows), []
                    if tree.rows.shape[1] < width:
                        tree = build(tree.ids, widened(tree.rows, width))
                    ids = some.column("id").to_numpy()
                    low = pc.fill_null(some.column("floor"), -_LONG).to_numpy()
                    place, vec_id, score = search(tree, ids, widened(asked, width), low, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[place]), pa.array(vec_id), pa.array(score)], ["query_id", "vec_id", "score"])

    return both.mapInArrow(run, _HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's ``k`` largest integer inner products over all other rows: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; a component x counts as floor(``scale`` * x).  Rows whose ``vec_id``
    is null, or whose vector is null or holds null or non-finite components, take no part.  Rows that repeat a ``vec_id``
    count once, by their smallest vector.  Vectors of unequal length are compared as if filled up with zeros.  Ties go
    to the smaller ``vec_id``; equal vectors are separate candidates.  A query with fewer candidates gets all of them; an
    empty table gives no row.  Scores beyond the long range stop at its ends, scaled components at those of double
    precision.  Other columns are ignored.  Eager.

    The coarse balls are placed by a sample of at most ``SAMPLE_ROWS`` vectors and ``SAMPLE_COMPONENTS`` components in the
    driver, the first by a hash of the id; every vector is dealt to one, and the result does not depend on them.  There are
    at most ``BALLS``, so what each task gets of them is bounded.
    """

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.flatnonzero(usable(batch.column("embedding")) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False))
            some = batch.take(pa.array(good))
            lists = some.column("embedding").cast(pa.list_(pa.float64()))
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False)), -_LARGEST, _LARGEST)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays([some.column("vec_id"), pa.ListArray.from_arrays(ends, pa.array(whole))], ["vec_id", "vector"])

    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("__asks"), "embedding")
    clean = materialize(
        plain.select("vec_id", "embedding").mapInArrow(numbers, "vec_id long, vector array<double>").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    )
    asks = plain.filter("__asks").select("vec_id").distinct()
    rows, width = clean.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    balls = min(BALLS, max(1, -(-rows // shard_rows)))
    sampled = min(SAMPLE_ROWS, max(balls, SAMPLE_COMPONENTS // max(1, width))) if balls > 1 else 0
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sampled).select("vector").collect() if sampled else []
    points = np.zeros((len(sample), width))
    for i, (vector,) in enumerate(sample):
        points[i, : len(vector)] = vector
    plan = coarse(points, balls)
    del sample, points

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column("vector"), plan.centres.shape[1])
            ball = dealt_to(plan, own)
            gap = _gaps(own, widened(plan.centres, own.shape[1])[ball])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball, pa.int32()), pa.array(gap)], [*batch.schema.names, "ball", "gap"])

    vectors_at = materialize(clean.mapInArrow(deal, "vec_id long, vector array<double>, ball int, gap double"))
    sizes, radii = [0] * len(plan.centres), np.full(len(plan.centres), -1.0)
    for ball, n, radius in vectors_at.groupBy("ball").agg(F.count(F.lit(1)), F.max("gap")).collect():  # a row per ball
        sizes[ball], radii[ball] = n, radius

    def nearest_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, QUERY_BATCH):
                some = batch.slice(i, QUERY_BATCH)
                high = _bounds(matrix(some.column("vector")), plan, radii)
                near = [row[:NEAR][high[j, row[:NEAR]] > -np.inf].tolist() for j, row in enumerate(np.argsort(-high, axis=1, kind="stable"))]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(near, pa.list_(pa.int32()))], [*some.schema.names, "near"])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, QUERY_BATCH):
                some = batch.slice(i, QUERY_BATCH)
                low = pc.fill_null(some.column("floor"), -_LONG).to_numpy()
                left = _bounds(matrix(some.column("vector")), plan, radii) >= low[:, None]
                for j, near in enumerate(some.column("near").to_pylist()):
                    left[j, near] = False
                lists = [np.flatnonzero(row).tolist() for row in left]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("query_id", "vector", "floor")), pa.array(lists, pa.list_(pa.int32()))], ["query_id", "vector", "floor", "balls"])

    asked = clean.join(asks, "vec_id", "left_semi").withColumnRenamed("vec_id", "query_id")
    queries = materialize(asked.mapInArrow(nearest_balls, "query_id long, vector array<double>, near array<int>"))
    first = queries.select("query_id", "vector", F.lit(None).cast("long").alias("floor"), F.slice("near", 1, 1).alias("balls"))
    found = materialize(_ranked(_round(vectors_at, first, k, sizes, shard_rows, query_rows), k))
    for last in (False, True) if len(sizes) > NEAR else (False,) if len(sizes) > 1 else ():
        floors = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        low = queries.join(floors, "query_id", "left")
        if last:
            turn = materialize(low.mapInArrow(reached, "query_id long, vector array<double>, floor long, balls array<int>").filter("size(balls) > 0"))
        else:
            turn = low.select("query_id", "vector", "floor", F.slice("near", 2, NEAR).alias("balls")).filter("size(balls) > 0")
        more = _round(vectors_at, turn, k, sizes, shard_rows, query_rows)
        found = materialize(_ranked(found.drop("rank").unionByName(more), k))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
