"""Compression of vectors to one codebook entry per part (operator 11).

Every component ``x`` becomes the integer ``floor(1024 * x)``, a vector is cut into equal consecutive parts, and each
part position has a codebook that starts as the parts of the rows with the smallest ids and is refined in rounds.

The parts of a position are ordered along a Hilbert curve by a range shuffle and kept as flat blocks: their points, the
box of least and greatest components, and the sum of the points.  The blocks are written once; each round reads them
and moves only sums.  Distances between a block's box and the entries give the block a shortlist; a block with one
entry left is assigned by its stored sum, any other by an exact integer kernel over its shortlist.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from locusflow.llm.vectors import matrix, usable
from locusflow.operators.joins import spread_join
from locusflow.session import materialize

SCALE = 1024
#: Points of a block, and bits of a Hilbert key.
BLOCK_ROWS, KEY_BITS = 128, 96
#: Sums travel as longs: whole below this component, else in limbs of so many bits.
PLAIN, LIMB = 1 << 24, 40
#: Sums are added by so many columns at once.
SLOTS = 64
_MOST = (1 << 63) - 1


class Compressed(NamedTuple):
    """One row per kept vector (``id``, ``label``, ``code`` with one entry number per part, ``error``), and the integer
    components of every codebook entry by part and entry."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def on_grid(values: np.ndarray) -> np.ndarray:
    """``floor(1024 * x) / 1024``, which a double always holds; from 2**43 on every double is on the grid already."""
    near = np.abs(values) < 2.0**43
    return np.where(near, np.floor(np.where(near, values, 0) * SCALE) / SCALE, values)


def whole(values: np.ndarray) -> np.ndarray:
    """Exact integers ``1024 * x`` of grid values, as Python integers."""
    out = np.empty(values.shape, object)
    for at, x in np.ndenumerate(values):
        out[at] = int(x) * SCALE if abs(x) >= 2.0**43 else int(x * SCALE)
    return out


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of rows of cell numbers below ``2**bits``, as rows of key bytes."""
    n, width = cells.shape
    axes = [cells[:, i].astype(np.uint32) for i in range(width)]
    for bit in range(bits - 1, 0, -1):  # undo the turns of every level, the coarsest first
        low = np.uint32((1 << bit) - 1)
        for i in range(width):
            is_set = (axes[i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(is_set, np.uint32(0), (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(is_set, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] ^ swap if i else axes[0]
    for i in range(1, width):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    crossed = np.stack([a ^ flip for a in axes], 1)
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((crossed[:, None, :] >> levels[None, :, None]) & 1).reshape(n, bits * width).astype(np.uint8), axis=1)


def limbs(values: np.ndarray, n: int) -> np.ndarray:
    """Integers as ``n`` longs, the lowest first; all but the last are below ``2**LIMB``."""
    out = []
    for _ in range(n - 1):
        out.append((values & ((1 << LIMB) - 1)).astype(np.int64))
        values = values >> LIMB
    return np.stack([*out, values.astype(np.int64)])


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the entries that may be nearest to some point of the box; ties stay in.

    An entry goes when its least distance to the box is beyond another's greatest one, or when that other entry is
    nearer at every corner.  A margin far above rounding keeps the choice safe in floating point.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        far = (np.maximum(np.abs(entries - low), np.abs(high - entries)) ** 2).sum(1)
        near = (np.maximum(np.maximum(low - entries, entries - high), 0) ** 2).sum(1)
        best = int(np.argmin(far))
        kept = np.flatnonzero(~(near > far[best] * (1 + 1e-9)))
        own, other = entries[best], entries[kept]
        corner = np.where(other > own, high, low)
        gain = ((other - own) * (other + own - 2 * corner)).sum(1)
        margin = 1e-9 * (np.abs(other - own) * (np.abs(other) + np.abs(own) + 2 * np.abs(corner))).sum(1)
        return kept[~(gain > margin)]


def nearest(points: np.ndarray, entries: np.ndarray, exact: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point (ties to the first) and its squared distance, exactly.

    ``points`` and ``entries`` are grid values.  Where all sums stay below 2**53 doubles hold the integers; beyond that
    Python integers do.
    """
    most = float(max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)))
    if most < 2.0**40 and points.shape[1] * (2 * SCALE * most) ** 2 < 2.0**53:
        x, c = points * SCALE, entries * SCALE
        gaps = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        best = gaps.argmin(1)
        return best, gaps[np.arange(len(x)), best].astype(np.int64)
    x = whole(points)
    gaps = np.stack([((x - np.array(c, object)) ** 2).sum(1) for c in exact], 1)
    best = np.array([min(range(len(exact)), key=row.__getitem__) for row in gaps], np.int64)
    return best, gaps[np.arange(len(x)), best]


def _binary(m: np.ndarray) -> pa.Array:
    """Rows of a matrix as byte strings."""
    raw = np.ascontiguousarray(m)
    width = raw.shape[1] * raw.itemsize
    ends = (np.arange(len(raw) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _matrix(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), kind) for b in column]


def _kept(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """Rows whose vector is usable, on the grid, each with a number of its own."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(usable(batch.column("v"))))
            lists = part.column("v").cast(pa.list_(pa.float64()))
            flat = on_grid(lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), made], ["id", "label", "v"])

    return materialize(own.mapInArrow(run, own.schema).withColumn("uid", F.monotonically_increasing_id()))


def _blocks(kept: DataFrame, width: int, parts: int, seeds: np.ndarray, n_limbs: int) -> DataFrame:
    """The parts of all rows in flat blocks along the Hilbert curve, written once."""
    bits = max(1, min(6, KEY_BITS // max(width, 1)))
    first, last = np.quantile(seeds, [0.02, 0.98], axis=0) if seeds.size else (np.zeros(0), np.zeros(0))
    step = np.maximum(last - first, 1e-300) / (1 << bits)
    types = {f.name: f.dataType for f in kept.schema.fields}
    cut = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("uid", T.LongType()),
            T.StructField("id", types["id"]),
            T.StructField("label", types["label"]),
            T.StructField("part", T.BinaryType()),
        ]
    )
    block = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            *[T.StructField(c, T.BinaryType()) for c in ("points", "low", "high", "total")],
            T.StructField("uid", T.ArrayType(T.LongType())),
            T.StructField("id", T.ArrayType(types["id"])),
            T.StructField("label", T.ArrayType(types["label"])),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            m = matrix(batch.column("v"), width * parts)
            for p in range(parts):
                own = m[:, p * width : (p + 1) * width]
                with np.errstate(over="ignore", invalid="ignore"):
                    cells = np.clip((own - first[p * width : (p + 1) * width]) / step[p * width : (p + 1) * width], 0, (1 << bits) - 1)
                keys = hilbert_keys(cells.astype(np.uint32), bits) if width else np.zeros((n, 0), np.uint8)
                also = [batch.column(c) if p == 0 else pa.nulls(n, batch.column(c).type) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), _binary(keys), batch.column("uid"), *also, _binary(own)], cut.names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("position").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            cuts = [(i, min(i + BLOCK_ROWS, b)) for a, b in zip(edges, edges[1:], strict=False) for i in range(a, b, BLOCK_ROWS)]
            if not cuts:
                continue
            out: dict[str, list] = {c: [] for c in block.names}
            for a, b in cuts:
                points = np.array(_matrix(batch.column("part").slice(a, b - a), "<f8")).reshape(b - a, width)
                plain = np.abs(points).max(initial=0) < PLAIN / SCALE
                total = (points * SCALE).sum(0).astype(np.int64) if plain else whole(points).sum(0)
                for c, value in zip(("points", "low", "high", "total"), (points, points.min(0), points.max(0), limbs(total, n_limbs)), strict=True):
                    out[c].append(value.tobytes())
                out["position"].append(int(at[a]))
            ends = pa.array(np.array([cuts[0][0], *[b for _, b in cuts]], np.int32))
            lists = [pa.ListArray.from_arrays(ends, batch.column(c)) for c in ("uid", "id", "label")]
            arrays = [pa.array(out["position"], pa.int32()), *[pa.array(out[c], pa.binary()) for c in ("points", "low", "high", "total")]]
            yield pa.RecordBatch.from_arrays([*arrays, *lists], block.names)

    ordered = kept.mapInArrow(split, cut).repartitionByRange("position", "key", "uid").sortWithinPartitions("position", "key", "uid")
    return materialize(ordered.mapInArrow(gather, block))


def _refined(blocks: DataFrame, books: list[list[list[int]]], width: int, n_limbs: int) -> list[list[list[int]]]:
    """One round: every part to its nearest entry, entries to the floor of their parts' mean; unused entries stay."""
    grids = [np.array([[c / SCALE for c in e] for e in book]).reshape(len(book), width) for book in books]
    slots = min(SLOTS, n_limbs * width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(g), np.int64) for g in grids]
        sums = [np.zeros((len(g), n_limbs, width), np.int64) for g in grids]
        for batch in batches:
            columns = [_matrix(batch.column(c), k) for c, k in (("points", "<f8"), ("low", "<f8"), ("high", "<f8"), ("total", "<i8"))]
            for p, points, low, high, total in zip(batch.column("position").to_pylist(), *columns, strict=True):
                own = shortlist(low, high, grids[p])
                points = points.reshape(-1, width)
                if len(own) == 1:
                    counts[p][own[0]] += len(points)
                    sums[p][own[0]] += total.reshape(n_limbs, width)
                    continue
                best, _ = nearest(points, grids[p][own], [books[p][e] for e in own])
                used, best = np.unique(best, return_inverse=True)
                counts[p][own[used]] += np.bincount(best)
                if np.abs(points).max(initial=0) < PLAIN / SCALE:
                    made = (np.eye(len(used))[best].T @ (points * SCALE)).astype(np.int64)
                else:
                    exact = whole(points)
                    made = np.stack([exact[best == i].sum(0) for i in range(len(used))])
                sums[p][own[used]] += limbs(made, n_limbs).transpose(1, 0, 2)
        for p, (many, total) in enumerate(zip(counts, sums, strict=True)):
            for k in range(n_limbs - 1):  # carry, so that very many tasks add up
                total[:, k + 1] += total[:, k] >> LIMB
                total[:, k] &= (1 << LIMB) - 1
            used = np.flatnonzero(many)
            flat = total[used].reshape(len(used), n_limbs * width)
            for at in range(0, n_limbs * width, slots):
                piece = np.pad(flat[:, at : at + slots], ((0, 0), (0, slots - flat[:, at : at + slots].shape[1])))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(piece.reshape(-1)), slots).cast(pa.list_(pa.int64()))
                heads = [np.full(len(used), p, np.int32), used.astype(np.int32), np.full(len(used), at, np.int32), many[used]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, heads), lists], ["position", "entry", "at", "n", "sums"])

    partial = blocks.select("position", "points", "low", "high", "total").mapInArrow(run, "position int, entry int, at int, n long, sums array<long>")
    added = partial.groupBy("position", "entry", "at").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(slots)]).alias("sums"))
    flat: dict[tuple[int, int], dict[int, int]] = {}
    many: dict[tuple[int, int], int] = {}
    for r in added.collect():  # at most entries * width numbers a part
        flat.setdefault((r["position"], r["entry"]), {}).update(enumerate(r["sums"], r["at"]))
        many[r["position"], r["entry"]] = r["n"]
    out = [list(book) for book in books]
    for (p, e), values in flat.items():
        out[p][e] = [sum(values[k * width + i] << (LIMB * k) for k in range(n_limbs)) // many[p, e] for i in range(width)]
    return out


def _assigned(blocks: DataFrame, books: list[list[list[int]]], width: int) -> DataFrame:
    """Entry number and squared distance of every part; a distance beyond a long stops at its end."""
    grids = [np.array([[c / SCALE for c in e] for e in book]).reshape(len(book), width) for book in books]
    types = {f.name: f.dataType.elementType for f in blocks.schema.fields if isinstance(f.dataType, T.ArrayType)}
    out = T.StructType(
        [
            T.StructField("uid", T.LongType()),
            T.StructField("position", T.IntegerType()),
            T.StructField("entry", T.IntegerType()),
            T.StructField("gap", T.LongType()),
            T.StructField("id", types["id"]),
            T.StructField("label", types["label"]),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_matrix(batch.column(c), "<f8") for c in ("points", "low", "high")]
            lists = [batch.column(c) for c in ("uid", "id", "label")]
            for i, (p, points, low, high) in enumerate(zip(batch.column("position").to_pylist(), *columns, strict=True)):
                own = shortlist(low, high, grids[p])
                uid, ids, labels = (column.slice(i, 1).flatten() for column in lists)
                best, gap = nearest(points.reshape(len(uid), width), grids[p][own], [books[p][e] for e in own])
                gap = np.minimum(gap, _MOST).astype(np.int64)
                arrays = [uid, pa.array(np.full(len(uid), p, np.int32)), pa.array(own[best].astype(np.int32)), pa.array(gap), ids, labels]
                yield pa.RecordBatch.from_arrays(arrays, out.names)

    return blocks.select("position", "points", "low", "high", "uid", "id", "label").mapInArrow(run, out)


def _bounded(total) -> F.Column:
    """A sum of longs that stops at the greatest long."""
    return F.least(total, F.lit(_MOST).cast("decimal(38,0)")).cast("long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4
) -> Compressed:
    """Codebooks of ``vectors`` and the code of every vector.

    Rows whose vector is null or holds null or non-finite components are dropped; every other row is kept, repeated
    rows and null ids too.  Vectors shorter than the longest, or than the next multiple of ``parts``, are filled up
    with zeros.  Each codebook starts as the parts of the ``entries`` rows with the smallest ids (null ids come last,
    rows of one id in the order of their vectors); with fewer rows it has as many entries as there are rows.  Rounds
    are exact whatever the size of the components; distances and errors beyond a long stop at its end.  Columns other
    than the three named are not looked at.  An empty table gives empty codebooks and no rows.  Eager but for the rows.
    """
    kept = _kept(vectors, id_col, vector, label)
    size = F.array_max(F.transform("v", F.abs))
    found = kept.agg(F.max(F.size("v")).alias("width"), F.max(size).alias("most")).first()
    width = -(-(found["width"] or 0) // parts)
    bits = int(whole(np.array([found["most"] or 0.0]))[0]).bit_length()
    n_limbs = 1 if bits < PLAIN.bit_length() else -(-(bits + 1 + BLOCK_ROWS.bit_length()) // LIMB) + 1
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    seeds = np.array([[*r["v"], *[0.0] * (width * parts - len(r["v"]))] for r in first]).reshape(len(first), width * parts)
    books = [[list(map(int, row)) for row in whole(seeds[:, p * width : (p + 1) * width])] for p in range(parts)]
    blocks = _blocks(kept, width, parts, seeds, n_limbs)
    for _ in range(rounds if width and first else 0):
        books = _refined(blocks, books, width, n_limbs)
    gap = F.sum(F.col("gap").cast("decimal(38,0)"))
    entry = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(parts)]
    rows = _assigned(blocks, books, width).groupBy("uid").agg(
        F.max("id").alias("id"), F.max("label").alias("label"), F.array(*entry).alias("code"), _bounded(gap).alias("error")
    )
    return Compressed(rows.drop("uid"), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """Add ``label_error``: ``error`` summed over the rows of equal label, null ones together."""
    rows = materialize(rows)
    sums = rows.groupBy("label").agg(_bounded(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    sums = materialize(sums)
    unlabelled = sums.filter("label IS NULL").first()
    joined = spread_join(rows, sums.filter("label IS NOT NULL"), ["label"], "left", salt_on=["id"])
    return joined.withColumn("label_error", F.coalesce("label_error", F.lit(unlabelled["label_error"] if unlabelled else None).cast("long")))


def restored(rows: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """Add ``approximation``: the entries that ``code`` names, as doubles.  Null codes give null."""
    books = [[[c / SCALE for c in entry] for entry in book] for book in codebooks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if code is None else [x for book, e in zip(books, code, strict=True) for x in book[e]] for code in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.float64()))], [*batch.schema.names, "approximation"])

    kept = rows.select([c for c in rows.columns if c != "approximation"])
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("approximation", T.ArrayType(T.DoubleType()))]))
