"""Packing token pieces into fixed-length sequences by bin completion (operator 2).

Only lengths decide a packing, and there are at most ``capacity`` of them.  So the search runs on the number of
pieces of each length, a table whose size does not grow with the data, and its answer is a list of patterns with
multiplicities ("this filling, so many times").  Every piece then finds its place on its own from its rank among
the pieces of its length; no task sees all pieces.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from locusflow.llm.batches import TEXT_ROWS, rows_per_batch
from locusflow.llm.tokens import KEPT_WORDS, KEPT_WORDS_LEAN, drops_white_space, text_ids
from locusflow.llm.words import SLICE_BYTES, slices
from locusflow.session import materialize

CAPACITY = 2048
#: Fillings the search may try before it keeps its incumbent.
NODES = 2400
#: Fillings of one node tested for dominance, and steps of such a test, after which a filling counts as undominated.
TESTED, STEPS = 1000, 200
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Filling(NamedTuple):
    """Lengths placed together, longest first, ``times`` over."""

    lengths: tuple[int, ...]
    times: int


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", lean: bool = False) -> DataFrame:
    """Token pieces of each whole text: its ids and ``end_id``, cut every ``capacity`` ids.

    Null text counts as empty and gives one piece of one id.  Repeated rows give repeated pieces; a null id stays null.
    ``lean`` takes less memory and more time.
    """
    kept, limit = (KEPT_WORDS_LEAN, SLICE_BYTES) if lean else (KEPT_WORDS, 2 * SLICE_BYTES)
    by_word, end = drops_white_space(tokenizer), np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit):
                ids, starts = text_ids(part.column("text"), tokenizer, by_word, kept)
                sizes = np.diff(starts) + 1
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                length = np.minimum(sizes[row] - number * capacity, capacity)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = np.empty(len(row), np.int64)
                last = number == counts[row] - 1
                at = starts[row] + number * capacity
                for i, (a, n, closes) in enumerate(zip(at.tolist(), length.tolist(), last.tolist(), strict=True)):
                    code = zlib.crc32(raw[4 * a : 4 * (a + n - closes)])
                    crc[i] = zlib.crc32(end, code) if closes else code
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row)), pa.array(number.astype(np.int32)),
                        pa.array(number * capacity, pa.int64()), pa.array(length, pa.int64()), pa.array(crc),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def completions(room: int, counts: np.ndarray, slack: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``room`` that waste up to ``slack``, least waste first, then longest pieces.

    A filling dominates another if its pieces can be split into the other's; so one long piece is preferred to
    several short ones of the same sum, and nothing that could still be added is left out.
    ``counts[l]`` pieces of length ``l`` are at hand.  Sets of the sums that the shortest lengths can reach, one bit
    each, lead to every filling without dead ends, however many pieces it holds.
    """
    have = [n for n in np.flatnonzero(counts[: max(room, 0) + 1]).tolist() if n]
    if not have:
        if room <= slack:
            yield ()
        return
    number = [int(counts[n]) for n in have]
    sums, mask = [1], (1 << (room + 1)) - 1  # sums[i]: what the first i lengths can reach
    for length, n in zip(have, number, strict=True):
        reach, left, step = sums[-1], min(n, room // length), 1
        while left:
            reach |= reach << (min(step, left) * length) & mask
            left, step = left - min(step, left), 2 * step
        sums.append(reach)

    def exact(target: int, i: int) -> Iterator[tuple[int, ...]]:
        if not target:
            yield ()
            return
        i = min(i, bisect.bisect_right(have, target))
        while i and sums[i] >> target & 1:
            i -= 1
            for k in range(min(number[i], target // have[i]), 0, -1):
                if sums[i] >> (target - k * have[i]) & 1:
                    for rest in exact(target - k * have[i], i):
                        yield (have[i],) * k + rest

    kept: list[tuple[int, ...]] = []
    tests = 0
    for waste in range(room + 1 - sums[-1].bit_length(), min(slack, room) + 1):
        short = have[: bisect.bisect_right(have, waste)]  # all of these must be in, or one could be added
        if sum(n * k for n, k in zip(short, number, strict=False)) > room - waste:
            return
        for filling in exact(room - waste, len(have)) if sums[-1] >> (room - waste) & 1 else ():
            if tests == TESTED:
                return
            tests += 1
            if any(filling.count(n) < k for n, k in zip(short, number, strict=False)) or any(_dominates(x, filling) for x in kept):
                continue
            kept.append(filling)
            yield filling


def _dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces ``other`` fit into rooms of the sizes ``one``; False if that is not found in some steps."""
    rooms, left = Counter(one), Counter(other)
    rooms, left = rooms - left, left - rooms  # a piece may as well take a room of its own size
    steps = STEPS

    def fits(pieces: list[int], rooms: list[int]) -> bool:
        nonlocal steps
        if not pieces:
            return True
        for room in sorted({r for r in rooms if r >= pieces[0]}):
            steps -= 1
            if steps < 0:
                return False
            others = rooms.copy()
            others.remove(room)
            if fits(pieces[1:], [*others, room - pieces[0]]):
                return True
        return False

    pieces, sizes = sorted(left.elements(), reverse=True), list(rooms.elements())
    return sum(pieces) <= sum(sizes) and max(pieces, default=0) <= max(sizes, default=0) and fits(pieces, sizes)


def _options(have: np.ndarray, capacity: int, slack: int) -> Iterator[Filling]:
    """Fillings with the longest piece of ``have``, as often as its lengths last, and later also fewer times."""
    longest, rest = int(np.flatnonzero(have)[-1]), have.copy()
    rest[longest] -= 1

    def fewer(most: Filling) -> Iterator[Filling]:
        for times in sorted({most.times - 1, most.times // 2, 1} - {0, most.times}, reverse=True):
            yield Filling(most.lengths, times)

    found: list[Filling] = []
    turn = 0
    for filling in completions(capacity - longest, rest, slack):
        lengths = (longest, *filling)
        found.append(Filling(lengths, min(int(have[n]) // k for n, k in Counter(lengths).items())))
        yield found[-1]
        if len(found) % 2 == 0:
            yield from fewer(found[turn])
            turn += 1
    for most in found[turn:]:
        yield from fewer(most)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences no packing can go below: by the sum of lengths, and by the pieces that cannot share a sequence."""
    number, amount = np.cumsum(counts), np.cumsum(np.arange(len(counts)) * counts)
    half = capacity // 2
    small = np.arange(1, half + 1)  # pieces shorter than this are left out of the count
    alone = number[capacity] - number[capacity - small]
    middle = number[capacity - small] - number[half]
    room = middle * capacity - (amount[capacity - small] - amount[half])
    over = np.maximum(0, amount[half] - amount[small - 1] - room)
    return max(-(-int(amount[capacity]) // capacity), int((alone + middle + -(-over // capacity)).max(initial=0)))


def best_fit(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Best fit by falling length, for all pieces of a length and all equally filled sequences at once.

    Equal sequences are one entry with a multiplicity; a length splits at most one entry for each room it meets, so
    the work follows the number of lengths and not the number of pieces.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []  # the keys of open_, rising

    def put(room: int, filling: tuple[int, ...], times: int) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append((filling, times))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, filling, times = capacity, (), left
            each = min(room // length, left)
            full = min(times, left // each)
            put(room - each * length, (*filling, *[length] * each), full)
            if full < times and room < capacity:
                put(room, filling, times - full)
            left -= full * each
    return [Filling(f, n) for groups in open_.values() for f, n in groups]


def plan(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[Filling]:
    """Fillings that use every piece of ``counts`` (``counts[l]`` pieces of length ``l``).

    Bin completion by branch and bound.  A node completes the longest piece left by each undominated filling in
    turn, used as often as its lengths last and also fewer times, and best fit packs the rest: the best such packing is
    the incumbent.  A branch ends when its waste, or the lower bound of its rest, leaves no packing with fewer
    sequences.  Branches with the fewest turns away from the first filling of each node are looked at first.  The search
    ends when the incumbent meets the lower bound of the whole, when no branch is left, or after ``nodes`` fillings.
    """
    counts = np.asarray(counts, np.int64).copy()
    total, bound = int((np.arange(len(counts)) * counts).sum()), lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    fewest = sum(f.times for f in best)
    # Each entry: turns taken, its order, counts left, fillings so far, their number, their waste, the waste allowed when
    # it was made, and its options tried.  Options are made anew for each turn: kept, they take much memory.
    queue: list[tuple[int, int, int, np.ndarray, list[Filling], int, int, int, int]] = []
    order = 0

    def put(turns: int, have: np.ndarray, done: list[Filling], used: int, waste: int, slack: int, seen: int) -> None:
        nonlocal order
        order += 1
        heapq.heappush(queue, (turns, -used, order, have, done, used, waste, slack, seen))

    if counts.any():
        put(0, counts, [], 0, 0, (fewest - 1) * capacity - total, 0)
    while queue and nodes and fewest > bound:
        turns, _, _, have, done, used, waste, slack, seen = heapq.heappop(queue)
        if waste > (fewest - 1) * capacity - total or used + lower_bound(have, capacity) >= fewest:
            continue
        filling = next(islice(_options(have, capacity, slack), seen, None), None)
        if filling is None:
            continue
        nodes -= 1
        put(turns + 1, have, done, used, waste, slack, seen + 1)
        after = have - filling.times * np.bincount(filling.lengths, minlength=len(have))
        tried, used = [*done, filling], used + filling.times
        waste += filling.times * (capacity - sum(filling.lengths))
        packed = best_fit(after, capacity)
        number = used + sum(f.times for f in packed)
        if number < fewest:
            best, fewest = [*tried, *packed], number
        slack = (fewest - 1) * capacity - total - waste
        if after.any() and slack >= 0:
            put(turns, after, tried, used, waste, slack, 0)
    return best


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row with a ``length`` a ``sequence_id`` and an ``offset`` in it, in as few sequences as found.

    ``cut`` should be a written table: it is read for the counts and again for the places.  Sequences are filled
    gapless from offset 0.  All copies of one length may be a third of the rows: ranks are made within
    ``(length, salt)`` and salts carried by their counts.  Lengths must lie in 1 to ``capacity``; an empty table
    returns no row.  Eager: one aggregate brings the count of each length, at most ``capacity`` rows, to the driver.
    """
    spark = cut.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = materialize(salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n")))
    rows = groups.groupBy("length").agg(F.sum("__n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in rows:
        counts[row["length"]] = row["n"]
    fillings = plan(counts, capacity)

    # For each length, where its runs of ranks begin and what they mean.
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequence = np.zeros(capacity + 1, np.int64), 0
    for filling, times in fillings:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            k = filling.count(length)
            runs.setdefault(length, []).append((int(used[length]), k, sequence, offset))
            used[length] += k * times
            offset += k * length
        sequence += times
    order = sorted(runs)
    flat = np.array([r for length in order for r in runs[length]], np.int64).reshape(-1, 4)
    first = np.zeros(capacity + 2, np.int64)
    for length in order:
        first[length + 1] = len(runs[length])
    first = np.cumsum(first)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            run = np.empty(batch.num_rows, np.int64)
            for value in np.unique(length):
                here, (a, b) = length == value, first[value : value + 2]
                run[here] = a + np.searchsorted(flat[a:b, 0], rank[here], "right") - 1
            start, k, at, offset = flat[run].T
            kept = [batch.column(c) for c in batch.schema.names if c != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(at + (rank - start) // k), pa.array(offset + (rank - start) % k * length)],
                [*(c for c in batch.schema.names if c != "__rank"), "sequence_id", "offset"],
            )

    by = Window.partitionBy("length").orderBy("__salt")
    before = groups.withColumn("__before", F.sum("__n").over(by) - F.col("__n")).drop("__n")
    inside = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("__in", F.row_number().over(inside) - 1)
        .join(before, ["length", "__salt"])
        .select(*cut.columns, (F.col("__in") + F.col("__before")).cast("long").alias("__rank"))
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", lean: bool = False) -> DataFrame:
    """Pieces of all ``docs`` with their sequences; only texts of more than ``capacity`` ids are cut.

    Other columns of ``docs`` are not carried.  See :func:`pieces` for null and empty texts.
    """
    with rows_per_batch(docs.sparkSession, TEXT_ROWS if lean else 2 * TEXT_ROWS):
        cut = materialize(pieces(docs, tokenizer, capacity, text=text, doc_id=doc_id, lean=lean))
    return pack(cut, capacity)
