"""Similarity join of documents on their word n-grams, and its components (operator 1).

Documents and n-grams form a sparse incidence matrix M; the overlaps of all pairs are the product of M with its
transpose.  Two size-derived bounds keep almost all of it from being computed:

* With a similarity of at least t, documents of n n-grams share one of the first n - ceil(t n) + 1 in any common
  order of n-grams.  So only that block of columns is multiplied in search of pairs.  The order puts frequent
  n-grams last, which keeps the columns of the block short.
* The overlap cannot exceed what sizes and per-bucket counts of n-grams leave.  Pairs below the bound are discarded
  before the remaining columns are added up.

The pairs left accumulate their whole overlap from the complete sets of n-grams.
Copies within a task are one row of M.  A first pass multiplies each column with one of its rows only, which
links the members of large groups in linear work; the complete product then covers pairs not yet in one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from locusflow.llm.batches import TEXT_ROWS, broadcast_if_few, rows_per_batch
from locusflow.llm.components import components
from locusflow.llm.words import SLICE_BYTES, shingle_hashes, slices, split_words
from locusflow.session import materialize

#: N-grams known as frequent, at most, and the count within a slice of text from which one is looked at.  Any choice
#: gives the same result; a better one gives shorter columns.
FREQUENT, LOCAL_COUNT = 1 << 18, 2
#: N-grams per bucket, at most, in the counts of the second bound, and buckets at least.
PER_BUCKET, LEAST_BUCKETS = 8, 64
#: Rows of a column multiplied in one piece, and pieces a compared document's partners are dealt over.
COLUMN_ROWS, SALTS = 2048, 16
#: Rows with a whole set that are handed to Python at once.
SET_ROWS = 64
#: Passes in which each column is multiplied with one row.
STAR_PASSES = 2


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The distinct n-gram hashes of each text, sorted; A-Z are folded."""
    grams, starts = shingle_hashes(split_words(pc.ascii_lower(pc.fill_null(texts, ""))), n)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        own = np.sort(grams[a:b])
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def frequent_grams(docs: DataFrame, n: int, most: int = FREQUENT) -> np.ndarray:
    """Hashes of the most frequent n-grams over all documents, most frequent last; at most ``most``.

    Each slice of text reports those it holds ``LOCAL_COUNT`` times, and reports are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 * SLICE_BYTES):
                sets = list(_sets(part.column("text"), n))
                grams, counts = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
                often = counts >= LOCAL_COUNT
                yield pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often])], ["gram", "n"])

    counted = materialize(docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    # The least count that lets at most ``most`` through, from a histogram in steps of a tenth.
    steps = counted.groupBy(F.floor(F.log("n") / F.log(F.lit(1.1))).alias("step")).agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    total, least = 0, None
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += row["c"]
        if total > most:
            break
        least = row["least"]
    if least is None:
        return np.zeros(0, np.uint64)
    top = counted.filter(F.col("n") >= least).toArrow()
    grams, counts = top.column("gram").to_numpy(), top.column("n").to_numpy()
    return grams[np.lexsort((grams, counts))].view(np.uint64)


def _key(doc_id: int, grams: np.ndarray) -> tuple[bytes, int]:
    """Digest of a set of n-grams, and the number that stands for this document."""
    digest = blake2b(grams.tobytes(), digest_size=16).digest()
    own = blake2b(digest + int(doc_id).to_bytes(8, "little", signed=True), digest_size=8).digest()
    return digest, int.from_bytes(own, "little", signed=True)


def _bucket_counts(grams: np.ndarray) -> bytes:
    """How many n-grams fall in each of 2**k buckets by their last k bits; k grows with the size of the set."""
    buckets = LEAST_BUCKETS
    while buckets * PER_BUCKET < len(grams):
        buckets *= 2
    return np.minimum(np.bincount((grams & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


_MATRIX = "gram long, key long, doc_id long, row long, n int, counts binary"


def incidence(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """A written table with two kinds of rows.

    ``gram`` null: one for each document with its size and the key of its set; ``counts`` only where the key is its
    own, that is for the first of the copies in a task.  ``gram`` set: the leading columns of such a first copy, negative
    for frequent n-grams.
    """
    frequent = frequent_grams(docs, n)
    order = np.argsort(frequent)
    sorted_grams, rank = frequent[order], order.astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                ids, marks = part.column("doc_id").to_pylist(), part.column("row")
                keys, sizes, counts, columns = [], [], [], []
                for doc_id, grams in zip(ids, _sets(part.column("text"), n), strict=True):
                    sizes.append(len(grams))
                    if doc_id is None:
                        keys.append(None)
                        counts.append(None)
                        continue
                    digest, key = _key(doc_id, grams)
                    fresh = digest not in first
                    keys.append(first.setdefault(digest, key))
                    counts.append(_bucket_counts(grams) if fresh else None)
                    if fresh and len(grams):
                        place = grams >> np.uint64(1)
                        if len(sorted_grams):
                            at = np.minimum(np.searchsorted(sorted_grams, grams), len(sorted_grams) - 1)
                            place = np.where(sorted_grams[at] == grams, np.uint64(1 << 63) + rank[at], place)
                        lead = len(grams) + (-percent * len(grams) // 100) + 1
                        columns.append((key, np.partition(place, lead - 1)[:lead] if lead < len(grams) else place, len(grams)))
                rows = len(ids)
                grams = np.concatenate([c for _, c, _ in columns]).view(np.int64) if columns else np.zeros(0, np.int64)
                times = [len(c) for _, c, _ in columns]
                owners, owned = (np.repeat(np.array([c[i] for c in columns], np.int64), times) for i in (0, 2))
                none = pa.nulls(len(grams))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(grams)]),
                        pa.concat_arrays([pa.array(keys, pa.int64()), pa.array(owners, pa.int64())]),
                        pa.concat_arrays([pa.array(ids, pa.int64()), none.cast(pa.int64())]),
                        pa.concat_arrays([marks, none.cast(pa.int64())]),
                        pa.concat_arrays([pa.array(sizes, pa.int32()), pa.array(owned.astype(np.int32))]),
                        pa.concat_arrays([pa.array(counts, pa.binary()), none.cast(pa.binary())]),
                    ],
                    ["gram", "key", "doc_id", "row", "n", "counts"],
                )

    return materialize(docs.select("doc_id", "text", "row").mapInArrow(run, _MATRIX))


def drop_alone(percent: int):
    """Of rows sorted by ``gram``, ``n`` and ``key``, those that have another with their n-gram and a size near theirs.

    Rows equal in n-gram and key count once.
    """

    def near(batch: pa.RecordBatch) -> np.ndarray:
        gram, n = batch.column("gram").to_numpy(), batch.column("n").to_numpy().astype(np.int64)
        return (gram[1:] == gram[:-1]) & (100 * n[:-1] >= percent * n[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        kept = False  # the held row is near the row before
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            gram, key = batch.column("gram").to_numpy(), batch.column("key").to_numpy()
            if len(gram):
                batch = batch.filter(pa.array(np.concatenate([[True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])])))
            if not batch.num_rows:
                continue
            after = near(batch)
            before = np.concatenate([[kept], after])
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(before[:-1] | after))
            held, kept = batch.slice(batch.num_rows - 1), bool(before[-1])
        if held is not None and kept:
            yield held

    return run


class Counts:
    """Bucket counts of many sets, compared pair by pair in the buckets of the coarser one."""

    def __init__(self, column: pa.Array) -> None:
        rows = column.to_pylist()
        self.buckets = np.array([len(r) for r in rows], np.int64)
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.buckets).tolist():
            # Sets of similar size have as many buckets, or half or twice as many: each set is kept at two levels.
            at = np.flatnonzero((self.buckets == size) | (self.buckets == 2 * size))
            table = np.empty((len(at), size), np.int16)
            for i, row in enumerate(at.tolist()):
                own = np.frombuffer(rows[row], np.uint8)
                table[i] = own if len(own) == size else np.minimum(own[:size].astype(np.int16) + own[size:], 255)
            place = np.zeros(len(rows), np.int64)
            place[at] = np.arange(len(at))
            self.levels[size] = table, place

    def apart(self, i: np.ndarray, other: Counts, j: np.ndarray) -> np.ndarray:
        """The sum of differences between the rows ``i`` here and ``j`` there; 0 where they have no level in common."""
        out = np.zeros(len(i), np.int64)
        common = np.minimum(self.buckets[i], other.buckets[j])
        near = np.maximum(self.buckets[i], other.buckets[j]) <= 2 * common
        for size in np.unique(common[near]).tolist():
            if size not in self.levels or size not in other.levels:
                continue  # the finer side alone holds this level
            (a, at_a), (b, at_b) = self.levels[size], other.levels[size]
            here = np.flatnonzero(near & (common == size))
            step = max(1, 8_000_000 // size)
            for k in range(0, len(here), step):
                some = here[k : k + step]
                out[some] = np.abs(a[at_a[i[some]]] - b[at_b[j[some]]]).sum(1, dtype=np.int64)
        return out


def _within_bound(n0: np.ndarray, n1: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether bucket counts leave room for the similarity: the symmetric difference of two sets is at least the sum
    of the differences in the buckets, and at most (1 - t) / (1 + t) of both sizes."""
    return (100 + percent) * apart <= (100 - percent) * (n0.astype(np.int64) + n1)


def _bounded(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``x, y, apart`` of the pairs (``x, y``) that the bound by bucket counts leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = Counts(pa.concat_arrays([batch.column("cx"), batch.column("cy")]))
            i = np.arange(batch.num_rows)
            apart = both.apart(i, both, i + batch.num_rows)
            ok = _within_bound(batch.column("nx").to_numpy(), batch.column("ny").to_numpy(), apart, percent)
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("x").take(at), batch.column("y").take(at), pa.array(apart[ok])], ["x", "y", "apart"])

    sizes = rows.select("key", "n", "counts")
    left = sizes.select(F.col("key").alias("x"), F.col("n").alias("nx"), F.col("counts").alias("cx"))
    right = sizes.select(F.col("key").alias("y"), F.col("n").alias("ny"), F.col("counts").alias("cy"))
    return pairs.join(left, "x").join(right, "y").mapInArrow(run, "x long, y long, apart long")


def _multiply(percent: int):
    """Pairs of rows in one piece of a column, with different labels and room for the similarity.

    A pair whose documents have the column before in common as well is left to that column.  Rows come sorted by piece.  ``role`` 2: every two rows of the piece meet; else a 1 meets a 0.
    """

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        piece = batch.column("piece").to_numpy()
        key, label, n, role, before = (batch.column(c).to_numpy() for c in ("key", "label", "n", "role", "before"))
        counts = Counts(batch.column("counts"))
        starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        longest = int(np.diff(np.concatenate([starts, [len(piece)]])).max(initial=1))
        found = []
        for step in range(1, longest):
            i = np.flatnonzero((piece[step:] == piece[:-step]) & (label[step:] != label[:-step]))
            j = i + step
            meet = (role[i] + role[j] == 4) | (role[i] + role[j] == 1)
            meet &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            meet &= before[i] != before[j]  # else both lie in that column too
            i, j = i[meet], j[meet]
            ok = _within_bound(n[i], n[j], counts.apart(i, counts, j), percent)
            found.append(np.stack([np.minimum(key[i[ok]], key[j[ok]]), np.maximum(key[i[ok]], key[j[ok]])], 1))
        both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            piece = batch.column("piece").to_numpy()
            cut = int(np.searchsorted(piece, piece[-1]))  # the last piece may go on in the next batch
            if cut:
                yield pairs(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None:
            yield pairs(held)

    return run


def pieces(columns: DataFrame) -> DataFrame:
    """Deal the rows of each column (``gram``, with a ``label`` per row) over pieces of bounded size.

    A column of at most ``COLUMN_ROWS`` rows is one piece.  In a longer one every pair with different labels has a row
    outside the column's most frequent label; those rows, in lots, meet all rows, in lots.
    """
    by_label = columns.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("c"))
    per = by_label.groupBy("gram").agg(F.sum("c").alias("rows"), F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
    per = per.filter("labels > 1").select(
        "gram", "rows", F.col("top.label").alias("main"),
        F.ceil(F.col("rows") / COLUMN_ROWS).cast("int").alias("lots"),
        F.ceil((F.col("rows") - F.col("top.c")) / COLUMN_ROWS).cast("int").alias("odd_lots"),
    )
    # One lot alone is one piece in which all rows meet.
    dealt = columns.join(per, "gram")
    lot = F.pmod(F.xxhash64("key", F.lit(1)), F.col("lots")).cast("int")
    odd = F.pmod(F.xxhash64("key", F.lit(2)), F.col("odd_lots")).cast("int")
    zero = F.lit(0)
    home = F.transform(F.sequence(zero, F.col("odd_lots") - 1), lambda i: F.struct(lot.alias("l"), i.alias("o"), F.lit(1).alias("role")))
    away = F.transform(F.sequence(zero, F.col("lots") - 1), lambda i: F.struct(i.alias("l"), odd.alias("o"), F.lit(0).alias("role")))
    one = F.array(F.struct(zero.alias("l"), zero.alias("o"), F.lit(2).alias("role")))
    places = F.when(F.col("lots") == 1, one).when(F.col("label") == F.col("main"), home).otherwise(F.concat(home, away))
    placed = dealt.select(*columns.columns, F.explode(places).alias("p"))
    return placed.select(F.xxhash64("gram", "p.l", "p.o").alias("piece"), *[c for c in columns.columns if c != "gram"], F.col("p.role").alias("role"))


def overlap(percent: int):
    """Add up the whole overlap of each pair and keep those with the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grams = None, np.zeros(0, np.uint64)
        for batch in batches:
            xs, ys = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            out = []
            for i, (x, y) in enumerate(zip(xs, ys, strict=True)):
                here = np.frombuffer(batch.column("grams")[i].as_buffer(), np.uint64)
                if y is None:
                    own, grams = x, here.copy()
                elif x == own:
                    both = len(np.intersect1d(grams, here, assume_unique=True))
                    if 100 * both >= percent * (len(grams) + len(here) - both):
                        out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return run


def _links(pairs: DataFrame, docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """``a, b``: the pairs (``x, y``) whose similarity reaches ``percent``, a written table.

    Whole texts are read again for the documents in question only.  The first of a pair travels once per lot of its
    partners, the second once per pair; a task holds one set and compares the partners that stream by.
    """
    pairs = materialize(pairs.select("x", "y", F.pmod(F.xxhash64("y"), F.lit(SALTS)).alias("lot")))
    needed = materialize(pairs.select(F.col("x").alias("key")).unionByName(pairs.select(F.col("y").alias("key"))).distinct().join(rows.select("key", "doc_id"), "key"))
    ids = broadcast_if_few(needed.select("doc_id").distinct())

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows have one key and one set
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(_key(i, g)[1], g) for i, g in zip(part.column("doc_id").to_pylist(), _sets(part.column("text"), n), strict=True)]
                fresh = [(k, g.tobytes()) for k, g in found if k not in seen and not seen.add(k)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in fresh], pa.int64()), pa.array([g for _, g in fresh], pa.binary())], ["key", "grams"])

    # One row for each part a set plays: the first of its pairs, once per lot, and the second of each of its pairs.
    none = F.lit(None).cast("long").alias("y")
    parts = pairs.select(F.col("x").alias("key"), "x", "lot", none).distinct().unionByName(pairs.select(F.col("y").alias("key"), "x", "lot", "y"))
    with rows_per_batch(docs.sparkSession, SET_ROWS):
        found = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(sets, "key long, grams binary")
        met = found.join(broadcast_if_few(parts), "key").select("x", "lot", "y", "grams").repartition("x", "lot")
        return materialize(met.sortWithinPartitions("x", "lot", F.col("y").asc_nulls_first()).mapInArrow(overlap(percent), "a long, b long"))


def _linked(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, key, n, counts`` of every document, and ``key, label`` of the keys that link."""
    table = incidence(docs, n, percent)
    members = table.filter("gram IS NULL").select("doc_id", "row", "key", "n", "counts")
    rows = members.filter("counts IS NOT NULL AND n > 0").select("key", "doc_id", "n", "counts")
    leading = table.filter("gram IS NOT NULL").select("gram", "key", "n")
    # Frequent n-grams have company for certain, and stay where they are.
    rare = leading.filter("gram >= 0").repartition("gram").sortWithinPartitions("gram", "n", "key")
    shared = rare.mapInArrow(drop_alone(percent), "gram long, key long, n int").unionByName(leading.filter("gram < 0"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))) if percent < 100 else F.col("n")
    # Each row knows its document's column before, so that a pair is formed where its common columns begin.
    before = F.coalesce(F.lag("gram").over(Window.partitionBy("key").orderBy("gram")), F.col("key"))
    shared = materialize(shared.withColumns({"size_class": size_class.cast("int"), "before": before}))

    links, labels = None, None

    def labelled() -> DataFrame:
        if labels is None:
            return shared.withColumn("label", F.col("key"))
        return shared.join(broadcast_if_few(labels), "key", "left").withColumn("label", F.coalesce("label", "key"))

    def add(pairs: DataFrame) -> None:
        nonlocal links, labels
        new = _links(pairs, docs, rows, n, percent)
        links = new if links is None else links.unionByName(new)
        labels = materialize(components(links).select(F.col("node").alias("key"), F.col("component").alias("label")))

    for turn in range(STAR_PASSES):
        columns = labelled()
        # One row of each column and class of sizes meets the others.
        first = F.min(F.struct(F.xxhash64("gram", "key", F.lit(turn)).alias("h"), "key", "label", "n"))
        lead = columns.groupBy("gram", "size_class").agg(first.alias("f"), F.min("label").alias("low"), F.max("label").alias("high"))
        lead = lead.filter("low <> high").select("gram", "size_class", F.col("f.key").alias("x"), F.col("f.label").alias("x_label"), F.col("f.n").alias("x_n"))
        star = columns.join(lead, ["gram", "size_class"]).filter(f"label <> x_label AND 100 * least(n, x_n) >= {percent} * greatest(n, x_n)")
        star = star.select("x", F.col("key").alias("y")).distinct()
        nearest = Window.partitionBy("y").orderBy("apart", "x")
        one = _bounded(star, rows, percent).withColumn("r", F.row_number().over(nearest)).filter("r = 1")
        add(one.select("x", "y"))

    dealt = pieces(labelled()).join(rows.select("key", "counts"), "key").repartition("piece").sortWithinPartitions("piece")
    add(dealt.mapInArrow(_multiply(percent), "x long, y long").distinct())
    return members, labels


def _placed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, row, n, label`` of every document; linked documents, and no others, share a label, null without words."""
    with rows_per_batch(docs.sparkSession, TEXT_ROWS):
        members, labels = _linked(docs, n, percent)
    label = F.when(F.col("n") > 0, F.coalesce("label", "key")).alias("label")
    return members.join(labels, "key", "left").select("doc_id", "row", "n", label)


def document_components(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z folded.  A document's set holds its distinct
    ``n``-word shingles; with fewer words the whole sequence is one, and without words the set is empty and links with
    nothing.  Documents link when 100 |A & B| >= ``percent`` |A | B|.  ``component_id`` is the smallest id that links
    lead to, its own included.  The result is exact: the bounds discard no pair that links.

    Null texts count as empty.  Rows with a null id take no part and return with a null component.  Rows that repeat an
    id are documents of their own that share it.  Other columns are ignored.  An empty table returns no row.  Eager.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("long").alias("row"))
    placed = _placed(docs, n, percent)
    least = placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "label", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every group of linked documents one row stays.

    It is the one with the smallest id; rows without an id come last, and among equals a hash of the text decides.  Rows
    of one id with different texts are documents of their own, rows equal in id and text are one.  Documents without
    words link with nothing and stay, all of them where they have no id.  All columns are kept as they are.  Eager.
    """
    ids = F.col(doc_id).cast("long")
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    # The last bit says that there is no id; the hash stands in for one then.
    row = own.bitwiseAND(F.lit(-2)).bitwiseOR(F.when(ids.isNull(), 1).otherwise(0).cast("long"))
    marked = docs.withColumns({"__of_id": F.coalesce(ids, own), "__of_row": row})
    placed = materialize(_placed(marked.select(F.col("__of_id").alias("doc_id"), F.col(text).alias("text"), F.col("__of_row").alias("row")), n, percent))
    same = placed.groupBy("label", "doc_id", "row").agg(F.count(F.lit(1)).alias("times"))
    order = F.struct(F.col("row").bitwiseAND(F.lit(1)).alias("lost"), "doc_id", "row", "times")
    chosen = same.filter("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("c")).select("c.doc_id", "c.row", "c.times")
    chosen = chosen.unionByName(same.filter("label IS NULL AND row & 1 = 0").select("doc_id", "row", "times"))
    chosen = materialize(chosen.select(F.col("doc_id").alias("__of_id"), F.col("row").alias("__of_row"), "times"))
    keys = ["__of_id", "__of_row"]
    once, many = (broadcast_if_few(chosen.filter(c).select(keys)) for c in ("times = 1", "times > 1"))
    wordless = ~F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    kept = marked.join(once, keys, "left_semi").unionByName(marked.join(many, keys, "left_semi").dropDuplicates(keys))
    return kept.unionByName(marked.filter(ids.isNull() & wordless)).select(*docs.columns)
