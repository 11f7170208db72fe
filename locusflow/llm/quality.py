"""Supervised subword embeddings that score the quality of whole texts (operator 8).

A text's vector is the mean over its words of three learned vectors: the word's, the mean of its character
n-grams', and that of the pair it makes with the word before.  All are hashed into one table.  Softmax over two
classes follows; table and output weights are trained by stochastic gradient descent in numpy on a bounded sample
of labelled rows.  Scoring is linear up to the softmax, so tasks get the table already multiplied by the output
weights: one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from locusflow.llm.batches import rows_per_batch
from locusflow.llm.words import give_back, mixed, slices, split_words, word_hashes
from locusflow.session import materialize

BUCKETS = 1 << 17
#: Lengths of character n-grams, counted in bytes with one space before and after the word.
GRAMS = (2, 3, 4)
#: Labelled rows used for training: at most so many of each label, and at most so many bytes of text in all.
ROWS_PER_LABEL = 1500
TRAINING_BYTES = 48 * 1024 * 1024


class Model(NamedTuple):
    """Per-bucket share of the log odds for label 1, and the log odds of a text without words."""

    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """True for rows never learned from: CRC-32 of the id as text leaves 2 modulo 4.  A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def word_grams(distinct: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(word number, bucket)`` of every character n-gram of each word, one length of n-gram at a time."""
    raw = np.frombuffer((" " + " ".join(distinct) + " ").encode() if distinct else b"", np.uint8)
    gap = np.cumsum(raw == 32, dtype=np.int32)
    for n in GRAMS:
        size = len(raw) - n + 1
        if size <= 0:
            continue
        at = np.flatnonzero(gap[n - 2 : n - 2 + size] == gap[:size])  # no gap inside, only at the ends
        code = np.full(len(at), n << 40, np.uint64)
        for k in range(n):
            code += raw[at + k].astype(np.uint64) << np.uint64(8 * k)
        yield gap[at] - 1, (mixed(code) % np.uint64(buckets)).astype(np.int32)


def pair_buckets(hashes: np.ndarray, starts: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each word's pair with the word before; the first word of a text pairs with a mark, and a word that
    repeats the one before shares one bucket with all such words."""
    before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]]) if len(hashes) else hashes
    first = starts[:-1][np.diff(starts) > 0]
    same = before == hashes
    pair = mixed(before * np.uint64(0x9E3779B97F4A7C15) + hashes)
    pair[same] = mixed(np.array([1], np.uint64))[0]
    pair[first] = mixed(hashes[first] + np.uint64(2))
    return (pair % np.uint64(buckets)).astype(np.int64)


def _features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The mean of every text as sparse rows: ``(row, bucket, share)``, buckets of a row distinct."""
    rows, places, shares = [], [], []
    words = split_words(texts)
    hashes = word_hashes(words.distinct)
    every = list(word_grams(words.distinct, buckets)) or [(np.zeros(0, np.int32), np.zeros(0, np.int32))]
    owner, gram = (np.concatenate(x) for x in zip(*every, strict=True))
    order = np.argsort(owner, kind="stable")
    gram = gram[order]
    first = np.searchsorted(owner[order], np.arange(len(words.distinct) + 1))
    single = (mixed(hashes + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
    pairs = pair_buckets(hashes[words.places], words.starts, buckets)
    for row, (a, b) in enumerate(zip(words.starts[:-1], words.starts[1:], strict=True)):
        kinds, times = np.unique(words.places[a:b], return_counts=True)
        sizes = first[kinds + 1] - first[kinds]
        at = np.repeat(first[kinds] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        place = np.concatenate([single[kinds], gram[at], pairs[a:b]])
        share = np.concatenate([times, np.repeat(times / np.maximum(sizes, 1), sizes), np.ones(b - a)]) / max(b - a, 1)
        place, inverse = np.unique(place, return_inverse=True)
        rows.append(np.full(len(place), row, np.int32))
        places.append(place.astype(np.int32))
        shares.append(np.bincount(inverse, share, len(place)).astype(np.float32))
    empty = [np.zeros(0, np.int32)]
    return np.concatenate(rows or empty), np.concatenate(places or empty), np.concatenate(shares or empty)


class Weights(NamedTuple):
    """What an epoch changes: the table of vectors, the output weights and their bias."""

    table: np.ndarray
    out: np.ndarray
    bias: np.ndarray


_GROUP = "g int, y binary, row binary, used binary, place binary, share binary"


def _grouped(key: tuple, texts: pa.Table) -> pa.Table:
    """Features of the texts of one step, as one row."""
    row, place, share = _features(texts.column("__text").combine_chunks(), BUCKETS)
    used, where = np.unique(place, return_inverse=True)
    y = texts.column("__y").to_numpy().astype(np.int32)
    parts = [y, row.astype(np.int32), used.astype(np.int32), where.astype(np.int32), share.astype(np.float32)]
    arrays = [pa.array([key[0].as_py()], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]]
    return pa.Table.from_arrays(arrays, names=[f.split()[0] for f in _GROUP.split(", ")])


def _step(w: Weights, group: dict[str, np.ndarray], share_of_label: tuple[float, float], step: float) -> None:
    """One step of stochastic gradient descent, in place."""
    y, row, used, where, share = (group[c] for c in ("y", "row", "used", "place", "share"))
    size = w.table.shape[1]
    vectors = w.table[used]
    hidden = np.stack([np.bincount(row, share * vectors[where, k], len(y)) for k in range(size)], 1)
    odds = hidden @ w.out + w.bias
    chance = np.exp(odds - odds.max(1, keepdims=True))
    chance /= chance.sum(1, keepdims=True)
    error = (chance - np.eye(2)[y]) * np.array(share_of_label)[y][:, None] / len(y)
    back = (error @ w.out.T).astype(np.float32)
    w.out[:] -= (step / 8 * hidden.T @ error).astype(np.float32)
    w.bias[:] -= (step / 8 * error.sum(0)).astype(np.float32)
    slope = np.stack([np.bincount(where, share * back[row, k], len(used)) for k in range(size)], 1)
    w.table[used] = vectors - (step * len(y) * slope).astype(np.float32)


def fit(sample: DataFrame, counts: dict[int, int], size: int = 8, epochs: int = 12, rate: float = 8.0, batch: int = 50, seed: int = 5) -> Model:
    """Train on the rows of ``sample`` (``doc_id``, ``__text``, 0/1 ``__y``; ``counts`` of each) by stochastic gradient descent.

    Each label counts for half.  Features are made once, one row of a written table for each step; an epoch is a job of
    one task in which the weights and then these rows stream by, in an order of its own, and which writes the weights it
    ends with.  So a task holds the weights and a few steps, and the driver sees the last weights only.  With one label
    only the model knows nothing but that.
    """
    if not counts.get(0) or not counts.get(1):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    spark, whole = sample.sparkSession, counts[0] + counts[1]
    share_of_label = (0.5 * whole / counts[0], 0.5 * whole / counts[1])
    groups = -(-whole // batch)
    number = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(groups)).cast("int")
    features = materialize(sample.withColumn("g", number).select("g", "__text", "__y").groupBy("g").applyInArrow(_grouped, _GROUP))
    kinds = {"y": np.int32, "row": np.int32, "used": np.int32, "place": np.int32, "share": np.float32}
    names = ["g", *kinds]

    def epoch(number: int, state: DataFrame | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = np.random.default_rng(seed).uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32)
            w = Weights(first, np.zeros((size, 2), np.float32), np.zeros(2, np.float32))
            done = 0
            for b in batches:
                for i in range(b.num_rows):
                    group = {c: np.frombuffer(b.column(c)[i].as_buffer(), k) for c, k in kinds.items()}
                    if b.column("g")[i].as_py() < 0:  # the weights come first
                        w = Weights(*(group[c].view(np.float32).reshape(x.shape).copy() for c, x in zip(("y", "row", "used"), w, strict=True)))
                        continue
                    _step(w, group, share_of_label, rate * (1 - (number * groups + min(done, groups)) / (epochs * groups)))
                    done += 1
            parts = [x.tobytes() for x in w] + [b"", b""]
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *[pa.array([x], pa.binary()) for x in parts]], names)

        rows = features if state is None else features.unionByName(state)
        turn = F.when(F.col("g") >= 0, F.xxhash64("g", F.lit(number))).asc_nulls_first()
        return materialize(rows.repartition(1).sortWithinPartitions(turn).mapInArrow(run, _GROUP))

    state = None
    with rows_per_batch(spark, 2):
        for number in range(epochs):
            state = epoch(number, state)
    last = state.select("y", "row", "used").first()
    table, out, bias = (np.frombuffer(x, np.float32) for x in last)
    out = out.reshape(size, 2)
    return Model((table.reshape(BUCKETS, size) @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, most_bytes: int = TRAINING_BYTES, label: str = "quality") -> Model:
    """Fit on rows of ``labels`` (``doc_id``, 0/1 ``label``) that are not held out, joined to their whole texts.

    At most ``rows_per_label`` rows of each label are used, the first by a hash of the id, and of those as many as
    hold ``most_bytes`` of text: a bounded sample whatever the input.  The odds are then set to the shares of the
    labels over all rows that may be learned from.  Null labels, ids and texts are left out.  Eager.
    """
    usable = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("__y")).filter("__y IN (0, 1)")
    totals = {r["__y"]: r["n"] for r in usable.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [usable.filter(F.col("__y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label) for y in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]))  # at most 2 * rows_per_label rows
    texts = docs.select("doc_id", F.col("text").alias("__text")).filter("__text IS NOT NULL")
    sample = materialize(texts.join(F.broadcast(chosen), "doc_id").withColumn("__n", F.octet_length("__text")))
    first = F.min(F.struct("__n", F.xxhash64("__text").alias("h"), "__y")).alias("f")  # of repeated ids one row
    one = sample.groupBy("doc_id").agg(first).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows_per_label)
    spent, ids, counts = 0, [], {0: 0, 1: 0}
    for r in one.select("doc_id", "f.__n", "f.h", "f.__y").collect():
        if spent + r["__n"] <= most_bytes:
            spent += r["__n"]
            counts[r["__y"]] += 1
            ids.append((r["doc_id"], r["h"], r["__y"]))
    prior = np.log((totals.get(1, 0) + 1) / (totals.get(0, 0) + 1))
    if not ids:
        return Model(np.zeros(BUCKETS, np.float32), float(prior))
    rows = docs.sparkSession.createDataFrame(ids, "doc_id long, h long, __y int")
    used = sample.withColumn("h", F.xxhash64("__text")).join(F.broadcast(rows), ["doc_id", "h", "__y"])
    model = fit(used.dropDuplicates(["doc_id"]).select("doc_id", "__text", "__y"), counts)
    give_back()
    return model._replace(bias=model.bias + float(prior))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (chance of label 1) and ``predicted`` (1 where it reaches ``threshold``) to ``docs``.

    Null and blank texts get the score of a text without words.  Other columns are kept; ones of the same names are
    replaced.  Rows are scored one by one: repeats get equal scores.
    """
    weights, bias, buckets = model.weights, model.bias, len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                hashes = word_hashes(words.distinct)
                n = len(words.distinct)
                inner, many = np.zeros(n), np.zeros(n)
                for owner, gram in word_grams(words.distinct, buckets):
                    inner += np.bincount(owner, weights[gram], n)
                    many += np.bincount(owner, minlength=n)
                alone = weights[(mixed(hashes + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)]
                each = (alone + inner / np.maximum(many, 1))[words.places] + weights[pair_buckets(hashes[words.places], words.starts, buckets)]
                sizes = np.diff(words.starts)
                total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), each, len(sizes))
                odds = total / np.maximum(sizes, 1) + bias
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.round(1 / (1 + np.exp(-np.clip(odds, -60, 60))), 12))],
                    [*part.schema.names, "score"],
                )

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema.fields)
    scored = docs.select(kept).mapInArrow(run, f"{schema}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
