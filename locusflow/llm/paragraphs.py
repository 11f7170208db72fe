"""Repeated passages across documents by MinHash banding of paragraphs (operator 9).

A paragraph here is a line, or part of one: after two sentences in three, chosen by hash among those of some words,
and after every long one, a new paragraph begins.  Such
cuts depend on the text at hand only, so a passage that stands inside different lines is cut alike in all of them.
Sentences of many words are also cut after words chosen by hash; these
pieces are paragraphs besides, compared among themselves.  Paragraphs are sets of word shingles.  Equal sets share a key.  Keys that collide in a band are compared exactly, links
are clustered into components, and every paragraph of a cluster but the first is a repeat.  Runs of repeats of enough
words are reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from locusflow.llm.batches import TEXT_ROWS, broadcast_if_few, rows_per_batch
from locusflow.llm.components import components
from locusflow.llm.ngram_join import SALTS, STAR_PASSES, drop_alone, overlap, pieces
from locusflow.llm.words import mixed, shingles_of, slices, split_words, word_hashes
from locusflow.session import materialize

#: Chance that bands must find a pair at the threshold, and highest chance allowed at half of it.
RECALL, NOISE = 0.98, 0.6
#: Words of a sentence that can end a paragraph, at least.
SENTENCE_WORDS = 3
#: Words from which on a sentence counts as long, words whose hash chooses a cut there, and words between such cuts.
LONG_WORDS, CUT_WORDS, CUT_EVERY = 25, 3, 4
#: Ends of sentences, and what may close after them.
STOPS, CLOSERS = ".!?\u2026\u3002\uff01\uff1f\uff0e\uff61", "\"')]}>*_\u00bb\u203a\u201d\u2019\u300d\u300f\uff09\u3011\u300b"
#: Words that a run of repeats must hold to be reported.
LEAST_WORDS = 25


def tune(threshold: float, recall: float = RECALL, noise: float = NOISE) -> tuple[int, int]:
    """The fewest ``bands`` (and their ``rows``) that find a pair at ``threshold`` with chance ``recall`` and one at
    half of it with at most ``noise``; without such a choice, the one with the least noise."""
    found = []
    for rows in range(1, 7):
        bands = next(b for b in range(1, 1000) if 1 - (1 - threshold**rows) ** b >= recall)
        chance = 1 - (1 - (threshold / 2) ** rows) ** bands
        found.append((chance > noise, bands if chance <= noise else chance, bands, rows))
    return min(found)[2:]


class Units(NamedTuple):
    """Paragraphs of a slice of documents: document, number in it, first word, words, whether it is a piece of a long
    sentence; and their shingles in a row."""

    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    size: np.ndarray
    inside: np.ndarray
    grams: np.ndarray
    starts: np.ndarray


def split_units(texts: pa.Array, n: int) -> Units:
    """Cut texts into paragraphs and take each one's distinct shingle hashes, sorted.

    Pieces of long sentences follow, with the number of their paragraph; their hashes are unlike those of paragraphs.
    Paragraphs without words are none.  One with fewer than ``n`` words is one shingle.
    """
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    row_of_line = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy())
    words = split_words(pc.ascii_lower(lines.flatten()))
    hashes = word_hashes(words.distinct)[words.places] if len(words.places) else np.zeros(0, np.uint64)
    last = pc.utf8_slice_codeunits(pc.utf8_rtrim(pa.array(words.distinct, pa.string()), CLOSERS), -1)
    stops = pc.is_in(last, pa.array(list(STOPS))).to_numpy(zero_copy_only=False)[words.places] if len(words.places) else np.zeros(0, bool)
    total = len(hashes)
    # A sentence's hash: the sum of its words' hashes since the last stop or line start, whatever stands before.
    begins = np.zeros(total + 1, bool)
    begins[words.starts] = True
    begins[1:] |= np.concatenate([stops, [False]])[:total] if total else False
    heads = np.flatnonzero(begins[:total])
    sentence = np.add.reduceat(hashes, heads) if len(heads) else np.zeros(0, np.uint64)
    ends = np.concatenate([heads[1:], [total]]) if len(heads) else heads
    cut = np.zeros(total + 1, bool)
    cut[words.starts] = True
    if len(heads):
        # A long sentence may begin outside a repeated passage: its end always cuts, as its hash may differ.
        chosen = (mixed(sentence) % np.uint64(3) > 0) | (ends - heads >= LONG_WORDS)
        closing = ends[stops[ends - 1] & (ends - heads >= SENTENCE_WORDS) & chosen]
        cut[closing] = True
    at = np.flatnonzero(cut[:total])
    size = np.diff(np.concatenate([at, [total]]))
    line = np.searchsorted(words.starts, at, "right") - 1
    row = row_of_line[line] if len(at) else np.zeros(0, np.int64)
    new = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    number = np.arange(len(row)) - np.repeat(head, np.diff(np.concatenate([head, [len(row)]])))
    first = at - at[head][np.cumsum(new) - 1] if len(row) else at
    grams, starts = _set(hashes, np.concatenate([at, [total]]), n, False)
    paragraphs = Units(row, number, first, size, np.zeros(len(at), bool), grams, starts)
    # Cuts within long sentences depend on the words right before them, whatever the sentence begins with.
    length = ends - heads
    since = np.arange(total) - np.repeat(heads, length)
    places = np.flatnonzero((since >= CUT_WORDS) & np.repeat(length >= LONG_WORDS, length))
    before = np.zeros(len(places), np.uint64)
    for back in range(CUT_WORDS, 0, -1):
        before = mixed(before * np.uint64(0x9E3779B97F4A7C15) + hashes[places - back])
    more = places[before % np.uint64(CUT_EVERY) == 0]
    more = more[~cut[more]]
    if not len(more):
        return paragraphs
    owner = np.searchsorted(at, more, "right") - 1
    split = np.zeros(len(at), bool)
    split[owner] = True
    # There every sentence's end cuts, as what lies between the last chosen one and the long sentence would be lost.
    others = ends[stops[ends - 1] & (length >= SENTENCE_WORDS)]
    others = others[~cut[others]]
    more = np.union1d(more, others[split[np.searchsorted(at, others, "right") - 1]])
    begin = np.sort(np.concatenate([at[split], more]))
    owner = np.searchsorted(at, begin, "right") - 1
    taken = np.repeat(split, size)  # words of the paragraphs that are split
    seen = np.concatenate([[0], np.cumsum(taken)])
    edges = np.concatenate([seen[begin], [seen[-1]]])
    grams, starts = _set(hashes[taken], edges, n, True)
    pieces_ = (row[owner], number[owner], first[owner] + begin - at[owner], np.diff(edges), np.ones(len(owner), bool), grams)
    joined = [np.concatenate([a, b]) for a, b in zip(paragraphs[:6], pieces_, strict=True)]
    return Units(*joined, np.concatenate([paragraphs.starts[:-1], paragraphs.starts[-1] + starts]))


def _set(hashes: np.ndarray, edges: np.ndarray, n: int, inside: bool | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of runs of words, and where each run's begin; those of pieces (``inside``) are unlike others."""
    grams, starts = shingles_of(hashes, edges, n)
    inside = np.repeat(np.broadcast_to(inside, len(edges) - 1), np.diff(starts))
    return _distinct(np.where(inside, mixed(grams ^ np.uint64(0x5851F42D4C957F2D)), grams), starts)


def _distinct(grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each run, each once; runs that repeat none stay in their order."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # A value and its run in one number: runs without a number that stands twice repeat nothing.
    both = mixed(grams + mixed(owner.astype(np.uint64) + np.uint64(1)))
    ranked = np.sort(both)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return grams, starts
    odd = np.zeros(len(starts) - 1, bool)
    odd[owner[np.isin(both, twice)]] = True
    at = np.flatnonzero(odd[owner])
    order = np.lexsort((grams[at], owner[at]))
    at = at[order]
    again = np.concatenate([[False], (grams[at][1:] == grams[at][:-1]) & (owner[at][1:] == owner[at][:-1])])
    fresh = np.ones(len(grams), bool)
    fresh[at[again]] = False
    return grams[fresh], np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(starts) - 1))])


def _folded(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set: an order-free sum of its mixed hashes and its size."""
    if not len(values):
        return np.zeros(len(starts) - 1, np.int64)
    sums = np.add.reduceat(mixed(values + np.uint64(11)), starts[:-1])
    return mixed(sums + np.diff(starts).astype(np.uint64)).view(np.int64)


def _bands(grams: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes, one row per set and one column per band."""
    out = np.empty((len(starts) - 1, bands), np.uint64)
    for band in range(bands):
        key = np.full(len(out), band + 1, np.uint64)
        for row in range(rows):
            salt = mixed(np.array([band * rows + row + 101], np.uint64))[0]
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(mixed(grams ^ salt), starts[:-1]))
        out[:, band] = key
    return out


def occurrences(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, digest, number, first, size, inside, key, n, bands`` of every paragraph, a written table.

    ``bands`` stand once per key and slice of text.  Sets so small that one more element already takes the similarity
    below the threshold link to equal sets only.  Those share their key, so they have no bands.
    """
    bands, rows = tune(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                units = split_units(part.column("text"), n)
                if not len(units.size):
                    continue
                key, sizes = _folded(units.grams, units.starts), np.diff(units.starts)
                once = np.zeros(len(key), bool)
                once[np.unique(key, return_index=True)[1]] = True
                once &= 100 * sizes >= percent * (sizes + 1)
                values = np.zeros(0, np.int64)
                if once.any():
                    values = _bands(units.grams[np.repeat(once, sizes)], np.concatenate([[0], np.cumsum(sizes[once])]), bands, rows).view(np.int64).ravel()
                edges = pa.array(np.concatenate([[0], np.cumsum(once * bands)]).astype(np.int32), mask=np.append(~once, False))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(units.row)), part.column("digest").take(pa.array(units.row)), pa.array(units.number.astype(np.int32)), pa.array(units.first.astype(np.int32)),
                        pa.array(units.size.astype(np.int32)), pa.array(units.inside), pa.array(key), pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(edges, pa.array(values)),
                    ],
                    ["doc_id", "digest", "number", "first", "size", "inside", "key", "n", "bands"],
                )

    schema = "doc_id long, digest long, number int, first int, size int, inside boolean, key long, n int, bands array<long>"
    return materialize(docs.mapInArrow(run, schema))


def _sets(docs: DataFrame, n: int, found: DataFrame, needed: DataFrame) -> DataFrame:
    """``key, grams`` of the paragraphs with a key in ``needed``, a written table.

    Each is read again in one text only, found by id and ``digest``, and no other part of that text is hashed.  What has
    another key there (texts of one id whose digests are equal by chance) is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(pc.ascii_lower(part.column("text")))
                spans = part.column("spans")
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(spans).to_numpy())
                key, first, size, inside = (f.to_numpy(zero_copy_only=False) for f in spans.flatten().flatten())
                begin = words.starts[row] + first
                here = begin + size <= words.starts[row + 1]
                key, begin, size, inside = key[here], begin[here], size[here].astype(np.int64), inside[here]
                edges = np.concatenate([[0], np.cumsum(size)])
                places = words.places[np.repeat(begin - edges[:-1], size) + np.arange(edges[-1])]
                used, places = np.unique(places, return_inverse=True)
                hashes = word_hashes([words.distinct[i] for i in used.tolist()])[places]
                grams, starts = _set(hashes, edges, n, inside)
                at = np.flatnonzero(_folded(grams, starts) == key)
                values = [grams[starts[i] : starts[i + 1]].tobytes() for i in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(values, pa.binary())], ["key", "grams"])

    held = found.join(broadcast_if_few(needed.select("key").distinct()), "key", "left_semi")
    places = held.groupBy("key").agg(F.min(F.struct("doc_id", "digest", "first", "size", "inside")).alias("p"))
    spans = places.groupBy("p.doc_id", "p.digest").agg(F.collect_list(F.struct("key", "p.first", "p.size", "p.inside")).alias("spans"))
    texts = docs.join(broadcast_if_few(materialize(spans)), ["doc_id", "digest"]).select("text", "spans")
    return materialize(texts.mapInArrow(run, "key long, grams binary").dropDuplicates(["key"]))


def _compare(percent: int):
    """Links among the rows of each piece of a band, compared exactly; see ``pieces`` for ``role``."""

    def links(batch: pa.RecordBatch) -> pa.RecordBatch:
        piece, key, label, role = (batch.column(c).to_numpy() for c in ("piece", "key", "label", "role"))
        sets = [np.frombuffer(g, np.uint64) for g in batch.column("grams").to_pylist()]
        size = np.array([len(s) for s in sets])
        starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        longest = int(np.diff(np.concatenate([starts, [len(piece)]])).max(initial=1))
        out = []
        for step in range(1, longest):
            near = (piece[step:] == piece[:-step]) & (label[step:] != label[:-step])
            near &= 100 * np.minimum(size[step:], size[:-step]) >= percent * np.maximum(size[step:], size[:-step])
            meet = role[step:] + role[:-step]
            for i in np.flatnonzero(near & ((meet == 4) | (meet == 1))).tolist():
                a, b = sets[i], sets[i + step]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    out.append((int(key[i]), int(key[i + step])))
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            piece = batch.column("piece").to_numpy()
            cut = int(np.searchsorted(piece, piece[-1]))
            if cut:
                yield links(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None:
            yield links(held)

    return run


def clusters(docs: DataFrame, found: DataFrame, n: int, percent: int) -> DataFrame | None:
    """``key, label`` of the paragraph keys of ``found`` that link to other keys; None where no two keys collide."""
    banded = found.filter("bands IS NOT NULL").select(F.explode("bands").alias("gram"), "key", "n").repartition("gram").sortWithinPartitions("gram", "n", "key")
    shared = materialize(banded.mapInArrow(drop_alone(percent), "gram long, key long, n int"))
    if shared.isEmpty():
        return None
    sets = _sets(docs, n, found, shared)
    links, labels = None, None

    def labelled() -> DataFrame:
        if labels is None:
            return shared.withColumn("label", F.col("key"))
        return shared.join(broadcast_if_few(labels), "key", "left").withColumn("label", F.coalesce("label", "key"))

    for turn in range(STAR_PASSES):
        columns = labelled()
        first = F.min(F.struct(F.xxhash64("gram", "key", F.lit(turn)).alias("h"), "key", "label", "n"))
        lead = columns.groupBy("gram").agg(first.alias("f"), F.min("label").alias("low"), F.max("label").alias("high"))
        lead = lead.filter("low <> high").select("gram", F.col("f.key").alias("x"), F.col("f.label").alias("x_label"), F.col("f.n").alias("x_n"))
        star = columns.join(lead, "gram").filter(f"label <> x_label AND 100 * least(n, x_n) >= {percent} * greatest(n, x_n)").select("x", F.col("key").alias("y")).distinct()
        star = materialize(star.withColumn("lot", F.pmod(F.xxhash64("y"), F.lit(SALTS))))
        none = F.lit(None).cast("long").alias("y")
        parts = star.select(F.col("x").alias("key"), "x", "lot", none).distinct().unionByName(star.select(F.col("y").alias("key"), "x", "lot", "y"))
        met = sets.join(broadcast_if_few(parts), "key").select("x", "lot", "y", "grams").repartition("x", "lot").sortWithinPartitions("x", "lot", F.col("y").asc_nulls_first())
        new = materialize(met.mapInArrow(overlap(percent), "a long, b long"))
        links = new if links is None else links.unionByName(new)
        labels = materialize(components(links).select(F.col("node").alias("key"), F.col("component").alias("label")))
    dealt = pieces(labelled()).join(sets, "key").repartition("piece").sortWithinPartitions("piece")
    links = links.unionByName(materialize(dealt.mapInArrow(_compare(percent), "a long, b long")))
    return materialize(components(links).select(F.col("node").alias("key"), F.col("component").alias("label")))


def repeated_passages(docs: DataFrame, n: int = 5, percent: int = 80, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of repeated paragraphs: ``doc_id, first_word, n_words, n_paragraphs, kept_doc_ids``, a row per run.

    Words are numbered from 0 within a document.  Of each cluster the paragraph with the smallest ``doc_id`` and then
    place stays; the others are repeats.  Repeats that follow each other form a run, which is reported from
    ``least_words`` words on.  ``kept_doc_ids`` lists the documents that hold the kept paragraphs of the run, rising.
    Null and blank texts have no paragraph.  Rows with a null id take no part.  Rows that repeat an id are one document
    whose paragraphs may stand twice: the second is a repeat of the first.  Other columns are ignored.  Eager.
    """
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest")).filter("doc_id IS NOT NULL")
    with rows_per_batch(docs.sparkSession, TEXT_ROWS):
        found = occurrences(whole, n, percent)
        labels = clusters(whole, found, n, percent)
    if labels is not None:
        found = found.join(broadcast_if_few(labels), "key", "left").withColumn("label", F.coalesce("label", "key"))
    else:
        found = found.withColumn("label", F.col("key"))
    placed = found.select("doc_id", "number", "first", "size", "label")
    kept = placed.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "number", "first")).alias("kept")).filter("n > 1")
    repeats = placed.join(kept, "label").filter(F.struct("doc_id", "number", "first") > F.col("kept")).select("doc_id", "number", "first", "size", F.col("kept.doc_id").alias("kept_doc_id"))
    # A piece may lie in a repeated paragraph: runs are unions of word ranges, and only ranges that reach further count.
    order = Window.partitionBy("doc_id").orderBy("first", F.col("size").desc(), "number")
    ranges = repeats.dropDuplicates(["doc_id", "number", "first", "size"]).withColumn("end", F.col("first") + F.col("size"))
    ranges = ranges.withColumn("reached", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
    runs = ranges.withColumn("run", F.sum((F.col("first") > F.col("reached")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("further", F.col("end") > F.col("reached"))
    return (
        runs.groupBy("doc_id", "run")
        .agg(
            F.min("first").cast("long").alias("first_word"), (F.max("end") - F.min("first")).cast("long").alias("n_words"),
            F.count_if("further").alias("n_paragraphs"), F.array_sort(F.collect_set(F.when(F.col("further"), F.col("kept_doc_id")))).alias("kept_doc_ids"),
        )
        .filter(F.col("n_words") >= least_words)
        .drop("run")
    )
