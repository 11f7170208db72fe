"""Language of documents by multinomial naive Bayes over hashed character n-grams (operator 13).

Texts are lower-cased; runs of letters are words, and a word's n-grams are those of its characters with a space before
and after.  Tasks count n-grams by language and bucket, Spark adds the counts up, and the matrix of log chances goes to
all tasks.  A slice of texts is scored as a sparse product: its distinct words by the matrix, then texts by words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from locusflow.llm.words import mixed, slices, split_words

#: Lengths of n-grams in characters.
GRAMS = (1, 2, 3, 4)
#: Buckets of the hash, fewer where languages are many, and the most bytes of the matrix.
BUCKETS, LEAST_BUCKETS = 1 << 16, 1 << 8
MATRIX_BYTES = 32 * 1024 * 1024
#: Added to every count.
SMOOTHING = 0.5
UNKNOWN = "und"


class Model(NamedTuple):
    """Languages in ascending order, log shares of their documents, and log chances by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    chances: np.ndarray


class Grams(NamedTuple):
    """N-grams of a slice of texts: words of each text as numbers, and the buckets of every word's n-grams."""

    texts: np.ndarray
    words: np.ndarray
    owner: np.ndarray
    bucket: np.ndarray
    n_words: int


def held_out(doc_id: Column) -> Column:
    """True for rows never learned from: CRC-32 of the id as text leaves 2 modulo 4.  A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    kinds, where = np.unique(points, return_inverse=True)
    return np.fromiter((chr(p).isalpha() for p in kinds.tolist()), bool, len(kinds))[where]


def grams(texts: pa.Array, buckets: int = BUCKETS) -> Grams:
    """N-grams of every text; a text without letters has none."""
    split = split_words(pc.utf8_lower(texts))
    points = np.frombuffer((" " + " ".join(split.distinct) + " ").encode("utf-32-le"), np.uint32) if split.distinct else np.zeros(1, np.uint32) + 32
    token = np.cumsum(points == 32) - 1  # the space before a word belongs to it
    points = np.where(letters(points), points, np.uint32(32))
    letter = points != 32
    begins = letter & ~np.concatenate([[False], letter[:-1]])
    word = np.cumsum(begins) - 1  # a token may hold several words
    owner, bucket = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in GRAMS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        inner = np.ones(size, bool)
        for k in range(1, n - 1):
            inner &= letter[k : k + size]
        # One letter at least, and spaces only at the ends.
        inner &= letter[:size] if n == 1 else (letter[:size] | letter[n - 1 : n - 1 + size] if n == 2 else True)
        at = np.flatnonzero(inner)
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + points[at + k].astype(np.uint64))
        # The first letter inside an n-gram names its word.
        owner.append(word[np.where(letter[at], at, at + 1)])
        bucket.append((code % np.uint64(buckets)).astype(np.int64))
    of_token = np.searchsorted(token[begins], np.arange(len(split.distinct) + 1))  # words of each token
    sizes = np.diff(of_token)[split.places] if len(split.places) else np.zeros(0, np.int64)
    first = of_token[:-1][split.places] if len(split.places) else sizes
    words = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    row = np.repeat(np.repeat(np.arange(len(texts)), np.diff(split.starts)), sizes)
    return Grams(row, words, np.concatenate(owner), np.concatenate(bucket), int(begins.sum()))


def buckets_for(n_languages: int) -> int:
    """As many buckets as the matrix has room for, ``BUCKETS`` at most; so many languages that too few remain are an error."""
    room = MATRIX_BYTES // (4 * max(n_languages, 1))
    if room < LEAST_BUCKETS:
        raise ValueError(f"{n_languages} languages are too many for one matrix; map them to fewer names first")
    return min(BUCKETS, 1 << (room.bit_length() - 1))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Model:
    """Counts of all rows that may be learned from, as log chances.

    Rows with a null text or language and held-out rows are left out; repeated rows count as often as they stand there.
    The numbers collected are bounded by ``MATRIX_BYTES``, as the languages of a corpus are few.  A table without rows
    to learn from gives a model without languages.  Eager: two passes.
    """
    usable = docs.filter(~held_out(F.col(id_col))).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    most = MATRIX_BYTES // (4 * LEAST_BUCKETS)
    shares = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()}
    buckets = buckets_for(len(shares))
    languages = sorted(shares)
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                own = np.array([number[name] for name in part.column("lang").to_pylist()])
                found = grams(part.column("text"), buckets)
                order = np.argsort(found.owner, kind="stable")
                ends = np.searchsorted(found.owner[order], np.arange(found.n_words + 1))
                gram = found.bucket[order]
                for i in np.unique(own):
                    times = np.bincount(found.words[own[found.texts] == i], minlength=found.n_words)
                    counts[i] += np.bincount(gram, np.repeat(times, np.diff(ends)), buckets).astype(np.int64)
        language, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[language, bucket])], ["language", "bucket", "n"])

    counts = np.zeros((len(languages), buckets))
    if languages:
        found = usable.mapInArrow(run, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[found["language"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    smooth = counts + SMOOTHING
    chances = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32)
    prior = np.array([shares[name] for name in languages], float)
    return Model(languages, np.log(prior / max(prior.sum(), 1)), np.ascontiguousarray(chances))


def log_odds(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log of prior times likelihood by text and language, and the words of letters of each text."""
    found = grams(texts, len(model.chances))
    each = np.zeros((found.n_words, len(model.languages)))
    total = np.zeros((len(texts), len(model.languages)))
    for i in range(len(model.languages)):
        each[:, i] = np.bincount(found.owner, model.chances[found.bucket, i], found.n_words)
        total[:, i] = np.bincount(found.texts, each[found.words, i], len(texts))
    return total + model.prior, np.bincount(found.texts, minlength=len(texts))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the chance that the model gives it.

    ``und`` with a score of 0 where the text is null or has no letter, or the model no language.  Of equal chances the
    first name wins.  Other columns are kept; ones of the two names are replaced.  Texts are scored whole and row by
    row, so repeats get equal results.
    """
    kept = docs.select([c for c in docs.columns if c not in ("lang_pred", "score")])
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = kept.sparkSession.sparkContext.broadcast(model)  # at most MATRIX_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text):
                odds, sizes = log_odds(part.column(text), model) if model.languages else (np.zeros((part.num_rows, 1)), np.zeros(part.num_rows))
                best = odds.argmax(1)
                chance = 1 / np.exp(odds - odds.max(1, keepdims=True)).sum(1)
                names = [model.languages[i] if n else UNKNOWN for i, n in zip(best.tolist(), sizes.tolist(), strict=True)]
                scores = pa.array(np.where(sizes > 0, np.round(chance, 12), 0.0))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), scores], schema.names)

    return kept.mapInArrow(run, schema)
