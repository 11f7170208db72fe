"""Token ids and counts of whole texts, and the digest cache of counts (operator 10)."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from locusflow.llm.batches import TEXT_ROWS, rows_per_batch
from locusflow.llm.words import slices, split_words
from locusflow.session import materialize

#: Distinct words whose ids a Python worker keeps; further words are encoded anew in each slice.
KEPT_WORDS, KEPT_WORDS_LEAN = 400_000, 100_000
#: Words handed to the tokenizer at once, and words in one of its texts.
ENCODE_BATCH, ENCODE_LOT = 16_000, 1000
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"

_TOKENIZERS: dict[str, object] = {}
_IDS: dict[str, dict[str, bytes]] = {}


def tokenizer_at(path: str):
    """The tokenizer in the file ``path``, loaded once per worker."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path.endswith(".model"):
            import sentencepiece

            _TOKENIZERS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            loaded = Tokenizer.from_file(path)
            loaded.no_truncation()
            loaded.no_padding()
            _TOKENIZERS[path] = loaded
    return _TOKENIZERS[path]


def tokenizer_version(path: str) -> str:
    """SHA-256 of the tokenizer's file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def drops_white_space(path: str) -> bool:
    """True for tokenizers whose tokens never span ASCII white space, so that words can be encoded alone.

    That holds for a ``.json`` tokenizer that turns runs of white space into one space, folds case, and keeps
    only matches of a pattern without white space.  Any other file is encoded text by text.
    """
    if not path.endswith(".json"):
        return False
    import json

    spec = json.loads(Path(path).read_text())
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1].get("pattern") == {"Regex": "\\s+"}
        and splits[0].get("type") == "Split"
        and splits[0].get("behavior") == "Removed"
        and splits[0].get("pattern", {}).get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
        and not spec.get("post_processor")
    )


def _separator(path: str) -> tuple[str, int] | None:
    """A special token of the tokenizer, which parts the words encoded in one call."""
    special = [t for t in tokenizer_at(path).get_added_tokens_decoder().items() if t[1].special and not t[1].normalized]
    return (special[0][1].content, special[0][0]) if special else None


def _encode_words(words: list[str], path: str) -> Iterator[tuple[str, bytes]]:
    """Each word with its little-endian 32-bit ids.  Many words go through one call, parted by a special token;
    words that may hold a special token go alone."""
    tokenizer, parted = tokenizer_at(path), _separator(path)
    together = [w for w in words if parted and parted[0][:2] not in w]
    for i in range(0, len(together), ENCODE_BATCH):
        lots = [together[j : j + ENCODE_LOT] for j in range(i, min(i + ENCODE_BATCH, len(together)), ENCODE_LOT)]
        texts = [f" {parted[0]} ".join(lot) for lot in lots]
        for lot, code in zip(lots, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array([*code.ids, parted[1]], "<u4")
            raw, start = ids.tobytes(), 0
            for word, end in zip(lot, (4 * np.flatnonzero(ids == parted[1])).tolist(), strict=True):
                yield word, raw[start:end]
                start = end + 4
    alone = [w for w in words if not parted or parted[0][:2] in w]
    for word, code in zip(alone, tokenizer.encode_batch_fast(alone, add_special_tokens=False) if alone else [], strict=True):
        yield word, np.array(code.ids, "<u4").tobytes()


def _word_ids(distinct: list[str], path: str, most: int = KEPT_WORDS) -> list[bytes]:
    """Little-endian 32-bit ids of each word; the worker keeps those of at most ``most`` words."""
    kept = _IDS.setdefault(path, {})
    found = dict(_encode_words([w for w in distinct if w not in kept], path))
    out = [kept[w] if w in kept else found[w] for w in distinct]
    for word, ids in found.items():
        if len(kept) >= most:
            break
        kept[word] = ids
    return out


def _spaced(texts: pa.Array) -> pa.Array:
    """Fewer distinct words with the same ids: ASCII letters in lower case, closing stops set apart.

    Both leave the tokenizer's own pieces as they are; a text that may hold a special token is not touched.
    """
    texts = pc.fill_null(texts, "")
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,]+)([ \t\n\v\f\r])", r"\1 \2\3")
    return pc.if_else(pc.match_substring(texts, "<|"), texts, plain)


def text_ids(texts: pa.Array, path: str, by_word: bool, kept_words: int = KEPT_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row (unsigned 32-bit), and where each text starts."""
    if by_word:
        words = split_words(_spaced(texts))
        codes = _word_ids(words.distinct, path, kept_words)
        flat = np.frombuffer(b"".join(codes), "<u4")
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        first = np.cumsum(lengths) - lengths
        each = lengths[words.places]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        starts = np.concatenate([[0], ends])[words.starts]
        at = np.repeat(first[words.places] - (ends - each), each)
        at += np.arange(total)
        return flat[at] if total else np.zeros(0, "<u4"), starts
    lists = _whole_texts(texts, path)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.fromiter((i for x in lists for i in x), "<u4", starts[-1]), starts


def _whole_texts(texts: pa.Array, path: str) -> list[list[int]]:
    plain = pc.fill_null(texts, "").to_pylist()
    if path.endswith(".model"):
        return tokenizer_at(path).encode(plain, num_threads=1) if plain else []
    return [e.ids for e in tokenizer_at(path).encode_batch_fast(plain, add_special_tokens=False)]


def text_lengths(texts: pa.Array, path: str, by_word: bool) -> np.ndarray:
    """Number of tokens of each text."""
    if by_word:
        words = split_words(_spaced(texts))
        lengths = np.fromiter(map(len, _word_ids(words.distinct, path)), np.int64, len(words.distinct)) // 4
        return np.diff(np.concatenate([[0], np.cumsum(lengths[words.places])])[words.starts])
    return np.array([len(x) for x in _whole_texts(texts, path)], np.int64)


def encode_missing(missing: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """``CACHE_SCHEMA`` rows for the ``(digest, text)`` rows of ``missing``, one for each digest of a task."""
    by_word = drops_white_space(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once_per_task(batches):
            for part in slices(batch, "text"):
                lengths = text_lengths(part.column("text"), tokenizer, by_word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * part.num_rows, pa.string()), part.column("digest"), pa.array(lengths, pa.int64())],
                    ["tokenizer", "digest", "n_tokens"],
                )

    return missing.select("digest", "text").mapInArrow(encode, CACHE_SCHEMA)


def _once_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest within this task: copies meet here before the shuffle."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for i, digest in enumerate(batch.column("digest").to_pylist()):
            if digest not in seen:
                seen.add(digest)
                fresh.append(i)
        if fresh:
            yield batch.take(pa.array(fresh, pa.int32()))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table at ``path``; an empty one where nothing has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of each row by a digest cache, beside its columns other than the text.

    A text's key is the SHA-256 of its normalised content and the tokenizer's version.  Normalising makes one space
    of each run of ASCII white space for tokenizers that drop it, else nothing.  Keys are joined to the cache table
    at ``cache``; only distinct missing texts are encoded, and their counts are appended to the cache, from which
    every row then takes its count.  Texts are shuffled once, after dropping copies within each task; a text with
    many copies leaves at most one row per task.  Eager: it runs the encoding job.

    Null text counts as empty (0 bytes, 0 tokens).  Repeated rows all return.  Columns of ``docs`` named like the
    new ones are replaced; others stay.  An empty table returns no row.  Two writers may append the same key; the
    counts agree and one is used.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    whole = F.coalesce(F.col(text), F.lit(""))
    normal = F.trim(F.regexp_replace(whole, r"[ \t\n\x0B\f\r]+", " ")) if drops_white_space(tokenizer) else whole
    kept = [c for c in docs.columns if c not in {text, "n_bytes", "n_tokens", "over_limit"}]
    key = F.unhex(F.sha2(normal.cast("binary"), 256))
    # The digests of all rows are written once: few bytes per row, and the texts are not hashed again.
    keys = materialize(
        docs.select(*[F.col(f"`{c}`") for c in kept], F.octet_length(whole).cast("long").alias("__bytes"), key.alias("__key"))
    )
    known = read_cache(spark, cache).filter(F.col("tokenizer") == version).select("digest")
    texts = docs.select(key.alias("digest"), whole.alias("text"))
    fewer = texts.mapInArrow(_once_per_task, texts.schema).repartition("digest")
    missing = fewer.join(known, "digest", "left_anti")
    with rows_per_batch(spark, TEXT_ROWS):
        encode_missing(missing, tokenizer, version).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    joined = keys.join(counts.withColumnRenamed("digest", "__key"), "__key", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__bytes").alias("n_bytes"), F.col("n_tokens"), (F.col("n_tokens") > limit).alias("over_limit"),
    )
