"""From raw documents to packed training sequences: five stages, each one operator of ``locusflow.llm``.

``STAGES`` lists them in order.  Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from locusflow.llm import mixing, ngram_join, packing, pii, quality
from locusflow.llm.catalog import WORD_BPE, mixing_size
from locusflow.llm.shipping import ship
from locusflow.session import materialize

#: Words and similarity (in percent) of near duplicates, and the most passes over a source when mixing.
SHINGLE_WORDS, SIMILARITY, MAX_PASSES = 5, 80, 1.25


def aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` under names of no meaning, so that no operator adds or replaces one of the
    user's, and a function that gives a result the columns of ``docs`` back."""
    names = {c: c if c in used else f"__aside_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels that are not held out.

    Null and empty texts get the score of a text without words.  Rows are judged one by one; all columns stay as they are.
    """
    ship(spark)
    own, back = aside(docs, "doc_id", "text")
    model = quality.train(own, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(quality.score(own, model).filter("predicted = 1"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; rows without one come last.

    Rows that repeat an id with different texts are documents of their own, rows equal in id and text are one.
    Documents without words link with nothing and stay.
    """
    ship(spark)
    own, back = aside(docs, "doc_id", "text")
    return back(ngram_join.one_of_each(own, SHINGLE_WORDS, SIMILARITY))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; ``n_chars`` follows the text."""
    ship(spark)
    own, back = aside(docs, "text")
    hidden = back(pii.find(own, pii.train(own), redact=True))
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return hidden


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources up to ``MAX_PASSES`` times over; every document at least once."""
    ship(spark)
    own, back = aside(docs, "doc_id", "source", "text")
    return back(mixing.mix(own, mixing_size(), max_passes=MAX_PASSES))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack_documents(docs, WORD_BPE, lean=True)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("pii", hide_personal_data),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL states the trained stages; tests compare the stages with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
