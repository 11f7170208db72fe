import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import DOCS, brute_components, odd_documents, words
from pyspark.sql.functions import lit

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from locusflow.llm import packing, pii, quality  # noqa: E402
from locusflow.llm.catalog import ORACLE, QUERIES  # noqa: E402
from locusflow.session import materialize  # noqa: E402


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    good = [(200 + i, words(i + 30, 80), "en", f"src{i % 4 if i % 5 else 0}", 400) for i in range(120)]
    bad = [(900 + i, " ".join(f"{w}%%%" for w in words(i + 800, 60).split()), "en", "src1", 300) for i in range(40)]
    copies = [(2000 + i, good[3][1] + " x" * (i % 3), "en", "src2", 400) for i in range(8)]
    rows = odd_documents() + good + bad + copies
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    pq.write_table(pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, kinds, strict=True))}), out / "documents.parquet")
    ids = [r[0] for r in good + bad]
    pq.write_table(pa.table({"doc_id": ids, "quality": pa.array([int(i < 900) for i in ids], pa.int32())}), out / "labels.parquet")
    return str(out), rows


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path))
        outs.append(docs)
    model = quality.train(spark.createDataFrame(rows, DOCS), spark.read.parquet(f"{path}/labels.parquet"))
    good = [tuple(r)[:5] for r in quality.score(spark.createDataFrame(rows, DOCS), model).filter("predicted = 1").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    kept = [tuple(r) for r in outs[0].collect()]
    assert sorted(kept, key=str) == sorted(good, key=str)
    assert not {r[0] for r in kept} & set(range(900, 940)) and {r[0] for r in kept} >= set(range(200, 320))
    groups = brute_components(kept, 5, 80)
    once = [tuple(r) for r in outs[1].collect()]
    assert sorted(r[0] for r in once if r[0] is not None) == sorted({d for d, _, c in groups if d is not None and d == c})
    assert not any(r[0] is None for r in once)  # that one is a copy of a document with an id
    hidden = {r["doc_id"]: r["text"] for r in outs[2].collect()}
    assert set(hidden) == {r[0] for r in once}
    for doc_id, text, *_ in once:
        if text and "@" not in text and doc_id is not None and not any(c.isdigit() for c in text):
            assert hidden[doc_id] == text
    assert not any(pii.base_spans(t) for t in hidden.values() if t)
    mixed = [r["doc_id"] for r in outs[3].collect()]
    assert set(mixed) == set(hidden) and max(mixed.count(i) for i in set(mixed)) <= 2
    lengths = [r["length"] for r in outs[4].collect()]
    assert len(outs[4].select("sequence_id").distinct().collect()) < len(lengths) and max(lengths) <= packing.CAPACITY
    for out in outs[:-1]:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_the_stages_and_takes_empty_tables(spark, folder, tmp_path):
    path, _ = folder
    assert corpus_pipeline.run(spark, path).count() > 0
    for name in ("documents", "labels"):
        pq.write_table(pq.read_table(f"{path}/{name}.parquet").slice(0, 0), tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    z, q, w = words(700, 60), words(701, 60), words(702, 60)
    rows = [(0, z), (2, z), (2, q), (3, q), (2, q), (7, w), (7, z + " tail"), (None, w + " x"), (None, words(703, 50)), (None, words(703, 50))]
    rows += [(None, ""), (None, None), (9, ""), (9, ""), (9, " "), (10, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, times int").repartition(3)
    got = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert got.columns == ["doc_id", "text", "times"]
    want = [(0, z), (2, q), (7, w), (None, words(703, 50)), (None, ""), (None, None), (9, ""), (9, " "), (10, None)]
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_columns_of_the_user_stay_as_they_are(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("text IS NOT NULL AND doc_id BETWEEN 200 AND 260")
    names = ["score", "predicted", "spans", "n_email", "base_sha256", "mix_pass", "mix_at", "share", "label", "key", "row", "__y", "a.b"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, lit(f"mine {i}"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, path))
        assert docs.columns[5:] == names and docs.count() >= 50
        assert {tuple(r)[5:] for r in docs.collect()} == {tuple(f"mine {i}" for i in range(len(names)))}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() >= 50
