"""The entry module without the training-data operators, and without libraries that only they need."""

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from locusflow.session import shared_dir

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys
sys.path.insert(0, {root!r})

class Gone:
    def find_spec(self, name, path=None, target=None):
        if any(name == b or name.startswith(b + ".") for b in {blocked!r}):
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Gone())
import __spark_entry__
print(len(__spark_entry__.queries()), len(__spark_entry__.oracle_sql()), any(q.startswith("op") for q in __spark_entry__.queries()))
"""


@pytest.mark.parametrize("blocked", [["locusflow.llm"], ["corpus_pipeline", "locusflow.llm"], ["public_tokenizers"]])
def test_entry_survives_what_is_gone(blocked):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(root=str(ROOT), blocked=blocked)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    own, with_sql, left = done.stdout.split()
    assert int(own) > 60 and int(own) == int(with_sql) and left == "False"


def test_shared_folder_without_the_setting():
    """Local sessions get one folder each, other masters a clear error."""

    def session(master, app):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, applicationId=app))

    first = shared_dir(session("local[2]", "app-a"))
    assert os.path.isdir(first) and shared_dir(session("local[2]", "app-a")) == first != shared_dir(session("local", "app-b"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077", "app-c"))


def test_texts_of_reads_are_built_once(spark):
    from locusflow.catalog import views

    reads = spark.createDataFrame([(i, 0, 1 + i, 0, 100) for i in range(9)], "read_id long, contig_idx long, start long, lead int, read_len long")
    plan = views.with_sequence(reads).select("seq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("repeat(") == 1


def test_quality_text_of_large_ids(spark):
    from locusflow.catalog import views

    ids = [0, 38, 359 * 150_000 * 10**10 + 12_345, 2**63 - 1, -1, -(2**63)]
    reads = spark.createDataFrame([(i, 60) for i in ids], "read_id long, read_len long")
    for first in (35, 66):
        got = {r["read_id"]: r["q"] for r in reads.select("read_id", views.quality_text(first).alias("q")).collect()}
        assert got == {i: "".join(chr(first + (i + 7 * off) % 39) for off in range(60)) for i in ids}
