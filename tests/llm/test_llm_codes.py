import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, odd_documents
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from locusflow.llm import codes, language, middle

VECTORS = "vec_id long, embedding array<double>, label string"


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Every part against every entry in Python integers: ``(id, label, code, error)`` of the kept rows, and the books."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max([len(r[1]) for r in kept], default=0) // parts)
    floor = lambda x: (lambda a, b: 1024 * a // b)(*x.as_integer_ratio())
    whole = [[floor(float(x)) for x in r[1]] + [0] * (width * parts - len(r[1])) for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, [float(x) for x in kept[i][1]]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(whole[i], p) for i in first] for p in range(parts)]

    def assign(p):
        gaps = [[sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in books[p]] for v in whole]
        return [(min(range(len(g)), key=g.__getitem__), min(g)) for g in gaps]

    for _ in range(rounds):
        for p in range(parts):
            best = assign(p)
            for e in range(len(books[p])):
                own = [cut(v, p) for v, (b, _) in zip(whole, best, strict=True) if b == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [assign(p) for p in range(parts)] if kept else []
    most = 2**63 - 1
    return [
        (r[0], r[2], [last[p][i][0] for p in range(parts)], min(sum(min(last[p][i][1], most) for p in range(parts)), most)) for i, r in enumerate(kept)
    ], books


def odd_vectors(seed, scale=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, (scale * rng.normal(size=8)).tolist(), "ab"[i % 2]) for i in range(0, 120)]
    rows += [(500 + i, rows[3][1], None) for i in range(40)]  # copies
    rows += [(700, None, "a"), (701, [1.0, None] + [0.0] * 6, "b"), (702, [math.nan] * 8, "a"), (703, [math.inf] + [0.0] * 7, None)]
    rows += [(None, rows[0][1], "c"), (720, [0.0] * 8, "a"), (721, [], "a"), (722, [0.5, -0.25, 1.0], "b"), rows[7], (5, rows[9][1], "a")]
    return rows


def key(row):
    return str(row)


@pytest.mark.parametrize(("seed", "scale", "entries"), [(1, 0.2, 16), (2, 3e4, 9), (3, 1e300, 5), (4, 0.01, 256)])
def test_codes_equal_brute_force(spark, monkeypatch, seed, scale, entries):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 7)
    rows = odd_vectors(seed, scale)
    want, books = brute_codes(rows, entries=entries)
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("x")).withColumn("uid", F.lit(1)).repartition(3)
    made = codes.compress(df, entries=entries)
    assert made.codebooks == books
    got = codes.with_label_error(made.rows).collect()
    assert sorted(((r["id"], r["label"], list(r["code"]), r["error"]) for r in got), key=key) == sorted(want, key=key)
    sums = Counter()
    for _, label, _, error in want:
        sums[label] += error
    assert {r["label"]: r["label_error"] for r in got} == {k: min(v, 2**63 - 1) for k, v in sums.items()}


def test_codes_of_few_and_no_rows(spark):
    df = spark.createDataFrame(odd_vectors(1), VECTORS)
    none = codes.compress(df.filter("vec_id = 700"))
    assert none.codebooks == [[]] * 4 and codes.with_label_error(none.rows).count() == 0
    one = codes.compress(df.filter("vec_id = 5").limit(1))
    assert [(list(r["code"]), r["error"]) for r in one.rows.collect()] == [([0] * 4, 0)]
    empty = codes.compress(df.filter("vec_id = 721"))
    assert [(list(r["code"]), r["error"]) for r in empty.rows.collect()] == [([0] * 4, 0)]


def test_restored_vectors_are_within_the_error(spark):
    rows = [r for r in odd_vectors(6) if r[1] and len(r[1]) == 8 and all(x is not None and math.isfinite(x) for x in r[1]) and r[0] is not None]
    made = codes.compress(spark.createDataFrame(rows, VECTORS), entries=32)
    own = {}
    for i, v, _ in rows:
        own.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    for r in codes.restored(made.rows, made.codebooks).collect():
        gaps = [sum((a - round(1024 * b)) ** 2 for a, b in zip(v, r["approximation"], strict=True)) for v in own[r["id"]]]
        assert r["error"] in gaps


@pytest.mark.parametrize(("width", "bits"), [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_neighbours_on_the_curve_are_neighbours_in_space(width, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width, indexing="ij"), -1).reshape(-1, width)
    keys = codes.hilbert_keys(cells, bits)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    assert len({k.tobytes() for k in keys}) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5), st.integers(1, 40), st.sampled_from([1 / 1024, 1.0, 1e8, 1e306]))
def test_shortlists_hold_every_nearest_entry(seed, width, n, scale):
    rng = np.random.default_rng(seed)
    points = codes.on_grid(scale * rng.integers(-3, 4, (12, width)).astype(float))
    entries = codes.on_grid(scale * rng.integers(-3, 4, (n, width)).astype(float))
    exact = [[int(c) for c in row] for row in codes.whole(entries)]
    own = codes.shortlist(points.min(0), points.max(0), entries)
    best, gap = codes.nearest(points, entries[own], [exact[e] for e in own])
    for point, b, g in zip(codes.whole(points), own[best], gap, strict=True):
        gaps = [sum((a - c) ** 2 for a, c in zip(point, e, strict=True)) for e in exact]
        assert (gaps.index(min(gaps)), min(gaps)) == (b, g)


def brute_middle(doc_id, text, seed, unit, fim, spm):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim:
        return doc_id, len(units), "plain", text, None, None, None
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    made = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(units), *made, len(p), len(m), len(s)


def middle_documents():
    chance = random.Random(4)
    pieces = ["a", "é", "日本", "𝄞", "\n", "\n\n", "\r\n", "<", ">", "P>", "<M", " ", " ", "x" * 50]
    rows = [(1000 + i, "".join(chance.choices(pieces, k=chance.randrange(0, 60))), "en", "s", 1) for i in range(300)]
    rows += [(2000, "<P>", "en", None, 1), (2001, "a<S>b\nc", None, "s", 1), (2002, "\n", None, None, None), (None, "a\né\n𝄞", None, None, None), (2003, "日" * 300_000 + "\n" + "a" * 300_000, "x", "y", 0)]
    return rows + odd_documents() + [rows[3]]


@pytest.mark.parametrize(("unit", "fim", "spm", "seed"), [("line", 100, 50, 7), ("character", 100, 50, 7), ("line", 60, 20, 1), ("character", 30, 100, 2)])
def test_middle_equals_brute_force_and_round_trips(spark, unit, fim, spm, seed):
    rows = middle_documents()
    df = spark.createDataFrame(rows, DOCS).withColumn("output", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    made = middle.rearrange(df, seed, unit, fim, spm)
    got = made.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    want = Counter(brute_middle(r[0], r[1], seed, unit, fim, spm) for r in rows)
    assert Counter((r["id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"], r["suffix_chars"]) for r in got) == want
    assert Counter((r["id"], r["back"]) for r in got) == Counter((r[0], r[1] or "") for r in rows)


def test_middle_of_nothing_and_with_other_marks(spark):
    df = spark.createDataFrame(middle_documents(), DOCS)
    assert middle.rearrange(df.limit(0)).count() == 0
    marks = middle.Marks("<|p|>", "(s)*", "[m]")
    made = middle.rearrange(df, marks=marks)
    back = made.withColumn("back", middle.restored(F.col("output"), F.col("form"), marks))
    assert Counter((r["id"], r["back"]) for r in back.collect()) == Counter((r[0], r[1] or "") for r in middle_documents())
    with pytest.raises(ValueError, match="unit"):
        middle.rearrange(df, unit="word")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aé日𝄞\n", max_size=12), max_size=4))
def test_places_convert_both_ways(texts):
    whole = "".join(texts)
    index = middle.exceptions(middle.text_bytes(pa.array(texts, pa.string()))[0])
    at = np.array([len(whole[:k].encode()) for k in range(len(whole) + 1)])
    assert index.to_points(at).tolist() == list(range(len(whole) + 1))
    assert index.to_bytes(np.arange(len(whole) + 1)).tolist() == at.tolist()


def slow_grams(text):
    out = []
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        own = f" {word} "
        for n in language.GRAMS:
            out += [own[i : i + n] for i in range(len(own) - n + 1) if own[i : i + n].strip() and " " not in own[i + 1 : i + n - 1]]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abÉé1 .\n日'_", max_size=30), max_size=4))
def test_grams_equal_slow_ones(texts):
    """The same n-grams share a bucket; every text has as many of each as a plain loop finds."""
    found = language.grams(pa.array(texts, pa.string()), 1 << 40)
    by_word = [[] for _ in range(found.n_words)]
    for w, b in zip(found.owner.tolist(), found.bucket.tolist(), strict=True):
        by_word[w].append(b)
    for i, text in enumerate(texts):
        mine = Counter(b for t, w in zip(found.texts.tolist(), found.words.tolist(), strict=True) if t == i for b in by_word[w])
        slow = Counter(slow_grams(text))
        assert sorted(mine.values()) == sorted(slow.values())


def test_language_equals_slow_bayes(spark):
    chance = random.Random(2)
    stems = {"aa": "the ing tion", "bb": "der ung keit", "cc": "é aux ment"}
    rows = [(i, " ".join(chance.choice(stems[c].split()) + chance.choice("xyz1") for _ in range(chance.randrange(1, 12))), c, "s", 1) for i in range(240) for c in [chance.choice(list(stems))]]
    df = spark.createDataFrame(rows, DOCS)
    model = language.train(df)
    learned = [r for r in rows if zlib_mod(r[0]) != 2]
    buckets = len(model.chances)
    counts = {c: Counter() for c in stems}
    for r in learned:
        counts[r[2]].update(bucket_of(g, buckets) for g in slow_grams(r[1]))
    for i, c in enumerate(model.languages):
        whole = sum(counts[c].values()) + language.SMOOTHING * buckets
        for b, n in counts[c].items():
            assert model.chances[b, i] == pytest.approx(math.log((n + language.SMOOTHING) / whole), rel=1e-5)
    for r in language.predict(df, model).collect():
        odds = [model.prior[i] + sum(float(model.chances[bucket_of(g, buckets), i]) for g in slow_grams(r["text"])) for i in range(3)]
        best = max(range(3), key=odds.__getitem__)
        assert r["lang_pred"] == model.languages[best]
        assert r["score"] == pytest.approx(1 / sum(math.exp(o - odds[best]) for o in odds), abs=1e-9)


def zlib_mod(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def bucket_of(gram, buckets):
    whole = (1 << 64) - 1

    def mix(h):
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & whole
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & whole
        return h ^ (h >> 31)

    code = len(gram)
    for c in gram:
        code = mix((code * 0x9E3779B97F4A7C15 + ord(c)) & whole)
    return code % buckets


def test_language_of_odd_rows(spark):
    df = spark.createDataFrame(odd_documents(), DOCS).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1)).repartition(3)
    model = language.train(df)
    assert model.languages == ["en"]
    for r in language.predict(df, model).collect():
        text = r["text"] or ""
        assert (r["lang_pred"], r["score"]) == (("en", 1.0) if any(c.isalpha() for c in text) else ("und", 0.0))
    assert language.predict(df.limit(0), model).count() == 0
    nothing = language.train(df.filter("doc_id < -99"))
    assert nothing.languages == [] and {r["lang_pred"] for r in language.predict(df, nothing).collect()} == {"und"}
    with pytest.raises(ValueError, match="languages"):
        language.buckets_for(10**6)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    rows = language.predict(docs, model).filter(language.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)
    swapped = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert (language.train(swapped).chances == model.chances).all()  # held-out languages are never looked at
