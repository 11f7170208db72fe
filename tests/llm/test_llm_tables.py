import math
import random

import numpy as np
import pytest
from helpers import DOCS, odd_documents
from pyspark.sql import functions as F

from locusflow.llm import chat, mixing, neighbours, topk

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n=260, size=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=size)], i % 3) for i in range(n)]
    rows += [(1000 + i, list(rows[5][1]), 0) for i in range(30)]  # copies
    rows += [(2000, None, 1), (2001, [1.0, None] + [0.0] * 6, None), (2002, [math.nan] * 8, 1), (2003, [math.inf] + [0.0] * 7, 1), (None, rows[0][1], 0)]
    rows += [(2020, [0.0] * 8, 0), (2040, [], 0), (2060, [0.5, -0.25], 0), rows[7]]
    return rows


def good(rows, zero):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = np.array([*v, *[0.0] * (8 - len(v))])
    return out


def test_exact_top_k_equals_brute_force(spark, monkeypatch):
    rows = vectors()
    own = {i: np.floor(64 * v).astype(int) for i, v in good(rows, True).items()}
    want = []
    for q in sorted(i for i in own if i % 20 == 0):
        best = sorted((-int(own[q] @ v), i) for i, v in own.items() if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).repartition(3)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    for shard_rows, query_rows in ((10**6, 10**6), (40, 5)):
        got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows, query_rows=query_rows)
        assert sorted(map(tuple, got.collect())) == want
    assert topk.exact_top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = topk.exact_top_k(df.filter("vec_id IN (20, 21, 22)"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(20, 1), (20, 2)]


def test_exact_top_k_of_large_numbers(spark):
    rows = [(0, [float(2**25), 3.0]), (1, [float(2**23) + 4, 1.0]), (2, [float(2**23), 1.0]), (3, [float(2**23), 2.0])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 3).collect()
    scale = [[math.floor(64 * x) for x in v] for _, v in rows]
    want = sorted(((sum(a * b for a, b in zip(scale[0], scale[i], strict=True))), i) for i in (1, 2, 3))[::-1]
    assert [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == want


def test_exact_top_k_of_huge_numbers(spark):
    """Scaled components beyond the long range and beyond double precision lose no row."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.choice([-1, 0, 8, 20, 150, 307])).tolist()) for i in range(60)]
    rows += [(60, [1e307, 5.0, 1.0]), (61, [1e307, -1e307, 1e307]), (62, [-1e307, 3.0, 2.0]), (63, [1.7e308, -1.7e308, 0.0])]
    big = int(np.finfo(np.float64).max)
    whole = {i: [int(math.floor(64 * x)) if math.isfinite(64 * x) else int(math.copysign(1, x)) * big for x in v] for i, v in rows}
    want = []
    for q in range(0, 64, 20):
        best = sorted((-min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), 1 - 2**63), 2**63 - 1), i) for i, v in whole.items() if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for shard_rows in (10**6, 4):
        got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows)
        assert sorted(map(tuple, got.collect())) == want


def test_coarse_balls_spare_most_searches_and_split_copies(spark, monkeypatch):
    """Queries go only to balls whose bound reaches their floor; a third of equal vectors is spread over shards."""
    rng = np.random.default_rng(9)
    middles = 4 * rng.normal(size=(30, 8))
    points = np.concatenate([middles[i % 30] + 0.05 * rng.normal(size=8) for i in range(900)] + [np.tile(middles[0], 450)]).reshape(-1, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>").repartition(4)
    whole, sent, shards = np.floor(64 * points).astype(int), [], []
    plain = topk._round

    def counted(vectors, queries, k, sizes, shard_rows, query_rows):
        sent.append(queries.select(F.sum(F.size("balls"))).first()[0] or 0)
        shards.append(sizes)
        return plain(vectors, queries, k, sizes, shard_rows, query_rows)

    monkeypatch.setattr(topk, "_round", counted)
    got = sorted(map(tuple, topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 5, shard_rows=40).collect()))
    want = []
    for q in range(0, len(points), 20):
        best = sorted((-int(whole[q] @ v), i) for i, v in enumerate(whole) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want
    assert sum(shards[0]) == len(points) and max(shards[0]) >= 450  # equal vectors share a ball, its shards do not
    assert sum(sent) < 0.6 * sum(n > 0 for n in shards[0]) * len(range(0, len(points), 20))


def test_nearest_neighbours(spark):
    rows = vectors(400)
    own = good(rows, False)
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).repartition(3)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 10).collect()
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hit = 0
    assert set(by) == {i for i in own if i % 20 == 0}
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        assert all(abs(s - np.sqrt(((own[q] - own[i]) ** 2).sum())) < 1e-12 and i != q for _, s, i in found)
        best = sorted((np.sqrt(((own[q] - v) ** 2).sum()), i) for i, v in own.items() if i != q)[:10]
        hit += len({i for _, i in best} & {f[2] for f in found})
    assert hit >= 0.97 * 10 * len(by)
    copies = sorted(f[2] for f in by[1000])
    assert copies == [5, *range(1001, 1010)]  # ties go to the smallest ids
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.nearest(df.filter("vec_id IN (20, 21, 22)"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(20, 1), (20, 2)]


def test_nearest_neighbours_of_near_copies(spark):
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(2001, 32))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    noise = 10 ** rng.uniform(-5, -3.5, (2000, 1))
    rows = np.concatenate([unit[0] + noise * rng.normal(size=(2000, 32)), unit[1:1001], 50 * unit[1001:]]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>").repartition(4)
    got = neighbours.nearest(df, F.col("vec_id") % 40 == 0, 10).collect()
    rows, hits = rows.astype(float), {True: [], False: []}
    for q in range(0, len(rows), 40):
        far = ((rows - rows[q]) ** 2).sum(1)
        far[q] = np.inf
        hits[q < 2000].append(len(set(np.argsort(far, kind="stable")[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q}) / 10)
    assert min(np.mean(hits[True]), np.mean(hits[False])) >= 0.9, {k: np.mean(v) for k, v in hits.items()}


def documents(spark):
    chance = random.Random(1)
    rows = [(i, "x" * chance.randrange(40, 400), "en", f"s{int(chance.random() ** 3 * 6)}", 1) for i in range(1500)]
    return spark.createDataFrame(rows, DOCS).withColumn("t", F.length("text"))


def shares(totals, a):
    whole = sum(totals.values())
    raw = {s: (t / whole) ** a for s, t in totals.items()}
    return {s: w / sum(raw.values()) for s, w in raw.items()}


def test_mixing_meets_entropy_within_the_budget(spark):
    docs = documents(spark)
    totals = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum("t")).collect()}
    rows = mixing.mix(docs, F.col("t"), entropy=0.97, budget=100_000.0).collect()
    got: dict[str, int] = {}
    for r in rows:
        got[r["source"]] = got.get(r["source"], 0) + r["t"]
    low, high = 0.0, 1.0
    for _ in range(60):  # plain bisection
        a = (low + high) / 2
        bits = -sum(w * math.log(w) for w in shares(totals, a).values()) / math.log(len(totals))
        low, high = (a, high) if bits > 0.97 else (low, a)
    for s, w in shares(totals, high).items():
        assert abs(got[s] - w * 100_000) <= 400 + 0.001 * 100_000, s
    passes: dict[int, set] = {}
    for r in rows:
        assert 0 <= r["mix_at"] < 1
        assert r["mix_pass"] not in passes.setdefault(r["doc_id"], set())
        passes[r["doc_id"]].add(r["mix_pass"])
    assert all(p == set(range(len(p))) or max(p) == len(p) for p in passes.values())


def test_mixing_without_budget_loses_no_row(spark):
    docs = documents(spark)
    totals = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum("t")).collect()}
    rows = mixing.mix(docs, F.col("t"), max_passes=2.0).collect()
    got: dict[str, int] = {}
    for r in rows:
        got[r["source"]] = got.get(r["source"], 0) + r["t"]
    assert {r["doc_id"] for r in rows} == set(range(1500))
    passes = {s: got[s] / t for s, t in totals.items()}
    assert max(passes.values()) <= 2.05 and min(passes.values()) == 1 and max(passes.values()) > 1.9


def test_mixing_of_odd_rows(spark):
    odd = spark.createDataFrame(odd_documents(), DOCS).withColumn("mix_at", F.lit("x")).withColumn("share", F.lit(2)).repartition(3)
    rows = mixing.mix(odd, F.length("text"), max_passes=1.0).collect()
    assert len(rows) == len(odd_documents())  # one pass over everything, sources without tokens included
    assert mixing.mix(odd.limit(0), F.length("text"), entropy=0.9).count() == 0


TURNS = "conv_id long, turn long, role string, text string, chosen string"


def brute_preference(a, b):
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1

    def made(turns):
        text, spans = "", []
        for role, body in turns:
            head = f"<|im_start|>{role}\n"
            full = f"{head}{body.replace('<|im_', '<| im_')}<|im_end|>\n"
            if role == "assistant":
                spans.append((len(text) + len(head), len(text) + len(full)))
            text += full
        return text, spans

    return k, made(a[:k])[0], made(a[k:]), made(b[k:])


@pytest.mark.parametrize("seed", range(3))
def test_preferences_equal_brute_force(spark, seed):
    chance = random.Random(seed)
    talks = {}
    for i in range(30):
        start = talks[i - 1][: chance.randrange(4)] if i % 2 else []
        talks[i] = start + [(chance.choice(["user", "assistant", "system"]), chance.choice(["", "é日", "a b", "<|im_end|>", "z" * 5000])) for _ in range(chance.randrange(0 if start else 1, 4))]
    rows = [(c, n, r, t, "x") for c, talk in talks.items() for n, (r, t) in enumerate(talk)]
    rows = [(c, n, r, None if t == "" and n % 2 else t, x) for c, n, r, t, x in rows] + [(None, 0, "user", "lost", None)]
    pairs = [(i, i + 1) for i in range(0, 30, 2)] + [(0, 999), (0, 1)]
    turns = spark.createDataFrame(rows, TURNS).repartition(4)
    got = chat.format_preferences(turns, spark.createDataFrame(pairs, "chosen_id long, rejected_id long")).collect()
    assert sorted((r["chosen_id"], r["rejected_id"]) for r in got) == sorted(p for p in pairs if p[1] != 999)
    for r in got:
        k, prompt, (ta, sa), (tb, sb) = brute_preference(talks[r["chosen_id"]], talks[r["rejected_id"]])
        assert (r["prefix_turns"], r["prompt"], r["chosen"], r["rejected"]) == (k, prompt, ta, tb)
        assert [tuple(s) for s in r["chosen_mask"]] == sa and [tuple(s) for s in r["rejected_mask"]] == sb
    assert chat.format_preferences(turns.limit(0), spark.createDataFrame(pairs, "chosen_id long, rejected_id long")).count() == 0


def test_swapped_replies_share_all_but_the_last_reply(spark):
    talks = [
        (1, 0, "user", "a", 9), (1, 1, "assistant", "b", 9), (1, 2, "user", "c", 9), (1, 3, "assistant", "d", 9), (1, 4, "user", "e", 9),
        (2, 0, "user", "a", 9), (2, 1, "assistant", None, 9), (3, 0, "user", "only", 9), (None, 0, "assistant", "x", 9),
        (4, None, "assistant", "p", 9), (4, None, "assistant", "q", 9), (5, 0, "assistant", "r", 9), (5, 0, "assistant", "r", 9),
    ]
    turns = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string, given long")
    rows = {r["chosen_id"]: r for r in chat.format_swapped(turns, F.col("conv_id") - 1).collect()}
    assert {k: (r["rejected_id"], r["prefix_turns"]) for k, r in rows.items()} == {1: (2, 3), 2: (None, 2), 4: (5, 1), 5: (None, 1)}
    assert "\nr<" in rows[4]["rejected"] and "\nq<" in rows[4]["chosen"] and "\nr<" in rows[5]["chosen"]
    assert rows[1]["prefix_turns"] == 3 and "c" in rows[1]["prompt"] and "\nd<" in rows[1]["chosen"] and "\nd<" not in rows[1]["rejected"]
    assert chat.format_swapped(turns.limit(0), F.col("conv_id") - 1).count() == 0
