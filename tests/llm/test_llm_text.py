import functools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import DOCS, brute_components, odd_documents, shingles, words
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusflow.llm import ngram_join, packing, paragraphs, pii, quality, tokens
from locusflow.llm.components import components

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCS).withColumn("key", F.lit(1)).withColumn("score", F.lit("x")).repartition(3)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


TEXT = st.lists(st.sampled_from(list("aAbzéÉß.,'s!?0 1\n\t\x0b\x85 ́İΣ<|>_日") + ["<|endoftext|>", "'ll", "abc.", "ABC, "]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_word_by_word_equal_the_tokenizers(texts):
    tokenizer = tokens.tokenizer_at(PATH)
    assert tokens.drops_white_space(PATH)
    got, starts = tokens.text_ids(pa.array(texts, pa.string()), PATH, True)
    assert [got[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [ids_of(tokenizer, t) for t in texts]


def test_token_counts_and_cache(spark, odd, tokenizer, tmp_path):
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        rows = tokens.count_tokens(odd, PATH, cache, limit=50).collect()
        want = Counter((r[0], len((r[1] or "").encode()), n := len(ids_of(tokenizer, r[1])), n > 50) for r in odd_documents())
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == want
    kept = spark.read.parquet(cache)
    assert kept.count() == kept.select("digest").distinct().count()  # the second run encoded nothing
    tokens.count_tokens(spark.createDataFrame([(1, "quite new")], "doc_id long, text string"), PATH, cache).collect()
    assert spark.read.parquet(cache).count() == kept.count() + 1
    assert tokens.count_tokens(odd.limit(0), PATH, f"file://{tmp_path}/other").count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_tokenizers(spark, odd, tmp_path, name):
    path = public_tokenizers.path(name)
    got = {(r["doc_id"], r["n_tokens"]) for r in tokens.count_tokens(odd, path, f"file://{tmp_path}/c").collect()}
    if name.endswith("model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        other = Tokenizer.from_file(path)
        count = lambda t: len(other.encode(t, add_special_tokens=False).ids)
    assert got == {(r[0], count(r[1] or "")) for r in odd_documents()}


def test_pack_documents_places_every_piece(odd, tokenizer):
    rows = packing.pack_documents(odd, PATH, capacity=64).collect()
    want = Counter()
    for r in odd_documents():
        ids = np.array([*ids_of(tokenizer, r[1]), 0], "<u4")
        for i, at in enumerate(range(0, len(ids), 64)):
            want[r[0], i, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    counts = np.bincount([r["length"] for r in rows], minlength=65)
    assert len(by) == packing.lower_bound(counts, 64)
    assert packing.pack_documents(odd.limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_plan_is_as_good_as_exhaustive_search(lengths):
    def fewest(left, rooms):
        if not left:
            return len(rooms)
        options = {r for r in rooms if r >= left[0]}
        found = [fewest(left[1:], [*rooms, 12 - left[0]])]
        for r in options:
            others = list(rooms)
            others.remove(r)
            found.append(fewest(left[1:], [*others, r - left[0]]))
        return min(found)

    counts = np.bincount(lengths, minlength=13) if lengths else np.zeros(13, int)
    plan = packing.plan(counts, 12)
    used = Counter()
    for filling, times in plan:
        assert sum(filling) <= 12
        used.update({n: k * times for n, k in Counter(filling).items()})
    assert used == Counter(lengths)
    assert sum(f.times for f in plan) == fewest(sorted(lengths, reverse=True), [])


@pytest.mark.parametrize("k", [1, 7, 1000])
def test_plan_fills_sequences_with_many_pieces(k):
    counts = np.zeros(2049, int)
    counts[300], counts[274] = 5 * k, 2 * k  # 5 * 300 + 2 * 274 = 2048
    assert sum(f.times for f in packing.plan(counts)) == k


def test_completions_leave_out_dominated_fillings():
    counts = np.bincount([7, 5, 4, 3, 2], minlength=11)
    found = list(packing.completions(10, counts, 10))
    assert found == [(7, 3), (5, 4)]  # 5, 3 and 2 fit into 7 and 3; 4, 3 and 2 too


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_components_equal_brute_force(spark, odd, n, percent):
    rows = odd_documents()
    chance = random.Random(4)
    for group in range(6):  # near copies at all distances, around common lines
        base = words(50 + group, 70).split() + words(7, 20).split()
        for i in range(12):
            own = list(base)
            for _ in range(chance.randrange(5)):
                own[chance.randrange(len(own))] = f"n{chance.randrange(10**6)}"
            rows.append((1000 + 100 * group + i, " ".join(own), "en", "src0", 1))
    got = ngram_join.document_components(spark.createDataFrame(rows, DOCS).repartition(5), n, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, n, percent)
    assert ngram_join.document_components(odd.limit(0), n, percent).count() == 0


def test_ngram_columns_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMN_ROWS", 4)
    monkeypatch.setattr(ngram_join, "STAR_PASSES", 1)
    chance, rows = random.Random(8), []
    for i in range(40):
        own = words(3, 60).split()
        for _ in range(chance.randrange(4)):
            own[chance.randrange(60)] = f"n{chance.randrange(10**6)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    got = ngram_join.document_components(spark.createDataFrame(rows, DOCS), 3, 90).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 90)


def test_components_equal_union_find(spark):
    chance = random.Random(2)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    head = {x: x for e in edges for x in e}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) * (1 + i % 2) for i, c in enumerate(re.sub("[^0-9]", "", m[0])[::-1])]
        if 16 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in d) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


PARTS = ["1", "25", "300", "4111111111111111", ".", "@", "a", "b-c", "+", "-", " ", "(", ")", "é", "\n", "x@y.z", "1.2.3.4", "+1 555 123 4567", "%"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute_base(text)
    base, every = pii.all_spans(text, {})
    assert sorted(every) == sorted(base)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 (" * 50_000, "1 " * 100_000])
def test_base_spans_take_linear_time(text):
    assert pii.base_spans(text) is not None
    assert pii.candidates(text, pii.Zone([(m.start(), m.end(), m[0]) for m in re.finditer("[A-Za-z]+|[0-9]+|[^A-Za-z0-9 ]", text[:20_000])], [False] * 20_000)) is not None


def sentences(seed, n=30):
    chance = random.Random(seed)
    mail = f"{chance.choice('abcdef')}{chance.choice('xyz')}r.{chance.randrange(99)}@mail{chance.randrange(9)}.example.com"
    phone = f"+1 ({chance.randrange(200, 999)}) 555-{chance.randrange(1000, 9999)}"
    return f"{words(seed, n)} {chance.choice([mail, phone, f'{chance.randrange(255)}.1.2.{chance.randrange(255)}'])} {words(seed + 1000, 10)}"


def test_field_learns_forms_that_patterns_miss(spark):
    weights = pii.train(spark.createDataFrame([(sentences(i),) for i in range(150)], "text string"))
    text = "write to jim.77 at mail3 dot example dot com now, or call (415) 555-1234 today. born 1987-03-02, 33 houses."
    base, every = pii.all_spans(text, weights)
    assert base == []
    assert {(k, text[a:b]) for k, a, b in every} == {("email", "jim.77 at mail3 dot example dot com"), ("phone", "(415) 555-1234")}
    assert pii.redacted(text, every).startswith("write to <email> now, or call <phone> today.")


@pytest.mark.parametrize(
    "form",
    ["john.doe [at] mail [dot] example [dot] co [dot] uk", "jane [at] mail [dot] com", "jane(at)mail3(dot)example(dot)net", "10[.]2[.]3[.]4",
     "2 1 2 5 5 5 0 1 8 7", "2-1-2-5-5-5-0-1-8-7", "(212) 555-0187", "x.y1 at " + " dot ".join(f"part{i}" for i in range(18)) + " dot com"],
)
def test_added_spans_leave_nothing_of_an_entity(form):
    weights = learned()
    for frame in ("{}", "please write or call {} for more", "the old one ({}), they said"):
        text = frame.format(form)
        base, every = pii.all_spans(text, weights)
        assert base == [] and [text[a:b] for _, a, b in every] == [form]


@functools.cache
def learned():
    return pii.learn([sentences(i) for i in range(200)])


def segmentations(n, found):
    """All ways to cover ``n`` tokens with ordinary tokens (left out) and typed segments."""

    def walk(at):
        if at >= n:
            yield ()
            return
        yield from walk(at + 1)
        for c, (i, j, _) in enumerate(found):
            if i == at:
                for kind in pii.KINDS:
                    for rest in walk(j):
                        yield ((c, kind), *rest)

    return list(walk(0))


@pytest.mark.parametrize("text", ["call 555 123 4567", "a@b.c 1.2.3.4", "j at m dot com", "1[.]2[.]3[.]4 @x"])
def test_decode_and_fit_equal_enumeration(text):
    zone = pii.zones(text, [])[0]
    found = pii.candidates(text, zone)
    every = segmentations(len(zone.tokens), found)
    assert found and len(every) > len(pii.KINDS)
    where = lambda c: (zone.tokens[found[c][0]][0], zone.tokens[found[c][1] - 1][1])

    chance = random.Random(5)
    weights = {(k, f): chance.uniform(-1, 1.5) for k in pii.KINDS for _, _, names in found for f in names}
    total = lambda one, margin: sum(sum(weights[k, f] for f in found[c][2]) - margin for c, k in one)
    best = max(total(one, 0.2) for one in every)
    got = pii.decode(text, zone, weights, margin=0.2)
    places = {where(c): c for c in range(len(found))}
    assert math.isclose(total([(places[a, b], k) for k, a, b in got], 0.2), best, abs_tol=1e-9)

    # One step from zero weights: the truth's features less their expectation over all segmentations.
    truth = [("phone", *where(0))]
    want = Counter()
    for f in found[0][2]:
        want["phone", f] += 1
    for one in every:
        for c, k in one:
            for f in found[c][2]:
                want[k, f] -= 1 / len(every)
    fitted = pii.fit([(text, truth)], epochs=1, rate=1.0, decay=0.0)
    assert all(abs(fitted.get(key, 0) - want.get(key, 0)) < 2e-3 for key in {*fitted, *want})


def test_pii_table(odd):
    rows = pii.find(odd, {}).collect()
    assert len(rows) == len(odd_documents()) and {"key", "score", "text"} <= set(rows[0].asDict())
    row = next(r for r in rows if r["doc_id"] == 17)
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == tuple(Counter(k for k, _, _ in brute_base(row["text"]))[k] for k in pii.KINDS)
    assert row["spans"] == pii.written(sorted(brute_base(row["text"]), key=lambda s: (pii.KINDS.index(s[0]), s[1])))
    hidden = next(r for r in pii.find(odd, {}, redact=True).collect() if r["doc_id"] == 17)["text"]
    assert hidden.startswith("mail <email> or <phone> or ") and hidden.endswith("<ip>")
    assert next(r for r in pii.find(odd, {}, redact=True).collect() if r["doc_id"] == 6)["text"] is None
    assert pii.find(odd.limit(0), pii.train(odd.limit(0))).count() == 0


def test_quality_learns_and_scores_every_row(spark, odd):
    good = [(i, words(i, 60), "en", "s", 1) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w}%%%" for w in words(i + 500, 60).split()), "en", "s", 1) for i in range(80)]
    docs = spark.createDataFrame(good + bad, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in good + bad] + [(None, 1), (5000, None), (7, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r["held"]]
    assert {r["doc_id"] for r in held} == {r[0] for r in good + bad if zlib.crc32(str(r[0]).encode()) % 4 == 2}
    assert all(r["predicted"] == (r["doc_id"] < 1000) for r in held) and all(0 <= r["score"] <= 1 for r in rows)
    scored = quality.score(odd, model).collect()
    assert len(scored) == len(odd_documents())
    assert len({r["score"] for r in scored if not (r["text"] or "").strip()}) == 1
    nothing = quality.train(docs.limit(0), labels.limit(0))
    assert quality.score(odd.limit(0), nothing).count() == 0
    assert {r["score"] for r in quality.score(odd, nothing).collect()} == {0.5}


def test_bands_are_tuned():
    for percent in (50, 80, 90):
        bands, rows = paragraphs.tune(percent / 100)
        assert 1 - (1 - (percent / 100) ** rows) ** bands >= paragraphs.RECALL


def test_repeated_passages(spark, odd):
    passage = "\n".join(words(70 + i, 25) + "." for i in range(4))
    rows = [(i, f"{words(200 + i, 40, 10**6)}. {passage} {words(300 + i, 40, 10**6)}", "en", "s", 1) for i in range(5)]
    rows += [(10 + i, words(400 + i, 120, 10**6), "en", "s", 1) for i in range(5)] + [(20, None, None, None, None), (21, "", "", "", 0)]
    near = words(900, 60, 10**6).replace(".", "")
    rows += [(30, near, "en", "s", 1), (31, near + " and one more", "en", "s", 1)]
    found = paragraphs.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 3, 4, 31}
    for r in found:
        own = next(x[1] for x in rows if x[0] == r["doc_id"]).split()
        text = " ".join(own[r["first_word"] : r["first_word"] + r["n_words"]])
        assert r["kept_doc_ids"] == ([30] if r["doc_id"] == 31 else [0])
        assert r["doc_id"] == 31 or (r["n_words"] >= 60 and text in " ".join(passage.split()))
    assert paragraphs.repeated_passages(odd).count() > 0
    assert paragraphs.repeated_passages(odd.limit(0)).count() == 0


def test_units_are_plain_sets_of_shingles():
    texts = [words(i, 80, 60) + "\n" + words(i % 7, 50, 10**6).replace(".", "") for i in range(30)] + ["a b a b a b a b a b a b", "", None, "one"]
    units = paragraphs.split_units(pa.array(texts), 5)
    keys = paragraphs._folded(units.grams, units.starts)
    seen: dict = {}
    covered: dict = {}
    for i, (row, first, size, inside) in enumerate(zip(units.row.tolist(), units.first.tolist(), units.size.tolist(), units.inside.tolist(), strict=True)):
        own = shingles(" ".join(texts[row].split()[first : first + size]), 5)
        assert len(own) == units.starts[i + 1] - units.starts[i]
        assert seen.setdefault((inside, own), keys[i]) == keys[i]
        if not inside:
            covered.setdefault(row, []).extend(range(first, first + size))
    assert len(set(seen.values())) == len(seen)
    assert all(covered.get(i, []) == list(range(len((t or "").split()))) for i, t in enumerate(texts))
    assert units.inside.any()


def test_clusters_equal_brute_force_components(spark):
    near = lambda i, j: " ".join(w if (k * 7 + j) % 29 else f"z{j}" for k, w in enumerate(words(i, 70, 10**6).replace(".", "").split()))
    rows = [(i % 9, near(i, j) + ".") for i in range(12) for j in range(4)]  # ids repeat with other texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.xxhash64("text")).repartition(3)
    found = paragraphs.occurrences(docs, 5, 80)
    labels = {r["key"]: r["label"] for r in paragraphs.clusters(docs, found, 5, 80).collect()}
    units = paragraphs.split_units(pa.array([t for _, t in rows]), 5)
    keys = paragraphs._folded(units.grams, units.starts).tolist()
    sets = {k: frozenset(units.grams[units.starts[i] : units.starts[i + 1]].tolist()) for i, k in enumerate(keys)}
    least = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    linked = {k for k in sets if sum(v == least[k] for v in least.values()) > 1}
    assert linked and all(least[k] == v for k, v in labels.items() if k in linked) and set(labels) <= linked
    assert len(set(labels) & linked) >= 0.95 * len(linked)


@pytest.mark.parametrize("end", ["", '."', ".)", "\u3002"])
def test_repeated_passages_in_the_middle_of_different_lines(spark, end):
    fresh = lambda seed, n: words(seed, n, 10**6).replace(".", "")
    rows = []
    for i in range(20):
        passage = fresh(1000 + i, 60).split()
        passage = " ".join(w + (end if k % 11 == 10 else "") for k, w in enumerate(passage))
        rows += [(2 * i + j, f"{fresh(2000 + 2 * i + j, 50)} {passage} {fresh(3000 + 2 * i + j, 50)}", "en", "s", 1) for j in (0, 1)]
    found = paragraphs.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    assert all(r["doc_id"] % 2 and r["kept_doc_ids"] == [r["doc_id"] - 1] for r in found)
    assert all(50 <= r["first_word"] and r["first_word"] + r["n_words"] <= 110 for r in found)
    assert len({r["doc_id"] for r in found}) >= 18
