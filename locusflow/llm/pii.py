"""Personal data in whole texts: fixed patterns, and a semi-Markov conditional random field (operator 6).

The patterns give the base spans, which always stay.  The field then reads the places that hold digits, ``@`` or a
spelled-out dot and are not explained by a base span.  It scores whole candidate segments, not tokens, and
a dynamic program over segments of bounded length chooses boundaries and types together.  It finds forms that the
patterns miss, such as spelled-out mail addresses of up to twenty labels, telephone numbers without a plus sign or digit
by digit, and bracketed internet addresses.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from locusflow.llm.words import give_back, slices

KINDS = ("email", "ip", "card", "phone")
#: Tokens in a segment at most, and tokens read before and after a trigger.
LONGEST, AROUND = 90, 92
#: Texts that the field is trained on, at most (half of them with the look of a base span, half with other triggers), bytes
#: of one of them at most, and rewritten copies of each.
TRAINING_TEXTS, TRAINING_BYTES, REWRITES = 400, 50_000, 4
#: Texts that may hold a base span, judged before the patterns themselves read them.
_LOOKS = r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|(?:[0-9][ -]?){15}[0-9]|\+[0-9][ ().0-9-]{6}"
#: By how much a segment of the field must beat its being ordinary text (log odds).
MARGIN = 2.0

Span = tuple[str, int, int]

_USER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = r"[0-9@]|\b[Dd][Oo][Tt]\b"
_SPELLED_HOST = re.compile(r"[a-z0-9-]+(?: ?[\[(<{]?dot[\])>}]? ?[a-z0-9-]+)+")
_PLAIN_HOST = re.compile(r"[a-z0-9-]+(?: ?(?:\.|[\[(<{]?dot[\])>}]?) ?[a-z0-9-]+)+")
_HOST_GOES_ON = re.compile(r"(?: ?[\[(<{]dot[\])>}] ?| dot |\.)[A-Za-z0-9]", re.IGNORECASE)
#: Endings of hosts that rewritten training texts take.
_ENDINGS = ("com", "org", "net", "info", "de", "fr", "co.uk")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_MAY_START = re.compile(_TRIGGER)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass the kind's test, by kind and start.

    Works in linear time on any text: each pattern is anchored where a match can begin.
    """
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _USER:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
        end = host.end() if host else at + 1
        at = text.find("@", end)
    for chain in _CHAIN.finditer(text):
        parts = list(re.finditer("[0-9]+", chain[0])) if "." in chain[0] else []
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(x := p[0].lstrip("0")) < 4 and int(x or 0) <= 255 for p in four):
                out.append(("ip", chain.start() + four[0].start(), chain.start() + four[3].end()))
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", found.start(), found.end()))
    for found in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in found[0]) <= 15:
            out.append(("phone", found.start(), found.end()))
    return out


class Zone(NamedTuple):
    """Tokens around triggers: ``(start, end, text)``, and whether a base span covers each."""

    tokens: list[tuple[int, int, str]]
    fixed: list[bool]


def zones(text: str, base: list[Span]) -> list[Zone]:
    """Runs of tokens around the triggers that lie outside base spans."""
    if not _MAY_START.search(text):
        return []
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
    covered = np.zeros(len(text) + 1, bool)
    for _, a, b in base:
        covered[a:b] = True
    fixed = [bool(covered[a]) for a, _, _ in tokens]
    near = np.zeros(len(tokens) + 1, np.int64)
    for i, (_, _, token) in enumerate(tokens):
        # A lone digit counts where another number stands next to it, or behind one mark or bracket.
        many = token.isdigit() and (len(token) > 1 or any(t.isdigit() for _, _, t in tokens[i + 1 : i + 5]))
        if not fixed[i] and (many or token == "@" or token.lower() == "dot"):
            near[max(0, i - AROUND)] += 1
            near[min(len(tokens), i + AROUND + 1)] -= 1
    on = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(near)[:-1] > 0, [0]])))
    return [Zone(tokens[a:b], fixed[a:b]) for a, b in zip(on[::2], on[1::2], strict=True)]


def features(text: str, zone: Zone, i: int, j: int) -> list[str] | None:
    """Features of the segment of tokens ``i`` to ``j`` (exclusive) as a whole; None if it can be no entity."""
    tokens = zone.tokens[i:j]
    if any(zone.fixed[i:j]):
        return None
    start, end = tokens[0][0], tokens[-1][1]
    span = text[start:end]
    words = [t.lower() for _, _, t in tokens]
    groups = [t for t in words if t.isdigit()]
    digits = "".join(groups)
    mail = "@" in words or ("at" in words[1:-1] and "dot" in words[2:-1])
    four = len(groups) == 4 and not any(t.isalpha() for t in words) and all(len(g) < 4 and int(g) < 256 for g in groups)
    if "\n" in span or "  " in span or not (mail or four or 7 <= len(digits) <= 20):
        return None
    if any(span.count(a) != span.count(b) for a, b in ("()", "[]", "{}")):
        return None
    if not (words[0][0].isalnum() or words[0] in "+(") or not (words[-1][0].isalnum()):
        return None
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return None
    letters = [t for t in words if t.isalpha()]
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    if mail:
        n = words.index("@") if "@" in words else words.index("at", 1)
        host, head = span[tokens[n][1] - start :].lower(), text[start : tokens[n][0]].rstrip(" [({<")
        spelled = bool((_SPELLED_HOST if words[n] == "at" else _PLAIN_HOST).fullmatch(host.lstrip(" ])>}")))
        shape = "one" if n == 1 else "joined" if " " not in head else "several"
        cut = bool(_HOST_GOES_ON.match(text, end)) or (start > 1 and text[start - 1] in "._%+-" and text[start - 2].isalnum())
        by, brackets = words[n], "".join(c for c in marks if c in "[](){}<>@")
        return [
            "mail", f"by {by} {brackets}", f"ats {min(words.count('@') + words.count('at'), 3)}", f"dots {min(words.count('dot'), 1)}",
            f"head {shape} {cut}", f"ends {len(words[-1]) if words[-1].isalpha() and len(words[-1]) < 5 else 'long'}",
            f"host {spelled}", f"cut {cut}", f"whole {spelled and not cut and shape != 'several'}",
        ]
    shape = "-".join(str(len(g)) for g in groups)
    out = ["bias", f"digits {min(len(digits), 20)}", f"groups {min(len(groups), 7)}", f"letters {min(len(letters), 6)}", f"marks {marks[:8]}"]
    if not letters:
        out += [f"shape {shape}", f"first {words[0] if words[0] in '+(' else 'd'}"]
        if 12 <= len(digits) <= 19:
            out.append(f"luhn {luhn(digits)}")
        if all(len(g) == 1 for g in groups):
            out.append(f"single {len(groups)}")
        if len(groups) == 4:
            at = [n for n, t in enumerate(words) if t.isdigit()]
            between = {text[tokens[m][1] : tokens[n][0]] for m, n in zip(at, at[1:], strict=False)}
            out.append(f"bytes {four} {marks[:4]} {len(between) == 1}")
    return out


Weights = dict[tuple[str, str], float]


def candidates(text: str, zone: Zone) -> list[tuple[int, int, list[str]]]:
    """``(i, j, features)`` of all segments of at most ``LONGEST`` tokens that may be entities.

    No entity crosses a line end, two spaces or a base span, holds more than three marks (``@`` or ``at``), or crosses a space between two words neither of which is ``at`` or
    ``dot``; the last of these is what keeps segments in prose short.
    """
    out, tokens = [], zone.tokens
    marks = np.concatenate([[0], np.cumsum([t == "@" or t.lower() == "at" for _, _, t in tokens])]).tolist()
    digits = np.concatenate([[0], np.cumsum([len(t) if t.isdigit() else 0 for _, _, t in tokens])]).tolist()
    level = {"(": 1, ")": -1, "[": 10**6, "]": -(10**6), "{": 10**12, "}": -(10**12)}
    depth = np.concatenate([[0], np.cumsum([level.get(t, 0) for _, _, t in tokens], dtype=np.int64)]).tolist()
    plain = [t.isalpha() and t.lower() not in ("at", "dot") for _, _, t in tokens]
    ends, end = [0] * len(tokens), len(tokens)
    for i in range(len(tokens) - 1, -1, -1):
        gap = text[tokens[i][1] : tokens[i + 1][0]] if i + 1 < len(tokens) else ""
        if "\n" in gap or "  " in gap or zone.fixed[i] or (gap and plain[i] and plain[i + 1]):
            end = i + 1
        ends[i] = end
    for i, (start, _, token) in enumerate(tokens):
        if zone.fixed[i] or not (token[0].isalnum() or token in "+(") or (start and text[start - 1].isalnum()):
            continue
        last = min(i + LONGEST, ends[i])
        for j in range(i + 1, last + 1):
            if marks[j] - marks[i] > 3 or (digits[j] - digits[i] > 20 and marks[last] == marks[i]):
                break  # several addresses, or longer than any number
            few, many = digits[j] - digits[i] < 4, digits[j] - digits[i] > 20
            if ((few or many) and marks[j] == marks[i]) or depth[j] != depth[i]:
                continue  # neither a number nor an address, or an open bracket
            if (found := features(text, zone, i, j)) is not None:
                out.append((i, j, found))
    return out


def decode(text: str, zone: Zone, weights: Weights, margin: float = MARGIN) -> list[Span]:
    """The best segmentation of a zone: ordinary tokens score 0, a segment its weights less ``margin``."""
    ends: dict[int, list[tuple[int, str, float]]] = defaultdict(list)
    for i, j, found in candidates(text, zone):
        score, kind = max((sum(weights.get((k, f), 0.0) for f in found), k) for k in KINDS)
        if score > margin:
            ends[j].append((i, kind, score - margin))
    if not ends:
        return []
    best, back = [0.0], [None]
    for j in range(1, len(zone.tokens) + 1):
        value, choice = best[j - 1], None
        for i, kind, score in ends.get(j, ()):
            if best[i] + score > value:
                value, choice = best[i] + score, (i, kind)
        best.append(value)
        back.append(choice)
    out, j = [], len(zone.tokens)
    while j:
        if back[j]:
            i, kind = back[j]
            out.append((kind, zone.tokens[i][0], zone.tokens[j - 1][1]))
            j = i
        else:
            j -= 1
    return out[::-1]


def all_spans(text: str, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans together, both by kind as listed and start."""
    base = base_spans(text)
    added = [s for zone in zones(text, base) for s in decode(text, zone, weights)]
    return base, sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit(examples: Iterable[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-3, seed: int = 3) -> Weights:
    """Maximise the likelihood of the given spans by gradient steps, one zone at a time.

    Of each text only the candidates around its triggers are held.  The normaliser sums over all segmentations into ordinary tokens and typed segments, by the forward and backward
    recursions over bounded segments.
    """
    work = []
    for text, spans in examples:
        gold_at = {(a, b): k for k, a, b in spans}
        for zone in zones(text, []):
            found = candidates(text, zone)
            gold = [gold_at.get((zone.tokens[i][0], zone.tokens[j - 1][1])) for i, j, _ in found]
            if found:
                work.append((len(zone.tokens), found, gold))
    weights: Weights = defaultdict(float)
    chance = random.Random(seed)
    for _ in range(epochs):
        chance.shuffle(work)
        for n, found, gold in work:
            ends, starts = defaultdict(list), defaultdict(list)
            scored = [(c, k, sum(weights[k, f] for f in found[c][2])) for c in range(len(found)) for k in KINDS]
            for c, k, s in scored:
                ends[found[c][1]].append((c, s))
                starts[found[c][0]].append((c, s))
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _log_sum([ahead[j - 1], *(ahead[found[c][0]] + s for c, s in ends[j])])
            for i in range(n - 1, -1, -1):
                behind[i] = _log_sum([behind[i + 1], *(behind[found[c][1]] + s for c, s in starts[i])])
            for c, k, s in scored:
                i, j, names = found[c]
                slope = (gold[c] == k) - math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n]))
                if abs(slope) > 1e-4:
                    for f in names:
                        weights[k, f] += rate * (slope - decay * weights[k, f])
    return {k: round(w, 6) for k, w in weights.items() if abs(w) > 1e-6}


def _variants(text: str, base: list[Span], chance: random.Random) -> tuple[str, list[Span]]:
    """A training text in which some base spans take other written forms, and numbers that are no personal data
    stand between its words."""
    parts, spans, done = [], [], 0
    plain = [
        lambda: f"{chance.randint(1900, 2030)}-{chance.randint(1, 12):02d}-{chance.randint(1, 28):02d}",
        lambda: f"{chance.randint(0, 9)}.{chance.randint(0, 40)}.{chance.randint(0, 99)}",
        lambda: str(chance.randint(1000000, 9999999999)),
        lambda: f"{chance.randint(1, 999)},{chance.randint(100, 999)},{chance.randint(100, 999)}.{chance.randint(10, 99)}",
        lambda: "".join(chance.choice("0123456789abcdef") for _ in range(32)),
        lambda: "".join(chance.choice("0123456789") for _ in range(chance.randint(12, 20))),
        lambda: f"{chance.randint(10, 23)}:{chance.randint(10, 59)}:{chance.randint(10, 59)} {chance.randint(1, 31)}.{chance.randint(1, 12)}.{chance.randint(1950, 2030)}",
        lambda: f"{chance.randint(256, 999)}.{chance.randint(0, 999)}.{chance.randint(0, 999)}.{chance.randint(256, 999)}",
        lambda: "look at the dot on it",
        lambda: "@ home",
    ]
    length = 0

    def put(piece: str) -> None:
        nonlocal length
        parts.append(piece)
        length += len(piece)

    last = 0
    for kind, a, b in sorted(base, key=lambda s: s[1]):
        if a < last:
            continue
        put(text[done:a])
        span = text[a:b]
        if chance.random() < 0.75:
            if kind == "email":
                user, host = span.split("@", 1)
                labels = host.split(".")
                labels[-1] = chance.choice([labels[-1], *_ENDINGS])
                labels = chance.choice([labels, labels[-2:], [labels[0], labels[-1]], [*labels, labels[0]], [*labels[:1], *labels, *labels[-1:]]])
                host, user = ".".join(labels), chance.choice([user, re.split("[._%+-]", user.strip("._%+-"))[0]])
                at, dot = chance.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" @ ", "."), (" AT ", " DOT ")])
                span = user.strip("._%+-") + at + host.replace(".", dot)
            elif kind == "phone":
                digits = re.sub("[^0-9]", "", span)
                d = digits[-10:]
                span = chance.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", " ".join(d), "-".join(d), f"00{digits[:-10]} {d[:3]} {d[3:6]} {d[6:]}"])
            elif kind == "card":
                sep = chance.choice([" . ", ".", "/", "  ", " - "]).replace("  ", " ")
                d = re.sub("[^0-9]", "", span)
                span = sep.join(d[i : i + 4] for i in range(0, len(d), 4))
            elif kind == "ip":
                span = span.replace(".", chance.choice(["[.]", " . ", "(.)"]))
        around = chance.choice([("", ""), ("", ""), ("", ""), ("(", ")"), ("", "."), ("", ", or")])
        put(around[0])
        if kind != "email" or span[0].isalnum():
            spans.append((kind, length, length + len(span)))
        put(span + around[1])
        done = last = b
        if chance.random() < 0.7:
            put(f" {chance.choice(plain)()} ")
    put(text[done:])
    return "".join(parts), spans


def learn(texts: list[str], seed: int = 11) -> Weights:
    """Train the field on ``texts``: their base spans, some of them rewritten into other forms, are the truth."""
    chance = random.Random(seed)

    def examples() -> Iterator[tuple[str, list[Span]]]:
        for text in texts:
            base = base_spans(text)
            yield text, base
            for _ in range(REWRITES if base else 1):
                yield _variants(text, base, chance)

    return fit(examples())


def train(docs: DataFrame, most: int = TRAINING_TEXTS, seed: int = 11) -> Weights:
    """Train the field on a bounded sample of at most ``most`` texts of at most ``TRAINING_BYTES`` bytes, the first by a hash
    of the text: one half with the look of a base span, one half with triggers alone, so that rare personal data is not
    crowded out by other numbers.  An empty sample gives a field that adds nothing.  Eager."""
    usable = docs.select("text").filter(F.col("text").rlike(_TRIGGER) & (F.octet_length("text") <= TRAINING_BYTES))
    # Hashes come first: only the texts chosen leave the executors, and copies count once.
    hashed = usable.withColumns({"h": F.xxhash64("text"), "looks": F.col("text").rlike(_LOOKS)})
    texts = []
    for looks in (True, False):
        own = hashed.filter(F.col("looks") == looks)
        first = [r["h"] for r in own.select("h").distinct().orderBy("h").limit(most // 2).collect()]
        if first:
            texts += [r["text"] for r in own.filter(F.col("h") <= first[-1]).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect()]
    weights = learn(texts, seed)
    del texts
    give_back()
    return weights


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, weights: Weights, redact: bool = False) -> DataFrame:
    """Add the columns ``FOUND`` to ``docs``: base spans counted by kind, their digest, and all spans.

    Positions are code points, ends exclusive.  Null text counts as empty and has no span.  With ``redact`` the
    text has every span replaced by its kind in angle brackets (overlapping spans by the first's), and null stays null.
    Existing columns of the new names are replaced, others kept; rows are read one by one.
    """
    names = [f.split()[0] for f in FOUND.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema.fields)
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at = part.schema.names.index("text")
                n = part.num_rows
                counts = np.zeros((len(KINDS), n), np.int64)
                digests, spans = [nothing] * n, [""] * n
                may = pc.fill_null(pc.match_substring_regex(part.column(at), _TRIGGER), False)
                rows = np.flatnonzero(may.to_numpy(zero_copy_only=False))
                changed: dict[int, str] = {}
                for i, text in zip(rows.tolist(), part.column(at).take(pa.array(rows)).to_pylist(), strict=True):
                    base, every = all_spans(text, weights)
                    for kind, _, _ in base:
                        counts[KINDS.index(kind), i] += 1
                    digests[i] = hashlib.sha256(written(base).encode()).hexdigest()
                    spans[i] = written(every)
                    if redact and every:
                        changed[i] = redacted(text, every)
                columns = list(part.columns)
                if changed:
                    texts = columns[at].to_pylist()
                    for i, text in changed.items():
                        texts[i] = text
                    columns[at] = pa.array(texts, columns[at].type)
                new = [*(pa.array(c) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *new], [*part.schema.names, *names])

    return docs.select(kept).mapInArrow(run, f"{schema}, {FOUND}")


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by ``<kind>``."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < done:
            if b > done:
                done = b
            continue
        out += [text[done:a], f"<{kind}>"]
        done = b
    return "".join([*out, text[done:]])
