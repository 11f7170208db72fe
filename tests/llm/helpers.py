"""Small tables with every odd case, and brute-force versions."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}x{'.' if chance.random() < 0.12 else ''}" for _ in range(n))


def odd_documents() -> list[tuple]:
    """Nulls in every column, empty, blank, short and very long texts, repeated rows, copies and near copies."""
    base = words(1, 120)
    near = base.replace("w1", "W1", 3) + " tail"
    long = words(2, 6000, 5000)
    texts = [
        base, base, near, base.upper().replace("W", "w").replace("X", "x"), "", " \t\n", None, "one", "one", "one two", "One  two\n",
        "é ü ß日本", long, long + " more", words(3, 60) + "\n" + base[:300], "<|endoftext|> a.b, c. <|x", "don't we'll 12.5 %%%",
        "mail bob.42@mail8.example.com or +1 (988) 555-2485 or 4387513035237269 at 10.0.0.255",
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, base, "en", "src0", 3), (100, words(9, 30), None, None, None), (-5, near, None, None, 0)]
    return rows


def shingles(text: str | None, n: int) -> frozenset:
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall("[^\\x20\\x09-\\x0D]+", folded)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))) if len(own) >= n else frozenset([tuple(own)])


def brute_components(rows: list[tuple], n: int, percent: int) -> list[tuple]:
    """``(doc_id, n_shingles, component_id)`` of every row, sorted."""
    sets = [shingles(r[1], n) for r in rows]
    head = list(range(len(rows)))

    def find(i: int) -> int:
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            if 100 * len(a & b) >= percent * len(a | b):
                head[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if r[0] is not None else None) for i, r in enumerate(rows)), key=str)
