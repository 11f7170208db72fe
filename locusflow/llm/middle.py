"""Fill-in-middle forms of documents (operator 12).

A text is cut twice at places drawn from a hash of its id, and written as prefix, suffix, middle with a mark before
each.  Cuts are places in code points or ends of lines; pieces are taken in bytes.  Only the characters of several bytes
are recorded: their places and the bytes they have beyond one.  Between them a code point is a byte, so either kind of
place becomes the other by one binary search in that list and a sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from locusflow.llm.words import slices


class Marks(NamedTuple):
    """What stands before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Exceptions(NamedTuple):
    """Characters of several bytes in a run of UTF-8: ``at`` their first bytes, ``point`` their numbers in code points,
    ``excess`` the bytes beyond one of all characters before each, with the total at the end."""

    at: np.ndarray
    point: np.ndarray
    excess: np.ndarray

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte place; the places begin characters."""
        return at - self.excess[np.searchsorted(self.at, at)]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return points + self.excess[np.searchsorted(self.point, points)]


def exceptions(raw: np.ndarray) -> Exceptions:
    """Index of UTF-8 bytes."""
    at = np.flatnonzero(raw >= 0xC0)
    first = raw[at]
    beyond = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
    excess = np.concatenate([[0], np.cumsum(beyond)])
    return Exceptions(at, at - excess[:-1], excess)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each starts, with the end after the last; null texts are empty."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut_places(raw: np.ndarray, starts: np.ndarray, index: Exceptions, unit: str, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and the bytes (two columns, ascending) after which it is cut.

    ``draws`` holds two numbers a text; modulo one more than its units they say after how many of them it is cut.
    """
    a, b = starts[:-1], starts[1:]
    if unit == "line":
        ends = np.flatnonzero(raw == 10)
        first = np.searchsorted(ends, a)
        whole = np.searchsorted(ends, b) - first
        units = whole + (b > a) * (raw[np.maximum(b - 1, 0)] != 10 if len(raw) else False)
    else:
        first = index.to_points(a)
        units = index.to_points(b) - first
    after = np.sort(draws % (units + 1)[:, None], axis=1)
    if unit == "line":
        place = np.concatenate([ends + 1, [0]])[np.minimum(first[:, None] + after - 1, len(ends))]
        return units, np.where(after == 0, a[:, None], np.where(after > whole[:, None], b[:, None], place))
    return units, index.to_bytes(first[:, None] + after)


def rearrange(
    docs: DataFrame, seed: int = 7, unit: str = "line", fim_percent: int = 100, spm_percent: int = 50, marks: Marks = Marks(), id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, units ``n``, ``form``, ``output``, and the code points of prefix, middle and suffix of every row.

    ``unit`` is ``"line"`` (a line with its end, and what follows the last end) or ``"character"`` (a code point).  The
    hex SHA-256 of the seed, a colon and the decimal id gives four numbers of 8 digits: two for the cuts, one for
    whether the text is rearranged, one for whether the suffix comes first (``spm``) or the prefix (``psm``).  A text
    that is empty or holds a mark, and one not chosen, is ``plain``: its output is the text, its counts are null.  A null
    text is an empty one, a null id an empty string.  Rows are handled one by one, so copies under one id get
    equal results; columns other than the two named are not looked at, and texts of any length are handled whole.
    """
    if unit not in ("line", "character"):
        raise ValueError(f"unit is 'line' or 'character', not {unit!r}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])
    own = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"), draws.alias("draws"))
    counts = ["prefix_chars", "middle_chars", "suffix_chars"]
    schema = T.StructType(
        [own.schema["id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("output", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in counts]
    )
    heads = [m.encode() for m in marks]

    def made(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text")
        raw, starts = text_bytes(texts)
        index = exceptions(raw)
        drawn = part.column("draws").flatten().to_numpy().reshape(-1, 4)
        units, cuts = cut_places(raw, starts, index, unit, drawn[:, :2])
        marked = np.zeros(len(texts), bool)
        for m in marks:
            marked |= pc.fill_null(pc.match_substring(texts, m), False).to_numpy(zero_copy_only=False)
        plain = marked | (starts[1:] == starts[:-1]) | (drawn[:, 2] % 100 >= fim_percent)
        spm = drawn[:, 3] % 100 < spm_percent
        places = np.column_stack([starts[:-1], cuts, starts[1:]])
        points = np.diff(index.to_points(places), axis=1)
        view, (p, s, m) = memoryview(raw), heads
        outputs = []
        for own_plain, first, (a, b, c, d) in zip(plain.tolist(), spm.tolist(), places.tolist(), strict=True):
            if own_plain:
                outputs.append(bytes(view[a:d]))
            elif first:
                outputs.append(b"".join((s, view[c:d], p, view[a:b], m, view[b:c])))
            else:
                outputs.append(b"".join((p, view[a:b], s, view[c:d], m, view[b:c])))
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        arrays = [part.column("id"), pa.array(units.astype(np.int64)), pa.array(form.tolist(), pa.string()), pa.array(outputs, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*arrays, *[pa.array(points[:, i], mask=plain) for i in range(3)]], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield made(part)

    return own.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that ``output`` was made from: its pieces put back in order.

    No piece holds a mark, and no mark ends as another begins, so the marks found are those that were written.
    """
    pieces = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks), -1)
    order = F.when(form == "psm", F.array(*[F.get(pieces, F.lit(i)) for i in (1, 3, 2)])).otherwise(F.array(*[F.get(pieces, F.lit(i)) for i in (2, 3, 1)]))
    return F.when(form == "plain", output).otherwise(F.concat_ws("", order))
