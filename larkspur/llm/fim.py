"""Fill-in-middle transformation by displacement scatter.

A scan of a batch's bytes finds where units of text end, and so the cuts of each text.
Difference arrays hold, at each cut, by how much the shift of the bytes behind it changes;
their cumulative sum is each byte's shift from its place in the batch to its place in the
output, where one scatter puts it.  The way back finds the sentinels in the outputs, makes
the same arrays from their places, and gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from larkspur.llm.common import per_text, text_or_empty, unused

#: Sentinels, all of one length, before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WIDTH = 3
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes whose shifts are held at a time.
BLOCK = 1 << 20
#: A unit of text: white space and the word behind it, or the white space that ends a text.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Policy:
    """``seed`` and the percentages of transformed texts, and of those with the suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80


def _space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of all texts, one text after another, and where each text's begin among them (and the end).

    ``data`` is the texts' bytes, ``offsets`` each text's first byte and the end.
    """
    last = np.zeros(len(data), bool)
    last[offsets[1:][np.diff(offsets) > 0] - 1] = True  # a text's last byte ends a unit, be it a word or white space
    space = _space(data)
    last[:-1] |= ~space[:-1] & space[1:]  # and so does a word's
    ends = np.flatnonzero(last) + 1
    return ends, np.searchsorted(ends, offsets, "right")


def _code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _shifted(n: int, at: np.ndarray, step: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks ``(start, end, place in the output of each byte)`` from the changes ``step`` of the shift at ``at``."""
    order = np.argsort(at, kind="stable")
    at, step, carry = at[order], step[order], 0
    for start in range(0, n, BLOCK):
        end = min(start + BLOCK, n)
        a, b = np.searchsorted(at, (start, end))
        shift = np.zeros(end - start, np.int64)
        np.add.at(shift, at[a:b] - start, step[a:b])
        shift[0] += carry
        shift = np.cumsum(shift)
        carry = int(shift[-1])
        yield start, end, shift + np.arange(start, end)


def _moves(offsets: np.ndarray, out: np.ndarray, cuts: np.ndarray, suffix_first: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the shift changes, and by how much, over texts at ``offsets`` with outputs at ``out`` (both with the end).

    ``cuts`` holds the two cuts of the texts that are ``moved``; the others only move as a whole.
    """
    start, end, a, b = offsets[:-1], offsets[1:], cuts[:, 0], cuts[:, 1]
    base = out[:-1] - start
    tail, middle = end - b, b - a
    prefix = base + np.where(moved, np.where(suffix_first, 2 * WIDTH + tail, WIDTH), 0)
    suffix = np.where(suffix_first, base + WIDTH + start - b, base + 2 * WIDTH - middle)
    whole = np.stack([prefix, np.where(moved, base + 3 * WIDTH + tail, prefix), np.where(moved, suffix, prefix)], 1)
    steps = np.diff(whole.reshape(-1), prepend=0)
    places = np.stack([start, np.where(moved, a, start), np.where(moved, b, start)], 1).reshape(-1)
    return places, steps


def transformed(texts: pa.Array, ids: list[int | None], policy: Policy) -> dict[str, list | pa.Array]:
    """Units, form, cuts in code points, and output of each text of an Arrow array of strings without nulls."""
    offsets, data = _bytes_of(texts)
    ends, first = unit_ends(data, offsets)
    n, rows = np.diff(first), len(texts)
    forms, cuts, moved = [PLAIN] * rows, np.stack([offsets[:-1]] * 2, 1), np.zeros(rows, bool)
    marks = _found(data, offsets)
    for i, doc in enumerate(ids):
        if not n[i] or marks[i]:
            continue
        h1, h2, h3, h4 = _draws(doc, policy.seed)
        if h3 % 100 >= policy.rate:
            continue
        forms[i], moved[i] = SPM if h4 % 100 < policy.spm else PSM, True
        units = sorted((h1 % (int(n[i]) + 1), h2 % (int(n[i]) + 1)))
        cuts[i] = [ends[first[i] + u - 1] if u else offsets[i] for u in units]
    suffix_first = np.array([f == SPM for f in forms], bool)
    out = np.concatenate(([0], np.cumsum(np.diff(offsets) + np.where(moved, 3 * WIDTH, 0))))
    made = np.empty(int(out[-1]), np.uint8)
    for start, end, place in _shifted(len(data), *_moves(offsets, out, cuts, suffix_first, moved)):
        made[place] = data[start:end]
    a, b = cuts[:, 0] - offsets[:-1], cuts[:, 1] - offsets[:-1]
    tail = np.diff(offsets) - b
    for mark, place in ((PREFIX, np.where(suffix_first, WIDTH + tail, 0)), (SUFFIX, np.where(suffix_first, 0, WIDTH + a)), (MIDDLE, np.where(suffix_first, 2 * WIDTH + tail + a, 2 * WIDTH + a + tail))):
        at = (out[:-1] + place)[moved]
        for k in range(WIDTH):
            made[at + k] = mark[k]
    chars = [(_code_points(data[s:x]), _code_points(data[x:y])) if m else (None, None) for s, (x, y), m in zip(offsets[:-1], cuts, moved, strict=True)]
    return {"n": n.tolist(), "form": forms, "prefix_chars": [x for x, _ in chars], "middle_chars": [y for _, y in chars], "output": _strings(made, out)}


def restored(outputs: pa.Array, forms: list[str]) -> pa.Array:
    """The texts behind ``outputs`` and their forms: an inverse gather at places that the sentinels give."""
    out, data = _bytes_of(outputs)
    moved, suffix_first = np.array([f != PLAIN for f in forms], bool), np.array([f == SPM for f in forms], bool)
    offsets = np.concatenate(([0], np.cumsum(np.diff(out) - np.where(moved, 3 * WIDTH, 0))))
    # A transformed text held no sentinel, so each sentinel occurs once, the first one at the output's start.
    second, third = _places(data, out, moved, suffix_first)
    first, between = second - out[:-1] - WIDTH, third - second - WIDTH
    a = np.where(suffix_first, between, first)
    tail = np.where(suffix_first, first, between)
    cuts = np.where(moved[:, None], np.stack([offsets[:-1] + a, offsets[1:] - tail], 1), np.stack([offsets[:-1]] * 2, 1))
    text = np.empty(int(offsets[-1]), np.uint8)
    for start, end, place in _shifted(len(text), *_moves(offsets, out, cuts, suffix_first, moved)):
        text[start:end] = data[place]
    return _strings(text, offsets)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, with the end) and bytes of an array of strings."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, "<i8")[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, "<i8")
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return offsets - offsets[0], held


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(data))


def _sentinels(data: np.ndarray, marks: tuple[bytes, ...]) -> np.ndarray:
    """Places of any of ``marks`` in ``data``, in order."""
    if len(data) < WIDTH:
        return np.empty(0, np.int64)
    at = np.flatnonzero(data[: 1 - WIDTH] == marks[0][0])
    return at[np.isin(data[at + 1], [m[1] for m in marks]) & (data[at + 2] == marks[0][2])] if len(at) else at


def _found(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a sentinel; one across the border of two texts is in neither."""
    at = _sentinels(data, (PREFIX, SUFFIX, MIDDLE))
    text = np.searchsorted(offsets, at, "right") - 1
    return np.bincount(text[at + WIDTH <= offsets[text + 1]], minlength=len(offsets) - 1).astype(bool)


def _places(data: np.ndarray, out: np.ndarray, moved: np.ndarray, suffix_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the second and the third sentinel of each transformed output stand."""
    second, third = out[:-1].copy(), out[:-1].copy()
    for mark, places in ((SUFFIX, second), (PREFIX, second), (MIDDLE, third)):
        at = _sentinels(data, (mark,))
        text = np.searchsorted(out, at, "right") - 1
        inside = (at + WIDTH <= out[text + 1]) & moved[text] & (True if mark == MIDDLE else (suffix_first[text] == (mark == PREFIX)))
        places[text[inside]] = at[inside]
    return second, third


def transform(docs: DataFrame, policy: Policy = Policy(), *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:  # noqa: B008
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row of ``docs``.

    A null text counts as empty, whose form is plain; so is that of a text with a
    sentinel in it.  A null id draws as an empty one; rows that share an id draw alike.
    An empty table yields no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = transformed(batch.column("text"), batch.column("doc_id").to_pylist(), policy)
        count = [pa.array(found[c], pa.int64()) for c in ("n", "prefix_chars", "middle_chars")]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), count[0], pa.array(found["form"], pa.string()), *count[1:], found["output"].cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(per_text(one, "text"), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(found: DataFrame) -> DataFrame:
    """``found`` (any columns, among them ``output`` and ``form``) with the text rebuilt from those two, as ``restored``.

    The name gets underscores before it where ``found`` has such a column.
    """
    name = unused("restored", found.columns)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = restored(batch.column("output"), batch.column("form").to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, text.cast(pa.string())], names=[*batch.schema.names, name])

    return found.mapInArrow(per_text(one, "output"), StructType([*found.schema.fields, StructField(name, StringType())]))


def digests(found: DataFrame) -> DataFrame:
    """``transform``'s rows with the digests of the output and of the text rebuilt from it."""
    return restore(found).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def transform_sql(policy: Policy = Policy()) -> str:  # noqa: B008
    """DuckDB SQL for the rows of ``digests``."""
    h = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{policy.seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT doc_id, text, regexp_extract_all(text, '{UNIT}') AS units, {h} FROM d),
    c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
          CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {policy.rate} THEN 'plain' WHEN h4 % 100 < {policy.spm} THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
    FROM p
    """
