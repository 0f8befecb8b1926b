"""Spans of a text: ``(kind, start, end)`` in code points, the end exclusive."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]

SPANS_SQL = "array<struct<kind:string,start:int,end:int>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def ordered(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then by the place of the kind in ``kinds``, then by end."""
    place = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], place[s[0]], s[2]))


def spans_array(rows: list[list[Span]]) -> pa.Array:
    """Rows of spans as an Arrow array of lists, built from flat columns."""
    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    flat = [s for row in rows for s in row]
    kind, start, end = zip(*flat, strict=True) if flat else ((), (), ())
    values = pa.StructArray.from_arrays([pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def joined(spans: Column) -> Column:
    """``kind:start:end``, joined by commas; empty without spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(spans: Column, base: Sequence[str]) -> list[Column]:
    """Columns ``n_<kind>`` for each base kind, ``base_sha256`` and ``spans``."""

    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    count = [of(k) for k in base]
    own = F.filter(spans, lambda s: s["kind"].isin(list(base)))
    return [*count, F.sha2(joined(own), 256).alias("base_sha256"), joined(spans).alias("spans")]
