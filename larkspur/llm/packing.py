"""Packing by power-of-two decomposition.

The ids of a document are cut into pieces whose lengths are the binary digits of its
length: as many pieces of ``sequence_length`` as fit, then one for each set bit of the
rest, longest first.  Each piece is a training sequence of its own, so no sequence
crosses documents and none needs padding; pieces of one length share a bucket, from
which batches of equal length are drawn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import BROADCAST_IDS, sub_batches, text_or_empty, written
from larkspur.llm.tokens import tokenizer


def piece_lengths(n: int, sequence_length: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: powers of two, longest first."""
    whole, rest = divmod(n, sequence_length)
    return [sequence_length] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, *, sequence_length: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each piece, which is one sequence.

    Columns: ``doc_id``, ``start`` (its document's ids before it), ``length``,
    ``doc_tokens``, ``bucket`` (binary logarithm of the length), ``sequence_id`` (the
    sequences of a bucket are numbered one after another, bucket 0 first), ``offset``
    (always 0) and ``ids`` (little-endian unsigned integers of ``id_bytes`` bytes).

    Null or empty text has the end id alone, so it is one piece of length 1.  Rows that
    share an id or have none are documents of their own.  An empty table has no pieces.
    The pieces are written once, by bucket, to the shared folder; sequence numbers are
    prefix sums over one count for each bucket and task.
    """
    if sequence_length & (sequence_length - 1) or sequence_length < 1:
        raise ValueError("sequence_length must be a power of two")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    last = sequence_length.bit_length() - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, task, count = tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId(), [0] * (last + 1)
        width = t.dtype.itemsize
        for batch in batches:
            for part in sub_batches(batch, "text"):
                out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "bucket", "task", "nth", "id_bytes", "ids")}
                for doc, ids in zip(part.column("doc_id").to_pylist(), t.encode(part.column("text").to_pylist()), strict=True):
                    n, at = len(ids) // width, 0
                    for length in piece_lengths(n, sequence_length):
                        b = length.bit_length() - 1
                        for k, v in zip(out, (doc, at, length, n, b, task, count[b], width, ids[at * width : (at + length) * width]), strict=True):
                            out[k].append(v)
                        count[b] += 1
                        at += length
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if k == "ids" else pa.int32() if k in ("bucket", "task", "id_bytes") else pa.int64()) for k, v in out.items()], names=list(out))

    pieces = written(rows.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, bucket int, task int, nth long, id_bytes int, ids binary"), "pieces", ["bucket"])
    # A row for each bucket and task of the writing job; buckets one after another, tasks within.
    counts = pieces.groupBy("bucket", "task").agg(F.count("*").alias("n"))
    own = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = written(counts.select("bucket", "task", "n", (F.sum("n").over(own) - F.col("n")).alias("before")), "sizes")
    totals = sizes.groupBy("bucket").agg(F.sum("n").alias("total"))  # a row a bucket, of which there are few
    earlier = totals.alias("a").join(F.broadcast(totals.alias("b")), F.col("b.bucket") < F.col("a.bucket"), "left").groupBy("a.bucket").agg(F.coalesce(F.sum("b.total"), F.lit(0)).alias("first"))
    base = sizes.join(F.broadcast(earlier), "bucket").select("bucket", "task", (F.col("first") + F.col("before")).alias("base"))
    base = F.broadcast(base) if sizes.count() <= BROADCAST_IDS else base
    return pieces.join(base, ["bucket", "task"]).select("doc_id", "start", "length", "doc_tokens", "bucket", (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "id_bytes", "ids")


def with_crc32(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    keep = [c for c in pieces.columns if c not in ("ids", "id_bytes")]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes()) for x, w in zip(batch.column("ids").to_pylist(), batch.column("id_bytes").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])

    kinds = dict(pieces.dtypes)
    return pieces.mapInArrow(digest, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", ids_crc32 long")
