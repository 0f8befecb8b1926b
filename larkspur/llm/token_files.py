"""Token-ID / binary output: flat unsigned integer files with 64-bit document offsets.

A store is a folder.  Shard ``i`` holds the documents of the ``i``-th range of ids:

``NNNNNN.bin``  the ids, little-endian, two bytes each if the vocabulary allows, else four
``NNNNNN.off``  one signed 64-bit offset (in ids) for each document, and the end
``NNNNNN.doc``  the documents' ids, signed 64-bit (``NULL_ID`` stands for null)

The base of a shard, that is the number of ids and documents before it, is the prefix
sum over the shards' sizes: the writers return one row for each shard, nothing else
reaches the driver.  A shard is written under another name and then renamed, so a task
that is run again replaces its own shard.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import local_path, shuffle_partitions, sub_batches, text_or_empty
from larkspur.llm.tokens import tokenizer

NULL_ID = -(1 << 63)
PARTS = ("bin", "off", "doc")


@dataclass(frozen=True)
class Shard:
    number: int
    docs: int
    tokens: int
    first_doc: int
    first_token: int


@dataclass(frozen=True)
class TokenStore:
    uri: str
    dtype: str
    shards: tuple[Shard, ...]

    def path(self, number: int, part: str) -> str:
        return f"{self.uri}/{number:06d}.{part}"


def _open_parts(uri: str, number: int) -> dict:
    name = f"{uri}/.{number:06d}-{uuid.uuid4().hex}"
    if base := local_path(name):
        os.makedirs(os.path.dirname(base), exist_ok=True)
        return {p: (f"{base}.{p}", open(f"{base}.{p}", "wb")) for p in PARTS}  # noqa: SIM115
    system, base = fs.FileSystem.from_uri(name)
    return {p: (f"{base}.{p}", system.open_output_stream(f"{base}.{p}")) for p in PARTS}


def _publish(uri: str, number: int, files: dict) -> None:
    for part, (name, handle) in files.items():
        handle.close()
        target = f"{uri}/{number:06d}.{part}"
        if path := local_path(target):
            os.replace(name, path)
        else:
            system, path = fs.FileSystem.from_uri(target)
            system.move(name, path)


def read_array(uri: str, dtype: str) -> np.ndarray:
    """A part as an array: mapped into memory where the store is a mounted folder."""
    if path := local_path(uri):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write_token_files(docs: DataFrame, uri: str, tokenizer_path: str, *, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text", shards: int | None = None) -> TokenStore:
    """Writes the ids of all texts of ``docs`` in ascending order of their id.

    Null text counts as empty and yields the end id alone; rows with a null id come
    first; rows that share an id are ordered by text and each keeps its own entry; an
    empty table yields a store without shards that hold anything.  Columns other than
    the two named ones are not read.
    """
    n = shards or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    rows = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, number, total, count = tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId(), 0, 0
        files = _open_parts(uri, number)
        files["off"][1].write(np.zeros(1, "<i8").tobytes())
        for batch in batches:
            for part in sub_batches(batch, "text"):
                ids = t.encode(part.column("text").to_pylist())
                ends = total + np.cumsum([len(x) // t.dtype.itemsize for x in ids], dtype="<i8")
                files["bin"][1].write(b"".join(ids))
                files["off"][1].write(ends.tobytes())
                files["doc"][1].write(part.column("id").fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
                total, count = int(ends[-1]), count + len(ids)
        _publish(uri, number, files)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([count]), pa.array([total]), pa.array([t.dtype.str])], names=["number", "docs", "tokens", "dtype"])

    sizes = sorted(rows.mapInArrow(write, "number int, docs long, tokens long, dtype string").collect())
    first_docs = accumulate((r.docs for r in sizes), initial=0)
    first_tokens = accumulate((r.tokens for r in sizes), initial=0)
    made = tuple(Shard(r.number, r.docs, r.tokens, d, k) for r, d, k in zip(sizes, first_docs, first_tokens, strict=False))
    return TokenStore(uri, sizes[0].dtype if sizes else "<u4", made)


def read_documents(spark: SparkSession, store: TokenStore) -> DataFrame:
    """One row for each document, from the files: its id, place and ids.

    ``ids`` is the documents' ids as little-endian unsigned 32-bit integers.
    """
    return _read(spark, store, lambda a: a.astype("<u4").tobytes(), "ids", pa.binary(), "binary")


def document_digests(spark: SparkSession, store: TokenStore) -> DataFrame:
    """As ``read_documents`` with the CRC-32 of the ids in their place."""
    return _read(spark, store, lambda a: zlib.crc32(a.astype("<u4").tobytes()), "ids_crc32", pa.int64(), "long")


def _read(spark: SparkSession, store: TokenStore, value, name: str, kind: pa.DataType, sql: str, rows: int = 2000) -> DataFrame:
    shards = {i: s for i, s in enumerate(store.shards)}
    dtype = store.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                s = shards[i]
                ids, off, doc = (read_array(store.path(s.number, p), d) for p, d in zip(PARTS, (dtype, "<i8", "<i8"), strict=True))
                for a in range(0, s.docs, rows):
                    b = min(a + rows, s.docs)
                    o = np.asarray(off[a : b + 1])
                    key = np.asarray(doc[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, mask=key == NULL_ID), pa.array(s.first_token + o[:-1]), pa.array(np.diff(o)), pa.array([value(ids[x:y]) for x, y in zip(o[:-1], o[1:], strict=True)], kind)],
                        names=["doc_id", "start", "n_tokens", name],
                    )

    n = len(shards)
    return spark.range(0, n, 1, max(n, 1)).mapInArrow(read, f"doc_id long, start long, n_tokens long, {name} {sql}")
