"""Byte-level BPE encoding and decoding with segment trees of pair ranks.

A piece of text (a match of the splitting pattern) starts as one part a byte.  A segment
tree over its byte positions holds, for each span of positions, the least ``(rank,
position)`` of a pair of neighbouring parts that starts there; its root is the leftmost
pair of the least rank.  A merge changes three positions at most (the pair's own, the one
that is no longer a part's start, and the live neighbour's before it), each by a point
update up to the root.

Short pieces are merged many at a time: a *forest* has a tree a row, and each round takes
the root of every row that still has a pair.  Longer pieces take one tree of their own,
with the same steps.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from larkspur.llm.common import per_text, text_or_empty, unused

#: No pair starts at a position.
NONE = (1 << 62) - 1
#: Widths of the forests' rows in bytes, the positions of a forest, and the rows from which one pays.
WIDTHS, FOREST, LEAST_ROWS = (8, 16, 32, 64, 128, 256, 512), 1 << 19, 24
#: Distinct pieces in each of the two generations that a worker keeps; a longer one is not kept.
CACHE_PIECES, LONGEST_KEPT = 250_000, 200
#: Texts of more characters are split into this many pieces at a time.
LONG_TEXT, PIECES = 1_000_000, 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Pairs:
    """Which two parts join to a token: an open-addressed table of ``(left id, right id)``."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        made = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    made[a << 32 | b] = rank
        self.dict = made
        self.bits = max(4, (4 * len(made)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        key, rank = np.fromiter(made.keys(), np.int64, len(made)), np.fromiter(made.values(), np.int64, len(made))
        slot = self._slots(key)
        while len(key):  # of those that want a free slot one gets it, the others look at the next
            free = np.flatnonzero(self.keys[slot] == -1)
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[won]], self.ranks[slot[won]] = key[won], rank[won]
            left = np.ones(len(key), bool)
            left[won] = False
            key, rank, slot = key[left], rank[left], (slot[left] + 1) & (len(self.keys) - 1)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it isn't a token."""
        key = left.astype(np.int64) << 32 | right
        slot, out = self._slots(key), np.full(len(key), NONE, np.int64)
        held = self.keys[slot]
        hit = np.flatnonzero(held == key)
        out[hit] = self.ranks[slot[hit]]
        open_ = np.flatnonzero((held != key) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[open_]]
            hit = open_[held == key[open_]]
            out[hit] = self.ranks[slot[hit]]
            open_ = open_[(held != key[open_]) & (held != -1)]
        return out


def merge_forest(rows: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merges of many pieces: ids, and which positions start a part.

    ``rows`` has a piece a row, as ids of its single bytes, of ``lengths`` each (the rest
    is ignored); its width is a power of two.
    """
    m, width = rows.shape
    shift = width.bit_length() - 1
    ids, place = rows.astype(np.int64), np.arange(width)
    live = place < lengths[:, None]
    after = np.broadcast_to(place + 1, (m, width)).astype(np.int32)
    before = np.broadcast_to(place - 1, (m, width)).astype(np.int32)
    tree = np.full((m, 2 * width), NONE, np.int64)
    r, p = np.nonzero(place < lengths[:, None] - 1)
    rank = pairs.of(ids[r, p], ids[r, p + 1])
    tree[r, width + p] = np.where(rank == NONE, NONE, rank << shift | p)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(row: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
        node = at + width
        tree[row, node] = value
        while len(row) and node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.flatnonzero(tree[:, 1] != NONE)
    while len(row):
        least = tree[row, 1]
        at = least & (width - 1)
        gone = after[row, at]
        ids[row, at], live[row, gone] = least >> shift, False
        end = after[row, gone]
        after[row, at] = end
        put(row, gone, NONE)
        inner = end < lengths[row]
        before[row[inner], end[inner]] = at[inner]
        value = np.full(len(row), NONE, np.int64)
        value[inner] = pairs.of(ids[row[inner], at[inner]], ids[row[inner], end[inner]])
        put(row, at, np.where(value == NONE, NONE, value << shift | at))
        first = before[row, at] >= 0
        r, q, p = row[first], before[row, at][first], at[first]
        value = pairs.of(ids[r, q], ids[r, p])
        put(r, q, np.where(value == NONE, NONE, value << shift | q))
        row = row[tree[row, 1] != NONE]
    return ids, live


def merge_tree(parts: list[int], pairs: dict[int, int]) -> list[int]:
    """Ids after all merges of one piece, given as ids of its single bytes."""
    n = len(parts)
    shift = max(1, (n - 1).bit_length())
    width, mask = 1 << shift, (1 << shift) - 1
    ids, after, before = array("q", parts), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    tree = array("q", [NONE]) * (2 * width)

    def value(a: int, b: int) -> int:
        rank = pairs.get(ids[a] << 32 | ids[b]) if b < n else None
        return NONE if rank is None else rank << shift | a

    def put(at: int, new: int) -> None:
        node = width + at
        tree[node] = new
        while node > 1:
            new = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == new:
                break
            tree[node] = new

    for i in range(n - 1):
        tree[width + i] = value(i, i + 1)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] != NONE:
        at = tree[1] & mask
        gone, ids[at] = after[at], tree[1] >> shift
        end = after[at] = after[gone]
        put(gone, NONE)
        if end < n:
            before[end] = at
        put(at, value(at, end))
        if before[at] >= 0:
            put(before[at], value(before[at], at))
    out, at = [], 0
    while at < n:
        out.append(ids[at])
        at = after[at]
    return out


class ByteBpe:
    """Encoder and decoder of a rank file and a splitting pattern; keeps the ids of pieces that occur again."""

    def __init__(self, path: str, pattern: str, cache_pieces: int = CACHE_PIECES) -> None:
        import regex

        self.ranks = read_ranks(path)
        self.pattern, self.pairs = regex.compile(pattern), Pairs(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.younger: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids (little-endian unsigned 32-bit) of each piece; a piece that is a token is that token."""
        out: list[bytes | None] = [None if (rank := self.ranks.get(p)) is None else rank.to_bytes(4, "little") for p in pieces]
        open_ = [i for i, x in enumerate(out) if x is None]
        lengths = np.array([len(pieces[i]) for i in open_], np.int64)
        done = np.zeros(len(open_), bool)
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            of = np.flatnonzero((lengths > low) & (lengths <= width))
            if len(of) < LEAST_ROWS:
                continue
            done[of] = True
            for a in range(0, len(of), FOREST // width):
                part = of[a : a + FOREST // width]
                flat = np.frombuffer(b"".join(pieces[open_[i]].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
                ids, live = merge_forest(self.single[flat], lengths[part], self.pairs)
                data, ends = ids[live].astype("<u4").tobytes(), np.cumsum(live.sum(1)).tolist()
                for i, x, y in zip(part, [0, *ends], ends, strict=False):
                    out[open_[i]] = data[4 * x : 4 * y]
        for i in np.flatnonzero(~done):
            parts = self.single[np.frombuffer(pieces[open_[i]], np.uint8)].tolist()
            out[open_[i]] = np.array(merge_tree(parts, self.pairs.dict), "<u4").tobytes()
        return out

    def _learn(self, pieces: Iterable[str]) -> None:
        """Sees to it that ``younger`` has all ``pieces``."""
        if len(self.younger) > self.cache_pieces:
            self.younger, self.older = {}, self.younger
        new = list(set(pieces).difference(self.younger))
        for piece in new:
            if (found := self.older.get(piece)) is not None:
                self.younger[piece] = found
        new = [x for x in new if x not in self.younger]
        self.younger.update(zip(new, self.merged([x.encode() for x in new]), strict=True))
        for piece in new:
            if len(piece) > LONGEST_KEPT:
                self.long.append(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        split: list[list[str]] = []
        self.long: list[str] = []
        out: list[bytes | None] = [None] * len(texts)
        for i, text in enumerate(texts):
            if len(text) > LONG_TEXT:
                out[i], matches = b"", (m[0] for m in self.pattern.finditer(text))
                while some := list(islice(matches, PIECES)):
                    self._learn(some)
                    out[i] += b"".join(map(self.younger.__getitem__, some))
                split.append([])
            else:
                split.append(self.pattern.findall(text))
        self._learn(piece for pieces in split for piece in pieces)
        for i, pieces in enumerate(split):
            if out[i] is None:
                out[i] = b"".join(map(self.younger.__getitem__, pieces))
        for piece in self.long:
            self.younger.pop(piece, None)
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes behind ids; an id without a token is an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> ByteBpe:
    """One per worker process, file and pattern."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, *, pattern: str = public_tokenizers.PATTERN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of each row of ``docs``.

    A null or empty text has no ids.  Rows that share an id or have none stay rows of
    their own; an empty table yields no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _codec(path, pattern).encode(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return rows.mapInArrow(per_text(one, "text"), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (any columns, among them ``ids``) with the bytes ``decoded`` from the ids.

    Null ids give null.  The name gets underscores before it where ``encoded`` has such a column.
    """
    name = unused("decoded", encoded.columns)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(path, public_tokenizers.PATTERN)
        found = [None if x is None else codec.decode(x) for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, name])

    return encoded.mapInArrow(per_text(one, "ids"), StructType([*encoded.schema.fields, StructField(name, BinaryType())]))


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """``encode``'s rows with the digests of the ids and of the bytes decoded from them."""
    return decode(encoded, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
