"""Conversation prefix trie by a splitter skeleton.

A conversation is a path: 20 bytes a turn (a digest of role and text, then the text's
UTF-8 length), so prefixes of a path at multiples of 20 are the nodes above it, and the
conversations below a node are neighbours in the order of paths.

Paths are dealt out to shards by splitters, points ``(path, conv_id)`` in that order.  A
node whose conversations fall into two shards or more is a prefix of a splitter: whatever
lies between two strings with one prefix has that prefix, too.  The trie of the splitters'
paths, the *skeleton*, is therefore broadcast; a shard, sorted, finishes every other node in
one pass with the current path as its only state, and gives a partial aggregate for each
skeleton node that it meets.  The partials are then added up.  As splitters hold the
conversation's id besides its path, even a path that most conversations share is dealt out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import shuffle_partitions, text_or_empty, written

#: Bytes of a turn in a path: of its digest, and of its text's length behind it.
DIGEST, ENTRY = 16, 20
#: Bytes that the sampled splitters may have in all, which bounds the skeleton; a splitter
#: whose share is less than its path is cut short, which leaves it a valid splitter.
SKELETON_BYTES = 32_000_000
#: Sampled conversations for each splitter.
OVERSAMPLE = 10
#: Ids in a chunk of a skeleton node's conversations, and rows of a batch that a shard gives.
CHUNK_IDS, BATCH_ROWS = 100_000, 4_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

#: What a row of a shard is: a node whose parent is known, a node below a skeleton node,
#: a partial of a skeleton node, ids of conversations that end at a skeleton node.
NODE, BELOW, PARTIAL, ENDS = range(4)
ROWS = "kind int, skeleton int, shard int, seq int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
ROWS_ARROW = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for c, t in (x.split() for x in ROWS.split(", "))])
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path`` of every conversation with an id.

    Turns are ordered by ``turn``, null first; turns that share it are ordered by their
    digest.  A null role or text is empty.  Turns are sorted by range, so those of one
    conversation may lie in several tasks; each gives its part as one cell.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    entry = F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(text)), 2 * (ENTRY - DIGEST), "0")))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", entry.alias("entry"))
    turns = turns.repartitionByRange(shuffle_partitions(conversations.sparkSession), "conv_id", "turn", "entry").sortWithinPartitions("conv_id", "turn", "entry")
    rows = turns.select("conv_id", F.spark_partition_id().alias("part"), "entry")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            ids, column = batch.column(0).to_numpy(), batch.column(2)
            data, base = memoryview(column.buffers()[2]), int(np.frombuffer(column.buffers()[1], "<i4")[column.offset])
            first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            cut = [*(base + ENTRY * first).tolist(), base + ENTRY * len(ids)]
            at = (batch.column(1)[0].as_py() << 32) + seq
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array([at] * len(first), pa.int64()), pa.array([bytes(data[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], names=["conv_id", "at", "entries"])

    return rows.mapInArrow(parts, "conv_id long, at long, entries binary").groupBy("conv_id").agg(F.expr("listagg(entries, x'') within group (order by at)").alias("path"))


def with_shared_starts(own: DataFrame, every: int, most: int) -> DataFrame:
    """``own`` rebuilt: conversation ``c`` starts with the first turns of ``c - c % every``.

    ``crc32(c) % most`` of them (all if it has fewer, none if there is no such
    conversation) take the place of as many turns of its own.
    """
    turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = own.select("conv_id", "path", (F.col("conv_id") - F.col("conv_id") % every).alias("start"), (ENTRY * turns).cast("int").alias("head"))
    heads = own.select(F.col("conv_id").alias("start"), F.substring("path", 1, ENTRY * most).alias("of_start"))
    empty = F.unhex(F.lit(""))
    taken = F.coalesce(F.substr("of_start", F.lit(1), F.col("head")), empty)
    return own.join(heads, "start", "left").select("conv_id", F.concat(taken, F.substr("path", F.col("head") + 1, F.greatest(F.octet_length("path") - F.col("head"), F.lit(0)))).alias("path"))


@dataclass(frozen=True)
class Skeleton:
    """Splitters, and the trie of their paths; nodes are numbered in the order of paths, the root is 0."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int]
    parent: list[int]
    depth: list[int]
    size: list[int]

    @classmethod
    def of(cls, splitters: Iterable[tuple[bytes, int]]) -> Skeleton:
        made = cls(sorted(splitters), {}, [-1], [0], [0])
        for path, _ in made.splitters:
            node = 0
            for i in range(0, len(path), ENTRY):
                entry = path[i : i + ENTRY]
                if (node, entry) not in made.child:
                    made.child[node, entry] = len(made.parent)
                    made.parent.append(node)
                    made.depth.append(made.depth[node] + 1)
                    made.size.append(int.from_bytes(entry[DIGEST:], "big"))
                node = made.child[node, entry]
        return made


def skeleton(rows: DataFrame, shards: int) -> Skeleton:
    """Splitters of about ``shards`` parts of ``conv_id, path``, from a sample by the id's hash."""
    wanted = shards * OVERSAMPLE
    every = max(1, rows.count() // wanted)
    longest = max(1, SKELETON_BYTES // wanted // ENTRY) * ENTRY
    sample = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select(F.substring("path", 1, longest).alias("path"), "conv_id").collect()
    points = sorted((bytes(r.path), r.conv_id) for r in sample)
    return Skeleton.of({points[i * len(points) // shards] for i in range(1, shards)} if points else [])


class _Open:
    """A node on the current path."""

    __slots__ = ("children", "ended", "ends", "entry", "held", "leaves", "least", "n", "saved", "seq", "skeleton")

    def __init__(self, entry: bytes, skeleton: int | None) -> None:
        self.entry, self.skeleton, self.n, self.least, self.children, self.leaves, self.saved = entry, skeleton, 0, None, 0, 0, 0
        self.held: list[tuple] = []  # finished children that wait for this node's smallest member
        self.ends = hashlib.sha256() if skeleton is None else []
        self.ended, self.seq = False, 0

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


def shard_rows(shard: int, members: Iterable[tuple[bytes, int]], trie: Skeleton) -> Iterator[tuple]:
    """Rows (``ROWS``) of one shard from its ``(path, conv_id)`` in order."""
    stack = [_Open(b"", 0)]

    def chunk(node: _Open) -> tuple:
        ids, node.ends, node.seq = ",".join(node.ends), [], node.seq + 1
        return (ENDS, node.skeleton, shard, node.seq, None, None, None, None, None, None, None, ids)

    def close() -> Iterator[tuple]:
        node, depth = stack.pop(), len(stack)
        size = int.from_bytes(node.entry[DIGEST:], "big")
        above = stack[-1] if stack else None
        if node.skeleton is None:
            yield from ((NODE, None, shard, 0, *row[:2], node.least, *row[2:]) for row in node.held)
            leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * size
            row = (node.least, depth, node.n, node.children, leaves, saved, node.ends.hexdigest())
            above.children += 1
            if above.skeleton is None:
                above.held.append(row)
            else:
                yield (BELOW, above.skeleton, shard, 0, *row[:2], None, *row[2:])
        else:
            # Once for each member; Skeleton's sizes are taken off again when all shards are added up.
            leaves, saved = node.leaves, node.saved + node.n * size
            yield (PARTIAL, node.skeleton, shard, 0, node.least, depth, None, node.n, node.children, leaves, saved, None)
            if node.ends:
                yield chunk(node)
        if above is not None:
            above.add(node.n, node.least)
            above.leaves += leaves
            above.saved += saved

    for path, conv in members:
        shared, last = 0, len(path) // ENTRY
        while shared < min(last, len(stack) - 1) and path[ENTRY * shared : ENTRY * (shared + 1)] == stack[shared + 1].entry:
            shared += 1
        while len(stack) - 1 > shared:
            yield from close()
        for i in range(shared, last):
            entry, above = path[ENTRY * i : ENTRY * (i + 1)], stack[-1].skeleton
            stack.append(_Open(entry, None if above is None else trie.child.get((above, entry))))
        end = stack[-1]
        end.add(1, conv)
        if end.skeleton is None:
            end.ends.update(f",{conv}".encode() if end.ended else f"{conv}".encode())
            end.ended = True
        else:
            end.ends.append(str(conv))
            if len(end.ends) >= CHUNK_IDS:
                yield chunk(end)
    while stack and stack[0].n + len(stack) > 1:
        yield from close()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined ids of each skeleton node from its chunks in order; one chunk is held at a time."""
    now, digest, done = None, None, []
    for batch in batches:
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != now:
                done += [(now, digest.hexdigest())] if digest else []
                now, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    done += [(now, digest.hexdigest())] if digest else []
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int32()), pa.array([x for _, x in done], pa.string())], names=["skeleton", "ends_sha256"])


def combined(trie: Skeleton, partials: Iterable[tuple]) -> list[tuple]:
    """Skeleton nodes ``(skeleton, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)`` from their summed partials ``(skeleton, conv_id, n_convs, n_children, n_leaves, saved_tokens)``."""
    n = len(trie.parent)
    found = {p[0]: p[1:] for p in partials}
    children, leaves, size = [0] * n, [0] * n, list(trie.size)
    for i, (_, _, below, leaves_below, _) in found.items():
        children[i], leaves[i] = children[i] + below, leaves_below
        if i:
            children[trie.parent[i]] += 1
    for i in range(n - 1, 0, -1):  # a node's number is larger than its parent's
        if i in found:
            size[trie.parent[i]] += size[i]
    lone = [0] * n
    for i in range(n - 1, -1, -1):
        if i in found:
            lone[i] += not children[i]
            if i:
                lone[trie.parent[i]] += lone[i]
    return [(i, conv, trie.depth[i], found[trie.parent[i]][0] if i else None, convs, children[i], leaves[i] + lone[i], saved - size[i]) for i, (conv, convs, _, _, saved) in sorted(found.items())]


def nodes(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """One row for each node of the trie of ``conv_id, path`` (distinct ids).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``; the
    root is a node if there is any conversation, a conversation without turns is a member
    of the root alone.  An empty table has no nodes.

    The rows are written to the shared folder before and after they are dealt out, as
    both tables are read more than once.  The driver gets a sample for the splitters and
    the sums of skeleton nodes, both bounded by ``SKELETON_BYTES``.
    """
    spark = rows.sparkSession
    shards = shards or shuffle_partitions(spark)
    rows = written(rows.select("conv_id", "path"), "paths")
    trie = skeleton(rows, shards)
    shared = spark.sparkContext.broadcast(trie)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value.splitters
        for batch in batches:
            shard = [bisect_right(points, x) for x in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(1), batch.column(0)], names=["shard", "path", "conv_id"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, number = shared.value, []

        def members() -> Iterator[tuple[bytes, int]]:
            for batch in batches:
                if batch.num_rows and not number:
                    number.append(batch.column(0)[0].as_py())
                yield from zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)

        # A task holds one shard; its number is known once its first row is read.
        stream, out = members(), []
        head = next(stream, None)
        if head is None:
            return

        def whole() -> Iterator[tuple[bytes, int]]:
            yield head
            yield from stream

        for row in shard_rows(number[0], whole(), trie):
            out.append(row)
            if len(out) == BATCH_ROWS:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    dealt = rows.mapInArrow(deal, "shard int, path binary, conv_id long").repartitionById(len(trie.splitters) + 1, F.col("shard")).sortWithinPartitions("path", "conv_id")
    found = written(dealt.mapInArrow(finish, ROWS), "trie")

    partials = found.where(F.col("kind") == PARTIAL).groupBy("skeleton").agg(F.min("conv_id"), *(F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))).collect()
    top = spark.createDataFrame(combined(trie, (tuple(r) for r in partials)), "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    ends = found.where(F.col("kind") == ENDS).repartition("skeleton").sortWithinPartitions("skeleton", "shard", "seq").select("skeleton", "ends").mapInArrow(_hashed, "skeleton int, ends_sha256 string")
    upper = top.join(F.broadcast(ends), "skeleton", "left").select(*RESULT[:-1], F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    lower = found.where(F.col("kind") == NODE).select(*RESULT[:-1], F.col("ends").alias("ends_sha256"))
    parents = F.broadcast(top.select("skeleton", F.col("conv_id").alias("of_parent")))
    below = found.where(F.col("kind") == BELOW).join(parents, "skeleton").select(*(F.col("of_parent" if c == "parent_conv_id" else "ends" if c == "ends_sha256" else c).alias(c) for c in RESULT))
    return lower.union(below).union(upper)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), ROWS_ARROW.types, strict=True)], schema=ROWS_ARROW)


def prefix_trie(conversations: DataFrame, *, every: int | None = None, most: int = 1, shards: int | None = None) -> DataFrame:
    """The trie of ``conversations`` (``conv_id, turn, role, text``), see ``nodes``.

    With ``every``, conversations are rebuilt first (``with_shared_starts``).  Rows with a
    null id belong to no conversation.  Repeated rows are turns of their own.  Other columns
    are not read.  A conversation's path is one cell: 20 bytes a turn, at most 2 GB.
    """
    own = paths(conversations)
    return nodes(with_shared_starts(own, every, most) if every else own, shards)


def _crc32_sql(value: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    step = "list_reduce(list_prepend(xor(a, b), range(8)), lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({value}, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: {step}))"


def prefix_trie_sql(every: int, most: int) -> str:
    """DuckDB SQL for the rows of ``prefix_trie``."""
    return f"""
    WITH t AS (SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS entry, strlen(coalesce(text, '')) AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, entry, size) AS k FROM t),
    c AS (SELECT conv_id, conv_id - conv_id % {every} AS start, {_crc32_sql("conv_id::VARCHAR")} % {most} AS h FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (SELECT c.conv_id, 0 AS own, k, entry, size FROM c JOIN o ON o.conv_id = c.start AND k <= h UNION ALL SELECT c.conv_id, 1, k, entry, size FROM c JOIN o ON o.conv_id = c.conv_id AND k > h),
    p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(entry, '') OVER w AS path, size FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)),
    m AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM (SELECT * FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM c)),
    n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM m GROUP BY path, depth),
    k AS (SELECT path[:64 * (depth - 1)] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
    s AS (SELECT path[:64 * above] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM f) GROUP BY 1)
    SELECT f.conv_id, f.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
    FROM f JOIN s USING (path) LEFT JOIN n q ON f.depth > 0 AND q.path = f.path[:64 * (f.depth - 1)]
    """
