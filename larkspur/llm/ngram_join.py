"""N-gram Jaccard join by universe partition and the pigeonhole principle.

Two sets with a Jaccard similarity of 0.8 or more differ in at most a ninth of the sum
of their sizes.  The universe of shingle hashes is dealt into segments; if the
segments' credits exceed the number of differences, two similar sets must meet in one:
a segment with one credit is indexed as the set's subset there, one with two credits
also with its one-deletion neighbourhood.

* Sets are banded by size.  A pair belongs to the band of its smaller set, so a set is
  indexed in its own band and, if a partner can be there, in the one below.
* ``allocation`` spends the credits of a band at the least cost of keys and expected
  collisions: one-deletion neighbourhoods where sets are small, exact subsets where
  they are large.
* An empty subset earns no credit.  A set that earns too few is indexed again under
  the next seed; a pair meets under the first seed under which either earns enough.
* Keys are dealt out by hash.  Up to ``ALL_PAIRS`` sets that share a key are paired
  with one another.  Beyond, all are paired with the first alone, and the key costs its
  credits: only sets whose remaining credits no longer suffice are compared further, by
  the first set of just so many of their rarest such keys that two similar ones must
  have one in common.  Sets with the same first one are compared in blocks, across the
  components found so far, and a block gives the links of a spanning forest alone.
* Candidates are sieved by size and by parity sketches, which never lose a pair, and
  verified on the whole texts.

Equal sets are one node, so copies are never paired.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import BROADCAST_IDS, per_text, salted_join, shuffle_partitions, sub_batches, text_or_empty, written
from larkspur.llm.graph import components
from larkspur.llm.shingles import SKETCH_LONGS, identity, mix, shingle_sets, sketch

#: Similar sets have ``100 * intersection >= 80 * union``.
PART, WHOLE = 80, 100
#: Sets that share a key and are paired one with another; more are handled by components.
ALL_PAIRS = 10
#: Second documents of one first document that are verified by one task.
GROUP = 64
#: Sets, and shingles, on a side of a block in the comparison of larger groups.
BLOCK, BLOCK_SHINGLES = 500, 1_000_000
SID_BITS, KEY_BITS = 40, 40
#: Seeds after which a set that is still short of credits is indexed by its elements.
SEEDS = 60

_U = np.uint64
_SKETCH = [f"k{i}" for i in range(SKETCH_LONGS)]


def largest_partner(n: int) -> int:
    return n * WHOLE // PART


def most_differences(n: int, partner: int | None = None) -> int:
    """Between a set of ``n`` and a similar one, of ``partner`` at most: (n + l)(1 - t) / (1 + t)."""
    return (n + (largest_partner(n) if partner is None else partner)) * (WHOLE - PART) // (WHOLE + PART)


@lru_cache(maxsize=1)
def bands() -> tuple[int, ...]:
    """Smallest size of each band; smaller sets are similar to equal sets only."""
    edges = [4]
    while edges[-1] < 1 << 40:
        edges.append(ceil(edges[-1] * 1.5))
    return tuple(edges)


@lru_cache(maxsize=100)
def allocation(band: int) -> tuple[int, int]:
    """Segments with two credits (which come first) and all segments of a band.

    The cost of a choice is its number of keys, each weighted by how likely another set
    has it by chance, which falls with the number of shingles in the key.
    """
    lo, hi = bands()[band], bands()[band + 1] - 1
    need, mean = most_differences(hi) + 1, (lo + hi) / 2
    best = None
    for two in range((need + 1) // 2 + 1):
        spare = ceil(0.06 * need) + 2 if 2 * two < need else 0
        one = max(0, need + spare - 2 * two)
        c = mean / (one + two)
        cost = one * (1 + 20 * np.exp(-c)) + two * (1 + c) * (1 + 20 * np.exp(1 - c))
        if best is None or cost < best[0]:
            best = (cost, two, one + two)
        if two > 64:
            break
    return best[1], best[2]


def keys_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of sets: 64-bit keys, the set's number, and flags.

    Flags: eight bits for the spare credits plus one (0: too few), six for the seed,
    one for a key of two credits, one for the band below.
    """
    keys, owners, flags = [], [], []
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    edges = np.array(bands())
    band = np.searchsorted(edges, sizes, side="right") - 1
    for below in (0, 1):
        at = band - below
        least = -(-sizes * PART // WHOLE)
        fits = (band >= 0) & (at >= 0) & ((least < edges[np.maximum(band, 0)]) if below else True)
        for b in np.unique(at[fits]):
            members = np.flatnonzero(fits & (at == b))
            two, segments = allocation(int(b))
            partner = bands()[b + 1] - 1 if below else None
            need = np.array([most_differences(int(sizes[i]), partner) + 1 for i in members])
            for seed in range(SEEDS):
                h = np.concatenate([sets[i] for i in members])
                own = np.repeat(np.arange(len(members)), sizes[members])
                segment = ((mix(h, 1000 + int(b) * SEEDS + seed) >> _U(32)) * _U(segments) >> _U(32)).astype(np.int64)
                cell = own * segments + segment
                order = np.argsort(cell, kind="stable")
                cell, value = cell[order], mix(h, 500)[order]
                start = np.flatnonzero(np.diff(cell, prepend=-1))
                total = np.add.reduceat(value, start)
                count = np.diff(np.append(start, len(cell)))
                where = cell[start]
                double = where % segments < two
                credit = np.bincount(where // segments, np.where(double, np.minimum(count, 2), 1), len(members)).astype(np.int64)
                spare = np.clip(credit - need + 1, 0, 255)
                salt = (int(b) * SEEDS + seed) * 0x10001 + 7
                parts = [(where, total, double)]
                if two:
                    inner = np.repeat(double & (count > 1), count)
                    parts.append((cell[inner], np.repeat(total, count)[inner] - value[inner], np.ones(int(inner.sum()), bool)))
                for c, t, d in parts:
                    keys.append(mix(mix(t, salt) + (c % segments).astype(np.uint64)))
                    owners.append(members[c // segments])
                    flags.append(spare[c // segments] | seed << 8 | d.astype(np.int64) << 14 | below << 15)
                short = spare == 0
                members, need = members[short], need[short]
                if not len(members):
                    break
            if len(members):
                # A credit for each element: always enough, and the same for both of a pair.
                keys.append(mix(mix(np.concatenate([sets[i] for i in members]), (int(b) * SEEDS + SEEDS) * 0x10001 + 7)))
                owners.append(np.repeat(members, sizes[members]))
                flags.append(np.repeat(np.clip(sizes[members] - need + 1, 0, 255) | SEEDS << 8 | below << 15, sizes[members]))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint16)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(flags).astype(np.uint16)


def _packed(values: np.ndarray) -> bytes:
    """40-bit values as 32-bit and 8-bit columns."""
    return values.astype("<u4").tobytes() + (values >> _U(32)).astype("u1").tobytes()


def _unpacked(data: memoryview, n: int) -> np.ndarray:
    return np.frombuffer(data[: 4 * n], "<u4").astype(np.uint64) | np.frombuffer(data[4 * n : 5 * n], "u1").astype(np.uint64) << _U(32)


def _index(docs: DataFrame, width: int, sid_bits: int) -> DataFrame:
    """Rows ``part, blob`` of packed keys, node ids and flags; each set once for a task."""
    parts = shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for piece in sub_batches(batch, "text"):
                sets, sids = [], []
                for s in shingle_sets(piece.column("text").to_pylist(), width):
                    if len(s) >= bands()[0] and (i := (identity(s, 11), identity(s, 12))) not in seen:
                        seen.add(i)
                        sets.append(s)
                        sids.append(node_id(i[0], sid_bits))
                if not sets:
                    continue
                key, owner, flag = keys_of(sets)
                sid = np.array(sids, np.uint64)[owner]
                part = ((key >> _U(32)) * _U(parts) >> _U(32)).astype(np.uint32)
                order = np.argsort(part, kind="stable")
                key, sid, flag = key[order] & _U((1 << KEY_BITS) - 1), sid[order], flag[order]
                number, first = np.unique(part[order], return_index=True)
                blobs = [_packed(key[a:b]) + _packed(sid[a:b]) + flag[a:b].tobytes() for a, b in zip(first, [*first[1:], len(key)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "blob"])

    return docs.select(text_or_empty("text").alias("text")).mapInArrow(run, "part int, blob binary").repartitionById(parts, "part")


def node_id(found: int, bits: int) -> int:
    """Part of a set's identity, for the keys; sets that share it are told apart when verified."""
    return found & (1 << bits) - 1


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _meetings(index: DataFrame, all_pairs: int = ALL_PAIRS) -> DataFrame:
    """What shares a key: pairs (``key`` null), and memberships in keys of many sets
    (``b`` null) with the key's first set and its number of sets.

    A task holds its share of the keys, 12 bytes for each key of a set:
    ``spark.sql.shuffle.partitions`` bounds it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sids, flags, part = [], [], [], 0
        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
                part, data = p, memoryview(blob.as_buffer())
                n = len(data) // 12
                keys.append(_unpacked(data, n))
                sids.append(_unpacked(data[5 * n :], n))
                flags.append(np.frombuffer(data[10 * n :], "<u2"))
        if not keys:
            return
        key, sid, flag = np.concatenate(keys), np.concatenate(sids), np.concatenate(flags)
        keys, sids, flags = [], [], []
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order], prepend=key[order[0]] + _U(1)) == 0
        shared = same.copy()
        shared[:-1] |= same[1:]  # in a group of two at least
        order = order[shared]
        order = order[np.lexsort((sid[order], key[order]))]
        key, sid, flag = key[order], sid[order], flag[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, sid, flag = key[new], sid[new], flag[new]
        start = np.flatnonzero(np.diff(key, prepend=key[0] + _U(1))) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.append(start, len(key)))
        large = np.repeat(count > all_pairs, count)
        group = np.repeat(np.arange(len(start)), count)
        firsts, seconds = [], []
        for d in range(1, all_pairs):
            at = np.flatnonzero((group[d:] == group[:-d]) & ~large[d:])
            firsts.append(sid[at])
            seconds.append(sid[at + d])
        star = np.flatnonzero(large & (np.arange(len(key)) != np.repeat(start, count)))
        firsts.append(sid[start[group[star]]])
        seconds.append(sid[star])
        a, b = _unique_pairs(np.concatenate(firsts), np.concatenate(seconds))
        a, b = a.astype(np.int64), b.astype(np.int64)
        step, names = 100_000, ["a", "b", "key", "flags", "first", "size"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

        def emit(columns: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
            n = next(len(c) for c in columns if c is not None)
            for i in range(0, n, step):
                size = len(range(i, min(i + step, n)))
                yield pa.RecordBatch.from_arrays([pa.nulls(size, k) if c is None else pa.array(c[i : i + step], k) for c, k in zip(columns, kinds, strict=True)], names=names)

        yield from emit([a, b, None, None, None, None])
        k = (key[large] | _U(part) << _U(KEY_BITS)).astype(np.int64)
        first = np.repeat(sid[start], count)[large].astype(np.int64)
        yield from emit([sid[large].astype(np.int64), None, k, flag[large].astype(np.int32), first, np.repeat(count, count)[large]])

    return index.mapInArrow(run, "a long, b long, key long, flags int, first long, size long")


def _sieved(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of node ids as pairs of documents that may be similar."""
    side = lambda x: nodes.select(*(F.col(c).alias(f"{x}_{c}") for c in ("sid", "rep", "n", *_SKETCH)))
    both = pairs.join(side("a"), F.col("a") == F.col("a_sid")).join(side("b"), F.col("b") == F.col("b_sid"))
    apart = sum((F.bit_count(F.col(f"a_{k}").bitwiseXOR(F.col(f"b_{k}"))) for k in _SKETCH), F.lit(0))
    near = (F.col("a_n") + F.col("b_n")) * (WHOLE - PART) / F.lit(WHOLE + PART)
    fit = F.least("a_n", "b_n") * WHOLE >= F.greatest("a_n", "b_n") * PART
    return both.where(fit & (apart <= near) & (F.col("a_rep") != F.col("b_rep"))).select("a_rep", "b_rep", "a_sid", "b_sid").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, width: int, sid_bits: int) -> DataFrame:
    """``a, b`` of the pairs whose whole texts are similar.

    The second documents of a first one are cut into groups of about ``GROUP``.  Each
    text goes, packed, to the groups that need it, the first document's to all of its
    groups, and is met there one after another.
    """
    spark = docs.sparkSession
    sizes = pairs.groupBy("a_rep", "a_sid").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    grouped = pairs.join(sizes, ["a_rep", "a_sid"]).withColumn("grp", F.xxhash64("a_rep", "a_sid", F.pmod(F.xxhash64("b_rep"), F.col("groups"))))
    firsts = grouped.select("grp", F.lit(0).alias("role"), F.col("a_rep").alias("doc_id"), F.col("a_sid").alias("sid")).distinct()
    wanted = written(firsts.union(grouped.select("grp", F.lit(1), "b_rep", "b_sid")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, []  # documents with the first one's id and node; several only where an id repeats
        for batch in batches:
            out: list[tuple[int, int]] = []
            cols = [batch.column(c).to_pylist() for c in ("grp", "role", "doc_id", "sid")]
            for i, (grp, role, doc, sid) in enumerate(zip(*cols, strict=True)):
                if grp != group:
                    group, first = grp, []
                found = _set_of(batch.column("packed")[i], width)
                if node_id(identity(found, 11), sid_bits) != sid:
                    continue
                if role == 0:
                    first.append((doc, found))
                    continue
                for a, own in first:
                    common = len(np.intersect1d(own, found, assume_unique=True))
                    if WHOLE * common >= PART * (len(own) + len(found) - common):
                        out.append((a, doc))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    packed = _with_texts(wanted, docs).select("grp", "role", "doc_id", "sid", "packed")
    met = packed.repartition(shuffle_partitions(spark), "grp").sortWithinPartitions("grp", "role")
    return written(met.mapInArrow(run, "a long, b long").distinct(), "links")


def _with_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` (a written table) with the texts of its ``doc_id``, ``packed`` once each."""

    def pack(piece: pa.RecordBatch) -> pa.RecordBatch:
        packed = [zlib.compress((t or "").encode(), 1) for t in piece.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    few = wanted.count() <= BROADCAST_IDS
    ids = wanted.select("doc_id").distinct()
    texts = docs.where("doc_id is not null").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    texts = texts.select("doc_id", "text").mapInArrow(per_text(pack, "text"), "doc_id long, packed binary")
    return texts.join(F.broadcast(wanted) if few else wanted, "doc_id")


def _set_of(packed: pa.Scalar, width: int) -> np.ndarray:
    return shingle_sets([zlib.decompress(packed.as_buffer()).decode()], width)[0]


def _unsettled(meetings: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pair, own, other, doc_id, s1, component, n``: sets whose similar ones their keys of few sets may miss, in blocks.

    ``nodes`` has the components so far.  Two similar sets share keys that are worth the
    credits which either can spare; so, in one order of all keys, the first key that they
    share is no further down a set's list of keys of many sets than the credits that the
    list has in excess of these.  A set is listed under the first set of each such key.
    Lists that hold one component alone are settled.  A list falls into blocks; a pair of
    blocks holds at most ``BLOCK`` sets and ``BLOCK_SHINGLES`` shingles (or one set) of
    each, about.
    """
    flags = F.col("flags")
    many = meetings.where("key is not null").select("key", F.col("a").alias("sid"), "first", "size", flags.bitwiseAND(0xFF).alias("spare"), F.shiftright(flags, 8).bitwiseAND(0xBF).alias("tag"), (F.shiftright(flags, 14).bitwiseAND(1) + 1).alias("credits"))
    own = Window.partitionBy("sid", "tag")
    before = F.sum("credits").over(own.orderBy("size", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("credits")
    excess = F.sum("credits").over(own) - F.min("spare").over(own)
    lists = many.withColumn("before", before).withColumn("excess", excess).where("before <= excess").select("first", "sid").distinct()
    rows = written(lists.join(nodes, "sid").select("first", F.col("rep").alias("doc_id"), "s1", "component", "n"), "unsettled")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = written(rows.groupBy("first").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.alias("blocks")).where("lo < hi").select("first", "blocks"), "mixed")
    rows = rows.join(F.broadcast(mixed), "first") if mixed.count() <= BROADCAST_IDS else salted_join(rows, mixed, ["first"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id", "s1"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("first", F.least("own", "other"), F.greatest("own", "other")).alias("pair")
    return written(rows.select(pair, "own", "other", "doc_id", "s1", "component", "n"), "blocks")


def _forest(sets: list[np.ndarray], ids: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of ``left`` and of ``right`` that join all components which any such link joins: a spanning forest."""
    out = []
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    bits = np.stack([sketch(s) for s in sets]).view(np.uint64)
    component = component.copy()
    for i in np.flatnonzero(left):
        j = np.flatnonzero(right & (component != component[i]))
        j = j[np.minimum(size[j], size[i]) * WHOLE >= np.maximum(size[j], size[i]) * PART]
        apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1)
        fit = apart * (WHOLE + PART) <= (size[j] + size[i]) * (WHOLE - PART)
        for k in j[fit][np.argsort(apart[fit], kind="stable")].tolist():
            if component[k] == component[i]:
                continue
            common = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if WHOLE * common >= PART * (int(size[i] + size[k]) - common):
                out.append((int(ids[i]), int(ids[k])))
                component[component == component[k]] = component[i]
    return out


def _linked_in_blocks(blocks: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``a, b``: for each pair of blocks the links of a spanning forest over its components, by whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            doc, component, own, other, sets = zip(*held, strict=True)
            held.clear()
            own, other = np.array(own), np.array(other)
            found = _forest(list(sets), np.array(doc), np.array(component), own <= other, own >= other)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("pair", "doc_id", "s1", "component", "own", "other")]
            for i, (pair, doc, s1, component, own, other) in enumerate(zip(*cols, strict=True)):
                if pair != now:
                    if held:
                        yield done()
                    now = pair
                found = _set_of(batch.column("packed")[i], width)
                if identity(found, 11) == s1:
                    held.append((doc, component, own, other, found))
        if held:
            yield done()

    rows = _with_texts(blocks, docs).select("pair", "own", "other", "doc_id", "s1", "component", "packed")
    rows = rows.repartition(shuffle_partitions(docs.sparkSession), "pair").sortWithinPartitions("pair")
    return rows.mapInArrow(run, "a long, b long")


def similar_components(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = 5, all_pairs: int = ALL_PAIRS, sid_bits: int = SID_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of 0.8 or more; the component is the smallest id that links lead to.
    Null or wordless text has the empty set, which links with nothing.  A row without an
    id has its size, links with nothing and has no component.  Rows that share an id
    are each compared; the component of the id's rows is by their own texts.  An empty
    table gives an empty result.  Other columns are not read.  ``sid_bits`` (40 at most)
    only decides how often different sets share a number, never the result.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def sized(piece: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(piece.column("text").to_pylist(), width)
        n = pa.array([len(s) for s in sets], pa.int64())
        both = [pa.array([identity(s, salt) for s in sets], pa.int64()) for salt in (11, 12)]
        bits = np.stack([sketch(s) for s in sets])
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), n, *both, *(pa.array(bits[:, i]) for i in range(SKETCH_LONGS))], names=["doc_id", "n", "s1", "s2", *_SKETCH])

    rows = docs.mapInArrow(per_text(sized, "text"), "doc_id long, n long, s1 long, s2 long, " + ", ".join(f"{k} long" for k in _SKETCH))
    rows = written(rows, "sets")
    known = rows.where("doc_id is not null and n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), *(F.first(k).alias(k) for k in _SKETCH))
    nodes = written(known.withColumn("sid", F.col("s1").bitwiseAND((1 << sid_bits) - 1)), "nodes")

    meetings = written(_meetings(_index(docs, width, sid_bits), all_pairs), "meetings")
    pairs = written(_sieved(meetings.where("key is null").select("a", "b").distinct(), nodes), "pairs")

    def with_component(links: DataFrame) -> DataFrame:
        found = components(links)
        return nodes.join(found, nodes["rep"] == found["node"], "left").withColumn("component", F.coalesce("component", "rep")).drop("node")

    # One pair for each second document joins nearly all that belong together; the
    # others are verified only where they would still join components.
    some = pairs.groupBy("b_rep", "b_sid").agg(F.min(F.struct("a_sid", "a_rep")).alias("a")).select("a.a_rep", "b_rep", "a.a_sid", "b_sid")
    links = _verified(some, docs, width, sid_bits)
    settled = written(with_component(links), "settled")
    component = lambda x: settled.select(F.col("rep").alias(f"{x}_rep"), F.col("component").alias(f"{x}_component"))
    rest = pairs.join(component("a"), "a_rep").join(component("b"), "b_rep").where("a_component != b_component").select("a_rep", "b_rep", "a_sid", "b_sid")
    rest, blocks = written(rest, "rest"), _unsettled(meetings, settled)
    more = [] if rest.isEmpty() else [_verified(rest, docs, width, sid_bits)]
    if not blocks.isEmpty():
        more.append(written(_linked_in_blocks(blocks, docs, width).distinct(), "block_links"))
    if more:
        settled = with_component(reduce(DataFrame.union, more, links))
    settled = written(settled.select("s1", "s2", "component"), "components")
    out = rows.select("doc_id", "n", "s1", "s2").join(settled, ["s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
