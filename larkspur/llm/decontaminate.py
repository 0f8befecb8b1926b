"""Benchmark decontamination: edit-distance search by CGK embedding and bit sampling.

Items and documents are sequences of words.  The CGK embedding walks over a sequence
and writes out the word it stands on, three steps for each word; a random bit, which
depends on the step and the word, says whether it moves on.  Sequences that few edits
separate walk in step again soon, so edit distance becomes Hamming distance.  Each
repetition draws a walk and a few samples of its steps; a window is a candidate for an
item when all words of a sample agree.  The number of repetitions follows from the target
recall, by embedding edited copies of the items themselves: repetitions are added until
the copies of each kind of edit are found, and then must find fresh copies, too.  Where
they can't, each window is a candidate for each item.  Candidates are verified by the
exact edit distance.

Windows are as long as the items, and begin at every word.  Before they are embedded, a
count filter drops those that can't be near any item: each edit breaks three word
triples at most and may shift one out at the window's end, so a window needs all but
four times as many triples that occur in the benchmark.  Windows end with their text, so
what is found in a text doesn't depend on the texts around it.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import per_text
from larkspur.llm.shingles import mix

_WORD = re.compile(r"\w+")
_U = np.uint64
#: Binary logarithm of the buckets of word triples in the count filter.
TRIPLE_BITS = 20
#: Words of items that one pass over the documents carries; more items take more passes.
PASS_WORDS = 2_000_000


@dataclass(frozen=True)
class Options:
    """``edit_rate``: edits for each word of an item.  ``recall``: of windows at that many
    edits, of any one kind.  ``sampled``: steps in a key.  ``draws``: keys of a walk.  ``most_repeats``: where more
    would be needed, all windows that pass the count filter are verified.
    ``least_words``: shorter items match nothing."""

    edit_rate: float = 0.15
    recall: float = 0.95
    sampled: int = 3
    draws: int = 8
    most_repeats: int = 200
    least_words: int = 1
    seed: int = 5


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def walk(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, wanted: np.ndarray) -> np.ndarray:
    """The words, 0 beyond the end, that stand at the ``wanted`` steps of each window's embedding."""
    at, out, slot = starts.copy(), np.zeros((len(starts), len(wanted)), np.int64), {int(s): i for i, s in enumerate(wanted)}
    for step in range(int(wanted.max()) + 1 if len(wanted) else 0):
        inside = at < ends
        word = np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0)
        if step in slot:
            out[:, slot[step]] = word
        at += inside & ((mix(word.astype(np.uint64), seed * 4096 + step) >> _U(63)).astype(bool))
    return out


def edit_distance_within(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of ``item`` to any stretch of ``text``, and the (first) end of such a stretch.

    Bit-parallel: one step for each word of the text (Myers, 1999).
    """
    n = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full, top = (1 << n) - 1, 1 << n - 1
    pv, mv, score, best = full, 0, n, (n, 0)
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        xv = eq | mv
        xh = ((eq & pv) + pv ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best[0]:
            best = (score, j + 1)
    return best


class ItemIndex:
    """What a pass needs of its items; its size is bounded by ``PASS_WORDS``."""

    def __init__(self, items: list[tuple[int, str]], options: Options) -> None:
        self.options = options
        texts = [(i, w) for i, t in items if len(w := words_of(t)) >= options.least_words]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({x for _, w in texts for x in w}))}
        self.items = [(i, [self.vocabulary[x] for x in w]) for i, w in texts]
        self.edits = [int(options.edit_rate * len(w)) for _, w in self.items]
        self.triples = np.zeros(1 << TRIPLE_BITS, bool)
        for _, w in self.items:
            self.triples[self._triple(np.array(w))] = True
        # Items of similar length share their windows and their keys.
        classes: dict[int, list[int]] = defaultdict(list)
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(ceil(edges[-1] * 1.15))
        for n, (_, w) in enumerate(self.items):
            classes[int(np.searchsorted(edges, len(w), side="right"))].append(n)
        self.classes = []
        for members in classes.values():
            lengths = [len(self.items[n][1]) for n in members]
            least, edits = min(lengths), max(self.edits[n] for n in members)
            self.classes.append((least, least - 2 - 4 * edits, self._keys(members, least), members))

    @staticmethod
    def _triple(w: np.ndarray) -> np.ndarray:
        """The bucket of the triple that begins at each place but the last two."""
        w = w.astype(np.uint64)
        return (mix(w[:-2] << _U(42) | w[1:-1] << _U(21) | w[2:], 3) >> _U(64 - TRIPLE_BITS)).astype(np.int64)

    @staticmethod
    def _hashed(keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.uint64)
        for column in keys.T:
            out = mix(out ^ column.astype(np.uint64), 9)
        return out

    def _embedded(self, rows: list[list[int]], seed: int, wanted: np.ndarray) -> np.ndarray:
        ends = np.cumsum([len(r) for r in rows])
        flat = np.array([x for r in rows for x in r], np.int64)
        return walk(flat, ends - [len(r) for r in rows], ends, seed, wanted)

    def _copies(self, rng: random.Random, members: list[int], least: int, count: int = 200) -> list[tuple[int, list[int]]]:
        """``count`` copies for each way to edit: an item's number and its first ``least`` words after its greatest number of edits.

        Words are replaced, inserted or removed, or all of it; other words follow, or
        the text ends.
        """
        out = []
        for ways, follow in (("r", True), ("i", True), ("d", True), ("d", False), ("rid", True)):
            for n in rng.choices(members, k=count):
                w = list(self.items[n][1])
                for _ in range(self.edits[n]):
                    at, way = rng.randrange(len(w)), rng.choice(ways)
                    w[at : at + (way != "i")] = [] if way == "d" else [-rng.randrange(1, 1 << 40)]
                out.append((n, [*w, *(-rng.randrange(1, 1 << 40) for _ in range(least if follow else 0))][:least]))
        return out

    def _keys(self, members: list[int], least: int) -> list | None:
        """Repetitions of a class, each a walk's seed and steps, and for each sample of these its places and the items by key; None if no number of them has the recall.

        A window is cut at the shortest item's length, and so are the items.
        """
        o, rng = self.options, random.Random(self.options.seed)
        rows, row_of = [self.items[n][1][:least] for n in members], {n: i for i, n in enumerate(members)}
        found: list[tuple] = []
        embedded: list[np.ndarray] = []

        def caught(copies: list[tuple[int, list[int]]], first: int) -> np.ndarray:
            """Which of the copies the repetitions from ``first`` on find."""
            hit = np.zeros(len(copies), bool)
            item = np.array([row_of[n] for n, _ in copies])
            for (seed, steps, draws), own in zip(found[first:], embedded[first:], strict=True):
                same = own[item] == self._embedded([w for _, w in copies], seed, steps)
                for at, _, _ in draws:
                    hit |= same[:, at].all(axis=1)
            return hit

        def enough(hit: np.ndarray) -> bool:
            return bool(found) and hit.reshape(5, -1).mean(axis=1).min() >= o.recall

        while True:
            copies = self._copies(rng, members, least)
            hit = caught(copies, 0)
            if enough(hit):  # fresh copies, which had no say in the number
                return found
            while not enough(hit):
                if len(found) == o.most_repeats:
                    return None
                seed = len(found)
                # The walk stands within the window for twice its words of steps, mostly.
                wanted = [sorted(rng.sample(range(2 * least), min(o.sampled, 2 * least))) for _ in range(o.draws)]
                steps = np.unique(np.array(wanted))
                own = self._embedded(rows, seed, steps)
                draws = []
                for w in wanted:
                    at = np.searchsorted(steps, w)
                    table: dict[int, list[int]] = defaultdict(list)
                    for n, k in zip(members, self._hashed(own[:, at]).tolist(), strict=True):
                        table[k].append(n)
                    draws.append((at, dict(table), np.array(sorted(table), np.uint64)))
                found.append((seed, steps, draws))
                embedded.append(own)
                hit |= caught(copies, seed)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """``(text, item, distance, item's words, start, end)`` of the best stretch of each text and item, in code points."""
        get = self.vocabulary.get
        lists, lengths = [], []
        for t in texts:
            words = words_of(t)
            words.append("")  # no word of an item
            lists.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            lengths.append(len(words))
        ids = np.concatenate(lists)
        ends = np.cumsum(lengths)
        # A triple over a text's end holds a 0, which no triple of an item does.
        known = ids > 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:])
        total = np.zeros(len(ids) + 1, np.int32)
        if len(at):
            triple = mix(ids[at].astype(np.uint64) << _U(42) | ids[at + 1].astype(np.uint64) << _U(21) | ids[at + 2].astype(np.uint64), 3) >> _U(64 - TRIPLE_BITS)
            total[at + 1] = self.triples[triple.astype(np.int64)]
        total = np.cumsum(total, dtype=np.int32)
        near: dict[tuple[int, int], set[int]] = defaultdict(set)  # windows by text and item
        last = np.repeat(ends - 1, lengths)  # the end of the text at each place
        for least, threshold, repeats, members in self.classes:
            # Triples that lie within the window of ``least`` words from each place on.
            inner = max(least - 2, 0)
            starts = np.flatnonzero(np.append(total[inner:-1], np.full(inner, total[-1]))[: len(ids)] - total[:-1] >= threshold)
            starts = starts[(starts < last[starts]) & (total[np.minimum(starts + inner, last[starts])] - total[starts] >= threshold)]
            if not len(starts):
                continue
            text = np.searchsorted(ends, starts, side="right")
            if repeats is None:
                for start, t in zip(starts.tolist(), text.tolist(), strict=True):
                    for n in members:
                        near[t, n].add(start)
                continue
            limit = np.minimum(starts + least, last[starts])
            for seed, steps, draws in repeats:
                words = walk(ids, starts, limit, seed, steps)
                for at, table, sorted_keys in draws:
                    keys = self._hashed(words[:, at])
                    at_most = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
                    for row in np.flatnonzero(sorted_keys[at_most] == keys).tolist():
                        for n in table[int(keys[row])]:
                            near[int(text[row]), n].add(int(starts[row]))
        out = []
        for (text, n), places in sorted(near.items()):
            if (found := self._verified(n, sorted(places), text, ids, ends)) is None:
                continue
            distance, a, b = found
            first = int(ends[text]) - lengths[text]
            whole = texts[text]
            places = [m.span() for m in _WORD.finditer(whole)] if len(whole.lower()) == len(whole) else []
            spans = places if len(places) == lengths[text] - 1 else [(0, len(whole))] * lengths[text]
            out.append((text, self.items[n][0], distance, len(self.items[n][1]), spans[a - first][0], spans[b - 1 - first][1]))
        return out

    def _verified(self, n: int, starts: list[int], text: int, ids: np.ndarray, ends: np.ndarray) -> tuple[int, int, int] | None:
        """The distance and the stretch nearest to an item around the windows at ``starts``, if it is near enough.

        Windows that overlap are one region, which is read once.
        """
        item, edits = self.items[n][1], self.edits[n]
        first, last = int(ends[text - 1]) if text else 0, int(ends[text]) - 1
        best, at = None, 0
        while at < len(starts):
            upto = at
            while upto + 1 < len(starts) and starts[upto + 1] <= starts[upto] + len(item):
                upto += 1
            lo, hi = max(starts[at] - edits, first), min(starts[upto] + len(item) + 2 * edits, last)
            at = upto + 1
            # Words outside the benchmark differ from all of an item's.
            region = ids[lo:hi].tolist()
            distance, end = edit_distance_within(item, region)
            if distance <= edits and (best is None or distance < best[0]):
                _, back = edit_distance_within(item[::-1], region[:end][::-1])
                best = (distance, lo + end - back, lo + end)
        return best


def find_leaks(docs: DataFrame, items: DataFrame, *, options: Options = Options(), id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:  # noqa: B008
    """``doc_id, item_id, distance, item_words, start, end`` of each document and item that it holds.

    ``start`` and ``end`` bound the nearest stretch in code points of the document (the
    whole text where lower-casing changes its length).  Null or wordless texts match
    nothing, on either side, nor do items of fewer than ``least_words`` words or without
    an id; items too short for an edit match where they occur.  Rows that repeat give rows that repeat; equal items each match.  Other
    columns are not read.  The documents are not shuffled; the items are taken in
    passes of a bounded number of words.
    """
    items = items.where(F.col(item_column).isNotNull()).select(F.col(item_column).cast("long").alias("item"), F.coalesce(item_text, F.lit("")).alias("text"))
    # A word and the gap behind it take two characters at least.
    passes = 1 + int((items.agg(F.sum(F.length("text"))).first()[0] or 0) // (2 * PASS_WORDS))
    out = None
    for p in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p).distinct().collect()
        found = _pass(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")), ItemIndex(sorted((r.item, r.text) for r in rows), options))
        out = found if out is None else out.union(found)
    return out


def _pass(docs: DataFrame, index: ItemIndex) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    names = ["item_id", "distance", "item_words", "start", "end"]

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.search(part.column("text").to_pylist())
        doc = part.column("doc_id").take(pa.array([r[0] for r in found], pa.int64()))
        kinds = [pa.int64(), *[pa.int32()] * 4]
        return pa.RecordBatch.from_arrays([doc, *(pa.array([r[i + 1] for r in found], k) for i, k in enumerate(kinds))], names=["doc_id", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from per_text(function, "text")(batches)

    return docs.mapInArrow(run, "doc_id long, item_id long, distance int, item_words int, start int, end int")
