"""Language identification with a linear-chain conditional random field.

Each word of a text gets a label, so text that switches between languages is labelled
word by word.  A word's features are its affixes, its character n-grams (hashed) and
its entry in a lexicon of frequent training words; transitions between labels are
learned with them.  Labelling is by forward-backward; a document's language is the
label with the largest expected number of words, and its score that share of words.

Only languages of whole documents are known for training.  Training sequences are
therefore spliced from stretches of documents in different languages, which gives the
transitions something to learn from.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import per_text, unused

#: Label of a text that is null or has no letter.
UNKNOWN = "und"
#: Letters in a word; a longer run (say, of a script without spaces) is words of that many.
LONGEST_WORD = 64
_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")
#: Words whose scores a worker keeps (about 200 bytes each, 500 at most).
CACHE_WORDS = 200_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; a run without a letter proper (say, of superscripts) is none."""
    found = _WORD.findall(text.lower()) if text else []
    return found if not text or text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


#: Odd multipliers that mix code points and the kind of a feature into a hash.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def features(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, as pairs of a word's number and a bucket.

    Affixes of 1 to 3 characters, and n-grams of 2 and 3 within ``^word$``.
    """
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    starts = ends - lengths
    left = np.repeat(ends, lengths) - np.arange(len(codes))  # characters of the word from here on
    owner = np.repeat(np.arange(len(words)), lengths)

    def hashed(kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(parts[0]), kind + 1, np.uint64) * _MIX[3]
        for p, m in zip(parts, _MIX, strict=False):
            h = (h ^ p) * m
            h ^= h >> np.uint64(29)
        return (h * _MIX[0] >> np.uint64(64 - bits)).astype(np.int64)

    who, what = [], []
    for n in (2, 3):
        at = np.flatnonzero(left >= n)
        who.append(owner[at])
        what.append(hashed(n, *(codes[at + i] for i in range(n))))
    for n in (1, 2, 3):
        long = np.flatnonzero(lengths - 2 >= n)
        who += [long, long]
        what.append(hashed(3 + n, *(codes[starts[long] + 1 + i] for i in range(n))))
        what.append(hashed(6 + n, *(codes[ends[long] - 1 - n + i] for i in range(n))))
    return np.concatenate(who), np.concatenate(what)


@dataclass
class Model:
    """Weights: hashed features first, then the lexicon's words."""

    labels: tuple[str, ...]
    bits: int
    lexicon: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray
    initial: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)
    rows: list = field(default_factory=list)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}, "rows": []}

    def indices(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature indices of all words one after another, and where each word's begin."""
        who, what = features(words, self.bits)
        known = [(i, (1 << self.bits) + self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        if known:
            more = np.array(known)
            who, what = np.concatenate([who, more[:, 0]]), np.concatenate([what, more[:, 1]])
        order = np.argsort(who, kind="stable")
        return what[order], np.searchsorted(who[order], np.arange(len(words)))

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores, words by labels."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.rows.clear()
        new = list(set(words) - self.cache.keys())
        if new:
            at, starts = self.indices(new)
            self.cache.update(zip(new, range(len(self.cache), len(self.cache) + len(new)), strict=True))
            self.rows[:] = [np.concatenate([*self.rows, np.add.reduceat(self.weights[at], starts, axis=0)])]
        return self.rows[0][np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))]


def forward_backward(scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray, initial: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of a row of sequences, which begin where ``starts`` is set (at 0, too).

    Returns the marginals, and scaled forward and backward values.  All sequences are
    one chain in which a start forgets what was before it; the chain is cut into blocks
    of about the root of its length.  One pass multiplies each block's matrices for all
    blocks at once, a short loop links the blocks, and a second pass fills them in.
    """
    n, k = scores.shape
    size = max(1, int(n**0.5))
    blocks = -(-n // size)
    pad = blocks * size - n
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if n else scores
    e = np.concatenate([e, np.ones((pad, k))]).reshape(blocks, size, k)
    s = np.concatenate([starts, np.ones(pad, bool)]).reshape(blocks, size)
    t, first = np.exp(transitions), np.exp(initial - initial.max())

    def unit(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)

    # Forward: a' = (a T) * e, or first * e at a start.
    product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for j in range(size):
        moved = product @ t
        at = s[:, j]
        if at.any():
            moved[at] = product[at].sum(axis=2, keepdims=True) * first
        product = unit(moved * e[:, j, None, :])
    a = np.empty((blocks, k))
    now = np.full(k, 1 / k)
    for b in range(blocks):
        a[b] = now
        now = now @ product[b]
        now /= now.sum()
    forward = np.empty((blocks, size, k))
    for j in range(size):
        a = unit(np.where(s[:, j, None], first, a @ t) * e[:, j])
        forward[:, j] = a

    # Backward: b = T (e' * b'), or 1 where the next word is a start.
    product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for j in range(size - 1, -1, -1):
        at = s[:, j]
        moved = t @ (e[:, j, :, None] * product)
        if at.any():
            moved[at] = (first[:, None] * e[at, j][:, :, None] * product[at]).sum(axis=1, keepdims=True)
        product = unit(moved)
    b = np.empty((blocks, k))
    now = np.full(k, 1 / k)
    for i in range(blocks - 1, -1, -1):
        b[i] = now
        now = product[i] @ now
        now /= now.sum()
    backward = np.empty((blocks, size, k))
    for j in range(size - 1, -1, -1):
        backward[:, j] = b
        b = unit(np.where(s[:, j, None], 1.0, (e[:, j] * b) @ t.T))
    forward, backward = forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), forward, backward


def train(samples: list[tuple[str, str]], *, bits: int = 16, lexicon_words: int = 20_000, epochs: int = 3, batch_words: int = 10_000, stretch: int = 12, rate: float = 0.3, decay: float = 1e-5, seed: int = 7) -> Model:
    """A model from ``(text, language)`` pairs; deterministic.

    ``stretch`` is the mean number of words before a spliced sequence may switch to
    another document; ``decay`` shrinks the weights.
    """
    labels = tuple(sorted({lang for _, lang in samples}))
    number = {x: i for i, x in enumerate(labels)}
    docs = [(w, number[lang]) for text, lang in samples if (w := words_of(text))]
    frequent = Counter(x for w, _ in docs for x in w)
    lexicon = {x: i for i, (x, c) in enumerate(sorted(frequent.items(), key=lambda p: (-p[1], p[0]))[:lexicon_words]) if c >= 3}
    k = len(labels)
    model = Model(labels, bits, lexicon, np.zeros(((1 << bits) + len(lexicon), k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    vocabulary = {x: i for i, x in enumerate(frequent)}
    at, starts = model.indices(list(vocabulary))
    ends = np.append(starts[1:], len(at))
    rng = random.Random(seed)
    seen, seen_t, seen_i = np.full(model.weights.shape, 1e-2, np.float32), np.full((k, k), 1e-2), np.full(k, 1e-2)

    def sequences() -> Iterator[tuple[list[int], list[int]]]:
        """Documents of all languages, cut into stretches and spliced at random, whole or mixed."""
        queue = [(w, y) for w, y in docs]
        rng.shuffle(queue)
        open_docs = [[w, y, 0] for w, y in queue]
        while open_docs:
            group = [open_docs.pop() for _ in range(min(len(open_docs), rng.choice((1, 1, 2, 3))))]
            x, y = [], []
            while group:
                d = rng.choice(group)
                n = 1 + int(rng.expovariate(1 / stretch)) if len(group) > 1 else len(d[0])
                part = d[0][d[2] : d[2] + n]
                x += [vocabulary[w] for w in part]
                y += [d[1]] * len(part)
                d[2] += len(part)
                if d[2] >= len(d[0]):
                    group = [g for g in group if g is not d]
            yield x, y

    def step(x: list[int], y: list[int], begin: list[int]) -> None:
        word, gold, start = np.array(x), np.array(y), np.zeros(len(x), bool)
        start[begin] = True
        types, place = np.unique(word, return_inverse=True)
        lengths = ends[types] - starts[types]
        flat = at[np.repeat(starts[types], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)]
        offsets = np.cumsum(lengths) - lengths
        scores = np.add.reduceat(model.weights[flat], offsets, axis=0).astype(float)[place]
        marginal, forward, backward = forward_backward(scores, start, model.transitions, model.initial)
        error = -marginal
        error[np.arange(len(gold)), gold] += 1
        by_type = np.stack([np.bincount(place, error[:, j], len(types)) for j in range(k)], axis=1)
        grad = np.zeros_like(model.weights)
        np.add.at(grad, flat, np.repeat(by_type, lengths, axis=0).astype(np.float32))
        inner = ~start[1:]
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        pair = forward[:-1][inner][:, :, None] * np.exp(model.transitions) * (e[1:][inner] * backward[1:][inner])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        grad_t = -pair.sum(axis=0)
        np.add.at(grad_t, (gold[:-1][inner], gold[1:][inner]), 1)
        grad_i = error[start].sum(axis=0)
        for value, g, total in ((model.weights, grad, seen), (model.transitions, grad_t, seen_t), (model.initial, grad_i, seen_i)):
            g = g / len(x) - decay * value
            total += g * g
            value += (rate * g / np.sqrt(total)).astype(value.dtype)

    for _ in range(epochs):
        x, y, begin = [], [], []
        for words, gold in sequences():
            begin.append(len(x))
            x += words
            y += gold
            if len(x) >= batch_words:
                step(x, y, begin)
                x, y, begin = [], [], []
        if x:
            step(x, y, begin)
    return model


def label(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """The language and score of each text."""
    lists = [words_of(t) for t in texts]
    out = [(UNKNOWN, 0.0)] * len(texts)
    full = [i for i, w in enumerate(lists) if w]
    if full and model.labels:
        lengths = np.array([len(lists[i]) for i in full])
        offsets = np.cumsum(lengths) - lengths
        starts = np.zeros(lengths.sum(), bool)
        starts[offsets] = True
        marginal, _, _ = forward_backward(model.scores([w for i in full for w in lists[i]]).astype(float), starts, model.transitions, model.initial)
        share = np.add.reduceat(marginal, offsets, axis=0) / lengths[:, None]
        for i, best, row in zip(full, share.argmax(axis=1), share, strict=True):
            out[i] = (model.labels[best], float(min(1.0, row[best])))
    return out


def label_words(model: Model, text: str) -> list[tuple[str, str, float]]:
    """Each word of a text with its language and that label's marginal."""
    words = words_of(text)
    if not words or not model.labels:
        return []
    starts = np.zeros(len(words), bool)
    starts[0] = True
    marginal, _, _ = forward_backward(model.scores(words).astype(float), starts, model.transitions, model.initial)
    return [(w, model.labels[i], float(m[i])) for w, i, m in zip(words, marginal.argmax(axis=1), marginal, strict=True)]


def training_rows(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", per_language: int = 300, max_chars: int = 20_000, languages: int = 1000) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows: ``per_language`` at most, of ``max_chars`` at most, of the ``languages`` with most rows.

    Rows are drawn by a hash of their id at a rate that follows from the languages'
    counts, so the sample spreads over the whole table; whole texts are taken.
    """
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where("lang is not null and text is not null").where(F.length("text") <= max_chars)
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    rate = F.lit(0)
    for lang, n in sorted(counts.items()):
        rate = F.when(F.col("lang") == lang, F.lit(min(1_000_000, 1_500_000 * per_language // n + 1))).otherwise(rate)
    drawn = rows.where(place < rate).limit(3 * per_language * len(counts)).collect()
    kept: dict[str, list] = {}
    for r in sorted(drawn, key=lambda r: (zlib.crc32((r.id or "").encode()), r.id or "", r.text)):
        kept.setdefault(r.lang, []).append((r.text, r.lang))
    return [x for lang in sorted(kept) for x in kept[lang][:per_language]]


def predict(docs: DataFrame, model: Model, *, keys: tuple[str, ...] = ("doc_id",), text_column: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``keys``, the language and its score (``names``) of every row; no shuffle.

    Null text, and text without a letter, gets ``und`` and score 0.  Rows that repeat
    or have null keys each get a row; an empty table gives an empty result.  Of two
    languages with equal shares the first by name wins.  The keys may include the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by bits and lexicon_words
    kinds = dict(docs.dtypes)
    text = text_column if text_column in keys else unused("text", keys)

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = zip(*label(shared.value, part.column(text).to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*keys, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from per_text(function, text)(batches)

    rows = docs.select(*keys) if text in keys else docs.select(*keys, F.col(text_column).alias(text))
    return rows.mapInArrow(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + f"`{names[0]}` string, `{names[1]}` double")
