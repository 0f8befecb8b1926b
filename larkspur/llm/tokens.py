"""Encoding of whole texts with a tokenizer file, through a cache of words.

The tokenizers that are used here drop white space and never join characters across
it, so the ids of a text are the ids of its white-space-separated chunks one after the
other.  Chunks repeat far more often than texts, so each worker encodes a chunk once
and keeps its ids in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

#: Chunks in each of the two generations that a worker keeps, of about 250 bytes each,
#: and the characters and bytes of ids in them; a longer chunk is not kept.
CACHE_CHUNKS, CACHE_BYTES, LONGEST_KEPT = 250_000, 32_000_000, 200
#: Chunks between two looks at the cache's size.
STEP = 20_000

#: Letters of one code point in either case and in NFC, with marks (no apostrophe) around them.
_PLAIN = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: ``str.split`` takes these for white space, the tokenizers' ``\s`` does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Chunks that tell whether the library does what ``_core`` and ``ids_of`` do.
PROBES = ("straße", "Straße", "ÉCOLE", "Naïve", "word", "WORD", "(word)", "--Word!?", "[ÀÿØ];", "un+happily.", "x", "$Q=")


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary spells the letters of ``_PLAIN`` beyond ASCII.

    Bytes that print in Latin-1 stand for themselves, the others follow from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    spelt = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class _Generation(dict):
    """Ids by chunk; what it lacks it asks of its owner."""

    def __init__(self, owner: WordTokenizer) -> None:
        super().__init__()
        self.owner, self.held = owner, 0

    def __missing__(self, chunk: str) -> bytes:
        found = self.owner.ids_of(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = found
            self.held += len(chunk) + len(found)
        return found


class WordTokenizer:
    """Ids of texts as little-endian unsigned integers of ``dtype``.

    The cache has two generations: when the younger is full it becomes the older one,
    from which what occurs again is taken over.

    White space must not matter to the tokenizer but as a separator
    (``tests/llm/test_tokens.py`` compares with the library's own ids of whole texts).
    """

    def __init__(self, path: str, end_id: int | None = 1, cache_chunks: int = CACHE_CHUNKS) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.end = b"" if end_id is None else self._packed([end_id])
        self.younger, self.older = _Generation(self), {}
        self.cache_chunks = cache_chunks
        self.letters = _byte_letters()
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        # Straight to the merges only where that is the whole of what the library does.
        self.direct = True
        self.direct = all(self.ids_of(x) == self._whole(x) for x in PROBES)
        self.younger, self.older = _Generation(self), {}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _core(self, core: str) -> bytes:
        """Ids of lower-case letters; a chunk of its own in the cache."""
        found = self.younger.get(core) or self.older.get(core)
        if found is None:
            spelt = core if core.isascii() else core.translate(self.letters)
            found = self._packed([x.id for x in self.library.model.tokenize(spelt)])
            if len(core) <= LONGEST_KEPT:
                self.younger[core] = found
                self.younger.held += len(core) + len(found)
        return found

    def ids_of(self, chunk: str) -> bytes:
        """The ids of a chunk that the younger generation lacks."""
        found = self.older.get(chunk)
        if found is None:
            plain = _PLAIN.fullmatch(chunk) if self.direct else None
            if plain is None or any(x in chunk for x in self.added):
                return self._whole(chunk)
            before, core, after = plain.groups()
            found = self._core(core.lower())
            if before:
                found = self.younger[before] + found
            if after:
                found += self.younger[after]
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text with the end id; a null text counts as empty."""
        return [(self._whole(t) if _ODD_SPACE.search(t) else self._joined(t.split())) + self.end for t in (t or "" for t in texts)]

    def _joined(self, chunks: list[str]) -> bytes:
        out = []
        for i in range(0, len(chunks), STEP):
            if len(self.younger) > self.cache_chunks or self.younger.held > CACHE_BYTES:
                self.younger, self.older = _Generation(self), self.younger
            out.append(b"".join(map(self.younger.__getitem__, chunks[i : i + STEP])))
        return b"".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str, end_id: int | None = 1) -> WordTokenizer:
    """One per worker process and file."""
    return WordTokenizer(path, end_id)
