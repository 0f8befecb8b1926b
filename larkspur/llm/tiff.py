"""Media columns: TIFF files in a binary column.

``read_tiff`` walks the chain of image directories, joins strips or tiles, decodes
PackBits, LZW or deflate, undoes the horizontal predictor, and yields one page for each
directory.  ``write_tiff`` stores bytes losslessly as pages of 8-bit grey samples.
Both bound their memory by one file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import per_text

#: Fixed values of the format: tags, compression schemes, sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES = 284, 317, 322, 323, 324, 325
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
FIELD_CODE = {1: "B", 3: "H", 4: "I"}
#: Bytes that a stored byte can stand for: 258 by two bits in deflate, 3838 by twelve in LZW, 128 by two bytes.
MOST_BYTES = {NONE: 1, DEFLATE: 1032, OLD_DEFLATE: 1032, LZW: 2559, PACKBITS: 64}


class TiffError(ValueError):
    """The bytes are no TIFF file that can be decoded."""


@dataclass(frozen=True)
class Page:
    number: int
    compression: int
    predictor: int
    pixels: np.ndarray  # height x width x samples


def packbits_decode(data: bytes, need: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < need:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def packbits_encode(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        run = i + 1
        while run < len(data) and run - i < 128 and data[run] == data[i]:
            run += 1
        if run - i > 1:
            out += bytes((257 - (run - i), data[i]))
            i = run
            continue
        end = i + 1
        while end < len(data) and end - i < 128 and not (end + 1 < len(data) and data[end] == data[end + 1]):
            end += 1
        out.append(end - i - 1)
        out += data[i:end]
        i = end
    return bytes(out)


def lzw_decode(data: bytes, need: int) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code early."""
    out, table, width, hold, bits, last = bytearray(), [], 9, 0, 0, b""
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    for byte in data:
        hold, bits = (hold << 8 | byte) & 0xFFFFFFFF, bits + 8
        if bits < width:
            continue
        if len(out) >= need:
            break
        bits -= width
        code = hold >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(first), 9, b""
            continue
        if not table:
            raise TiffError("LZW data without a clear code")
        if not last:
            word = table[code]
        elif code < len(table):
            word = table[code]
            table.append(last + word[:1])
        elif code == len(table):
            word = last + last[:1]
            table.append(word)
        else:
            raise TiffError("LZW code beyond the table")
        out += word
        last = word
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    out, hold, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width, following = 9, 258

    def put(code: int) -> None:
        nonlocal hold, bits
        hold, bits = hold << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(hold >> bits & 0xFF)
        hold &= (1 << bits) - 1

    def clear() -> None:
        nonlocal table, width, following
        put(256)
        table, width, following = {bytes((i,)): i for i in range(256)}, 9, 258

    clear()
    word = b""
    for byte in data:
        longer = word + bytes((byte,))
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = following
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
        if following == 4094:
            clear()
        word = bytes((byte,))
    if word:
        put(table[word])
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if bits:
        out.append(hold << 8 - bits & 0xFF)
    return bytes(out)


def _decoded(data: bytes, scheme: int, need: int) -> bytes:
    """The first ``need`` bytes, and no more than a code's beyond: a small file can't fill the memory."""
    if scheme == NONE:
        return data
    if scheme in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, need)
        except zlib.error as e:
            raise TiffError(str(e)) from None
    if scheme == PACKBITS:
        return packbits_decode(data, need)
    if scheme == LZW:
        return lzw_decode(data, need)
    raise TiffError(f"compression {scheme}")


def _encoded(data: bytes, scheme: int) -> bytes:
    return {NONE: bytes, DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: packbits_encode, LZW: lzw_encode}[scheme](data)


def _fields(data: bytes, at: int, order: str) -> tuple[dict[int, tuple], int]:
    """The whole-number fields of the directory at ``at``, and where the next one is."""
    (n,) = struct.unpack_from(f"{order}H", data, at)
    found = {}
    for i in range(n):
        entry = at + 2 + 12 * i
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, entry)
        if kind in FIELD_CODE:
            size = FIELD_BYTES[kind] * count
            (place,) = (entry + 8,) if size <= 4 else struct.unpack_from(f"{order}I", data, entry + 8)
            found[tag] = struct.unpack_from(f"{order}{count}{FIELD_CODE[kind]}", data, place)
    return found, struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)[0]


def _block(data: bytes, at: int, size: int, shape: tuple[int, int, int], scheme: int, predictor: int, depth: np.dtype) -> np.ndarray:
    need = shape[0] * shape[1] * shape[2] * depth.itemsize
    raw = _decoded(data[at : at + size], scheme, need)
    if len(raw) < need:
        raise TiffError("a strip or tile is too short")
    block = np.frombuffer(raw, depth, shape[0] * shape[1] * shape[2]).reshape(shape)
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=depth.newbyteorder("="))
    if predictor != 1:
        raise TiffError(f"predictor {predictor}")
    return block


def read_tiff(data: bytes) -> Iterator[Page]:
    """The pages of a file, in the order of their directories.

    Chunky samples of 8 or 16 bits, either byte order.  Raises ``TiffError`` where the
    bytes end early, strips or tiles don't cover a page, a page is larger than its data
    can make it, the directories run in a circle, or a feature isn't supported.
    """
    try:
        order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
        if order is None:
            raise TiffError("no TIFF header")
        (at,) = struct.unpack_from(f"{order}I", data, 4)
        seen: set[int] = set()
        while at:
            if at in seen:
                raise TiffError("the directories run in a circle")
            seen.add(at)
            f, following = _fields(data, at, order)
            (width,), (height,) = f[WIDTH], f[HEIGHT]
            bits, samples = f.get(BITS, (1,))[0], f.get(SAMPLES, (1,))[0]
            scheme, predictor = f.get(COMPRESSION, (NONE,))[0], f.get(PREDICTOR, (1,))[0]
            if bits not in (8, 16) or (samples > 1 and f.get(PLANAR, (1,))[0] != 1):
                raise TiffError("only chunky samples of 8 or 16 bits")
            depth = np.dtype(f"{order}u{bits // 8}")
            # A strip is a tile as wide as the page that may end with it.
            tw, th = (f[TILE_WIDTH][0], f[TILE_HEIGHT][0]) if TILE_AT in f else (width, min(f.get(STRIP_ROWS, (height,))[0], height))
            if not (width and height and samples and tw and th):
                raise TiffError("a page, strip or tile without extent")
            across, down = -(-width // tw), -(-height // th)
            blocks = list(zip(*((f[TILE_AT], f[TILE_BYTES]) if TILE_AT in f else (f[STRIP_AT], f[STRIP_BYTES])), strict=True))
            if len(blocks) != across * down:
                raise TiffError("the strips or tiles don't cover the page")
            stored = sum(min(size, max(len(data) - place, 0)) for place, size in blocks)
            if across * tw * height * samples * depth.itemsize > MOST_BYTES.get(scheme, 1) * stored:
                raise TiffError("the page is larger than its data")
            pixels = np.empty((height, width, samples), depth.newbyteorder("="))
            for i, (place, size) in enumerate(blocks):
                y, x = i // across * th, i % across * tw
                n = th if TILE_AT in f else min(th, height - y)
                block = _block(data, place, size, (n, tw, samples), scheme, predictor, depth)
                pixels[y : y + th, x : x + tw] = block[: height - y, : width - x]
            yield Page(len(seen) - 1, scheme, predictor, pixels)
            at = following
    except (struct.error, KeyError, IndexError, ValueError) as e:
        if isinstance(e, TiffError):
            raise
        raise TiffError(f"{type(e).__name__}: {e}") from None


def write_tiff(payload: bytes, *, width: int = 64, page_rows: int = 1024, strip_rows: int = 256, scheme: int = DEFLATE, predictor: int = 2, tile: int = 0, order: str = "<") -> bytes:
    """``payload``, of a positive multiple of ``width`` bytes, as grey samples in rows.

    A page has ``page_rows`` rows at most, in strips of ``strip_rows`` or, if given, in
    tiles of ``tile`` by ``tile`` (a multiple of 16).
    """
    if not payload or len(payload) % width:
        raise ValueError("the payload must be a positive multiple of the width")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0")
    link = 4
    for top in range(0, len(rows), page_rows):
        page, blocks = rows[top : top + page_rows], []
        if tile:
            for y in range(0, len(page), tile):
                for x in range(0, width, tile):
                    block = np.zeros((tile, tile), np.uint8)
                    part = page[y : y + tile, x : x + tile]
                    block[: part.shape[0], : part.shape[1]] = part
                    blocks.append(block)
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, len(page), strip_rows)]
        places, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((len(block), 1), np.uint8))
            places.append(len(out))
            out += _encoded(block.tobytes(), scheme)
            sizes.append(len(out) - places[-1])
            out += b"\0" * (len(out) % 2)
        fields = {WIDTH: [width], HEIGHT: [len(page)], BITS: [8], COMPRESSION: [scheme], PHOTOMETRIC: [1], SAMPLES: [1], PREDICTOR: [predictor]}
        fields |= {TILE_WIDTH: [tile], TILE_HEIGHT: [tile], TILE_AT: places, TILE_BYTES: sizes} if tile else {STRIP_AT: places, STRIP_ROWS: [strip_rows], STRIP_BYTES: sizes}
        entries = bytearray()
        for tag, values in sorted(fields.items()):
            packed = struct.pack(f"{order}{len(values)}I", *values)
            if len(packed) > 4:
                place, packed = len(out), out.extend(packed) or b""
                packed = struct.pack(f"{order}I", place)
            entries += struct.pack(f"{order}HHI", tag, 4, len(values)) + packed
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def text_payload(text: str, multiple: int = 64) -> tuple[bytes, int]:
    """The UTF-8 bytes of ``text`` with zero bytes up to a positive multiple, and their number without these."""
    raw = text.encode()
    return raw + b"\0" * (max(1, -(-len(raw) // multiple)) * multiple - len(raw)), len(raw)


def encode_texts(docs: DataFrame, *, key: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Columns ``key``, ``n_bytes`` and ``media``: each text as a TIFF file; no shuffle.

    Null text counts as empty and is stored as one row of zero bytes.  Rows that repeat
    or have a null key are stored each on its own; an empty table gives an empty result.
    """

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        sizes, files = [], []
        for text in part.column("text").to_pylist():
            payload, n = text_payload(text)
            sizes.append(n)
            files.append(write_tiff(payload, **options))
        return pa.RecordBatch.from_arrays([part.column("key"), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["key", "n_bytes", "media"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return rows.mapInArrow(per_text(function, "text"), f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


def pages(media: DataFrame, *, key: str, media_column: str = "media") -> DataFrame:
    """One row for each page: ``key``, ``page``, ``width``, ``height``, ``samples``,
    ``compression``, ``predictor``, ``pixels`` (row by row, native byte order) and ``error``.

    A null file has no page.  A file that can't be decoded to its end has its good pages
    and then a row in which only ``key``, ``page`` and ``error`` are set.
    """
    names = ["key", "page", "width", "height", "samples", "compression", "predictor", "pixels", "error"]
    kinds = [pa.int32()] * 6 + [pa.binary(), pa.string()]

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]

        def add(*row) -> None:
            for column, value in zip(out, row, strict=True):
                column.append(value)

        for i, data in enumerate(part.column("media").to_pylist()):
            n = 0
            try:
                for p in read_tiff(data) if data is not None else ():
                    h, w, s = p.pixels.shape
                    add(i, p.number, w, h, s, p.compression, p.predictor, p.pixels.tobytes(), None)
                    n += 1
            except TiffError as e:
                add(i, n, *[None] * 6, str(e))
        keys = part.column("key").take(pa.array(out[0], pa.int64()))
        return pa.RecordBatch.from_arrays([keys, *(pa.array(v, k) for v, k in zip(out[1:], kinds, strict=True))], names=names)

    kind = dict(media.dtypes)[key]
    schema = f"key {kind}, page int, width int, height int, samples int, compression int, predictor int, pixels binary, error string"
    return media.select(F.col(key).alias("key"), F.col(media_column).alias("media")).mapInArrow(per_text(function, "media"), schema).withColumnRenamed("key", key)


def page_features(pixels: list[np.ndarray]) -> str:
    """Number of pages and samples, mean, deviation and entropy of the samples' histogram, and mean step along rows."""
    counts, steps, n_steps = np.zeros(256, np.int64), 0, 0
    for p in pixels:
        counts += np.bincount(p.ravel(), minlength=256)
        d = np.abs(np.diff(p.astype(np.int16), axis=1))
        steps, n_steps = steps + int(d.sum()), n_steps + d.size
    total = int(counts.sum())
    share = counts[counts > 0] / total
    values = np.arange(256)
    mean = float(counts @ values) / total
    deviation = (float(counts @ values**2) / total - mean**2) ** 0.5
    entropy = abs(float(-(share * np.log2(share)).sum()))
    return f"pages={len(pixels)};samples={total};mean={mean:.4f};deviation={deviation:.4f};entropy={entropy:.4f};step={steps / max(n_steps, 1):.4f}"


def payload_digests(media: DataFrame, *, key: str, n_bytes: str = "n_bytes") -> DataFrame:
    """Digests of what is read back from each file: the samples of its pages one after another."""
    import hashlib

    names = ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in part.column("media").to_pylist():
            found = [p.pixels[:, :, 0] for p in read_tiff(data)]
            payload = b"".join(p.tobytes() for p in found)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), page_features(found)))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([part.column("key"), part.column("n_bytes"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=names)

    kind = dict(media.dtypes)[key]
    schema = f"key {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select(F.col(key).alias("key"), n_bytes, "media").mapInArrow(per_text(function, "media"), schema).withColumnRenamed("key", key)
