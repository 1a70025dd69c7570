"""Media columns: signature sniffing, structure checks, type correction and carving.

Aho-Corasick finds every magic number in a binary value in one pass. A validator for each format walks the structure
that should follow and returns where it ends, or rejects it. Whatever stands at the first byte gives the true type and
corrects a declared one; every valid object, wherever it lies, can be carved.

Null values are treated as empty ones: no type, no objects; the declared type is then kept. Repeated rows are each
sniffed. Other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import new_path, slices

UNIT = 192
RATE = 8000


def _u32(data: bytes, at: int, order: str = "<") -> int:
    return struct.unpack_from(order + "I", data, at)[0] if 0 <= at <= len(data) - 4 else -1


def png_end(data: bytes, at: int) -> int | None:
    """Length, type and checksum of each chunk, from IHDR to IEND."""
    p, first = at + 8, True
    while (n := _u32(data, p, ">")) >= 0 and p + 12 + n <= len(data):
        kind = data[p + 4 : p + 8]
        if first != (kind == b"IHDR") or zlib.crc32(data[p + 4 : p + 8 + n]) != _u32(data, p + 8 + n, ">"):
            return None
        p, first = p + 12 + n, False
        if kind == b"IEND":
            return p
    return None


def jpeg_end(data: bytes, at: int) -> int | None:
    """Marker segments up to a scan, entropy coded data up to the next marker, and so on to the end marker."""
    p, scans = at + 2, 0
    while p + 4 <= len(data) and data[p] == 0xFF:
        kind = data[p + 1]
        if kind == 0xD9:
            return p + 2 if scans else None
        n = int.from_bytes(data[p + 2 : p + 4], "big")
        if kind < 0xC0 or n < 2:
            return None
        p += 2 + n
        if kind == 0xDA:
            scans += 1
            while 0 <= (q := data.find(b"\xff", p)) < len(data) - 1 and (data[q + 1] == 0 or 0xD0 <= data[q + 1] <= 0xD7):
                p = q + 2
            p = q if q >= 0 else len(data)
    return p + 2 if scans and data[p : p + 2] == b"\xff\xd9" else None


def gif_end(data: bytes, at: int) -> int | None:
    """Screen descriptor and colour table, then extension and image blocks to the trailer."""

    def blocks(p: int) -> int:
        while p < len(data) and data[p]:
            p += 1 + data[p]
        return p + 1

    if at + 13 > len(data):
        return None
    p = at + 13 + (3 << (data[at + 10] & 7) + 1 if data[at + 10] & 0x80 else 0)
    while p < len(data):
        if data[p] == 0x3B:
            return p + 1
        if data[p] == 0x21:
            p = blocks(p + 2)
        elif data[p] == 0x2C and p + 10 < len(data):
            p = blocks(p + 11 + (3 << (data[p + 9] & 7) + 1 if data[p + 9] & 0x80 else 0))
        else:
            return None
    return None


def bmp_end(data: bytes, at: int) -> int | None:
    """File size, reserved zeros, header size, one plane, a usual depth, and room for all rows."""
    size, first, head = _u32(data, at + 2), _u32(data, at + 10), _u32(data, at + 14)
    if _u32(data, at + 6) or head not in (40, 108, 124) or not 14 + head <= first <= size or at + size > len(data):
        return None
    width, height, planes, depth = struct.unpack_from("<iiHH", data, at + 18)
    row = (width * depth + 31) // 32 * 4
    fits = width > 0 and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and first + row * abs(height) <= size
    return at + size if fits else None


def riff_chunks(data: bytes, at: int) -> dict[bytes, tuple[int, int]] | None:
    """The chunks (start, length) of a RIFF form that fill its declared length exactly."""
    size = _u32(data, at + 4)
    if size < 4 or at + 8 + size > len(data):
        return None
    p, end, found = at + 12, at + 8 + size, {}
    while p + 8 <= end:
        n = _u32(data, p + 4)
        found.setdefault(data[p : p + 4], (p + 8, n))
        p += 8 + n + (n & 1)
    return found if p == end else None


def riff_end(data: bytes, at: int) -> int | None:
    chunks = riff_chunks(data, at)
    form = data[at + 8 : at + 12]
    wanted = {b"WAVE": (b"fmt ", b"data"), b"WEBP": (), b"AVI ": (b"LIST",)}.get(form)
    whole = chunks and wanted is not None and all(x in chunks for x in wanted) and (form != b"WEBP" or set(chunks) & {b"VP8 ", b"VP8L", b"ANMF"})
    return at + 8 + _u32(data, at + 4) if whole else None


def ogg_end(data: bytes, at: int) -> int | None:
    """Pages of version 0, numbered from 0 in each of the streams that may alternate, until all streams have ended."""
    p, pages, ended = at, {}, set()
    while data[p : p + 5] == b"OggS\0" and p + 27 <= len(data):
        table = data[p + 27 : p + 27 + data[p + 26]]
        end, stream = p + 27 + data[p + 26] + sum(table), _u32(data, p + 14)
        number = pages.get(stream, 0)
        if len(table) < data[p + 26] or end > len(data) or stream in ended or _u32(data, p + 18) != number or bool(data[p + 5] & 2) != (number == 0):
            return None
        pages[stream] = number + 1
        if data[p + 5] & 4:
            ended.add(stream)
            if len(ended) == len(pages):
                return end
        p = end
    return None


def mp4_end(data: bytes, at: int) -> int | None:
    """Boxes from ftyp on, of 32-bit or 64-bit lengths; a moov or moof box is needed. A box of length 0 goes to the end."""
    p, seen = at, set()
    while (n := _u32(data, p, ">")) >= 0 and data[p + 4 : p + 8].isalnum():
        kind = data[p + 4 : p + 8]
        if n == 1:
            n = int.from_bytes(data[p + 8 : p + 16], "big") if p + 16 <= len(data) else 0
            n = n if n >= 16 else -1
        elif n == 0:
            n = len(data) - p
        if n < 8 or p + n > len(data):
            break
        seen.add(kind)
        p += n
    return p if b"ftyp" in seen and seen & {b"moov", b"moof"} else None


#: Fixed values of the formats: magic bytes, where the object begins before them, type, validator.
FORMATS: list[tuple[bytes, int, str, Callable[[bytes, int], int | None]]] = [
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", png_end),
    (b"\xff\xd8\xff", 0, "image/jpeg", jpeg_end),
    (b"GIF87a", 0, "image/gif", gif_end),
    (b"GIF89a", 0, "image/gif", gif_end),
    (b"BM", 0, "image/bmp", bmp_end),
    (b"RIFF", 0, "riff", riff_end),
    (b"OggS", 0, "audio/ogg", ogg_end),
    (b"ftyp", 4, "video/mp4", mp4_end),
]
RIFF_TYPES = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/avi"}
_automaton: list = []


def find_media(data: bytes) -> list[tuple[str, int, int]]:
    """(type, offset, length) of every valid object in the value, in order of offset; nested ones included."""
    if not _automaton:
        a = ahocorasick.Automaton()
        for k, (magic, *_) in enumerate(FORMATS):
            a.add_word(magic.decode("latin-1"), k)
        a.make_automaton()
        _automaton.append(a)
    found = []
    for last, k in _automaton[0].iter(data.decode("latin-1")):
        magic, back, kind, end_of = FORMATS[k]
        at = last + 1 - len(magic) - back
        if at >= 0 and (end := end_of(data, at)):
            found.append((RIFF_TYPES[data[at + 8 : at + 12]] if kind == "riff" else kind, at, end - at))
    return sorted(found, key=lambda x: (x[1], x[0]))


def sniff_media(df: DataFrame, content: str = "content", declared: str = "declared_type") -> DataFrame:
    """df with media_type (the true type, else the declared one), mislabelled, and objects: (type, offset, length)."""
    kind = pa.list_(pa.struct([("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
    extra = ["media_type", "mislabelled", "objects"]
    base = df.select(*(c for c in df.columns if c not in extra)) if set(extra) & set(df.columns) else df
    at, said = base.columns.index(content), base.columns.index(declared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            objects = [find_media(x.as_py() or b"") for x in batch.column(at)]
            old = batch.column(said).to_pylist()
            new = [next((k for k, start, _ in o if start == 0), d) for o, d in zip(objects, old, strict=True)]
            listed = [[{"type": k, "offset": a, "length": n} for k, a, n in o] for o in objects]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string()), pa.array([a != b for a, b in zip(new, old, strict=True)]), pa.array(listed, kind)], [*batch.schema.names, *extra])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, fields + ", media_type string, mislabelled boolean, objects array<struct<type:string,offset:bigint,length:bigint>>")


def carve_media(df: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """One row for each valid object: (key, media_type, offset, length, data), the object's own bytes. Nested ones too.

    Values without objects, null and empty ones give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one value's objects at a time
                value = batch.column(1)[k].as_py() or b""
                found = find_media(value)
                if found:
                    kinds, at, sizes = zip(*found, strict=True)
                    own = batch.column(0).take(pa.array([k] * len(found)))
                    yield pa.RecordBatch.from_arrays([own, pa.array(kinds), pa.array(at, pa.int64()), pa.array(sizes, pa.int64()), pa.array([value[a : a + n] for _, a, n in found], pa.binary())], [key, "media_type", "offset", "length", "data"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, content).mapInArrow(run, f"`{key}` {kind}, media_type string, offset long, length long, data binary")


def wav_of(payload: bytes) -> bytes:
    """Mono 8-bit PCM; the samples are the payload's bytes. An even length needs no padding."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


def wav_samples(data: bytes, at: int = 0) -> tuple[int, int, int, bytes]:
    """(channels, rate, bits, sample bytes) of the WAV object at an offset; zeros and nothing where it is none."""
    chunks = riff_chunks(data, at) or {}
    if chunks.get(b"fmt ", (0, 0))[1] < 16 or b"data" not in chunks:
        return 0, 0, 0, b""
    fmt, (start, n) = chunks[b"fmt "][0], chunks[b"data"]
    _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, fmt)
    return channels, rate, bits, data[start : start + n]


def texts_as_media(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_bytes, declared_type, content): the padded UTF-8 as WAV, declared as a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            raw = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
            for a, b in slices([len(x) for x in raw], 8_000_000):
                content = [wav_of(x.ljust(max(1, -(-len(x) // UNIT)) * UNIT, b" ")) for x in raw[a:b]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(x) for x in raw[a:b]], pa.int64()), pa.array(["image/bmp"] * (b - a)), pa.array(content, pa.binary())], ["doc_id", "n_bytes", "declared_type", "content"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, declared_type string, content binary")


def media_features(media: DataFrame) -> DataFrame:
    """Sniffed rows with doc_id and n_bytes -> digests of the carved sound's samples and of the stored value.

    A row whose value holds no sound at its first byte has an empty payload and the feature of its media type alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in batches:
            ids, sizes, kinds, objects = (batch.column(x).to_pylist() for x in ("doc_id", "n_bytes", "media_type", "objects"))
            rows = []
            for doc_id, n, kind, found, value in zip(ids, sizes, kinds, objects, batch.column("content"), strict=True):
                data, payload, feature = value.as_py() or b"", b"", kind or ""
                sound = next((o for o in found if o["type"] == "audio/wav" and o["offset"] == 0), None)
                if sound:
                    channels, rate, bits, payload = wav_samples(data[: sound["length"]])
                    level = np.frombuffer(payload, np.uint8).astype(np.float64) - 128
                    feature = f"{kind};channels={channels};rate={rate};bits={bits};seconds={len(payload) / max(rate, 1):.3f};rms={np.sqrt((level**2).mean()) if len(level) else 0:.4f};objects={len(found)}"
                rows.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return media.select("doc_id", "n_bytes", "content", "media_type", "objects").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def store_and_read_back(docs: DataFrame) -> DataFrame:
    """Write docs' texts as media to the shared folder, read the stored values back, sniff them and digest them."""
    path = new_path(docs.sparkSession, "media")
    media = texts_as_media(docs)
    media.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return media_features(sniff_media(docs.sparkSession.read.schema(media.schema).parquet(path)))
