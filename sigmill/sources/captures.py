"""Captures (WAV, RF64 and raw .r64 files) as a Spark data source: one row a block of samples.

    register(spark)
    spark.read.format("iqcapture").option("path", uri_or_folder).load()

Planning lists files and no more: an input partition is a range of bytes of one file, and the task that reads it reads
the file's header and yields the blocks whose first byte lies in its range. Filters on start_sample skip blocks before
any sample is read. Paths go through pyarrow's file systems, so file, hdfs and object store URIs work alike.

    read_blocks(files, ...)  # the same blocks of a table of files
    spark.read.format("iqmeta").option("path", uri_or_folder).load()

`iqmeta` has a row a file, from its header alone: frames, channels, bits, rate (fs_hz: the hint if there is one;
fs_header_hz: the header's own, null for raw files), duration, and whether integers.

Options: path (files and folders, by commas; captures whose names hold commas are read from a table, `read_blocks`);
samples (false: blocks without their samples, which are then not read); form (auto, wav, raw: auto goes by the RIFF or RF64 mark); fallbackRaw
(true: a file that claims to be WAV but cannot be parsed is read as raw); fsHint (Hz, wins over the header; needed for
raw files); channelOrder (IQ, QI); blockFrames, chunkFrames; partitionBytes; haloBefore, haloAfter (frames), haloBeforeMs:
the block's neighbouring samples in head_i, head_q, tail_i, tail_q, so that frames and filters that reach over a border
need no shuffle.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

BLOCK_FRAMES = 1 << 18
CHUNK_FRAMES = 1 << 24
PARTITION_BYTES = 128 << 20
_SAMPLES = T.ArrayType(T.FloatType(), False)
BLOCKS = T.StructType([T.StructField("file_id", T.StringType()), T.StructField("chunk_id", T.LongType()), T.StructField("block_id", T.LongType()), T.StructField("start_sample", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("fs_hz", T.DoubleType()), T.StructField("i", _SAMPLES), T.StructField("q", _SAMPLES)])
MARKS = (b"RIFF", b"RF64")
#: Fixed values of the format: tags for integers, floating numbers and "see the sub-format", and the widths they come in.
INTEGER, FLOATING, EXTENSIBLE = 1, 3, 0xFFFE
SAMPLE_KINDS = {(INTEGER, 8), (INTEGER, 16), (INTEGER, 24), (INTEGER, 32), (FLOATING, 32), (FLOATING, 64)}


@dataclass(frozen=True)
class Capture:
    """frames: complex samples; width: bytes of one number; mono files hold I and Q in turn."""

    uri: str
    offset: int
    frames: int
    channels: int
    width: int
    floating: bool
    fs_hz: float
    header_hz: float | None = None

    @property
    def frame_bytes(self) -> int:
        return self.width * max(2, self.channels)


def chunk_frames(memory_mb: int, channels: int = 2, least: int = BLOCK_FRAMES) -> int:
    """Frames of a chunk whose float32 samples fill memory_mb (64 at least): a multiple of `least`, CHUNK_FRAMES at most."""
    fit = (max(memory_mb, 64) << 20) // (4 * channels)
    return min(max(1, fit // least) * least, CHUNK_FRAMES)


def _store(uri: str):
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _opened(uri: str):
    store, path = _store(uri)
    return store.open_input_file(path)


def _probe_wav(f, uri: str, fs_hint: float) -> Capture:
    f.seek(0)
    head = f.read(12)
    if head[:4] not in MARKS or head[8:] != b"WAVE":
        raise ValueError(f"{uri} is not a WAV file")
    at, wide, fmt = 12, None, None
    while at + 8 <= f.size():
        f.seek(at)
        kind, size = struct.unpack("<4sI", f.read(8))
        if kind == b"ds64":
            wide = struct.unpack_from("<QQ", f.read(16))[1]
        elif kind == b"fmt ":
            raw = f.read(min(size, 26))
            fmt = struct.unpack_from("<HHIIHH", raw)
            if fmt[0] == EXTENSIBLE:  # the real tag begins the sub-format behind the extension's first fields
                fmt = (*struct.unpack_from("<H", raw, 24), *fmt[1:])
        elif kind == b"data":
            if fmt is None or (fmt[0], fmt[5]) not in SAMPLE_KINDS or not fmt[1]:
                raise ValueError(f"{uri} has no usable format before its data")
            size = wide if size == 0xFFFFFFFF and wide is not None else size
            tag, channels, rate, _, _, bits = fmt
            width = bits // 8
            size = min(size, f.size() - at - 8)
            return Capture(uri, at + 8, size // (width * max(2, channels)), channels, width, tag == FLOATING, fs_hint or float(rate), float(rate))
        at += 8 + size + (size & 1)
    raise ValueError(f"{uri} has no data")


def probe(uri: str, form: str = "auto", fs_hint: float = 0.0, fallback_raw: bool = False) -> Capture:
    """Read the header. A raw file is headerless float32 and needs fs_hint; `auto` looks for the RIFF or RF64 mark."""
    with _opened(uri) as f:
        if form == "wav" or form == "auto" and f.read(4) in MARKS:
            try:
                return _probe_wav(f, uri, fs_hint)
            except (ValueError, struct.error):
                if not fallback_raw:
                    raise
        if fs_hint <= 0:
            raise ValueError(f"raw samples need a rate (fsHint): {uri}")
        return Capture(uri, 0, f.size() // 8, 2, 4, True, fs_hint)


def decode(raw: bytes, width: int, floating: bool) -> np.ndarray:
    """u8, s16, s24 and s32 scaled to [-1, 1); floating numbers of four and eight bytes as they are."""
    if width == 1:
        return ((np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 127.5).astype(np.float32)
    if width == 2:
        return np.frombuffer(raw, "<i2").astype(np.float32) / 32768
    if width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        v = b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16
        return (np.where(v >= 1 << 23, v - (1 << 24), v) / 8388608).astype(np.float32)
    if width == 4 and not floating:
        return (np.frombuffer(raw, "<i4") / 2147483648).astype(np.float32)
    return np.frombuffer(raw, "<f8").astype(np.float32) if width == 8 else np.frombuffer(raw, "<f4")


def _frames(f, c: Capture, start: int, stop: int, swap: bool) -> tuple[np.ndarray, np.ndarray]:
    f.seek(c.offset + start * c.frame_bytes)
    x = decode(f.read((stop - start) * c.frame_bytes), c.width, c.floating).reshape(stop - start, max(2, c.channels))
    return (x[:, 1], x[:, 0]) if swap else (x[:, 0], x[:, 1])


def read_block(c: Capture, start: int, stop: int, swap: bool = False) -> tuple[np.ndarray, np.ndarray]:
    with _opened(c.uri) as f:
        return _frames(f, c, start, stop, swap)


@dataclass
class Bytes(InputPartition):
    """Bytes low to high of a file, header included."""

    uri: str
    low: int
    high: int


@dataclass
class Options:
    form: str = "auto"
    fallback_raw: bool = False
    fs_hint: float = 0.0
    swap: bool = False
    block: int = BLOCK_FRAMES
    chunk: int = CHUNK_FRAMES
    partition_bytes: int = PARTITION_BYTES
    before: int = 0
    before_ms: float = 0.0
    after: int = 0
    paths: list[str] = field(default_factory=list)
    samples: bool = True

    @classmethod
    def of(cls, options: dict) -> Options:
        o = {k.lower(): v for k, v in options.items()}
        return cls(
            o.get("form", "auto").lower(), o.get("fallbackraw", "false").lower() == "true", float(o.get("fshint", 0)), o.get("channelorder", "IQ").upper() == "QI", int(o.get("blockframes", BLOCK_FRAMES)),
            int(o.get("chunkframes", CHUNK_FRAMES)), int(o.get("partitionbytes", PARTITION_BYTES)), int(o.get("halobefore", 0)), float(o.get("halobeforems", 0)), int(o.get("haloafter", 0)), o["path"].split(",") if "path" in o else [],
            o.get("samples", "true").lower() == "true",
        )

    @property
    def schema(self) -> T.StructType:
        """The halo's widths and the lengths of chunks and blocks stand in the fields' metadata, where operators look them up."""
        fields = [T.StructField(f.name, f.dataType, True, {"chunk_id": {"frames": self.chunk}, "block_id": {"frames": self.block}}.get(f.name)) for f in BLOCKS if self.samples or f.name not in "iq"]
        for name, frames, ms in (("head", self.before, self.before_ms), ("tail", self.after, 0.0)):
            if (frames or ms) and self.samples:
                fields += [T.StructField(f"{name}_{c}", _SAMPLES, True, {"frames": frames, "ms": ms}) for c in "iq"]
        return T.StructType(fields)


class CaptureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = Options.of(options)
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("start_sample",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high, f.value)
            yield f  # ranges only skip blocks; Spark still applies each filter

    def partitions(self) -> Sequence[InputPartition]:
        """A frame has two bytes at least, so ranges that end before byte 2 * low hold no wanted block."""
        step, out = max(1, self.options.partition_bytes), []
        for uri, size in files(self.options.paths):
            out += [Bytes(uri, a, min(size, a + step)) for a in range(0, size, step) if min(size, a + step) > 2 * self.low]
        return out

    def blocks_of(self, partition: Bytes) -> tuple[Capture, list[int]]:
        """The capture and the wanted blocks whose first byte is in the range."""
        o = self.options
        c = probe(partition.uri, o.form, o.fs_hint, o.fallback_raw)
        size = o.block * c.frame_bytes
        first, last = (max(0, -(-(x - c.offset) // size)) for x in (partition.low, partition.high))
        last = min(last, -(-c.frames // o.block), self.high // o.block + 1)
        return c, list(range(max(first, -(-self.low // o.block)), last))

    def read(self, partition: Bytes | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads when no range is left
            return
        o = self.options
        c, blocks = self.blocks_of(partition)
        kinds = {"file_id": pa.string(), "chunk_id": pa.int64(), "block_id": pa.int64(), "start_sample": pa.int64(), "n": pa.int32(), "fs_hz": pa.float64()}
        before = max(o.before, int(np.ceil(o.before_ms * c.fs_hz / 1000)))
        if not o.samples:
            start = np.array(blocks, np.int64) * o.block
            n = np.minimum(o.block, c.frames - start)
            values = {"file_id": [c.uri] * len(blocks), "chunk_id": start // o.chunk, "block_id": blocks, "start_sample": start, "n": n, "fs_hz": np.full(len(blocks), c.fs_hz)}
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in values.items()], list(values))
            return
        with _opened(c.uri) as f:
            for b in blocks:
                start, stop = b * o.block, min(c.frames, (b + 1) * o.block)
                low, high = max(0, start - before), min(c.frames, stop + o.after)
                i, q = _frames(f, c, low, high, o.swap)
                row = {"file_id": c.uri, "chunk_id": start // o.chunk, "block_id": b, "start_sample": start, "n": stop - start, "fs_hz": c.fs_hz}
                parts = {"": (start - low, stop - low)} | ({"head_": (0, start - low)} if before else {}) | ({"tail_": (stop - low, high - low)} if o.after else {})
                arrays = {f"{name}{c2}": x[s:e] for name, (s, e) in parts.items() for c2, x in (("i", i), ("q", q))}
                columns = [pa.array([v], kinds[k]) for k, v in row.items()] + [pa.array([v], pa.list_(pa.float32())) for v in arrays.values()]
                yield pa.RecordBatch.from_arrays(columns, [*row, *arrays])


META = T.StructType([T.StructField("file_id", T.StringType()), T.StructField("frames", T.LongType()), T.StructField("channels", T.IntegerType()), T.StructField("bits", T.IntegerType()), T.StructField("floating", T.BooleanType()), T.StructField("fs_hz", T.DoubleType()), T.StructField("duration_s", T.DoubleType()), T.StructField("message", T.StringType()), T.StructField("fs_header_hz", T.DoubleType())])


def header_row(uri: str, form: str, fs_hint: float, fallback_raw: bool, tolerant: bool) -> pa.RecordBatch:
    """A file's row of META; with tolerant, one whose header cannot be read has the reason as its message."""
    try:
        c = probe(uri, form, fs_hint, fallback_raw)
        row = (uri, c.frames, c.channels, 8 * c.width, c.floating, c.fs_hz, c.frames / c.fs_hz, None, c.header_hz)
    except (ValueError, struct.error) as e:
        if not tolerant:
            raise
        row = (uri, None, None, None, None, None, None, str(e), None)
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.string(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], META.names)


@dataclass
class Header(InputPartition):
    uris: list[str]


class HeaderReader(DataSourceReader):
    """Some files a partition; no sample is read."""

    def __init__(self, options: dict):
        self.options = Options.of(options)
        self.tolerant = {k.lower(): v for k, v in options.items()}.get("tolerant", "false").lower() == "true"

    def partitions(self) -> Sequence[InputPartition]:
        found = [uri for uri, _ in files(self.options.paths)]
        return [Header(found[k : k + 64]) for k in range(0, len(found), 64)]

    def read(self, partition: Header | None) -> Iterator[pa.RecordBatch]:
        for uri in partition.uris if partition else ():
            yield header_row(uri, self.options.form, self.options.fs_hint, self.options.fallback_raw, self.tolerant)


class HeaderSource(DataSource):
    """Options: path, form, fsHint, fallbackRaw as of `iqcapture`; tolerant."""

    @classmethod
    def name(cls) -> str:
        return "iqmeta"

    def schema(self) -> T.StructType:
        return META

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return HeaderReader(dict(self.options))


class CaptureSource(DataSource):
    """Options: see the module."""

    @classmethod
    def name(cls) -> str:
        return "iqcapture"

    def schema(self) -> T.StructType:
        return Options.of(dict(self.options)).schema

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return CaptureReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CaptureSource)
    spark.dataSource.register(HeaderSource)


def files(paths: list[str]) -> list[tuple[str, int]]:
    """(file, bytes) of files and folders, each once, by name in any case."""
    found = {x: n for p in paths for x, n in discover(p)}
    return sorted(found.items(), key=lambda x: (x[0].rpartition("/")[2].lower(), x[0]))


def discover(path: str) -> list[tuple[str, int]]:
    """A file, or the .wav and .r64 files in a folder (any case, not below it), with their sizes. Nothing found is an error."""
    store, inner = _store(path)
    prefix = path[: len(path) - len(inner)] if "://" in path else ""
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = [(prefix + x.path, x.size) for x in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if x.type == fs.FileType.File and x.path.lower().endswith((".wav", ".r64"))]
    if not found:
        raise FileNotFoundError(f"no captures in {path}")
    return found


def listed(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """(file_id, bytes) of files and folders, listed by tasks, each file once. paths: a list, or a table of one column.

    What a folder holds goes from the task that lists it to a table; the driver sees the given paths alone. A path without
    captures fails, as in `discover`.
    """
    if isinstance(paths, list):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = discover(path)
                for k in range(0, len(found), 10_000):
                    uris, sizes = zip(*found[k : k + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(uris), pa.array(sizes, pa.int64())], ["file_id", "bytes"])

    rows = paths.select(paths.columns[0]).distinct().mapInArrow(run, "file_id string, bytes long")
    return rows.groupBy("file_id").agg(F.max("bytes").alias("bytes"))


def metadata(spark: SparkSession, path: str | list[str], form: str = "auto", fs_hint: float = 0.0, fallback_raw: bool = False, tolerant: bool = False) -> DataFrame:
    """META's columns of each file; files are listed, and headers read, by tasks. path: by commas, or a list.

    message is null; with tolerant, a file whose header cannot be read has the reason there, and null elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield header_row(uri, form, fs_hint, fallback_raw, tolerant)

    paths = path.split(",") if isinstance(path, str) else path
    return listed(spark, paths).select("file_id").mapInArrow(run, META)


def read_blocks(files: DataFrame, **options) -> DataFrame:
    """files(file_id, bytes) -> the blocks of `iqcapture` with these options, for any number of files with any names.

    Ranges of bytes are dealt to tasks by a shuffle of (file_id, range), not of samples.
    """
    o = Options.of(options)
    reader = CaptureReader(options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from reader.read(Bytes(uri, low, high))

    step = max(1, o.partition_bytes)
    low = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long")))
    ranges = files.where("bytes > 0").select("file_id", low.alias("low"), "bytes").select("file_id", "low", F.least("bytes", F.col("low") + step).alias("high"))
    return ranges.repartition("file_id", "low").mapInArrow(run, o.schema)


def wav_header(frames: int, fs_hz: float) -> bytes:
    """The bytes before stereo PCM_16 samples: RIFF, or RF64 where its 32-bit lengths do not do."""
    rate, size = int(fs_hz), 4 * frames
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 2, rate, rate * 4, 4, 16)
    if 36 + size > 0xFFFFFFFF:
        ds64 = struct.pack("<4sIQQQI", b"ds64", 28, 72 + size, size, frames, 0)
        return struct.pack("<4sI4s", b"RF64", 0xFFFFFFFF, b"WAVE") + ds64 + fmt + struct.pack("<4sI", b"data", 0xFFFFFFFF)
    return struct.pack("<4sI4s", b"RIFF", 36 + size, b"WAVE") + fmt + struct.pack("<4sI", b"data", size)


def pcm16(i: np.ndarray, q: np.ndarray) -> bytes:
    """Interleaved 16-bit samples of values in [-1, 1]; values beyond are clipped, NaN is zero."""
    return np.clip(np.round(np.nan_to_num(np.stack([i, q], axis=1)) * 32767), -32768, 32767).astype("<i2").tobytes()


def wav_bytes(i: np.ndarray, q: np.ndarray, fs_hz: float) -> bytes:
    """A short slice as one WAV file."""
    return wav_header(len(i), fs_hz) + pcm16(i, q)
