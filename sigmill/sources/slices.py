"""Slices of captures as WAV files (stereo PCM_16): a data source to write, format `iqslices`.

    register(spark)
    export(blocks, intervals, folder, block_frames)

A task streams each slice's pieces in order through an open file, so it holds one piece. Files are staged in a folder of
the job's own; the job's commit gives them their names and replaces equal names, its abort removes them. So a task that
fails or runs twice leaves nothing, and a job that fails leaves what was there before. (On a store without a rename, the
moves copy.)
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import captures
from .captures import pcm16, wav_header

PIECES = "name string, frames long, fs_hz double, at long, i array<float>, q array<float>"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]
    """Staged path and name of each file that a task has written whole."""


class SliceWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.stage = f"_staged-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Pieces arrive by name and then by place."""
        store, folder = self._store()
        store.create_dir(f"{folder}/{self.stage}", recursive=True)
        name, out, files = None, None, []
        try:
            for batch in iterator:
                columns = [batch.column(c) for c in ("name", "frames", "fs_hz", "i", "q")]
                for row in zip(*columns, strict=True):
                    this, frames, rate = (x.as_py() for x in row[:3])
                    if this != name:
                        if out:
                            out.close()
                        name = this
                        files.append((f"{folder}/{self.stage}/{uuid.uuid4().hex}", name))
                        out = store.open_output_stream(files[-1][0])
                        out.write(wav_header(frames, rate))
                    out.write(pcm16(*(np.asarray(x.values) for x in row[3:])))
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = self._store()
        store.create_dir(folder, recursive=True)
        for message in filter(None, messages):
            for part, name in message.files:
                store.move(part, f"{folder}/{name}")
        self._clear(store, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*self._store())

    def _clear(self, store: fs.FileSystem, folder: str) -> None:
        if store.get_file_info(f"{folder}/{self.stage}").type == fs.FileType.Directory:
            store.delete_dir(f"{folder}/{self.stage}")


class SliceSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "iqslices"

    def schema(self) -> str:
        return PIECES

    def writer(self, schema, overwrite: bool) -> SliceWriter:
        return SliceWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SliceSink)


def export(blocks: DataFrame, intervals: DataFrame, folder: str, block_frames: int, part_frames: int | None = None) -> None:
    """One file for each interval that holds samples: <capture>_<crc of its path>_<slice_idx>.wav.

    Lengths are what the capture holds. Pieces are dealt by file name, so one file is one task's sequential work. With
    part_frames, an interval longer than that becomes files <...>.part00000.wav, ..., each of the pieces that begin within
    part_frames samples, which several tasks write; a shorter one has its plain name.
    """
    pieces = captures.cut(blocks, intervals, block_frames, "fs_hz")
    whole = Window.partitionBy("file_id", "slice_idx")
    padded = lambda c: F.lpad(c.cast("string"), 5, "0")
    part, suffix = F.lit(0), F.lit("")
    if part_frames:
        size = F.sum(F.size("i")).over(whole)
        part = F.when(size > part_frames, F.floor((F.col("at") - F.min("at").over(whole)) / part_frames)).otherwise(0)
        suffix = F.when(size > part_frames, F.concat(F.lit(".part"), padded(F.col("part")))).otherwise("")
    stem = F.regexp_extract("file_id", r"([^/]*?)(\.[^./]*)?$", 1)
    name = F.concat(stem, F.lit("_"), F.lower(F.hex(F.crc32(F.col("file_id").cast("binary")))), F.lit("_"), padded(F.col("slice_idx")), suffix, F.lit(".wav"))
    named = pieces.withColumn("part", part).withColumn("name", name)
    frames = F.sum(F.size("i")).over(Window.partitionBy("name"))
    rows = named.withColumn("frames", frames.cast("long")).select("name", "frames", "fs_hz", "at", "i", "q")
    rows.sortWithinPartitions("name", "at").write.format("iqslices").mode("append").save(folder)
