"""All results of a set of captures in one folder: quality, spectrum, carriers, activity, slices, slice audio.

Each table is written by one Spark job over all captures that are to do. Tables are partitioned by capture and replaced
by capture, so a run that was cut short is simply repeated. The table `progress` names each capture with its status
(completed, failed: its header cannot be read) and how long it lasts.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assessment, irr, wideband
from ..operators import captures as ops
from ..sources import captures, slices
from . import outputs

#: What a deployment sets otherwise than the defaults. max_columns bounds the waterfall's time resolution.
PRESETS = {
    "standard": {"nperseg": 4096, "prominence_db": 8.0, "cfar_k": 3.0, "max_columns": 4000},
    "hybrid": {"nperseg": 1024, "prominence_db": 5.0, "cfar_k": 2.5, "max_columns": 4000},
    "industrial": {"nperseg": 512, "prominence_db": 10.0, "cfar_k": 4.0, "max_columns": 4000},
}
STEPS = ("quality", "spectrum", "slices")
PROGRESS = "file_id string, status string, duration_s double, message string, capture string"


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """The progress table; an empty one before the first run."""
    try:
        return spark.read.schema(PROGRESS).json(f"{folder}/progress")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS)


def analyse(spark: SparkSession, path: str | list[str], folder: str, preset: str = "standard", block_frames: int = captures.BLOCK_FRAMES, resume: bool = False, audio: bool = False, thresh_dbfs: float = -60.0, max_slices: int | None = None, steps: tuple[str, ...] = STEPS, conv: str | None = None, memory_mb: int | None = None, **source) -> None:
    """With resume, captures named as completed are left out. source holds further options of `iqcapture`.

    conv is the convention whose rejection the summary sets against step one's; None takes each capture's best. memory_mb
    sets the length of chunks (sources.captures.chunk_frames) where source has no chunkFrames.
    """
    started = time.time()
    if memory_mb is not None:
        source = {"chunkFrames": captures.chunk_frames(memory_mb, least=block_frames)} | source
    options = PRESETS[preset]
    nperseg = options["nperseg"]
    hop, rms_ms = nperseg // 4, 5.0
    captures.register(spark)
    listed = captures.listed(spark, path.split(",") if isinstance(path, str) else path)
    known = captures.metadata(spark, path, source.get("form", "auto"), float(source.get("fsHint", 0)), str(source.get("fallbackRaw", "false")).lower() == "true", tolerant=True)
    if resume:
        known = known.join(progress(spark, folder).where("status = 'completed'"), "file_id", "left_anti")
    found = known.select("file_id", "frames", "fs_hz", "duration_s", "message", "channels", "fs_header_hz").collect()  # a row a capture, as many as were listed
    if not found:
        return
    good = [r["file_id"] for r in found if r["message"] is None]
    files = spark.createDataFrame(found, "file_id string, frames long, fs_hz double, duration_s double, message string, channels int, fs_header_hz double")
    if good:
        halo = {"haloAfter": nperseg - hop, "haloBeforeMs": rms_ms}
        wanted = listed.join(spark.createDataFrame([(x,) for x in good], "file_id string"), "file_id", "left_semi")
        blocks = captures.read_blocks(wanted, blockFrames=block_frames, **halo, **source)
        _write(spark, blocks, files.where("message IS NULL").drop("message", "duration_s"), folder, options, nperseg, hop, rms_ms, thresh_dbfs, max_slices, steps, audio, block_frames, conv, {"chunk_frames": int(source.get("chunkFrames", captures.CHUNK_FRAMES)), "memory_mb": memory_mb})
    status = F.when(F.col("message").isNull(), "completed").otherwise("failed")
    rows = files.select("file_id", status.alias("status"), "duration_s", "message").withColumn("capture", outputs.capture())
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture").json(f"{folder}/progress")
    outputs.index(progress(spark, folder), f"{folder}/index")
    outputs.batch_summary(progress(spark, folder), folder, started, time.time())


def _earlier(spark: SparkSession, folder: str) -> DataFrame:
    """Image rejection as the quality step of an earlier run left it; without one, no rows."""
    schema = "input_file string, best_convention string, best_irr_db double, direct_db double, mirrored_db double"
    try:
        rows = spark.read.schema(schema).json(f"{folder}/stats")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.withColumnRenamed("input_file", "file_id").drop("capture")


def _write(spark, blocks, files, folder, options, nperseg, hop, rms_ms, thresh_dbfs, max_slices, steps, audio, block_frames, conv, read) -> None:
    stats = assessment.statistics(blocks).persist() if "quality" in steps else _earlier(spark, folder)  # a row a file
    if "quality" in steps:
        outputs.quality(stats, folder, files=files, block_frames=block_frames, fft_size=ops.IRR_FFT, **{k: v for k, v in read.items() if v is not None})
    if "spectrum" in steps:
        psd = ops.welch(blocks, nperseg, nperseg // 2)
        psd.withColumn("capture", outputs.capture()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture").parquet(f"{folder}/psd")
        psd = spark.read.parquet(f"{folder}/psd").join(files.select("file_id"), "file_id", "left_semi")
        mask = wideband.cfar_mask(ops.waterfall(blocks, nperseg, hop, options["max_columns"], files=files), options["cfar_k"])
        outputs.spectrum(files, psd, ops.carriers(psd, options["prominence_db"]), mask, folder, nperseg, **{k: v for k, v in options.items() if k != "nperseg"}, compared=irr.comparison(files.select("file_id").join(stats, "file_id", "left"), conv))
    if "slices" in steps:
        spans = ops.activity_slices(blocks, rms_ms, thresh_dbfs, max_slices=max_slices)
        outputs.slices(files, spans, folder, rms_win_ms=rms_ms, thresh_dbfs=thresh_dbfs, min_dur_ms=5.0, gap_ms=3.0, pad_ms=2.0)
        if audio:
            slices.register(spark)
            slices.export(blocks, spans.select("file_id", "slice_idx", "start_sample", "end_sample"), f"{folder}/audio", block_frames)
    stats.unpersist()
