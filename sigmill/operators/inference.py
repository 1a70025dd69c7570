"""From blocks to labelled bursts: one connected plan.

chunks -> robust scale -> frame energies -> threshold -> voice segments -> radio metrics and classified frames -> bursts
-> absolute frequencies and times. Everything up to the segments is a row a frame at most; samples are read where they
are, once for each of the steps that need them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.captures import BLOCK_FRAMES
from . import intervals as iv
from .captures import lengths

SEGMENT = ["file_id", "segment_id", "chunk_id", "start_sample", "end_sample", "start_time_s", "end_time_s", "duration_s", "pred_idx", "pred_label", "prob_top1", "rf_offset_hz", "bandwidth_hz", "snr_db"]
PREDICTION = ["burst_id", "pred_label", "avg_prob_top1", "start_time_s", "end_time_s", "duration_s", "start_time_abs", "end_time_abs", "rf_offset_hz", "rf_center_hz_abs", "bandwidth_hz", "snr_db"]


@dataclass(frozen=True)
class Settings:
    """The surveyed defaults. vad_db sets a fixed threshold; None takes the automatic one."""

    seg_s: float = 10.0
    overlap_s: float = 0.0
    start_s: float = 0.0
    limit: int = 0
    channels: int = 14
    crop: int = 16_384
    stride: int = 8_192
    vad_size: int = 4096
    vad_stride: int = 2048
    vad_db: float | None = -35.0
    hang_db: float = 3.0
    min_ms: float = 60.0
    merge_ms: float = 60.0
    group_ms: float = 60.0
    quantile: float = 0.98
    margin_db: float = 6.0
    smooth_ms: float = 0.54
    envelope: bool = False
    vad_down: int = 1
    unknown: float = 0.0
    nfft: int = 4096
    hop: int = 1024
    max_frames: int | None = 8192
    preview_hz: float | None = 2e6
    whole_chunks: bool = False  # a chunk without segments counts as one
    block_frames: int = BLOCK_FRAMES


#: What a deployment sets otherwise than the defaults.
PRESETS = {"standard": Settings(), "hybrid": Settings(seg_s=2.0), "industrial": Settings(seg_s=1.0, limit=60)}


def _step(fs_hz: float, s: Settings) -> int:
    return max(1, round(fs_hz / s.preview_hz)) if s.preview_hz and fs_hz > s.preview_hz else 1


def halo(fs_hz: float, s: Settings = Settings()) -> tuple[int, int]:
    """The widest halo that a step of infer takes: samples before a block, and behind it."""
    win, later = iv.smoothing(fs_hz, s.vad_down, s.smooth_ms) if s.vad_db is None else (1, 0)
    return max(1, (win - 1 - later) * s.vad_down), max(later * s.vad_down, s.vad_size - 1, s.nfft * _step(fs_hz, s), s.crop - 1)


def voice(blocks: DataFrame, chunks: DataFrame, fs_hz: float, s: Settings, known: iv.Extent | None = None) -> tuple[DataFrame, DataFrame]:
    """(scaled chunks, segments): segments(file_id, segment_id, chunk_id, start_sample, end_sample, chunk_start, fs_hz)."""
    scaled = chunks.join(iv.robust_scale(blocks, chunks, s.block_frames, known), list(iv.KEYS)).persist()
    energies = iv.frame_energies(blocks, scaled, s.vad_size, s.vad_stride, s.block_frames, known)
    if s.vad_db is None:
        thr = iv.auto_threshold(blocks, scaled, fs_hz, s.vad_down, s.smooth_ms, s.quantile, s.margin_db, s.envelope, s.block_frames, known)
        found = iv.voice_segments(energies.join(thr, list(iv.KEYS)), F.col("threshold_db"), s.hang_db, s.min_ms, s.merge_ms, s.vad_size)
    else:
        found = iv.voice_segments(energies, s.vad_db, s.hang_db, s.min_ms, s.merge_ms, s.vad_size)
    placed = chunks.select(*iv.KEYS, F.col("start_sample").alias("chunk_start"), F.col("end_sample").alias("chunk_end"))
    if s.whole_chunks:
        rates = blocks.groupBy("file_id").agg(F.first("fs_hz").alias("rate"))
        found = placed.join(found, list(iv.KEYS), "left").join(rates, "file_id")
        found = found.withColumns({"start": F.coalesce("start", F.lit(0).cast("long")), "stop": F.coalesce("stop", F.col("chunk_end") - F.col("chunk_start")), "fs_hz": F.coalesce("fs_hz", "rate")}).drop("rate")
    else:
        found = found.join(placed, list(iv.KEYS))
    order = Window.partitionBy("file_id").orderBy("interval_id", "start")
    rows = found.select("file_id", (F.row_number().over(order) - 1).cast("long").alias("segment_id"), F.col("interval_id").alias("chunk_id"), (F.col("chunk_start") + F.col("start")).alias("start_sample"), (F.col("chunk_start") + F.col("stop")).cast("long").alias("end_sample"), "chunk_start", "fs_hz")
    return scaled, rows


def as_intervals(segments: DataFrame) -> DataFrame:
    return segments.select("file_id", F.col("segment_id").alias("interval_id"), "start_sample", "end_sample")


def frame_logits(frames: DataFrame, classifier: Callable[[np.ndarray], np.ndarray], channels: int) -> DataFrame:
    """model_frames' rows -> (file_id, interval_id, at, fs_hz, logits array): standardised frames through the classifier.

    classifier: (batch, channels, length) -> (batch, classes), called on Arrow batches.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["x"].to_list()).reshape(len(batch), channels, -1).astype(np.float64)
            x = (x - x.mean(axis=2, keepdims=True)) / np.maximum(x.std(axis=2, ddof=1, keepdims=True), 1e-6)
            yield batch.drop(columns="x").assign(logits=list(np.asarray(classifier(x), np.float64)))

    return frames.select("file_id", "interval_id", "at", "fs_hz", "x").mapInPandas(run, "file_id string, interval_id long, at long, fs_hz double, logits array<double>")


def _label(idx, labels: list[str]):
    fallback = F.concat(F.lit("class_"), idx.cast("string"))
    return F.coalesce(F.get(F.array(*map(F.lit, labels)), idx), fallback) if labels else fallback


def frame_predictions(logits: DataFrame, segments: DataFrame, labels: list[str]) -> DataFrame:
    """A row a frame: (file_id, segment_id, frame_start_sample, frame_start_time_s, top1_idx, top1_label, top1_prob)."""
    top = F.array_max("logits")
    idx = (F.array_position("logits", top) - 1).cast("int")
    prob = 1 / F.aggregate(F.transform("logits", lambda z: F.exp(z - top)), F.lit(0.0), lambda a, b: a + b)
    rows = logits.join(segments.select("file_id", F.col("segment_id").alias("interval_id"), "start_sample"), list(iv.KEYS))
    start = F.col("start_sample") + F.col("at")
    return rows.select("file_id", F.col("interval_id").alias("segment_id"), start.alias("frame_start_sample"), (start / F.col("fs_hz")).alias("frame_start_time_s"), idx.alias("top1_idx"), _label(idx, labels).alias("top1_label"), prob.alias("top1_prob"))


def segment_rows(segments: DataFrame, logits: DataFrame, metrics: DataFrame, labels: list[str], unknown: float = 0.0) -> DataFrame:
    """The segments with mean-logit labels and radio metrics, rounded as they are reported."""
    mean = logits.select(*iv.KEYS, F.posexplode("logits").alias("idx", "z")).groupBy(*iv.KEYS, "idx").agg(F.avg("z").alias("z"))
    each = mean.groupBy(*iv.KEYS).agg(F.max("z").alias("top"), F.max_by("idx", F.struct("z", -F.col("idx"))).alias("pred_idx"), F.collect_list("z").alias("zs"))
    prob = 1 / F.aggregate(F.transform("zs", lambda z: F.exp(z - F.col("top"))), F.lit(0.0), lambda a, b: a + b)
    rows = segments.withColumnRenamed("segment_id", "interval_id").join(each, list(iv.KEYS)).join(metrics, list(iv.KEYS)).withColumn("prob", prob)
    t0, t1 = F.col("start_sample") / F.col("fs_hz"), F.col("end_sample") / F.col("fs_hz")
    rows = rows.withColumns({"segment_id": F.col("interval_id"), "start_time_s": F.round(t0, 6), "end_time_s": F.round(t1, 6), "duration_s": F.round(t1 - t0, 6), "pred_label": F.when((F.lit(unknown) > 0) & (F.col("prob") < unknown), "UNKNOWN").otherwise(_label(F.col("pred_idx"), labels)), "prob_top1": F.round("prob", 6)})
    return rows.withColumns({"rf_offset_hz": F.round("rf_offset_hz", 1), "bandwidth_hz": F.round("bandwidth_hz", 1), "snr_db": F.round("snr_db", 2)}).select(*SEGMENT)


def bursts(segments: DataFrame, group_s: float = 0.06) -> DataFrame:
    """Segments of one label with gaps up to group_s seconds, in order of start; an unknown one stands alone.

    Windows run over segments of a file. Offset: weighted by duration; bandwidth: the widest; SNR: the median.
    """
    order = Window.partitionBy("file_id").orderBy("start_time_s", "segment_id")
    same = (F.col("pred_label") == F.lag("pred_label").over(order)) & (F.col("pred_label") != "UNKNOWN")
    run = segments.withColumn("turn", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("turn").over(order))
    reach = F.max("end_time_s").over(Window.partitionBy("file_id", "run").orderBy("start_time_s", "segment_id").rowsBetween(Window.unboundedPreceding, -1))
    opens = run.withColumn("opens", F.when(reach.isNull() | (F.col("start_time_s") - reach > group_s), 1).otherwise(0))
    rows = opens.withColumn("burst_id", (F.sum("opens").over(order) - 1).cast("long"))
    w = F.col("end_time_s") - F.col("start_time_s")
    offset = F.when(F.count("*") == 1, F.first("rf_offset_hz")).when(F.sum(w) > 0, F.sum(F.col("rf_offset_hz") * w) / F.sum(w))
    return rows.groupBy("file_id", "burst_id").agg(
        F.min_by("pred_label", F.struct("start_time_s", "segment_id")).alias("pred_label"), F.round(F.avg("prob_top1"), 6).alias("avg_prob_top1"), F.min("start_time_s").alias("start_time_s"), F.max("end_time_s").alias("end_time_s"),
        F.round(F.max("end_time_s") - F.min("start_time_s"), 6).alias("duration_s"), offset.alias("rf_offset_hz"), F.max("bandwidth_hz").alias("bandwidth_hz"), F.percentile("snr_db", F.lit(0.5)).alias("snr_db"),
    )


def predictions(bursts: DataFrame, rf_center_hz: float | None = None, recording_start: str | None = None) -> DataFrame:
    """(file, file_id, and the reported columns): absolute centre frequency and ISO 8601 times, null where not known.

    recording_start: ISO 8601 with Z, an offset or none; times keep that offset. One that cannot be read counts as none.
    """
    zone, local = "", None
    if recording_start:
        m = re.fullmatch(r"(\d{4}-\d\d-\d\d)(?:[T ](\d\d:\d\d(?::\d\d(?:\.\d{1,6})?)?))?(Z|[+-]\d\d:\d\d)?", recording_start.strip())
        if m:
            local, zone = f"{m[1]} {m[2] or '00:00:00'}", "+00:00" if m[3] == "Z" else m[3] or ""

    def absolute(seconds: str):
        if local is None:
            return F.lit(None).cast("string")
        micros = F.round(F.col(seconds) * 1e6).cast("long")
        at = F.to_timestamp_ntz(F.lit(local)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), micros / F.lit(1_000_000).cast("decimal(18,6)"))
        text = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit(zone))

    center = F.round(F.lit(rf_center_hz) + F.coalesce("rf_offset_hz", F.lit(0.0)), 1) if rf_center_hz is not None else F.lit(None).cast("double")
    out = bursts.withColumns({"start_time_abs": absolute("start_time_s"), "end_time_abs": absolute("end_time_s"), "rf_center_hz_abs": center, "file": F.regexp_extract("file_id", r"[^/]*$", 0)})
    return out.select("file", "file_id", *PREDICTION)


@dataclass
class Result:
    segments: DataFrame
    frames: DataFrame
    bursts: DataFrame
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Free what is kept between the tables: a row a segment and a row a frame, made again where an executor is lost."""
        for df in self.kept:
            df.unpersist()


def infer(blocks: DataFrame, classifier: Callable[[np.ndarray], np.ndarray], labels: list[str], fs_hz: float, settings: Settings = Settings(), files: DataFrame | None = None) -> Result:
    """The whole plan over captures of one rate; classifier as in frame_logits. files(file_id, frames, fs_hz) as headers
    have them (sources.captures.metadata) save a read of the blocks."""
    s = settings
    files = lengths(blocks) if files is None else files.select("file_id", "frames", "fs_hz")
    chunks = iv.chunk_plan(files, s.seg_s, s.overlap_s, s.start_s, s.limit).persist()
    scaled_chunks, segments = voice(blocks, chunks, fs_hz, s, iv.extent(chunks, s.block_frames))
    segments = segments.persist()
    spans = as_intervals(segments)
    known = iv.extent(spans, s.block_frames)
    metrics = iv.radio_metrics(iv.spectra(blocks, spans, s.nfft, s.hop, s.max_frames, _step(fs_hz, s), s.block_frames, known))
    scaled = spans.join(iv.robust_scale(blocks, spans, s.block_frames, known), list(iv.KEYS))
    logits = frame_logits(iv.model_frames(blocks, scaled, s.channels, s.crop, s.stride, s.block_frames, known), classifier, s.channels).persist()
    rows = segment_rows(segments, logits, metrics, labels, s.unknown)
    return Result(rows, frame_predictions(logits, segments, labels), bursts(rows, s.group_ms / 1000), (chunks, scaled_chunks, segments, logits))
