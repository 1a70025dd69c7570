"""Tables that stand beside captures: clips and their metadata, carriers, detections, labels, and synthetic captures."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .captures import BLOCK_FRAMES, BLOCKS, CHUNK_FRAMES

CLIPS = "clip_index long, carrier_index long, i array<float>, q array<float>, y int"
CLIP_META = """file string, fs_used_hz double, duration_s double, clips array<struct<clip_index: bigint, carrier_index: bigint, f_center_hz_rel: double, bw_hz_est: double,
    fs_dec_hz: double, decim: bigint, t0_s: double, t1_s: double, source_span_dec: array<bigint>>>"""
CARRIERS = "f_center_hz double, p_db double, bw_hz_est double, snr_db_est double"
DETECTIONS = "clip_index long, pred_name string, confidence double, carrier_index long, f_center_hz_rel double, bw_hz_est double"
FEATURES = "clip_index long, fs_hz double, T int, snr_db double, bw_hz double, sfm double, env_kurt double, c20_r double, c20_i double, c40_r double, c40_i double, c41_r double, c41_i double, c42_r double, c42_i double, cfo_hz double"


def clips(spark: SparkSession, path: str) -> DataFrame:
    """Clips as Parquet, two arrays a row."""
    return spark.read.schema(CLIPS).parquet(path)


def clip_meta(spark: SparkSession, path: str) -> DataFrame:
    """A row a clip of a JSON document whose list `clips` describes them, with the file's fs_used_hz and duration_s."""
    return spark.read.schema(CLIP_META).json(path, multiLine=True).select("file", "fs_used_hz", "duration_s", F.explode_outer("clips").alias("c")).select("file", "fs_used_hz", "duration_s", "c.*")


def clip_rates(clips: DataFrame, meta: DataFrame, fs_hz: float | None = None) -> DataFrame:
    """clips with fs_hz: a fixed one, else the clip's own, else its recording's, else 1. Of repeated numbers the largest rate.

    Clips with a column `file` take rates of that recording alone; without one, clips are taken to be of one recording.
    """
    if fs_hz is not None:
        return clips.withColumn("fs_hz", F.lit(float(fs_hz)))
    by = ["file"] if "file" in clips.columns else []
    own = meta.where("clip_index IS NOT NULL").groupBy(*by, "clip_index").agg(F.max("fs_dec_hz").alias("own_hz"))
    whole = meta.groupBy(*by).agg(F.max("fs_used_hz").alias("whole_hz"))
    out = clips.join(own, [*by, "clip_index"], "left")
    out = out.join(whole, by, "left") if by else out.crossJoin(F.broadcast(whole))  # one row
    return out.withColumn("fs_hz", F.coalesce("own_hz", "whole_hz", F.lit(1.0))).drop("own_hz", "whole_hz")


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header, by a declared schema; empty fields are null."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def carriers(spark: SparkSession, path: str) -> DataFrame:
    """Carriers as written by a spectrum step; a missing level is 0 dB."""
    return csv_rows(spark, path, CARRIERS).withColumn("p_db", F.coalesce("p_db", F.lit(0.0)))


def detections(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, DETECTIONS)


def latest(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """The most recently changed file below a folder whose name fits; of equally recent ones the last by name."""
    listed = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup="true").load(folder)
    return listed.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def labels(spark: SparkSession, path: str) -> DataFrame:
    """(idx, label) of a JSON list, or of a document's kept_class_names or labels."""
    text = spark.read.text(path, wholetext=True).first()
    found = json.loads(text[0]) if text else []
    if isinstance(found, dict):
        found = found.get("kept_class_names") or found.get("labels") or []
    return spark.createDataFrame([(k, str(x)) for k, x in enumerate(found)], "idx int, label string")


def synthetic(spark: SparkSession, seconds: float, fs_hz: float = 20e6, carriers: int = 5, seed: int = 0, noise: float = 1e-4, block_frames: int = BLOCK_FRAMES, chunk_frames: int = CHUNK_FRAMES, file_id: str = "synthetic") -> DataFrame:
    """Blocks of white noise and AM carriers spread over the band: the same samples for the same seed, whatever the partitions.

    Carrier k: (k - carriers // 2) * fs / (carriers + 2) Hz, amplitude 0.1 * U(0.5, 1.5), depth 0.3 at 1000 + 500 k Hz.
    """
    total = int(seconds * fs_hz)
    rng = np.random.default_rng(seed)
    amps, phases = 0.1 * rng.uniform(0.5, 1.5, carriers), rng.uniform(0, 2 * np.pi, carriers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch["id"].tolist():
                start = b * block_frames
                n = start + np.arange(min(block_frames, total - start))
                own = np.random.default_rng([seed, b])
                x = (own.normal(size=len(n)) + 1j * own.normal(size=len(n))) * np.sqrt(noise / 2)
                for k, (a, p) in enumerate(zip(amps, phases, strict=True)):
                    turns = (k - carriers // 2) / (carriers + 2) * n
                    x += a * (1 + 0.3 * np.sin(2 * np.pi * (1000 + 500 * k) / fs_hz * n)) * np.exp(1j * (2 * np.pi * (turns % 1) + p))
                yield pd.DataFrame({"file_id": [file_id], "chunk_id": [start // chunk_frames], "block_id": [b], "start_sample": [start], "n": [len(n)], "fs_hz": [float(fs_hz)], "i": [x.real.astype(np.float32)], "q": [x.imag.astype(np.float32)]})

    blocks = -(-total // block_frames)
    return spark.range(0, blocks, 1, max(1, min(blocks, 10_000))).mapInPandas(run, BLOCKS)
