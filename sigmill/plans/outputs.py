"""Result files: CSV, JSON and text as the surveyed steps lay them out, written by Spark as folders of part files.

Words of reports and names of fields are fixed values: readers of the surveyed files look for them.

Every table is partitioned by capture where it has a file_id, and writing it again replaces the partitions of the captures
it holds and no others: a run that was cut short can be repeated. Missing values are empty fields.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import assessment, captures, inference, intervals, irr, qa, wideband
from . import dialect

DOCUMENT = ["channels", "fs_header_hz"]
SLICES = ["slice_idx", "start_sample", "end_sample", "start_s", "end_s", "duration_ms"]
CARRIERS = ["f_center_hz", "p_db", "bw_hz_est", "snr_db_est"]


def capture(file_id: str = "file_id") -> Column:
    """A name for a capture's partition: its file's stem and a checksum of the whole path."""
    stem = F.regexp_replace(F.regexp_extract(file_id, r"([^/]*?)(\.[^./]*)?$", 1), r"[^A-Za-z0-9._-]", "_")
    return F.concat(stem, F.lit("_"), F.lower(F.hex(F.crc32(F.col(file_id).cast("binary")))))


def _write(df: DataFrame, folder: str, form: str) -> None:
    out = df.withColumn("capture", capture())
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture").format(form).save(folder)


def _json(df: DataFrame, folder: str, *columns: str) -> None:
    """One document a row, keys sorted."""
    text = F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})
    _text(df.select("file_id", text.alias("value")), folder)


def _text(df: DataFrame, folder: str) -> None:
    """df(file_id, value) as text by capture."""
    df.withColumn("capture", capture()).select("value", "capture").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture").text(folder)


def _fields(values: dict) -> Column:
    """Parameters as a struct, by name."""
    return F.struct(*(F.lit(v).alias(k) for k, v in sorted(values.items())))


def quality(stats: DataFrame, folder: str, short_s: float | None = None, files: DataFrame | None = None, **params) -> None:
    """assessment.statistics' rows as sorted JSON (stats) and as a text report (report).

    files(file_id, channels, fs_header_hz), as sources.captures.metadata has them, and params (fft_size, chunk_frames,
    memory_mb, ...) become fields of the document: what the header says and how the samples were read.
    """
    rows = assessment.assess(stats, short_s)
    rows = rows.join(files.select("file_id", *DOCUMENT), "file_id", "left") if files is not None else rows.withColumns({"channels": F.lit(None).cast("int"), "fs_header_hz": F.lit(None).cast("double")})
    rows = rows.withColumns({
        "input_file": F.col("file_id"), "fs_used_hz": F.col("fs_hz"), "file_duration_s": F.col("duration_s"), "covered_duration_s": F.col("duration_s"), "coverage_fraction": F.lit(1.0),
        "analysis_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), "sampling_strategy": F.lit("stream_full"), "analysis_params": _fields({"passes": 2} | params),
    })
    nested = rows.withColumn("quality_assessment", F.struct("quality_score", "warnings", "issues", "recommendations"))
    names = [c for c in nested.columns if c not in ("quality_score", "warnings", "issues", "recommendations", "verdict")]
    _json(nested, f"{folder}/stats", *names)
    line = lambda form, *cols: F.format_string(form, *cols)
    rule, empty = F.lit("-" * 20), F.lit("")
    head = [
        F.lit("I/Q Data Sanity Check Report"), F.lit("=" * 50), empty, line("Input File: %s", "file_id"), line("Quality Score: %.1f/100", "quality_score"), empty,
        F.lit("File Characteristics:"), rule, line("File duration: %.3f seconds", "duration_s"), line("Samples analyzed: %,d", "frames"), line("Sample Rate (used): %,.0f Hz", "fs_hz"), empty,
        F.lit("Data Quality:"), rule, line("NaN values: %d", "nan_count"), line("Infinite values: %d", "inf_count"), line("I channel clipping: %.2f%%", "i_clip_pct"), line("Q channel clipping: %.2f%%", "q_clip_pct"), empty,
        F.lit("I/Q Balance Analysis:"), rule, line("Best convention: %s", "best_convention"), line("Best IRR: %.2f dB", "best_irr_db"), line("Envelope kurtosis: %.2f", "envelope_kurtosis"), empty,
    ]

    def part(title: str, mark: str, column: str) -> Column:
        lines = F.transform(column, lambda x: F.concat(F.lit(f"[{mark}] "), x))
        return F.when(F.size(column) > 0, F.concat(F.array(F.lit(title), rule), lines, F.array(empty))).otherwise(F.array().cast("array<string>"))

    ok = F.when((F.size("issues") == 0) & (F.size("warnings") == 0), F.array(F.lit("[OK] No significant issues detected!"))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(F.array(*head), part("Issues Found:", "ERROR", "issues"), part("Warnings:", "WARNING", "warnings"), part("Recommendations:", "SUGGESTION", "recommendations"), ok)
    _text(rows.select("file_id", F.array_join(lines, "\n").alias("value")), f"{folder}/report")


def carriers(found: DataFrame, folder: str) -> None:
    _csv(found.withColumnsRenamed({"bw_hz": "bw_hz_est", "snr_db": "snr_db_est"}), folder, *CARRIERS)


def _csv(df: DataFrame, folder: str, *columns: str) -> None:
    out = df.select(*columns, capture().alias("capture"))
    out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", header="true", emptyValue="").partitionBy("capture").csv(folder)


def spectrum(files: DataFrame, psd: DataFrame, found: DataFrame, mask: DataFrame, folder: str, nperseg: int, overlap: float = 0.5, prominence_db: float = 8.0, cfar_k: float = 3.0, cfar_guard: int = 1, cfar_train: int = 6, max_columns: int | None = None, compared: DataFrame | None = None) -> None:
    """carriers, time_activity, occupancy (a table where the surveyed scripts plot) and a JSON summary by capture.

    The summary has structs for the detector's parameters (cfar), for what of the samples went in (optimization: all of
    them, the waterfall's columns thinned to max_columns) and, with irr.comparison's rows, for image rejection before and
    after (irr_analysis, null without).
    """
    carriers(found, f"{folder}/carriers")
    _csv(wideband.time_activity(mask), f"{folder}/time_activity", "time_s", "activity")
    _csv(wideband.occupancy(mask), f"{folder}/occupancy", "f_idx", "occupancy")
    counts = found.groupBy("file_id").agg(F.count("*").alias("num_carriers"))
    shapes = mask.groupBy("file_id").agg(F.max(F.size("mask")).cast("long").alias("height"), F.count("*").alias("width"))
    names = ["conv_applied", "corrected_irr_db", "step1_irr_db", "step1_convention", "irr_improvement_db", "verdict", "band"]
    if compared is None:
        kinds = ["string" if n in ("conv_applied", "step1_convention", "verdict", "band") else "double" for n in names]
        compared = files.select("file_id", F.lit(None).cast("struct<" + ", ".join(f"{n}: {k}" for n, k in zip(names, kinds, strict=True)) + ">").alias("irr_analysis"))
    else:
        compared = compared.select("file_id", F.struct(*names).alias("irr_analysis"))
    header = F.col("fs_header_hz") if "fs_header_hz" in files.columns else F.lit(None).cast("double")
    rows = files.join(captures.noise_floor(psd), "file_id", "left").join(counts, "file_id", "left").join(shapes, "file_id", "left").join(compared, "file_id", "left")
    length = F.col("frames") / F.col("fs_hz")
    fields = {
        "wav": F.col("file_id"), "fs_header_hz": header, "fs_used_hz": F.col("fs_hz"), "original_fs_hz": F.col("fs_hz"), "duration_s": length, "original_duration_s": length, "samples_processed": F.col("frames"), "original_samples": F.col("frames"),
        "nperseg": F.lit(nperseg), "overlap": F.lit(overlap), "num_carriers": F.coalesce("num_carriers", F.lit(0)), "prom_db": F.lit(prominence_db), "cfar": _fields({"k": cfar_k, "guard": cfar_guard, "train": cfar_train}),
        "optimization": F.struct(F.lit(False).alias("used_sampling"), F.lit(1.0).alias("reduction_factor"), F.lit(max_columns).cast("int").alias("max_columns"), F.array("height", "width").alias("waterfall_shape")),
    }
    _json(rows.withColumns(fields), f"{folder}/summary", *fields, "noise_floor_db", "irr_analysis")


def slices(files: DataFrame, found: DataFrame, folder: str, **params) -> None:
    """slices as CSV, and their parameters and number by capture as JSON."""
    _csv(found, f"{folder}/slices", *SLICES)
    counts = found.groupBy("file_id").agg(F.count("*").alias("num_slices"))
    rows = files.join(counts, "file_id", "left").select(F.col("file_id").alias("wav"), "file_id", "fs_hz", "frames", (F.col("frames") / F.col("fs_hz")).alias("duration_s"), _fields(params).alias("params"), F.coalesce("num_slices", F.lit(0)).alias("num_slices"))
    _json(rows, f"{folder}/slices_meta", "wav", "fs_hz", "frames", "duration_s", "params", "num_slices")


def clips(found: DataFrame, carriers: DataFrame, folder: str) -> None:
    """extraction.numbered clips as Parquet, and what they are cut from as JSON lines."""
    about = found.join(carriers.select("file_id", "carrier_index", "f_center_hz", "bw_hz"), ["file_id", "carrier_index"])
    about = about.select("file_id", "clip_index", "carrier_index", F.col("f_center_hz").alias("f_center_hz_rel"), F.col("bw_hz").alias("bw_hz_est"), F.col("fs_hz").alias("fs_dec_hz"), "decim", "t0_s", "t1_s", F.array("place", F.col("place") + F.size("i")).alias("source_span_dec"))
    _write(found.select("file_id", "clip_index", "carrier_index", "i", "q", "y"), f"{folder}/clips", "parquet")
    _write(about, f"{folder}/meta", "json")


def features(found: DataFrame, folder: str) -> None:
    """features.clip_features' rows as CSV: by capture where clips have a file_id, else one table for all clips."""
    if "file_id" in found.columns:
        _csv(found, folder, *(c for c in found.columns if c != "file_id"))
    else:
        found.write.mode("overwrite").option("header", "true").csv(folder)


def engineered(found: DataFrame, folder: str) -> None:
    """features.engineered's rows with a file_id: x (clip_index, y, X as an array a channel) as Parquet and, by capture, the
    channels' names in X's order as JSON. A capture whose clips differ in their channels has a document for each list."""
    names = F.transform("channels", lambda c: c["name"])
    _write(found.select("file_id", "clip_index", "y", F.transform("channels", lambda c: c["values"]).alias("X")), f"{folder}/x", "parquet")
    lists = found.where(F.size("channels") > 0).groupBy("file_id", names.alias("channels")).agg(F.count("*").alias("clips"))
    _json(lists, f"{folder}/channels", "channels", "clips")


def inference_tables(result: inference.Result, files: DataFrame, folder: str, settings: inference.Settings, labels: list[str], rf_center_hz: float | None = None, recording_start: str | None = None) -> None:
    """frames and predictions by capture, consolidated_predictions where there is any burst, and run_info."""
    rows = inference.predictions(result.bursts, rf_center_hz, recording_start)
    _csv(result.frames, f"{folder}/frames", "segment_id", "frame_start_sample", "frame_start_time_s", "top1_idx", "top1_label", "top1_prob")
    _csv(rows, f"{folder}/predictions", *inference.PREDICTION)
    if not rows.isEmpty():
        rows.select("file", *inference.PREDICTION).write.mode("overwrite").option("header", "true").csv(f"{folder}/consolidated_predictions")
    plan = intervals.chunk_plan(files, settings.seg_s, settings.overlap_s, settings.start_s, settings.limit).groupBy("file_id").agg(F.count("*").alias("chunks"))
    info = {k: v for k, v in asdict(settings).items() if v is not None}
    about = files.join(plan, "file_id", "left").withColumns({"source": F.col("file_id"), "sample_rate_hz": F.col("fs_hz"), "duration_s": F.col("frames") / F.col("fs_hz"), "labels_count": F.lit(len(labels)), "settings": _fields(info)})
    _json(about, f"{folder}/run_info", "source", "sample_rate_hz", "duration_s", "chunks", "labels_count", "settings")


def qa_tables(detections: DataFrame, features: DataFrame, folder: str, conf: float = qa.CONF, dominance: float = qa.DOMINANCE) -> None:
    """Clean and doubtful carriers, conflicts, clips of low confidence, and a summary in words."""
    names = {"carrier": "carrier_index", "f0": "f_center_hz_rel_med", "bw": "bw_hz_med", "n_clips": "clips", "dominant": "dominant_mod", "share": "dominant_share", "dominant_conf": "dominant_conf_mean", "breakdown": "class_breakdown"}
    texts = {"carriers_clean": qa.carriers(False, conf, dominance), "carriers_review": qa.carriers(True, conf, dominance), "carrier_conflicts": qa.conflicts(conf, dominance), "clips_low_conf": qa.low_confidence(conf)}
    for name, sql in texts.items():
        rows = dialect.run(sql, detections=detections, features=features).withColumnsRenamed(names if name != "clips_low_conf" else {"pred_name": "pred"})
        rows.write.mode("overwrite").options(header="true", emptyValue="").csv(f"{folder}/{name}")
    total = dialect.run(qa.summary(conf, dominance), detections=detections)
    lines = [("Total clips: %d", "clips"), (f"Low-conf clips (<{conf:.2f}): %d", "low_conf"), ("Total carriers: %d", "carriers"), ("Carriers to review: %d", "to_review")]
    total.select(F.concat_ws("\n", *(F.format_string(t, c) for t, c in lines), F.lit("Heuristics: low dominance or low mean confidence -> review."))).write.mode("overwrite").text(f"{folder}/qa_summary")


def index(progress: DataFrame, folder: str) -> None:
    """An HTML page a capture links its results from: one row each, in order of name."""
    safe = F.replace(F.replace(F.replace("file_id", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    row = F.concat(F.lit("<tr><td>"), safe, F.lit("</td><td>"), "status", F.lit('</td><td><a href="stats/capture='), capture(), F.lit('">results</a></td></tr>'))
    spark = progress.sparkSession
    ends = spark.createDataFrame([(0, "", "<html><body><table><tr><th>Capture</th><th>Status</th><th></th></tr>"), (2, "", "</table></body></html>")], "part int, file_id string, value string")
    lines = ends.unionByName(progress.select(F.lit(1).alias("part"), "file_id", row.alias("value")))
    # lines are sorted and written one after the other: no row holds all captures
    lines.coalesce(1).sortWithinPartitions("part", "file_id").select("value").write.mode("overwrite").text(folder)


def batch_summary(progress: DataFrame, folder: str, started: float, ended: float) -> None:
    """batch_summary: counts, success rate and times of a batch as one JSON document, started and ended as Unix seconds.

    The names of completed and failed captures, a line each, are tables beside it (completed_list, failed_list).
    """
    done, bad = (F.count_if(F.col("status") == s) for s in ("completed", "failed"))
    hours, total = F.lit(max(0.0, ended - started) / 3600), done + bad
    clock = lambda s: F.date_format(F.timestamp_seconds(F.lit(float(s))), "yyyy-MM-dd HH:mm:ss")
    fields = {
        "batch_start_time": clock(started), "last_update": clock(ended), "elapsed_hours": hours, "completed_files": done, "failed_files": bad, "total_processed": total,
        "success_rate": F.when(total > 0, done / total).otherwise(0.0), "avg_time_per_file_hours": F.when(total > 0, hours / total).otherwise(0.0), "total_duration_s": F.coalesce(F.sum("duration_s"), F.lit(0.0)),
    }
    one = progress.agg(*(v.alias(k) for k, v in sorted(fields.items())))
    one.write.mode("overwrite").json(f"{folder}/batch_summary")
    for status in ("completed", "failed"):
        progress.where(F.col("status") == status).select("file_id").write.mode("overwrite").text(f"{folder}/{status}_list")


def burst_spectrograms(blocks: DataFrame, spans: DataFrame, nfft: int = 2048, hop: int = 256, block_frames: int = intervals.BLOCK_FRAMES) -> DataFrame:
    """(file_id, interval_id, at, db array): magnitudes of the i channel by frame, instead of an image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, lead, own, at in intervals.pieces(r, 0, nfft - 1):
                    total = w["e"] - w["s"]
                    padded = max(nfft, total + -(total - nfft) % hop) if total >= nfft else nfft
                    starts = intervals.frame_starts(padded, at, own, nfft, hop)
                    for s in starts.tolist():
                        part = x.real[s - at + lead : s - at + lead + nfft]
                        db = kernels.spectrogram_db(part, nfft, nfft)[0]
                        yield pd.DataFrame({"file_id": [r.file_id], "interval_id": [w["interval_id"]], "at": [s], "db": [db.astype(np.float32)]})

    return intervals.of_blocks(blocks, spans, block_frames, after=nfft - 1).mapInPandas(run, "file_id string, interval_id long, at long, db array<float>")


def carrier_spectra(streams: DataFrame, nperseg: int = 2048) -> DataFrame:
    """Welch's rows of each carrier's stream (extraction.downmix), by file_id and carrier_index."""
    rows = streams.select(F.concat("file_id", F.lit("#"), "carrier_index").alias("file_id"), "block_id", F.col("start_out").alias("start_sample"), F.size("i").alias("n"), "fs_hz", "i", "q")
    out = captures.welch(rows, nperseg, nperseg // 2)
    return out.withColumns({"carrier_index": F.regexp_extract("file_id", r"#(\d+)$", 1).cast("long"), "file_id": F.regexp_replace("file_id", r"#\d+$", "")})
