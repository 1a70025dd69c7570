"""Frames, energies, thresholds and spectra within intervals of captures: chunks, voice segments, slices.

Intervals (file_id, interval_id, start_sample, end_sample) meet the blocks they touch by an equi-join; a block takes the
list of its intervals, so its samples are never copied. A frame belongs to the block that holds its first sample and
takes the rest from the block's halo. What leaves the tasks is a row a frame, or a few sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..sources.captures import BLOCK_FRAMES
from .captures import samples_of, with_halo

KEYS = ("file_id", "interval_id")
#: A table of scales or thresholds up to so many rows, counted first, is broadcast.
BROADCAST_ROWS = 100_000
#: The same for the lists of intervals by block, of some 50 bytes an interval and block.
BROADCAST_TOUCHED = 1_000_000
#: Intervals of up to so many samples have their quantiles from one row of all values.
ROW_VALUES = 1 << 20
#: Frames for a model leave a task in batches of so many bytes, or those of a block.
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Extent:
    """Of a table of intervals: the longest, in samples, and how many pairs of an interval and a block that it touches."""

    longest: int
    touched: int


def extent(intervals: DataFrame, block_frames: int = BLOCK_FRAMES) -> Extent:
    """Reads the table; the steps that are told take neither a shuffle of blocks nor a second pass where they need none."""
    touched = F.expr(f"(end_sample - 1) div {block_frames} - start_sample div {block_frames} + 1")
    r = intervals.where("end_sample > start_sample").agg(F.max(F.col("end_sample") - F.col("start_sample")), F.sum(touched)).first()
    return Extent(r[0] or 0, r[1] or 0)


def chunk_plan(files: DataFrame, seg_s: float = 10.0, overlap_s: float = 0.0, start_s: float = 0.0, limit: int = 0) -> DataFrame:
    """files(file_id, frames, fs_hz) -> intervals of seg_s seconds that overlap, from start_s on; `limit` of them if above 0.

    An overlap as long as the segment counts as none. A file that ends before start_s has no chunks.
    """
    count = lambda s: F.round(F.col("fs_hz") * s).cast("long")
    seg, lap, first = count(seg_s), count(overlap_s), F.greatest(F.lit(0), count(start_s))
    hop = seg - F.when(lap >= seg, 0).otherwise(lap)
    rest = F.col("frames") - first
    n = (F.ceil(F.greatest(F.lit(0), rest - seg) / hop) + 1).cast("long")
    n = F.least(n, F.lit(limit)) if limit > 0 else n
    plan = files.where(rest > 0).select("file_id", "fs_hz", "frames", seg.alias("seg"), hop.alias("hop"), first.alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("interval_id"))
    start = F.col("first") + F.col("interval_id") * F.col("hop")
    return plan.select("file_id", "interval_id", start.alias("start_sample"), F.least(start + F.col("seg"), F.col("frames")).alias("end_sample"))


def evenly_spaced(files: DataFrame, segments: int = 10, seconds: float = 5.0) -> DataFrame:
    """files(file_id, frames, fs_hz) -> so many intervals of equal length spread over each file; none of a shorter file."""
    length = F.floor(F.col("fs_hz") * seconds).cast("long")
    step = F.greatest(F.lit(1), F.floor((F.col("frames") - length) / max(1, segments - 1)))
    rows = files.where(F.col("frames") >= length).select("file_id", "frames", length.alias("length"), step.alias("step"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))).alias("interval_id"))
    start = F.least(F.col("interval_id") * F.col("step"), F.col("frames") - F.col("length"))
    return rows.select("file_id", "interval_id", start.alias("start_sample"), (start + F.col("length")).alias("end_sample"))


def of_blocks(blocks: DataFrame, intervals: DataFrame, block_frames: int = BLOCK_FRAMES, before: int = 0, after: int = 0, more: tuple[str, ...] = (), known: Extent | None = None) -> DataFrame:
    """Blocks with `wanted`, the list of intervals that touch them, and the halo asked for. Lists known to be few are broadcast."""
    touched = F.sequence(F.expr(f"start_sample div {block_frames}"), F.expr(f"(end_sample - 1) div {block_frames}"))
    rows = intervals.where("end_sample > start_sample").select("file_id", F.explode(touched).alias("block_id"), F.struct("interval_id", F.col("start_sample").alias("s"), F.col("end_sample").alias("e"), *more).alias("w"))
    wanted = rows.groupBy("file_id", "block_id").agg(F.collect_list("w").alias("wanted"))
    wanted = F.broadcast(wanted) if known and known.touched <= BROADCAST_TOUCHED else wanted
    return with_halo(blocks, "start_sample", "n", "fs_hz", "i", "q", before=before, after=after).join(wanted, ["file_id", "block_id"])


def pieces(r, before: int = 0, after: int = 0) -> Iterator[tuple]:
    """Of a row of of_blocks: (interval, samples, lead, own, at) for each interval.

    samples: the block's own part of the interval, `lead` samples of the interval before it and up to `after` behind it; at:
    where the own part begins in the interval.
    """
    x, left = samples_of(r, before, after)
    zero, stop = r.start_sample - left, r.start_sample + len(r.i)
    for w in r.wanted:
        low, high = max(w["s"], r.start_sample), min(w["e"], stop)
        if high > low:
            a, b = max(w["s"], low - before, zero), min(w["e"], high + after, zero + len(x))
            yield w, x[a - zero : b - zero], low - a, high - low, low - w["s"]


def frame_starts(total: int, at: int, own: int, size: int, hop: int) -> np.ndarray:
    """Starts, within an interval of total samples, of the frames that begin in its part [at, at + own).

    Whole frames only, but for an interval shorter than a frame, which is one short frame.
    """
    last = max(0, total - size)
    first = -(-at // hop) * hop
    return np.arange(first, min(at + own - 1, last) + 1, hop)


def exact_quantile(parts: DataFrame, keys: tuple[str, ...], q: float) -> DataFrame:
    """parts(*keys, y array of floats >= 0) -> (*keys, n, top, value): the interpolated quantile of all values of a key.

    Two passes over the values, each reduced to counts where they are: by the upper 16 bits of a float, then by the lower
    16 within the one or two upper parts that hold the ranks.
    """
    types = ", ".join(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys)

    def bits(y) -> np.ndarray:
        return np.ascontiguousarray(np.asarray(y, np.float32)).view(np.uint32)

    def upper(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                value, n = np.unique(bits(r.y) >> 16, return_counts=True)
                yield pd.DataFrame({**{k: getattr(r, k) for k in keys}, "hi": value.astype(np.int64), "n": n, "top": float(np.max(r.y, initial=0.0))})

    def lower(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                b = bits(r.y)
                for hi in r.his:
                    value, n = np.unique(b[b >> 16 == hi] & 0xFFFF, return_counts=True)
                    yield pd.DataFrame({**{k: getattr(r, k) for k in keys}, "hi": hi, "lo": value.astype(np.int64), "n": n})

    key, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("hi")
    counts = parts.mapInPandas(upper, f"{types}, hi long, n long, top double").groupBy(*keys, "hi").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    counts = counts.withColumns({"total": F.sum("n").over(key), "top": F.max("top").over(key), "past": F.sum("n").over(order)})
    at = (F.col("total") - 1) * F.lit(float(q))
    ranks = F.array_distinct(F.array(F.floor(at), F.ceil(at)))
    here = F.filter(ranks, lambda x: (x < F.col("past")) & (x >= F.col("past") - F.col("n")))
    # ranks within the upper part that holds them
    found = counts.select(*keys, "hi", "total", "top", F.explode(here).alias("rank"), (F.col("past") - F.col("n")).alias("before")).withColumn("within", F.col("rank") - F.col("before"))
    lists = found.groupBy(*keys).agg(F.collect_set("hi").alias("his"))
    lists = F.broadcast(lists) if lists.count() <= BROADCAST_ROWS else lists
    inner = parts.join(lists, list(keys)).mapInPandas(lower, f"{types}, hi long, lo long, n long").groupBy(*keys, "hi", "lo").agg(F.sum("n").alias("n"))
    inner = inner.withColumn("past", F.sum("n").over(Window.partitionBy(*keys, "hi").orderBy("lo")))
    exact = found.join(inner, [*keys, "hi"]).where((F.col("within") < F.col("past")) & (F.col("within") >= F.col("past") - F.col("n")))

    def floats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            word = (batch["hi"].to_numpy() << 16 | batch["lo"].to_numpy()).astype(np.uint32)
            yield batch.drop(columns=["hi", "lo"]).assign(v=word.view(np.float32).astype(np.float64))

    values = exact.select(*keys, "total", "top", "rank", "hi", "lo").mapInPandas(floats, f"{types}, total long, top double, rank long, v double")
    rows = values.groupBy(*keys).agg(F.first("total").alias("n"), F.first("top").alias("top"), F.min_by("v", "rank").alias("a"), F.max_by("v", "rank").alias("b"), F.min("rank").alias("r"))
    part = (F.col("n") - 1) * F.lit(float(q)) - F.col("r")
    return rows.select(*keys, "n", "top", (F.col("a") + part * (F.col("b") - F.col("a"))).alias("value"))


def gathered_quantile(parts: DataFrame, keys: tuple[str, ...], q: float) -> DataFrame:
    """exact_quantile in one pass: the values of a key are sorted in one row, so they must be few (ROW_VALUES)."""
    whole = parts.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("y"))).alias("y")).where(F.size("y") > 0)
    n, value = F.size("y").cast("long"), lambda rank: F.get("y", rank.cast("int")).cast("double")
    at = (n - 1) * F.lit(float(q))
    a, b = value(F.floor(at)), value(F.ceil(at))
    return whole.select(*keys, n.alias("n"), value(n - 1).alias("top"), (a + (at - F.floor(at)) * (b - a)).alias("value"))


def _quantile(parts: DataFrame, q: float, known: Extent | None) -> DataFrame:
    return (gathered_quantile if known and known.longest <= ROW_VALUES else exact_quantile)(parts, KEYS, q)


def robust_scale(blocks: DataFrame, intervals: DataFrame, block_frames: int = BLOCK_FRAMES, known: Extent | None = None) -> DataFrame:
    """(file_id, interval_id, scale): the 99.9th percentile of max(|i|, |q|), or the largest where that is under 1e-6, or 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, lead, own, _ in pieces(r):
                    y = np.maximum(np.abs(x.real), np.abs(x.imag))[lead : lead + own]
                    yield pd.DataFrame({"file_id": [r.file_id], "interval_id": [w["interval_id"]], "y": [y.astype(np.float32)]})

    parts = of_blocks(blocks, intervals, block_frames, known=known).mapInPandas(run, "file_id string, interval_id long, y array<float>")
    found = _quantile(parts, 0.999, known)
    return found.select(*KEYS, F.when(F.col("value") >= 1e-6, F.col("value")).when(F.col("top") >= 1e-6, F.col("top")).otherwise(1.0).alias("scale"))


def _scaled(x: np.ndarray, scale: float | None) -> np.ndarray:
    """Samples over scale, each channel cut off at 4."""
    return x if scale is None else np.clip(x.real / scale, -4, 4) + 1j * np.clip(x.imag / scale, -4, 4)


def frame_energies(blocks: DataFrame, intervals: DataFrame, size: int = 4096, hop: int = 2048, block_frames: int = BLOCK_FRAMES, known: Extent | None = None) -> DataFrame:
    """(file_id, interval_id, at, total, fs_hz, energy_db): mean square over both channels of each frame of an interval.

    intervals may have a column scale (see robust_scale). at counts from the interval's start; total is its length.
    """
    more = ("scale",) if "scale" in intervals.columns else ()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, lead, own, at in pieces(r, 0, size - 1):
                    total = w["e"] - w["s"]
                    starts = frame_starts(total, at, own, size, hop)
                    p = np.r_[0.0, np.cumsum(np.abs(_scaled(x, w["scale"] if more else None)) ** 2)]
                    a = starts - at + lead
                    b = np.minimum(a + size, len(x))
                    mean = np.maximum((p[b] - p[a]) / (2 * np.maximum(b - a, 1)), 1e-12)
                    yield pd.DataFrame({"file_id": r.file_id, "interval_id": w["interval_id"], "at": starts, "total": total, "fs_hz": r.fs_hz, "energy_db": 10 * np.log10(mean)})

    near = of_blocks(blocks, intervals, block_frames, after=size - 1, more=more, known=known)
    return near.mapInPandas(run, "file_id string, interval_id long, at long, total long, fs_hz double, energy_db double")


def smoothing(fs_hz: float, down: int = 1, smooth_ms: float = 0.54) -> tuple[int, int]:
    """auto_threshold's boxcar: its width in kept samples, and how many of them lie behind its place."""
    win = max(4, int(fs_hz / down * smooth_ms / 1000))
    return win, (win - 1) // 2


def auto_threshold(blocks: DataFrame, intervals: DataFrame, fs_hz: float, down: int = 1, smooth_ms: float = 0.54, quantile: float = 0.98, margin_db: float = 6.0, envelope: bool = False, block_frames: int = BLOCK_FRAMES, known: Extent | None = None) -> DataFrame:
    """(file_id, interval_id, threshold_db): a quantile of the smoothed power (or envelope) and a margin.

    The boxcar has zero padded edges and a constant divisor; an interval shorter than it is not smoothed. down takes
    every so-manieth sample; 1, the default, takes all (the surveyed scripts: 100, and 2,000,000 points at most).
    """
    win, later = smoothing(fs_hz, down, smooth_ms)
    before, after = (win - 1 - later) * down, later * down
    more = ("scale",) if "scale" in intervals.columns else ()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, lead, own, at in pieces(r, before, after):
                    p = np.abs(_scaled(x, w["scale"] if more else None))
                    p = p if envelope else p**2
                    first = -(-at // down) * down - at  # of the own samples
                    y = p[lead + first : lead + own : down]
                    if -(-(w["e"] - w["s"]) // down) >= win:
                        back = (lead + first) // down
                        series = p[lead + first - back * down :: down]
                        series = np.concatenate([np.zeros(max(0, win - 1 - later - back)), series])
                        skip = max(back, win - 1 - later)
                        total = np.r_[0.0, np.cumsum(np.pad(series, (0, max(0, skip + len(y) + later - len(series)))))]
                        k = skip + np.arange(len(y))
                        y = (total[k + later + 1] - total[k - (win - 1 - later)]) / win
                    if len(y):
                        yield pd.DataFrame({"file_id": [r.file_id], "interval_id": [w["interval_id"]], "y": [np.maximum(y, 0).astype(np.float32)]})

    parts = of_blocks(blocks, intervals, block_frames, before, after, more, known).mapInPandas(run, "file_id string, interval_id long, y array<float>")
    floor = _quantile(parts, quantile, known)
    return floor.select(*KEYS, (10 * F.log10(F.greatest("value", F.lit(1e-12)) * 10 ** (margin_db / 10) + 1e-12)).alias("threshold_db"))


def voice_segments(energies: DataFrame, threshold: Column | float = -35.0, hang_db: float = 3.0, min_ms: float = 60.0, merge_ms: float = 60.0, size: int = 4096) -> DataFrame:
    """frame_energies' rows -> (file_id, interval_id, fs_hz, start, stop) within the interval: hysteresis over frames.

    On at the threshold, off at hang_db below it. Short segments go, then neighbours merge, the later one's end counting.
    """
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    samples = lambda ms: F.floor(F.col("fs_hz") * ms / 1000)
    order = Window.partitionBy(*KEYS).orderBy("at")
    mark = F.when(F.col("energy_db") >= thr, 1).when(F.col("energy_db") <= thr - abs(hang_db), 0)
    on = energies.withColumn("state", F.coalesce(F.last(mark, ignorenulls=True).over(order), F.lit(0)))
    on = on.withColumn("was", F.coalesce(F.lag("state").over(order), F.lit(0))).where("state <> was")
    on = on.withColumn("stop", F.coalesce(F.lead("at").over(order) + size, F.col("total"))).where("state = 1")
    on = on.where(F.col("stop") - F.col("at") >= samples(min_ms))
    opens = F.when(F.col("at") - F.lag("stop").over(order) <= samples(merge_ms), 0).otherwise(1)
    runs = on.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    return runs.groupBy(*KEYS, "fs_hz", "run").agg(F.min("at").alias("start"), F.max_by("stop", "at").alias("stop")).drop("run")


def spectra(blocks: DataFrame, intervals: DataFrame, nfft: int = 4096, hop: int = 1024, max_frames: int | None = 8192, step: int = 1, block_frames: int = BLOCK_FRAMES, known: Extent | None = None) -> DataFrame:
    """(file_id, interval_id, fs_hz, p_db array): the mean power of an interval's frames, centred bins.

    Symmetric Hann window, divided by its energy; max_frames leaves out frames evenly, step takes every so-manieth
    sample (and divides the rate, so that offsets and bandwidths come out in true Hz). Short intervals are zero filled.
    Sums are in double precision, so samples of any size need no rescaling.
    """
    reach = nfft * step

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, lead, own, at in pieces(r, 0, reach):
                    n = -(-(w["e"] - w["s"]) // step)
                    frames = 1 + max(0, n - nfft) // hop
                    skip = max(1, frames // max_frames) if max_frames and frames > max_frames else 1
                    starts = frame_starts(max(n, nfft) * step, at, own, reach, hop * skip * step)
                    if not len(starts):
                        continue
                    local = starts - at + lead
                    x = np.pad(x, (0, max(0, int(local[-1]) + reach - len(x))))
                    p = kernels.strided_power(x, local, nfft, step)
                    yield pd.DataFrame({"file_id": r.file_id, "interval_id": w["interval_id"], "fs_hz": r.fs_hz / step, "bin": np.arange(nfft), "p": p, "frames": len(starts)})

    parts = of_blocks(blocks, intervals, block_frames, after=reach, known=known).mapInPandas(run, "file_id string, interval_id long, fs_hz double, bin int, p double, frames long")
    mean = parts.groupBy(*KEYS, "fs_hz", "bin").agg((F.sum("p") / F.sum("frames")).alias("p"))
    db = 10 * F.log10(F.greatest("p", F.lit(1e-20)))
    lists = mean.groupBy(*KEYS, "fs_hz").agg(F.sort_array(F.collect_list(F.struct("bin", db.alias("db")))).alias("s"))
    return lists.select(*KEYS, "fs_hz", F.col("s.db").alias("p_db"))


def radio_metrics(spectra: DataFrame, below_db: float = 20.0) -> DataFrame:
    """spectra's rows -> (file_id, interval_id, rf_offset_hz, bandwidth_hz, snr_db)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [kernels.band_of(np.asarray(p), fs, below_db) for p, fs in zip(batch["p_db"], batch["fs_hz"], strict=True)]
            yield pd.concat([batch[list(KEYS)].reset_index(drop=True), pd.DataFrame(rows, columns=["rf_offset_hz", "bandwidth_hz", "snr_db"])], axis=1)

    return spectra.select(*KEYS, "fs_hz", "p_db").mapInPandas(run, "file_id string, interval_id long, rf_offset_hz double, bandwidth_hz double, snr_db double")


def model_frames(blocks: DataFrame, intervals: DataFrame, channels: int = 14, size: int = 16_384, hop: int = 8_192, block_frames: int = BLOCK_FRAMES, known: Extent | None = None) -> DataFrame:
    """(file_id, interval_id, at, fs_hz, x array of channels * size floats): a model's input, frame by frame.

    Channels: i, q over the interval's scale (column scale; see robust_scale), amplitude, phase and its step from the
    sample before (0 at the interval's start), repeated to the number asked for. A short interval is zero filled.
    """
    names = ["file_id", "interval_id", "at", "fs_hz", "x"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                found = []
                for w, x, lead, own, at in pieces(r, 1, size - 1):
                    y = _scaled(x, w["scale"])
                    phase = np.angle(y)
                    base = np.stack([y.real, y.imag, np.abs(y), phase, np.diff(phase, prepend=phase[:1])]).astype(np.float32)
                    for start in frame_starts(w["e"] - w["s"], at, own, size, hop).tolist():
                        k = start - at + lead
                        part = base[:, k : k + size]
                        part = np.pad(part, ((0, 0), (0, size - part.shape[1])))
                        x_out = np.tile(part, (-(-channels // 5), 1))[:channels]
                        found.append((r.file_id, w["interval_id"], start, r.fs_hz, x_out.ravel()))
                        if len(found) * x_out.nbytes >= BATCH_BYTES:
                            yield pd.DataFrame(found, columns=names)
                            found = []
                if found:
                    yield pd.DataFrame(found, columns=names)

    near = of_blocks(blocks, intervals, block_frames, 1, size - 1, ("scale",), known)
    return near.mapInPandas(run, "file_id string, interval_id long, at long, fs_hz double, x array<float>")
