"""Clips around carriers: mixed to DC, low-passed, resampled, cut into windows.

The filter is causal, as `lfilter` is: sample n of its output takes samples up to n. Decimation takes a second, centred
filter (Kaiser). Both together need so many samples before a block and so many behind it, which come as its halo; the
result does not depend on block lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from .captures import samples_of, with_halo


def decimation(fs_hz: float, bw_hz: float, oversample: float = 4.0, min_bw_hz: float = 1e5) -> tuple[int, float]:
    """(factor, cutoff in Hz) for a carrier: at least `oversample` times its bandwidth is left."""
    bw = max(bw_hz, min_bw_hz)
    return max(1, int(np.floor(fs_hz / (bw * oversample)))), min(0.45 * fs_hz, 1.2 * bw)


def resampled(x: np.ndarray, low: np.ndarray, factor: int, first: int, count: int) -> np.ndarray:
    """x through the causal filter, then the Kaiser filter of a decimation, at `count` places from `first`, factor apart.

    Both filters are one, of which only the wanted places are computed. At the end of x the first filter stops with the
    samples, so the few places that the second one reaches beyond are computed by one after the other.
    """
    fir = kernels.kaiser_fir(factor)
    reach = len(fir) // 2
    inside = min(count, max(0, -(-(len(x) - reach - first) // factor)))
    z = kernels.fir_at(x, np.convolve(low, fir), first + reach, factor, inside)
    if inside == count:
        return z
    at = first + factor * inside - reach  # the first sample of the causal filter's output that is still needed
    begin = max(0, at - len(low) + 1)
    y = np.convolve(x[begin:], low)[: len(x) - begin]
    return np.concatenate([z, kernels.fir_at(y, fir, first + factor * inside + reach - begin, factor, count - inside)])


def downmix(blocks: DataFrame, carriers: DataFrame, fs_hz: float, oversample: float = 4.0, min_bw_hz: float = 1e5, taps: int = 801) -> DataFrame:
    """carriers(file_id, carrier_index, f_center_hz, bw_hz) -> (file_id, carrier_index, block_id, start_out, fs_hz, decim, i, q).

    fs_hz bounds the halo: it is the highest rate of the captures.
    """
    half = 10 * decimation(fs_hz, 0.0, oversample, min_bw_hz)[0]
    before, after = taps - 1 + half, half

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x, left = samples_of(r, before, after)
                n, zero = len(r.i), r.start_sample - left
                for c in r.carriers:
                    factor, cutoff = decimation(r.fs_hz, c["bw_hz"], oversample, min_bw_hz)
                    mixed = kernels.mix(x, zero, c["f_center_hz"], r.fs_hz)
                    low = kernels.firwin_hann(taps, float(np.clip(cutoff / (r.fs_hz / 2), 0.01, 0.99)))
                    first = -(-r.start_sample // factor) * factor
                    z = resampled(mixed, low, factor, first - zero, max(0, -(-(r.start_sample + n - first) // factor)))
                    yield pd.DataFrame({"file_id": [r.file_id], "carrier_index": [c["carrier_index"]], "block_id": [r.block_id], "start_out": [int(-(-r.start_sample // factor))], "fs_hz": [r.fs_hz / factor], "decim": [factor], "i": [z.real.astype(np.float32)], "q": [z.imag.astype(np.float32)]})

    wanted = carriers.groupBy("file_id").agg(F.collect_list(F.struct(F.col("carrier_index").cast("long").alias("carrier_index"), F.col("f_center_hz").cast("double").alias("f_center_hz"), F.col("bw_hz").cast("double").alias("bw_hz"))).alias("carriers"))
    near = with_halo(blocks, "start_sample", "n", "fs_hz", "i", "q", before=before, after=after).join(wanted, "file_id")
    return near.mapInPandas(run, "file_id string, carrier_index long, block_id long, start_out long, fs_hz double, decim int, i array<float>, q array<float>")


def clip_spans(carriers: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """(file_id, carrier_index, t0_s, t1_s): the whole file (column duration_s of carriers), or a carrier's active spans."""
    if spans is None:
        return carriers.select("file_id", "carrier_index", F.lit(0.0).alias("t0_s"), F.col("duration_s").alias("t1_s"))
    return carriers.select("file_id", "carrier_index").join(spans.select("file_id", "carrier_index", "t0_s", "t1_s"), ["file_id", "carrier_index"])


def clips(streams: DataFrame, spans: DataFrame, files: DataFrame, win: int = 16_384, hop_frac: float = 0.5) -> DataFrame:
    """(file_id, carrier_index, t0_s, t1_s, place, fs_hz, decim, i, q): windows of downmix's streams within spans.

    files(file_id, fs_hz, frames) has the original rates. Spans of up to four original samples, and those shorter than a
    window, have none; place is the window's first sample in the stream. A window gathers from the blocks it touches: the
    pieces of one window are what a task holds.
    """
    hop = max(1, int(win * hop_frac))
    rates = streams.groupBy("file_id", "carrier_index").agg(F.first("decim").alias("decim"), F.first("fs_hz").alias("fs_hz"))
    rows = spans.join(files.select("file_id", F.col("fs_hz").alias("fs"), "frames"), "file_id").join(rates, ["file_id", "carrier_index"])
    first, last = F.floor(F.col("t0_s") * F.col("fs")), F.least(F.col("frames"), F.ceil(F.col("t1_s") * F.col("fs")))
    rows = rows.where(last > first + 4).withColumns({"d0": F.floor(first / F.col("decim")), "d1": F.floor(last / F.col("decim"))}).where(F.col("d1") - F.col("d0") >= win)
    rows = rows.select("file_id", "carrier_index", "t0_s", "t1_s", F.explode(F.sequence(F.col("d0"), F.col("d1") - win, F.lit(hop))).alias("place"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                start, n = r.start_out, len(r.i)
                for w in r.windows:
                    a, b = max(w["place"], start), min(w["place"] + win, start + n)
                    if b > a:
                        yield pd.DataFrame({"file_id": [r.file_id], "carrier_index": [r.carrier_index], "t0_s": [w["t0_s"]], "t1_s": [w["t1_s"]], "place": [w["place"]], "fs_hz": [r.fs_hz], "decim": [r.decim], "at": [a], "i": [r.i[a - start : b - start]], "q": [r.q[a - start : b - start]]})

    by_carrier = rows.groupBy("file_id", "carrier_index", F.floor(F.col("place") / (64 * win)).alias("zone")).agg(F.collect_list(F.struct("place", "t0_s", "t1_s")).alias("windows"))
    low, high = F.floor((F.col("start_out") - win) / (64 * win)), F.floor((F.col("start_out") + F.size("i")) / (64 * win))
    near = streams.withColumn("zone", F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), low), high))).join(by_carrier, ["file_id", "carrier_index", "zone"])
    parts = near.mapInPandas(cut, "file_id string, carrier_index long, t0_s double, t1_s double, place long, fs_hz double, decim int, at long, i array<float>, q array<float>")
    whole = parts.groupBy("file_id", "carrier_index", "t0_s", "t1_s", "place", "fs_hz", "decim").agg(F.sort_array(F.collect_list(F.struct("at", "i", "q"))).alias("p"))
    out = whole.select("file_id", "carrier_index", "t0_s", "t1_s", "place", "fs_hz", "decim", F.flatten("p.i").alias("i"), F.flatten("p.q").alias("q"))
    return out.where(F.size("i") == win)


def numbered(clips: DataFrame) -> DataFrame:
    """clips with clip_index and y (0, the unknown label): numbers by file, carrier, span and place, dense and stable.

    Numbers are given by counting within (file, carrier), and adding what the smaller ones hold: no task sorts all clips.
    """
    from pyspark.sql import Window

    own = Window.partitionBy("file_id", "carrier_index").orderBy("t0_s", "place")
    counts = clips.groupBy("file_id", "carrier_index").agg(F.count("*").alias("n_clips"))
    past = Window.orderBy("file_id", "carrier_index").rowsBetween(Window.unboundedPreceding, -1)  # a row a carrier
    base = counts.withColumn("base", F.coalesce(F.sum("n_clips").over(past), F.lit(0)))
    rows = clips.withColumn("k", F.row_number().over(own) - 1).join(base, ["file_id", "carrier_index"])
    return rows.withColumns({"clip_index": (F.col("base") + F.col("k")).cast("long"), "y": F.lit(0)}).drop("k", "base", "n_clips")


def clips_per_carrier(clips: DataFrame) -> DataFrame:
    return clips.groupBy("file_id", "carrier_index").agg(F.count("*").alias("n_clips"))
