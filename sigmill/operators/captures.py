"""Operators on sample blocks: (file_id, chunk_id, block_id, start_sample, n, fs_hz, i, q), a row a block.

Every block is reduced where it is read; what crosses the shuffle is partial sums, frames or interval pieces. The halo
(samples that a frame or filter needs from neighbouring blocks) comes with the block where the source was asked for it
(options haloBefore, haloAfter, haloBeforeMs), and nothing of the samples is shuffled then; other tables of blocks get it
by a join with short pieces of their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels

IRR_FFT = 1 << 18


def samples(blocks: DataFrame) -> DataFrame:
    """One row a sample, for short captures and for the SQL operators."""
    zipped = F.posexplode(F.arrays_zip("i", "q"))
    return blocks.select("file_id", "chunk_id", "start_sample", zipped.alias("p", "x")).select("file_id", "chunk_id", (F.col("start_sample") + F.col("p")).alias("n"), F.col("x.i").cast("double").alias("i"), F.col("x.q").cast("double").alias("q"))


def lengths(blocks: DataFrame) -> DataFrame:
    """(file_id, frames, fs_hz) by counting blocks; headers say the same without reading samples (sources.captures.metadata)."""
    return blocks.groupBy("file_id").agg(F.max(F.col("start_sample") + F.col("n")).alias("frames"), F.first("fs_hz").alias("fs_hz"))


_CHANNEL = "{c}_nan long, {c}_inf long, {c}_n long, {c}_m double, {c}_m2 double, {c}_min double, {c}_max double, {c}_clip long"
_BANDS = ("pos", "neg", "cpos", "cneg")


def block_statistics(blocks: DataFrame, size: int = IRR_FFT, bands: bool = True) -> DataFrame:
    """A row a block: counts, mean, squared deviations from that mean and extremes of each channel, and, with bands, band
    powers of the centre crop. One pass over the samples serves channel_moments, image_rejection and chunk_means."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                row = {k: getattr(r, k) for k in keys} | {"frames": len(r.i)}
                for name in ("i", "q"):
                    x = np.asarray(getattr(r, name), np.float64)
                    ok = x[np.isfinite(x)]
                    mean = ok.mean() if len(ok) else 0.0
                    row |= {f"{name}_nan": int(np.isnan(x).sum()), f"{name}_inf": int(np.isinf(x).sum()), f"{name}_n": len(ok), f"{name}_m": mean, f"{name}_m2": ((ok - mean) ** 2).sum(), f"{name}_min": ok.min(initial=np.inf), f"{name}_max": ok.max(initial=-np.inf), f"{name}_clip": int((np.abs(ok) > 0.999).sum())}
                if bands:
                    x = kernels.complex_of(r.i, r.q)
                    x = x - x.mean() if len(x) else x
                    row |= dict(zip(_BANDS, kernels.all_band_powers(x, kernels.fft_size(size, max(1, len(x)))), strict=True))
                rows.append(row)
            yield pd.DataFrame(rows)

    keys = [k for k in ("file_id", "chunk_id", "fs_hz") if k in blocks.columns]
    kinds = [f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys]
    fields = ", ".join([*kinds, "frames long", *(_CHANNEL.format(c=c) for c in "iq"), *(f"{k} double" for k in _BANDS if bands)])
    return blocks.select(*keys, "i", "q").mapInPandas(run, fields)


def channel_moments(blocks: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Counts, means, deviations and extremes of each channel by file, from block_statistics (parts, if they are there).

    Blocks' deviations from their own means meet around the file's mean, so a large constant offset costs no digits. A
    stream has no file mean to meet around; there the block means' squares are summed.
    """
    parts = block_statistics(blocks, bands=False) if parts is None else parts
    aggs = [F.sum("frames").alias("frames")]
    file = Window.partitionBy("file_id")  # one row a block
    for c in "iq":
        n = F.greatest(F.sum(f"{c}_n"), F.lit(1))
        mean = F.sum(F.col(f"{c}_n") * F.col(f"{c}_m")) / n
        if blocks.isStreaming:
            var = (F.sum(f"{c}_m2") + F.sum(F.col(f"{c}_n") * F.col(f"{c}_m") ** 2)) / n - mean * mean
        else:
            parts = parts.withColumn(f"{c}_mu", F.sum(F.col(f"{c}_n") * F.col(f"{c}_m")).over(file) / F.greatest(F.sum(f"{c}_n").over(file), F.lit(1)))
            var = F.sum(F.col(f"{c}_m2") + F.col(f"{c}_n") * (F.col(f"{c}_m") - F.col(f"{c}_mu")) ** 2) / n
        std = F.sqrt(F.greatest(F.lit(0.0), var))
        aggs += [F.sum(f"{c}_nan").alias(f"{c}_nan"), F.sum(f"{c}_inf").alias(f"{c}_inf"), mean.alias(f"{c}_mean"), std.alias(f"{c}_std"), F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"), F.greatest(F.abs(F.min(f"{c}_min")), F.abs(F.max(f"{c}_max"))).alias(f"{c}_peak_abs"), F.sqrt(mean * mean + std * std).alias(f"{c}_rms"), (100 * F.sum(f"{c}_clip") / n).alias(f"{c}_clip_pct")]
    return parts.groupBy("file_id").agg(*aggs)


def chunk_means(parts: DataFrame) -> DataFrame:
    """block_statistics' rows -> (file_id, chunk_id, mi, mq): means of finite samples."""
    mean = lambda c: F.sum(F.col(f"{c}_n") * F.col(f"{c}_m")) / F.greatest(F.sum(f"{c}_n"), F.lit(1))
    return parts.groupBy("file_id", "chunk_id").agg(mean("i").alias("mi"), mean("q").alias("mq"))


def envelope_kurtosis(blocks: DataFrame, dc: DataFrame | None = None) -> DataFrame:
    """(file_id, n, envelope_kurtosis): the fourth standardised moment of the envelope after the chunk's DC is removed.

    Two reductions: chunk means of finite samples (dc: file_id, chunk_id, mi, mq, if they are known), then power sums of
    the envelope around each block's mean, which meet around the file's.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                x = [np.asarray(v, np.float64) for v in (r.i, r.q)]
                x = [v[np.isfinite(v)] for v in x]
                rows.append((r.file_id, r.chunk_id, x[0].sum(), len(x[0]), x[1].sum(), len(x[1])))
            yield pd.DataFrame(rows, columns=["file_id", "chunk_id", "si", "ni", "sq", "nq"])

    def powers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                z = np.hypot(np.asarray(r.i, np.float64) - r.mi, np.asarray(r.q, np.float64) - r.mq)
                z = z[np.isfinite(z)]
                m = z.mean() if len(z) else 0.0
                d = z - m
                rows.append((r.file_id, len(z), m, (d**2).sum(), (d**3).sum(), (d**4).sum()))
            yield pd.DataFrame(rows, columns=["file_id", "n", "m", "m2", "m3", "m4"])

    if dc is None:
        dc = blocks.select("file_id", "chunk_id", "i", "q").mapInPandas(sums, "file_id string, chunk_id long, si double, ni long, sq double, nq long").groupBy("file_id", "chunk_id")
        dc = dc.agg((F.sum("si") / F.greatest(F.sum("ni"), F.lit(1))).alias("mi"), (F.sum("sq") / F.greatest(F.sum("nq"), F.lit(1))).alias("mq"))
    parts = blocks.select("file_id", "chunk_id", "i", "q").join(dc, ["file_id", "chunk_id"]).mapInPandas(powers, "file_id string, n long, m double, m2 double, m3 double, m4 double")
    parts = parts.withColumn("d", F.col("m") - F.sum(F.col("n") * F.col("m")).over(Window.partitionBy("file_id")) / F.greatest(F.sum("n").over(Window.partitionBy("file_id")), F.lit(1)))
    n, d = F.sum("n"), F.col("d")
    var = F.sum(F.col("m2") + F.col("n") * d**2) / n
    fourth = F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d**2 * F.col("m2") + F.col("n") * d**4) / n
    return parts.groupBy("file_id").agg(n.alias("n"), F.when(F.sqrt(var) < 1e-12, 0.0).otherwise(fourth / (var * var)).alias("envelope_kurtosis"))


def image_rejection(blocks: DataFrame, size: int = IRR_FFT, parts: DataFrame | None = None) -> DataFrame:
    """(file_id, best, irr_db, direct_db, mirrored_db): band powers of each block's centre crop, summed; a tie goes to I+Q.

    Conjugation mirrors the spectrum, so one transform serves all conventions: direct_db is that of I+Q and Q-I, mirrored_db
    of I-Q and Q+I, both with their signs. parts: block_statistics, if they are there.
    """
    parts = block_statistics(blocks, size) if parts is None else parts
    sums = parts.groupBy("file_id").agg(*(F.sum(c).alias(c) for c in _BANDS))
    plain, mirrored = (10 * F.log10(F.col(a) / F.col(b)) for a, b in (("pos", "neg"), ("cpos", "cneg")))
    return sums.select("file_id", F.when(plain >= mirrored, "I+Q").otherwise("I-Q").alias("best"), F.abs(F.greatest(plain, mirrored)).alias("irr_db"), plain.alias("direct_db"), mirrored.alias("mirrored_db"))


def _has(blocks: DataFrame, side: str, frames: int = 0, ms: float = 0.0) -> bool:
    """Whether the blocks came with so wide a halo on one side ("head" or "tail")."""
    width = blocks.schema[f"{side}_i"].metadata if f"{side}_i" in blocks.columns else {}
    return bool(width) and width.get("frames", 0) >= frames and width.get("ms", 0.0) >= ms


def with_halo(blocks: DataFrame, *columns: str, before: int = 0, after: int = 0) -> DataFrame:
    """The columns of blocks, with head_i, head_q (`before` samples before the block) and tail_i, tail_q (`after` behind
    it): as read with the blocks, or by joins. A halo longer than a block gathers from as many blocks as it takes."""
    sides = [(s, n, step) for s, n, step in (("head", before, 1), ("tail", after, -1)) if n]
    own = [f"{s}_{c}" for s, n, _ in sides if _has(blocks, s, n) for c in "iq"]
    out = blocks.select(*dict.fromkeys(("file_id", "block_id", *columns)), *own)
    missing = [x for x in sides if not _has(blocks, x[0], x[1])]
    known = blocks.schema["block_id"].metadata.get("frames")
    for side, n, step in missing:
        size, length = F.size("i"), known
        if known is None and not blocks.isStreaming:  # the length of the shortest of the files' whole blocks
            length = blocks.groupBy("file_id").agg(F.max("n" if "n" in blocks.columns else size).alias("m")).agg(F.min("m")).first()[0]
        if length is None or n <= length:
            first = 1 if side == "tail" else F.greatest(F.lit(1), size - n + 1)
            piece = blocks.select("file_id", (F.col("block_id") + step).alias("block_id"), *(F.slice(c, F.lit(first) if side == "tail" else first, F.lit(n)).alias(f"{side}_{c}") for c in "iq"))
        else:
            away = blocks.withColumn("_away", F.explode(F.sequence(F.lit(1), F.lit(-(-n // length)))))
            if known is None:
                away = away.join(blocks.groupBy("file_id").agg(F.max(size).alias("_length")), "file_id")
            part = F.least(size, F.lit(n) - (F.col("_away") - 1) * (F.col("_length") if known is None else F.lit(known))).cast("int")
            first = F.lit(1) if side == "tail" else size - part + 1
            part_of = away.where(part > 0).select("file_id", (F.col("block_id") + step * F.col("_away")).alias("block_id"), F.struct((-step * F.col("_away")).alias("at"), *(F.slice(c, first, part).alias(c) for c in "iq")).alias("p"))
            whole = part_of.groupBy("file_id", "block_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
            piece = whole.select("file_id", "block_id", *(F.flatten(f"p.{c}").alias(f"{side}_{c}") for c in "iq"))
        out = out.join(piece, ["file_id", "block_id"], "left")
    return out


def haloed(blocks: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """blocks with a halo of that width, as the source gives it: steps that need no wider one join nothing."""
    near = with_halo(blocks, *blocks.columns, before=before, after=after)
    width = {f"{side}_{c}": {"frames": n} for side, n in (("head", before), ("tail", after)) if n for c in "iq"}
    return near.select(*(F.col(c).alias(c, metadata=width[c]) if c in width else c for c in near.columns))


def samples_of(r, before: int = 0, after: int = 0) -> tuple[np.ndarray, int]:
    """A row of with_halo as complex samples, and how many of them precede the block's own."""
    part = lambda side, some: kernels.complex_of(*(np.zeros(0) if (v := getattr(r, f"{side}_{c}")) is None else np.asarray(v)[some] for c in "iq"))
    own = kernels.complex_of(r.i, r.q)
    head = part("head", slice(-before, None)) if before else own[:0]
    tail = part("tail", slice(None, after)) if after else own[:0]
    return np.concatenate([head, own, tail]), len(head)


def welch(blocks: DataFrame, nperseg: int = 4096, hop: int = 2048) -> DataFrame:
    """(file_id, bin, f_hz, p, p_db): the average periodogram of all frames of the file, across block borders.

    The block length must be a multiple of hop. A file shorter than nperseg is one frame of its own length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x, _ = samples_of(r, after=nperseg - hop)
                size = min(nperseg, len(x)) if r.start_sample == 0 else nperseg
                if size < nperseg and len(r.tail_i if r.tail_i is not None else ()) == nperseg - hop:
                    size = nperseg  # a short block, but not a short file
                p, n = kernels.welch_sums(x, size, hop, r.fs_hz) if size else (np.zeros(0), 0)
                yield pd.DataFrame({"file_id": r.file_id, "fs_hz": r.fs_hz, "size": size, "bin": np.arange(size), "p": p, "frames": n})

    parts = with_halo(blocks, "start_sample", "fs_hz", "i", "q", after=nperseg - hop).mapInPandas(run, "file_id string, fs_hz double, size int, bin int, p double, frames long")
    psd = parts.groupBy("file_id", "fs_hz", "size", "bin").agg((F.sum("p") / F.greatest(F.sum("frames"), F.lit(1))).alias("p"), F.sum("frames").alias("frames")).where("frames > 0")
    return psd.select("file_id", "bin", ((F.col("bin") - F.floor(F.col("size") / 2)) * F.col("fs_hz") / F.col("size")).alias("f_hz"), "p", (10 * F.log10(F.greatest("p", F.lit(1e-20)))).alias("p_db"))


def noise_floor(psd: DataFrame) -> DataFrame:
    """(file_id, noise_floor_db): the median over the bins, which trimming both ends alike does not change."""
    return psd.groupBy("file_id").agg(F.median("p_db").alias("noise_floor_db"))


def carriers(psd: DataFrame, prominence_db: float = 8) -> DataFrame:
    """(file_id, carrier_index, f_center_hz, p_db, bw_hz, snr_db) from welch's rows: prominent peaks and their width 6 dB below.

    A group is one file's spectrum, nperseg rows. Peaks less than three bins wide are left out, as the definition says.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        f, db = group["f_hz"].to_numpy(), group["p_db"].to_numpy()
        rows = []
        for p in kernels.peaks(db, prominence_db):
            left, right = kernels.walk_down(db, p, db[p] - 6)
            if right - left >= 3:
                rows.append((group["file_id"].iat[0], len(rows), f[p], db[p], (right - left) * (f[1] - f[0]), db[p] - np.median(db)))
        return pd.DataFrame(rows, columns=["file_id", "carrier_index", "f_center_hz", "p_db", "bw_hz", "snr_db"])

    return psd.select("file_id", "bin", "f_hz", "p_db").groupBy("file_id").applyInPandas(run, "file_id string, carrier_index long, f_center_hz double, p_db double, bw_hz double, snr_db double")


def waterfall(blocks: DataFrame, nperseg: int = 4096, hop: int = 1024, max_columns: int | None = None, scaling: str = "none", kind: str = "float", files: DataFrame | None = None) -> DataFrame:
    """(file_id, t_idx, time_s, s_db array): STFT columns of all blocks; frames that cross a border use the halo.

    hop must divide the block length. max_columns keeps every so-manieth frame of a file, so that no more columns come
    (4000 in the surveyed scripts); frames that are left out are not computed, and t_idx counts the kept ones. The lengths
    that this needs come from files(file_id, frames), as headers have them; else blocks are read once more to count.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x, _ = samples_of(r, after=nperseg - hop)
                first = r.start_sample // hop
                kept = np.arange(-first % r.skip, max(0, (len(x) - nperseg) // hop + 1), r.skip)
                if not len(kept):
                    continue
                rows = np.concatenate([x[k * hop : k * hop + nperseg] for k in kept])
                db = kernels.stft_db(rows, nperseg, nperseg, scaling)
                t = first + kept
                yield pd.DataFrame({"file_id": r.file_id, "t_idx": t // r.skip, "time_s": t * hop / r.fs_hz, "s_db": list(db.astype(np.float32 if kind == "float" else np.float64))})

    near = with_halo(blocks, "start_sample", "fs_hz", "n", "i", "q", after=nperseg - hop)
    if max_columns is None:
        near = near.withColumn("skip", F.lit(1).cast("long"))
    else:
        total = lengths(blocks) if files is None else files
        total = total.select("file_id", F.col("frames").alias("total"))
        frames = 1 + F.greatest(F.lit(0), F.floor((F.col("total") - nperseg) / hop))
        near = near.join(total.select("file_id", F.greatest(F.lit(1), F.ceil(frames / max_columns)).cast("long").alias("skip")), "file_id")
    return near.mapInPandas(run, f"file_id string, t_idx long, time_s double, s_db array<{kind}>")


def cut(blocks: DataFrame, intervals: DataFrame, block_frames: int, *keep: str) -> DataFrame:
    """Samples of intervals(file_id, slice_idx, start_sample, end_sample): an equi-join on the blocks each one touches.

    -> (file_id, slice_idx, block_id, at, i, q) and the block columns named in keep, the pieces of each interval in order of `at`.
    """
    touched = F.sequence(F.expr(f"start_sample div {block_frames}"), F.expr(f"(end_sample - 1) div {block_frames}"))
    want = intervals.where("end_sample > start_sample").select("file_id", "slice_idx", F.col("start_sample").alias("s"), F.col("end_sample").alias("e"), F.explode(touched).alias("block_id"))
    joined = blocks.join(want, ["file_id", "block_id"])
    first = F.greatest(F.col("s") - F.col("start_sample"), F.lit(0)).cast("int")
    last = F.least(F.col("e") - F.col("start_sample"), F.col("n")).cast("int")
    piece = lambda c: F.slice(c, first + 1, last - first).alias(c)
    return joined.where(last > first).select("file_id", "slice_idx", "block_id", (F.col("start_sample") + first).alias("at"), piece("i"), piece("q"), *keep)


def activity_runs(blocks: DataFrame, rms_ms: float = 5, thresh_dbfs: float = -60, gap_ms: float = 3) -> DataFrame:
    """(file_id, chunk_id, fs_hz, lo, hi, s, e): of each block the stretches over the threshold, and one row with null s and e.

    A stream of blocks needs them with a halo (haloBeforeMs): it cannot be joined with itself here.
    """
    count = lambda fs_hz, ms: max(1, round(fs_hz * ms / 1000))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                w, gap = count(r.fs_hz, rms_ms), int(round(r.fs_hz * gap_ms / 1000))
                head, x = (np.abs(kernels.complex_of(np.zeros(0) if i is None else i, np.zeros(0) if q is None else q)) ** 2 for i, q in ((r.head_i, r.head_q), (r.i, r.q)))
                head = head[max(0, len(head) - w + 1) :]
                total = np.r_[0.0, np.cumsum(np.r_[head, x])]
                stop = len(head) + 1 + np.arange(len(x))
                first = np.maximum(stop - w, 0)
                rms = np.sqrt(np.maximum(total[stop] - total[first], 0) / (stop - first))
                on = np.flatnonzero(20 * np.log10(np.maximum(rms, 1e-12)) > thresh_dbfs)
                cuts = np.flatnonzero(np.diff(on) - 1 > gap)
                place = (r.file_id, r.chunk_id, r.fs_hz, r.start_sample, r.start_sample + len(x))
                rows.append((*place, None, None))
                if len(on):
                    rows += [(*place, r.start_sample + int(s), r.start_sample + int(e) + 1) for s, e in zip(on[np.r_[0, cuts + 1]], on[np.r_[cuts, len(on) - 1]], strict=True)]
            yield pd.DataFrame(rows, columns=["file_id", "chunk_id", "fs_hz", "lo", "hi", "s", "e"]).astype({"s": "Int64", "e": "Int64"})

    if _has(blocks, "head", ms=rms_ms):  # the window starts anew in each chunk
        keep = F.least(F.size("head_i"), (F.col("start_sample") - F.col("chunk_id") * blocks.schema["chunk_id"].metadata["frames"]).cast("int"))
        near = blocks.select("file_id", "chunk_id", "start_sample", "fs_hz", "i", "q", *(F.when(keep > 0, F.slice(f"head_{c}", F.size("head_i") - keep + 1, keep)).alias(f"head_{c}") for c in "iq"))
    else:
        longest = blocks.agg(F.max(F.ceil(F.col("fs_hz") * rms_ms / 1000))).first()[0] or 1
        begins = blocks.groupBy("file_id", "chunk_id").agg(F.min("start_sample").alias("begins"))
        near = with_halo(blocks, "chunk_id", "start_sample", "fs_hz", "i", "q", before=int(longest)).join(begins, ["file_id", "chunk_id"])
        keep = F.least(F.size("head_i"), (F.col("start_sample") - F.col("begins")).cast("int"))
        near = near.select("file_id", "chunk_id", "start_sample", "fs_hz", "i", "q", *(F.when(keep > 0, F.slice(f"head_{c}", F.size("head_i") - keep + 1, keep)).alias(f"head_{c}") for c in "iq"))
    return near.mapInPandas(run, "file_id string, chunk_id long, fs_hz double, lo long, hi long, s long, e long")


def activity_slices(blocks: DataFrame, rms_ms: float = 5, thresh_dbfs: float = -60, min_ms: float = 5, gap_ms: float = 3, pad_ms: float = 2, max_slices: int | None = None) -> DataFrame:
    """(file_id, slice_idx, start_sample, end_sample, start_s, end_s, duration_ms): stretches whose running RMS exceeds the threshold.

    The running RMS warms up anew in each chunk; its window may be longer than a block. Blocks are reduced to runs where
    they are read, so the windows sort runs and not samples. NaN counts as zero. All slices of a file are reported, or its first max_slices.
    """
    runs = activity_runs(blocks, rms_ms, thresh_dbfs, gap_ms)
    samples_of = lambda ms: F.round(F.col("fs_hz") * ms / 1000).cast("long")
    chunk, file = Window.partitionBy("file_id", "chunk_id"), Window.partitionBy("file_id")
    bounded = runs.withColumns({"lo": F.min("lo").over(chunk), "hi": F.max("hi").over(chunk)}).where("s IS NOT NULL")
    opens = lambda last, reach: F.when(F.col("s") - last <= reach, 0).otherwise(1)
    marked = bounded.withColumn("opens", opens(F.lag("e").over(chunk.orderBy("s")), samples_of(gap_ms)))
    islands = marked.withColumn("island", F.sum("opens").over(chunk.orderBy("s"))).groupBy("file_id", "chunk_id", "fs_hz", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    padded = islands.select("file_id", "fs_hz", F.greatest(F.col("s") - samples_of(pad_ms), "lo").alias("s"), F.least(F.col("e") + samples_of(pad_ms), "hi").alias("e")).where(F.col("e") - F.col("s") >= samples_of(min_ms))
    order = file.orderBy("s", "e")
    joined = padded.withColumn("opens", opens(F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    slices = joined.groupBy("file_id", "fs_hz", "island").agg(F.min("s").alias("start_sample"), F.max("e").alias("end_sample")).withColumn("slice_idx", (F.row_number().over(file.orderBy("start_sample")) - 1).cast("long"))
    seconds = lambda c: (F.col(c) / F.col("fs_hz"))
    if max_slices is not None:
        slices = slices.where(F.col("slice_idx") < max_slices)
    return slices.select("file_id", "slice_idx", "start_sample", "end_sample", seconds("start_sample").alias("start_s"), seconds("end_sample").alias("end_s"), ((F.col("end_sample") - F.col("start_sample")) * 1000 / F.col("fs_hz")).alias("duration_ms"))


def retune(blocks: DataFrame, carriers: DataFrame, target_hz: float = 1e6, taps: int = 127, passband: float = 0.40) -> DataFrame:
    """Carriers(file_id, carrier_index, f_center_hz) at DC: mixed, low-passed, decimated to about target_hz.

    -> (file_id, carrier_index, block_id, start_out, fs_hz, i, q). Only the kept samples are filtered. Phase and decimation
    follow the file's sample index, so block lengths do not show.
    """
    half = (taps - 1) // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                factor = max(1, round(r.fs_hz / target_hz))
                h = kernels.lowpass(taps, float(np.clip(passband / factor, 0.05, 0.49)))
                x, left = samples_of(r, half, half)
                n = len(r.i)
                for c in r.carriers:
                    y = kernels.decimate(kernels.mix(x, r.start_sample - left, c["f_center_hz"], r.fs_hz), h, factor, r.start_sample, left, n)
                    yield pd.DataFrame({"file_id": [r.file_id], "carrier_index": [c["carrier_index"]], "block_id": [r.block_id], "start_out": [-(-r.start_sample // factor)], "fs_hz": [r.fs_hz / factor], "i": [y.real.astype(np.float32)], "q": [y.imag.astype(np.float32)]})

    near = with_halo(blocks, "start_sample", "n", "fs_hz", "i", "q", before=half, after=half)
    wanted = carriers.groupBy("file_id").agg(F.collect_list(F.struct(F.col("carrier_index").cast("long").alias("carrier_index"), F.col("f_center_hz").cast("double").alias("f_center_hz"))).alias("carriers"))
    return near.join(wanted, "file_id").mapInPandas(run, "file_id string, carrier_index long, block_id long, start_out long, fs_hz double, i array<float>, q array<float>")


def classify(frames: DataFrame, classifier: Callable[[np.ndarray], np.ndarray], labels: list[str], unknown: float = 0.0) -> DataFrame:
    """frames(segment_id, i, q) -> (segment_id, pred_idx, pred_label, prob_top1).

    classifier: (batch, 2, length) -> (batch, classes) logits, called on Arrow batches of equally long frames; the
    logits of a segment are averaged before the softmax.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack([np.stack(batch["i"].to_list()), np.stack(batch["q"].to_list())], axis=1)
            x = (x - x.mean(axis=2, keepdims=True)) / np.maximum(x.std(axis=2, ddof=1, keepdims=True), 1e-6)
            z = classifier(x)
            yield pd.DataFrame({"segment_id": np.repeat(batch["segment_id"].to_numpy(), z.shape[1]), "idx": np.tile(np.arange(z.shape[1]), len(z)), "z": z.ravel()})

    mean = frames.select("segment_id", "i", "q").mapInPandas(run, "segment_id long, idx int, z double").groupBy("segment_id", "idx").agg(F.avg("z").alias("z"))
    each = mean.groupBy("segment_id").agg(F.max("z").alias("top"), F.max_by("idx", F.struct("z", -F.col("idx"))).alias("pred_idx"), F.collect_list("z").alias("zs"))
    prob = 1 / F.aggregate(F.transform("zs", lambda z: F.exp(z - F.col("top"))), F.lit(0.0), lambda a, b: a + b)
    label = F.coalesce(F.get(F.array(*map(F.lit, labels)), F.col("pred_idx")), F.concat(F.lit("class_"), "pred_idx")) if labels else F.concat(F.lit("class_"), "pred_idx")
    return each.select("segment_id", "pred_idx", F.when(prob < unknown, "UNKNOWN").otherwise(label).alias("pred_label"), prob.alias("prob_top1"))
