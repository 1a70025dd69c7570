"""Image rejection of captures in four conventions: by file, by segment, across files and under decimation.

Conjugation mirrors a spectrum and a factor j leaves it, so one transform serves all conventions: I+jQ and Q-jI have
the power of x, I-jQ and Q+jI its mirror image. Ties go to the convention named first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..sources.captures import BLOCK_FRAMES
from .captures import IRR_FFT
from .intervals import KEYS, of_blocks, pieces

CONVENTIONS = ("I+jQ", "I-jQ", "Q+jI", "Q-jI")
#: The longest table of files that goes to the blocks.
BROADCAST_FILES = 50_000
FACTORS = (1, 2, 3, 4, 5, 8, 10, 16)
#: What step two and step five call a convention.
SHORT = {"I+jQ": "I+Q", "I-jQ": "I-Q", "Q+jI": "Q+I", "Q-jI": "Q-I"}


def _powers(x: np.ndarray, size: int, legacy: bool = False) -> tuple[float, float, float, float]:
    fft = kernels.fft_size(size, max(1, len(x)))
    fft = min(fft, max(1, len(x))) if legacy else fft
    return kernels.all_band_powers(x, fft)


def _best(plain: Column, mirrored: Column) -> dict[str, Column]:
    return {"best_convention": F.when(plain >= mirrored, CONVENTIONS[0]).otherwise(CONVENTIONS[1]), "best_irr_db": F.greatest(plain, mirrored), **{f"irr_{k}": v for k, v in (("i_q", plain), ("i_neg_q", mirrored), ("q_i", mirrored), ("q_neg_i", plain))}}


def by_interval(blocks: DataFrame, intervals: DataFrame, size: int = IRR_FFT, block_frames: int = BLOCK_FRAMES, legacy: bool = False) -> DataFrame:
    """(file_id, interval_id, best_convention, best_irr_db, irr_*): a centre crop of each interval, its own mean removed.

    The mean is the interval's; the crop, size samples at most, is gathered in one task. legacy gives the older form: no
    transform longer than the interval, and absolute values, of which the first largest is the best.
    """
    width = F.least(F.lit(size), F.pow(F.lit(2), F.floor(F.log2(F.greatest(F.col("end_sample") - F.col("start_sample"), F.lit(1)))))).cast("long")
    middle = intervals.withColumn("w", F.greatest(F.lit(4096), width))
    start = F.col("start_sample") + F.greatest(F.lit(0), F.floor((F.col("end_sample") - F.col("start_sample") - F.col("w")) / 2))
    crop = middle.select(*KEYS, start.alias("start_sample"), F.least(F.col("end_sample"), start + F.col("w")).alias("end_sample"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(r.file_id, w["interval_id"], x.real.sum(), x.imag.sum(), own) for r in batch.itertuples() for w, x, _, own, _ in pieces(r)]
            yield pd.DataFrame(rows, columns=["file_id", "interval_id", "re", "im", "n"])

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w, x, _, _, at in pieces(r):
                    yield pd.DataFrame({"file_id": [r.file_id], "interval_id": [w["interval_id"]], "at": [at], "re": [x.real], "im": [x.imag]})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        x = np.concatenate(group["re"].to_list()) - group["mre"].iat[0] + 1j * (np.concatenate(group["im"].to_list()) - group["mim"].iat[0])
        return pd.DataFrame([(group["file_id"].iat[0], group["interval_id"].iat[0], *_powers(x, size, legacy))], columns=["file_id", "interval_id", "pos", "neg", "cpos", "cneg"])

    mean = of_blocks(blocks, intervals, block_frames).mapInPandas(sums, "file_id string, interval_id long, re double, im double, n long").groupBy(*KEYS)
    mean = mean.agg((F.sum("re") / F.sum("n")).alias("mre"), (F.sum("im") / F.sum("n")).alias("mim"))
    cut = of_blocks(blocks, crop, block_frames).mapInPandas(parts, "file_id string, interval_id long, at long, re array<double>, im array<double>")
    power = cut.join(mean, list(KEYS)).groupBy(*KEYS).applyInPandas(run, "file_id string, interval_id long, pos double, neg double, cpos double, cneg double")
    plain, mirrored = (10 * F.log10(F.col(a) / (F.col(b) + 1e-12)) for a, b in (("pos", "neg"), ("cpos", "cneg")))
    if legacy:
        plain, mirrored = F.abs(10 * F.log10(F.col("pos") / F.col("neg"))), F.abs(10 * F.log10(F.col("cpos") / F.col("cneg")))
    return power.withColumns(_best(plain, mirrored)).drop("pos", "neg", "cpos", "cneg")


def variability(rows: DataFrame, by: str | None = "file_id", order: str = "interval_id", low: float = 2.0, high: float = 10.0) -> DataFrame:
    """Statistics of best_irr_db of rows: by file over segments, or over files with by=None (thresholds 5 and 20 there).

    consistency is the share of the first row's convention; most_common_convention is the most frequent one, of equally
    frequent ones the first named.
    """
    keys = [by] if by else []
    counts = rows.groupBy(*keys, "best_convention").agg(F.count("*").alias("n"))
    rank = F.struct(F.col("n"), -F.array_position(F.array(*map(F.lit, CONVENTIONS)), F.col("best_convention")))
    modes = counts.groupBy(*keys).agg(F.max_by("best_convention", rank).alias("most_common_convention"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("best_convention", "n")))).alias("distribution"))
    first = F.min_by("best_convention", order)
    irr = F.col("best_irr_db")
    stats = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(irr).alias("mean_irr"), F.stddev_pop(irr).alias("std_irr"), F.min(irr).alias("min_irr"), F.max(irr).alias("max_irr"), (F.max(irr) - F.min(irr)).alias("range_irr"), first.alias("first"))
    both = stats.join(modes, keys) if keys else stats.crossJoin(modes)  # one row each
    verdict = F.when(F.col("range_irr") < low, "LOW").when(F.col("range_irr") < high, "MODERATE").otherwise("HIGH")
    return both.withColumns({"consistency": F.element_at("distribution", F.col("first")) / F.col("n"), "variability": verdict}).drop("first")


def sampling_sweep(blocks: DataFrame, factors: tuple[int, ...] = FACTORS, frame: int = 4096) -> DataFrame:
    """(file_id, factor, fs_hz, best_convention, irr_db, baseline_db, difference_db): every factor-th sample of whole captures.

    Samples are taken by their place in the file. Band powers are summed over consecutive frames of `frame` taken
    samples, each less the mean of the file's taken samples; the baseline is factor 1 in its best convention, which all
    factors then use. A frame belongs to the block that holds its first sample; the last part of a file that fills no
    frame counts for factors that have a frame, by none.
    """
    reach = frame * max(factors)

    def means(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                x = kernels.complex_of(r.i, r.q)
                rows += [(r.file_id, f, y.real.sum(), y.imag.sum(), len(y)) for f in factors for y in (x[-r.start_sample % f :: f],)]
            yield pd.DataFrame(rows, columns=["file_id", "factor", "re", "im", "n"])

    def powers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .captures import samples_of

        for batch in batches:
            for r in batch.itertuples():
                x, _ = samples_of(r, after=reach)
                rows = []
                for m in r.means:
                    f = m["factor"]
                    first = -r.start_sample % (frame * f)
                    total = np.zeros(4)
                    for s in range(first, min(len(r.i), len(x) - (frame - 1) * f), frame * f):
                        y = x[s : s + frame * f : f][:frame] - complex(m["mre"], m["mim"])
                        if len(y) == frame:
                            total += kernels.all_band_powers(y, frame)
                    rows.append((r.file_id, f, r.fs_hz / f, *total))
                yield pd.DataFrame(rows, columns=["file_id", "factor", "fs_hz", "pos", "neg", "cpos", "cneg"])

    from .captures import with_halo

    dc = blocks.select("file_id", "start_sample", "i", "q").mapInPandas(means, "file_id string, factor int, re double, im double, n long").groupBy("file_id", "factor")
    dc = dc.agg((F.sum("re") / F.greatest(F.sum("n"), F.lit(1))).alias("mre"), (F.sum("im") / F.greatest(F.sum("n"), F.lit(1))).alias("mim"))
    lists = dc.groupBy("file_id").agg(F.collect_list(F.struct("factor", "mre", "mim")).alias("means"))
    near = with_halo(blocks, "start_sample", "fs_hz", "i", "q", after=reach).join(lists, "file_id")
    sums = near.mapInPandas(powers, "file_id string, factor int, fs_hz double, pos double, neg double, cpos double, cneg double").groupBy("file_id", "factor", "fs_hz").agg(*(F.sum(c).alias(c) for c in ("pos", "neg", "cpos", "cneg")))
    rows = sums.where("pos > 0").withColumns({"plain": 10 * F.log10(F.col("pos") / F.col("neg")), "mirrored": 10 * F.log10(F.col("cpos") / F.col("cneg"))})
    return _against_baseline(rows)


def _against_baseline(rows: DataFrame) -> DataFrame:
    """rows(file_id, factor, fs_hz, plain, mirrored) -> the sweep's columns; a window over a file's factors, not a join."""
    file = Window.partitionBy("file_id")
    at_one = lambda c: F.max(F.when(F.col("factor") == 1, F.col(c))).over(file)
    rows = rows.withColumns({"plain_1": at_one("plain"), "mirrored_1": at_one("mirrored")}).where("plain_1 is not null")
    direct = F.col("plain_1") >= F.col("mirrored_1")
    rows = rows.withColumns({"best_convention": F.when(direct, CONVENTIONS[0]).otherwise(CONVENTIONS[1]), "irr_db": F.when(direct, F.col("plain")).otherwise(F.col("mirrored")), "baseline_db": F.greatest("plain_1", "mirrored_1")})
    return rows.select("file_id", "factor", "fs_hz", "best_convention", "irr_db", "baseline_db", (F.col("irr_db") - F.col("baseline_db")).alias("difference_db"))


def single_transform_sweep(blocks: DataFrame, files: DataFrame, factors: tuple[int, ...] = FACTORS, target: int = 1 << 18, most_frames: int | None = None) -> DataFrame:
    """sampling_sweep's columns by one transform a factor, of the centre crop of the capture's every factor-th sample.

    files(file_id, frames, fs_hz) has the lengths, most_frames leaves out what follows (20 million in the surveyed
    script). A factor's transform is the largest power of two within target and its samples, between 4096 and 2^20;
    fewer samples stand in the middle of zeros. The mean of all its samples is taken off first. Blocks are read once for
    the means and once for the crops; a task holds one crop, 2^20 samples at most.
    """
    n = F.col("frames") if most_frames is None else F.least("frames", F.lit(most_frames))
    plan = files.select("file_id", F.col("fs_hz").alias("rate"), n.alias("total"), F.explode(F.array(*map(F.lit, factors))).alias("factor"))
    count = F.ceil(F.col("total") / F.col("factor"))
    bits = F.length(F.conv(F.greatest(F.least(count, F.lit(target)), F.lit(1)).cast("string"), 10, 2)) - 1
    size = F.greatest(F.lit(4096), F.least(F.lit(1 << 20), F.expr("shiftleft(1, cast(bits as int))")))
    plan = plan.withColumn("count", count.cast("long")).withColumn("bits", bits).withColumn("size", size.cast("long"))
    plan = plan.withColumn("first", F.greatest(F.lit(0), F.floor((F.col("count") - F.col("size")) / 2)).cast("long"))
    lists = plan.groupBy("file_id").agg(F.first("rate").alias("rate"), F.first("total").alias("total"), F.collect_list(F.struct("factor", "count", "size", "first")).alias("wanted"))
    lists = F.broadcast(lists) if files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES else lists
    near = blocks.select("file_id", "start_sample", "i", "q").join(lists, "file_id").where("start_sample < total")

    def taken(r, f: int) -> tuple[np.ndarray, int]:
        """The block's samples at multiples of f before the total, and the number of the first one."""
        x = kernels.complex_of(r.i, r.q)[: max(0, r.total - r.start_sample)]
        return x[-r.start_sample % f :: f], -(-r.start_sample // f)

    def means(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(r.file_id, w["factor"], y.real.sum(), y.imag.sum()) for r in batch.itertuples() for w in r.wanted for y in (taken(r, w["factor"])[0],)]
            yield pd.DataFrame(rows, columns=["file_id", "factor", "re", "im"])

    def crops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                for w in r.wanted:
                    y, at = taken(r, w["factor"])
                    a, b = max(at, w["first"]), min(at + len(y), w["first"] + w["size"])
                    if b > a:
                        part = y[a - at : b - at]
                        yield pd.DataFrame({"file_id": [r.file_id], "factor": [w["factor"]], "size": [w["size"]], "count": [w["count"]], "fs_hz": [r.rate / w["factor"]], "at": [a - w["first"]], "re": [part.real], "im": [part.imag]})

    def transformed(group: pd.DataFrame) -> pd.DataFrame:
        size, one = int(group["size"].iat[0]), group.iloc[0]
        x, n = np.zeros(size, complex), min(size, int(one["count"]))
        left = (size - n) // 2
        for at, re, im in zip(group["at"], group["re"], group["im"], strict=True):
            x[left + at : left + at + len(re)] = np.asarray(re) + 1j * np.asarray(im)
        x[left : left + n] -= complex(one["mre"], one["mim"])
        pos, neg, cpos, cneg = kernels.all_band_powers(x, size)
        return pd.DataFrame({"file_id": [one["file_id"]], "factor": [one["factor"]], "fs_hz": [one["fs_hz"]], "plain": [10 * np.log10(pos / neg)], "mirrored": [10 * np.log10(cpos / cneg)]})

    dc = near.mapInPandas(means, "file_id string, factor int, re double, im double").groupBy("file_id", "factor").agg(F.sum("re").alias("re"), F.sum("im").alias("im"))
    parts = near.mapInPandas(crops, "file_id string, factor int, size long, count long, fs_hz double, at long, re array<double>, im array<double>").join(dc.withColumnsRenamed({"re": "mre", "im": "mim"}), ["file_id", "factor"])
    parts = parts.withColumns({"mre": F.col("mre") / F.col("count"), "mim": F.col("mim") / F.col("count")})
    return _against_baseline(parts.groupBy("file_id", "factor").applyInPandas(transformed, "file_id string, factor int, fs_hz double, plain double, mirrored double"))


def worst_degradation(sweep: DataFrame) -> DataFrame:
    """(file_id, factor, difference_db): the factor that loses most."""
    return sweep.groupBy("file_id").agg(F.min_by("factor", F.struct("difference_db", "factor")).alias("factor"), F.min("difference_db").alias("difference_db"))


def chosen_factor(candidates: DataFrame, sweep: DataFrame) -> DataFrame:
    """candidates(file_id, factor, base, place) and measured factors -> (file_id, factor, irr_db, grade): the best by rejection.

    Of equal ones the earlier candidate; where none was measured, the base factor without a value.
    """
    both = candidates.join(sweep.select("file_id", "factor", "irr_db"), ["file_id", "factor"], "left")
    best = both.groupBy("file_id").agg(F.max_by("factor", F.when(F.col("irr_db").isNotNull(), F.struct("irr_db", -F.col("place")))).alias("f"), F.max("irr_db").alias("irr_db"), F.first("base").alias("base"))
    grade = F.when(F.col("irr_db") > 10, "GOOD").when(F.col("irr_db") > 0, "OK").otherwise("POOR")
    return best.select("file_id", F.coalesce("f", "base").alias("factor"), "irr_db", grade.alias("grade"))


def sampling_decision(files: DataFrame, target_s: float = 60.0, min_samples: float = 10e6) -> DataFrame:
    """files(file_id, frames, fs_hz) -> (file_id, sampled, factor, fs_hz): short or small files are taken whole."""
    long = (F.col("frames") / F.col("fs_hz") > target_s) & (F.col("frames") > min_samples)
    factor = F.when(long, F.ceil(F.col("frames") / F.col("fs_hz") / target_s)).otherwise(1).cast("long")
    return files.select("file_id", long.alias("sampled"), factor.alias("factor"), (F.col("fs_hz") / factor).alias("fs_hz"))


#: Bands of image rejection from a number of dB on, and the accuracy expected of a classifier there, in percent.
BANDS = (("excellent", 30.0, 95, 98), ("good", 20.0, 90, 95), ("marginal", 10.0, 75, 90), ("poor", 5.0, 60, 75), ("very_poor", None, 40, 60))


def bands(spark: SparkSession) -> DataFrame:
    """BANDS as a table: (band, from_db, accuracy_low, accuracy_high); very_poor has no lower bound."""
    return spark.createDataFrame(BANDS, "band string, from_db double, accuracy_low int, accuracy_high int")


def band(irr_db: Column) -> Column:
    """The band of a value: excellent above 30 dB, the others from their bound on; null of null."""
    out = F.when(irr_db.isNotNull(), F.lit(BANDS[-1][0]))
    for name, low, *_ in reversed(BANDS[:-1]):
        out = F.when(irr_db > low if name == "excellent" else irr_db >= low, name).otherwise(out)
    return out


def comparison(stats: DataFrame, conv: str | None = None) -> DataFrame:
    """Rejection as measured in step one against that of the convention a later step applies, by file.

    stats(file_id, best_convention, best_irr_db, direct_db, mirrored_db), as assessment.statistics has them; conv is a short
    name (I+Q, I-Q, Q+I, Q-I), or None for each file's own best one. -> (file_id, conv_applied, corrected_irr_db,
    step1_irr_db, step1_convention, irr_improvement_db, verdict, band). A file without step one's values has nulls
    there, Unknown as its convention, and no verdict.
    """
    if conv is not None and conv not in SHORT.values():
        raise ValueError(f"no such convention: {conv}")
    rows = channel_order(stats).withColumn("conv_applied", F.col("conv") if conv is None else F.lit(conv))
    corrected = F.when(F.col("conv_applied").isin(SHORT[CONVENTIONS[0]], SHORT[CONVENTIONS[3]]), F.col("direct_db")).otherwise(F.col("mirrored_db"))
    gain = F.col("corrected_irr_db") - F.col("step1_irr_db")
    verdict = F.when(gain > 5, "significant").when(gain > 1, "moderate").when(gain > -1, "minimal").when(gain.isNotNull(), "degraded")
    rows = rows.withColumns({"corrected_irr_db": corrected, "step1_irr_db": F.col("best_irr_db"), "step1_convention": F.coalesce("best_convention", F.lit("Unknown"))})
    return rows.select("file_id", "conv_applied", "corrected_irr_db", "step1_irr_db", "step1_convention", gain.alias("irr_improvement_db"), verdict.alias("verdict"), band(F.col("corrected_irr_db")).alias("band"))


def channel_order(best: DataFrame) -> DataFrame:
    """(..., best_convention) with conv (the short name, I+Q where unknown) and channel_order (QI for Q first)."""
    names = F.create_map(*(F.lit(x) for kv in SHORT.items() for x in kv))
    conv = F.coalesce(F.element_at(names, F.col("best_convention")), F.lit("I+Q"))
    return best.withColumns({"conv": conv, "channel_order": F.when(F.startswith(conv, F.lit("Q")), "QI").otherwise("IQ")})
