"""Quality of captures from their blocks: statistics, image rejection, envelope, and what they mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import captures as ops

IRR_THRESHOLD = 20.0


def statistics(blocks: DataFrame, size: int = ops.IRR_FFT) -> DataFrame:
    """A row a file: channel statistics, nan_count, inf_count, best_convention, best_irr_db,
    direct_db and mirrored_db (see captures.image_rejection), envelope_kurtosis, duration_s.

    Two passes over the samples: one for everything but the envelope, whose DC removal needs the chunk means.
    """
    parts = ops.block_statistics(blocks, size).persist()  # a row a block, made again where an executor is lost
    rates = parts.groupBy("file_id").agg(F.first("fs_hz").alias("fs_hz"))
    irr = ops.image_rejection(blocks, size, parts).select("file_id", F.when(F.col("best") == "I+Q", "I+jQ").otherwise("I-jQ").alias("best_convention"), F.col("irr_db").alias("best_irr_db"), "direct_db", "mirrored_db")
    kurtosis = ops.envelope_kurtosis(blocks, ops.chunk_means(parts)).select("file_id", "envelope_kurtosis")
    rows = ops.channel_moments(blocks, parts).join(irr, "file_id").join(kurtosis, "file_id", "left").join(rates, "file_id")
    return rows.withColumns({"nan_count": F.col("i_nan") + F.col("q_nan"), "inf_count": F.col("i_inf") + F.col("q_inf"), "duration_s": F.col("frames") / F.col("fs_hz"), "envelope_kurtosis": F.coalesce("envelope_kurtosis", F.lit(0.0))})


def _first(*cases: tuple[Column, Column | str | int]) -> Column:
    out = F.lit(None)
    for when, then in reversed(cases):
        out = F.when(when, then if isinstance(then, Column) else F.lit(then)).otherwise(out)
    return out


def assess(stats: DataFrame, short_s: float | None = None) -> DataFrame:
    """statistics' rows with quality_score (100 less penalties, 0 at least), verdict and arrays of issues, warnings and recommendations.

    Penalties: NaN 20, infinite 20; clipping over 5 %: 25, over 1 %: 10, over 0.1 %: 5; image rejection under 10 dB: 15,
    under 20 dB: 5. The envelope, and with short_s (0.1 in the older form) a short recording, are warnings alone.
    """
    clip, irr, kurt = F.greatest("i_clip_pct", "q_clip_pct"), F.col("best_irr_db"), F.col("envelope_kurtosis")
    one = lambda x: F.format_string("%.1f", x)
    penalty = F.when(F.col("nan_count") > 0, 20).otherwise(0) + F.when(F.col("inf_count") > 0, 20).otherwise(0)
    penalty += F.coalesce(_first((clip > 5, 25), (clip > 1, 10), (clip > 0.1, 5)), F.lit(0)) + F.coalesce(_first((irr < 10, 15), (irr < IRR_THRESHOLD, 5)), F.lit(0))
    issues = F.array(
        F.when(F.col("nan_count") > 0, F.concat(F.lit("Found "), "nan_count", F.lit(" NaN values"))), F.when(F.col("inf_count") > 0, F.concat(F.lit("Found "), "inf_count", F.lit(" infinite values"))),
        F.when(clip > 5, F.concat(F.lit("Severe clipping detected: "), one(clip), F.lit("%"))), F.when(irr < 10, F.concat(F.lit("Poor I/Q balance (IRR: "), one(irr), F.lit(" dB)"))),
    )
    warnings = [
        _first((clip > 5, F.lit(None)), (clip > 1, F.concat(F.lit("Moderate clipping detected: "), one(clip), F.lit("%"))), (clip > 0.1, F.concat(F.lit("Minor clipping detected: "), one(clip), F.lit("%")))),
        F.when((irr >= 10) & (irr < IRR_THRESHOLD), F.concat(F.lit("Suboptimal I/Q balance (IRR: "), one(irr), F.lit(" dB)"))),
        _first((kurt < 1.5, "Very constant envelope detected - may indicate CW or unmodulated carrier"), (kurt > 10, "Highly variable envelope detected - check for intermittent signals or interference")),
    ]
    if short_s is not None:
        warnings.append(F.when(F.col("duration_s") < short_s, F.concat(F.lit("Very short recording ("), F.format_string("%.3f", "duration_s"), F.lit("s) - may not be sufficient for analysis"))))
    name = F.replace(F.replace(F.replace("best_convention", F.lit("+j"), F.lit(" ")), F.lit("-j"), F.lit(" -")), F.lit("j"), F.lit(""))
    advice = F.array(F.when(F.col("best_convention") != "I+jQ", F.concat(F.lit("Consider using --conv "), name, F.lit(" in downstream processing"))))
    score = F.greatest(F.lit(0), F.lit(100) - penalty)
    texts = {"issues": F.array_compact(issues), "warnings": F.array_compact(F.array(*(w.cast("string") for w in warnings))), "recommendations": F.array_compact(advice)}
    verdict = F.when(score >= 80, "good").when(score >= 60, "marginal").otherwise("poor")
    return stats.withColumns({"quality_score": score.cast("double"), "verdict": verdict, **texts})
