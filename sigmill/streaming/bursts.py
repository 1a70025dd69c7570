"""Bursts from an unbounded stream of classified segments, by file; the same rows as the batch query gives.

Segments may arrive in any order within the watermark's delay. They wait in typed state by second (`ordered`) until the
watermark has passed it, so the state of a file is the segments of one delay and sums of one open burst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from .ordered import ORIGIN_MS, Ordered

GAP_S, UNKNOWN = 0.06, "UNKNOWN"
BURST = "file_id {kind}, pred_label string, avg_prob double, start_s double, end_s double, offset_hz double, bandwidth_hz double, snr_db double, n_segments long"
FIELDS = {"start_s": "double", "segment_id": "long", "end_s": "double", "pred_label": "string", "prob": "double", "offset_hz": "double", "bw_hz": "double", "snr_db": "double"}
SUMS = {"label": "string", "start": "double", "end": "double", "n": "long", "prob": "double", "n_prob": "long", "seconds": "double", "shift": "double", "n_shift": "long", "width": "double"}


class Bursts(Ordered):
    """The open burst's sums are one value; its SNR values a map of counts.

    SNR values count by hundredths of a dB, as segments report them, so their median is exact and memory does not grow
    with a long burst.
    """

    def __init__(self, gap_s: float, out: list[str]):
        super().__init__(FIELDS, out)
        self.gap_s = gap_s

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", ", ".join(f"`{c}` {kind}" for c, kind in SUMS.items()))
        self.snr = handle.getMapState("snr", "hundredths long", "n long")

    def take(self, rows: list[tuple]) -> list[tuple]:
        burst, counts, done = dict(zip(SUMS, self.sums.get(), strict=True)) if self.sums.exists() else None, {}, []
        for start, _, end, label, prob, offset, width, snr in sorted(rows, key=lambda r: r[:2]):
            if burst and (label in (None, UNKNOWN) or label != burst["label"] or start - burst["end"] > self.gap_s):
                done.append(self._row(burst, counts))
                burst, counts = None, {}
            burst = burst or {"label": label, "start": start, "end": end, "n": 0, "prob": 0.0, "n_prob": 0, "seconds": 0.0, "shift": 0.0, "n_shift": 0, "width": None}
            burst["end"] = max(burst["end"], end)
            burst["n"] += 1
            burst["seconds"] += end - start
            if prob is not None:
                burst["prob"], burst["n_prob"] = burst["prob"] + prob, burst["n_prob"] + 1
            if offset is not None:
                burst["shift"], burst["n_shift"] = burst["shift"] + offset * (end - start), burst["n_shift"] + 1
            if width is not None:
                burst["width"] = width if burst["width"] is None else max(burst["width"], width)
            if snr is not None:
                counts[round(snr * 100)] = counts.get(round(snr * 100), 0) + 1
        if burst:
            self.sums.update(tuple(burst.values()))
            for value, n in counts.items():
                old = self.snr.getValue((value,))
                self.snr.updateValue((value,), (n + (old[0] if old else 0),))
        return done

    def closes_ms(self) -> float | None:
        return (self.sums.get()[list(SUMS).index("end")] + self.gap_s) * 1000 + ORIGIN_MS if self.sums.exists() else None

    def settle(self) -> list[tuple]:
        row = self._row(dict(zip(SUMS, self.sums.get(), strict=True)), {})
        self.sums.clear()
        return [row]

    def _row(self, b: dict, counts: dict[int, int]) -> tuple:
        """Duration-weighted offset, widest band, median SNR; unknown values are left out, as SQL's aggregates do."""
        for (value,), (n,) in list(self.snr.iterator()) if self.snr.exists() else []:
            counts[value] = counts.get(value, 0) + n
        self.snr.clear()
        total, past, found = sum(counts.values()), 0, []
        for value in sorted(counts):
            past += counts[value]
            while len(found) < 2 and past > ((total - 1) // 2, total // 2)[len(found)]:
                found.append(value / 100)
        median = sum(found) / 2 if found else None
        return b["label"], b["prob"] / b["n_prob"] if b["n_prob"] else None, b["start"], b["end"], b["shift"] / max(b["seconds"], 1e-12) if b["n_shift"] else None, b["width"], median, b["n"]


def _timed(segments: DataFrame, delay: str, *columns: str) -> DataFrame:
    at_us = (F.col("start_s") * 1e6 + ORIGIN_MS * 1000).cast("long")
    timed = segments.where("start_s IS NOT NULL AND end_s IS NOT NULL").withColumn("at_us", at_us).withColumn("at", F.timestamp_micros("at_us"))
    return timed.select("file_id", "at", "at_us", *columns).withWatermark("at", delay)


def bursts(segments: DataFrame, gap_s: float = GAP_S, delay: str = "10 seconds") -> DataFrame:
    """segments(file_id, segment_id, start_s, end_s, pred_label, prob, offset_hz, bw_hz, snr_db), streaming.

    A burst is emitted once the watermark is past the second that holds its end and the gap. An unknown or null label stands
    alone; a segment without a start or end belongs to no burst. Other columns are ignored.
    """
    out = BURST.format(kind=segments.schema["file_id"].dataType.simpleString())
    names = [x.strip().split()[0] for x in out.split(",")]
    return _timed(segments, delay, *FIELDS).groupBy("file_id").transformWithStateInPandas(Bursts(gap_s, names), out, "append", "EventTime")


def spans(segments: DataFrame, gap_s: float = GAP_S, delay: str = "10 seconds") -> DataFrame:
    """Stretches of segments(file_id, start_s, end_s) of any label with no gap over gap_s, streaming or not, by Spark's own
    session windows: a segment's session lasts to its end and the gap, and sessions that meet merge.

    -> (file_id, start_s, end_s, n_segments). Times count in microseconds. A segment without a start or end, or with its end
    before its start, belongs to none. A stream gives a stretch once the watermark is past it.
    """
    gap_us = round(gap_s * 1e6)
    if gap_us < 1:  # Spark drops the rows of sessions without length
        raise ValueError("the gap must be a microsecond at least")
    us = lambda c: F.round(F.col(c) * 1e6).cast("long")
    valid = segments.where("end_s >= start_s").withColumns({"from_us": us("start_s") + ORIGIN_MS * 1000, "to_us": us("end_s") + ORIGIN_MS * 1000})
    timed = valid.select("file_id", F.timestamp_micros("from_us").alias("at"), "from_us", "to_us")
    length = F.concat((F.col("to_us") - F.col("from_us") + gap_us).cast("string"), F.lit(" microseconds"))
    grouped = timed.withWatermark("at", delay).groupBy("file_id", F.session_window("at", length)).agg(F.min("from_us").alias("a"), F.max("to_us").alias("b"), F.count("*").alias("n_segments"))
    seconds = lambda c: (F.col(c) - ORIGIN_MS * 1000) / 1e6
    return grouped.select("file_id", seconds("a").alias("start_s"), seconds("b").alias("end_s"), "n_segments")
