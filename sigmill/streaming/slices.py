"""Activity slices from an unbounded stream of per-block runs, by file; the same rows as the batch operator gives.

Blocks are reduced to runs before the state: (lo, hi) of each block and the stretches (s, e) within it whose running RMS
exceeds the threshold. A file's blocks may arrive in any order within the watermark's delay and wait in typed state by
second (`ordered`); a slice is emitted once the watermark has passed what could still join it. The state of a file is the
runs of one delay and one open slice.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from .ordered import ORIGIN_MS, Ordered

SLICE = "file_id string, start_sample long, end_sample long, start_s double, end_s double, duration_ms double"
FIELDS = {"lo": "long", "hi": "long", "chunk_id": "long", "s": "long", "e": "long", "fs_hz": "double"}
#: The chunk in work with what is known of it and its island of runs, and the padded slice that may still be joined.
OPEN = {"rate": "double", "chunk": "long", "lo": "long", "hi": "long", "s": "long", "e": "long", "open_s": "long", "open_e": "long"}


class Slices(Ordered):
    def __init__(self, gap_ms: float, pad_ms: float, min_ms: float):
        super().__init__(FIELDS, [x.strip().split()[0] for x in SLICE.split(",")])
        self.ms = gap_ms, pad_ms, min_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open", ", ".join(f"`{c}` {kind}" for c, kind in OPEN.items()))

    def take(self, rows: list[tuple]) -> list[tuple]:
        at, done = dict(zip(OPEN, self.state.get(), strict=True)) if self.state.exists() else None, []
        for lo, hi, chunk, s, e, rate in sorted(rows, key=lambda r: (r[0], -1 if r[3] is None else r[3])):
            gap = round(rate * self.ms[0] / 1000)
            at = at or dict.fromkeys(OPEN)
            if at["chunk"] != chunk:
                done += self._close(at)
                at |= {"rate": rate, "chunk": chunk, "lo": lo, "hi": hi}
            at["lo"], at["hi"] = min(at["lo"], lo), max(at["hi"], hi)
            if s is None:
                continue
            if at["s"] is not None and s - at["e"] > gap:
                done += self._close(at)  # its pad lies before this run, within what is known of the chunk
            at["s"] = s if at["s"] is None else at["s"]
            at["e"] = e if at["e"] is None else max(at["e"], e)
        if at:
            self.state.update(tuple(at.values()))
        return done

    def _close(self, at: dict) -> list[tuple]:
        """The island becomes the open slice or joins it; -> the slice that was open, if they do not touch."""
        if at["s"] is None:
            return []
        pad, least = (round(at["rate"] * ms / 1000) for ms in self.ms[1:])
        s, e = max(at["s"] - pad, at["lo"]), min(at["e"] + pad, at["hi"])
        at["s"] = at["e"] = None
        if e - s < least:
            return []
        if at["open_s"] is not None and s <= at["open_e"]:
            at["open_e"] = max(at["open_e"], e)
            return []
        done = self._row(at)
        at["open_s"], at["open_e"] = s, e
        return done

    def _row(self, at: dict) -> list[tuple]:
        s, e, rate = at["open_s"], at["open_e"], at["rate"]
        return [] if s is None else [(s, e, s / rate, e / rate, (e - s) * 1000 / rate)]

    def closes_ms(self) -> float | None:
        if not self.state.exists():
            return None
        at = dict(zip(OPEN, self.state.get(), strict=True))
        return (at["hi"] + sum(round(at["rate"] * ms / 1000) for ms in self.ms[:2]) + 1) / at["rate"] * 1000 + ORIGIN_MS

    def settle(self) -> list[tuple]:
        at = dict(zip(OPEN, self.state.get(), strict=True))
        done = self._close(at) + self._row(at)
        self.state.clear()
        return done


def activity_slices(runs: DataFrame, gap_ms: float = 3, pad_ms: float = 2, min_ms: float = 5, delay: str = "10 seconds") -> DataFrame:
    """runs(file_id, chunk_id, fs_hz, lo, hi, s, e), streaming: a row a run, and one with null s and e for each block.

    Gaps are closed within a chunk, slices are padded within it, short ones go, touching ones of all chunks are joined.
    lo and hi are the block's first sample and the one behind its last; event time is lo in seconds. A pad longer than the
    gap would reach past what is known of a chunk and is refused.
    """
    if pad_ms > gap_ms:
        raise ValueError("the pad must not be longer than the gap")

    at_us = (F.col("lo") / F.col("fs_hz") * 1e6 + ORIGIN_MS * 1000).cast("long")
    timed = runs.withColumn("at_us", at_us).withColumn("at", F.timestamp_micros("at_us")).select("file_id", "at", "at_us", *FIELDS).withWatermark("at", delay)
    return timed.groupBy("file_id").transformWithStateInPandas(Slices(gap_ms, pad_ms, min_ms), SLICE, "append", "EventTime")


def chunks(blocks: DataFrame, seg_s: float = 10.0, hop_s: float | None = None) -> DataFrame:
    """A stream of blocks with the event-time windows (seg_s long, hop_s apart) that they begin in: a fixed chunk plan."""
    at = F.timestamp_micros((F.col("start_sample") / F.col("fs_hz") * 1e6).cast("long"))
    length = f"{math.floor(seg_s * 1e6)} microseconds"
    return blocks.withColumn("at", at).withColumn("chunk", F.window("at", length, f"{math.floor((hop_s or seg_s) * 1e6)} microseconds"))
