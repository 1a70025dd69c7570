"""Rows of a stream in the order of their times, by key, as typed state with timers.

Rows may arrive in any order within the watermark's delay. Each second of event time waits as one entry of a map state and
has a timer; when the watermark has passed the second, its rows are taken in order and the entry goes. So a trigger touches
the seconds that new rows fall into and those that end, and nothing else that waits. Needs the RocksDB state store
(spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SECOND_MS = 1000
#: Event times begin here, not at 0, where a stream's first watermark stands.
ORIGIN_MS = 1000


class Ordered(StatefulProcessor):
    """Subclasses say what to do with rows in order (`take`), until when what is open may still grow (`closes_ms`), and how
    it ends (`settle`). Their own state is opened in `open`. Batches have a column at_us, the event time with its origin."""

    def __init__(self, fields: dict[str, str], out: list[str]):
        self.fields, self.out = fields, out

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def take(self, rows: list[tuple]) -> list[tuple]:
        raise NotImplementedError

    def closes_ms(self) -> float | None:
        raise NotImplementedError

    def settle(self) -> list[tuple]:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        row = ", ".join(f"{c}: {kind}" for c, kind in self.fields.items())
        self.held = handle.getMapState("held", "second long", f"waiting array<struct<{row}>>")
        self.due = handle.getValueState("due", "at_ms long")
        self.open(handle)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, list[tuple]] = {}
        for batch in rows:
            values = batch[list(self.fields)].astype(object)
            values = values.where(values.notna(), None)
            for at, row in zip((batch["at_us"] // (SECOND_MS * 1000)).tolist(), values.itertuples(index=False, name=None), strict=True):
                fresh.setdefault(at, []).append(tuple(int(x) if x is not None and kind == "long" else x for x, kind in zip(row, self.fields.values(), strict=True)))
        for second, new in fresh.items():
            old = self.held.getValue((second,))
            self.held.updateValue((second,), ([tuple(r) for r in old[0]] + new if old else new,))
            if not old:
                self.handle.registerTimer((second + 1) * SECOND_MS)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        due = self.due.get()[0] if self.due.exists() else None
        if at % SECOND_MS:  # what was open ends here, unless it has grown since
            done = self.settle() if at == due else []
            if at == due:
                self.due.clear()
        else:
            waiting = self.held.getValue((at // SECOND_MS - 1,))
            done = self.take([tuple(r) for r in waiting[0]]) if waiting else []
            self.held.removeKey((at // SECOND_MS - 1,))
            done += self._reschedule(at, mark, due)
        if done:
            yield pd.DataFrame([(*key, *d) for d in done], columns=self.out)

    def _reschedule(self, at: int, mark: int, due: int | None) -> list[tuple]:
        """The timer of what is open, just behind the second in which a row could still join it."""
        closes = self.closes_ms()
        want = None if closes is None else (int(closes) // SECOND_MS + 1) * SECOND_MS + 1
        if due is not None and due != want:
            self.handle.deleteTimer(due)
            self.due.clear()
        if want is None or due == want:
            return []
        if want > mark:
            self.handle.registerTimer(want)
            self.due.update((want,))
            return []
        # the watermark is past it already: it ends now, or with the last of the seconds before it that are still to come
        return [] if any(at < t < want and t % SECOND_MS == 0 for t in list(self.handle.listTimers())) else self.settle()
