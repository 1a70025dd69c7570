"""What follows from a waterfall (file_id, t_idx, time_s, s_db array): CFAR mask, occupancy, activity, spans, thumbnails.

Columns are whole where they are made, so everything along frequency stays in its row. Along time a column needs a few
neighbours: columns are dealt in spans of `SPAN`, with the few that a span shares with the next one sent to both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels

SPAN = 512


def cfar_mask(grid: DataFrame, k: float = 3.0, guard: int = 1, train: int = 6, chunk: int | None = None) -> DataFrame:
    """(file_id, t_idx, time_s, mask array): cells that stand out along both axes from their training cells.

    With chunk (1000 in the surveyed scripts) the mask is that of their chunked form: training cells are needed on both
    sides, and what is left over when an axis is cut into equal chunks of about that length is not marked.
    """
    reach = guard + train
    both = chunk is not None
    cells = grid.withColumn("span", F.floor(F.col("t_idx") / SPAN))
    total = Window.partitionBy("file_id")
    if both:
        cells = cells.withColumn("n_t", F.max("t_idx").over(total) + 1)
    else:
        cells = cells.withColumn("n_t", F.lit(None).cast("long"))
    place = F.col("t_idx") % SPAN
    spans = F.array_compact(F.array(F.col("span"), F.when((place < reach) & (F.col("span") > 0), F.col("span") - 1), F.when(place >= SPAN - reach, F.col("span") + 1)))
    dealt = cells.withColumn("to", F.explode(spans))

    def left_over(n: int) -> int:
        """Where the last equal chunk ends."""
        chunks = max(1, n // chunk)
        return chunks * (n // chunks)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("t_idx")
        t, to = group["t_idx"].to_numpy(), group["to"].iat[0]
        db = np.stack(group["s_db"].to_list())
        # columns are found by number: a missing one is no neighbour
        whole = np.full((t[-1] - t[0] + 1, db.shape[1]), np.nan)
        whole[t - t[0]] = db
        own = group["span"].to_numpy() == to
        along_t = kernels.cfar_line(np.ascontiguousarray(whole.T), guard, train, k, both).T[t - t[0]][own]
        mask = along_t & kernels.cfar_line(db[own], guard, train, k, both)
        if both:
            mask[t[own] >= left_over(int(group["n_t"].iat[0]))] = False
            mask[:, left_over(mask.shape[1]) :] = False
        return pd.DataFrame({"file_id": group["file_id"].iat[0], "t_idx": t[own], "time_s": group["time_s"].to_numpy()[own], "mask": list(mask)})

    kind = grid.schema["file_id"].dataType.simpleString()
    return dealt.groupBy("file_id", "to").applyInPandas(run, f"file_id {kind}, t_idx long, time_s double, mask array<boolean>")


def occupancy(mask: DataFrame) -> DataFrame:
    """(file_id, f_idx, occupancy): how much of the time each bin is active. Tasks add up columns; sums are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_id, rows in batch.groupby("file_id"):
                on = np.stack(rows["mask"].to_list())
                yield pd.DataFrame({"file_id": file_id, "f_idx": np.arange(on.shape[1]), "on": on.sum(axis=0), "n": len(on)})

    kind = mask.schema["file_id"].dataType.simpleString()
    parts = mask.select("file_id", "mask").mapInPandas(run, f"file_id {kind}, f_idx long, on long, n long")
    return parts.groupBy("file_id", "f_idx").agg((F.sum("on") / F.sum("n")).alias("occupancy"))


def time_activity(mask: DataFrame) -> DataFrame:
    """(file_id, t_idx, time_s, activity): the active share of each column."""
    on = F.aggregate("mask", F.lit(0), lambda a, x: a + x.cast("int"))
    return mask.select("file_id", "t_idx", "time_s", (on / F.size("mask")).alias("activity"))


def active_spans(mask: DataFrame, carriers: DataFrame, pad: float = 1.25) -> DataFrame:
    """(file_id, carrier_index, t_first, t_last, t0_s, t1_s): runs of columns with activity in a carrier's padded band.

    carriers(file_id, carrier_index, f_center_hz, bw_hz, fs_hz); the band is f_center_hz -/+ pad * bw_hz / 2, the end the
    time of the last active column.
    """
    wanted = carriers.groupBy("file_id").agg(F.collect_list(F.struct(F.col("carrier_index").cast("long").alias("carrier_index"), *(F.col(c).cast("double").alias(c) for c in ("f_center_hz", "bw_hz", "fs_hz")))).alias("carriers"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                on = np.flatnonzero(r.mask)
                n = len(r.mask)
                for c in r.carriers:
                    f = (on - n // 2) * c["fs_hz"] / n
                    if (np.abs(f - c["f_center_hz"]) <= pad * c["bw_hz"] / 2).any():
                        rows.append((r.file_id, c["carrier_index"], r.t_idx, r.time_s))
            yield pd.DataFrame(rows, columns=["file_id", "carrier_index", "t_idx", "time_s"])

    kind = mask.schema["file_id"].dataType.simpleString()
    hits = mask.join(wanted, "file_id").mapInPandas(run, f"file_id {kind}, carrier_index long, t_idx long, time_s double")
    order = Window.partitionBy("file_id", "carrier_index").orderBy("t_idx")
    runs = hits.withColumn("opens", F.when(F.col("t_idx") - F.lag("t_idx").over(order) == 1, 0).otherwise(1)).withColumn("run", F.sum("opens").over(order))
    return runs.groupBy("file_id", "carrier_index", "run").agg(F.min("t_idx").alias("t_first"), F.max("t_idx").alias("t_last"), F.min("time_s").alias("t0_s"), F.max("time_s").alias("t1_s")).drop("run")


def thumbnail(grid: DataFrame, r_t: int = 8, r_f: int = 4) -> DataFrame:
    """(file_id, t, f, max_db, mean_db) of blocks of r_t columns and r_f bins; NaN cells are left out.

    A block at the end of an axis is filled up with copies of its last column or bin, as they weigh in the mean.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("t_idx")
        db = np.stack(group["s_db"].to_list()).astype(np.float64)
        db = np.pad(db, ((0, max(0, r_t - len(db))), (0, -db.shape[1] % r_f)), mode="edge")
        cells = db.reshape(len(db), -1, r_f).transpose(1, 0, 2).reshape(db.shape[1] // r_f, -1)
        some = ~np.isnan(cells).all(axis=1)
        cells = np.where(some[:, None], cells, 0.0)
        n = len(cells)
        return pd.DataFrame({"file_id": group["file_id"].iat[0], "t": group["t"].iat[0], "f": np.arange(n), "max_db": np.where(some, np.nanmax(cells, axis=1), np.nan), "mean_db": np.where(some, np.nanmean(cells, axis=1), np.nan)})

    kind = grid.schema["file_id"].dataType.simpleString()
    return grid.withColumn("t", F.floor(F.col("t_idx") / r_t)).groupBy("file_id", "t").applyInPandas(run, f"file_id {kind}, t long, f long, max_db double, mean_db double")
