"""Features and engineered channels of clips: a row a clip, (clip_index, fs_hz, i array, q array), reduced where it is.

A file_id stays in front where clips have one. Nothing is shuffled. Clips may differ in length; an empty clip has null features and no channels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions import kernels
from ..sources.files import FEATURES

NAMES = [x.strip().split()[0] for x in FEATURES.split(",")]
EXTRAS = "amp,phase,dfreq,cosphi,sinphi,d_amp,d2phase"


def cumulants(x: np.ndarray) -> tuple[complex, complex, complex, complex]:
    """C20, C40, C41 and C42 after the mean is removed, over the power and its square."""
    x = x - x.mean()
    p, m2, m4 = (np.abs(x) ** 2).mean(), (x**2).mean(), (x**4).mean()
    norm = p + 1e-12
    return m2 / norm, (m4 - 3 * m2**2) / norm**2, ((x**3 * x.conj()).mean() - 3 * m2 * p) / norm**2, (m4 - abs(m2) ** 2 - 2 * p**2) / norm**2


def spectral(x: np.ndarray, fs: float, nperseg: int, overlap: float) -> tuple[float, float, float]:
    """(SNR, bandwidth 6 dB below the peak, flatness) of the Welch spectrum."""
    size = min(nperseg, len(x))
    total, n = kernels.welch_sums(x, size, max(1, size - int(size * overlap)), fs)
    p = np.maximum(total / n, 1e-20)
    db = 10 * np.log10(p)
    peak = int(db.argmax())
    low = np.flatnonzero(db <= db[peak] - 6)
    left, right = low[low < peak].max(initial=0), low[low > peak].min(initial=len(db) - 1)
    return db[peak] - np.median(db), (right - left) * fs / size, np.exp(np.log(p).mean()) / p.mean()


def _file(clips: DataFrame) -> tuple[str, ...]:
    return ("file_id",) if "file_id" in clips.columns else ()


def clip_features(clips: DataFrame, nperseg: int = 2048, overlap: float = 0.5) -> DataFrame:
    file = _file(clips)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                x = kernels.complex_of(r.i, r.q)
                own = [getattr(r, c) for c in (*file, "clip_index", "fs_hz")]
                if not len(x):
                    rows.append((*own, 0, *[None] * 13))
                    continue
                a = np.abs(x)
                kurt = (((a - a.mean()) / (a.std() + 1e-12)) ** 4).mean()
                cfo = np.angle(np.vdot(x[:-1], x[1:])) / (2 * np.pi) * r.fs_hz
                parts = [v for c in cumulants(x) for v in (c.real, c.imag)]
                rows.append((*own, len(x), *spectral(x, r.fs_hz, nperseg, overlap), kurt, *parts, cfo))
            yield pd.DataFrame(rows, columns=[*file, *NAMES])

    return clips.select(*file, "clip_index", "fs_hz", "i", "q").mapInPandas(run, ", ".join([*(f"{c} string" for c in file), FEATURES]))


def channels(x: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    """The channels named, of the length of x. Names in any case; unknown ones are left out.

    bande_lo, bande_hi and spec_flat are the log power below and above a quarter of the bins up to half the rate, and the
    flatness, of short Hann frames; cum20 to cum42 the real parts of the cumulants: constants repeated over the clip.
    """
    amp, phase = np.abs(x), np.unwrap(np.angle(x))
    base = {
        "amp": lambda: amp, "phase": lambda: phase, "dfreq": lambda: np.diff(phase, prepend=phase[:1]), "cosphi": lambda: np.cos(phase), "sinphi": lambda: np.sin(phase),
        "d_amp": lambda: np.diff(amp, prepend=amp[:1]), "d2phase": lambda: np.diff(phase, n=2, prepend=phase[:1], append=phase[-1:]),
    }
    asked = [n.strip().lower() for n in names]
    out = {"I": x.real, "Q": x.imag} | {n: base[n]() for n in asked if n in base}
    moments = ("cum20", "cum40", "cum41", "cum42")
    if set(moments) & set(asked):
        out |= {n: np.full(len(x), c.real) for n, c in zip(moments, cumulants(x), strict=True) if n in asked}
    if {"bande_lo", "bande_hi", "spec_flat"} & set(asked):
        win = min(256, max(128, len(x) // 64 // 2 * 2))
        rows = kernels.frames(x, win, win // 2)
        if len(rows):
            p = (np.abs(np.fft.fft(rows * kernels.hann(win), axis=1)[:, : win // 2 + 1]) ** 2).mean(axis=0)
            low = len(p) // 4
            values = {"bandE_lo": np.log(p[:low].mean() + 1e-12), "bandE_hi": np.log(p[low:].mean() + 1e-12), "spec_flat": np.exp(np.log(p + 1e-12).mean()) / (p.mean() + 1e-12)}
            out |= {n: np.full(len(x), v) for n, v in values.items() if n.lower() in asked}
    return out


def engineered(clips: DataFrame, extras: str = EXTRAS) -> DataFrame:
    """(clip_index, y, channels: array of (name, values)): the samples, then the channels of the comma list."""
    names, file = [n for n in extras.split(",") if n.strip()], _file(clips)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x = kernels.complex_of(r.i, r.q)
                found = channels(x, names) if len(x) else {}
                yield pd.DataFrame({**{c: [getattr(r, c)] for c in file}, "clip_index": [r.clip_index], "y": [0], "channels": [[{"name": n, "values": v.astype(np.float32)} for n, v in found.items()]]})

    kinds = [*(f"{c} string" for c in file), "clip_index long, y int, channels array<struct<name: string, values: array<float>>>"]
    return clips.select(*file, "clip_index", "i", "q").mapInPandas(run, ", ".join(kinds))
