"""NumPy kernels for blocks of complex samples; each runs inside Arrow tasks on one bounded block."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

CONVENTIONS = {"I+Q": lambda i, q: i + 1j * q, "I-Q": lambda i, q: i - 1j * q, "Q+I": lambda i, q: q + 1j * i, "Q-I": lambda i, q: q - 1j * i}


def complex_of(i: np.ndarray, q: np.ndarray, convention: str = "I+Q") -> np.ndarray:
    """Samples in one of the four conventions; NaN and infinite values become zero."""
    clean = (np.nan_to_num(np.asarray(x, np.float64), nan=0.0, posinf=0.0, neginf=0.0) for x in (i, q))
    return CONVENTIONS[convention](*clean)


def fft_size(target: int, n: int) -> int:
    """The largest power of two within target and n, between 4096 and 2**20."""
    return int(np.clip(1 << max(0, min(target, n).bit_length() - 1), 4096, 1 << 20))


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """All whole frames, one a row; an input shorter than a frame has none."""
    return np.lib.stride_tricks.sliding_window_view(x, size)[::hop] if len(x) >= size else np.zeros((0, size), x.dtype)


def welch_sums(x: np.ndarray, nperseg: int, hop: int, fs: float) -> tuple[np.ndarray, int]:
    """Sum over frames of the two-sided density, centred, and the number of frames."""
    w = hann(nperseg)
    power = np.abs(np.fft.fft(frames(x, nperseg, hop) * w, axis=1)) ** 2 / (fs * (w**2).sum())
    return np.fft.fftshift(power.sum(axis=0)), len(power)


def stft_db(x: np.ndarray, nperseg: int, hop: int, scaling: str = "none") -> np.ndarray:
    """(frames, nperseg) centred magnitudes in dB; scaling "spectrum" divides them by the window's sum."""
    w = hann(nperseg)
    spectrum = np.fft.fftshift(np.fft.fft(frames(x, nperseg, hop) * w, axis=1), axes=1)
    return 20 * np.log10(np.maximum(np.abs(spectrum) / (w.sum() if scaling == "spectrum" else 1.0), 1e-12))


def strided_power(x: np.ndarray, starts: np.ndarray, nfft: int, step: int = 1, batch: int = 256) -> np.ndarray:
    """Centred power, summed over frames of every step-th sample from each start, under a symmetric Hann window; unit window energy."""
    w, total = np.hanning(nfft), np.zeros(nfft)
    for k in range(0, len(starts), batch):
        rows = x[starts[k : k + batch, None] + np.arange(nfft) * step]
        total += (np.abs(np.fft.fft(rows * w, axis=1)) ** 2).sum(axis=0)
    return np.fft.fftshift(total / ((w**2).sum() + 1e-12))


def band_of(p_db: np.ndarray, fs: float, below: float = 20.0) -> tuple[float, float, float]:
    """(centre, bandwidth, SNR) of a centred spectrum: between the outermost bins within `below` dB of the peak, over the median."""
    f, strong = (np.arange(len(p_db)) - len(p_db) // 2) / len(p_db), np.flatnonzero(p_db >= p_db.max() - below)
    low, high = f[strong[0]], f[strong[-1]]
    return (low + high) / 2 * fs, (high - low) * fs, float(p_db.max() - np.median(p_db))


@lru_cache
def median_network(n: int) -> tuple[tuple[int, int], ...]:
    """Compare-and-exchange steps after which the middle one (n odd) or two (n even) of n values stand in the middle.

    Batcher's odd-even merge sort, less the steps that no middle value depends on.
    """
    steps, p = [], 1
    while p < n:
        k = p
        while k >= 1:
            steps += [(i + j, i + j + k) for j in range(k % p, n - k, 2 * k) for i in range(min(k, n - j - k)) if (i + j) // (2 * p) == (i + j + k) // (2 * p)]
            k //= 2
        p *= 2
    live, kept = {(n - 1) // 2, n // 2}, []
    for a, b in reversed(steps):
        if a in live or b in live:
            live |= {a, b}
            kept.append((a, b))
    return tuple(reversed(kept))


def _median(cells: list[np.ndarray]) -> np.ndarray:
    """The median of equally shaped arrays, cell by cell; the list is used up."""
    for a, b in median_network(len(cells)):
        low = np.minimum(cells[a], cells[b])
        cells[b] = np.maximum(cells[a], cells[b])
        cells[a] = low
    return (cells[(len(cells) - 1) // 2] + cells[len(cells) // 2]) / 2


def cfar_line(x: np.ndarray, guard: int, train: int, k: float, both: bool = False) -> np.ndarray:
    """Cells of each row of x that stand out from their neighbours along it: above median + k * 1.4826 * MAD of up to
    `train` cells on each side beyond `guard`. With `both`, a cell that lacks neighbours on one side does not.

    Where all neighbours are there, both medians are taken by a sorting network over shifted views of the row, some rows
    at a time; the cells near an end or a missing value take what neighbours they have.
    """
    n, reach = x.shape[1], guard + train
    out = np.zeros(x.shape, bool)
    if not n or not train:
        return out
    near = [j for j in range(-reach, reach + 1) if abs(j) > guard]
    whole = np.zeros(x.shape, bool)
    if n > 2 * reach:
        step = max(1, 40_000 // n)
        for r in range(0, len(x), step):
            rows = x[r : r + step].astype(np.float64)
            views = [rows[:, reach + j : n - reach + j] for j in near]
            mid = _median(list(views))
            mad = _median([np.abs(v - mid) for v in views]) + 1e-12
            out[r : r + step, reach : n - reach] = rows[:, reach : n - reach] > mid + k * 1.4826 * mad
            gaps = np.r_["1", np.zeros((len(rows), 1), np.int32), np.cumsum(np.isnan(rows), axis=1, dtype=np.int32)]
            whole[r : r + step, reach : n - reach] = gaps[:, 2 * reach + 1 :] == gaps[:, : n - 2 * reach]
    row, at = np.nonzero(~whole)
    wide = np.pad(x, ((0, 0), (reach, reach)), constant_values=np.nan)
    for c in range(0, len(row), 100_000):
        r, p = row[c : c + 100_000], at[c : c + 100_000]
        ref = wide[r[:, None], p[:, None] + reach + np.array(near)].astype(np.float64)
        some = ~np.isnan(ref).all(axis=1)
        if both:
            some &= ~np.isnan(ref[:, :train]).all(axis=1) & ~np.isnan(ref[:, train:]).all(axis=1)
        ref = np.where(some[:, None], ref, 0.0)
        mid = np.nanmedian(ref, axis=1)
        mad = np.nanmedian(np.abs(ref - mid[:, None]), axis=1) + 1e-12
        out[r, p] = some & (x[r, p] > mid + k * 1.4826 * mad)
    return out


def firwin_hann(taps: int, cutoff: float) -> np.ndarray:
    """Windowed sinc (symmetric Hann) of unit gain at DC; cutoff as a share of half the rate."""
    n = np.arange(taps) - (taps - 1) / 2
    h = cutoff * np.sinc(cutoff * n) * np.hanning(taps)
    return h / h.sum()


def kaiser_fir(factor: int, beta: float = 8.6) -> np.ndarray:
    """The anti-alias filter of a resampling by 1 / factor: 20 * factor + 1 taps, cutoff at the new half rate."""
    if factor == 1:
        return np.ones(1)
    half = 10 * factor
    n = np.arange(-half, half + 1)
    h = np.sinc(n / factor) / factor * np.kaiser(2 * half + 1, beta)
    return h / h.sum()


def spectrogram_db(i: np.ndarray, nfft: int = 2048, hop: int = 256) -> np.ndarray:
    """(frames, nfft / 2 + 1) magnitudes in dB of one channel, zero filled to whole frames."""
    n = len(i)
    extra = -(n - nfft) % hop if n >= nfft else nfft - n
    rows = frames(np.pad(np.asarray(i, np.float64), (0, extra)), nfft, hop)
    return 20 * np.log10(np.maximum(np.abs(np.fft.rfft(rows * np.hanning(nfft), axis=1)), 1e-12))


def band_powers(x: np.ndarray, size: int) -> tuple[float, float]:
    """Power at positive and negative frequencies of a centre crop, zero filled to `size`; DC counts for neither."""
    if len(x) >= size:
        start = (len(x) - size) // 2
        x = x[start : start + size]
    p = np.abs(np.fft.fft(np.pad(x, (0, size - len(x))))) ** 2
    return float(p[1 : size // 2].sum() + 1e-12), float(p[size // 2 :].sum() + 1e-12)


def all_band_powers(x: np.ndarray, size: int) -> tuple[float, float, float, float]:
    """band_powers of x and of its conjugate, whose spectrum is the mirror image, from one transform."""
    if len(x) >= size:
        start = (len(x) - size) // 2
        x = x[start : start + size]
    f = np.fft.fft(np.pad(x, (0, size - len(x))))
    p = f.real**2 + f.imag**2
    half = size // 2
    cut = size - half + 1
    return tuple(float(part.sum() + 1e-12) for part in (p[1:half], p[half:], p[cut:], p[1:cut]))


def lowpass(taps: int, cutoff: float, window: str = "hamming") -> np.ndarray:
    """Windowed sinc with unit gain at DC; cutoff in cycles a sample."""
    n = np.arange(taps) - (taps - 1) / 2
    h = 2 * cutoff * np.sinc(2 * cutoff * n) * (np.hamming(taps) if window == "hamming" else np.hanning(taps))
    return h / h.sum()


def mix(x: np.ndarray, start: int, f0: float, fs: float) -> np.ndarray:
    """Shift f0 to DC; start is the global index of the first sample, so blocks agree."""
    return x * np.exp(-2j * np.pi * f0 / fs * (start + np.arange(len(x))))


def overlap_save(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The whole convolution of x with h, a piece at a time through transforms of about eight times h's length."""
    taps, n = len(h), len(x) + len(h) - 1
    if not len(x):
        return x[:0]
    if taps < 64:
        return np.convolve(x, h)
    size = 1 << (8 * taps - 1).bit_length()
    step, spectrum = size - taps + 1, np.fft.fft(h, size)
    wide = np.concatenate([np.zeros(taps - 1, complex), x, np.zeros(size, complex)])
    return np.concatenate([np.fft.ifft(np.fft.fft(wide[a : a + size]) * spectrum)[taps - 1 :] for a in range(0, n, step)])[:n]


def fir_at(x: np.ndarray, h: np.ndarray, first: int, step: int, count: int) -> np.ndarray:
    """sum over k of h[k] * x[at - k] at `count` places from `first`, `step` apart; x is zero beyond its ends.

    Only the wanted places are computed, each from its own window (what a polyphase filter does); at every place of a long
    filter the work goes through transforms.
    """
    taps = len(h)
    if count <= 0:
        return np.zeros(0, complex)
    if step * 16 < taps:  # a transform costs about so many multiplications a sample
        y = overlap_save(x, h)
        at = first + step * np.arange(count)
        return np.where((at >= 0) & (at < len(y)), y[np.clip(at, 0, len(y) - 1)], 0) if len(y) else np.zeros(count, complex)
    low, high = first - taps + 1, first + step * (count - 1) + 1
    wide = np.concatenate([np.zeros(max(0, -low), complex), x[max(0, low) : max(0, high)], np.zeros(max(0, high - max(low, len(x))) if low < len(x) else high - low - max(0, -low), complex)])
    rows, turned = np.lib.stride_tricks.sliding_window_view(wide, taps)[::step][:count], h[::-1].astype(complex)
    return np.concatenate([rows[k : k + 4096] @ turned for k in range(0, count, 4096)])


def decimate(x: np.ndarray, h: np.ndarray, factor: int, start: int, left: int, n: int) -> np.ndarray:
    """Filtered ('same') samples of a block at the global multiples of factor.

    x holds the block's n samples with `left` samples before them and up to (taps - 1) / 2 after them.
    """
    first = -start % factor
    return fir_at(x, h, left + first + (len(h) - 1) // 2, factor, max(0, -(-(n - first) // factor)))


def _reach_left(db: np.ndarray) -> np.ndarray:
    """For each place the lowest value from it leftwards, up to the next strictly higher one, by a stack of falling values."""
    out, stack = np.empty(len(db)), []
    for k, v in enumerate(db.tolist()):
        low = v
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        stack.append((v, low))
        out[k] = low
    return out


def peaks(db: np.ndarray, prominence: float) -> np.ndarray:
    """Local maxima (the middle of a plateau) that stand `prominence` above the lowest point towards higher ground."""
    db = np.asarray(db, np.float64)
    if len(db) < 3:
        return np.zeros(0, int)
    start = np.flatnonzero(np.r_[True, db[1:] != db[:-1]])  # of plateaus
    stop, level = np.r_[start[1:], len(db)] - 1, db[start]
    top = 1 + np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:]))
    base = np.maximum(_reach_left(level), _reach_left(level[::-1])[::-1])
    top = top[level[top] - base[top] >= prominence]
    return (start[top] + stop[top]) // 2


def walk_down(db: np.ndarray, at: int, level: float) -> tuple[int, int]:
    """The nearest places left and right of `at` with at most `level`; the first and last place where there are none."""
    found = []
    for side, end in ((db[:at][::-1], 0), (db[at + 1 :], len(db) - 1)):
        low, n, place = 0, 64, None
        while low < len(side) and place is None:
            hit = np.flatnonzero(side[low : low + n] <= level)
            place = low + int(hit[0]) if len(hit) else None
            low, n = low + n, 2 * n
        found.append(end if place is None else at - 1 - place if end == 0 else at + 1 + place)
    return found[0], found[1]
