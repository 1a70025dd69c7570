"""A small byte-level convolutional network in numpy.

Bytes are embedded; filters of two neighbouring blocks (8 bytes, 4 apart) slide over chunks that overlap and together
cover the whole input; each filter keeps its largest response in a chunk; the chunks' responses are pooled (mean and
largest) and combined into one probability. Training is Adam on the logistic loss, from a fixed seed. A network fitted
to no rows gives 0.5.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4


class ByteConvNet:
    def __init__(self, chunk: int = 512, stride: int = 448, embed: int = 4, filters: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.chunk, self.stride, self.rng = chunk, stride, rng
        self.p = {
            "embed": rng.normal(0, 0.5, (256, embed)).astype(np.float32),
            "near": rng.normal(0, 0.25, (BLOCK * embed, filters)).astype(np.float32),
            "far": rng.normal(0, 0.25, (BLOCK * embed, filters)).astype(np.float32),
            "out": rng.normal(0, 0.1, 2 * filters).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }

    def chunks(self, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All chunks of all items as a (n, chunk) matrix, zero filled, and how many each item has (1 at least)."""
        counts = np.array([max(1, -(-(len(x) - (self.chunk - self.stride)) // self.stride)) for x in items])
        out = np.zeros((counts.sum(), self.chunk), np.uint8)
        row = 0
        for x, n in zip(items, counts.tolist(), strict=True):
            flat = np.frombuffer(x, np.uint8)
            for k in range(n):
                part = flat[k * self.stride : k * self.stride + self.chunk]
                out[row, : len(part)] = part
                row += 1
        return out, counts

    def _convolve(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blocks = self.p["embed"][chunks].reshape(len(chunks), self.chunk // BLOCK, -1)
        return blocks, blocks[:, :-1] @ self.p["near"] + blocks[:, 1:] @ self.p["far"]

    def _pool(self, peaks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.cumsum(counts) - counts
        mean = np.add.reduceat(peaks, first, axis=0) / counts[:, None]
        return np.hstack([mean, np.maximum.reduceat(peaks, first, axis=0)]).astype(np.float32), first

    def logits(self, items: list[bytes]) -> np.ndarray:
        if not items:
            return np.zeros(0)
        chunks, counts = self.chunks(items)
        peaks = np.concatenate([self._convolve(chunks[k : k + 256])[1].max(axis=1) for k in range(0, len(chunks), 256)])
        return self._pool(peaks, counts)[0].astype(np.float64) @ self.p["out"] + float(self.p["bias"][0])

    def probability(self, items: list[bytes]) -> np.ndarray:
        return sigmoid(self.logits(items))

    def _gradients(self, chunks: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        parts = []
        for k in range(0, len(chunks), 256):  # what is kept of a slice is its peaks and the inputs that made them
            blocks, h = self._convolve(chunks[k : k + 256])
            at, some = h.argmax(axis=1), np.arange(len(h))[:, None]
            parts.append((at, np.take_along_axis(h, at[:, None], axis=1)[:, 0], blocks[some, at], blocks[some, at + 1]))
        at, peaks, near, far = (np.concatenate(x) for x in zip(*parts, strict=True))  # near, far: (chunks, filters, block * embed)
        pooled, first = self._pool(peaks, counts)
        d = (sigmoid(pooled @ self.p["out"] + self.p["bias"][0]) - y).astype(np.float32) / len(y)
        n = peaks.shape[1]
        doc = np.repeat(np.arange(len(counts)), counts)
        dp = (d / counts)[doc, None] * self.p["out"][:n]
        dp = dp + (peaks == pooled[doc, n:]) * d[doc, None] * self.p["out"][n:]
        rows = np.arange(len(chunks))[:, None]
        g = {
            "out": pooled.T @ d, "bias": np.array([d.sum()]),
            "near": np.einsum("cfk,cf->kf", near, dp), "far": np.einsum("cfk,cf->kf", far, dp),
        }
        grid = chunks.reshape(len(chunks), -1, BLOCK)
        embed = np.zeros_like(self.p["embed"])
        for side, w in ((at, "near"), (at + 1, "far")):
            d_in = (dp[:, :, None] * self.p[w].T[None]).reshape(-1, embed.shape[1])
            np.add.at(embed, grid[rows, side].ravel(), d_in)
        g["embed"] = embed
        return g

    def fit(self, items: list[bytes], y: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 0.01) -> ByteConvNet:
        y = np.asarray(y, np.float32)
        if not len(y):
            self.p["out"][:] = 0
            return self
        share = float(np.clip(y.mean(), 0.01, 0.99))
        self.p["bias"][0] = np.log(share / (1 - share))
        chunks, counts = self.chunks(items)
        first = np.cumsum(counts) - counts
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        steps, t = epochs * -(-len(y) // batch), 0
        for _ in range(epochs):
            order = self.rng.permutation(len(y))
            for k in range(0, len(y), batch):
                docs = order[k : k + batch]
                rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in docs])
                t += 1
                now = rate * min(1, 2 * (1 - t / (steps + 1)))
                for name, g in self._gradients(chunks[rows], counts[docs], y[docs]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.99 * v[name] + 0.01 * g * g
                    self.p[name] -= (now * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return self


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
