"""Quality classifier: a byte-level convolutional network in numpy.

Every byte is embedded by fixed features (its bits and its kind). Learned
filters, ``WIDTH`` bytes wide, move over the whole document by ``STRIDE``
bytes; their responses are max-pooled over chunks of ``CHUNK`` bytes that
overlap by half. The mean and the maximum over all chunks are combined into
one probability. All learned numbers come from Adam with hand-written
gradients over a bounded sample of labelled rows (``max_per_class`` whole
texts of each label). Scoring is one pass without a shuffle; memory is bounded
by ``PIECE`` bytes, whatever a text's length.

Defined cases: a null or empty text is one chunk of padding and gets a score
like any other. Labels, held-out rows, nulls, repeated rows, ids with several
texts, empty tables and other columns are treated as by ``toxicity``; without
rows of both labels every score is the share of label 1. Texts of any length
are scored whole. There are no ties to break.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, shipped
from .toxicity import bucket, prior_shift, score_rows, training_sample

WIDTH, STRIDE, HALF, CHUNK = 8, 4, 128, 256
PIECE = 1 << 20


def byte_features() -> np.ndarray:
    """256 x 16: eight bits, six kinds, a pad mark and a constant."""
    b = np.arange(256)
    bits = (b[:, None] >> np.arange(8) & 1) - 0.5
    low, up = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90)
    digit, blank, high = (b >= 48) & (b <= 57), (b == 32) | ((b >= 9) & (b <= 13)), b >= 128
    other = ~(low | up | digit | blank | high | (b == 0))
    return np.column_stack([bits, low, up, digit, blank, high, other, b == 0, b >= 0]).astype(np.float32)


EMBED = byte_features()


@dataclass
class ConvModel:
    filters: np.ndarray  # WIDTH * 16 x F
    shift: np.ndarray  # F
    dense: np.ndarray  # 2 F
    bias: float

    def logit(self, mean: np.ndarray, top: np.ndarray) -> np.ndarray:
        return np.hstack([mean, top]) @ self.dense + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for every text, whole."""
        out = np.empty(len(texts))
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal held, size
            if held:
                halves, n = half_maxima(self, [b for _, b in held])
                mean, top, _ = pool(halves, n)
                out[[i for i, _ in held]] = self.logit(mean, top)
            held, size = [], 0

        for i, t in enumerate(texts):
            b = t.encode()
            if len(b) > PIECE:  # half-chunk maxima piece by piece; pieces share WIDTH bytes
                parts = [half_maxima(self, [b[a : a + PIECE + WIDTH]], whole=a + PIECE >= len(b))[0] for a in range(0, len(b), PIECE)]
                halves = np.concatenate(parts)
                mean, top, _ = pool(halves, np.array([len(halves)]))
                out[i] = self.logit(mean, top)[0]
                continue
            held.append((i, b))
            size += len(b) + HALF
            if size > PIECE:
                flush()
        flush()
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _padded(raw: list[bytes], whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All texts back to back, each padded to whole half-chunks so that no
    window meets the next text, and the number of half-chunks of each. Of a
    piece that is not the last (``whole`` false) the bytes that follow it are
    part of its last windows."""
    n = np.array([-(-(len(b) + WIDTH - STRIDE) // HALF) if whole else PIECE // HALF for b in raw])
    buf = np.zeros(int(n.sum()) * HALF + WIDTH, np.uint8)
    at = 0
    for b, k in zip(raw, n):
        part = np.frombuffer(b, np.uint8)
        buf[at : at + len(part)] = part[: len(buf) - at]
        at += int(k) * HALF
    return buf, n


def responses(model: ConvModel, buf: np.ndarray, n: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(embedded strides, filter responses by half-chunk, stride and filter).
    A text's last stride holds padding only and reaches into the next text;
    it never wins."""
    a = EMBED[buf].reshape(-1, STRIDE * EMBED.shape[1])
    k = a.shape[1]
    y = a[:-2] @ model.filters[:k]
    y += a[1:-1] @ model.filters[k:]
    y += model.shift
    if whole:
        y[np.cumsum(n) * (HALF // STRIDE) - 1] = -np.inf
    return a, y.reshape(-1, HALF // STRIDE, y.shape[1])


def half_maxima(model: ConvModel, raw: list[bytes], whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    buf, n = _padded(raw, whole)
    _, y = responses(model, buf, n, whole)
    return np.maximum(y.max(axis=1), 0), n


def pool(halves: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and maximum over the chunks of each text. A chunk is a half-chunk
    and the next one of the same text (the last one stands alone)."""
    ends = np.cumsum(n)
    after = np.arange(1, len(halves) + 1)
    after[ends - 1] = ends - 1
    chunk = np.maximum(halves, halves[after])
    starts = ends - n
    mean = np.add.reduceat(chunk, starts) / n[:, None]
    return mean, np.maximum.reduceat(chunk, starts), after


def fit(
    texts: list[str], labels: np.ndarray, share: float | None = None, filters: int = 16, epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 7
) -> ConvModel:
    """``share`` is the share of label 1 among all labelled rows, where the
    sample's differs."""
    rng = np.random.default_rng(seed)
    width = WIDTH * EMBED.shape[1]
    y = np.asarray(labels, float)
    own_share = float(y.mean()) if len(y) else 0.0
    all_ = own_share if share is None else share
    model = ConvModel(
        (rng.normal(size=(width, filters)) * 0.1).astype(np.float32),
        np.zeros(filters, np.float32),
        np.zeros(2 * filters),
        float(np.log((all_ + 1e-9) / (1 - all_ + 1e-9))),
    )
    if not 0 < own_share < 1:
        return model
    model.bias = float(np.log(own_share / (1 - own_share)))
    model.dense = rng.normal(size=2 * filters) * 0.1
    params = [model.filters, model.shift, model.dense, np.array([model.bias])]
    moments = [(np.zeros_like(p, float), np.zeros_like(p, float)) for p in params]
    raw = [t.encode() for t in texts]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(raw))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            step += 1
            grads = _gradients(model, [raw[i] for i in own], y[own])
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)
            model.bias = float(params[3][0])
    model.bias += prior_shift(y, share)
    return model


def _gradients(model: ConvModel, raw: list[bytes], y: np.ndarray):
    """Gradients of the mean log loss by filters, shift, dense and bias."""
    buf, n = _padded(raw)
    a, r = responses(model, buf, n)
    f = r.shape[2]
    where = r.argmax(axis=1)  # the stride that gave each half-chunk's maximum
    halves = np.maximum(np.take_along_axis(r, where[:, None], 1)[:, 0], 0)
    mean, top, after = pool(halves, n)
    z = model.logit(mean, top)
    e = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(y)
    g_dense = np.hstack([mean, top]).T @ e + 1e-3 * model.dense
    # back to the chunks, then to the half-chunk that gave each chunk's maximum
    who = np.repeat(np.arange(len(n)), n)
    g_chunk = e[who, None] * model.dense[:f] / n[who, None]
    second = halves[after] > halves
    g_half = np.where(second, 0, g_chunk)
    np.add.at(g_half, after, np.where(second, g_chunk, 0))
    for j in range(f):  # a text's maximum: its first half-chunk that has it
        best = np.flatnonzero(halves[:, j] == top[who, j])
        text, first = np.unique(who[best], return_index=True)
        g_half[best[first], j] += e[text] * model.dense[f + j]
    g_half *= halves > 0
    k = a.shape[1]
    pos = where + (np.arange(len(where)) * (HALF // STRIDE))[:, None]
    g_filters = np.empty((2 * k, f))
    for j in range(f):  # only the strides that won take part
        g = g_half[:, j].astype(np.float32)
        live = np.flatnonzero(g)
        g_filters[:k, j] = g[live] @ a[pos[live, j]]
        g_filters[k:, j] = g[live] @ a[pos[live, j] + 1]
    return g_filters, g_half.sum(axis=0), g_dense, np.array([e.sum()])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    max_per_class: int = 1500,
    max_chars: int = 100_000,
    threshold: float = 0.3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(row struct of the other columns, t string, held_out boolean, score
    double, predicted int), one row per input row."""
    held = bucket(F.col("id"), 5) == 0
    texts, y, share = training_sample(docs, labels, "quality", held, max_per_class, max_chars, doc_id, text)
    shared = ship(docs.sparkSession, fit(texts, y, share))

    def make():
        model: ConvModel = shipped(shared)
        return model.scores

    return score_rows(docs, make, held, threshold, doc_id, text)
