"""Toxicity: a character n-gram linear classifier with naive Bayes scaling.

A text's features are the distinct character n-grams of its lower-cased
whole text. Each selected n-gram is scaled by its log-count ratio between the
toxic and the clean training texts (Wang and Manning 2012), and a logistic
regression weighs the scaled features. Features stand for themselves by their
64-bit hash; a small table of hash prefixes refuses most n-grams early.

Training reads a bounded sample of labelled rows: of each label the first
``max_per_class`` whole texts by a hash of the id, of at most ``max_chars``
characters each and ``max_total_chars`` together, which bounds the driver's
memory. Candidates are the n-grams that at least ``least`` texts of either
label hold. Scoring is one pass without a shuffle; a text of any length
is scored whole, in pieces of ``PIECE`` characters that overlap by n - 1.

Defined cases: a null or empty text has no features and gets the intercept's
score. Rows of ``labels`` with a null id or label are ignored; an id with
several labels counts as toxic if one says so. Without rows of both labels
every score is the share of toxic rows (0 without any). A null id is never
held out and never learned from. Repeated rows are scored one by one; of an
id with several texts the smallest is learned from, and each is scored. An
empty table gives no rows. Ties among n-grams go to the smaller hash. Other
columns are carried as one struct, so their names may clash with anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_blocks, pick, ship, shipped, stored

SIZES = (4, 5, 6)
PIECE = 1 << 18
BLOCK_BYTES = 4 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_GATE = np.uint64(64 - 20)


def _wide(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _codes(text: str) -> np.ndarray:
    return _wide(text.lower())


def _pieces(texts: list[str], widest: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Text numbers and codes of pieces of at most ``PIECE`` characters, and
    ``widest`` - 1 of the next; short texts are handed out together, some
    ``PIECE`` characters at a time, so that no more are held as codes."""
    owner, some, size = [], [], 0
    for i, t in enumerate(texts):
        t = t.lower()  # whole: a letter's lower case may hang on its neighbours
        for at in range(0, max(len(t), 1), PIECE):
            c = _wide(t[at : at + PIECE + widest - 1])
            if some and size + len(c) > PIECE:
                yield owner, some
                owner, some, size = [], [], 0
            owner.append(i)
            some.append(c)
            size += len(c) + widest  # and a mark that no text has
    if some:
        yield owner, some


def _ngrams(c: np.ndarray, sizes=SIZES) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of the characters ``c``, one array per size."""
    h, done = None, 0
    for n in range(1, max(sizes) + 1):
        if len(c) < n:
            return
        h = c.copy() if h is None else h[:-1] * _FACTOR + c[n - 1 :]
        done = n
        if done in sizes:
            x = h * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            yield x * _FACTOR


@dataclass
class NgramModel:
    keys: np.ndarray  # sorted hashes of the selected n-grams
    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...] = SIZES

    def gate(self) -> np.ndarray:
        g = np.zeros(1 << 20, bool)
        g[(self.keys >> _GATE).astype(np.int64)] = True
        return g

    def scores(self, texts: list[str], gate: np.ndarray) -> np.ndarray:
        """Probability of the label for every text."""
        total = np.full(len(texts), self.bias)
        if not len(self.keys):
            return 1 / (1 + np.exp(-total))
        m = len(self.keys)

        def count(pairs: np.ndarray) -> None:
            total[:] += np.bincount(pairs // m, self.weights[pairs % m], minlength=len(texts))

        pairs = np.zeros(0, np.int64)  # text number * features + feature
        for owner, some in _pieces(texts, max(self.sizes)):
            mark = np.full(max(self.sizes), 1 << 40, np.uint64)
            c = np.concatenate([x for w in some for x in (w, mark)])
            who = np.repeat(np.array(owner), [len(w) + len(mark) for w in some])
            hits = [pairs]
            for h in _ngrams(c, self.sizes):
                p = np.flatnonzero(gate[(h >> _GATE).astype(np.int64)])
                x = h[p]
                k = np.minimum(np.searchsorted(self.keys, x), m - 1)
                ok = self.keys[k] == x
                hits.append(np.unique(who[p[ok]] * m + k[ok]))
            pairs = np.unique(np.concatenate(hits))
            done = np.searchsorted(pairs, owner[-1] * m)  # the last text may go on
            count(pairs[:done])
            pairs = pairs[done:].copy()
        count(pairs)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _present(text: str) -> np.ndarray:
    parts = [np.unique(h) for h in _ngrams(_codes(text))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _document_counts(texts: list[str], some: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams and how many texts hold each, summed by ``some`` texts at
    a time to spare the driver's memory."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    for at in range(0, len(texts), some):
        k, c = np.unique(np.concatenate([_present(t) for t in texts[at : at + some]]), return_counts=True)
        spot = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
        old = keys[spot] == k if len(keys) else np.zeros(len(k), bool)
        counts[spot[old]] += c[old].astype(np.int32)
        k, c = k[~old], c[~old].astype(np.int32)
        to = np.searchsorted(keys, k)
        keys, counts = np.insert(keys, to, k), np.insert(counts, to, c)
    return keys, counts


def prior_shift(y: np.ndarray, share: float | None) -> float:
    """What to add to a logit learned on the sample ``y`` for a population
    with this share of label 1."""
    s = float(np.mean(y))
    return 0.0 if share is None else float(np.log(share / (1 - share)) - np.log(s / (1 - s)))


def fit(
    texts: list[str], labels: np.ndarray, share: float | None = None, features: int = 4096, least: int = 4, l2: float = 1.0, steps: int = 300
) -> NgramModel:
    """Log-count ratios and logistic regression over the ``features`` n-grams
    whose ratios are the most significant. ``share`` is the share of label 1
    among all labelled rows, where the sample's differs."""
    y = np.asarray(labels, float)
    own = y.mean() if len(y) else 0.0
    all_ = own if share is None else share
    none = NgramModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log((all_ + 1e-9) / (1 - all_ + 1e-9))))
    if not 0 < own < 1:
        return none
    by_label = []
    for label in (1, 0):
        k, c = _document_counts([t for t, own in zip(texts, y) if bool(own) == bool(label)])
        by_label.append(k[c >= least])
    keys = np.union1d(*by_label)
    if not len(keys):
        return none
    p, q = np.zeros(len(keys)), np.zeros(len(keys))

    def found(among: np.ndarray, text: str) -> np.ndarray:
        at = np.searchsorted(among, h := _present(text))
        at = np.minimum(at, len(among) - 1)
        return at[among[at] == h]

    for t, k in zip(texts, y):
        (p if k else q)[found(keys, t)] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    ratio = np.log(((p + 1) / (n1 + 2)) / ((q + 1) / (n0 + 2)))
    spread = np.sqrt(1 / (p + 1) + 1 / (q + 1))
    best = np.sort(np.argsort(-np.abs(ratio) / spread, kind="stable")[:features])
    sel, r = keys[best], ratio[best]
    rows, cols = [], []
    for k, t in enumerate(texts):  # again: all candidates of all texts would not be small
        own = found(sel, t)
        rows.append(np.full(len(own), k))
        cols.append(own)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    x = r[cols]
    w, b = np.zeros(len(sel)), float(np.log(n1 / n0))
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for s in range(1, steps + 1):  # Adam on the whole sample
        z = np.bincount(rows, x * w[cols], minlength=len(y)) + b
        e = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        g = np.bincount(cols, x * e[rows], minlength=len(sel)) / len(y) + l2 * w / len(y)
        gb = e.mean()
        mw, vw = 0.9 * mw + 0.1 * g, 0.999 * vw + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**s, 1 - 0.999**s
        w -= 0.03 * (mw / c1) / (np.sqrt(vw / c2) + 1e-8)
        b -= 0.03 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return NgramModel(sel, w * r, b + prior_shift(y, share))


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, max_per_class: int, max_chars: int, doc_id: str = "doc_id", text: str = "text",
    max_total_chars: int = 16_000_000,
) -> tuple[list[str], np.ndarray, float | None]:
    """Whole texts and labels of a bounded, repeatable sample: of each label
    the first ``max_per_class`` ids by their hash that are not held out, while
    their texts have ``max_total_chars`` characters together; and
    the share of label 1 among all rows that are not. ``held_out`` is over a
    column named id."""
    said = (
        labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("y"))
        .where("id is not null and y is not null")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .where(~held_out)
    )
    texts = docs.select(docs[doc_id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("t")).where(F.length("t") <= max_chars)
    rank = F.xxhash64("id")
    # ids and lengths first, once: the texts of no more than the sample are joined
    sized = stored(said.join(texts.groupBy("id").agg(F.max(F.length("t")).alias("n")), "id"), "sized")
    got: list = []
    for y in (0, 1):
        first = sized.where(F.col("y") == y if y == 0 else F.col("y") != 0).orderBy(rank, "id").limit(max_per_class)
        size = first.select("n").collect()
        ids = first.select("id").limit(int((np.cumsum([r[0] for r in size]) <= max_total_chars).sum()))
        got += [(t, y) for (t,) in texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("t").alias("t")).orderBy(rank, "id").select("t").collect()]
    share = said.agg(F.avg((F.col("y") != 0).cast("double"))).first()[0]
    return [t for t, _ in got], np.array([y for _, y in got], float), share


def score_rows(docs: DataFrame, make, held_out: Column, threshold: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row struct of all columns, held_out, score, predicted). ``make`` gives
    a task its function from texts to scores; ``held_out`` is over a column
    named id."""
    base = docs.select(F.struct(*[pick(docs, c) for c in docs.columns if c != text]).alias("row"), docs[doc_id].alias("id"), docs[text].alias("t"))
    base = base.select("row", "t", F.coalesce(held_out, F.lit(False)).alias("held_out"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scores = make()
        for t in in_blocks(batches, BLOCK_BYTES):
            s = scores(t.column("t").fill_null("").to_pylist())
            cols = [t.column("row").combine_chunks(), t.column("t").combine_chunks(), t.column("held_out").combine_chunks(), pa.array(s, pa.float64())]
            yield from pa.Table.from_arrays(cols, ["row", "t", "held_out", "score"]).to_batches()

    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())])
    got = base.mapInArrow(run, schema)
    return got.select("row", "t", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_per_class: int = 1500,
    max_chars: int = 100_000,
    threshold: float = 0.3,
    doc_id: str = "doc_id",
    text: str = "text",
    training_docs: DataFrame | None = None,
) -> DataFrame:
    """(row struct of the other columns, t string, held_out boolean, score
    double, predicted int), one row per input row. Trains on the labelled
    rows of ``training_docs`` (``docs`` by default) that are not held out."""
    held = bucket(F.col("id"), 4) == 2
    texts, y, share = training_sample(docs if training_docs is None else training_docs, labels, "toxic", held, max_per_class, max_chars, doc_id, text)
    shared = ship(docs.sparkSession, fit(texts, y, share))

    def make():
        model: NgramModel = shipped(shared)
        gate = model.gate()
        return lambda texts: model.scores(texts, gate)

    return score_rows(docs, make, held, threshold, doc_id, text)
