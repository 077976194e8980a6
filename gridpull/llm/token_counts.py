"""Token counts that follow edits, by a segment tree of pre-tokens.

Each document's pre-tokens are dealt to leaves of ``LEAF``; a tree holds the
characters and tokens under every node, so a position is found and a sum
renewed in logarithmic steps. An edit re-encodes only the text from a safe
pre-token boundary before it to the first boundary after it that the old text
had too; the sums above the changed leaves are updated. A leaf that an edit
fills beyond ``FULL`` pre-tokens is dealt anew, and the tree over all leaves is
built again, once for each so many new pre-tokens. Counts equal a full encoding
of the edited text.

Nothing is shuffled. Defined cases: a null text is empty; a null list of edits
is empty; edits are applied one after another, positions in characters of the
text as it then is, cut to its ends; a null replacement is empty. Texts of any
length are one tree each; every row is counted on its own, so rows and keys may
repeat or be null; an empty table gives no rows. Only the key, the text and the
edits are read, so other columns may have any name; the key's name must differ
from the results'.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import BLOCK_BYTES, BpeModel, merge_all, splitter
from .common import in_blocks, ship, shipped

LEAF = 32
FULL = 8 * LEAF


class SumTree:
    """Sums over a fixed number of leaves, one row of ``data`` per quantity."""

    def __init__(self, leaves: np.ndarray):
        rows, n = leaves.shape
        self.size = 1 << max(0, (n - 1).bit_length())
        self.data = np.zeros((rows, 2 * self.size), np.int64)
        self.data[:, self.size : self.size + n] = leaves
        width = self.size
        while width > 1:
            level = self.data[:, width : 2 * width]
            self.data[:, width // 2 : width] = level[:, ::2] + level[:, 1::2]
            width //= 2

    def total(self, row: int) -> int:
        return int(self.data[row, 1])

    def put(self, leaf: int, values) -> None:
        at = self.size + leaf
        delta = np.asarray(values) - self.data[:, at]
        while at:
            self.data[:, at] += delta
            at >>= 1

    def find(self, row: int, position: int) -> tuple[int, int]:
        """(leaf, sum before it) of the leaf that holds ``position``; past the
        end, the last leaf that is not empty."""
        at, before = 1, 0
        sums = self.data[row]
        position = min(position, max(int(sums[1]) - 1, 0))
        while at < self.size:
            at *= 2
            if position - before >= sums[at]:
                before += int(sums[at])
                at += 1
        return at - self.size, before


class TokenTree:
    """One document: leaves of pre-tokens and their sums (characters, tokens).

    ``count`` numbers tokens of a list of pre-tokens; edits may leave it to
    the end (``settle``), so that many documents share one call."""

    def __init__(self, tokens: list[str], counts: np.ndarray, split: Callable[[str], list[str]], context: int):
        self.split, self.context = split, context
        self.leaves = [tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF)] or [[]]
        n = len(self.leaves)
        sums = np.zeros((2, n), np.int64)
        if tokens:
            at = np.arange(0, len(tokens), LEAF)
            sums[0] = np.add.reduceat(np.fromiter(map(len, tokens), np.int64, len(tokens)), at)
            sums[1] = np.add.reduceat(counts, at)
        self.tree = SumTree(sums)
        self.dirty: set[int] = set()
        self.reencoded = 0

    def text(self) -> str:
        return "".join(t for leaf in self.leaves for t in leaf)

    def edit(self, start: int, end: int, new: str) -> None:
        size = self.tree.total(0)
        start, end = min(max(start, 0), size), min(max(end, start, 0), size)
        first, before = self._safe_start(start)
        # grow to the right until a boundary of the old text is met again
        last, at = self.tree.find(0, end)
        reach = 1
        while True:
            stop = min(last + reach, len(self.leaves))
            old = [t for leaf in self.leaves[first:stop] for t in leaf]
            text = "".join(old)
            changed = text[: start - before] + new + text[end - before :]
            got = self.split(changed)
            self.reencoded += len(changed)
            done = self._resync(old, got, changed, end - before, len(new) - (end - start), stop == len(self.leaves))
            if done is not None:
                break
            reach *= 2
        keep_new, keep_old = done
        tokens = got[:keep_new] + old[keep_old:]
        if len(tokens) > LEAF * (stop - first - 1) + FULL:
            self._deal(first, stop, tokens)
            return
        for k, leaf in enumerate(range(first, stop)):  # the last leaf takes what is over
            part = tokens[k * LEAF : (k + 1) * LEAF] if leaf < stop - 1 else tokens[k * LEAF :]
            self.leaves[leaf] = part
            self.tree.put(leaf, [sum(map(len, part)), self.tree.data[1, self.tree.size + leaf]])
            self.dirty.add(leaf)

    def _deal(self, first: int, stop: int, tokens: list[str]) -> None:
        """Leaves ``first`` to ``stop`` become as many as ``tokens`` need."""
        new = [tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF)]
        sums = self.tree.data[:, self.tree.size : self.tree.size + len(self.leaves)]
        own = np.array([[sum(map(len, part)), 0] for part in new], np.int64).T
        self.leaves[first:stop] = new
        self.tree = SumTree(np.concatenate([sums[:, :first], own, sums[:, stop:]], axis=1))
        shift = len(new) - (stop - first)
        self.dirty = {k if k < first else k + shift for k in self.dirty if not first <= k < stop} | set(range(first, first + len(new)))

    def _safe_start(self, start: int) -> tuple[int, int]:
        """A leaf, and the characters before it, whose earlier pre-tokens do
        not depend on text from ``start`` on: they end ``context`` characters
        before it, and not in white space."""
        leaf, before = self.tree.find(0, max(start - self.context, 0))
        while leaf and (before > start - self.context or not self.leaves[leaf - 1] or self.leaves[leaf - 1][-1][-1].isspace()):
            leaf -= 1
            before -= sum(map(len, self.leaves[leaf]))
        return leaf, before

    def _resync(self, old: list[str], got: list[str], changed: str, end: int, shift: int, whole: bool) -> tuple[int, int] | None:
        """(new tokens to take, old tokens they stand for): the first common
        boundary after the edit that does not depend on text further right."""
        ends = np.cumsum([0, *map(len, old)]) + shift
        at = {int(e): k for k, e in enumerate(ends)}
        pos, limit = 0, len(changed) - self.context
        for k, t in enumerate(got):
            if pos >= end + shift and pos in at and ends[at[pos]] - shift >= end and pos <= limit and pos and not changed[pos - 1].isspace():
                return k, at[pos]
            pos += len(t)
        return (len(got), len(old)) if whole else None

    def settle(self, count_of: Callable[[str], int]) -> None:
        for leaf in self.dirty:
            part = self.leaves[leaf]
            self.tree.put(leaf, [self.tree.data[0, self.tree.size + leaf], sum(map(count_of, part))])
        self.dirty.clear()

    def n_tokens(self) -> int:
        return self.tree.total(1)


def count_tokens(model: BpeModel, words: list[str]) -> dict[str, int]:
    """Tokens of each pre-token."""
    _, starts = merge_all(model, [b"" if w in model.special else w.encode() for w in words])
    n = np.diff(starts)
    return {w: 1 if w in model.special else int(k) for w, k in zip(words, n)}


def count_after_edits(
    df: DataFrame,
    model: BpeModel,
    edits: str | Callable[[str], list[tuple[int, int, str]]],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_tokens long, n_edits long, n_tokens_edited long, n_reencoded
    long), one row per input row. ``edits`` is a column of type
    array<struct<start: int, end: int, text: string>>, or a function from a
    text to such a list. n_reencoded counts the
    characters that were split again."""
    shared = ship(df.sparkSession, model)
    of_text = edits if callable(edits) else None
    context = max([len(s) for s in model.special] + [0]) + 4
    cols = [df[key].alias("k"), df[text].alias("t")] + ([] if of_text else [df[edits].alias("e")])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m: BpeModel = shipped(shared)
        split = splitter(m)
        for t in in_blocks(batches, BLOCK_BYTES):
            texts = t.column("t").fill_null("").to_pylist()
            if of_text:
                lists = [of_text(x) for x in texts]
            else:
                lists = [[(e["start"] or 0, e["end"] or 0, e["text"] or "") for e in x or () if e] for x in t.column("e").to_pylist()]
            number: dict[str, int] = {}
            docs = []
            for x in texts:
                toks = split(x)
                for w in set(toks).difference(number):
                    number[w] = len(number)
                docs.append(toks)
            known = count_tokens(m, list(number))
            before, after, edited, redone, trees = [], [], [], [], []
            for toks, own in zip(docs, lists):
                n = np.fromiter(map(known.__getitem__, toks), np.int64, len(toks))
                tree = TokenTree(toks, n, split, context)
                before.append(tree.n_tokens())
                for start, end, new in own:
                    tree.edit(start, end, new)
                edited.append(len(own))
                redone.append(tree.reencoded)
                trees.append(tree if tree.dirty else tree.n_tokens())
            late = {w for x in trees if isinstance(x, TokenTree) for leaf in x.dirty for w in x.leaves[leaf] if w not in known}
            known.update(count_tokens(m, list(late)))
            for x in trees:
                if isinstance(x, TokenTree):
                    x.settle(known.__getitem__)
                    x = x.n_tokens()
                after.append(x)
            out = [t.column("k").combine_chunks(), *(pa.array(v, pa.int64()) for v in (before, edited, after, redone))]
            yield from pa.Table.from_arrays(out, [key, "n_tokens", "n_edits", "n_tokens_edited", "n_reencoded"]).to_batches()

    fields = [T.StructField(key, df.schema[key].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_edits", "n_tokens_edited", "n_reencoded")]
    return df.select(*cols).mapInArrow(run, T.StructType(fields))
