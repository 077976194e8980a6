"""Byte-level BPE encoding and decoding by a pair occurrence index.

For every block of a partition the distinct pre-tokens are laid out as one
symbol array. An index maps each mergeable pair (by its rank) to all its
positions; ranks are applied in ascending order, each to all positions at
once, and only the lists of the pairs next to a merge change. Texts are then
sequences of pre-token numbers, so ids, counts and decoded bytes are looked up.

Nothing is shuffled; memory is bounded by ``BLOCK_BYTES`` of text (one longer
text makes a block of its own). Null texts count as empty; empty texts have
no tokens. Every row is encoded on its own, so rows may repeat; an empty table
gives no rows. Input columns of any name are kept apart from the results; in
``encode_column`` a kept column named ids is refused.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import fresh, in_blocks, ship, shipped

#: Fixed value: the split pattern of this kind of vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 8 << 20


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, the public byte-level rule:
    visible Latin-1 characters stand for themselves, the rest follow from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class BpeModel:
    """Tables of a byte-level BPE file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for tok, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in tok)
        for tok, i in self.special.items():
            self.token_bytes[i] = tok.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.codes = self.left << 32 | self.right
        self._build_lookup()

    # A pair code -> rank: one probe in a large table; the few codes that
    # share a slot are in a sorted side list.
    _MUL, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 20)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * self._MUL >> self._SHIFT).astype(np.int64)

    def _build_lookup(self) -> None:
        slot = self._slot(self.codes)
        self.table = np.full(1 << 20, -1, np.int32)
        _, first = np.unique(slot, return_index=True)
        self.table[slot[first]] = first
        late = np.setdiff1d(np.arange(len(slot)), first)
        self.shared = np.zeros(1 << 20, bool)
        self.shared[slot[late]] = True
        order = np.argsort(self.codes[late])
        self.late_codes, self.late_ranks = self.codes[late][order], late[order].astype(np.int32)

    def ranks(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each pair code, -1 where no merge exists."""
        slot = self._slot(codes)
        r = self.table[slot]
        out = np.where((r >= 0) & (self.codes[r] == codes), r, np.int32(-1))
        if len(self.late_codes):
            again = np.flatnonzero((out < 0) & self.shared[slot])
            if len(again):
                at = np.minimum(np.searchsorted(self.late_codes, codes[again]), len(self.late_codes) - 1)
                hit = self.late_codes[at] == codes[again]
                out[again[hit]] = self.late_ranks[at[hit]]
        return out


def merge_all(model: BpeModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all ``words`` back to back, and each word's first index
    (one more entry than words)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n = int(lengths.sum())
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    sym = model.byte_id[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    nxt = np.arange(1, n + 1, dtype=np.int64)
    prv = np.arange(-1, n - 1, dtype=np.int64)
    full = lengths > 0
    ends = np.cumsum(lengths)[full] - 1
    nxt[ends] = -1
    prv[ends + 1 - lengths[full]] = -1

    index: dict[int, list[np.ndarray]] = {}  # rank -> position lists
    active: list[int] = []

    def add(pos: np.ndarray, ranks: np.ndarray) -> None:
        if len(pos) > 1:
            order = np.argsort(ranks, kind="stable")
            pos, ranks = pos[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cut.tolist(), len(pos)]
            groups = zip(ranks[starts[:-1]].tolist(), (pos[a:b] for a, b in zip(starts, starts[1:])))
        else:
            groups = zip(ranks.tolist(), (pos,))
        for r, p in groups:
            held = index.get(r)
            if held is None:
                index[r] = [p]
                heapq.heappush(active, r)
            else:
                held.append(p)

    if n:
        at = np.flatnonzero(nxt >= 0)
        r = model.ranks(sym[at] << 32 | sym[at + 1])
        ok = r >= 0
        add(at[ok], r[ok])
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        pos = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b, made = int(model.left[r]), int(model.right[r]), int(model.made[r])
        j = nxt[pos]
        ok = (sym[pos] == a) & (j >= 0)
        ok &= sym[j] == b
        if not ok.all():
            pos, j = pos[ok], j[ok]
        if not len(pos):
            continue
        if a == b and len(pos) > 1:  # aaa: every second one of a run, from the left
            new_run = np.r_[True, pos[1:] != j[:-1]]
            start = np.maximum.accumulate(np.where(new_run, np.arange(len(pos)), 0))
            odd = (np.arange(len(pos)) - start) % 2 == 0
            pos, j = pos[odd], j[odd]
        after = nxt[j]
        sym[pos] = made
        sym[j] = -1
        nxt[pos] = after
        has = after >= 0
        prv[after[has]] = pos[has]
        before = prv[pos]
        left = before[before >= 0]
        right = pos[has]
        spots = np.concatenate((left, right))
        if len(spots):
            ranks = model.ranks(sym[spots] << 32 | sym[nxt[spots]])
            ok = ranks >= 0
            if ok.any():
                add(spots[ok], ranks[ok])
    alive = sym >= 0
    counts = np.bincount(word_of[alive], minlength=len(words))
    return sym[alive].astype(np.int32), np.r_[0, np.cumsum(counts)]


def splitter(model: BpeModel):
    """text -> list of pre-tokens; special tokens stand as their own items."""
    import regex

    find = regex.compile(PATTERN).findall
    if not model.special:
        return find
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(model.special, key=len, reverse=True))) + ")")
    names = tuple(model.special)

    def split(text: str) -> list[str]:
        if not any(s in text for s in names):
            return find(text)
        out: list[str] = []
        for k, part in enumerate(cut.split(text)):
            out.extend([part] if k % 2 else find(part))
        return out

    return split


def encode_block(model: BpeModel, texts: list[str], split=None):
    """(numbers of each text's pre-tokens, ids, starts): pre-token w has the
    ids ``ids[starts[w]:starts[w + 1]]``."""
    split = split or splitter(model)
    number: dict[str, int] = {}

    def numbers(text: str) -> np.ndarray:
        toks = split(text)
        for t in set(toks).difference(number):
            number[t] = len(number)
        return np.fromiter(map(number.__getitem__, toks), np.int32, len(toks))

    docs = [numbers(t) for t in texts]
    words = list(number)
    special = [w for w in words if w in model.special]
    ids, starts = merge_all(model, [b"" if w in model.special else w.encode() for w in words])
    if special:  # a special token is one id and takes part in no merge
        at = [number[w] for w in special]
        ids = np.insert(ids, starts[at], [model.special[w] for w in special])
        extra = np.zeros(len(starts), np.int64)
        extra[np.array(at) + 1] = 1
        starts = starts + np.cumsum(extra)
    return docs, ids, starts


def encode_texts(model: BpeModel, texts: list[str]) -> list[np.ndarray]:
    """Token ids of every text."""
    docs, ids, starts = encode_block(model, texts)
    return [
        np.concatenate([ids[starts[w] : starts[w + 1]] for w in d.tolist()]) if len(d) else np.zeros(0, np.int32)
        for d in docs
    ]


def decode_ids(model: BpeModel, ids) -> str:
    """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(model.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode_column(df: DataFrame, model: BpeModel, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus ids array<int> of every row's text."""
    from pyspark.sql import types as T

    if "ids" in keep:
        raise ValueError("a kept column may not be named ids")
    shared, own = ship(df.sparkSession, model), fresh(df, "_text")
    fields = [df.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m: BpeModel = shipped(shared)
        for t in in_blocks(batches, BLOCK_BYTES):
            got = encode_texts(m, t.column(own).fill_null("").to_pylist())
            for at in range(0, len(got), 256):
                part = got[at : at + 256]
                cols = [t.column(c).slice(at, 256).combine_chunks() for c in keep]
                offs = np.r_[0, np.cumsum([len(x) for x in part])].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(part)))
                yield from pa.Table.from_arrays([*cols, ids], [*keep, "ids"]).to_batches()

    return df.select(*keep, df[text].alias(own)).mapInArrow(run, T.StructType(fields))


def bpe_digests(df: DataFrame, model: BpeModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) for every row: the ids as
    decimals joined by commas, and the text decoded from them."""
    shared = ship(df.sparkSession, model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        m: BpeModel = shipped(shared)
        split = splitter(m)
        decimal = [str(i) for i in range(len(m.token_bytes))]
        for t in in_blocks(batches, BLOCK_BYTES):
            docs, ids, starts = encode_block(m, t.column("t").fill_null("").to_pylist(), split)
            lens, ids, cuts = np.diff(starts), ids.tolist(), starts.tolist()
            spelt = [",".join(map(decimal.__getitem__, ids[a:b])) for a, b in zip(cuts, cuts[1:])]
            raw = [b"".join(map(m.token_bytes.__getitem__, ids[a:b])) for a, b in zip(cuts, cuts[1:])]
            count, listed, text_sha = [], [], []
            for d in docs:
                count.append(int(lens[d].sum()))
                d = d.tolist()
                listed.append(sha256(",".join(map(spelt.__getitem__, d)).encode()).hexdigest())
                whole = b"".join(map(raw.__getitem__, d)).decode("utf-8", "replace")
                text_sha.append(sha256(whole.encode()).hexdigest())
            cols = [t.column("k").combine_chunks(), pa.array(count, pa.int64()), pa.array(listed), pa.array(text_sha)]
            yield from pa.Table.from_arrays(cols, [key, "n_tokens", "ids_sha256", "decoded_sha256"]).to_batches()

    return df.select(df[key].alias("k"), df[text].alias("t")).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
