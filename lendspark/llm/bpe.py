"""Byte-level BPE encoding and decoding by rank files.

Every match of the split pattern is merged on its own.  A segment tree over the byte positions of a match keeps, in its root, the
leftmost pair of lowest rank; a merge updates the two live neighbours in logarithmic time, so a match of n bytes takes O(n log n),
also when a text is one single match.  Matches seen before come from a table that each Python worker keeps, of bounded size.
"""

from __future__ import annotations

import base64
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, map_texts

#: characters of text that are encoded together
PART_CHARS = 1_000_000
#: texts above this many characters are split as a stream
STREAM_CHARS = 2_000_000
_NONE = 1 << 62
#: white space other than spaces and line ends
_ODD = re.compile(r"[^\S \n]")


def _plain(t: str) -> bool:
    """No white space beside a space or at an end: then every single space begins a match."""
    return not ("  " in t or " \n" in t or "\n " in t or t[:1] == " " or t[-1:] == " " or _ODD.search(t))


def _word_cut(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: repeatedly join the leftmost adjacent pair whose joined bytes have the lowest rank."""
    n = len(piece)
    if piece in ranks or n == 1:
        return [ranks[piece]]
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    get = ranks.get
    # leaf i: rank of the pair that starts at byte i, made unique and leftmost-first by the position
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))  # start of the next live token
    before = list(range(-1, n))  # start of the previous one
    while (key := tree[1]) != _NONE:
        i = key % n
        j = after[i]
        end = after[i] = after[j]
        before[end] = i
        changes = [(j, _NONE)]
        rank = get(piece[i:after[end]]) if end < n else None
        changes.append((i, _NONE if rank is None else rank * n + i))
        p = before[i]
        if p >= 0:
            rank = get(piece[p:end])
            changes.append((p, _NONE if rank is None else rank * n + p))
        for leaf, value in changes:
            k = size + leaf
            if k >= 2 * size:  # the last byte starts no pair
                continue
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Codec:
    """Encoder and decoder of one rank file; remembers recent words within fixed bounds."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.bytes = np.array([self.ranks[bytes([k])] for k in range(256)], dtype=np.int64)
        pairs = {(self.ranks[t[:k]] << 32) | self.ranks[t[k:]]: rank for t, rank in self.ranks.items()
                 for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.pieces = Remembered(lambda piece: _packed(merge(piece.encode(), self.ranks)), 120_000)
        self.words = Remembered(self._match, 200_000)

    def _match(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """``merge`` of many matches of at most 64 bytes at once: one segment tree a row, one merge a row and round."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        for low, size in ((0, 8), (8, 16), (16, 32), (32, 64)):
            chosen = np.flatnonzero((lengths > low) & (lengths <= size)).tolist()
            if not chosen:
                continue
            rows, n = len(chosen), lengths[chosen]
            raw = np.frombuffer(b"".join(pieces[k].ljust(size, b"\0") for k in chosen), dtype=np.uint8).reshape(rows, size)
            token = np.concatenate([self.bytes[raw], np.zeros((rows, 1), dtype=np.int64)], axis=1)
            after = np.tile(np.arange(1, size + 2), (rows, 1))
            before = np.tile(np.arange(-1, size), (rows, 1))
            tree = np.full((rows, 2 * size), _NONE, dtype=np.int64)
            place = np.arange(size - 1)
            rank = self._pair_rank(token[:, :size - 1], token[:, 1:size])
            tree[:, size:2 * size - 1] = np.where((rank >= 0) & (place + 1 < n[:, None]), rank * size + place, _NONE)
            for k in range(size - 1, 0, -1):
                tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
            live = np.flatnonzero(tree[:, 1] != _NONE)
            while len(live):
                key = tree[live, 1]
                i = key % size
                j = after[live, i]
                end = after[live, j]
                token[live, i] = key // size  # a token's id is its rank
                after[live, i] = end
                before[live, end] = i
                p = before[live, i]
                right = np.where(end < n[live], self._pair_rank(token[live, i], token[live, end]), -1)
                left = np.where(p >= 0, self._pair_rank(token[live, p], token[live, i]), -1)
                for leaf, rank in ((j, None), (i, right), (np.where(p >= 0, p, j), left)):
                    at = size + leaf
                    tree[live, at] = _NONE if rank is None else np.where(rank >= 0, rank * size + leaf, _NONE)
                    while at[0] > 1:
                        at >>= 1
                        tree[live, at] = np.minimum(tree[live, 2 * at], tree[live, 2 * at + 1])
                live = live[tree[live, 1] != _NONE]
            at = np.zeros(rows, dtype=np.int64)
            starts = np.zeros((rows, size), dtype=bool)
            live = np.arange(rows)
            while len(live):
                starts[live, at[live]] = True
                at[live] = after[live, at[live]]
                live = live[at[live] < n[live]]
            ids = token[:, :size][starts].astype("<u4")
            cuts = np.concatenate([[0], np.cumsum(starts.sum(axis=1))]) * 4
            packed = ids.tobytes()
            for k, a, b in zip(chosen, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[k] = packed[a:b]
        return out

    def _learn(self, words: set[str]) -> None:
        """Encode the matches of new words together."""
        split = {w: self.pattern.findall(w) for w in words if len(w) <= 64}
        found = set(itertools.chain.from_iterable(split.values())) - self.pieces.keys() - self.pieces.older.keys()
        fresh = {w: raw for w in found if len(raw := w.encode()) <= 64 and raw not in self.ranks}
        for w, packed in zip(fresh, self.merge_many(list(fresh.values()))):
            self.pieces.put(w, packed)
        get = self.pieces.__getitem__
        for w, parts in split.items():
            self.words.put(w, b"".join(map(get, parts)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text.

        Between two characters that are no white space, a single space always begins a match, so plain texts are cut there first.
        """
        out, part, size = [], [], 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= PART_CHARS:
                out += self._encode_part(part)
                part, size = [], 0
        return out + self._encode_part(part)

    def _encode_part(self, texts: list[str]) -> list[bytes]:
        cut = [None if len(t) > STREAM_CHARS or not _plain(t) else _word_cut(t) for t in texts]
        self._learn(set().union(*(c for c in cut if c)) - self.words.keys() - self.words.older.keys())
        return [self.encode(t) if c is None else b"".join(map(self.words.__getitem__, c)) for t, c in zip(texts, cut)]

    def encode(self, text: str) -> bytes:
        if len(text) <= STREAM_CHARS:
            return self._match(text)
        found = (m.group() for m in self.pattern.finditer(text))
        return b"".join(b"".join(map(self.pieces.__getitem__, part)) for part in itertools.batched(found, 65536))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec, loaded once."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """Every row of ``df`` with its packed ids (little-endian unsigned 32-bit) in ``out``, and decoded again in ``decoded`` if named.

    A null text counts as empty and gets no ids.  Repeated rows get the same ids; other columns pass through, those with the new
    names are replaced.  There are no special tokens: their strings in a text are ordinary text.  One pass, no shuffle.
    """

    def make():
        own = codec(path, pattern)

        def run(texts: list[str | None]) -> list[list]:
            ids = own.encode_all([t or "" for t in texts])
            return [ids, [own.decode(i) for i in ids]] if decoded else [ids]

        return run

    return map_texts(df, text, f"`{out}` binary" + (f", `{decoded}` binary" if decoded else ""), make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row of ``df`` with the bytes of its packed ids in ``out``; null ids count as none, unknown ids raise."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for packed in batches:
            yield packed.map(own.decode)

    return df.withColumn(out, run(F.coalesce(F.col(ids), F.lit(b""))))
