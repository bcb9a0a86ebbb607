"""Token counts by prefix dynamic programming, for BPE piece models with byte fallback.

For each prefix of a text there is exactly one piece that can end its encoding: the piece that forms a valid pair with the last piece
of the prefix before it, where a pair is valid if encoding its joined characters gives that pair back.  So one pass over the characters
gives the token count of *every* prefix, and truncation or budget questions are look-ups.  No piece of such a model holds a space
after another character, so a text falls into independent chunks (spaces, then other characters); a worker remembers the counts
of chunks seen before, in a table of bounded size.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

from pyspark.sql import DataFrame

from .common import Remembered, map_texts

#: piece pairs whose validity a worker remembers
PAIRS = 1_000_000
_SPACE = "▁"
_CHUNK = re.compile(r" *[^ ]+| +")


class Counter(Remembered):
    """Chunk to the token counts of all its prefixes (by characters), filled on demand."""

    def __init__(self, path: str) -> None:
        super().__init__(self._count)
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        # only the vocabulary is taken from the library; a higher score merges first
        self.rank = {model.id_to_piece(i).replace(_SPACE, " "): -model.get_score(i) for i in normal}
        if any(" " in piece.lstrip(" ") for piece in self.rank):
            raise ValueError("a piece spans a space: chunks would not be independent")
        self.tails = {piece[i:] for piece in self.rank for i in range(len(piece))}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _merge(self, text: str) -> list[str]:
        """Plain BPE of a short text, from which pair validity follows."""
        parts = list(text)
        rank = self.rank.get
        while len(parts) > 1:
            scores = [rank(a + b, 1e18) for a, b in zip(parts, parts[1:])]
            low = min(scores)
            if low == 1e18:
                break
            i = scores.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _valid(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self._merge(left + right) == ([left, right] if left else [right])
            self.pairs[left, right] = known
        return known

    def _count(self, chunk: str) -> array:
        rank, tails, pairs = self.rank, self.tails, self.pairs
        last, counts = [""], [0]
        for end in range(1, len(chunk) + 1):
            start = end - 1
            while start >= 0 and (piece := chunk[start:end]) in tails:
                if piece in rank:
                    # a character outside the vocabulary ("" too) joins nothing: what follows it stays as it is
                    known = pairs.get((last[start], piece))
                    if self._valid(last[start], piece) if known is None else known:
                        counts.append(counts[start] + 1)
                        last.append(piece)
                        break
                start -= 1
            else:
                if chunk[end - 1] in rank:
                    raise ValueError(f"no piece ends {chunk[:end]!r}")
                counts.append(counts[end - 1] + len(chunk[end - 1].encode()))
                last.append("")
        return array("I", counts)

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text as the model sees it: a leading space is added, none for an empty text."""
        text = text.replace(_SPACE, " ")
        if not text or text[0] == " " or text[-1] == " " or "  " in text:
            return _CHUNK.findall(" " + text) if text else []
        return list(map(" ".__add__, text.split(" ")))

    def total(self, text: str) -> int:
        return sum([counts[-1] for counts in map(self.__getitem__, self.chunks(text))])

    def prefixes(self, text: str) -> array:
        """Token count of text[:i] for i = 0 .. len(text)."""
        out, base = array("I", [0]), 0
        for k, chunk in enumerate(self.chunks(text)):
            counts = self[chunk]
            # the first chunk starts with the added space, which is no prefix of the text
            out.extend(base + c for c in counts[2 if k == 0 else 1:])
            base += counts[-1]
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter, loaded once."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _mapped(df: DataFrame, path: str, text: str, field: str, of: Callable[[Counter, str], object]) -> DataFrame:
    def make():
        own = counter(path)
        return lambda texts: [[of(own, t or "") for t in texts]]

    return map_texts(df, text, field, make)


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Every row of ``df`` with the token count of its whole text in ``out``.

    Null counts as empty (0 tokens).  Begin, end and other special tokens are not added; their strings in a text are ordinary text.
    One pass, no shuffle; other columns pass through, one named ``out`` is replaced.
    """
    return _mapped(df, path, text, f"`{out}` long", lambda own, t: own.total(t))


def prefix_counts(df: DataFrame, path: str, text: str = "text", out: str = "prefix_tokens") -> DataFrame:
    """Every row with the token counts of all prefixes of its text, by characters: element i is for text[:i], so n + 1 elements."""
    return _mapped(df, path, text, f"`{out}` array<int>", lambda own, t: own.prefixes(t).tolist())


def fit_budget(df: DataFrame, path: str, budget: int, text: str = "text", out: str = "fitting") -> DataFrame:
    """Every row with the longest prefix of its text that takes at most ``budget`` tokens, read off the prefix counts.

    Counts are not monotone in the length, so the last fitting prefix is looked for from the end.
    """

    def cut(own: Counter, t: str) -> str:
        counts = own.prefixes(t)
        return t[:next(i for i in range(len(counts) - 1, -1, -1) if counts[i] <= budget)]

    return _mapped(df, path, text, f"`{out}` string", cut)
