"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: for the contexts of up to ORDER bytes before a byte, how often each byte followed.  A byte is
coded in its longest known context; a byte not seen there escapes to the context shorter by one, down to a uniform code.  Symbol
and escape probabilities are those of method C (escape weight = number of distinct symbols), from statistics that are frozen after
training.  A text is coded word by word (letters, lower case, contexts do not cross words), so its exact code length is
the sum of its words' lengths, and a word's length is computed once in each Python worker.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, bounded_sample, map_texts

ORDER = 4
_LETTERS = regex.compile(r"\p{L}+")


def contexts(word: str) -> Iterator[tuple[bytes, int]]:
    """Every (context, byte) of a word between word ends, for all orders."""
    raw = b" " + word.encode() + b" "
    for i in range(1, len(raw)):
        for k in range(min(ORDER, i) + 1):
            yield raw[i - k:i], raw[i]


class Model:
    """Context trees of all languages, as code lengths in bits."""

    def __init__(self, rows: list[tuple[str, bytes, int, int]]) -> None:
        """``rows``: language, context, byte, count."""
        self.languages = sorted({r[0] for r in rows}, key=str.encode)
        seen: dict[str, dict[bytes, dict[int, int]]] = {lang: {} for lang in self.languages}
        for lang, context, byte, count in rows:
            seen[lang].setdefault(bytes(context), {})[byte] = count
        self.trees = [{context: (_bits(len(s), sum(s.values()) + len(s)), {b: _bits(c, sum(s.values()) + len(s)) for b, c in s.items()})
                       for context, s in seen[lang].items()} for lang in self.languages]

    def step_bits(self, gram: bytes) -> list[float]:
        """Code length of the last byte of ``gram`` after the bytes before it (up to ORDER of its word), in each language."""
        byte, out = gram[-1], []
        for tree in self.trees:
            total = 0.0
            for k in range(len(gram) - 1, -1, -1):
                node = tree.get(gram[len(gram) - 1 - k:-1])
                if node is not None:  # an unknown context costs nothing: both sides know that it is unknown
                    bits = node[1].get(byte)
                    if bits is not None:
                        total += bits
                        break
                    total += node[0]
            else:
                total += 8.0
            out.append(total)
        return out


def _bits(part: int, whole: int) -> float:
    return math.log2(whole / part)


class Scorer:
    """Sums of code lengths; remembers recent steps (a byte after its context) and recent chunks, within fixed bounds."""

    KEPT = 300_000

    def __init__(self, model: Model) -> None:
        self.model = model
        self.steps = Remembered(model.step_bits, 100_000)
        self.rows = np.zeros((self.KEPT + 50_001, len(model.languages) + 1))
        self.place: dict[str, int] = {}

    def word_bits(self, word: str) -> list[float]:
        """Code length of a word and its end in each language."""
        raw = b" " + word.encode() + b" "
        steps = self.steps
        return [sum(col) for col in zip(*[steps[raw[i - ORDER if i > ORDER else 0:i + 1]] for i in range(1, len(raw))])]

    def _chunk(self, chunk: str) -> list[float]:
        """Bits in each language, and the bytes coded."""
        words = _LETTERS.findall(chunk.lower())
        bits = [self.word_bits(w) for w in words]
        return [sum(col) for col in zip(*bits)] + [sum(len(w.encode()) + 1 for w in words)] if words else [0.0] * self.rows.shape[1]

    def _learn(self, chunk: str) -> int:
        at = len(self.place)
        self.rows[at] = self._chunk(chunk)
        self.place[chunk] = at
        return at

    def text(self, text: str) -> np.ndarray:
        total = np.zeros(self.rows.shape[1])
        chunks = text.split()
        for start in range(0, len(chunks), 50_000):
            part = chunks[start:start + 50_000]
            if len(self.place) > self.KEPT:  # a part adds 50,000 at most
                self.place.clear()
            known = self.place.get
            at = [known(c) for c in part]
            if None in at:
                at = [k if k is not None else known(c, -1) if c in self.place else self._learn(c) for k, c in zip(at, part)]
            total += self.rows[at].sum(axis=0)
        return total


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = 600) -> Model:
    """Context trees from at most ``rows_per_language`` rows of each language, chosen by hash of key and text; the same rows in every run.

    Rows repeated in full are learnt once, rows with a null key like others.

    That documented bound on rows bounds the model: only contexts seen twice or more are kept beyond order 1.  Rows with a null
    language or text are not learnt from.  Counting is distributed; the driver holds the finished trees.
    """
    own = df.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    sample = bounded_sample(own.where("lang is not null and text is not null"), "lang", ["k", "text"], rows_per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for language, group in pdf.groupby("lang"):
                words: Counter = Counter()
                for t in group["text"]:
                    words.update(_LETTERS.findall(t.lower()))
                nodes: Counter = Counter()
                for word, n in words.items():
                    for item in contexts(word):
                        nodes[item] += n
                yield pd.DataFrame({"lang": language, "context": [c for c, _ in nodes], "byte": [b for _, b in nodes], "n": list(nodes.values())})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, context binary, byte int, n long")
    trees = counted.groupBy("lang", "context", "byte").agg(F.sum("n").alias("n")).where("n > 1 or octet_length(context) < 2")
    return Model([tuple(r) for r in trees.collect()])


def identify(df: DataFrame, model: Model, text: str = "text", max_bits: float = 8.0) -> DataFrame:
    """Every row of ``df`` with language, score, bits_per_byte and ``rejected``.

    ``language``: the one whose tree codes the text in the fewest bits (first by code point on ties); ``und`` if the text is null, has no
    letter, or nothing was learnt.  ``score``: its probability given the code lengths and equal priors, 0 for ``und``.
    ``rejected``: ``und``, or no language codes the letters in fewer than ``max_bits`` bits a byte, as a uniform code would.
    Whole texts of any length are scored in pieces.  No shuffle; columns of ``df`` with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        names = scorer.model.languages

        def one(text: str | None) -> tuple:
            total = scorer.text(text) if text and names else np.zeros(1)
            bits, coded = total[:-1], total[-1]
            if coded == 0:
                return "und", 0.0, None, True
            best = int(bits.argmin())
            score = float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())
            return names[best], score, float(bits[best] / coded), bool(bits[best] / coded >= max_bits)

        return lambda texts: list(zip(*map(one, texts)))

    return map_texts(df, text, "language string, score double, bits_per_byte double, rejected boolean", make)
