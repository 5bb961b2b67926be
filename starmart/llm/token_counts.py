"""Exact token counts of every prefix of a text, by dynamic programming over its prefixes.

For each prefix the table holds the number of tokens and the last token.  The last token of a prefix is the one piece
that ends there and is compatible with the last token of the prefix before it; exactly one is, so one pass over the
matches of an Aho-Corasick automaton fills the table.  A stored table answers how many tokens any prefix has and where a
text must be cut for a budget without encoding anything again.

Units (a word with its space mark, see ``piece_codec``) are independent, so the table of a text is made of those of its
units; a short unit's total is remembered, which changes nothing but time.  Counts are the SentencePiece library's own,
without begin and end; its strings of special tokens are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import text_of
from starmart.llm.piece_codec import MARK, Pieces, Remembered, words_of

DEFAULT_LIMIT = 4096


class PrefixCounter:
    def __init__(self, model_path: str) -> None:
        self.pieces = Pieces(model_path)
        self._totals = Remembered(self._total)
        self._runs = [0]

    def _segment(self, text: str, counts: list[int], lone: list[bool], start: int) -> None:
        """Extends the table of a unit by a segment in which every character has a piece."""
        p, n = self.pieces, len(text)
        pairs, compatible = p._pairs, p.compatible
        last = [-1] * (n + 1)
        base = counts[start]
        own, first = [0] * (n + 1), [False] * (n + 1)
        for end, (size, piece) in p.matcher.iter(text):
            end += 1
            if last[end] >= 0:
                continue  # the piece of this prefix is found; shorter matches follow
            begin = end - size
            if begin:
                key = last[begin] << 32 | piece
                fits = pairs.get(key)
                if not (compatible(last[begin], piece) if fits is None else fits):
                    continue
                first[end] = first[begin]
            else:
                first[end] = start == 0 and piece == p.lone_mark
            last[end], own[end] = piece, own[begin] + 1
        counts += [base + c for c in own[1:]]
        lone += first[1:] if start == 0 else [lone[start]] * n

    def unit(self, text: str) -> tuple[list[int], list[bool]]:
        """Per prefix of the unit: tokens, and whether the first one is a space mark alone."""
        counts, lone = [0], [False]
        p = self.pieces
        if p.known.issuperset(text):
            self._segment(text, counts, lone, 0)
            return counts, lone
        for k, part in enumerate(p.not_known.split(text)):
            if k % 2:
                counts.append(counts[-1] + len(part.encode("utf-8", "surrogatepass")))
                lone.append(lone[-1])
            elif part:
                self._segment(part, counts, lone, len(counts) - 1)
        return counts, lone

    def _total(self, word: str) -> int:
        if word[:1] == "\n":
            return 1 + (self.unit(word[1:])[0][-1] if len(word) > 1 else 0)
        return self.unit(MARK + word)[0][-1]

    def run(self, marks: int) -> list[int]:
        """Tokens of 0 to ``marks`` space marks."""
        if marks >= len(self._runs):
            sizes = [n for n in range(1, marks + 1) if MARK * n in self.pieces.ids]
            top = max(sizes)
            while len(self._runs) <= min(marks, 4 * top):
                self._runs.append(len(self.pieces.run(len(self._runs))))
            for n in range(len(self._runs), marks + 1):
                self._runs.append(len(self.pieces.run(n)))
        return self._runs[: marks + 1]

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of every prefix: entry ``i`` is that of the first ``i`` code points."""
        out, done = [0], 0
        for marks, body in self.pieces.spans(text.replace(MARK, " ")):
            bare = not marks or body in ("", "\n")
            runs = self.run(marks if bare else marks - 1)
            out += [done + c for c in runs[1:]]
            before = done + runs[-1]
            if body == "\n":
                out.append(before + 1)
            elif body and bare:
                out += [before + c for c in self.unit(body)[0][1:]]
            elif body:
                counts, lone = self.unit(MARK + body)
                joined = done + self.run(marks)[-1] - 1
                out += [(joined if alone else before) + c for c, alone in zip(counts[1:], lone[1:], strict=True)]
            done = out[-1]
        return np.array([0, *out[2:]] if text else [0], "int64")  # without the mark that every text gets in front

    def total(self, text: str) -> int:
        if not text:
            return 0
        words = words_of(text)
        if "" in words:
            return int(self.prefixes(text)[-1])
        return sum(map(self._totals.table(words).__getitem__, words))

    def fitting(self, text: str, budget: int) -> int:
        """Code points of the longest prefix that has ``budget`` tokens at most."""
        words = words_of(text)
        if not text or "" in words:
            return int(np.flatnonzero(self.prefixes(text) <= budget)[-1]) if budget >= 0 else 0
        table = self._totals.table(words)
        before = list(accumulate(map(table.__getitem__, words), initial=0))
        if before[-1] <= budget:
            return len(text)
        k = int(np.searchsorted(np.array(before), budget, "right")) - 1
        word = words[k]
        chars = sum(map(len, words[:k])) + sum(w[:1] != "\n" for w in words[1:k])
        if word[:1] == "\n":
            counts = [0, 1, *(1 + c for c in self.unit(word[1:])[0][1:])] if len(word) > 1 else [0, 1]
        else:
            counts = self.unit(MARK + word)[0]
            counts = counts if k else counts[1:]
        return chars + max((i for i, c in enumerate(counts) if before[k] + c <= budget or not i), default=0)


@lru_cache(maxsize=2)
def counter(model_path: str) -> PrefixCounter:
    """One counter per Python worker and model."""
    return PrefixCounter(model_path)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


def prefix_tables(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, prefix_tokens (array<int>; entry i: tokens of the first i code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                tables = [c.prefixes(t).astype("int32") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(tables, pa.list_(pa.int32()))], ["doc_id", "prefix_tokens"]
                )

    return _rows(docs).mapInArrow(run, "doc_id long, prefix_tokens array<int>")


def token_counts(docs: DataFrame, model_path: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, fits_chars (code points of the longest prefix
    within ``limit`` tokens).

    No shuffle.  NULL text counts as empty (no tokens); repeated rows and NULL ``doc_id`` pass through; other columns are
    never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_path)
        for batch in batches:
            tokens, fits = [], []
            for text in (x.as_py() for x in batch.column("text")):
                n = c.total(text)
                tokens.append(n)
                fits.append(len(text) if n <= limit else c.fitting(text, limit))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.compute.cast(pa.compute.binary_length(batch.column("text")), pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens]), pa.array(fits, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"],
            )

    return _rows(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long")


def within(tables: DataFrame, chars: str) -> DataFrame:
    """Tokens of the first ``chars`` (a column) code points from stored ``prefix_tables``, without encoding."""
    at = F.least(F.greatest(F.col(chars), F.lit(0)), F.size("prefix_tokens") - 1)
    return tables.withColumn("tokens", F.element_at("prefix_tokens", (at + 1).cast("int")))
