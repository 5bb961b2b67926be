"""Exact encoding and decoding with a merge-type (BPE) SentencePiece vocabulary, by backtracking.

A sequence of pieces is the library's encoding of a text exactly when every two neighbours are compatible, that is when
merging their joined characters again gives just these two pieces.  So the encoder never merges a whole text.  It walks
forward with the longest piece at each position (Aho-Corasick), checks the piece against its left neighbour, falls back
to shorter prefixes of the piece, and steps back when none fits; positions from which no way led on are marked in a
bitfield and never entered again.  Pair checks are remembered, as there are few different pairs.

A text falls into units that no piece spans: a word with the space mark before it, or a word after a line end.  The
encodings of short units are remembered in two bounded generations; that changes nothing but time.  Runs of space marks
merge after everything else, as their scores are the lowest, so a run is merged by itself.  Characters without a piece
become byte pieces and no piece spans them.

The vocabulary is read from ``model_path`` on each executor (the library serves as file reader only).
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import text_of

MARK = "▁"
REMEMBERED_UNITS = 250_000
REMEMBERED_PAIRS = 1_000_000
LONG_UNIT = 64
_RUNS = re.compile(f"({MARK}*)(\n|[^{MARK}\n]+)?")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("starmart-each-byte", _each_byte)


class Pieces:
    """The vocabulary, its matcher and the compatibility of neighbours."""

    def __init__(self, model_path: str) -> None:
        reader = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.begin, self.end, self.unknown = reader.bos_id(), reader.eos_id(), reader.unk_id()
        self.text: list[str] = [reader.id_to_piece(i) for i in range(reader.vocab_size())]
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        self.control = {i for i in range(reader.vocab_size()) if reader.is_control(i)}
        for i, piece in enumerate(self.text):
            if reader.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif reader.is_control(i):
                self.raw.append(b"")
            elif reader.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = -reader.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        mixed = [p for p in self.ids if MARK in p[1:] and p.strip(MARK)]
        alone = [p for p in self.ids if not set(p) <= self.ids.keys()]
        if mixed or alone:
            raise ValueError("units need pieces with space marks in front only, and a piece for each of their characters")
        self.known = {p for p in self.ids if len(p) == 1}
        self.not_known = re.compile("([^" + re.escape("".join(sorted(self.known))) + "])")
        self.lone_mark = self.ids[MARK]
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) == 1 or piece.strip(MARK):
                self.matcher.add_word(piece, (len(piece), i))
        self.matcher.make_automaton()
        self.length = [len(p) for p in self.text]
        self.shorter = [-1] * len(self.text)
        for piece, i in self.ids.items():
            for n in range(len(piece) - 1, 0, -1):
                if (found := self.ids.get(piece[:n])) is not None:
                    self.shorter[i] = found
                    break
        self._pairs: dict[int, bool] = {}
        self._runs: dict[int, list[int]] = {}

    def merge(self, text: str) -> list[int]:
        """Plain merging of known characters: best score first, leftmost among equals."""
        rank, n = self.rank, len(text)
        part: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank[text[i:i + 2]], i, 2) for i in range(n - 1) if text[i:i + 2] in rank]
        heapq.heapify(queue)
        while queue:
            _, left, size = heapq.heappop(queue)
            right = after[left] if part[left] is not None else n
            if right >= n or len(part[left]) + len(part[right]) != size:
                continue
            part[left] += part[right]
            part[right] = None
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b < n and (both := part[a] + part[b]) in rank:
                    heapq.heappush(queue, (rank[both], a, len(both)))
        return [self.ids[p] for p in part if p is not None]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= REMEMBERED_PAIRS:
                self._pairs.clear()
            found = self._pairs[key] = self.merge(self.text[left] + self.text[right]) == [left, right]
        return found

    def run(self, marks: int) -> list[int]:
        """The pieces of a run of space marks."""
        found = self._runs.get(marks)
        if found is None:
            found = self.merge(MARK * marks)
            if marks <= 1024:
                self._runs[marks] = found
        return found

    def segment(self, text: str) -> list[int]:
        """Backtracking over characters that all have pieces and with one space mark at most, in front."""
        n = len(text)
        longest = [-1] * (n + 1)
        for last, (size, piece) in self.matcher.iter(text):
            longest[last - size + 1] = piece  # a later match of the same start is longer
        failed = bytearray((n >> 3) + 1)
        length, shorter, pairs, compatible = self.length, self.shorter, self._pairs, self.compatible
        out: list[int] = []
        at, piece = 0, longest[0]
        while at < n:
            left = out[-1] if out else -1
            while True:
                to = at + length[piece]
                if not failed[to >> 3] >> (to & 7) & 1:
                    fits = left < 0 or pairs.get(left << 32 | piece)
                    if fits is None:
                        fits = compatible(left, piece)
                    if fits:
                        out.append(piece)
                        at, piece = to, longest[to]
                        break
                piece = shorter[piece]
                if piece < 0:
                    failed[at >> 3] |= 1 << (at & 7)
                    piece = out.pop()
                    at -= length[piece]
                    break
        return out

    def unit(self, text: str) -> list[int]:
        """A unit: a space mark in front or none, no other; any characters."""
        if self.known.issuperset(text):
            return self.segment(text)
        out: list[int] = []
        for k, part in enumerate(self.not_known.split(text)):
            if k % 2:
                out += [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            elif part:
                out += self.segment(part)
        return out

    def after_run(self, marks: int, unit: list[int]) -> list[int]:
        """``marks`` more space marks before a unit that begins with one."""
        if unit[0] == self.lone_mark:
            return self.run(marks + 1) + unit[1:]
        return self.run(marks) + unit

    def spans(self, text: str) -> Iterator[tuple[int, str]]:
        """(space marks, body): body is a word, a line end or, at the end of the text, nothing."""
        for m in _RUNS.finditer(MARK + text.replace(" ", MARK)):
            if m[0]:
                yield len(m[1]), m[2] or ""


def words_of(text: str) -> list[str]:
    """The text cut at spaces and before line ends.  A word has a space mark before it unless it begins with a line end;
    an empty word stands for one more space mark."""
    return text.replace(MARK, " ").replace("\n", " \n").split(" ")


class Remembered:
    """word -> value for words as ``words_of`` gives them, in two bounded generations."""

    def __init__(self, make) -> None:
        self.make, self.young, self.old = make, {}, {}

    def table(self, words: list[str]) -> dict:
        """A mapping that has all of ``words``."""
        if len(self.young) > REMEMBERED_UNITS:
            self.old, self.young = self.young, {}
        young, old, rest = self.young, self.old, None
        for w in set(words).difference(young):
            value = old.get(w)
            if value is None:
                value = self.make(w)
            if len(w) > LONG_UNIT:
                rest = {} if rest is None else rest
                rest[w] = value
            else:
                young[w] = value
        return young if rest is None else _Both(rest, young)


class _Both(dict):
    def __init__(self, own: dict, more: dict) -> None:
        super().__init__(own)
        self.more = more

    def __missing__(self, key):
        return self.more[key]


class Codec:
    """``encode`` gives packed little-endian unsigned 32-bit ids, ``decode`` reads them."""

    def __init__(self, model_path: str) -> None:
        self.pieces = Pieces(model_path)
        self._words = Remembered(self._word)
        self._shown = [r.decode() if len(r) != 1 or r[0] < 128 else None for r in self.pieces.raw]
        for i in self.pieces.byte_ids:
            self._shown[i] = None
        self._edges = tuple(np.array([i], "<u4").tobytes() for i in (self.pieces.begin, self.pieces.end))

    def _word(self, word: str) -> bytes:
        p = self.pieces
        if word[:1] == "\n":
            ids = [p.byte_ids[10], *(p.unit(word[1:]) if len(word) > 1 else ())]
        else:
            ids = p.unit(MARK + word)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str, edges: bool = True) -> bytes:
        if not text:
            out = b""
        else:
            words = words_of(text)
            if "" in words:
                out = self._with_runs(text.replace(MARK, " "))
            else:
                out = b"".join(map(self._words.table(words).__getitem__, words))
        return self._edges[0] + out + self._edges[1] if edges else out

    def _with_runs(self, text: str) -> bytes:
        p, ids = self.pieces, []
        for marks, body in p.spans(text):
            if body == "\n":
                ids += [*p.run(marks), p.byte_ids[10]]
            elif not body:
                ids += p.run(marks)
            elif marks:
                ids += p.after_run(marks - 1, p.unit(MARK + body)) if marks > 1 else p.unit(MARK + body)
            else:
                ids += p.unit(body)
        return np.array(ids, "<u4").tobytes()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        control = self.pieces.control
        if ids and (ids[0] in control or ids[-1] in control):
            ids = [i for i in ids if i not in control]
        try:
            text = "".join(map(self._shown.__getitem__, ids))
        except TypeError:  # byte pieces
            text = b"".join(map(self.pieces.raw.__getitem__, ids)).decode("utf-8", "starmart-each-byte")
        return text[1:] if ids and self.pieces.text[ids[0]][:1] == MARK else text


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    """One codec per Python worker and model."""
    return Codec(model_path)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (binary: packed little-endian unsigned 32-bit ids with begin and end),
    decoded (the text that these ids decode to).

    No shuffle: a row depends on its text only.  NULL text counts as empty (begin and end only); repeated rows and NULL
    ``doc_id`` pass through; other columns are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [both.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(both.decode, ids), pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
