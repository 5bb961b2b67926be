"""Best-fit packing by bin completion over the histogram of lengths.

Which sequences are built depends only on how many pieces have which length, and there are at most ``capacity`` lengths.
So Spark tokenises the documents and counts the lengths, the search runs over that histogram of at most ``capacity``
numbers (whatever the corpus size), and Spark deals the pieces to the places of the plan by their rank among the pieces
of equal length.

The search is bin completion by branch and bound.  It takes the largest length left, enumerates the fillings that go
with it and are not dominated (a filling is dominated if a length left out could take the place of some of its pieces
and waste less) in order of waste, and applies a filling as often as the histogram allows.  Bitsets of the sums that shorter
lengths can reach lead the enumeration, so it meets fillings only, and none is left out.  A branch is cut when the waste so
far exceeds what a solution better than the incumbent may waste.  The incumbent is the best-fit-decreasing solution, of
the whole and of what is left at every node.  ``WORK`` (lengths looked at, summed over the nodes) bounds the search; the
incumbent is always a whole solution, so a search that ends early packs every piece too, in as few sequences as found.

Ranks are counted per (length, hash bucket) and shifted by the counts of the buckets before, so a length that a third of
all pieces share is spread over many tasks.

Defined results: a NULL text is the empty text, which is the end token alone; repeated rows are packed each; a NULL
``doc_id`` is an id like any other; an empty table gives no pieces; other columns are never read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import shuffle_width, stored, task_of, text_of

CAPACITY = 4096
END_ID = 1
WORK = 400_000
NODE_WORK = 32
BUCKET_PIECES = 50_000
REMEMBERED_WORDS = 200_000
TOGETHER = 100_000

Filling = tuple[tuple[int, int], ...]  # (length, how often), longest first
Plan = list[tuple[Filling, int]]  # a filling and how many sequences have it


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing: each piece goes where the least room stays.  Equal sequences are handled together."""
    open_bins: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append([filling, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    put(capacity - each * length, ((length, each),), whole)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            room = rooms[at]
            group = open_bins[room][-1]
            each = min(room // length, left)
            n = min(group[1], left // each)
            left -= n * each
            group[1] -= n
            if not group[1]:
                open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            put(room - each * length, (*group[0], (length, each)), n)
    return [(filling, n) for groups in open_bins.values() for filling, n in groups]


def _dominated(chosen: list[tuple[int, int]], room: int, left: dict[int, int], order: list[int]) -> bool:
    """Could a length that is left out take the place of one or two chosen pieces (or of free room) and waste less?"""
    if not order:
        return False
    used = dict(chosen)
    sums = {0}
    flat = [n for n, c in chosen for _ in range(min(c, 2))]
    sums.update(flat)
    sums.update(a + b for i, a in enumerate(flat) for b in flat[i + 1:])
    for total in sums:
        low, high = bisect_left(order, total + 1), bisect_left(order, total + room + 1)
        if any(left[n] > used.get(n, 0) for n in order[low:high]):
            return True
    return False


def reachable(order: list[int], left: dict[int, int], room: int) -> list[int]:
    """Bitsets: bit ``s`` of the ``k``-th is set if pieces of the first ``k`` lengths of ``order`` can add up to ``s``."""
    sums, mask = [1], (2 << room) - 1
    for length in order:
        now, more, step = sums[-1], min(left[length], room // length), 1
        while more:
            step = min(step, more)
            now |= now << (step * length)
            more, step = more - step, 2 * step
        sums.append(now & mask)
    return sums


def fillings(largest: int, left: dict[int, int], capacity: int, waste: int, budget: list[int]) -> Iterator[Filling]:
    """The undominated fillings around one piece of ``largest`` that waste at most ``waste``, least waste first, each when
    it is asked for.  What can be reached with the shorter lengths is known, so no step leads nowhere.  Every length looked
    at is taken off ``budget``; no more comes once it is used up."""
    room = capacity - largest
    order = sorted(n for n, c in left.items() if c > 0 and n <= room)
    sums = reachable(order, left, room)
    budget[0] -= len(order)

    def adding_up(top: int, rest: int, chosen: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        if not rest:
            yield chosen
            return
        for at in range(min(top, bisect_left(order, rest + 1)) - 1, -1, -1):
            budget[0] -= 1
            if budget[0] <= 0 or not sums[at + 1] >> rest & 1:
                return
            length = order[at]
            for often in range(min(left[length], rest // length), 0, -1):
                if sums[at] >> (rest - often * length) & 1:
                    yield from adding_up(at, rest - often * length, [*chosen, (length, often)])

    for wasted in range(min(waste, room) + 1):
        if sums[-1] >> (room - wasted) & 1:
            for chosen in adding_up(len(order), room - wasted, []):
                if not _dominated(chosen, wasted, left, order):
                    merged = dict(chosen)
                    merged[largest] = merged.get(largest, 0) + 1
                    yield tuple(sorted(merged.items(), reverse=True))
                if budget[0] <= 0:
                    return


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A bound no packing beats: all tokens, and pieces that cannot share a sequence with one another."""
    number = np.zeros(capacity + 1, "int64")
    for n, c in counts.items():
        number[n] = c
    upto, tokens = np.cumsum(number), np.cumsum(number * np.arange(capacity + 1))
    half = capacity // 2
    low = np.arange(half + 1)  # pieces below ``low`` are left out of the count
    big = upto[capacity] - upto[capacity - low]
    middle = upto[capacity - low] - upto[half]
    room = middle * capacity - (tokens[capacity - low] - tokens[half])
    small = tokens[half] - np.where(low > 0, tokens[low - 1], 0)
    more = np.maximum(0, -((room - small) // capacity))
    bound = max(-(-int(tokens[capacity]) // capacity), int((big + middle + more).max()))
    return bound


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, work: int = WORK) -> Plan:
    """Fillings and how often each is used; uses up ``counts`` exactly."""
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    size = sum(n for _, n in best)
    floor, total = least_sequences(counts, capacity), sum(n * c for n, c in counts.items())
    budget = [work]

    def search(left: dict[int, int], used: Plan, n_used: int, wasted: int) -> None:
        nonlocal best, size
        if size == floor or budget[0] <= 0:
            return
        budget[0] -= NODE_WORK + len(left)
        if not left:
            if n_used < size:
                best, size = list(used), n_used
            return
        rest = best_fit(left, capacity)
        if n_used + sum(n for _, n in rest) < size:
            best, size = [*used, *rest], n_used + sum(n for _, n in rest)
        allowed = (size - 1) * capacity - total - wasted
        if allowed < 0:
            return
        largest = max(left)
        without = dict(left)
        without[largest] -= 1
        for filling in fillings(largest, without, capacity, allowed, budget):
            each = min(left[n] // c for n, c in filling)
            loss = capacity - sum(n * c for n, c in filling)
            for times in dict.fromkeys((min(each, allowed // loss) if loss else each, 1)):
                if times < 1 or loss * times > (size - 1) * capacity - total - wasted:
                    continue
                after = {n: c for n, c in left.items()}
                for n, c in filling:
                    after[n] -= c * times
                    if not after[n]:
                        del after[n]
                search(after, [*used, (filling, times)], n_used + times, wasted + loss * times)
                if size == floor or budget[0] <= 0:
                    return

    import sys

    deep = sys.getrecursionlimit()
    sys.setrecursionlimit(max(deep, work // 10 + 1000))
    try:
        search(counts, [], 0, 0)
    finally:
        sys.setrecursionlimit(deep)
    return best


def plan_slots(plan: Plan) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their rank: slot ``i`` takes the ranks from ``low[i]`` on, ``each[i]`` of
    them to a sequence.  Sorted by (length, low)."""
    taken: dict[int, int] = {}
    rows, first = [], 0
    for filling, n in plan:
        offset = 0
        for length, each in filling:
            low = taken.get(length, 0)
            rows.append((length, low, each, first, offset))
            taken[length] = low + each * n
            offset += length * each
        first += n
    rows.sort()
    table = np.array(rows, "int64").reshape(-1, 5)
    return dict(zip(("length", "low", "each", "first", "offset"), table.T, strict=True))


# A full stop or comma between a letter or digit and white space is a piece of text of its own.  (Some letters beyond these
# end in a combining mark once normalised or small, and that would belong to the piece.)
_MARK = re.compile("([.,])(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ][.,])(?=[ \\n])")  # begins with what is rare


class WordTokenizer:
    """Ids of a text, packed as little-endian unsigned 32-bit integers.

    The vocabulary drops white space and nothing spans it or the border of a word and a mark behind it, so the library
    encodes each different word once; the remembered words are bounded, which changes nothing but time.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.parting = "<|startoftext|>"
        self.parting_id = self.library.token_to_id(self.parting)
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _cut(self, words: list[str], ids: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> None:
        packed = ids.tobytes()
        for w, low, high in zip(words, (4 * lows).tolist(), (4 * highs).tolist(), strict=True):
            self.young[w] = packed[low:high]

    def _learn(self, words: list[str]) -> None:
        """One call for many words: words of letters only are one unit each, whose last token says so; others are parted
        by a special token, which nothing spans."""
        letters, plain = [], []
        for w in words:
            if "<|" in w:
                self.young[w] = self._ids(w).tobytes()
            elif w.isalpha() and w.lower().isalpha() and is_normalized("NFC", w):
                letters.append(w)
            else:
                plain.append(w)
        for at in range(0, len(letters), 256):
            some = letters[at:at + 256]
            ids = self._ids(" ".join(some))
            highs = np.flatnonzero(self.ends_word[ids]) + 1
            if len(highs) == len(some) and highs[-1] == len(ids):
                self._cut(some, ids, np.concatenate([[0], highs[:-1]]), highs)
            else:  # the library takes a letter for something else
                plain += some
        for at in range(0, len(plain), 256):
            some = plain[at:at + 256]
            ids = self._ids(self.parting.join(some))
            marks = np.flatnonzero(ids == self.parting_id)
            self._cut(some, ids, np.concatenate([[0], marks + 1]), np.concatenate([marks, [len(ids)]]))

    def __call__(self, text: str) -> bytes:
        return self._together([text])[0]

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; the new words of texts of some ``TOGETHER`` characters go to the library at once."""
        low = held = 0
        for k, text in enumerate(texts):
            held += len(text)
            if held >= TOGETHER or k + 1 == len(texts):
                yield from self._together(texts[low:k + 1])
                low, held = k + 1, 0

    def _together(self, texts: list[str]) -> list[bytes]:
        cut = [_MARK.sub(r" \1", text).replace("\n", " ").split(" ") for text in texts]
        if len(self.young) > REMEMBERED_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new, small = [], []
        for w in set().union(*cut).difference(young):
            if w in old:
                young[w] = old[w]
            elif w.isascii() and not w.islower():
                small.append(w)
            else:
                new.append(w)
        # the vocabulary has no capitals: in ASCII a word and its small form have the same ids
        forms = {w: w.lower() for w in small if "<|" not in w}
        new += [w for w in small if w not in forms]
        unknown = set(forms.values()).difference(young, new)
        for w in [*unknown]:
            if w in old:
                young[w] = old[w]
                unknown.remove(w)
        if new or unknown:
            self._learn([*new, *unknown])
        for w, form in forms.items():
            young[w] = young[form]
        return [b"".join(map(young.__getitem__, words)) for words in cut]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _forget() -> None:
    _tokenizer.cache_clear()


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """The pieces of every row: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (packed, binary)."""
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_of("packing", _forget)
        encode = _tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode.many(part.column("text").to_pylist()), strict=True):
                    ids += end
                    for piece, low in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[low:low + 4 * capacity]
                        rows.append((doc, piece, low // 4, len(own) // 4, zlib.crc32(own), own))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, schema)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (stored pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = spark.sparkContext.broadcast(plan_slots(plan_sequences(counts, capacity)))
    buckets = max(shuffle_width(spark), -(-sum(counts.values()) // BUCKET_PIECES))
    rows = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("_own", F.row_number().over(inside)).join(shifts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_own") - 1 + F.col("_before")).drop("_own", "_before", "_bucket")
    kept = cut.columns

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        keys = s["length"] << 40 | s["low"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            nth, inner = np.divmod(rank - s["low"][at], s["each"][at])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(s["first"][at] + nth),
                 pa.array(s["offset"][at] + inner * length)], [*kept, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.select(*kept, "_rank").mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and place all rows: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return place(stored(pieces(docs, tokenizer_path, capacity, keep_ids)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole training sequences from pieces that kept their ids: sequence_id, n_tokens, ids (packed), doc_ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))  # at most ``capacity`` pieces

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["ids"] = [b"".join(map(bytes, x)) for x in batch["ids"]]
            yield batch

    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.col("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
    ).mapInPandas(join, "sequence_id long, n_tokens long, ids binary, doc_ids array<long>")
