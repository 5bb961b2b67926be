"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes of the UTF-8 text ends a chunk wherever it is one less than a multiple of the block size,
so a chunk depends on its own bytes only and an edit changes the chunks it touches.  The block size is the least of
3, 6, 12, ... at which a text has 64 chunks at most.  A chunk becomes one of 64 characters by its CRC-32.  A fingerprint is
``size:signature:signature at twice the size``; no chunk is left out, and equal texts have equal fingerprints.

Two fingerprints are compared at a block size that both have, so at sizes apart by no more than a factor of two; otherwise
their likeness is 0.  Signatures without a common run of ``COMMON_RUN`` characters (half the shorter one where that is
shorter) have likeness 0 too, which keeps chance agreement out.  Else it is one less the edit distance over the summed
lengths, where an insertion or deletion costs one and a replacement two.

``compare_with_next`` needs every document beside the next one by ``doc_id``.  Ids are cut into ranges at ids that occur,
the rows of a range are sorted by Spark and read as a stream, and the row at each cut is sent to the range before as
well (the first of all to the last).  So the texts are shuffled once and a task holds two of them.

Defined results: NULL text counts as empty; the fingerprint of the empty text is ``3::``, and equal fingerprints have
likeness 1; a NULL ``doc_id`` comes before all others; rows with one ``doc_id`` follow each other by text; a single row is
its own next; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import shuffle_width, text_of

SMALLEST, CHUNKS, WINDOW, COMMON_RUN = 3, 64, 7, 7
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
RANGE_BYTES, MOST_RANGES = 64 << 20, 10_000
BLOCK = 1 << 20
_REPEATS = re.compile(r"(.)\1{3,}")


def _boundaries(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of chunks at the smallest block size, and how often each one's size may double."""
    ends, levels = [], []
    data = np.frombuffer(raw, "uint8")
    for low in range(0, len(data), BLOCK):  # bounded memory for long texts
        before = min(low, WINDOW - 1)
        x = np.zeros(min(BLOCK, len(data) - low) + WINDOW - 1, "uint32")
        part = data[low - before: low + BLOCK]
        x[WINDOW - 1 - before: WINDOW - 1 - before + len(part)] = part
        n = len(x) - WINDOW + 1
        added = x[WINDOW - 1:] * np.uint32(WINDOW + 1)
        mixed = x[WINDOW - 1:].copy()
        for k in range(1, WINDOW):
            own = x[WINDOW - 1 - k: WINDOW - 1 - k + n]
            added += own * np.uint32(WINDOW + 1 - k)
            mixed ^= own << np.uint32(5 * k)
        added += mixed
        added += np.uint32(1)
        at = np.flatnonzero(added % np.uint32(SMALLEST) == 0)
        value = added[at].astype("int64")
        value[value == 0] = 1 << 32
        ends.append(at + low + 1)
        levels.append(np.log2(value & -value).astype("int64"))
    return (np.concatenate(ends), np.concatenate(levels)) if ends else (np.zeros(0, "int64"),) * 2


def _signature(raw: bytes, ends: np.ndarray) -> str:
    cuts = [0, *ends.tolist()]
    if cuts[-1] < len(raw):
        cuts.append(len(raw))
    crc = zlib.crc32
    return "".join([LETTERS[crc(raw[a:b]) & 63] for a, b in zip(cuts, cuts[1:], strict=False)])


def fingerprint(text: str) -> str:
    raw = text.encode("utf-8", "surrogatepass")
    ends, levels = _boundaries(raw)
    level = 0
    if len(ends) >= CHUNKS:
        left = np.cumsum(np.bincount(levels)[::-1])[::-1]  # boundaries that stay at each doubling
        fits = np.flatnonzero(left < CHUNKS)
        level = int(fits[0]) if len(fits) else len(left)
    first = _signature(raw, ends[levels >= level])
    second = _signature(raw, ends[levels > level])
    return f"{SMALLEST << level}:{first}:{second}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of ``a``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = state = (1 << len(a)) - 1
    for c in b:
        hit = state & masks.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def signature_likeness(a: str, b: str) -> float:
    a, b = _REPEATS.sub(r"\1\1\1", a), _REPEATS.sub(r"\1\1\1", b)
    if a == b:
        return 1.0
    run = min(COMMON_RUN, -(-min(len(a), len(b)) // 2))
    if not run:
        return 0.0
    parts = {a[i:i + run] for i in range(len(a) - run + 1)}
    if parts.isdisjoint(b[i:i + run] for i in range(len(b) - run + 1)):
        return 0.0
    distance = len(a) + len(b) - 2 * _common(a, b)
    return 1 - distance / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = (x.split(":") for x in (a, b))
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(signature_likeness(a1, b1), signature_likeness(a2, b2))
    if size_a == 2 * size_b:
        return signature_likeness(a1, b2)
    if size_b == 2 * size_a:
        return signature_likeness(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much from the start of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), own], ["doc_id", "fingerprint"])

    return _rows(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (range, follower, doc_id, text), sorted; follower rows close a range and stand for the row after it."""
    spark, rows = docs.sparkSession, _rows(docs)
    size, nulls, least = rows.select(
        F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)), F.count_if(F.col("doc_id").isNull()), F.min("doc_id")
    ).first()
    ranges = min(MOST_RANGES, max(shuffle_width(spark), -(-size // RANGE_BYTES)))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.select(F.percentile_approx("doc_id", shares, 10 * MOST_RANGES)).first()[0] if shares else []
    cuts = np.array(sorted({least, *(found or [])} - {None}), "int64")
    last, wraps_at_null = max(len(cuts) - 1, 0), bool(nulls)

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        """Twice the range, and one more for a row that begins its range (and must be known in the one before)."""
        empty = ids.isna().to_numpy()
        own = ids.fillna(0).astype("int64").to_numpy()
        at = np.searchsorted(cuts, own, "right") - 1
        begins = (cuts[np.maximum(at, 0)] == own) if len(cuts) else np.zeros(len(own), bool)
        if wraps_at_null:
            begins = begins & (at > 0)
        at[empty], begins[empty] = 0, True
        return pd.Series(at * 2 + begins)

    own, begins = (F.col("_place") / 2).cast("int"), F.col("_place") % 2 == 1
    before = F.when(own == 0, F.lit(last)).otherwise(own - 1)
    targets = F.when(begins, F.array(F.struct(own.alias("r"), F.lit(0).alias("f")), F.struct(before.alias("r"), F.lit(1).alias("f")))
                     ).otherwise(F.array(F.struct(own.alias("r"), F.lit(0).alias("f"))))
    dealt = rows.withColumn("_place", place("doc_id")).select(F.explode(targets).alias("t"), "doc_id", "text")
    return dealt.select(F.col("t.r").alias("range"), F.col("t.f").alias("follower"), "doc_id", "text").repartition(
        max(ranges, 1), "range"
    ).sortWithinPartitions("range", "follower", F.col("doc_id").asc_nulls_first(), "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited (its last quarter taken from the next document), fingerprint,
    edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            for at, follows, doc, text in zip(
                *(batch.column(c).to_pylist() for c in ("range", "follower", "doc_id")),
                (x.as_py() for x in batch.column("text")), strict=True,
            ):
                if follows and (open_row is None or open_row[0] != at):
                    continue  # further rows with the id of the cut
                print_ = fingerprint(text)
                if open_row is not None:
                    where, known, old, own = open_row
                    if where != at:
                        raise RuntimeError("a range ended without its follower")
                    new = edited(old, text)
                    changed = fingerprint(new)
                    out.append((known, len(old), new, own, changed, likeness(own, changed), likeness(own, print_)))
                open_row = None if follows else (at, doc, text, print_)
            for low in range(0, len(out), 500):
                columns = zip(*out[low:low + 500], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return _in_order(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def digests(compared: DataFrame) -> DataFrame:
    return compared.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
