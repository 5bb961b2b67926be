"""Importance resampling towards a target distribution, with exact ranks by parallel sorting by regular sampling.

A text's features are its runs of 1 to ``longest`` consecutive words, hashed into ``buckets``.  Two arrays of bucket counts,
of the documents and of the target texts, give one gain a bucket (the logarithm of the smoothed ratio of shares, in
thousandths, floored); a document's weight is the sum of its features' gains.  Gumbel noise from a hash of ``doc_id`` added
to the weights makes the highest scores a weighted draw without replacement.

The draw is a global order, by parallel sorting by regular sampling:

1. every partition of scored rows is written as a locally sorted run;
2. each run gives equally spaced samples, ``SAMPLES`` of all runs together and one a run at least; the driver sorts them,
   weighted by the rows they stand for, and takes regular splitters;
3. rows go to the segment between two splitters, where they are merged in order;
4. prefix counts of the segments before make a row's place in its segment an exact rank.

Only segments that hold drawn ranks are exchanged.  What is gathered: one number a bucket from each side, the samples, one
count a segment.  Rows with equal keys are told apart by their place in the stored runs, so a key that many rows share
can be split.

A NULL text has no words: weight 0.  A NULL ``doc_id`` has no hash to draw with: its score and rank are NULL and it does
not count among the documents drawn from.  Rows that share a ``doc_id`` are documents of their own, with the same noise;
if they also share the score, which one comes first is not defined, and it makes no difference to the ids.  An empty table gives
an empty result, an empty target a target of no words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import ship, shuffle_width, stored, text_of

BUCKETS = 10_000
SAMPLES = 100_000
SEGMENT_ROWS = 500_000
POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition there

# Bytes that stand in words: digits, letters and all of code points above 127.  Capitals become small, the rest a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def features(text: str | None, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each feature."""
    words = words_of(text)
    runs = words if longest == 1 else [
        b" ".join(words[k:k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)
    ]
    return len(words), np.fromiter(map(crc32, runs), np.uint32, len(runs)) % buckets


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in the column ``text``.  Every task sums into one array first."""
    ship(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py(), longest, buckets)[1], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met, pa.int64()), pa.array(total[met])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = texts.select(text_of(texts).alias("text")).mapInArrow(count, "bucket long, n long")
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    size = len(corpus)
    all_corpus, all_target = float(corpus.sum() + size), float(target.sum() + size)
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * all_corpus / (float(s + 1) * all_target)))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise in thousandths, floored."""
    h = int(hashlib.sha256(b"%d:%d" % (seed, doc_id)).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    ship(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, found = features(text.as_py(), longest, len(gain))
                weight = int(gain[found].sum())
                rows.append((n, len(found), weight, None if doc_id is None else weight + noise(doc_id, seed)))
            n, m, w, s = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, m, w, s))],
                                  ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text")).mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long, score long")


def splitters(runs: DataFrame, segments: int) -> np.ndarray:
    """At most ``segments`` - 1 keys (-score, doc_id, at), in order, that cut the able rows into even segments."""
    sizes = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    many = sizes.count()
    if segments < 2 or not many:
        return np.empty((0, 3), np.int64)
    each = -(-SAMPLES // many)
    place = F.col("at") - F.col("first")
    step = (F.floor((place + 1) * each / F.col("n")) > F.floor(place * each / F.col("n"))) | (F.col("n") <= each)
    rows = runs.join(F.broadcast(sizes), "run").where(step).select(  # one row a run
        -F.col("score"), "doc_id", "at", F.col("n") / F.least(F.col("n"), F.lit(each))
    ).collect()  # SAMPLES, and one more a run at most
    keys, stand_for = np.array([r[:3] for r in rows], np.int64), np.array([r[3] for r in rows])
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    reached = np.cumsum(stand_for[order])
    cuts = np.searchsorted(reached, reached[-1] * np.arange(1, segments) / segments)
    return keys[order][np.unique(np.minimum(cuts, len(keys) - 1))]


def _segments(runs: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Add ``segment``, the number of splitters below the row's key; NULL for rows that cannot be drawn."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            able = np.flatnonzero(batch.column("able").to_numpy(zero_copy_only=False))
            keys = [np.concatenate([cuts[:, k], x]) for k, x in enumerate((
                -batch.column("score").to_numpy(zero_copy_only=False)[able].astype(np.int64),
                batch.column("doc_id").to_numpy(zero_copy_only=False)[able].astype(np.int64),
                batch.column("at").to_numpy(zero_copy_only=False)[able].astype(np.int64),
            ))]
            is_cut = np.arange(len(keys[0])) < len(cuts)
            order = np.lexsort((~is_cut, keys[2], keys[1], keys[0]))  # a splitter comes before the row it was
            below = np.empty(len(order), np.int64)
            below[order] = np.cumsum(is_cut[order])
            out = np.full(batch.num_rows, -1, np.int64)
            out[able] = below[len(cuts):]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, mask=out < 0)], [*batch.schema.names, "segment"])

    fields = ", ".join(f"{n} {t}" for n, t in runs.dtypes)
    return runs.mapInArrow(assign, f"{fields}, segment bigint")


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Add ``rank`` (1, 2, ...) to the highest ``percent`` of the rows with ``least_words``; NULL for all others."""
    ship(scored.sparkSession)
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    best_first = [F.desc("able"), F.desc("score"), F.asc("doc_id")]
    runs = stored(scored.withColumn("able", able).sortWithinPartitions(*best_first).withColumn(
        "at", F.monotonically_increasing_id()
    )).withColumn("run", F.shiftright("at", POSITION_BITS))
    of = runs.where("able")
    total = of.count()
    wanted = percent * total // 100
    if not wanted:
        return runs.select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    cuts = splitters(of, max(shuffle_width(scored.sparkSession), -(-total // SEGMENT_ROWS)))
    dealt = _segments(runs, cuts)
    counts = dict(dealt.where("able").groupBy("segment").count().collect())  # one row a segment
    first, before = 0, []
    for segment in sorted(counts):
        if first < wanted:
            before.append((segment, first))
        first += counts[segment]
    last = before[-1][0]
    merged = Window.partitionBy("segment").orderBy(F.desc("score"), "doc_id", "at")
    offsets = F.broadcast(scored.sparkSession.createDataFrame(before, "segment long, first long"))
    reached = dealt.where(F.col("segment") <= last).withColumn("place", F.row_number().over(merged)).join(offsets, "segment")
    rank = F.col("first") + F.col("place")
    return reached.select(*scored.columns, F.when(rank <= wanted, rank).alias("rank")).unionByName(
        dealt.where(F.col("segment").isNull() | (F.col("segment") > last)).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    )


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024,
             longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: ``percent`` of the documents drawn towards ``target``."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    return draw(scores(docs, gain, seed, longest), percent, least_words)
