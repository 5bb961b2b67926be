"""Exact deduplication with a cuckoo-filter index of live digests.

Texts are equal when they agree after every run of ASCII white space has become one space; NULL is the empty text.
The digest of a text is the SHA-256 of that form.  The index is cut into buckets by digest.  A bucket has

* a cuckoo filter of 16-bit fingerprints, four to a slot, which supports insertion and deletion, and
* the stored keys: every live digest with the smallest ``doc_id`` and the number of its rows.

An incoming digest that misses the filter is new, without a look at the keys.  A hit is verified against the keys of the
bucket, so a chance agreement of fingerprints never merges two texts.  When an insertion finds no place the filter is
rebuilt at twice its size from the stored keys, so nothing is ever lost.

Spark computes the digests, combines the rows of each Arrow batch by digest before anything is shuffled (a text that a
third of all rows share is one row per batch) and deals the rows to buckets of about ``BUCKET_KEYS`` digests; a task holds
one bucket at a time.  The result meets the documents again in a join that treats hot digests apart.

Defined results: NULL text equals empty text; of repeated rows with one ``doc_id`` and one text all are ``kept`` in
``dedup`` (they name the same document) and one stays in ``keep_first``; a NULL ``doc_id`` sorts after all others; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import ASCII_SPACE, attach, shuffle_width, stored, text_of

BUCKET_KEYS = 50_000
SLOT = 4
MAX_KICKS = 200
INDEX_SCHEMA = "bucket int, text_sha256 string, keep_id long, group_size long, first_rows long, stale boolean"


class CuckooFilter:
    """Partial-key cuckoo hashing: a fingerprint has two slots, each found from the other and the fingerprint."""

    def __init__(self, slots: int) -> None:
        self.slots = 1 << max(1, (slots - 1).bit_length())
        self.table = [[] for _ in range(self.slots)]
        self.size = 0

    def _places(self, digest: str) -> tuple[int, int, int]:
        value = int(digest[16:48], 16)
        mark = (value & 0xFFFF) or 1
        first = (value >> 16) & (self.slots - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995) & (self.slots - 1))

    def __contains__(self, digest: str) -> bool:
        mark, first, second = self._places(digest)
        return mark in self.table[first] or mark in self.table[second]

    def insert(self, digest: str) -> bool:
        """False when no place was found; the caller then rebuilds from its keys."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            if len(self.table[place]) < SLOT:
                self.table[place].append(mark)
                self.size += 1
                return True
        place = second
        for kick in range(MAX_KICKS):
            held = self.table[place]
            held[kick % SLOT], mark = mark, held[kick % SLOT]
            place = self._other(place, mark)
            if len(self.table[place]) < SLOT:
                self.table[place].append(mark)
                self.size += 1
                return True
        return False

    def delete(self, digest: str) -> bool:
        """Only for digests that were inserted."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            if mark in self.table[place]:
                self.table[place].remove(mark)
                self.size -= 1
                return True
        return False


class BucketIndex:
    """Filter and stored keys of one bucket."""

    def __init__(self, expected: int = 1024) -> None:
        self.keys: dict[str, list] = {}
        self.filter = CuckooFilter(max(2, expected // SLOT))
        self.resizes = 0
        self.false_hits = 0

    def insert(self, digest: str, doc_id: int | None, rows: int, first_rows: int) -> None:
        if digest in self.filter:
            found = self.keys.get(digest)
            if found is not None:
                found[1] += rows
                if found[0] is None or (doc_id is not None and doc_id < found[0]):
                    found[0], found[2] = doc_id, (first_rows if doc_id != found[0] else found[2] + first_rows)
                elif doc_id == found[0]:
                    found[2] += first_rows
                return
            self.false_hits += 1
        self.keys[digest] = [doc_id, rows, first_rows, False]
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: str, rows: int, doc_id: int | None = None, first_rows: int = 0) -> None:
        """Take ``rows`` rows of a live digest away, ``first_rows`` of them with the least id ``doc_id``.  The last one takes
        the digest out of filter and keys; a group that lives on without any row of its ``keep_id`` is stale."""
        if digest not in self.filter or (found := self.keys.get(digest)) is None:
            return
        found[1] -= rows
        if found[1] <= 0:
            del self.keys[digest]
            self.filter.delete(digest)
        elif doc_id == found[0]:
            found[2] -= first_rows
            found[3] = found[3] or found[2] <= 0

    def _resize(self) -> None:
        slots = self.filter.slots
        while True:
            slots *= 2
            self.resizes += 1
            bigger = CuckooFilter(slots)
            if all(bigger.insert(k) for k in self.keys):
                self.filter = bigger
                return

    def rows(self, bucket: int) -> pd.DataFrame:
        return pd.DataFrame({
            "bucket": np.full(len(self.keys), bucket, "int32"),
            "text_sha256": list(self.keys),
            "keep_id": pd.array([v[0] for v in self.keys.values()], "Int64"),
            "group_size": np.array([v[1] for v in self.keys.values()], "int64"),
            "first_rows": np.array([v[2] for v in self.keys.values()], "int64"),
            "stale": np.array([v[3] for v in self.keys.values()], bool),
        })


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256) of every row."""
    plain = F.regexp_replace(text_of(docs), ASCII_SPACE, " ")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.sha2(plain, 256).alias("text_sha256"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        each = pa.Table.from_batches([batch]).group_by(["text_sha256", "doc_id"]).aggregate([([], "count_all")])
        both = each.group_by("text_sha256").aggregate([("doc_id", "min"), ("count_all", "sum")])
        first = both.join(each, ["text_sha256", "doc_id_min"], ["text_sha256", "doc_id"], "left outer", use_threads=False)
        yield from pa.table({
            "text_sha256": first["text_sha256"],
            "keep_id": first["doc_id_min"],
            "group_size": first["count_all_sum"],
            "first_rows": pa.compute.coalesce(first["count_all"], first["count_all_sum"]),
            "step": pa.array(np.ones(len(first), "int32")),
        }).to_batches()


def _run_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket and step: 0 stored keys, 1 insertions, 2 deletions."""
    bucket, index = None, BucketIndex()
    for batch in batches:
        for value, part in batch.groupby("bucket", sort=False):
            if value != bucket:
                if bucket is not None:
                    yield index.rows(bucket)
                bucket, index = value, BucketIndex()
            ids = part["keep_id"].astype("Int64")
            for digest, doc, rows, first, step in zip(
                part["text_sha256"], ids, part["group_size"], part["first_rows"], part["step"], strict=True
            ):
                doc = None if doc is pd.NA else int(doc)
                if step == 2:
                    index.delete(digest, int(rows), doc, int(first))
                else:
                    index.insert(digest, doc, int(rows), int(first))
    if bucket is not None:
        yield index.rows(bucket)


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    number = F.conv(F.substring("text_sha256", 1, 8), 16, 10).cast("long")
    placed = rows.withColumn("bucket", (number % buckets).cast("int"))
    width = min(buckets, max(shuffle_width(rows.sparkSession), buckets // 8))
    return (
        placed.repartition(width, "bucket").sortWithinPartitions("bucket", "step")
        .mapInPandas(_run_buckets, INDEX_SCHEMA)
    )


def _buckets(spark, rows: int) -> int:
    return max(shuffle_width(spark), -(-rows // BUCKET_KEYS))


def build_index(digest_rows: DataFrame, rows: int) -> DataFrame:
    """The index of live digests: bucket, text_sha256, keep_id, group_size, first_rows (rows that carry ``keep_id``), stale."""
    combined = digest_rows.mapInArrow(
        _combine, "text_sha256 string, keep_id long, group_size long, first_rows long, step int"
    )
    return _in_buckets(combined, _buckets(digest_rows.sparkSession, rows))


def update_index(index: DataFrame, live: DataFrame, added: DataFrame | None, removed: DataFrame | None, rows: int) -> DataFrame:
    """``index`` after the rows of ``added`` came and those of ``removed`` went; ``live`` are all rows that are there then
    (all three as ``digests`` gives them).

    A group that lost all rows of its ``keep_id`` but lives on is looked up in ``live``; all others follow from the changes.
    """
    schema = "text_sha256 string, keep_id long, group_size long, first_rows long, step int"
    parts = index.select("text_sha256", "keep_id", "group_size", "first_rows", F.lit(0).alias("step"))
    for step, more in ((1, added), (2, removed)):
        if more is not None:
            parts = parts.unionByName(more.mapInArrow(_combine, schema).withColumn("step", F.lit(step)))
    after = stored(_in_buckets(parts, _buckets(index.sparkSession, rows)))
    stale = after.where("stale")
    by_id = live.join(stale.select("text_sha256"), "text_sha256", "left_semi").groupBy("text_sha256", "doc_id").agg(
        F.count(F.lit(1)).alias("n"))
    firsts = by_id.groupBy("text_sha256").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n")).alias("first"))
    mended = stale.drop("keep_id", "first_rows").join(firsts, "text_sha256").select(
        "bucket", "text_sha256", F.col("first.doc_id").alias("keep_id"), "group_size", F.col("first.n").alias("first_rows"),
        F.lit(False).alias("stale"))
    return after.where("not stale").unionByName(mended)


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, first_rows."""
    seen = stored(digests(docs))
    total = seen.count()
    groups = stored(build_index(seen, total).drop("bucket"))
    return attach(seen, groups, "text_sha256", "group_size", total).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "first_rows",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of equal texts the one with the smallest ``doc_id``.

    Columns may have any name: the row travels as one struct.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(
        whole.alias("row"), F.sha2(F.regexp_replace(text_of(docs), ASCII_SPACE, " "), 256).alias("digest"),
        docs["doc_id"].cast("long").alias("id"),
    )
    verdict = stored(dedup(docs))
    same = F.col("digest").eqNullSafe(F.col("its_digest")) & F.col("id").eqNullSafe(F.col("its_id"))

    def keys(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("text_sha256").alias("its_digest"), F.col("doc_id").alias("its_id")).distinct()

    gone, repeated = keys(verdict.where("not kept")), keys(verdict.where("kept and first_rows > 1"))
    single = named.join(gone.unionByName(repeated), same, "left_anti")
    nth = F.row_number().over(Window.partitionBy("digest", "id").orderBy(F.lit(1)))
    first = named.join(repeated, same, "left_semi").withColumn("nth", nth).where("nth = 1").drop("nth")
    return single.unionByName(first).select("row.*")
