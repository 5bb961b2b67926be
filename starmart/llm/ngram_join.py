"""Jaccard join of documents on word n-grams by vertical partitioning.

A document's set is its distinct runs of ``N`` words (the whole sequence if it has fewer words), as hashes: 48 bits that
travel and are compared, beside the range of the other bits.  Two
documents link when 100 times the intersection is at least ``SIMILAR`` times the union.

1. *Frequencies.*  The n-grams of a chunk of documents travel by hash range, as packed arrays.  Where all of a range meet,
   each n-gram gets its document frequency, and those of two documents or more go back to their chunks.  An n-gram that
   many documents of a chunk have travels once, with its count, and its documents go straight to the chunk's own place.
2. *Who can link at all.*  A linked document shares at least 75 % of its n-grams with its partner, so a document with fewer
   n-grams of frequency two or more is alone.  This test is exact and leaves out most of a corpus.
3. *Classes.*  Documents with equal sets become one class; only classes go on.
4. *Candidates.*  The global order of n-grams is (frequency, hash), rare ones first.  Linked classes share one of the
   first ``n - ceil(0.75 n) + 1`` n-grams of each.  ``links`` turns these keys into components and never pairs a whole key.
5. *Fragments.*  The global order is cut into ``FRAGMENTS`` fragments.  A candidate pair's overlap is counted in each
   fragment by itself and summed per pair; the sum decides.

Every document, n-gram and key is counted; nothing is capped or sampled.

Defined results: NULL text and texts without words have an empty set (``n_shingles`` 0) and are linked with nothing;
repeated rows are one class; ``component_id`` is the smallest non-NULL ``doc_id`` of the component; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import attach, ship, shuffle_width, stored, task_of, text_of, unused
from starmart.llm.links import linked_components

N, SIMILAR = 5, 75
FRAGMENTS = 4
CHUNK_DOCS, CHUNK_NGRAMS = 2000, 500_000
FREQUENT = 32
RANGE_BYTES = 8 << 20
REMEMBERED_WORDS = 300_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.random.default_rng(20240229).integers(1, 1 << 62, N + 1, dtype="uint64") * np.uint64(2) + np.uint64(1)

# Kinds of packed rows.
SINGLE, COUNTED, LISTED, DOCS = 0, 1, 2, 3
_PACKED = "place int, kind int, chunk long, ngrams binary, docs binary, counts binary"
_PACKED_NAMES = ["place", "kind", "chunk", "ngrams", "docs", "counts"]


def _thin(hashes: np.ndarray) -> bytes:
    """The low 48 bits of each hash."""
    return np.ascontiguousarray(hashes, "<u8").view("u1").reshape(-1, 8)[:, :6].tobytes()


def _wide(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), "u1")
    out[:, :6] = np.frombuffer(packed, "u1").reshape(-1, 6)
    return out.view("<u8").ravel()


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


_WORDS = _Words()


def _forget() -> None:
    _WORDS.clear()


def ngrams(text: str) -> np.ndarray:
    """The sorted distinct hashes of a text."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, "uint64")
    own = np.fromiter(map(_WORDS.__getitem__, words), "uint64", len(words))
    size = min(N, len(words))
    n = len(words) - size + 1
    mixed = np.full(n, size, "uint64") * _ODD[N]
    for k in range(size):
        part = own[k:k + n] * _ODD[k]
        mixed += part ^ (part >> np.uint64(29))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _PACKED_NAMES)


def _chunk_rows(chunk: int, ids: list, sets: list[np.ndarray], ranges: int) -> Iterator[tuple]:
    """Packed rows of a chunk: each n-gram to the place of its hash range, lists and documents to the chunk's own."""
    home = int(chunk * 0x9E3779B1 % ranges)
    known = np.array([i is not None for i, _ in ids])
    marks = b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    packed_ids = np.array([0 if i is None else i for i, _ in ids], "<i8").tobytes() + known.tobytes()
    packed_ids += np.array([key for _, key in ids], "<i8").tobytes()
    yield home, DOCS, chunk, packed_ids, marks, np.array([len(s) for s in sets], "<u4").tobytes()
    every = np.concatenate(sets)
    docs = np.repeat(np.arange(len(sets), dtype="<u2"), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, docs = every[order], docs[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, "int64")
    sizes = np.diff(np.append(starts, len(every)))
    often = np.repeat(sizes > FREQUENT, sizes)
    if often.any():
        yield home, LISTED, chunk, _thin(every[often]), docs[often].tobytes(), None
    for kind, hashes, more in (
        (SINGLE, every[~often], docs[~often]),
        (COUNTED, every[starts[sizes > FREQUENT]], sizes[sizes > FREQUENT].astype("<u4")),
    ):
        place = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype("int64")
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[p], cuts[p + 1]
            part = more[a:b].tobytes()
            yield p, kind, chunk, _thin(hashes[a:b]), *((part, None) if kind == SINGLE else (None, part))


def _by_value(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[tuple]]]:
    """All rows of one value at a time, of rows that are sorted by it."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _PACKED_NAMES), strict=True):
            value = row[_PACKED_NAMES.index(column)]
            if value != now and held:
                yield now, held
                held = []
            now = value
            held.append(row)
    if held:
        yield now, held


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies within a hash range; rows for the chunks, with frequencies of two or more as counts."""
    for place, rows in _by_value(batches, "place"):
        arrays = [_wide(r[3]) if r[1] in (SINGLE, COUNTED) else None for r in rows]
        own = [i for i, a in enumerate(arrays) if a is not None]
        if own:
            every = np.concatenate([arrays[i] for i in own])
            weight = np.concatenate([
                np.frombuffer(rows[i][5], "<u4") if rows[i][1] == COUNTED else np.ones(len(arrays[i]), "u4")
                for i in own
            ])
            order = np.argsort(every, kind="stable")
            ranked = every[order]
            first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            total = np.minimum(np.add.reduceat(weight[order], np.flatnonzero(first), dtype="int64"), (1 << 32) - 1)
            frequency = np.empty(len(every), "u4")
            frequency[order] = total[np.cumsum(first) - 1]
            del order, ranked, first
        at = 0
        for i, row in enumerate(rows):
            if arrays[i] is None:
                yield _pack([row])
                continue
            mine = frequency[at:at + len(arrays[i])]
            at += len(arrays[i])
            keep = mine > 1
            if keep.any():
                docs = np.frombuffer(row[4], "<u2")[keep].tobytes() if row[1] == SINGLE else None
                counts = mine[keep].astype("<u4").tobytes()
                yield _pack([(place, row[1], row[2], _thin(arrays[i][keep]), docs, counts)])


_SETS = "doc_id long, text_key long, n_shingles long, mark binary, shared binary, often binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Back to documents: the shared n-grams of those that can link, in the global order."""
    for _, rows in _by_value(batches, "chunk"):
        head = next(r for r in rows if r[1] == DOCS)
        sizes = np.frombuffer(head[5], "<u4")
        n = len(sizes)
        ids = np.frombuffer(head[3][: 8 * n], "<i8")
        known = np.frombuffer(head[3][8 * n:9 * n], bool)
        keys = np.frombuffer(head[3][9 * n:], "<i8")
        hashes, docs, often = [], [], []
        for kind in (SINGLE, LISTED):
            for r in rows:
                if r[1] == kind:
                    hashes.append(_wide(r[3]))
                    docs.append(np.frombuffer(r[4], "<u2"))
                    often.append(np.frombuffer(r[5], "<u4") if kind == SINGLE else None)
        counted = [(_wide(r[3]), np.frombuffer(r[5], "<u4")) for r in rows if r[1] == COUNTED]
        if counted:
            names, counts = (np.concatenate(x) for x in zip(*counted, strict=True))
            order = np.argsort(names)
            names, counts = names[order], counts[order]
            often = [counts[np.searchsorted(names, h)] if o is None else o for h, o in zip(hashes, often, strict=True)]
        h, d, o = (np.concatenate(x) if x else np.zeros(0, "int64") for x in (hashes, docs, often))
        order = np.lexsort((h, o, d))
        h, d, o = h[order], d[order], o[order]
        cuts = np.searchsorted(d, np.arange(n + 1))
        out = []
        for k in range(n):
            a, b = int(cuts[k]), int(cuts[k + 1])
            able = sizes[k] > 0 and 100 * (b - a) >= SIMILAR * int(sizes[k])
            out.append((
                int(ids[k]) if known[k] else None, int(keys[k]), int(sizes[k]), head[4][16 * k:16 * k + 16],
                _thin(h[a:b]) if able else None, o[a:b].astype("<u4").tobytes() if able else None,
            ))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for low in range(0, n, 500):
            columns = zip(*out[low:low + 500], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "text_key", "n_shingles", "mark", "shared", "often"],
            )


def text_key(docs: DataFrame) -> Column:
    """Tells texts of rows that share a ``doc_id`` apart."""
    return F.xxhash64(text_of(docs))


def shared_sets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, mark (128 bits of the set) and, where the document can link, its
    n-grams of frequency two or more (packed, in the global order) and their frequencies."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), text_key(docs).alias("text_key"))
    size = rows.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(shuffle_width(spark), -(-size // RANGE_BYTES))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_of("ngram_join", _forget)
        number, ids, sets, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            names = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), strict=True)
            for name, text in zip(names, batch.column("text"), strict=True):
                own = ngrams(text.as_py())
                if ids and (len(ids) >= CHUNK_DOCS or held + len(own) > CHUNK_NGRAMS):
                    yield _pack(list(_chunk_rows(number, ids, sets, ranges)))
                    number, ids, sets, held = number + 1, [], [], 0
                ids.append(name)
                sets.append(own)
                held += len(own)
        if ids:
            yield _pack(list(_chunk_rows(number, ids, sets, ranges)))

    dealt = rows.mapInArrow(chunks, _PACKED).repartition(ranges, "place").sortWithinPartitions("place")
    back = dealt.mapInArrow(_frequencies, _PACKED).repartition(ranges, "chunk").sortWithinPartitions("chunk")
    return back.mapInArrow(_sets, _SETS)


def _order_keys(shared: bytes, often: bytes) -> np.ndarray:
    """Where n-grams stand in the global order, as a number that never falls along it: the whole frequency and the upper
    31 bits of the hash.  N-grams with the same number are on the same side of every cut."""
    return np.frombuffer(often, "<u4").astype("int64") << 31 | (_wide(shared) >> np.uint64(17)).astype("int64")


def prefixes(classes: DataFrame) -> DataFrame:
    """(key, node, room, size): the n-grams of which linked classes have one in common, how many n-grams the class has from
    there on in the global order, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, rooms, sizes = ([np.zeros(0, "int64")] for _ in range(4))
            for node, n, shared in zip(*(batch.column(c).to_pylist() for c in ("node", "n_shingles", "shared")), strict=True):
                own = _wide(shared).astype("int64")
                first = n - -(-SIMILAR * n // 100) + 1 - (n - len(own))  # n-grams of one document stand before all others
                keys.append(own[: max(first, 0)])
                nodes.append(np.full(len(keys[-1]), node))
                rooms.append(np.arange(len(own), len(own) - len(keys[-1]), -1))
                sizes.append(np.full(len(keys[-1]), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (keys, nodes, rooms, sizes)], ["key", "node", "room", "size"]
            )

    return classes.select("node", "n_shingles", "shared").mapInArrow(run, "key long, node long, room long, size long")


def _possible(x: str, y: str) -> Column:
    """At the first n-gram that two linked sets have in common, both have as many left as the overlap must be."""
    room, size = F.least(f"{x}.room", f"{y}.room"), F.col(f"{x}.size") + F.col(f"{y}.size")
    return (room * (100 + SIMILAR) >= size * SIMILAR) & (
        F.least(f"{x}.size", f"{y}.size") * 100 >= F.greatest(f"{x}.size", f"{y}.size") * SIMILAR
    )


def fragment_cuts(classes: DataFrame) -> list[int]:
    """Where the global order is cut: quantiles over every class's own quantiles.  Any cut gives the same sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [np.zeros(0, "int64")]
            for shared, often in zip(batch.column("shared").to_pylist(), batch.column("often").to_pylist(), strict=True):
                keys = _order_keys(shared, often)
                marks.append(keys[np.linspace(0, len(keys) - 1, 2 * FRAGMENTS + 1).astype(int)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(marks))], ["k"])

    shares = [k / FRAGMENTS for k in range(1, FRAGMENTS)]
    marks = classes.select("shared", "often").mapInArrow(run, "k long")
    return sorted(set(marks.select(F.percentile_approx("k", shares)).first()[0] or []))


def segments(classes: DataFrame, cuts: list[int]) -> DataFrame:
    """(node, fragment, segment): a class's n-grams of each fragment, packed in hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, shared, often in zip(*(batch.column(c).to_pylist() for c in ("node", "shared", "often")), strict=True):
                own = _wide(shared)
                edges = [0, *np.searchsorted(_order_keys(shared, often), cuts, "right").tolist(), len(own)]
                out += [(node, f, _thin(np.sort(own[a:b]))) for f, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
            columns = list(zip(*out, strict=True)) or [()] * 3
            types = [pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["node", "fragment", "segment"]
            )

    return classes.select("node", "shared", "often").mapInArrow(run, "node long, fragment int, segment binary")


def _overlap(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([
        len(np.intersect1d(_wide(a), _wide(b), assume_unique=True))
        for a, b in zip(x, y, strict=True)
    ], dtype="int64")


def linked_pairs(pairs: DataFrame, sizes: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps fragment by fragment, summed per pair."""
    able = pairs.join(sizes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a")), "a").join(
        sizes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b")), "b"
    ).where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR)
    overlap = F.pandas_udf(_overlap, "long")
    mine = parts.select(F.col("node").alias("a"), "fragment", F.col("segment").alias("x"))
    other = parts.select(F.col("node").alias("b"), "fragment", F.col("segment").alias("y"))
    partial = able.join(mine, "a").join(other, ["b", "fragment"]).select("a", "b", "n_a", "n_b", overlap("x", "y").alias("o"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("o").alias("o"))
    return summed.where(F.col("o") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("o")) * SIMILAR).select("a", "b")


def link_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_size (rows with the same set), text_key, and
    first_key, the least ``text_key`` among the component's rows with its smallest ``doc_id``."""
    sets = stored(shared_sets(docs))
    able = sets.where("shared is not null")
    name = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))
    classes = stored(able.groupBy("mark").agg(
        F.min(name).alias("first"), F.count(F.lit(1)).alias("class_size"), F.any_value("n_shingles").alias("n_shingles"),
        F.any_value(F.struct("shared", "often")).alias("own"),
    ).select(F.monotonically_increasing_id().alias("node"), "mark", "first", "class_size", "n_shingles", "own.shared", "own.often"))
    sizes = classes.select("node", "n_shingles")
    parts = stored(segments(classes, fragment_cuts(classes)))
    keys = prefixes(classes).withColumn("lack", F.col("size") - F.col("room"))
    linked = linked_components(
        keys, lambda pairs: linked_pairs(pairs, sizes, parts), ("room", "size"), _possible, "lack"
    )
    placed = classes.select("node", "mark", "first", "class_size").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    groups = stored(placed.join(least, "component").select(
        "mark", "class_size", F.col("least.doc_id").alias("component_id"), F.col("least.text_key").alias("first_key")
    ))
    narrow = sets.select("doc_id", "text_key", "n_shingles", "mark", F.col("shared").isNotNull().alias("able"))
    together = attach(narrow.where("able"), groups, "mark", "class_size", narrow.count())
    alone = narrow.where("not able").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("class_size"),
        "text_key", F.col("text_key").alias("first_key"),
    )
    return together.select(alone.columns).unionByName(alone)


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of each component the one with the smallest ``doc_id``.

    Rows that share a ``doc_id`` are judged each by its own text; if several of one component share its smallest
    ``doc_id``, the text with the least key stays.  Rows equal in ``doc_id`` and text have one verdict.  A row without an id
    cannot be named as a copy and stays.
    """
    copies = link_documents(docs).where("doc_id <> component_id or text_key <> first_key")
    gone = copies.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct().alias(unused("gone", docs))
    names = [F.col(f"{unused('gone', docs)}.{c}") for c in ("id", "key")]
    return docs.join(gone, (docs["doc_id"].cast("long") == names[0]) & (text_key(docs) == names[1]), "left_anti")
