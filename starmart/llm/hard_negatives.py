"""Hard negatives by segment summary filtering: bounds from segments' means and deviations, exact scores for what is left.

Vectors are integers, floor(256 x).  Each is cut into segments of ``WIDTH`` components, and for each segment its mean and
deviation (root of the sum of squares about the mean) are stored.  The part of an inner product that a segment
contributes is ``width * mean * mean``, plus or minus the product of the deviations at most.  The sums of these over the
segments bound the score from both sides.  Summaries of wider segments follow from those of their parts.  Bounds are taken
from the widest segments first, pairs that cannot reach a wanted score go, narrower segments refine the rest, and only what
passes the narrowest is scored, exactly, in integers.

Wanted scores are windows: an anchor's positives are the first ``positives`` of its label in the window of all scores; each
positive p opens the window from ``low`` percent of p to p, whose first ``negatives`` rows of other labels are its hard
negatives.  Both searches run in blocks: anchors and rows are dealt into cells of a grid of at most ``CELL`` by ``CELL`` rows
(within a label for the positives), each cell keeps its best few of each window, and these are merged.  A first round
over one of ``ROUND`` columns of cells raises the windows' lower ends for all others, so that what cells keep is small
however many there are.  The set of anchors is a stated part of all rows, so the work grows with anchors times rows; no
task or driver holds more than a cell.

Rows take no part if label, vector or ``vec_id`` is NULL or a component is NULL or not finite.  A shorter vector counts as
followed by zeros, an empty one scores 0 with all.  Repeated rows and rows that share a ``vec_id`` are rows of their own: an
anchor leaves out only itself.  Equal scores are ordered by ``vec_id``.  Components whose product by 256 leaves the range of a
long are cut to that range; scores beyond it too.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import attach, ship, shuffle_width, stored

WIDTH = 4
LEVELS = (8, 4, 1)  # how many narrow segments stand together at each level, widest first
CELL = 8192
ROUND = 16
BLOCK = 64  # anchors looked at together in a cell
DENSE = 0.1  # from this share of pairs on, a level is computed for all pairs of the block at once
LEAST, MOST = -(2**63), 2**63 - 1
SAFE = 2.0**53  # below it sums of products are exact in floating point


def prepare(vectors: DataFrame, every: int = 100) -> DataFrame:
    """row, id, label, q (integers), means, devs and anchor (is ``id`` divisible by ``every``) of the rows that take part."""
    ship(vectors.sparkSession)
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), label.alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("q"), (F.col("vec_id") % every == 0).alias("anchor"),
    )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("q")
            means, devs = summaries(_matrix(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(means), _lists(devs)], [*batch.schema.names, "means", "devs"])

    return stored(rows.mapInArrow(summarise, "row long, id long, label long, q array<bigint>, anchor boolean, "
                                             "means array<double>, devs array<double>"))


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows, followed by zeros up to the longest or ``width``."""
    lengths, flat = column.value_lengths().to_numpy(), column.flatten().to_numpy()
    out = np.zeros((len(lengths), max(width, lengths.max(initial=0))), flat.dtype if len(flat) else np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of ``WIDTH`` components; the last is filled up with zeros."""
    short = -q.shape[1] % WIDTH
    parts = np.pad(q, ((0, 0), (0, short))).reshape(len(q), -1, WIDTH).astype(np.float64)
    means = parts.mean(axis=2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))


def widened(means: np.ndarray, devs: np.ndarray, together: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments ``together`` times as wide, from those of their parts."""
    short = ((0, 0), (0, -means.shape[1] % together))
    m = np.pad(means, short).reshape(len(means), -1, together)
    d = np.pad(devs, short).reshape(m.shape)
    mean = m.mean(axis=2)
    return mean, np.sqrt((d**2).sum(axis=2) + WIDTH * ((m - mean[:, :, None]) ** 2).sum(axis=2))


class Block:
    """Rows of one side of a cell: ids, labels, exact vectors, and summaries at each level."""

    def __init__(self, table: pa.Table, width: int, segments: int):
        def column(name: str) -> pa.Array:
            return table.column(name).combine_chunks()

        self.row, self.id, self.label = (column(n).to_numpy() for n in ("row", "id", "label"))
        self.q = _matrix(column("q"), width)
        self.largest = float(np.abs(self.q.astype(np.float64)).max(initial=0))
        means, devs = (_matrix(column(n), segments).astype(np.float64) for n in ("means", "devs"))
        self.levels = []
        for together in LEVELS:
            m, d = widened(means, devs, together)
            self.levels.append((m * np.sqrt(WIDTH * together), d))
        self.norm = np.sqrt((self.q.astype(np.float64) ** 2).sum(axis=1))


def candidates(a: Block, x: Block, mine: slice, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the allowed pairs whose bounds reach into [low, high] of their anchor, in order of the anchors."""
    keep = allowed
    slack = 0.5 + 1e-9 * a.norm[mine][:, None] * x.norm
    rows = cols = None
    for (am, ad), (xm, xd) in zip(a.levels, x.levels):
        am, ad = am[mine], ad[mine]
        if rows is not None and len(rows) < DENSE * keep.size:
            middle = np.einsum("ij,ij->i", am[rows], xm[cols])
            spread = np.einsum("ij,ij->i", ad[rows], xd[cols]) + slack[rows, cols]
            able = (middle + spread >= low[rows]) & (middle - spread <= high[rows])
            rows, cols = rows[able], cols[able]
            continue
        middle, spread = am @ xm.T, ad @ xd.T + slack
        keep = keep & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
        rows, cols = np.nonzero(keep)
    return rows, cols


def exact(a: Block, x: Block, mine: slice, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs."""
    q = a.q[mine]
    if a.largest * x.largest * max(1, q.shape[1]) >= SAFE:
        sums = (sum(int(u) * int(v) for u, v in zip(q[i], x.q[j])) for i, j in zip(rows, cols))
        return np.array([min(max(s, LEAST), MOST) for s in sums], np.int64)
    if len(rows) >= DENSE * len(q) * len(x.q):
        return (q.astype(np.float64) @ x.q.T.astype(np.float64))[rows, cols].astype(np.int64)
    return np.einsum("ij,ij->i", q[rows], x.q[cols])


def best_of_cell(anchors: pa.Table, others: pa.Table, same_label: bool, first: int) -> pa.Table:
    """The ``first`` rows of each window of each anchor: anchor, window, id, score."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    if anchors.num_rows and others.num_rows:
        widths = [max((t.column(c).combine_chunks().value_lengths().to_numpy().max(initial=0) for t in (anchors, others)))
                  for c in ("q", "means")]
        a, x = Block(anchors, *widths), Block(others, *widths)
        windows = anchors.column("windows").to_pylist()
        low = np.array([min(w["low"] for w in ws) for ws in windows], np.float64)
        high = np.array([max(w["high"] for w in ws) for ws in windows], np.float64)
        for start in range(0, len(a.id), BLOCK):
            mine = slice(start, min(start + BLOCK, len(a.id)))
            alike = a.label[mine][:, None] == x.label
            allowed = alike & (a.row[mine][:, None] != x.row) if same_label else ~alike
            rows, cols = candidates(a, x, mine, allowed, low[mine], high[mine])
            score = exact(a, x, mine, rows, cols)
            ends = np.searchsorted(rows, np.arange(mine.stop - start + 1))
            for k in range(mine.stop - start):
                own_cols, own = cols[ends[k]:ends[k + 1]], score[ends[k]:ends[k + 1]]
                for w in windows[start + k]:
                    inside = np.flatnonzero((own >= w["low"]) & (own <= w["high"]))
                    if len(inside) > first:
                        at_least = np.partition(own[inside], -first)[-first]
                        inside = inside[own[inside] >= at_least]
                    ids = x.id[own_cols[inside]]
                    inside = inside[np.lexsort((ids, -own[inside]))[:first]]
                    for to, what in zip(out, (np.full(len(inside), a.row[start + k]), np.full(len(inside), w["window"]),
                                              x.id[own_cols[inside]], own[inside])):
                        to.append(what)
    columns = [pa.array(np.concatenate(c) if c else np.empty(0), pa.int64()) for c in out]
    return pa.Table.from_arrays(columns, ["anchor", "window", "id", "score"])


def _search(anchors: DataFrame, rows: DataFrame, windows: DataFrame, group: str | None, first: int) -> DataFrame:
    """The ``first`` rows of every window (anchor, window, low, high): anchor, window, id, score, place.

    With a ``group`` anchors meet the rows of their group only (the same label), else rows of other labels.
    """
    spark, total = rows.sparkSession, rows.count()
    width = max(256, min(CELL, total // (2 * shuffle_width(spark))))
    key = F.col(group) if group else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("g", key), anchors.withColumn("g", key)
    sizes = stored(anchors.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("bands")).join(
        rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / width).alias("columns")), "g"))
    rows = attach(rows, sizes, "g", "n", total).select(
        "g", "row", "id", "label", "q", "means", "devs", "bands", F.pmod(F.xxhash64("row"), "columns").alias("column")
    )
    anchors = attach(anchors, sizes, "g", "n", total).withColumn("band", F.pmod(F.xxhash64("row", F.lit(1)), "bands"))
    merged = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    best = None
    for turn in (True, False):  # the columns 0, ROUND, 2 ROUND, ..., then all others
        def chosen(column: str) -> Column:
            return (F.col(column) % ROUND == 0) if turn else (F.col(column) % ROUND != 0)

        if best is not None:
            full = best.where(F.col("place") == first).select("anchor", "window", F.col("score").alias("reached"))
            windows = windows.join(full, ["anchor", "window"], "left").select(
                "anchor", "window", F.greatest("low", F.coalesce("reached", "low")).alias("low"), "high")
        of_anchor = windows.groupBy(F.col("anchor").alias("row")).agg(
            F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("windows"))  # one entry a positive
        left = anchors.join(of_anchor, "row").withColumn(
            "column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1))
        ).where(chosen("column")).select("g", "band", "column", "row", "id", "label", "q", "means", "devs", "windows")
        right = rows.where(chosen("column")).withColumn(
            "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))
        ).select("g", "band", "column", *[F.col(c).alias(c) for c in ("row", "id", "label", "q", "means", "devs")])
        cell = ["g", "band", "column"]
        found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
            lambda a, x: best_of_cell(a, x, bool(group), first), "anchor long, window long, id long, score long")
        found = found if best is None else found.unionByName(best.drop("place"))
        best = stored(found.withColumn("place", F.row_number().over(merged)).where(F.col("place") <= first))
    return best


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = prepare(vectors, every)
    anchors = rows.where("anchor")
    all_scores = anchors.select(F.col("row").alias("anchor"), F.lit(0).cast("long").alias("window"),
                                F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"))
    best = _search(anchors, rows, all_scores, "label", positives)
    # below 0 the window is empty; the least whole number of hundredths not under low * score
    windows = best.where("score >= 0").select(
        "anchor", F.col("place").cast("long").alias("window"),
        F.expr(f"(score div 100) * {low} + ((score % 100) * {low} + 99) div 100").alias("low"), F.col("score").alias("high"))
    hard = _search(anchors, rows, stored(windows), None, negatives)
    pairs = best.select(F.col("anchor"), F.col("place").cast("long").alias("window"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return hard.join(pairs, ["anchor", "window"]).join(
        anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"
    ).select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
             F.col("score").alias("negative_score"))
