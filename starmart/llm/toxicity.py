"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of three hashed ones: of the whole word, of its first and of its last four characters, so
that an inflected form of a known word is not unknown.  Filters one, two and three words wide slide over the whole text,
each keeps its largest response (max pooling), and a logistic unit weighs these.  A feature that fewer than
``LEAST_DOCS`` training texts have stays at zero, so single texts are not learned by heart.

All labelled rows whose CRC-32 of the id, modulo 4, is not 2 are learned from, each with its whole text.  Spark deals them to
shards by hash, of ``SHARD_ROWS`` rows or ``SHARD_CHARS`` characters on average, and counts the features.  The first shard alone
gives the model to start from, by ``EPOCHS`` passes; then every shard takes that model through one pass over its own rows, and
the model becomes the mean of what they return: of an embedding over the shards that changed it, of all else over all.  One
shard needs the first step only.  Nothing but the model reaches the driver, ``BUCKETS`` embeddings at most.  Sums are of whole
numbers, so the result does not depend on their order.

A share of the rows calibrates instead: each language gets the threshold with the best F1 over all of them, on a grid of
``1 / GRID`` of a logit, and a score is the logistic of the distance to the threshold, shifted so that the threshold has score 0.3.
The language is read off the text by its function words (the column ``lang`` is never used); a language with fewer than
``LEAST_TOXIC`` toxic calibration rows, or whose best threshold would call all its rows toxic, takes the common threshold.  Only
the text enters a score.  Scoring covers every whole text, one scan and no shuffle.

Defined results: NULL text counts as empty and gets the score of a text without known words; a NULL ``doc_id`` is not held
out; several labels of a document make it toxic if one does; NULL labels are ignored; without both classes every score is
a constant below 0.3, and labels that the texts do not tell apart reject nothing; an empty table gives an empty result; other columns are never read by the score.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import MOST_MARKS, maybe_among, release, stored, task_of, text_of

SHARD_ROWS, SHARD_CHARS = 4000, 16_000_000  # on average
HELD_OUT = 2
PASS_MARK = 0.3
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 18, 16, 16, (1, 2, 3)
LEAST_DOCS, LEAST_TOXIC, LEAST_RANKING = 3, 15, 0.6
EPOCHS, RATE, DECAY, CALIBRATION_SHARE = 6, 0.1, 1e-5, 0.2
GRID, MOST_LOGIT, BLOCK = 1000, 30.0, 50_000
UNIT, MOST_WEIGHT = float(1 << 20), float(1 << 21)  # weights are summed as whole numbers of 1 / UNIT
REMEMBERED_WORDS, COUNTED_WORDS = 200_000, 50_000
RETURNED = 10_000  # rows of weights in one batch
_WORD = re.compile(r"[^\W_]+")

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for with was are this",
    "de": "der die und das ist den von zu ein mit dem nicht",
    "fr": "le les des et une est du que pour dans un par",
    "es": "el los las y del una por con para se su en",
}
_LANGUAGE_OF = {w: k for k, words in FUNCTION_WORDS.items() for w in words.split()}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def language_of(words: list[str]) -> str:
    """The language most function words speak for; ties go to the first name, none to ``other``."""
    votes = dict.fromkeys(FUNCTION_WORDS, 0)
    for w in filter(None, map(_LANGUAGE_OF.get, words)):
        votes[w] += 1
    best = max(sorted(votes), key=votes.get)
    return best if votes[best] else "other"


def buckets_of(word: str) -> tuple[int, int, int]:
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in (word, "<" + word[:4], word[-4:] + ">"))


@dataclass
class Classifier:
    """Weights, thresholds by language, and the words this worker has met."""

    row: np.ndarray  # bucket -> row of ``embedding``; row 0 is the zero vector
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, SIZE, FILTERS)
    shift: np.ndarray
    weight: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def __post_init__(self) -> None:
        self._known: dict[str, int] = {}
        self._rows = np.zeros((1024, 3), "int32")

    def forget(self) -> None:
        self.__post_init__()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_known", "_rows")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def rows(self, words: list[str]) -> np.ndarray:
        """(words, 3) rows of ``embedding``."""
        if len(self._known) > REMEMBERED_WORDS:
            self._known.clear()
        known = self._known
        for w in set(words).difference(known):
            at = known[w] = len(known)
            if at >= len(self._rows):
                self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
            self._rows[at] = self.row[list(buckets_of(w))]
        return self._rows[np.fromiter(map(known.__getitem__, words), "int64", len(words))]

    def responses(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter before the rectifier, and where."""
        n = max(len(rows), max(WIDTHS))
        x = np.zeros((n, SIZE), "float32")
        x[: len(rows)] = self.embedding[rows].sum(1) if len(rows) else 0
        best, at = [], []
        for width, f in zip(WIDTHS, self.filters, strict=True):
            z = x[: n - width + 1] @ f[0]
            for k in range(1, width):
                z += x[k: n - width + 1 + k] @ f[k]
            where = z.argmax(0)
            at.append(where)
            best.append(z[where, np.arange(FILTERS)])
        return np.concatenate(best) + self.shift, np.concatenate(at)

    def peaks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``responses``, a very long text in overlapping blocks: the maximum is the same."""
        top, at = self.responses(rows[: BLOCK + max(WIDTHS) - 1])
        for low in range(BLOCK, len(rows) - max(WIDTHS) + 1, BLOCK):
            own, where = self.responses(rows[low: low + BLOCK + max(WIDTHS) - 1])
            at = np.where(own > top, where + low, at)
            top = np.maximum(top, own)
        return top, at

    def logit(self, words: list[str]) -> float:
        top, _ = self.peaks(self.rows(words))
        return float(np.maximum(top, 0) @ self.weight + self.bias)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        words = words_of(text)
        away = self.logit(words) - self.thresholds.get(language_of(words), self.thresholds[""])
        return float(1 / (1 + np.exp(-np.clip(away + np.log(PASS_MARK / (1 - PASS_MARK)), -30, 30))))


def _best_cut(z: np.ndarray, n: np.ndarray, hits: np.ndarray, common: float | None = None) -> float:
    """Of ``n`` rows with ``hits`` toxic ones at each logit ``z``, falling: the middle of the gap at which F1 is best.  Where
    the best cut would only call every row toxic: ``common`` if there is one, else the best cut that leaves a row, or above all
    rows if the logits do not rank the classes."""
    above, all_of = np.cumsum(hits), hits.sum()
    f1 = 2 * above / (np.cumsum(n) + all_of)
    k = int(f1.argmax())
    if k + 1 == len(z):
        if common is not None:
            return common
        clean = n - hits  # the share of pairs of a toxic and another row with the toxic one above; ties count half
        below = clean.sum() - np.cumsum(clean)
        if (hits * (below + clean / 2)).sum() < LEAST_RANKING * max(1, clean.sum() * all_of):
            return float(z[0] + 1)
        k = int(f1[:-1].argmax())
    return float((z[k] + z[k + 1]) / 2)


def _best_threshold(logits: np.ndarray, toxic: np.ndarray, common: float | None = None) -> float:
    z, which = np.unique(-logits, return_inverse=True)
    return _best_cut(-z, np.bincount(which).astype("float64"), np.bincount(which, toxic), common)


def _set_thresholds(m: Classifier, judged: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
    """``judged``: by language, and of all rows under the empty name, what ``_best_cut`` takes."""
    m.thresholds = {"": _best_cut(*judged[""])}
    for name in sorted(FUNCTION_WORDS):
        z, n, hits = judged.get(name, (np.zeros(0),) * 3)
        if hits.sum() >= LEAST_TOXIC and hits.sum() < n.sum():
            m.thresholds[name] = _best_cut(z, n, hits, m.thresholds[""])


def _cells(z: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal logits together, falling."""
    own, which = np.unique(-z, return_inverse=True)
    return -own, np.bincount(which, n), np.bincount(which, n * toxic)


def untrained(kept: np.ndarray) -> Classifier:
    """Random weights, with an embedding for each of the buckets ``kept``."""
    rng = np.random.default_rng(7)
    row = np.zeros(BUCKETS, "int32")
    row[kept] = np.arange(1, len(kept) + 1)
    emb = rng.normal(0, 0.05, (len(kept) + 1, SIZE)).astype("float32")
    emb[0] = 0
    n_out = FILTERS * len(WIDTHS)
    return Classifier(
        row, emb, [rng.normal(0, 0.3 / w, (w, SIZE, FILTERS)).astype("float32") for w in WIDTHS],
        np.zeros(n_out, "float32"), rng.normal(0.3, 0.1, n_out).astype("float32") * np.where(np.arange(n_out) % 4 == 3, -1, 1).astype("float32"),
        -1.0, {"": 0.0},
    )


def constant(rows: int, toxic: int) -> Classifier:
    """Of rows of one class."""
    m = untrained(np.zeros(0, "int64"))
    m.constant = min(0.25, (toxic + 1) / (rows + 20))
    return m


@dataclass
class Trainer:
    """A classifier in training, with AdaGrad's sums of squares for each of its parts."""

    model: Classifier
    embedding: np.ndarray
    dense: list[np.ndarray]  # for the filters of each width, the shift, the weight and the bias

    @classmethod
    def of(cls, m: Classifier) -> Trainer:
        return cls(m, np.full(m.embedding.shape, 1e-3, "float32"), [
            np.full(x.shape, 1e-3, "float32") for x in (*m.filters, m.shift, m.weight, np.zeros(1))])

    def copied(self) -> Trainer:
        return pickle.loads(pickle.dumps(self))

    def flat(self) -> np.ndarray:
        """All but the embeddings, in rows of ``2 * SIZE``: the weights and their sums of squares."""
        m = self.model
        own = np.concatenate([x.ravel() for x in (*m.filters, m.shift, m.weight, np.array([m.bias], "float32"))])
        squares = np.concatenate([x.ravel() for x in self.dense])
        both = np.zeros((2, -(-len(own) // SIZE) * SIZE), "float32")
        both[:, : len(own)] = own, squares
        return np.concatenate([both[0].reshape(-1, SIZE), both[1].reshape(-1, SIZE)], axis=1)

    def set_flat(self, rows: np.ndarray) -> None:
        m, low = self.model, 0
        own, squares = rows[:, :SIZE].ravel(), rows[:, SIZE:].ravel()
        parts = [*m.filters, m.shift, m.weight]
        for x, g in zip(parts, self.dense, strict=False):
            x[...], g[...] = own[low: low + x.size].reshape(x.shape), squares[low: low + x.size].reshape(x.shape)
            low += x.size
        m.bias, self.dense[-1][0] = float(own[low]), squares[low]

    def run(self, rows: list[np.ndarray], y: np.ndarray, lift: float, epochs: int, seed: int) -> np.ndarray:
        """Passes over ``rows`` (of ``Classifier.rows``); a toxic one counts ``lift`` times.  Returns which embeddings changed."""
        m, rng, changed = self.model, np.random.default_rng([7, seed]), np.zeros(len(self.embedding), bool)
        g_f, (g_shift, g_w, g_b) = self.dense[: len(WIDTHS)], self.dense[len(WIDTHS):]
        for i in (i for _ in range(epochs) for i in rng.permutation(len(rows))):
            r = rows[i]
            r = r[rng.random(len(r)) > 0.1] if len(r) > 3 else r
            top, at = m.peaks(r)
            h = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ m.weight + m.bias, -30, 30)))
            d = float(p - y[i]) * (lift if y[i] else 1.0)
            if abs(d) < 1e-3:
                continue
            gh = (d * m.weight * (top > 0)).astype("float32")
            gw = (d * h + DECAY * m.weight).astype("float32")
            live = np.flatnonzero(gh)
            padded = r if len(r) >= max(WIDTHS) else np.concatenate([r, np.zeros((max(WIDTHS) - len(r), 3), "int32")])
            touched, pushes = [], []
            for k, width in enumerate(WIDTHS):
                own = live[(live >= k * FILTERS) & (live < (k + 1) * FILTERS)]
                if not len(own):
                    continue
                f, col = m.filters[k], own - k * FILTERS
                for j in range(width):
                    at_rows = padded[at[own] + j]
                    x = m.embedding[at_rows].sum(1)
                    grad = x.T * gh[own]
                    touched.append(at_rows)
                    pushes.append((f[j][:, col] * gh[own]).T)
                    g_f[k][j][:, col] += grad * grad
                    f[j][:, col] -= RATE * (grad / np.sqrt(g_f[k][j][:, col]) + DECAY * f[j][:, col])
            if touched:
                own_rows = np.concatenate(touched)
                push = np.repeat(np.concatenate(pushes), 3, 0)
                which, where = np.unique(own_rows.ravel(), return_inverse=True)
                grad = np.zeros((len(which), SIZE), "float32")
                np.add.at(grad, where, push)
                grad[which == 0] = 0
                self.embedding[which] += grad * grad
                m.embedding[which] -= RATE * grad / np.sqrt(self.embedding[which])
                changed[which] = True
            g_shift += gh * gh
            m.shift -= RATE * gh / np.sqrt(g_shift)
            g_w += gw * gw
            m.weight -= RATE * gw / np.sqrt(g_w)
            g_b += d * d
            m.bias -= RATE * d / float(np.sqrt(g_b[0]))
        changed[0] = False
        return changed


def feature_counts(cut: Iterable[list[str]]) -> np.ndarray:
    """How many texts have a feature of each bucket."""
    seen, known = np.zeros(BUCKETS, "int64"), {}
    for words in cut:
        if len(known) > COUNTED_WORDS:
            known.clear()
        own = set(words)
        for w in own.difference(known):
            known[w] = buckets_of(w)
        seen[list({b for w in own for b in known[w]})] += 1
    return seen


def train(texts: list[str], toxic: list[int]) -> Classifier:
    """Of few texts at hand, what ``learn`` does with one shard.  Deterministic for a given order of rows."""
    y = np.array(toxic, "float32")
    if not len(y) or y.min() == y.max():
        return constant(len(y), int(y.sum()))
    cut = [words_of(t) for t in texts]
    fit = np.array([i for i in range(len(y)) if zlib.crc32(b"%d" % i) % 100 >= 100 * CALIBRATION_SHARE])
    judge = np.setdiff1d(np.arange(len(y)), fit)
    if not 0 < y[judge].sum() < len(judge) or not 0 < y[fit].sum() < len(fit):
        fit = judge = np.arange(len(y))
    m = untrained(np.flatnonzero(feature_counts(cut[i] for i in fit) >= LEAST_DOCS))
    lift = float(np.sqrt((y[fit] == 0).sum() / max(1, y[fit].sum())))  # the rarer class counts for more
    Trainer.of(m).run([m.rows(cut[i]) for i in fit], y[fit], lift, EPOCHS, 0)
    z, one = np.array([m.logit(cut[i]) for i in judge]), np.ones(len(judge))
    tongue = np.array([language_of(cut[i]) for i in judge])
    _set_thresholds(m, {"": _cells(z, y[judge], one)} | {
        k: _cells(z[tongue == k], y[judge][tongue == k], one[tongue == k]) for k in set(tongue.tolist())})
    m.forget()
    return m


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def _marked(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of the documents to learn from."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
    ).groupBy("doc_id").agg((F.max(F.col("toxic").cast("int")) == 1).cast("int").alias("toxic")).where(~held_out())


def _maybe_marked(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """``rows`` without most of those whose doc_id is not ``marked``, so that few other texts are shuffled."""
    return maybe_among(rows, marked, "doc_id", MOST_MARKS)


def labelled(docs: DataFrame, labels: DataFrame, n_shards: int = 1) -> DataFrame:
    """text, toxic (0 or 1), judge (a row to calibrate with), place (a hash) and shard of all rows to learn from; the rows of a
    shard are in one partition."""
    marked = _marked(labels)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    near = _maybe_marked(rows, marked).join(marked.hint("merge"), "doc_id")  # a broadcast would grow with the labels
    place = F.xxhash64("doc_id", "text")
    dealt = near.select("text", "toxic", _judges("text").alias("judge"), place.alias("place"))
    return dealt.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(n_shards))).repartition(n_shards, "shard")


def _judges(text: str) -> Column:
    return F.pmod(F.xxhash64("doc_id", text, F.lit("judge")), F.lit(100)) < round(100 * CALIBRATION_SHARE)


def _feature_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n) over all ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_of("toxicity")
        seen = feature_counts(words_of(t.as_py()) for batch in batches for t in batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen)), pa.array(seen[seen > 0])], ["bucket", "n"])

    return rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _trained(trainer: Trainer, shards: DataFrame, lift: float, epochs: int) -> Trainer:
    """The mean of what the shards of ``shards`` (shard, text, toxic), sorted by shard, make of ``trainer``."""
    known = shards.sparkSession.sparkContext.broadcast(trainer)
    values = [f"v{k}" for k in range(2 * SIZE)]

    def passed(shard: int, rows: list[np.ndarray], y: list[int]) -> Iterator[pa.RecordBatch]:
        own = known.value.copied()
        changed = np.flatnonzero(own.run(rows, np.array(y, "float32"), lift, epochs, shard))
        flat = own.flat()
        table = np.concatenate([flat, np.concatenate([own.model.embedding[changed], own.embedding[changed]], axis=1)])
        number = np.concatenate([-1 - np.arange(len(flat)), changed])
        for low in range(0, len(table), RETURNED):
            part = table[low: low + RETURNED].astype("float64")
            whole = np.rint(np.clip(part, -MOST_WEIGHT, MOST_WEIGHT) * UNIT).astype("i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[low: low + RETURNED]), *(pa.array(np.ascontiguousarray(c)) for c in whole.T)], ["row", *values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, now, rows, y = known.value.model, None, [], []
        for batch in batches:
            for shard, text, toxic in zip(batch.column("shard").to_pylist(), batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                if shard != now and rows:
                    yield from passed(now, rows, y)
                    rows, y = [], []
                now = shard
                rows.append(words.rows(words_of(text.as_py())))
                y.append(toxic)
        if rows:
            yield from passed(now, rows, y)
        words.forget()

    returned = shards.mapInArrow(run, ", ".join(["row long", *(f"{v} long" for v in values)]))
    mean = returned.groupBy("row").agg(*((F.sum(v) / F.count(F.lit(1)) / UNIT).cast("float").alias(v) for v in values))
    got = mean.orderBy("row").toArrow()
    known.unpersist()
    if not got.num_rows:
        return trainer
    number = got.column("row").to_numpy()
    table = np.stack([got.column(v).to_numpy() for v in values], axis=1)
    out, dense = trainer.copied(), number < 0
    out.set_flat(table[dense][::-1])
    out.model.embedding[number[~dense]], out.embedding[number[~dense]] = table[~dense][:, :SIZE], table[~dense][:, SIZE:]
    return out


def _judged(model: Classifier, rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``_set_thresholds`` takes, from the logits of all ``rows`` on the grid: a bounded number of counts a language."""
    known = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tongue, z = [], []
            for words in (words_of(t.as_py()) for t in batch.column("text")):
                tongue.append(language_of(words))
                z.append(known.value.logit(words))
            cell = np.rint(np.clip(z, -MOST_LOGIT, MOST_LOGIT) * GRID).astype("i8")
            yield pa.RecordBatch.from_arrays([pa.array(tongue, pa.string()), pa.array(cell), batch.column("toxic")], ["tongue", "cell", "toxic"])

    counted = rows.select("text", "toxic").mapInArrow(run, "tongue string, cell long, toxic int").groupBy("tongue", "cell", "toxic")
    got = counted.agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    known.unpersist()
    return {
        k: _cells(own["cell"].to_numpy() / GRID, own["toxic"].to_numpy(), own["n"].to_numpy())
        for k, own in [("", got), *got.groupby("tongue")]
    }


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Train on all labelled rows that are not held out, see above."""
    text = text_of(docs)
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", _judges("text").alias("judge"), F.length("text").alias("chars"))
    found = narrow.join(_marked(labels), "doc_id").groupBy("judge", "toxic").agg(F.count(F.lit(1)), F.sum("chars")).collect()
    counts = {(judge, toxic): n for judge, toxic, n, _ in found}
    n, toxic = sum(counts.values()), sum(c for (_, y), c in counts.items() if y)
    if not 0 < toxic < n:
        return constant(n, toxic)
    apart = len(counts) == 4  # else too few rows for two parts: all of them do both
    own = {y: sum(c for (j, t), c in counts.items() if t == y and not (j and apart)) for y in (0, 1)}
    chars = sum(c for j, _, _, c in found if not (j and apart))
    n_shards = max(1, round(sum(own.values()) / SHARD_ROWS), round(chars / SHARD_CHARS))
    # a shard lies in one file, so it is one task's; of one with several row groups each task trains its own part
    rows = stored(labelled(docs, labels, n_shards).sortWithinPartitions("shard", "place", "text", "toxic").drop("place"))
    fit, judge = (rows.where("not judge"), rows.where("judge")) if apart else (rows, rows)
    kept = _feature_counts(fit).where(F.col("n") >= LEAST_DOCS).select("bucket").orderBy("bucket").toArrow()  # at most ``BUCKETS``
    lift = float(np.sqrt(own[0] / own[1]))  # the rarer class counts for more
    trainer = _trained(Trainer.of(untrained(kept.column("bucket").to_numpy())), fit.where("shard = 0"), lift, EPOCHS)
    if n_shards > 1:
        trainer = _trained(trainer, fit, lift, 1)
    model = trainer.model
    _set_thresholds(model, _judged(model, judge))
    release(rows)
    return model


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """All columns of ``docs`` that are asked for by name later, with toxicity_score: scans only doc_id and text."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS rows of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_of("toxicity")
        for batch in batches:
            scores = [known.value.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_harmless(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows of ``docs`` whose score is below ``PASS_MARK``, all columns as they are."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_of("toxicity")
        for batch in batches:
            keep = [known.value.score(t or "") < PASS_MARK for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    return score(docs, learn(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PASS_MARK).cast("int").alias("predicted")
    )
