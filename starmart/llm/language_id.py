"""Language identification that labels the spans of mixed-language text.

Every word gets a score for each learned language: the log likelihood of its hashed character trigrams and of the word
itself, less that of the best language, no lower than ``FLOOR``.  The script of its letters narrows the candidates first:
a language that hardly used the script in training is out for this word, unless no language used it.  Viterbi then finds
the best sequence of languages, where each change costs ``SWITCH``.  Equal neighbours form spans; the text's language is
the one whose words have most letters.

The model is learned from a bounded sample: ``SAMPLE_PER_LANGUAGE`` texts of a language and ``SAMPLE_ROWS`` in all, of at
most ``TRAINING_CHARS`` characters each, chosen by hash among rows with a non-NULL ``lang`` whose CRC-32 of the id, modulo
4, is not 2.  Only the text enters a prediction.  Prediction covers every whole text, one scan and no shuffle.

Defined results: a NULL text or one without a letter is ``und`` with score 0 and no spans, and so is every text if nothing
could be learned; ties go to the first language by name; a NULL ``doc_id`` is not held out; repeated rows pass through; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import text_of

HELD_OUT = 2
SAMPLE_SHARES = 64  # in which a language's rows are looked through
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS, TRAINING_CHARS = 800, 8000, 20_000
BUCKETS, PRIOR = 1 << 17, 0.2
FLOOR, SWITCH = -4.0, 12.0
LEAST_SCRIPT_SHARE = 0.005
REMEMBERED_WORDS = 200_000
TOGETHER = 12
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")

# First code point of a range and its script.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"),
    (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
)
_STARTS = [a for a, _ in SCRIPT_RANGES]


_SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
_SCRIPT_OF_RANGE = np.array([_SCRIPTS.index(s) for _, s in SCRIPT_RANGES])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all words at once: buckets of their trigrams and of themselves, the word each belongs to (ascending), and the
    script of each word's first letter (a run of letters rarely mixes scripts)."""
    marked = [f"<{w.lower()}>" for w in words]
    sizes = np.array([len(m) for m in marked])
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype("uint64")
    owner = np.repeat(np.arange(len(words)), sizes)
    mixed = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA6B) + points[2:] * np.uint64(0xC2B2AE35)
    inside = owner[:-2] == owner[2:]
    buckets = ((mixed ^ (mixed >> np.uint64(17))) % np.uint64(BUCKETS)).astype("int64")[inside]
    own = np.array([zlib.crc32(m.encode("utf-8", "surrogatepass")) % BUCKETS for m in marked])
    owners = np.concatenate([owner[:-2][inside], np.arange(len(words))])
    order = np.argsort(owners, kind="stable")
    first = points[np.cumsum(sizes) - sizes + 1]
    return np.concatenate([buckets, own])[order], owners[order], _SCRIPT_OF_RANGE[np.searchsorted(_STARTS, first, "right") - 1]


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, letters: np.ndarray) -> None:
        """``counts``: features by bucket and language; ``letters``: by script and language."""
        self.languages = languages
        if languages:
            smooth = counts + PRIOR
            self.log = np.log(smooth / smooth.sum(0)).astype("float32")
            self.uses = letters / np.maximum(letters.sum(0), 1) >= LEAST_SCRIPT_SHARE
            self.uses[~self.uses.any(1)] = True
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._scores = np.zeros((1024, max(1, len(self.languages))), "float32")

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_known", "_scores")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def word_scores(self, words: list[str]) -> np.ndarray:
        buckets, owners, scripts = features(words)
        own = np.add.reduceat(self.log[buckets], np.searchsorted(owners, np.arange(len(words))), axis=0)
        own = np.where(self.uses[scripts], own, -np.inf)
        return np.maximum(own - own.max(1, keepdims=True), FLOOR)

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self._known) > REMEMBERED_WORDS:
            self._known.clear()
        known = self._known
        new = list(set(words).difference(known))
        if new:
            low, high = len(known), len(known) + len(new)
            known.update(zip(new, range(low, high), strict=True))
            while high > len(self._scores):
                self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
            self._scores[low:high] = self.word_scores(new)
        return self._scores[np.fromiter(map(known.__getitem__, words), "int64", len(words))]


def best_paths(scores: list[np.ndarray]) -> list[np.ndarray]:
    """The Viterbi path of each text.  Texts advance together, the longest first; the few that outlast the others go on
    alone.  Staying wins ties, then the first language."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    paths: list[np.ndarray] = [np.zeros(0, "int64")] * len(scores)
    if not len(order) or not lengths[0]:
        return paths
    every = np.concatenate([scores[i] for i in order])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    turn = int(lengths[TOGETHER - 1]) if len(order) >= TOGETHER else 0
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    value = np.zeros((0, every.shape[1]))
    ended: list[np.ndarray] = []
    active = int((lengths > 0).sum())
    for t in range(turn):
        live = int(np.searchsorted(-lengths, -t, "left"))  # lengths above t
        if t == 0:
            value = every[first[:live]].astype("float64")
            steps.append((None, None))
            active = live
            continue
        if live < active:
            ended.append(value[live:active])
            value, active = value[:live], live
        top = value.argmax(1)
        change = value[np.arange(live), top] - SWITCH
        stays = value >= change[:, None]
        value = np.where(stays, value, change[:, None]) + every[first[:live] + t]
        steps.append((top, stays))
    final = np.concatenate([value, *ended[::-1]]) if turn else value
    label = np.zeros(len(order), "int64")
    for k in range(min(TOGETHER, len(order))):  # texts that outlast the others
        if lengths[k] > turn:
            tail, label_in = _alone(every[first[k]: first[k] + lengths[k]], final[k].tolist() if turn else None, turn)
            label[k] = label_in
            paths[order[k]] = tail
    done = np.zeros(len(order), bool)
    track = np.zeros(len(every), "int16")
    for k in range(min(TOGETHER, len(order))):
        if lengths[k] > turn:
            track[first[k] + turn: first[k] + lengths[k]] = paths[order[k]]
            done[k] = True
    for t in range(turn - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -t, "left"))
        begins = np.flatnonzero((lengths[:live] == t + 1) | ((t == turn - 1) & ~done[:live]))
        if len(begins):
            label[begins] = final[begins].argmax(1)
        track[first[:live] + t] = label[:live]
        top, stays = steps[t]
        if top is not None:
            rows = np.arange(live)
            label[:live] = np.where(stays[rows, label[:live]], label[:live], top)
    for k, i in enumerate(order):
        paths[i] = track[first[k]: first[k] + lengths[k]]
    return paths


def _alone(own: np.ndarray, value: list[float] | None, start: int) -> tuple[np.ndarray, int]:
    """Labels from ``start`` on and the label just before it."""
    rows = own.astype("float64").tolist()
    back: list[list[int]] = []
    width = len(rows[0])
    for t in range(start, len(rows)):
        row = rows[t]
        if value is None:
            value, start_row = row, list(range(width))
            back.append(start_row)
            continue
        most = max(value)
        top, change = value.index(most), most - SWITCH
        back.append([k if v >= change else top for k, v in enumerate(value)])
        value = [(v if v >= change else change) + s for v, s in zip(value, row, strict=True)]
    at, out = value.index(max(value)), np.zeros(len(back), "int16")
    for k in range(len(back) - 1, -1, -1):
        out[k] = at
        at = back[k][at]
    return out, at


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def train(texts: list[str], langs: list[str]) -> Model:
    languages = sorted(set(langs))
    number = {k: i for i, k in enumerate(languages)}
    counts, letters = np.zeros((BUCKETS, len(languages))), np.zeros((len(_SCRIPTS), len(languages)))
    for lang, k in number.items():
        words: dict[str, int] = {}
        for text, own in zip(texts, langs, strict=True):
            if own == lang:
                for w in _WORD.findall(text):
                    words[w] = words.get(w, 0) + 1
        if words:
            often = np.array(list(words.values()))
            buckets, owners, scripts = features(list(words))
            np.add.at(counts[:, k], buckets, often[owners])
            np.add.at(letters[:, k], scripts, often * np.array([len(w) for w in words]))
    return Model(languages if letters.any() else [], counts, letters)


def learn(docs: DataFrame) -> Model:
    """From the bounded sample; its ids (at most ``SAMPLE_ROWS``) are broadcast."""
    usable = docs.select("doc_id", "lang", text_of(docs).alias("_text")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
        & (F.length("_text") <= TRAINING_CHARS) & (F.length("_text") > 0)
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_SHARES))).orderBy(*order)
    first = usable.select("doc_id", "lang", F.row_number().over(some).alias("_nth")).where(F.col("_nth") <= SAMPLE_PER_LANGUAGE)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(*order))  # of SAMPLE_PER_LANGUAGE from each share at most
    picked = first.select("doc_id", "lang", nth.alias("_nth")).where(F.col("_nth") <= SAMPLE_PER_LANGUAGE)
    picked = picked.orderBy("_nth", "lang", "doc_id").limit(SAMPLE_ROWS).select("doc_id").distinct()
    rows = usable.join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "_text").limit(SAMPLE_ROWS)
    got = rows.select("_text", F.col("lang").cast("string").alias("lang")).toPandas()
    return train(got["_text"].tolist(), got["lang"].tolist())


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def _spans(text: str, path: np.ndarray, languages: list[str]) -> list[dict]:
    out: list[dict] = []
    if (path == path[0]).all():
        start = _WORD.search(text).start()
        stop = len(text) - next(i for i, c in enumerate(reversed(text)) if _WORD.match(c))
        return [{"start": start, "stop": stop, "lang": languages[path[0]]}]
    for m, k in zip(_WORD.finditer(text), path.tolist(), strict=True):
        if out and out[-1]["lang"] == languages[k]:
            out[-1]["stop"] = m.end()
        else:
            out.append({"start": m.start(), "stop": m.end(), "lang": languages[k]})
    return out


def label(texts: list[str], model: Model) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    words = [_WORD.findall(t) for t in texts]
    if not model.languages:
        return [(UNDETERMINED, 0.0, [])] * len(texts)
    every = model.scores([w for own in words for w in own])
    scores = np.split(every, np.cumsum([len(w) for w in words])[:-1])
    out = []
    for text, own, s, path in zip(texts, words, scores, best_paths(scores), strict=True):
        if not any(c.isalpha() for w in own for c in w):  # nothing, or signs such as a raised digit
            out.append((UNDETERMINED, 0.0, []))
            continue
        sizes = np.bincount(path, [len(w) for w in own], len(model.languages))
        best = int(sizes.argmax())
        total = s[path == best].sum(0, dtype="float64")
        sure = 1 / np.exp(np.clip(total - total[best], -50, 50)).sum()
        out.append((model.languages[best], float(sizes[best] / sizes.sum() * sure), _spans(text, path, model.languages)))
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans (array of start, stop in code points, lang)."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, a column for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                pred, score, spans = zip(*label(part.column("text").to_pylist(), known.value), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(pred), pa.array(score, pa.float64()), pa.array(spans, _SPANS)],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>"
    )


def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
