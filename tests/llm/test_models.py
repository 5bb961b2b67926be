"""Classifiers on held-out rows, learned formats, fingerprints against plain versions, and the pipeline."""

import collections
import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF

import corpus_pipeline
from starmart.llm import common, fingerprints, language_id, ngram_join, secret_scan, toxicity
from starmart.llm.queries import QUERIES

from .conftest import TEXTS, frame
from .test_copies import components, digest, shingles
from .test_tokens import check_packing

SMALL = "/root/testdata/sf0.01"


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    y = np.array(labels)
    return (ranks[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())


# --- toxicity -------------------------------------------------------------------------------------------------

INSULTS = ["idiot", "clown", "moron", "worthless"]


def made_texts(n, seed):
    rng = random.Random(seed)
    for k in range(n):
        own = [f"word{int(rng.paretovariate(0.6)) % 3000}" for _ in range(rng.randrange(20, 200))] + ["the", "of"]
        if k % 4 == 0:
            own[rng.randrange(len(own))] = rng.choice(INSULTS)
        yield " ".join(own), int(k % 4 == 0)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*zip(*made_texts(1200, 1), strict=True))


def test_classifier_learns(model):
    texts, labels = zip(*made_texts(600, 2), strict=True)
    scores = [model.score(t) for t in texts]
    assert auc(scores, labels) > 0.98
    wrong = sum((s >= toxicity.PASS_MARK) != y for s, y in zip(scores, labels, strict=True))
    assert wrong < 0.05 * len(texts)
    assert all(0 <= s <= 1 for s in scores)


def test_long_texts_score_in_blocks(model):
    clean = " ".join(f"word{k % 300}" for k in range(60_000))
    assert model.score(clean) < toxicity.PASS_MARK <= model.score(clean + " you idiot and moron clown")
    words = toxicity.words_of(clean)[:60_000]
    top, _ = model.responses(model.rows(words))
    assert np.isclose(model.logit(words), np.maximum(top, 0) @ model.weight + model.bias, atol=1e-4)


def plain_logit(model, words):
    """The classifier window by window: sums of hashed embeddings, every filter at every place, largest response, logistic unit."""
    embedded = []
    for w in words:
        parts = (w, "<" + w[:4], w[-4:] + ">")
        embedded.append(sum(model.embedding[model.row[zlib.crc32(p.encode()) % toxicity.BUCKETS]].astype(float) for p in parts))
    embedded += [np.zeros(toxicity.SIZE)] * (max(toxicity.WIDTHS) - len(embedded))
    total, unit = float(model.bias), 0
    for width, own in zip(toxicity.WIDTHS, model.filters, strict=True):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(float(embedded[at + k] @ own[k, :, f]) for k in range(width)) for at in range(len(embedded) - width + 1)
            )
            total += max(best + float(model.shift[unit]), 0.0) * float(model.weight[unit])
            unit += 1
    return total


def test_scores_equal_a_plain_forward_pass(model):
    texts = [t for t, _ in made_texts(12, 3)] + ["", "idiot", "the moron", "never seen words", "Straße déjà 東京 idiot"]
    for text in texts:
        words = toxicity.words_of(text)
        want = plain_logit(model, words)
        assert np.isclose(model.logit(words), want, atol=1e-3), text[:50]
        limit = model.thresholds.get(toxicity.language_of(words), model.thresholds[""])
        odds = np.exp(want - limit) * toxicity.PASS_MARK / (1 - toxicity.PASS_MARK)
        assert np.isclose(model.score(text), odds / (1 + odds), atol=1e-3)


def test_nothing_to_learn_from(spark, docs, nothing):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(TEXTS) and {r.predicted for r in rows} == {0} and len({r.score for r in rows}) == 1
    assert {(r.doc_id, r.held_out) for r in rows} == {(i, held_out(i)) for i, _ in TEXTS}
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_only_the_text_enters(spark):
    """Other columns and held-out labels change no score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    plain = {r.doc_id: (r.score, r.predicted) for r in toxicity.toxicity(docs, labels).collect()}
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x"), "score": F.lit(1)})
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: (r.score, r.predicted) for r in toxicity.toxicity(other, turned).collect()} == plain


def test_registered_toxicity_held_out(spark):
    rows = QUERIES["op6_toxicity"](spark, SMALL).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    own = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert len(rows) == 1000 and auc(*zip(*own, strict=True)) > 0.8


def labelled_frames(spark, made, parts):
    rows = [(i, t, y) for i, (t, y) in enumerate(made)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(parts)
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").repartition(parts)


def test_whole_long_texts_are_learned_from(spark):
    """No toxic text is short."""
    made = [(t + " word1 word2" * 1800 * y, y) for t, y in made_texts(400, 5)]
    assert min(len(t) for t, y in made if y) > 20_000
    model = toxicity.learn(*labelled_frames(spark, made, 3))
    fresh = [(t + " word1 word2" * 1800 * y, y) for t, y in made_texts(80, 6)]
    assert all((model.score(t) >= toxicity.PASS_MARK) == y for t, y in fresh)


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    """The mean of six shards tells the classes apart, however the rows lie."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 200)
    made = [*made_texts(2000, 1)]
    rows = toxicity.labelled(*labelled_frames(spark, made, 3)).collect()
    want = [t for i, (t, _) in enumerate(made) if not held_out(i)]
    assert sorted(r.text for r in rows) == sorted(want)
    one, other = (toxicity.learn(*labelled_frames(spark, made, parts)) for parts in (2, 9))
    fresh = [*made_texts(300, 2)]
    assert [one.score(t) for t, _ in fresh] == [other.score(t) for t, _ in fresh]
    assert auc([one.score(t) for t, _ in fresh], [y for _, y in fresh]) > 0.97


def test_returned_weights_do_not_depend_on_batches(spark, monkeypatch):
    rows = spark.createDataFrame([(0, t, y) for t, y in made_texts(80, 4)], "shard long, text string, toxic int")
    kept = np.flatnonzero(toxicity.feature_counts(toxicity.words_of(r.text) for r in rows.collect()) >= toxicity.LEAST_DOCS)
    start = toxicity.Trainer.of(toxicity.untrained(kept))
    whole = toxicity._trained(start, rows, 1.0, 1)
    monkeypatch.setattr(toxicity, "RETURNED", 7)
    parts = toxicity._trained(start, rows, 1.0, 1)
    assert (whole.model.embedding == parts.model.embedding).all() and (whole.flat() == parts.flat()).all()
    assert not (whole.flat() == start.flat()).all()


def test_blocks_of_long_texts_have_no_windows_of_their_own(model, monkeypatch):
    rows = model.rows([f"word{k % 300}" for k in range(211)])
    top, at = model.responses(rows)
    for block in (70, 105, 209, 210, 211):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        own, where = model.peaks(rows)
        assert np.allclose(own, top, atol=1e-5) and (where + max(toxicity.WIDTHS) <= len(rows) + 2).all()


def test_labels_that_texts_do_not_explain_reject_nothing():
    blind = toxicity.train(["the same words of it"] * 40, [0, 1] * 20)
    assert blind.score("the same words of it") < toxicity.PASS_MARK


def test_threshold_where_nearly_all_rows_are_toxic():
    """One clean row that does not rank last: the toxic rows above it are still rejected."""
    z, y = np.array([*np.linspace(1, 3, 40), -2.0, -1.0]), np.array([1.0] * 41 + [0.0])
    assert toxicity._best_threshold(z, y) < 1 and toxicity._best_threshold(z, y) > -1
    assert toxicity._best_threshold(z, y, 0.4) == 0.4  # a language takes the common threshold
    assert toxicity._best_threshold(np.zeros(6), np.array([1.0, 0, 1, 0, 1, 1])) > 0  # no ranking: nothing is rejected


def test_texts_without_a_label_are_not_exchanged(spark, monkeypatch):
    """All marked rows pass, few others do; a full bitmap lets all pass."""
    marked = spark.createDataFrame([(7 * i - 300,) for i in range(200)], "doc_id long")
    rows = spark.range(-5000, 5000).toDF("doc_id")
    near = {r.doc_id for r in toxicity._maybe_marked(rows, marked).collect()}
    assert near >= {7 * i - 300 for i in range(200)} and len(near) < 2000
    monkeypatch.setattr(toxicity, "MOST_MARKS", 1)
    assert toxicity._maybe_marked(rows, marked).count() > 9000


# --- secrets --------------------------------------------------------------------------------------------------


def plain_base(text):
    out = []
    for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])"""
        r"""|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(found):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found)


def check_secrets(rows, texts):
    want = collections.Counter()
    for i, t in texts:
        base = plain_base(t or "")
        counts = [sum(k == j for _, k, _ in base) for j in range(3)]
        want[(i, *counts, hashlib.sha256(listed(base).encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
    by_id = collections.defaultdict(list)
    for i, t in texts:
        by_id[i].append(set(listed(plain_base(t or "")).split(",")))
    for r in rows:
        assert any(base <= set(r.spans.split(",")) for base in by_id[r.doc_id])


def test_secrets_of_odd_rows(docs, nothing):
    check_secrets(secret_scan.digests(secret_scan.find_secrets(docs)).collect(), TEXTS)
    assert secret_scan.find_secrets(nothing).count() == secret_scan.redact(nothing).count() == 0


def test_registered_secrets(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check_secrets(QUERIES["op7_secret_scan"](spark, SMALL).collect(), texts)


def test_base_patterns_on_random_strings():
    rng = random.Random(1)
    parts = ["password", "PassWD", "token", "api_key", "APIKEY", "ſecret", "toKen", ":", "=", " ", '"', "AKIA", "ABCDEFGH12345678",
             "0123456789abcdef", "abcdef", "x", "é", "\n", "secret"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))
        assert [(a, k, b) for a, k, b, _ in secret_scan.base_spans(text)] == plain_base(text), text


def test_formats_are_learned():
    rng = random.Random(2)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    found = {"hex": [make(hexes, 40) for _ in range(200)], "access": ["AKIA" + make(caps, 16) for _ in range(200)]}
    words = ["-".join(rng.choice(["report", "2024", "table", "page", "draft", "final"]) for _ in range(4)) for _ in range(300)]
    known = secret_scan.Formats(found, words)
    assert sum(known.is_secret(make(hexes, 20)) for _ in range(100)) > 60  # too short for the base pattern
    assert sum(known.is_secret("ASIA" + make(caps, 16)) for _ in range(100)) > 80
    assert not any(known.is_secret(w) for w in words[:200]) and not known.is_secret("justalongplainwordhere")
    for a in [*known.kinds.values(), known.background]:
        for log, unseen in zip(a.log, a.unseen, strict=True):
            mass = sum(np.exp(list(log.values()))) + (len(secret_scan.SYMBOLS) + 1 - len(log)) * np.exp(unseen)
            assert abs(mass - 1) < 1e-6  # each state is a distribution


@pytest.mark.parametrize("share", [1, 5, 40])
def test_formats_at_any_share_of_unlabelled_credentials(share):
    """Credentials outside the base patterns among the runs do not raise the limit above themselves."""
    rng = random.Random(share)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    found = {"hex": [make(hexes, 40) for _ in range(200)], "access": ["AKIA" + make(caps, 16) for _ in range(200)]}
    plain = ["-".join(rng.choice(["report", "2024", "table", "page", "draft", "final"]) for _ in range(4)) for _ in range(1000)]
    plain += [make("0123456789", 16) for _ in range(500)]
    hidden = ["ASIA" + make(caps, 16) if k % 2 else make(hexes, 22) for k in range(15 * share)]
    known = secret_scan.Formats(found, plain + hidden)
    own = [v for v in hidden if secret_scan.MIXED.search(v)]
    assert sum(map(known.is_secret, own)) > 0.7 * len(own)
    assert not any(map(known.is_secret, plain))


def scanned_values(spark, found, runs):
    """A stored scan whose documents hold one value each, some of them twice."""
    rows = [(1, [(k, 0, len(v), v)], []) for k, values in found.items() for v in [*values, *values[:20]]]
    rows += [(2, [], [("run", 0, len(v), v)]) for v in [*runs, *runs[:20]]]
    span = "array<struct<kind:string,start:int,stop:int,value:string>>"
    return spark.createDataFrame(rows, f"doc_id long, base {span}, runs {span}")


def test_formats_are_learned_from_all_values(spark, monkeypatch):
    """More values than a driver's sample held, and longer ones, count like any other."""
    rng = random.Random(7)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    found = {"hex": [make(hexes, 40) for _ in range(1500)], "assign": [make(caps, 260) for _ in range(30)]}
    runs = sorted({"-".join(rng.choice(["report", "2024", "table", "page"]) for _ in range(6)) for _ in range(5000)})
    assert len(runs) > 2500
    scanned, plain = scanned_values(spark, found, runs), secret_scan.Formats(found, runs)
    known = secret_scan.learn(scanned)
    for a, b in zip([*known.kinds.values(), known.background], [*plain.kinds.values(), plain.background], strict=True):
        assert a.step == b.step and a.unseen == pytest.approx(b.unseen)
    assert list(known.kinds) == ["assign", "hex"] and known.length["assign"] == 260
    for part in ("centre", "spread", "length", "least"):
        assert getattr(known, part) == pytest.approx(getattr(plain, part)), part
    # With fewer nodes than the tree has, every value still counts, and formats are still told apart.
    monkeypatch.setattr(secret_scan, "MOST_NODES", 300)
    fewer = secret_scan.learn(scanned)
    assert fewer.length == pytest.approx(plain.length) and fewer.kinds.keys() == plain.kinds.keys()
    assert sum(fewer.is_secret(make(hexes, 22)) for _ in range(100)) > 60
    assert not any(map(fewer.is_secret, runs[:300]))


def test_counts_of_a_cut_tree_are_whole(spark, monkeypatch):
    """Each value starts once, ends once and takes a step for each character, whatever stays off the driver."""
    monkeypatch.setattr(secret_scan, "MOST_NODES", 50)
    monkeypatch.setattr(secret_scan, "HELD_COUNTS", 7)
    seen = {}
    real = secret_scan.Automaton.__init__
    monkeypatch.setattr(secret_scan.Automaton, "__init__", lambda self, values=(), steps=None, counts=None: (
        seen.update(counts=counts, steps=steps), real(self, values, steps, counts))[1])
    rng = random.Random(3)
    values = sorted({"".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(8, 30))) for _ in range(400)})
    secret_scan._automata(spark.createDataFrame([("hex", v) for v in values], "kind string, value string"))
    assert sum(n for (_, c), n in seen["counts"].items() if c == "") == len(values)
    assert sum(n for (_, c), n in seen["counts"].items() if c) == sum(map(len, values))


def test_every_node_of_a_large_tree_has_its_part_in_the_merges(spark, monkeypatch):
    """Trees of more than ``MOST_NODES`` merge as the whole tree does, nodes of few strings included."""
    monkeypatch.setattr(secret_scan, "MOST_NODES", 50)
    monkeypatch.setattr(secret_scan, "HELD_PAIRS", 900, raising=False)
    rng = random.Random(11)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    values = {"run": {"-".join(rng.choice(["report", "2024", "table", "page"]) for _ in range(rng.randrange(1, 7))) for _ in range(1500)},
              "assign": {make("ab/+_0Z", rng.choice([1, 2, 3, 40])) + "=" * rng.randrange(3) for _ in range(700)}}
    rows = [(k, v) for k, own in values.items() for v in sorted(own)]
    got = secret_scan._automata(spark.createDataFrame(rows, "kind string, value string").repartition(3))
    for kind, own in values.items():
        plain = secret_scan.Automaton(sorted(own))
        assert len(plain.step) > 2 and got[kind].step == plain.step, kind
        assert got[kind].log == plain.log and got[kind].unseen == plain.unseen, kind


def test_planted_formats_over_a_whole_table(spark):
    """Precision and recall of ``format`` spans: keys of formats near the base ones, without a label and outside the base
    patterns, planted among the texts of a whole table, beside labelled ones and long runs that are no credentials."""
    rng = random.Random(5)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows, hidden, plain = [], set(), set()
    for i, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas().itertuples(index=False):
        text = text or ""
        if i % 3 == 0:  # labelled: the base patterns find these
            text += f" key AKIA{make(caps, 16)} sum {make(hexes, 40)}"
        if i % 10 == 1:
            value = f"ASIA{make(caps, 16)}" if i % 20 == 1 else make(hexes, 22)
            if secret_scan.MIXED.search(value):
                hidden.add((i, len(text) + 5, len(text) + 5 + len(value)))
                text += f" see {value} there"
        if i % 7 == 2:
            value = rng.choice([make("0123456789", 18), "-".join(rng.choice(["report", "2024", "table", "page"]) for _ in range(5))])
            plain.add((i, len(text) + 4))
            text += f" at {value} end"
        rows.append((i, text))
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    got = {(r.doc_id, s.start, s.stop) for r in found for s in r.found if s.kind == "format"}
    recall, precision = len(got & hidden) / len(hidden), len(got & hidden) / len(got)
    print("recall", recall, "precision", precision, len(hidden), len(got))
    assert len(hidden) > 90 and recall > 0.8 and precision > 0.9
    assert not {(i, a) for i, a, _ in got} & plain


def test_parts_beside_base_spans_are_candidates():
    left, right, key, tail = "Zx9" * 8, "q7W/" * 6, "AKIA" + "B2C3" * 4, "0123456789abcdef" * 2
    text = f"a {left}{'_'}{tail}/{right}== b {key} {left} c"
    base = secret_scan.base_spans(text)
    got = secret_scan.candidate_spans(text, base)
    assert [v for _, _, v in got] == [left + "_", "/" + right + "==", left]
    assert all(text[a:b] == v for a, b, v in got)
    assert not any(a < stop and start < b for a, b, _ in got for start, _, stop, _ in base)
    short = f"{left[:15]}-{tail}-{right[:14]}"
    assert [v for _, _, v in secret_scan.candidate_spans(short, secret_scan.base_spans(short))] == [left[:15] + "-"]


def test_redaction(docs):
    left = secret_scan.redact(docs)
    assert left.columns == docs.columns
    texts = collections.defaultdict(list)
    for i, t in TEXTS:
        texts[i].append(t)
    for r in left.collect():
        assert not plain_base(r.text or "")
        if r.text not in texts[r.doc_id]:
            assert secret_scan.MARKER in r.text and r.n_chars == len(r.text)
    got = {r.doc_id: r.text for r in left.collect()}
    assert got[21] == "The key [SECRET] and [SECRET]" and got[6] is None and got[14] == dict(TEXTS)[14]


def test_rows_of_a_tree_are_not_all_python_objects_at_once():
    n = 20_000
    rows = pa.table({
        "kind": ["run"] * n, "node": [b""] + [b"%016d" % k for k in range(1, n)], "parent": [None] + [b""] * (n - 1),
        "symbol": [None] + ["a"] * (n - 1), "depth": [0] + [1] * (n - 1), "n": [n] + [1] * (n - 1), "ends": [0] + [1] * (n - 1),
        "open": [True] + [False] * (n - 1)})
    tracemalloc.start()
    root = secret_scan.counted_tree(rows)
    left, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert root.n == n and root.next["a"][1] == 1 and peak - left < 8e6


# --- fingerprints ---------------------------------------------------------------------------------------------


def plain_ends(raw):
    out = []
    for i in range(len(raw)):
        window = raw[max(0, i - 6):i + 1][::-1]
        h, x = sum(window) + sum((7 - k) * c for k, c in enumerate(window)), 0
        for k, c in enumerate(window):
            x ^= (c << 5 * k) & 0xFFFFFFFF
        out.append((h + x) & 0xFFFFFFFF)
    return out


def plain_fingerprint(text):
    raw = text.encode()
    rolled, size = plain_ends(raw), 3
    while sum(h % size == size - 1 for h in rolled) >= 64:
        size *= 2

    def signature(size):
        out, start = "", 0
        for i, h in enumerate(rolled):
            if h % size == size - 1:
                out, start = out + fingerprints.LETTERS[zlib.crc32(raw[start:i + 1]) & 63], i + 1
        return out + (fingerprints.LETTERS[zlib.crc32(raw[start:]) & 63] if start < len(raw) else "")

    return f"{size}:{signature(size)}:{signature(2 * size)}"


def test_fingerprints_equal_plain_version(monkeypatch):
    texts = [t or "" for _, t in TEXTS if len(t or "") < 5000] + ["ab" * 500, "z", "é" * 99]
    for text in texts:
        assert fingerprints.fingerprint(text) == plain_fingerprint(text), text[:50]
    whole = fingerprints.fingerprint(dict(TEXTS)[14])
    monkeypatch.setattr(fingerprints, "BLOCK", 1000)
    assert fingerprints.fingerprint(dict(TEXTS)[14]) == whole


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_likeness_is_an_edit_distance():
    rng = random.Random(9)
    for _ in range(300):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(8, 40)))
        b = a[: rng.randrange(7, len(a) + 1)] + "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 20)))
        x, y = (re.sub(r"(.)\1{3,}", r"\1\1\1", s) for s in (a, b))
        if any(x[i:i + 7] in y for i in range(len(x) - 6)) and min(len(x), len(y)) >= 13:
            assert abs(fingerprints.signature_likeness(a, b) - (1 - plain_distance(x, y) / (len(x) + len(y)))) < 1e-12
    assert fingerprints.likeness("3:abc:d", "24:abc:d") == 0 and fingerprints.likeness("3::", "3::") == 1


def check_fingerprints(rows, texts):
    ordered = sorted(((i, t or "") for i, t in texts), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        new, own = t[: len(t) - len(t) // 4] + after[: len(t) // 4], fingerprints.fingerprint(t)
        changed = fingerprints.fingerprint(new)
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), own, changed, fingerprints.likeness(own, changed),
                     fingerprints.likeness(own, fingerprints.fingerprint(after))))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r[c] for c in names) for r in rows), key=repr) == sorted(want, key=repr)


def test_fingerprints_of_odd_rows(spark, docs, nothing):
    for some in (docs, docs.where("doc_id = 11"), docs.where("doc_id is null"), docs.where("doc_id in (9, 10)")):
        texts = [(r.doc_id, r.text) for r in some.collect()]
        check_fingerprints(fingerprints.digests(fingerprints.compare_with_next(some)).collect(), texts)
    assert fingerprints.compare_with_next(nothing).count() == fingerprints.fingerprints(nothing).count() == 0
    assert {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}[11] == plain_fingerprint("two words")


def test_registered_fingerprints(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = QUERIES["op8_document_fingerprints"](spark, SMALL).collect()
    check_fingerprints(rows, texts)
    assert np.median([r.near_edited for r in rows]) > 0.7 and np.quantile([r.near_next for r in rows], 0.95) < 0.2


# --- language -------------------------------------------------------------------------------------------------


def test_viterbi_paths_are_best():
    rng = np.random.default_rng(0)

    def value(s, path):
        return sum(s[i, k] for i, k in enumerate(path)) - language_id.SWITCH * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for _ in range(200):
        scores = [np.round(-12 * rng.random((int(rng.integers(0, 30)), 3))) for _ in range(int(rng.integers(0, 40)))]
        for s, path in zip(scores, language_id.best_paths(scores), strict=True):
            assert len(path) == len(s)
            if len(s):
                assert value(s, path) == value(s, language_id._alone(s, None, 0)[0])
            if 0 < len(s) <= 6:
                assert value(s, path) == max(value(s, p) for p in itertools.product(range(3), repeat=len(s)))


def test_scripts_and_spans():
    english, russian, greek = "the cat and the other cat of it", "это кот и ещё один кот тут", "αυτή είναι η γάτα και η άλλη"
    known = language_id.train([english * 5, russian * 5, greek * 5], ["en", "ru", "el"])
    mixed = f"{english} {english} {russian} {russian} {english} 12."
    (lang, score, spans), = language_id.label([mixed], known)
    assert lang == "en" and 0 < score <= 1
    assert [(s["lang"], mixed[s["start"]:s["stop"]]) for s in spans] == [
        ("en", f"{english} {english}"), ("ru", f"{russian} {russian}"), ("en", english)
    ]
    assert language_id.label(["12 34 !", "", "x² ²"[1:]], known) == [("und", 0.0, [])] * 3
    assert language_id.label(["γάτα"], known)[0][0] == "el"


def test_language_of_odd_rows(docs, nothing):
    rows = language_id.language_id(docs).collect()
    assert len(rows) == len(TEXTS)
    letters = {i: any(c.isalpha() for c in t or "") for i, t in TEXTS}
    assert {(r.doc_id, r.held_out) for r in rows} == {(i, held_out(i)) for i, _ in TEXTS}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) for r in rows)
    assert language_id.language_id(nothing).count() == 0
    assert {r.lang_pred for r in language_id.language_id(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null")).collect()} == {"und"}


def test_registered_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op10_language_id"](spark, SMALL).collect()]
    own = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean(own) > 0.98


# --- pipeline -------------------------------------------------------------------------------------------------


def plain_pipeline(rows, harmless, is_secret):
    """(doc_id, text) that reach the packing stage."""
    first = {}
    for i, t in sorted((r for r in rows if r[0] in harmless), key=lambda r: r[0]):
        first.setdefault(digest(t), (i, t))
    left = sorted(first.values())
    sets = [shingles(t) for _, t in left]
    seen, kept = set(), []
    for (i, t), root, s in zip(left, components(sets), sets, strict=True):
        if not s or root not in seen:
            kept.append((i, t))
        seen.add(root)
    out = []
    for i, t in kept:
        base = secret_scan.base_spans(t or "")
        cut = [(a, b) for a, _, b, _ in base] + [(a, b) for a, b, v in secret_scan.candidate_spans(t or "", base) if is_secret(v)]
        marks, end, text = sorted(cut), 0, ""
        for a, b in marks:
            if a >= end:
                text += (t or "")[end:a] + secret_scan.MARKER
            end = max(end, b)
        out.append((i, text + (t or "")[end:]))
    return out


def test_pipeline_equals_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = frame(spark, [(10_000 + k, t) for k, (i, t) in enumerate(TEXTS)]).select(docs.columns)
    docs.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    every = spark.read.parquet(f"{tmp_path}/documents.parquet")
    harmless = {r.doc_id for r in toxicity.toxicity(every, labels).collect() if not r.predicted}
    stages = every
    for _, stage in corpus_pipeline.STAGES[:3]:
        stages = stage(spark, stages, str(tmp_path))
        assert stages.columns == every.columns
        path = f"{tmp_path}/{stage.__name__}"
        stages.write.parquet(path)
        stages = spark.read.parquet(path)
    formats = secret_scan.learn(secret_scan.scan(stages))
    want = plain_pipeline([(r.doc_id, r.text) for r in every.collect()], harmless, formats.is_secret)
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), want, 4096)
    assert public_tokenizers.path("word_bpe_49k.json") and len(want) < every.count()


def test_workers_forget_another_operators_words():
    ngram_join.ngrams("some words of a text")
    assert ngram_join._WORDS
    common.task_of("ngram_join", ngram_join._forget)
    common.task_of("ngram_join", ngram_join._forget)
    assert ngram_join._WORDS  # its own next task finds them
    common.task_of("toxicity")
    assert not ngram_join._WORDS


def test_stages_take_texts_in_batches_of_bounded_size(spark):
    """10,000 rows of long texts would be one batch."""
    seen = spark.sparkContext.accumulator(0)
    docs = frame(spark, [(k, "text " * 2000) for k in range(2000)]).coalesce(1)
    corpus_pipeline.drop_near_copies(spark, docs.limit(0), SMALL)

    def run(batches):
        for batch in batches:
            seen.add(1)
            assert batch.nbytes < 12 << 20
            yield batch

    assert docs.mapInArrow(run, docs.schema).count() == 2000 and seen.value > 2


def test_pipeline_of_nothing_and_of_odd_rows(spark, docs, nothing, tmp_path):
    spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (nothing, docs):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            if name != "best_fit_packing":
                assert now.columns == docs.columns
                path = f"{tmp_path}/{name}-{rows is docs}"
                now.write.parquet(path)
                now = spark.read.parquet(path)
        assert (now.count() > 0) == (rows is docs)
