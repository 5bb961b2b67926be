"""Token counts, piece codec and packing against the libraries."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF

from starmart.llm import packing, piece_codec, token_counts
from starmart.llm.queries import QUERIES

from .conftest import TEXTS

MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdeéßthin ing  \n\t▁日本語कя0123456789😀<s>'\"\x00\x7f́€ΣЖ"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(pieces, n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(0, 35)))
        if k % 3 == 0:
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 6))).replace("▁", " ")
        yield " " * rng.randrange(0, 40) + text if k % 7 == 0 else text


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_codec_equals_library(library):
    codec = piece_codec.Codec(MODEL)
    for text in [*random_texts(codec.pieces.text[259:], 3000), *(t or "" for _, t in TEXTS)]:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text) == packed(ids), text
        assert codec.decode(packed(ids)) == library.decode(ids), text


def test_decode_of_any_ids(library):
    codec, rng = piece_codec.Codec(MODEL), random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(0, 300), rng.randrange(3, 32000)]) for _ in range(rng.randrange(0, 8))]
        assert codec.decode(packed(ids)) == library.decode(ids), ids


def test_prefix_counts_equal_library(library):
    counter, rng = token_counts.PrefixCounter(MODEL), random.Random(5)
    for text in random_texts(counter.pieces.text[259:], 500, 2):
        want = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        budget = rng.randrange(0, 12)
        assert counter.prefixes(text).tolist() == want, text
        assert counter.total(text) == want[-1], text
        assert counter.fitting(text, budget) == max(k for k, n in enumerate(want) if n <= budget), text


def test_operators_on_odd_rows(docs, nothing, library):
    want = sorted(((i, t or "") for i, t in TEXTS), key=repr)
    counts = token_counts.token_counts(docs, MODEL, 100).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in counts), key=repr) == sorted(
        ((i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 100) for i, t in want), key=repr
    )
    coded = piece_codec.encode_decode(docs, MODEL).collect()
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in coded), key=repr) == sorted(
        ((i, packed(library.encode(t, add_bos=True, add_eos=True)), t) for i, t in want), key=repr
    )
    assert token_counts.token_counts(nothing, MODEL).count() == piece_codec.encode_decode(nothing, MODEL).count() == 0


def test_stored_prefixes_answer_budgets(docs, library):
    from pyspark.sql import functions as F

    some = docs.where("doc_id in (11, 22)")
    tables = token_counts.prefix_tables(some, MODEL).withColumn("cut", F.lit(4))
    texts = dict(TEXTS)
    for r in token_counts.within(tables, "cut").collect():
        assert r.tokens == len(library.encode(texts[r.doc_id][:4]))


def test_registered_queries_equal_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_token_counts"](spark, SF).collect():
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(library.encode(texts[r.doc_id])))
    for r in QUERIES["op5_piece_codec"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def least_bins(items, capacity):
    """Exhaustive search."""
    items, best = sorted(items, reverse=True), len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= items[k] and rooms[i] not in rooms[:i]:
                rooms[i] -= items[k]
                go(k + 1, rooms)
                rooms[i] += items[k]
        go(k + 1, [*rooms, capacity - items[k]])

    go(0, [])
    return best


def test_plan_is_optimal_on_small_cases():
    rng, better = random.Random(3), 0
    for k in range(600):
        capacity = rng.choice([10, 20, 50, 100])
        items = [rng.randrange(1, capacity + 1 if k % 2 else capacity // 2 + 1) for _ in range(rng.randrange(0, 13))]
        counts, used = collections.Counter(items), collections.Counter()
        plan = packing.plan_sequences(counts, capacity)
        for filling, n in plan:
            assert sum(a * b for a, b in filling) <= capacity
            for length, each in filling:
                used[length] += each * n
        assert used == counts
        size = sum(n for _, n in plan)
        assert packing.least_sequences(counts, capacity) <= size == least_bins(items, capacity)
        better += size < sum(n for _, n in packing.best_fit(counts, capacity))
    assert better  # the search does beat best fit


def test_fillings_come_by_waste_and_none_is_missing():
    rng = random.Random(11)
    for _ in range(200):
        capacity = rng.randrange(8, 40)
        left = {n: rng.randrange(1, 4) for n in rng.sample(range(1, capacity), rng.randrange(1, 6))}
        largest = max(left)
        got = [*packing.fillings(largest, left, capacity, capacity, [10**6])]
        wastes = [capacity - sum(n * c for n, c in f) for f in got]
        assert wastes == sorted(wastes) and len(set(got)) == len(got)
        every, order = [{}], sorted(left)
        for n in order:
            every = [{**f, n: c} if c else f for f in every for c in range(left[n] + 1)]
        want = set()
        for f in every:
            room = capacity - largest - sum(n * c for n, c in f.items())
            if room >= 0 and not packing._dominated(sorted(f.items()), room, left, order):
                own = collections.Counter(f)
                own[largest] += 1
                want.add(tuple(sorted(own.items(), reverse=True)))
        assert set(got) == want


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    library, at = Tokenizer.from_file(WORDS), collections.defaultdict(list)
    want = []
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, low in enumerate(range(0, len(ids), capacity)):
            own = ids[low:low + capacity]
            want.append((i, piece, low, len(own), zlib.crc32(packed(own))))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    counts = collections.Counter(r[3] for r in want)
    assert len(at) <= sum(n for _, n in packing.best_fit(counts, capacity))
    assert len(at) >= packing.least_sequences(counts, capacity)


def test_packing_of_odd_rows(docs, nothing):
    placed = packing.pack(docs, WORDS, 256)
    rows = placed.collect()
    check_packing(rows, TEXTS, 256)
    ids = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in packing.sequences(placed).collect()}
    for r in rows:
        n, own = ids[r.sequence_id]
        assert zlib.crc32(own[4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32 and len(own) == 4 * n
    assert packing.pack(nothing, WORDS).count() == 0


def test_registered_packing(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packing(QUERIES["op1_best_fit_packing"](spark, SF).collect(), texts, 4096)


def test_words_equal_whole_texts():
    from tokenizers import Tokenizer

    own, library, rng = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS), random.Random(6)
    texts = ["".join(rng.choice(LETTERS + "\x85\x1c\x0b'sS") for _ in range(40)) for _ in range(1000)]
    texts += ["".join(rng.choice("aB1²_é.,.,.,  \n\u0301İſ'sⅣ…") for _ in range(30)) for _ in range(2000)]
    texts += [" ".join(rng.choice(["Word", "word", "WORD.", "word,", "wörd", "Wörd.", "x1.", "İ.", "ǅ,", "don't."]) for _ in range(9)) for _ in range(200)]
    for text in [*texts, "a<|endoftext|>b  <|startoftext|> I'll 'S", *(t or "" for _, t in TEXTS)]:
        assert own(text) == packed(library.encode(text, add_special_tokens=False).ids), text


def test_new_words_of_many_texts_go_to_the_library_together(monkeypatch):
    rng, calls = random.Random(8), []
    texts = [" ".join("".join(rng.choices("abcdeéßΣ.,", k=9)) for _ in range(12)) + rng.choice(["", ".", ",\n", " <|endoftext|>"]) for _ in range(200)]
    one = packing.WordTokenizer(WORDS)
    want = [one(t) for t in texts]
    own = packing.WordTokenizer(WORDS)
    encode = own._ids
    monkeypatch.setattr(own, "_ids", lambda text: calls.append(text) or encode(text))
    assert list(own.many(texts)) == want and len(calls) < len(texts) / 4
    monkeypatch.setattr(packing, "TOGETHER", 300)
    assert list(packing.WordTokenizer(WORDS).many(texts)) == want and list(own.many([])) == []
