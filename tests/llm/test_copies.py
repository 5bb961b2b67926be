"""Exact dedup, n-gram join and line dedup against brute force."""

import collections
import hashlib
import random
import re
import time

import pyarrow as pa
from conftest import SF
from pyspark.sql import functions as F

from starmart.llm import exact_dedup, line_dedup, links, ngram_join
from starmart.llm.common import maybe_among, stored
from starmart.llm.queries import ORACLES, QUERIES

from .conftest import BASE, NEAR, TEXTS, frame, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_cuckoo_filter_takes_and_gives_back():
    index = exact_dedup.BucketIndex(8)
    names = [hashlib.sha256(b"%d" % i).hexdigest() for i in range(3000)]
    for i, name in enumerate(names):
        index.insert(name, i, 1, 1)
    assert index.resizes and all(n in index.filter for n in names) and len(index.keys) == 3000
    for name in names[::2]:
        index.delete(name, 1)
    assert len(index.keys) == index.filter.size == 1500
    assert all(n in index.filter for n in names[1::2])
    assert sum(n in index.filter for n in names[::2]) < 20  # chance agreements only
    index.insert(names[1], 0, 2, 2)
    assert index.keys[names[1]] == [0, 3, 2, False]


def test_dedup_of_odd_rows(docs, nothing):
    groups = collections.defaultdict(list)
    for i, t in TEXTS:
        groups[digest(t)].append(i)
    keep = {d: min((i for i in ids if i is not None), default=None) for d, ids in groups.items()}
    want = [(i, keep[digest(t)], len(groups[digest(t)]), i == keep[digest(t)], digest(t)) for i, t in TEXTS]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.dedup(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    first = exact_dedup.keep_first(docs)
    assert first.columns == docs.columns
    assert sorted(((r.doc_id, digest(r.text)) for r in first.collect()), key=repr) == sorted(
        {(w[0], w[4]) for w in want if w[3]}, key=repr
    )
    assert exact_dedup.dedup(nothing).count() == exact_dedup.keep_first(nothing).count() == 0


def test_index_lives_on(spark, docs):
    """After rows came and went the index is the one that would be built from what is left."""
    rows = exact_dedup.digests(docs)
    index = exact_dedup.build_index(rows, rows.count())
    added = [(0, "one"), (99, "new text"), (98, "new text"), (None, "two words")]
    removed = [(11, "two words"), (1, TEXTS[0][1]), (2, TEXTS[0][1]), (98, "new text"), (5, TEXTS[5][1])]
    left = list(TEXTS) + added
    for r in removed:
        left.remove(r)
    live, came, went = (exact_dedup.digests(frame(spark, r)) for r in (left, added, removed))
    after = exact_dedup.update_index(index, live, came, went, 100)
    anew = exact_dedup.build_index(live, len(left))
    columns = ["text_sha256", "keep_id", "group_size", "first_rows", "stale"]
    assert sorted(map(str, after.select(columns).collect())) == sorted(map(str, anew.select(columns).collect()))
    got = {r.text_sha256: (r.keep_id, r.group_size) for r in after.collect()}
    assert got[digest("one")] == (0, 3) and got[digest("new text")] == (99, 1)
    assert got[digest("two words")] == (None, 1) and got[digest(TEXTS[0][1])] == (2, 3)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components(sets, similar=75):
    """Smallest member's position for each set, by union-find over all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    having = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            having[x].append(k)
    for k, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in having[x] if j < k)
        for j, n in common.items():
            if 100 * n >= similar * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    return [find(k) for k in range(len(sets))]


def check_join(rows, texts):
    sets = [shingles(t) for _, t in texts]
    roots, least = components(sets), {}
    for (i, _), root, s in zip(texts, roots, sets, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = [(i, len(s), least.get(root) if s else i) for (i, _), root, s in zip(texts, roots, sets, strict=True)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == sorted(want, key=repr)


def test_join_of_odd_rows(docs, nothing):
    check_join(ngram_join.link_documents(docs).collect(), TEXTS)
    assert ngram_join.link_documents(nothing).count() == 0
    left = ngram_join.keep_one_each(docs)
    assert left.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in left.collect())
    assert 1 in ids and not {2, 3, 4, 5, 10, 12, 15} & set(ids) and {6, 7, 8, 14} <= set(ids) and ids[None] == 2


def test_stages_lose_no_row_and_no_column(spark):
    """Rows that share an id are judged each by its own text, and columns may have any name."""
    from pyspark.sql import functions as F

    other = words(900, 40)
    rows = [(1, BASE), (2, NEAR), (2, other), (3, other + " more"), (3, "a text of its own, not like any other"), (4, NEAR + " x"),
            (1, NEAR.replace("changed", "altered")), (5, None), (None, BASE)]
    names = ["_digest", "_nth", "_d", "_i", "_gone", "gone", "row", "digest", "id", "nth", "its_id", "text_key", "with.dot"]
    clashing = frame(spark, rows).withColumns({n: F.lit(n) for n in names})
    left = ngram_join.keep_one_each(clashing)
    kept = left.collect()
    assert left.columns == clashing.columns and all(r[n] == n for r in kept for n in names)
    texts = {(r.doc_id, r.text) for r in kept}
    first = {(1, t) for i, t in texts if i == 1}
    assert len(first) == 1  # of two near copies under the smallest id one stays
    assert texts - first == {(2, other), rows[4], (5, None), (None, BASE)} and len(kept) == 5
    again = exact_dedup.keep_first(clashing.unionByName(clashing))
    kept = again.collect()
    assert again.columns == clashing.columns and all(r[n] == n for r in kept for n in names)
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(rows[:-1], key=repr)  # BASE stays under id 1


def test_join_of_near_copies(spark):
    """A chain of near copies, a group of many, and a passage that unlike texts share."""
    rng, vocabulary = random.Random(8), [f"v{i}" for i in range(4000)]
    base, rows = [rng.choice(vocabulary) for _ in range(120)], []
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(120)] = f"edit{k}"
        rows.append((k, " ".join(copy)))
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for k in range(12):
        rows.append((100 + k, " ".join(chain)))
        chain[6 * k:6 * k + 3] = [f"c{k}", "d", "e"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [(200 + k, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(60))) for k in range(40)]
    check_join(ngram_join.link_documents(frame(spark, rows)).collect(), rows)


def test_registered_join(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_join(QUERIES["op2_ngram_jaccard_join"](spark, SF).collect(), texts)


def test_many_per_chunk_and_range():
    """Packed rows keep every n-gram, however chunks and ranges fall."""
    import numpy as np

    sets = [np.unique(np.random.default_rng(k % 7).integers(0, 1 << 63, 50, dtype="uint64")) for k in range(200)]
    rows = list(ngram_join._chunk_rows(3, [(k, k) for k in range(200)], sets, 5))
    back = {r.doc_id: r for b in ngram_join._sets(_through(rows)) for r in b.to_pandas().itertuples()}
    assert len(back) == 200
    for k, s in enumerate(sets):
        assert back[k].n_shingles == 50 and sorted(ngram_join._wide(back[k].shared)) == sorted(s & np.uint64((1 << 48) - 1))
        assert set(np.frombuffer(back[k].often, "<u4")) == {200 // 7 + (k % 7 < 200 % 7)}


def _through(rows):
    mid = [r for b in ngram_join._frequencies([ngram_join._pack(sorted(rows, key=lambda r: r[0]))]) for r in b.to_pylist()]
    mid = [tuple(r.values()) for r in mid]
    return [ngram_join._pack(mid)]


def test_cuts_among_very_frequent_ngrams(spark):
    """Near copies whose n-grams stand in more than 32767 documents keep their whole overlap, wherever the cuts fall."""
    import numpy as np

    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 48, 400, dtype="uint64")
    often = rng.integers(32_768, (1 << 32) - 1, 400).astype("<u4")
    often[:40] = (1 << 32) - 1
    rows, sets = [], []
    for node in range(12):
        own = np.sort(rng.permutation(400)[:380])
        own = own[np.lexsort((hashes[own], often[own]))]
        keys = ngram_join._order_keys(ngram_join._thin(hashes[own]), often[own].tobytes())
        assert (np.diff(keys) >= 0).all()
        rows.append((node, 380, bytearray(ngram_join._thin(hashes[own])), bytearray(often[own].tobytes())))
        sets.append(set(own.tolist()))
    classes = spark.createDataFrame(rows, "node long, n_shingles long, shared binary, often binary")
    cuts = ngram_join.fragment_cuts(classes)
    assert len(cuts) == ngram_join.FRAGMENTS - 1
    parts = {(r.node, r.fragment): set(ngram_join._wide(r.segment).tolist()) for r in ngram_join.segments(classes, cuts).collect()}
    for a in range(12):
        for b in range(a):
            by_fragment = sum(len(parts.get((a, f), set()) & parts.get((b, f), set())) for f in range(ngram_join.FRAGMENTS))
            assert by_fragment == len(sets[a] & sets[b])


def test_components_of_links(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7)]
    got = {r.node: r.component for r in links.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: c for x, c in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


def line_set(line):
    return frozenset(line[k:k + 5] for k in range(len(line) - 4)) if len(line) >= 5 else frozenset([line])


def by_line(texts):
    return [(i, n, line) for i, t in texts for n, line in enumerate((t or "").split("\n"))]


def test_lines_of_odd_rows(docs, nothing):
    every = by_line(TEXTS)
    roots = components([line_set(x) for _, _, x in every])
    order = lambda p: (p[0] is None, p[0] or 0, p[1])
    keep, size = {}, collections.Counter(roots)
    for (i, n, _), root in zip(every, roots, strict=True):
        keep[root] = min((i, n), keep.get(root, (i, n)), key=order)
    want = [(i, n, *keep[root], size[root], (i, n) == keep[root]) for (i, n, _), root in zip(every, roots, strict=True)]
    assert sorted(map(tuple, line_dedup.dedup_lines(docs).collect()), key=repr) == sorted(want, key=repr)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_registered_lines_have_recall(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lines = by_line(texts)
    distinct = sorted({x for _, _, x in lines})
    roots = dict(zip(distinct, components([line_set(x) for x in distinct]), strict=True))
    rows = QUERIES["op9_line_dedup"](spark, SF).collect()
    text = {(i, n): x for i, n, x in lines}
    assert len(rows) == len(lines)
    together = {(text[r.doc_id, r.line_no], text[r.keep_doc_id, r.keep_line_no]) for r in rows}
    assert all(roots[a] == roots[b] for a, b in together)  # nothing is merged wrongly
    kept = sum(r.kept for r in rows)
    assert len(set(roots.values())) <= kept <= 1.01 * len(set(roots.values()))


def test_long_near_copies_share_a_band(spark):
    """Lines of many words with a similarity of 0.75 to 0.85: nearly all pairs have a band in common."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    pairs = []
    while len(pairs) < 600:
        n = (25, 40, 100)[len(pairs) % 3]
        old = " ".join(word() for _ in range(n))
        new = old
        for _ in range(round(len(old) * rng.uniform(0.015, 0.035))):
            at = rng.randrange(len(new))
            new = new[:at] + rng.choice("abcdefgh") + new[at + len(pairs) // 3 % 2:]  # inserted or replaced
        x, y = line_set(old), line_set(new)
        if 0.75 <= len(x & y) / len(x | y) <= 0.85:
            pairs.append((old, new))
    lines = spark.createDataFrame([(2 * k + j, p[j]) for k, p in enumerate(pairs) for j in range(2)], "node long, line string")
    keys = collections.defaultdict(set)
    facts = {}
    for r in line_dedup.sketches(lines).collect():
        keys[r.node], facts[r.node] = set(r["keys"]), r
    assert sum(bool(keys[2 * k] & keys[2 * k + 1]) for k in range(600)) >= 0.985 * 600
    both = spark.createDataFrame([(facts[2 * k], facts[2 * k + 1]) for k in range(600)], ["x", "y"])
    assert both.where(line_dedup._possible("x", "y")).count() >= 0.998 * 600


def test_sketches_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab c\u00e9\U0001f600") for _ in range(n)) for n in (0, 1, 4, 5, 6, 40, 300, 2000)]
    whole = line_dedup._sketches(lines)
    assert whole[0].tolist() == [len(line_set(x)) for x in lines]
    for piece in (1, 7, 100):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        assert all((a == b).all() for a, b in zip(whole, line_dedup._sketches(lines), strict=True))


def template_lines(n):
    rng = random.Random(n)
    return [f"{rng.randrange(10 ** 9):09d} entry of the register on page" for _ in range(n)]


def test_lines_of_one_template_are_not_all_compared(spark, monkeypatch):
    """Bands of hundreds of lines that are not linked: few pairs are verified, and the answer is that of brute force."""
    lines = template_lines(1500)
    lines += [x.replace("register", "registry") for x in lines[::50]]  # near copies
    docs = frame(spark, list(enumerate(lines)))
    seen, check = [], line_dedup.near_pairs
    monkeypatch.setattr(line_dedup, "near_pairs", lambda pairs, own: seen.append(pairs.count()) or check(pairs, own))
    roots = components([line_set(x) for x in lines])
    for paired in (line_dedup.PAIRED, 1):  # 1: leaders and rare shingles alone
        monkeypatch.setattr(line_dedup, "PAIRED", paired)
        seen.clear()
        rows = {r.doc_id: r.keep_doc_id for r in line_dedup.dedup_lines(docs).collect()}
        assert sum(seen) < 20 * len(lines)
        assert all(roots[i] == roots[k] for i, k in rows.items())
        assert len(set(roots)) <= len(set(rows.values())) <= 1.01 * len(set(roots))


def test_rare_shingles_bring_linked_lines_together(spark):
    lines = template_lines(300)
    lines += [x[:-2] for x in lines[::7]] + [x + " nine" for x in lines[::11]]
    table = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    rows = table.select(F.lit(1).cast("long").alias("key"), F.struct("node").alias("x"), F.col("node").alias("component"))
    keys = [collections.defaultdict(set), collections.defaultdict(set)]
    for own, part in zip(keys, line_dedup.by_rare_shingles(rows, table), strict=True):
        for r in part.collect():
            own[r.x.node].add(r.key)
    sets = [line_set(x) for x in lines]
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) * 4 >= 3 * len(sets[a] | sets[b])]
    assert len(linked) > 60
    assert all(keys[0][a] & keys[1][b] or keys[0][b] & keys[1][a] for a, b in linked)


def common_words(rng):
    pool = [a + b for a in ("tion", "ing", "the", "and", "ent", "sor", "qui", "mel") for b in ("er", "on", "al", "is", "ou", "ap", "yk", "ub")]
    return " ".join(rng.choice(pool) + rng.choice("bcdfgklmprstvz") for _ in range(40))


def test_finer_bands_bring_linked_lines_together(spark):
    """Lines that share a band by common shingles alone get few rows there: by rare shingles alone it was 50 a line and more."""
    rng = random.Random(9)
    lines = [common_words(rng) for _ in range(300)]
    lines += [x[:40] + "Q" + x[41:] for x in lines[::6]] + [x[20:] for x in lines[::10]]
    table = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    sketched = line_dedup.sketches(table).withColumn("band", F.lit(0))
    rows = sketched.select(F.lit(1).cast("long").alias("key"), F.struct("node", *line_dedup._FACTS, "band").alias("x"),
                           F.col("node").alias("component"))
    keys = [collections.defaultdict(set), collections.defaultdict(set)]
    for own, part in zip(keys, line_dedup.by_finer_bands(rows, table), strict=True):
        for r in part.collect():
            own[r.x.node].add(r.key)
    sets = [line_set(x) for x in lines]
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) * 4 >= 3 * len(sets[a] | sets[b])]
    assert len(linked) > 60
    assert all(keys[0][a] & keys[1][b] or keys[0][b] & keys[1][a] for a, b in linked)
    assert sum(map(len, keys[0].values())) < 40 * len(lines)


def test_pairs_of_large_bands_are_found_in_both_ways(spark, monkeypatch):
    """Lines of a large band that meet in one task, and those of a band too large for that: no linked pair is lost."""
    rng = random.Random(9)
    lines = [common_words(rng) for _ in range(300)]
    lines += [x[:40] + "Q" + x[41:] for x in lines[::6]] + [x[20:] for x in lines[::10]] + [lines[0] + " " + 30 * "x"] * 2
    table = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    x = F.struct("node", *line_dedup._FACTS, "band")
    rows = line_dedup.sketches(table).withColumn("band", F.lit(0)).select(
        F.lit(1).cast("long").alias("key"), F.lit(len(lines)).cast("long").alias("n"), x.alias("x"), F.col("node").alias("component"))
    sets = [line_set(x) for x in lines]
    linked = {(b, a) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) * 4 >= 3 * len(sets[a] | sets[b])}
    assert len(linked) > 60
    found = []
    for within, paired in ((1 << 15, 64), (1 << 15, 2), (1, 64), (1, 2)):
        monkeypatch.setattr(line_dedup, "WITHIN", within)
        monkeypatch.setattr(line_dedup, "PAIRED", paired)
        found.append({(r.a, r.b) for r in line_dedup.finer_pairs(rows, table).collect()})
        assert linked <= found[-1] and all(a < b for a, b in found[-1])
    assert found[0] == found[2] and len(found[0]) < 2 * len(linked)
    together = rows.withColumn("component", F.lit(7))
    assert line_dedup.finer_pairs(together, table).count() == 0


def test_whole_sets_are_compared(spark, monkeypatch):
    rng = random.Random(4)
    lines = ["".join(rng.choice("ab c\u00e9\U0001f600") for _ in range(n)) for n in (0, 1, 4, 5, 6, 40, 40, 300, 2000)]
    lines += [x[:k] + "z" + x[k + 1:] for x in lines for k in (2, 9, 30)] + [x + x[:7] for x in lines] + ["abcd", "abcde", "aaaaaaa", "aaaaaa"]
    table = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    pairs = spark.createDataFrame([(a, b) for b in range(len(lines)) for a in range(b)], "a long, b long")
    sets = [line_set(x) for x in lines]
    want = {(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) * 4 >= 3 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in line_dedup.near_pairs(pairs, table).collect()} == want
    whole = line_dedup._set_of_each(lines)
    for piece in (1, 7, 100):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        assert (line_dedup._set_of_each(lines) == whole).all()
    every = pa.RecordBatch.from_pydict({"line_a": lines, "line_b": lines[::-1]})
    assert pa.Table.from_batches(line_dedup._parts(every)).equals(pa.Table.from_batches([every]))


def test_stored_tables_leave_no_shuffle_files(spark):
    """They took more disk than the tables themselves until the driver collected its garbage."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", blocks.getAllFiles().mkString(" ")))
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    was = spark.conf.get(name, None)
    counted = stored(spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert spark.conf.get(name, None) == was
    assert counted.count() == 1000 and counted.join(counted, "k").count() == 1000


def test_only_lines_that_are_asked_for_are_shuffled(spark):
    lines = spark.range(20_000).select(F.col("id").alias("node"), F.col("id").cast("string").alias("line"))
    nodes = lines.select("node").where("node % 100 = 7")
    assert {r.node for r in maybe_among(lines, nodes, "node").collect()} >= set(range(7, 20_000, 100))
    assert maybe_among(lines, nodes, "node").count() < 6000
    assert sorted(r.node for r in line_dedup._texts(lines, nodes).collect()) == list(range(7, 20_000, 100))


def test_cleaned_texts(docs):
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(docs.where("doc_id in (18, 19, 20)")).collect()}
    assert got[18] == "line one of it\n" and got[19] == "same line that stands in many texts" and got[20] == "other"


def test_cleaned_texts_of_null_and_repeated_ids(spark):
    rows = [(None, "only the row without an id has it\nshared line"), (None, "another row without an id"), (5, "shared line\nfifth b"),
            (5, "a first text of five\nshared line"), (5, "a first text of five\nshared line"), (7, "shared line")]
    got = [tuple(r) for r in line_dedup.without_repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted([
        (None, "only the row without an id has it"), (None, "another row without an id"),
        (5, "a first text of five\nshared line"), (5, "fifth b"),
    ], key=repr)


def test_oracle_of_dedup(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.sql(ORACLES["op4_exact_dedup"])
    cols, want = result.columns, result.fetchall()
    got = [tuple(r[c] for c in cols) for r in QUERIES["op4_exact_dedup"](spark, SF).collect()]
    assert sorted(got) == sorted(want)
