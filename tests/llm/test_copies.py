"""Suffix dedup, n-gram join, near passages and near vectors against plain versions, with odd and with hot groups."""

from __future__ import annotations

import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from warcaudit.llm import caps, graph, jaccard, passages, suffixes  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
TEXTS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(4)
    base = [f"b{k}" for k in range(60)]
    near = []
    for k in range(80):
        copy = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 9])):
            copy[rnd.randrange(60)] = f"e{rnd.random()}"
        near.append((2_000_000 + k, " ".join(copy)))
    common = " ".join(f"line{k}" for k in range(20))
    mixed = [(3_000_000 + k, " ".join(f"u{k}.{j}" for j in range(rnd.randrange(12))) + " " + common) for k in range(60)]
    odd = [(4_000_000, "x" * 1000), (4_000_001, "ab" * 300), (4_000_002, None), (4_000_003, ""), (4_000_004, "é" * 120), (4_000_005, "y" * 99),
           (4_000_006, "y" * 99), (4_000_007, "One two"), (4_000_008, "one TWO"), (4_000_009, " \t "), (4_000_010, "the of " * 9000)]
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return real.unionByName(spark.createDataFrame(near + mixed + odd, TEXTS)).cache()


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_components_are_those_of_all_pairs(docs, width, percent):
    rows = jaccard.classes(docs, width=width, percent=percent).collect()
    want = brute.jaccard_components([(r.doc_id, r.text) for r in docs.collect()], width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(want)
    assert all(r.kept == (r.component_id == r.doc_id) for r in rows)


def test_every_similar_pair_shares_a_signature():
    """The guarantee itself, on random sets at the threshold."""
    rng = np.random.default_rng(3)
    for percent in (80, 85, 95):
        for size in (*range(1, 40), 60, 100, 235, 300, 700):
            small = rng.integers(1, 2**63, size, dtype=np.uint64)
            for removed in range(size):
                if 100 * (size - removed) < percent * size:
                    break
            added = 0
            while 100 * (size - max(removed - 1, 0)) >= percent * (size + added + 1):
                added += 1
            other = np.concatenate([small[max(removed - 1, 0):], rng.integers(1, 2**63, added, dtype=np.uint64)])
            both = len(np.intersect1d(small, other))
            if 100 * both < percent * (len(small) + len(other) - both):
                continue
            sets = [np.unique(small), np.unique(other)]
            sigs, owner = jaccard._signatures(np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets])), np.array([1, 2], np.uint64), percent)
            assert np.intersect1d(sigs[owner == 1], sigs[owner == 2]).size


def test_deduplicated_rows(spark, docs):
    extra = docs.withColumn("_set", F.lit("clash")).withColumn("node", F.lit(1))
    twice = extra.unionByName(extra.limit(5)).unionByName(spark.createDataFrame([(None, "one two", "x", 1), (None, "alone here", "x", 1)], "doc_id long, text string, _set string, node int"))
    kept = jaccard.deduplicate(twice)
    assert kept.columns == twice.columns
    want = brute.jaccard_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    # Texts without words are linked with nothing, so all of them stay; a row without id stays where it is alone.
    got = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert got == sorted(i for i, (_, c) in want.items() if c == i)
    assert [r.text for r in kept.filter("doc_id is null").collect()] == ["alone here"]
    assert jaccard.deduplicate(docs.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in graph.components(links).collect()} == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}
    assert graph.components(links.limit(0)).count() == 0


def digests(df):
    rows = df.select("doc_id", "n_bytes", F.expr("n_bytes - octet_length(kept)").alias("gone"), F.size("spans").alias("runs"), F.sha2("kept", 256).alias("sha"))
    return {r.doc_id: tuple(r)[1:] for r in rows.collect()}


def test_what_is_left_without_repeats(docs):
    assert digests(suffixes.remove_repeats(docs)) == brute.without_repeats([(r.doc_id, r.text) for r in docs.collect()])


def test_repeats_in_crowds_segments_and_odd_rows(spark, monkeypatch):
    """An anchor with many runs, a text over several segments, repeated rows, equal ids, rows without id."""
    rnd = random.Random(9)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(130))
    rows = [(k, "".join(rnd.choice("ijklmnop") for _ in range(200)) + line[rnd.randrange(20):] + str(k)) for k in range(40)]
    rows += [(50, "".join(rnd.choice("qrstuv") for _ in range(3000)) + rows[3][1] + rows[3][1])]
    monkeypatch.setattr(suffixes, "CROWD", 5)
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    monkeypatch.setattr(suffixes, "slices", lambda offsets: [(k, k + 1) for k in range(len(offsets) - 1)])
    df = spark.createDataFrame(rows, TEXTS)
    want = brute.without_repeats(rows)
    assert digests(suffixes.remove_repeats(df)) == want
    again = suffixes.remove_repeats(df.unionByName(df.limit(3)).unionByName(spark.createDataFrame([(None, rows[0][1])], TEXTS)))
    found = again.select("doc_id", F.expr("n_bytes - octet_length(kept)").alias("gone")).collect()
    assert len(found) == len(rows) + 4
    assert all(r.gone == (want[r.doc_id][1] if r.doc_id is not None else len(rows[0][1])) for r in found)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [3, 40])
def test_a_passage_with_many_variants_and_surroundings(spark, monkeypatch, crowd):
    """Its anchors are crowded, and stay so for several rounds of splitting."""
    rnd = random.Random(4)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(260))
    rows = []
    for k in range(250):
        copy = list(line)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(260)] = rnd.choice("XYZ")
        a, b = sorted((rnd.randrange(261), rnd.randrange(261)))
        part = copy[a if rnd.random() < 0.5 else 0: b if rnd.random() < 0.3 else 260]
        rows.append((k, "".join(rnd.choice("ijklmnop") for _ in range(rnd.randrange(120))) + "".join(part) + "".join(rnd.choice("qrstuv") for _ in range(rnd.randrange(120)))))
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    assert digests(suffixes.remove_repeats(spark.createDataFrame(rows, TEXTS).repartition(6))) == brute.without_repeats(rows)


@pytest.mark.parametrize("known", [(0, 0), (38, 0), (19, 37), (0, 75), (76, 0)])
def test_parts_of_a_run_hold_all_its_windows_once(known):
    rnd = random.Random(2)
    before, behind = known
    for _ in range(50):
        place = rnd.randint(before, suffixes.LENGTH)
        last = place - before
        first = max(0, place - (suffixes.LENGTH - suffixes.GRAM - behind))
        body = bytes(rnd.choice(b"abc") for _ in range(last + suffixes.LENGTH))[first:]
        parts = list(suffixes._split(1, body, before, behind, place - first, suffixes.LENGTH, suffixes.GRAM))
        assert sorted(s for _, start, size, _, _ in parts for s in range(start, start + size)) == list(range(last - first + 1))
        for _, start, size, b, a in parts:
            assert before + behind + (b > before or a > behind) <= b + a or before + behind == suffixes.LENGTH - suffixes.GRAM
            assert all(b <= place - first - s and a <= suffixes.LENGTH - suffixes.GRAM - (place - first - s) for s in range(start, start + size))


@pytest.mark.parametrize("seed", range(20))
def test_interval_expansion(seed):
    rnd = random.Random(seed)
    length = rnd.choice([3, 5, 10])
    base = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 30))) for _ in range(4)]
    texts = [b"".join(rnd.choice(base) for _ in range(rnd.randint(0, 3)))[:60] for _ in range(rnd.randint(1, 6))]
    got = defaultdict(list)
    for text, start, group in zip(*(x.tolist() for x in suffixes.repeated_windows(texts, length))):
        got[group].append((text, start))
    want = defaultdict(list)
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            want[t[k: k + length]].append((i, k))
    assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


@pytest.mark.parametrize("seed", range(20))
def test_compact_windows_are_the_cartesian_tree(seed):
    rng = np.random.default_rng(seed)
    first = np.append(0, np.cumsum(rng.integers(0, 40, 4)))
    hashes, width = rng.integers(0, 2**64 - 1, first[-1], dtype=np.uint64), int(rng.integers(1, 9))
    want = []

    def split(low, high, row):
        if high - low + 1 >= width:
            least = low + int(np.argmin(hashes[low: high + 1]))
            want.append((least, low, high, row))
            split(low, least - 1, row)
            split(least + 1, high, row)

    for row in range(4):
        split(int(first[row]), int(first[row + 1]) - 1, row)
    assert sorted(zip(*(x.tolist() for x in passages.compact_windows(hashes, first, width)))) == sorted(want)


def test_passages_that_meet_under_one_function(spark):
    """One word in 50 is another: some of these pairs have the same least shingle under one of the six functions only."""
    rnd = random.Random(11)
    fill = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(9000):
        passage = fill(50)
        copy = list(passage)
        copy[rnd.randrange(5, 45)] = "edited"
        texts += [" ".join(fill(20) + p + fill(20)).encode() for p in (passage, copy)]
    shingles, first, _ = passages._sequence(np.append(0, np.cumsum([len(t) for t in texts])), np.frombuffer(b"".join(texts), np.uint8))
    met = np.zeros(9000, np.int64)
    for seed in passages._SEEDS[: passages.FUNCTIONS]:
        at, _, _, row = passages.compact_windows(passages.mix(shingles ^ seed), first, passages.LEAST - passages.WIDTH + 1)
        keys = [set() for _ in texts]
        for r, s in zip(row.tolist(), shingles[at].tolist()):
            keys[r].add(s)
        met += [bool(keys[2 * k] & keys[2 * k + 1]) for k in range(9000)]
    rows = [(j, texts[j].decode()) for k in np.flatnonzero(met == 1).tolist() for j in (2 * k, 2 * k + 1)]
    assert rows
    found = passages.near_passages(spark.createDataFrame(rows, TEXTS)).collect()
    assert {(r.of_doc_id, r.doc_id) for r in found} == {(j, j + 1) for j, _ in rows[::2]}


def test_planted_passages(spark):
    rnd = random.Random(2)
    fill = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    rows, planted = [], []
    for i in range(30):
        passage = fill(55)
        for k in range(3):
            copy = list(passage)
            if i % 2 and k:
                copy[20] = f"edited{k}"
            planted.append((len(rows), len(rows) - k))
            rows.append((len(rows), " ".join(fill(rnd.randint(20, 200)) + copy + fill(rnd.randint(20, 200)))))
    clean = range(len(rows), len(rows) + 80)
    rows += [(k, " ".join(fill(300))) for k in clean]
    odd = [(9_000_000, None), (9_000_001, ""), (9_000_002, "few words"), (None, rows[0][1]), rows[0]]
    found = passages.near_passages(spark.createDataFrame(rows + odd, TEXTS)).collect()
    caught = {r.doc_id for r in found} | {r.of_doc_id for r in found}
    assert caught == {i for i, _ in planted} and not caught & set(clean)
    texts = dict(rows)
    for r in found:
        assert r.of_doc_id < r.doc_id and r.similarity >= 0.8 and r.end_word - r.start_word >= 50
        left, right = (brute.shingle_set(" ".join(texts[i].split()[a:b]), 5) for i, a, b in (
            (r.doc_id, r.start_word, r.end_word), (r.of_doc_id, r.of_start_word, r.of_end_word)))
        assert abs(len(left & right) / len(left | right) - r.similarity) < 1e-9
    assert passages.near_passages(spark.createDataFrame([], TEXTS)).count() == 0


def test_every_copy_of_a_passage_has_a_row(spark):
    rnd = random.Random(6)
    fill = lambda n: [f"w{rnd.random()}" for _ in range(n)]
    rows, places = [], {}
    for i in range(12):
        passage = fill(60)
        rows.append((2 * i, " ".join(fill(80) + passage + fill(80))))
        words, places[2 * i + 1] = fill(70), []
        for gap in (90, 700, 40):
            places[2 * i + 1].append(len(words))
            words += passage + fill(gap)
        rows.append((2 * i + 1, " ".join(words)))
    found = passages.near_passages(spark.createDataFrame(rows, TEXTS)).collect()
    got = {(r.doc_id, r.start_word, r.end_word, r.of_doc_id) for r in found}
    assert got == {(i, p, p + 60, i - 1) for i, starts in places.items() for p in starts}


def variant_rows(seed, variants, copies, length=60, slots=(0.45, 0.55)):
    """A passage whose words at some places differ by variant, each variant in several documents of other words."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    base, texts = [word() for _ in range(length)], []
    for _ in range(variants):
        passage = list(base)
        for slot in slots:
            passage[int(slot * length)] = word()
        texts += [" ".join([*[word() for _ in range(50)], *passage, *[word() for _ in range(50)]]) for _ in range(copies)]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize(("variants", "copies", "more"), [
    (10, 20, {}), (50, 10, {}), (10, 20, {"slots": (0.2, 0.8)}), (30, 3, {}), (10, 20, {"length": 100}), (10, 20, {"slots": (0.05, 0.5)})])
def test_variants_of_a_passage_do_not_hide_each_other(spark, variants, copies, more):
    """Every document holds an exact copy of another's passage, but most that share its shingles have another variant."""
    rows = variant_rows(variants, variants, copies, **more)
    found = passages.near_passages(spark.createDataFrame(rows, TEXTS).repartition(4)).collect()
    caught = {i for r in found for i in (r.doc_id, r.of_doc_id)}
    assert len(rows) - len(caught) <= 0.01 * len(rows)
    assert all(r.similarity >= 0.8 for r in found)


def test_documents_with_passages_are_those_of_all_pairs(spark):
    """All pairs of documents compared in full: the query finds the same documents, and pairs that are among those."""
    rows = variant_rows(3, 6, 4, slots=(0.3, 0.6)) + [(100 + i, t) for i, t in variant_rows(4, 12, 1, slots=(0.5,))]
    rows += [(200 + i, t) for i, t in variant_rows(5, 1, 5, length=48)] + [(300, "a b c"), (301, None)]
    texts = {i: t.encode() for i, t in rows if t}
    shingles = {}
    for i, t in texts.items():
        shingles[i] = passages._sequence(np.array([0, len(t)]), np.frombuffer(t, np.uint8))[0]
    want = {(b, a) for a in shingles for b in shingles if a < b and passages.passages(shingles[a], shingles[b], 50, 0.8)}
    found = {(r.doc_id, r.of_doc_id) for r in passages.near_passages(spark.createDataFrame(rows, TEXTS)).collect()}
    assert found <= want and {i for pair in found for i in pair} == {i for pair in want for i in pair} and len(want) > 50


def planted_windows(seed):
    """Sequences around one shingle, as windows of a key: variants with changed, added and left out places, and repeats."""
    rng = np.random.default_rng(seed)
    base = np.arange(1, 1 + int(rng.integers(50, 110)), dtype=np.uint64)
    rows = []
    for k in range(int(rng.integers(9, 26))):
        row = base[int(rng.integers(0, 30)): len(base) - int(rng.integers(0, 15))].copy()
        for _ in range(int(rng.integers(0, 5))):
            at = int(rng.integers(0, len(row)))
            row[at: at + 5] = rng.integers(500, 510 if k % 3 else 2**40, len(row[at: at + 5])).astype(np.uint64)
        if k % 4 == 1:
            row = np.delete(row, slice(20, 20 + int(rng.integers(1, 9))))
        if k % 4 == 2:
            row = np.insert(row, min(25, len(row)), rng.integers(2**41, 2**42, int(rng.integers(1, 20))).astype(np.uint64))
        if k % 5 == 3:
            row = np.concatenate([row, row[: int(rng.integers(1, len(row)))]])
        if k % 7 == 6:
            row = np.repeat(row[:4], int(rng.integers(1, 30)))
        rows.append(np.concatenate([rng.integers(2**43, 2**44, int(rng.integers(0, 30))).astype(np.uint64), row]))
    return rows + [rows[0].copy(), np.append(rows[1], np.uint64(7))]


def roots(n, pairs):
    root = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("seed", range(60))
def test_windows_of_a_crowd_are_joined_like_all_pairs(seed):
    rows = planted_windows(seed)
    docs = np.arange(len(rows))
    want = {(a, b) for a in docs for b in docs if a < b and passages.passages(rows[a], rows[b], 50, 0.8)}
    first = np.append(0, np.cumsum([len(r) for r in rows]))
    got = passages.joined(np.concatenate(rows), first, docs, 50, 0.8)
    assert set(got) <= want and roots(len(rows), got) == roots(len(rows), want)


def test_rows_that_share_a_line_only_are_not_compared():
    """Of 400 rows with the same ten shingles, only two that share a passage are; and those with a row that repeats the line all may be."""
    rng = np.random.default_rng(8)
    fresh = lambda n: rng.integers(1, 2**63, n).astype(np.uint64)
    line, passage = fresh(10), fresh(60)
    rows = [np.concatenate([fresh(60), line, passage if k in (7, 9) else fresh(60)]) for k in range(400)]
    first = np.append(0, np.cumsum([len(r) for r in rows]))
    alive, usual, low = passages._may_join(np.concatenate(rows), first, 50, 0.8)
    assert np.flatnonzero(alive).tolist() == np.flatnonzero(usual).tolist() == [7, 9] and not low.any()
    assert passages.joined(np.concatenate(rows), first, np.arange(400), 50, 0.8) == [(7, 9)]
    rows.append(np.tile(line, 9))
    first = np.append(first, first[-1] + 90)
    alive, usual, low = passages._may_join(np.concatenate(rows), first, 50, 0.8)
    assert alive.all() and np.flatnonzero(usual).tolist() == [7, 9] and np.flatnonzero(low).tolist() == [400]


@pytest.mark.parametrize(("block", "length", "slots"), [(8, 60, 1), (1024, 80, 2)])
def test_variants_of_a_passage_are_joined_like_all_pairs(spark, monkeypatch, block, length, slots):
    """Twelve passages of which every document has its own variant: rows join the documents that all pairs join."""
    monkeypatch.setattr(passages, "BLOCK", block, raising=False)
    rnd = random.Random(slots)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(length)]
        for _ in range(24):
            passage = list(base)
            for slot in rnd.sample(range(4, length - 4), slots):
                passage[slot] = word()
            texts.append(" ".join([*[word() for _ in range(40)], *passage, *[word() for _ in range(40)]]))
    texts += texts[:2]
    rnd.shuffle(texts)
    n = len(texts)
    shingles = [passages._sequence(np.array([0, len(t)]), np.frombuffer(t.encode(), np.uint8))[0] for t in texts]
    sets = [set(x.tolist()) for x in shingles]
    want = {(a, b) for a in range(n) for b in range(a + 1, n) if sets[a] & sets[b] and passages.passages(shingles[a], shingles[b], 50, 0.8)}
    found = {(r.of_doc_id, r.doc_id) for r in passages.near_passages(spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(3)).collect()}
    assert found <= want and roots(n, found) == roots(n, want) and len(want) > 1000


def test_neighbouring_passages_do_not_hide_each_other():
    a = np.arange(116, dtype=np.uint64)  # shingles of 120 words
    b = a.copy()
    for first, last in ((30, 30), (56, 63), (90, 90)):  # changed words
        b[first - 4: last + 1] += np.uint64(1000)
    found = passages.passages(a, b, 50, 0.8)
    assert [(p, q) for p, q, *_ in found] and all(s >= 0.8 and q - p >= 46 for p, q, _, _, s in found)
    assert {k for p, q, *_ in found for k in range(p, q)} >= set(range(52))


@pytest.mark.parametrize("seed", range(150))
def test_passages_cover_those_of_all_parts(seed):
    """Every part of a stretch, from one shared place to another, that is long and similar enough is in a passage."""
    rng = np.random.default_rng(seed)
    a = np.arange(rng.integers(46, 160), dtype=np.uint64)
    b = a.copy()
    for _ in range(rng.integers(1, 7)):
        at = int(rng.integers(0, len(b)))
        size = len(b[at: at + int(rng.integers(1, passages.GAP + 1))])
        b[at: at + size] = rng.integers(10_000, 2**40, size).astype(np.uint64)
    same = np.flatnonzero(a == b)
    pieces = np.split(same, np.flatnonzero(np.diff(same) > passages.GAP + 1) + 1)
    want = set()
    for piece in pieces:
        for i, p in enumerate(piece):
            for j in range(i, len(piece)):
                n = int(piece[j] - p) + 1
                if n >= 46 and (j - i + 1) / (2 * n - (j - i + 1)) >= 0.8:
                    want |= set(range(p, p + n))
    found = passages.passages(a, b, 50, 0.8)
    assert {k for p, q, *_ in found for k in range(p, q)} == want and all(s >= 0.8 and q - p >= 46 for p, q, _, _, s in found)


def test_exact_repeats_are_near_passages(spark, docs):
    """Of the documents that share fifty words in a row with another, nearly all are found; runs of one word may not be."""
    seen, repeated = {}, set()
    for r in docs.collect():
        w = brute.words(r.text)
        for k in range(len(w) - 49):
            window = tuple(w[k: k + 50])
            if seen.setdefault(window, r.doc_id) != r.doc_id and len(set(window)) > 25:
                repeated |= {seen[window], r.doc_id}
    found = passages.near_passages(docs).select("doc_id", "of_doc_id").collect()
    caught = {i for r in found for i in r}
    assert len(repeated) > 50 and len(repeated - caught) <= 0.01 * len(repeated)


VECTORS = "vec_id long, embedding array<float>, label int, n_links string"


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(caps, "BLOCK", 8)  # the close group is dealt out as many pairs of blocks
    centre = rng.standard_normal(32)
    close = centre + rng.standard_normal((50, 32)) * 0.25
    vectors = [*rng.standard_normal((300, 32)), *close, *(close[:20] + rng.standard_normal((20, 32)) * 0.2)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(1000, rows[3][1]), (1001, [x * 2 for x in rows[3][1]]), (1002, None), (1003, []), (1004, [0.0] * 32), (1005, [float("nan")] * 32),
             (1006, [None] * 32), (1007, [1.0, 0.0]), (1008, [1.0, 0.0]), (1009, [float("inf")] * 32)]
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near(df).collect()}
    stored = {r.vec_id: r.embedding for r in df.collect()}
    want = brute.cosine_links(list(stored), list(stored.values()))
    assert got.keys() == want.keys()
    found, all_ = sum(n for n, _, _ in got.values()), sum(n for n, _, _ in want.values())
    assert all_ > 500 and 0.98 * all_ <= found <= all_ and all(got[i][0] <= want[i][0] for i in got)
    assert got[1000][1] == 3 and got[1008][:2] == (1, 1007) and all(got[i] == (0, i, True) for i in (1002, 1003, 1004, 1005, 1006, 1009))
    odd = df.unionByName(df.limit(2)).unionByName(spark.createDataFrame([(None, rows[0][1], 0, "x")], VECTORS))
    assert caps.near(odd).count() == df.count() + 3 and caps.near(df.limit(0)).count() == 0


@pytest.mark.parametrize("nodes", [500, 50_000, 5_000_000])
def test_recall_at_the_threshold(nodes):
    rng = np.random.default_rng(3)
    filters = caps.Filters(64, caps.code_words(nodes))
    x, z = caps._unit(rng.standard_normal((400, 64))), rng.standard_normal((400, 64))
    z = caps._unit(z - (z * x).sum(1, keepdims=True) * x)
    pairs = zip(filters.of(x), filters.of(0.9 * x + np.sqrt(1 - 0.81) * z))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.98
