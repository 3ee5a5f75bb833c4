"""Periodic runs, centroid clusters and id files: each against a plain version, with odd rows."""

from __future__ import annotations

import hashlib
import random
import struct
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from warcaudit.llm import boundaries, centroids, idfiles, queries, tandems  # noqa: E402
from warcaudit.llm.oracles import all_oracles  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, periodic string, ids string, doc string, start long"
ODD = ["", "  \n", None, "a", "a a a a a", "a a a a a a", "x ha ha ha ha ha ha y", "A a A a A a A a", "ab c ab c ab c ab",
       "q a a a a a a q a a a a a a q a a a a a a q a a a a a a q", "tab\tnew\nline\x0bx\x0cy\rz", "é é é é é é\xa0é", "one " * 30_000,
       " ".join("abcabcabc" * 4_000), "<|endoftext|> it's 12345 ﬁ 日本語 😀", "w" * 5_000, "\x00 \x1c \x85"]


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(1_000_000 + k, t) for k, t in enumerate(ODD)]
    odd += [(None, "a b c"), (None, None), odd[6], odd[6], (-5, "minus minus"), (7, "another text of seven"), (2**62, "far")]
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    clash = {"periodic": F.lit("x"), "ids": F.lit("x"), "doc": F.lit("x"), "start": F.lit(1).cast("long")}
    return real.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumns(clash).cache()


# ---- runs ---------------------------------------------------------------------------------------
def period_words(doc_id, words):
    """The words as the contract of the query has them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def run_row(doc_id, text):
    words = period_words(doc_id, brute.plain_words(text))
    found = brute.periodic_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_small_alphabets():
    pick = random.Random(5)
    for _ in range(1_500):
        texts = []
        for _ in range(pick.randint(1, 6)):
            n, k = pick.choice([0, 1, 2, 5, 10, 30, 70]), pick.choice([1, 2, 3, 5])
            words = [b"%d" % pick.randrange(k) for _ in range(n)]
            if n and pick.random() < 0.5:
                a, p = pick.randrange(n), pick.randint(1, max(1, n // 4))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        counts, fields, _ = tandems._slice(texts, 4, 6)
        got, at = list(zip(*[f.tolist() for f in fields])), 0
        for words, n in zip(texts, counts):
            assert got[at: at + n] == brute.periodic_runs(words)
            at += n


def test_run_query_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = {r.doc_id: run_row(r.doc_id, r.text) for r in docs.collect()}
    # Written, as a plan that is only collected leaves out what a plan that is written does.
    queries.op11_periodic_runs(spark, FOLDER).write.parquet(str(tmp_path / "runs"))
    rows = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert len(rows) == len(want) and sum(r.n_runs for r in rows) > 10
    assert {r.doc_id: tuple(r) for r in rows} == want


def test_runs_of_odd_rows(spark, docs):
    plain = tandems.find_runs(docs)
    assert plain.columns == docs.columns and plain.count() == docs.count()
    for r in plain.filter("doc_id >= 1000000 or doc_id is null").select("text", "periodic.*").collect():
        words = brute.plain_words(r.text)
        assert r.n_words == len(words)
        if len(words) < 1_000:
            assert [tuple(x) for x in r.runs] == brute.periodic_runs(words)
    long = {r.n_words: r for r in plain.select("periodic.*").collect()}
    assert [tuple(x) for x in long[30_000].runs] == [(0, 30_000, 1)] and long[30_000].collapsed == "one"
    assert [tuple(x) for x in long[36_000].runs] == [(0, 36_000, 3)] and long[36_000].collapsed == "a b c"
    assert tandems.find_runs(docs.limit(0)).count() == 0


def test_periods_that_the_contract_plants(spark, docs):
    rows = tandems.with_periods(docs).collect()
    assert len(rows) == docs.count()
    before = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id in before and r.doc_id != 7:
            assert brute.plain_words(r.text) == period_words(r.doc_id, brute.plain_words(before[r.doc_id]))


# ---- clusters -----------------------------------------------------------------------------------
def test_tree_finds_the_nearest_and_the_smallest_number():
    pick = np.random.default_rng(3)
    for k in (1, 2, 5, 16, 100):
        points = pick.integers(-3, 4, (k, 4))
        points[k // 2:] = points[: k - k // 2]
        vectors = pick.integers(-4, 5, (500, 4))
        away = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
        number, squared = centroids.VantageTree(points).nearest(vectors)
        assert (number == away.argmin(axis=1)).all() and (squared == away.min(axis=1)).all()


def test_tree_of_large_numbers_is_exact():
    pick = np.random.default_rng(4)
    points = pick.integers(-centroids.LARGEST, centroids.LARGEST, (40, 64))
    vectors = np.concatenate([points[:20] + 1, (points[:20] + points[20:]) // 2])
    number, squared = centroids.VantageTree(points).nearest(vectors)
    away = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, p)) for p in points] for v in vectors]
    assert [min(row) for row in away] == squared.tolist() and [row.index(min(row)) for row in away] == number.tolist()


def lloyd(rows, k, rounds):
    kept = [(i, [int(np.floor(np.float64(x) * 64)) for x in v]) for i, v in rows]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in order[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        members = [[] for _ in middle]
        for _, v in kept:
            members[place(v)[1]].append(v)
        middle = [[sum(x) // len(g) for x in zip(*g)] if g else m for g, m in zip(members, middle)]
    return [(i, *place(v)[::-1]) for i, v in kept], middle


def test_clusters_of_odd_vectors(spark):
    pick = np.random.default_rng(9)
    rows = [(k, [float(x) for x in pick.normal(size=4)]) for k in range(60)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (0, rows[0][1]), (None, rows[3][1]), (101, [0.0] * 4), (102, [-0.015625] * 4)]
    wrong = [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 1.0, 1.0]), (204, [float("nan")] * 4), (205, [float("inf")] * 4), (None, None)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + wrong], "vec_id long, embedding array<double>, cluster string, centroid int")
    got = centroids.cluster(df, k=5, rounds=3, dimensions=4)
    want, middle = lloyd(rows, 5, 3)
    found = got.collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found) == sorted((i is None, i or 0, c, d) for i, c, d in want)
    for r in found:
        assert r.centroid == middle[r.cluster] and r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
    few = centroids.cluster(df.filter("vec_id < 3"), k=16, dimensions=4)
    assert few.count() == 5 and {r.distance for r in few.collect()} == {0}
    for none in (df.limit(0), df.filter("vec_id > 199"), df.filter("vec_id is null")):
        assert centroids.cluster(none, dimensions=4).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>"), dimensions=4)


def test_cluster_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
    answer = con.execute(all_oracles()["op12_centroids"])
    names = [d[0] for d in answer.description]
    want = sorted(answer.fetchall())
    got = queries.op12_centroids(spark, FOLDER).select(*names).collect()
    assert sorted(tuple(r) for r in got) == want and len({r.cluster for r in got}) > 5


# ---- id files -----------------------------------------------------------------------------------
@pytest.mark.parametrize("high", [1, 2, 1_000, 1 << 40, (1 << 64) - 1])
def test_codes_of_boundaries(high):
    pick = np.random.default_rng(high % 97)
    for n in (0, 1, 63, 64, 65, 5_000):
        values = np.sort(pick.integers(0, high, n, dtype=np.uint64, endpoint=True))
        code = boundaries.EliasFano.from_bytes(boundaries.EliasFano.of(values).to_bytes())
        k = pick.permutation(n)
        assert len(code) == n and (code.select(k) == values[k]).all()
    with pytest.raises(IndexError):
        code.select(np.array([5_000]))


def test_codes_with_long_gaps_and_their_size():
    pick = np.random.default_rng(8)
    gaps = pick.integers(0, 3, 20_000)
    gaps[[5_000, 5_010, 19_999]] = 1 << 30
    values = np.cumsum(gaps).astype(np.uint64)
    code = boundaries.EliasFano.of(values)
    assert len(code.sparse) > 0 and (code.select(np.arange(20_000)) == values).all()
    even = np.cumsum(pick.integers(1, 1_000, 100_000)).astype(np.uint64)
    assert len(boundaries.EliasFano.of(even).to_bytes()) * 8 < 12.5 * len(even)


def in_order(docs, library):
    """Ids of each document, as the files should have them."""
    rows = [(r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in docs.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("file_ids", [idfiles.FILE_IDS, 2_000])
def test_files_hold_what_the_library_gives(spark, docs, tmp_path, monkeypatch, file_ids):
    monkeypatch.setattr(idfiles, "FILE_IDS", file_ids)
    monkeypatch.setattr(idfiles, "READ_IDS", 3_000)
    manifest = idfiles.write(docs, queries.WORD_TOKENS, queries.END_ID, str(tmp_path / "ids")).collect()
    rows = sorted(idfiles.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    want = in_order(docs, Tokenizer.from_file(queries.WORD_TOKENS))
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    assert sum(m.n_ids for m in manifest) == start == sum(len(x) for _, x in want)
    assert sorted((r.doc_id or 0, list(struct.unpack(f"<{r.n_tokens}I", r.ids))) for r in rows) == sorted((i or 0, x) for i, x in want)
    one = idfiles.IdFile(max(manifest, key=lambda m: m.n_docs).path)
    begins = one.begins(np.arange(one.n_docs + 1))
    for k in range(0, one.n_docs, 7):
        assert one.document(k).tolist() == one.ids(begins[k], begins[k + 1]).tolist()


def test_ids_of_odd_texts_are_those_of_the_library():
    """Latin texts are cut here, others by the library; both have to agree with it on everything."""
    library, own, pick = Tokenizer.from_file(queries.WORD_TOKENS), idfiles.Encoder(queries.WORD_TOKENS), random.Random(6)
    signs = [chr(c) for c in range(0x260)] + [*"ΣσςİıßſKÅﬁ日本語😀\u0301\u0307\u3000²½٣"] + ["'s", "'LL", "n't", "<|", "|>", "<|endoftext|>", " ", "\n"] * 8
    latin = [chr(c) for c in (*range(0x20, 0x7F), *range(0xA1, 0x250))] + [" ", "'"] * 30
    texts = ["".join(pick.choice(some) for _ in range(pick.randint(0, 40))) for some in (signs, latin) for _ in range(8_000)] + ["ab" * 3_000]
    for text, ids, found in zip(texts, own.encode(texts, 2), library.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, own.kind).tolist() == [*found.ids, 2], text


def test_ranges_are_even_also_where_many_rows_share_an_id(spark, tmp_path):
    rows = [(k, "x y " * (k % 50)) for k in range(2_000)] + [(700, f"text {k} of the same id") for k in range(3_000)] + [(None, "a b")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    manifest = idfiles.write(docs, queries.WORD_TOKENS, 2, str(tmp_path / "ids"), range_bytes=4_000).collect()
    found = idfiles.read(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(r[0] for r in rows if r[0] is not None) + [None] * 5
    assert len(manifest) > 30 and max(m.n_ids for m in manifest) < 3 * sum(m.n_ids for m in manifest) / len(manifest)


def test_files_of_nothing_and_files_left_by_lost_tasks(spark, docs, tmp_path):
    folder = str(tmp_path / "none")
    assert idfiles.write(docs.limit(0), queries.WORD_TOKENS, 2, folder).count() == 0 and idfiles.read(spark, folder).count() == 0
    folder = str(tmp_path / "some")
    manifest = idfiles.write(docs.limit(20), queries.WORD_TOKENS, 2, folder)
    (tmp_path / "some" / "000000-0000-lost.ids").write_bytes(b"half a file")
    assert idfiles.read(spark, folder).count() == 20 == manifest.agg(F.sum("n_docs")).first()[0]
    lost = tmp_path / "some" / "000000-0000-lost.ids"
    lost.write_bytes(b"x" * 99)
    with pytest.raises(ValueError, match="no file of token ids"):
        idfiles.IdFile(str(lost))


def test_query_of_files(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want, start = [], 0
    for i, ids in in_order(docs, Tokenizer.from_file(queries.WORD_TOKENS)):
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op13_id_files(spark, FOLDER).collect()) == want
