"""Operators 11 to 13 against brute force, the library and their SQL, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import WORD

from orbitgrain.llm import importance_resampling, periodic_runs, registry, token_files

ASCII_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def byte_level():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# 11 -----------------------------------------------------------------------


def brute_runs(w, least=24, times=3):
    """Stretches of equal words at each distance; of one stretch the smallest distance counts."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - s + q >= max(least, times * q):
                out.setdefault((s - q, i), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def repetitive(rng):
    letters, w = rng.choice([1, 2, 2, 3, 50]), []
    for _ in range(rng.randrange(0, 8)):
        u = [b"%d" % rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 5, 9, 17, 30, 40]))]
        if rng.random() < 0.3:
            u = u * rng.randrange(1, 4) + [b"x"]
        v = u * rng.randrange(1, 9)
        w += v[: rng.randrange(len(v) + 1)]
    return w


def test_op11_runs_whatever_the_chunks():
    rng, seen = random.Random(5), 0
    for _ in range(150):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 6))]
        want = [brute_runs(t) for t in texts]
        seen += sum(map(len, want))
        for chunk in (1 << 16, rng.randrange(1, 60), 1):
            assert periodic_runs.runs_of(texts, chunk) == want
    assert seen > 200


def test_op11_runs_are_known_while_words_come():
    catchers = periodic_runs.SquareCatchers(100)
    for i in range(40):
        catchers.append(np.array([i % 5]))
        assert catchers.runs() == ([(0, i + 1, 5)] if i + 1 >= 24 else [])
    catchers.append(np.array([9, 1, 2]))
    assert catchers.runs() == [(0, 40, 5)]
    with pytest.raises(ValueError):
        periodic_runs.SquareCatchers(10, least=10)


def test_op11_words_compared_one_by_one(monkeypatch):
    """Sums that always agree make longer stretches, which the words cut again."""
    texts = [[b"a", b"b"] * 20 + [b"c"] * 30]
    catchers = periodic_runs.SquareCatchers(80)
    catchers.append(np.array([0, 1] * 20 + [2] * 30))
    catchers.closed = (np.array([0]), np.array([70]), np.array([2]))
    catchers.open = (np.array([40]), np.array([70]), np.array([1]))
    assert catchers.runs() == brute_runs(texts[0])


@pytest.mark.parametrize("text", [["w"] * 200_000, (["a"] * 60_000 + ["b"]) * 3, (["a"] * 30 + ["b"]) * 3000])
def test_op11_long_repetitive_texts(text):
    got = periodic_runs.runs_of([[w.encode() for w in text]])[0]
    assert all(text[s : s + n - q] == text[s + q : s + n] for s, n, q in got)
    assert max(n for _, n, _ in got) == len(text)


def test_op11_against_sql_and_brute_force(spark, sf, documents):
    import duckdb

    got = {r.doc_id: r for r in periodic_runs.op11_periodic_runs(spark, sf).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    out = con.execute(registry.ORACLES["op11_periodic_runs"])
    names = [c[0] for c in out.description]
    assert {r[0]: dict(zip(names, r, strict=True)) for r in out.fetchall()} == {i: r.asDict() for i, r in got.items()}
    assert len(got) == len(documents) and sum(r.n_runs > 0 for r in got.values()) > 10
    for doc in documents:
        w, h = WORD.findall(doc.text or ""), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs, r = brute_runs(w), got[doc.doc_id]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (runs and 1000 * best[1] // best[2] or None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()


def test_op11_edges(edges, none):
    got = periodic_runs.find_runs(edges).collect()
    assert len(got) == edges.count() and periodic_runs.find_runs(none).count() == 0
    rows = {r.doc_id: r for r in got}
    assert (rows[1].n_words, rows[2].n_words, rows[1].runs, rows[1].strongest, rows[1].collapsed) == (0, 0, [], None, "")
    assert [tuple(x) for x in rows[9].runs] == [(0, 3000, 1)] and rows[9].collapsed == "word"
    assert rows[5].strongest.period == 10 and rows[5].collapsed == "To be, or not to be: that is the question."
    assert [tuple(x) for x in rows[8].runs] == brute_runs("漢字 and 😀 ▁ <|endoftext|> é ﬁ ".split() * 20)


def test_op11_null_ids_and_long_words(spark):
    rows = [(None, "a b " * 20), (3, "x" * 1_000_000 + " " + "y z " * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert [tuple(x) for x in got[None].runs] == [(0, 40, 2)] and [tuple(x) for x in got[3].runs] == [(1, 30, 2)]
    assert periodic_runs.planted_words(None, "a b c") == [b"a", b"b", b"a"]


# 12 -----------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 15, 16, 17, 20, 31, 32])
def test_op12_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 999, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-999 * bits // 8)
    assert (token_files.unpack(data, 999, bits) == ids).all() and (token_files.unpack(data, 300, bits, 501) == ids[501:801]).all()
    assert token_files.bits_for(1 << bits) == bits
    if bits < 32:
        with pytest.raises(ValueError):
            token_files.pack(np.array([1 << bits], np.uint64), bits)


def test_op12_encoder_is_the_library(byte_level, documents):
    encode = token_files.ByteLevelEncoder(byte_level, cache_bytes=300_000)
    rng = random.Random(1)
    odd = ["a", "B", "é", "漢", " ", " ", "  ", "\n", "\t", "\xa0", " ", "　", "'s", "'LL", "12", "\x1c", "\x1f", "\x85", "_", "#", "😀", "<|endoftext|>", "<|endof", "​", "﻿", "\r\n", "\x00", "᠎", "́"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(14))) for _ in range(5000)] + [r.text or "" for r in documents] + ["", "x" * 100_000, " " * 5000]
    got = encode(texts)
    assert [x.tolist() for x in got] == [e.ids for e in encode.tok.encode_batch(texts, add_special_tokens=False)]
    with pytest.raises(ValueError):
        import public_tokenizers

        token_files.ByteLevelEncoder(public_tokenizers.path("word_bpe_49k.json"))


def test_a_word_goes_to_the_library_once_whatever_marks_and_lines_follow(byte_level):
    encode = token_files.ByteLevelEncoder(byte_level)
    ids, sent = encode._ids, []
    encode._ids = lambda texts: (sent.extend(texts), ids(texts))[1]
    texts = ["so qwzrtl qwzrtl. qwzrtl, qwzrtl.\nvbnmkx vbnmkx!?", "vbnmkx. x's. \u00bfqwzrtl? a.\n\nb it's.' 7.) \u4e2d. \u4e2d"]
    for text in texts:
        assert encode([text])[0].tolist() == encode.tok.encode(text, add_special_tokens=False).ids
    assert sum(t.count(" qwzrtl") for t in sent) == 1 and sum(t.replace(" vbnmkx", "").count("vbnmkx") for t in sent) == 1


def test_op12_against_the_library(spark, sf, documents, byte_level):
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(byte_level), 0
    got = sorted(token_files.op12_token_files(spark, sf).collect())
    assert len(got) == len(documents)
    for r, doc in zip(got, sorted(documents, key=lambda d: d.doc_id), strict=True):
        ids = [*tok.encode(doc.text or "", add_special_tokens=False).ids, 0]
        assert tuple(r) == (doc.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def plain_encoder():
    """A maker of encoders that workers get by value, since they cannot import this module."""
    return lambda: lambda texts: [np.array([ord(c) % 1000 for c in t], np.uint32) for t in texts]


some_encoder = plain_encoder()


def test_op12_files_and_random_access(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(chr(rng.randrange(32, 1000)) for _ in range(rng.choice([0, 1, 50, 3000]))) for _ in range(300)]
    docs = spark.createDataFrame([*enumerate(texts), (7, texts[7]), (None, "null"), (500, None)], "doc_id long, text string").repartition(5)
    manifest = token_files.write_ids(docs, f"file://{tmp_path}/ids", some_encoder, 1000, file_ids=20_000)
    assert manifest.count() > 5
    rows = sorted(token_files.read_documents(manifest, with_ids=True).collect(), key=lambda r: (r.start, r.n_tokens))
    order = [(None, "null"), *sorted([*enumerate(texts), (7, texts[7])]), (500, "")]
    stream = np.concatenate([some_encoder()([t])[0] for _, t in order])
    assert sum(r.n_tokens for r in rows) == len(stream) == manifest.agg({"n_ids": "sum"}).first()[0]
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(some_encoder()([t])[0].tolist())) for i, t in order)
    assert all((stream[r.start : r.start + r.n_tokens] == r.ids).all() for r in rows)
    for first, last in ((0, 10), (19_990, 20_010), (len(stream) - 5, len(stream) + 5), (7, 7), (0, len(stream))):
        assert (token_files.read_range(manifest, first, last) == stream[first:last]).all()
    # ten bits an id, and nothing but packed ids and the index
    path = manifest.orderBy("n_ids", ascending=False).first().path
    reader = token_files.IdReader(path)
    assert reader.bits == 10 and reader.offsets[1] - reader.offsets[0] == -(-min(reader.n_ids, token_files.BLOCK) * 10 // 8)
    reader.close()


def test_op12_blocks_are_met_and_checked(tmp_path):
    ids = np.arange(200_000, dtype=np.uint32) % 5000
    writer = token_files.IdWriter(f"{tmp_path}/a.bits", 13)
    for i in range(0, len(ids), 7001):
        writer.add(i, ids[i : i + 7001])
    path, n_ids, n_docs, n_bytes = writer.close()
    reader = token_files.IdReader(path)
    assert (n_ids, n_docs, len(reader.sums)) == (200_000, 29, 4)
    seen, read_block = [], reader.read_block
    reader.read_block = lambda k: (seen.append(k), read_block(k))[1]
    assert (reader.read(65_530, 65_540) == ids[65_530:65_540]).all() and seen == [0, 1]
    assert (reader.read(190_000, 200_000) == ids[190_000:]).all() and seen == [0, 1, 2, 3]
    with open(path, "r+b") as f:
        assert len(f.read()) == n_bytes
        f.seek(100)
        f.write(b"\xff\xff")
    with pytest.raises(ValueError):
        token_files.IdReader(path).read(0, 10)
    with open(path, "r+b") as f:
        f.truncate(n_bytes - 9)
    with pytest.raises(ValueError):
        token_files.IdReader(path)


def test_op12_files_of_lost_attempts_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, "abc") for i in range(20)], "doc_id long, text string")
    manifest = token_files.write_ids(docs, f"{tmp_path}/ids", some_encoder, 1000)
    stray = token_files.IdWriter(f"{tmp_path}/ids/ids-000000-00000-stray.bits", 10)
    stray.add(99, np.array([1, 2, 3]))
    stray.close()
    assert sorted(r.doc_id for r in token_files.read_documents(manifest).collect()) == list(range(20))


def test_op12_edges(edges, none, tmp_path):
    docs = edges.withColumnsRenamed({"shard": "place", "word": "path"})
    manifest = token_files.write_ids(docs, f"{tmp_path}/some", some_encoder, 1000, end_id=3)
    got = token_files.read_documents(manifest).collect()
    assert len(got) == edges.count() and {r.doc_id: r.n_tokens for r in got}[1] == 1
    empty = token_files.write_ids(none, f"{tmp_path}/none", some_encoder, 1000)
    assert empty.count() == 0 and token_files.read_documents(empty).count() == 0 and len(token_files.read_range(empty, 0, 5)) == 0


# 13 -----------------------------------------------------------------------


def brute_buckets(text, n_max, n_buckets=10_000):
    w = ASCII_WORD.findall(lower(text))
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % n_buckets for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize(("n_max", "words"), [(1, 300_000), (1, 0), (1, 500), (3, 500), (3, 300_000)])
def test_op13_features(documents, n_max, words):
    texts = [r.text or "" for r in documents] + ["", "a", "A-a", "é ﬁ\x00ß", "x" * 100_000 + " b"]
    dictionary = importance_resampling.WordDictionary(words)
    for _ in range(2):
        got = [Counter() for _ in texts]
        for a, b in importance_resampling.blocks_of(texts, 20_000):
            buckets, of, n_words = importance_resampling.features(texts[a:b], n_max, 10_000, dictionary)
            for i, x in zip(of.tolist(), buckets.tolist(), strict=True):
                got[a + i][x] += 1
            assert n_words.tolist() == [len(ASCII_WORD.findall(lower(t))) for t in texts[a:b]]
        assert got == [Counter(brute_buckets(t, n_max)) for t in texts]
    assert len(dictionary.number) <= words and (words < 1000 or len(dictionary.number) > 1000)


def test_op13_composition():
    rng = np.random.default_rng(3)
    parts = [(rng.bytes(rng.integers(0, 50)), rng.bytes(rng.integers(0, 300))) for _ in range(200)]
    crc = lambda i: np.array([zlib.crc32(p[i]) for p in parts], np.uint64)
    got = importance_resampling.compose(crc(0), crc(1), np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


def brute_draw(docs, target, percent, n_max, least=20, n=10_000):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(brute_buckets(x, n_max))
    for x in target:
        t.update(brute_buckets(x, n_max))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + n) / ((s[b] + 1) * (t.total() + n)))) for b in range(n)]
    rows = []
    for i, x in docs:
        own = brute_buckets(x, n_max)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ASCII_WORD.findall(lower(x)))])
    fits = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for k, r in enumerate(fits[: percent * len(fits) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_op13_against_sql_and_brute_force(spark, sf, documents):
    import duckdb

    got = importance_resampling.op13_importance_resampling(spark, sf).collect()
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = con.execute(f"SELECT doc_id, n_features, weight, score, rank, n_words FROM ({registry.ORACLES['op13_importance_resampling']})").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    assert sorted(map(tuple, got), key=str) == brute_draw([tuple(r) for r in documents], target, 10, 1)


def test_op13_runs_of_words_ties_and_repeated_rows(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 60)))) for i in range(300)] + [(7, "a b " * 20)] * 150 + [(None, "c " * 30)] * 3
    target = ["a b a b", None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for percent in (0, 3, 40, 100):
        got = importance_resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent, n_max=2).select("doc_id", "n_features", "weight", "score", "rank", "n_words").collect()
        assert sorted(map(tuple, got), key=str) == brute_draw(docs, target, percent, 2)


def test_op13_edges(spark, edges, none):
    target = spark.createDataFrame([("to be or not to be",)], "text string")
    got = importance_resampling.resample(edges, target, 50).collect()
    assert len(got) == edges.count() and {r.doc_id: (r.n_features, r.weight) for r in got}[1] == (0, 0)
    assert importance_resampling.resample(none, target, 50).count() == 0
    assert importance_resampling.resample(edges, target.limit(0), 50).count() == edges.count()
