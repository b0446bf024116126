"""The ten operators against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import WORD, brute_base, brute_tiles
from pyspark.sql import functions as F

from orbitgrain.llm import decontamination, language_id, license_scan, lm_scoring, near_dedup, quality_rules, sentence_pieces, sharding, suffix_dedup, token_counts
from orbitgrain.llm.common import key_crc

def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


# 1 ------------------------------------------------------------------------


def test_op1_base_and_held_out(spark, sf, documents):
    got = lm_scoring.op1_lm_scoring(spark, sf).collect()
    words = {r.doc_id: [*WORD.findall(lower(r.text)), ""] for r in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, own in words.items() if not held[i] for w in own)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(words)
    for r in got:
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
        assert r.score < 0


def test_op1_spelling_adds_up_to_less_than_one():
    words = [b"ab", b"abc", b"b", b"", b"abd", b"zz"]
    slots = lm_scoring.Slots(len(words))
    counts = np.zeros(2 * slots.all, np.int64)
    lm_scoring.fill(words, counts, slots)
    speller = lm_scoring.Speller(lm_scoring.packed(counts), slots)
    speller.train(words)
    every = [bytes([a]) for a in range(256) if a not in (9, 10, 11, 12, 13, 32)] + [b""] + words[:2] + words[4:]
    assert 0 < (10.0 ** speller.spell(list(dict.fromkeys(every)), 0)).sum() < 1
    # shared beginnings give what each word has by itself, long words what their bytes have one by one
    assert np.allclose(speller.spell(words, 0), [speller.spell([w], 0)[0] for w in words])
    long, short = b"ab" * 300, b"ab" * 60
    assert np.allclose(speller.spell([long, short, long], 0), [speller.spell([w], 0)[0] for w in (long, short, long)])
    flat = lm_scoring.PIECE
    try:
        lm_scoring.PIECE = 1000
        want = speller.spell([long], 0)[0]
    finally:
        lm_scoring.PIECE = flat
    assert speller.spell([long], 0)[0] == pytest.approx(want)


def test_op1_texts_are_a_distribution():
    """All texts of four words out of known and rare ones, the spelling of which adds up to one too."""
    import itertools

    sample = [[b"a", b"b", b"a", b""], [b"b", b"b", b"a", b""], [b"a", b"c", b""]]
    classes = lm_scoring.TextClasses(sample)
    c, share = {b"a": 6, b"b": 3, b"c": 1, b"d": 0}, {b"a": 0.4, b"b": 0.3, b"c": 0.1, b"d": 0.2}

    def find(own):
        mix = [[255 * (w != b"b" and c.get(w, 0) > 0), 255 * (w == b"b"), *[0] * 6] for w in own]
        rows = [classes.number.get(w, len(classes.number)) for w in own]
        return np.array([c.get(w, 0) for w in own]), np.log10([share.get(w, 1e-9) for w in own]), np.array(mix, np.uint8), np.arange(len(own), dtype=np.int32), np.array(rows)

    model = lm_scoring.TextModel(np.array([7, 3, 0, 0, 0, 0, 0, 0]), classes)
    model.learn(lm_scoring.streams_of(sample, find, np.ones(3, np.int64))[0])
    texts = [list(t) for t in itertools.product(c, repeat=4)]
    s, *about = lm_scoring.streams_of(texts, find, np.zeros(len(texts), np.int64))
    score, fresh = model.score(s, *about)
    assert (10.0**score).sum() == pytest.approx(1.0, abs=1e-5) and np.allclose(score, fresh)


def test_op1_scores_depend_on_the_table_only(spark, sf):
    docs, held = spark.read.parquet(f"{sf}/documents.parquet"), key_crc(F.col("doc_id")) % 7 == 2

    def scores(df, **how):
        return {r.doc_id: (r.score, r.fresh_score, r.base_score, r.n_known) for r in lm_scoring.score_texts(df, held, **how).collect()}

    want = scores(docs)
    for frequent in (50, 0):
        got = scores(docs, frequent=frequent)
        assert all(got[i] == pytest.approx(want[i]) for i in want)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (4, 9):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = scores(docs.repartition(n))
            assert all(got[i] == pytest.approx(want[i], rel=1e-6) for i in want)
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def test_op1_held_out_texts_score_above_the_base(spark, sf):
    got = lm_scoring.op1_lm_scoring(spark, sf.replace("0.001", "0.01")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_op1_copies_score_apart(spark):
    import random

    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame([*enumerate(texts), *((100 + i, texts[i]) for i in range(10))], "doc_id long, text string")
    got = {r.doc_id: r.bits_per_byte for r in lm_scoring.score_texts(docs, F.lit(False)).collect()}
    assert max(got[i] for i in range(10)) < min(got[i] for i in range(10, 60))


def test_op1_edges(edges, none):
    rows = {r.doc_id: r for r in lm_scoring.score_texts(edges, F.col("doc_id") == 5).collect()}
    assert (rows[1].n_tokens, rows[2].n_tokens, rows[9].n_tokens) == (1, 1, 3001)
    assert rows[1].bits_per_byte is None and rows[9].bits_per_byte < rows[7].bits_per_byte
    assert lm_scoring.score_texts(edges, F.col("doc_id") == 5).count() == edges.count()
    assert lm_scoring.score_texts(none, F.col("doc_id") == 5).count() == 0
    assert lm_scoring.score_texts(edges, F.lit(True)).filter("n_known > 0 or isnan(score) or score > 0").count() == 0


def test_op1_very_long_words(spark):
    docs = spark.createDataFrame([(1, "x" * 1_000_000 + " y"), (2, "ab" * 100 + " " + " ".join("cd" * k for k in range(100))), (3, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, F.lit(False)).collect()}
    assert got[1].n_tokens == 3 and all(math.isfinite(r.score) and math.isfinite(r.fresh_score) for r in got.values())
    held = {r.doc_id: r for r in lm_scoring.score_texts(docs, F.col("doc_id") == 1).collect()}
    assert held[1].n_known == 1 and held[1].score < -1000


def test_op1_learns_from_long_texts_alone(spark):
    import random

    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    texts = [" ".join(words[min(rng.randrange(300), rng.randrange(300))] for _ in range(25_000)) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert min(map(len, texts)) > 100_000
    sample = [r.text for r in lm_scoring.least_hashed(docs, 10).collect()]
    assert len(sample) == 4 and all(99_980 < len(t) < 100_000 and any(t in x for x in texts) for t in sample)
    held = lm_scoring.score_texts(docs, F.col("doc_id") == 0).filter("doc_id = 0").first()
    assert held.score > 1.03 * held.base_score  # words drawn one by one: nothing beats their shares, and untrained mixers lose 7 %


def test_op1_learns_from_all_texts(spark, monkeypatch):
    """Classes, contexts, weights and curves come from every learned text and word, however many there are."""
    texts = [" ".join(f"{a}{i}x{j}" for j in range(5)) + " common" + "c" * (i % 3) for i, a in enumerate("ab" * 450)]
    docs, found = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), {}
    train_texts, settle = lm_scoring.train_texts, lm_scoring.Speller.settle

    def trained(*args):
        found["model"] = train_texts(*args)
        return found["model"]

    def settled(self, w, ones, all_):
        found["bits"] = all_.sum() - 0.1 * all_.size * found["shards"]
        settle(self, w, ones, all_)

    monkeypatch.setattr(lm_scoring, "train_texts", trained)
    monkeypatch.setattr(lm_scoring.Speller, "settle", settled)
    learned, words = texts[:-9], {b""}.union(*(t.encode().split() for t in texts[:-9]))
    found["shards"] = -(-len(words) // 600)
    lm_scoring.score_texts(docs, F.col("doc_id") >= len(learned), shard_words=600, shard_tokens=1500)
    model = found["model"]
    # no word comes twice in a text, so whether it was had before is asked at each word behind the first
    assert (model.seen[1].sum((1, 2)) == sum(len(t.split()) for t in learned)).all()
    assert found["bits"] == pytest.approx(8 * sum(len(w) + 1 for w in words))
    assert {b"common", b"commonc", b"commoncc"} < model.classes.names and len(model.classes.names) == 512
    assert (model.w != 0.4).any() and model.of_class.sum() == sum(len(t.split()) + 1 for t in learned)


def test_op1_sets_no_texts_down(spark, monkeypatch):
    """Disk: rare words go to their texts' shards, and no scratch table repeats the texts."""
    set_down, materialize = [], lm_scoring.materialize
    monkeypatch.setattr(lm_scoring, "materialize", lambda df, label="cut": set_down.append(df.columns) or materialize(df, label))
    docs = spark.createDataFrame([(i, f"some words x{i} y{i // 2}") for i in range(20)], "doc_id long, text string")
    assert lm_scoring.score_texts(docs, F.col("doc_id") % 7 == 2, shard_tokens=20).count() == 20
    assert set_down and not any("text" in columns for columns in set_down)


def test_op1_splits_as_bytes_do():
    import pyarrow as pa

    texts = [" a  B\n", "", "   ", "x\x0by\x0cz\r\n\tQ", "A\x1cB \xa0 É", "\x85k", "a a"]
    ids, sizes, words = lm_scoring.words_of(pa.array(texts))
    want = [[*t.encode().lower().split(), b""] for t in texts]
    assert [words[i].as_py() for i in ids.tolist()] == sum(want, []) and sizes.tolist() == [len(w) for w in want]


# 2 ------------------------------------------------------------------------


def test_op2_law(spark, sf, documents):
    rows = sharding.op2_sharding(spark, sf).collect()
    text = {r.doc_id: r.text or "" for r in documents}
    sizes, slots, shard_of = Counter(), {}, {}
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of.setdefault(raw, r.shard) == r.shard
    assert len(rows) == len(text) and set(sizes) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= max(max(r.size for r in rows), sum(sizes.values()) / 16 * 1.02)


def test_op2_best_fit_takes_the_tightest_bin():
    import random

    rng = random.Random(3)
    for _ in range(30):
        sizes = [rng.randrange(1, 100) for _ in range(rng.randrange(1, 300))]
        got, used = sharding.best_fit_decreasing(sizes, 120)
        left, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(r, b) for b, r in enumerate(left) if r >= sizes[i]]
            if fits:
                b = min(fits)[1]
                left[b] -= sizes[i]
            else:
                b = len(left)
                left.append(120 - sizes[i])
            want[i] = b
        assert (got, used) == (want, len(left))
    assert sharding.pack_into([5, 5, 5, 5], 2) in ([0, 0, 1, 1],)
    assert sharding.best_fit_decreasing([], 10) == ([], 0)


def test_op2_edges(edges, none):
    rows = sharding.documents_to_shards(edges).collect()
    assert len(rows) == edges.count() and len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1
    assert sorted(r.size for r in rows)[:2] == [1, 1]
    assert sharding.documents_to_shards(none).count() == 0


# 3 ------------------------------------------------------------------------


def brute_scan(text, idf, rare=3, agree=2):
    words = re.findall(license_scan.WORDS, lower(text))
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        if at:
            labels.add(label)
    index, found = license_scan.rare_index(idf, rare=rare), set(labels)
    for (label, body, key), entries in zip(license_scan.TEMPLATES, index, strict=True):
        own, key = body.split(), key.split()
        start = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
        for o in range(-len(own), len(words)):
            hits = sum(0 <= o + q < len(words) and words[o + q] == w for w, q in entries)
            if hits >= min(agree, len(entries)) and o + start >= 0 and words[o + start : o + start + len(key)] == key:
                found.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(found))


def test_op3(spark, sf, documents, edges, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    idf = license_scan.inverse_frequencies(docs)
    text = {r.doc_id: r.text for r in documents}
    some = edges.select("doc_id", "text").union(spark.createDataFrame([(20, "x permission is hereby granted free of charge to any person"), (21, "General Public License gnu"), (22, "under CC-BY\nSA 4.0 licensed under cc by sa 4 0"), *((30 + i, f"// {t[:len(t) * 2 // 3]}") for i, t in enumerate((license_scan.texts.MIT, license_scan.texts.ZLIB, license_scan.texts.BSD, license_scan.texts.BOOST)))], "doc_id long, text string"))
    for frame, texts in ((docs, text), (some, {r.doc_id: r.text for r in some.collect()})):
        for r in license_scan.scan(frame, idf).collect():
            assert tuple(r)[1:7] == brute_scan(texts[r.doc_id], idf) and 0 <= r.score <= 1
    assert license_scan.scan(none, license_scan.inverse_frequencies(none)).count() == 0
    # a body that lacks its last third is known all the same, as itself and as no other
    assert {r.doc_id: r.labels for r in license_scan.scan(some, idf).filter("doc_id >= 30").collect()} == {30: "mit", 31: "zlib", 32: "bsd", 33: "bsl"}


# 4 ------------------------------------------------------------------------


def test_op4_tiles_against_brute_force():
    import random

    rng = random.Random(5)
    for _ in range(300):
        kinds = rng.choice([2, 3, 6])
        a, b = ([rng.randrange(0 if rng.random() < 0.3 else 1, kinds) for _ in range(rng.randrange(3, 40))] for _ in range(2))
        b = b + a[5:25] if rng.random() < 0.5 else b
        assert decontamination.tiles(np.array(a), np.array(b), 3, rng.choice([3, 8, 32])) == brute_tiles(a, b)


def test_op4_whole_table_against_brute_force(spark, sf, documents):
    items = {r.item_id: decontamination.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in items.items()}
    got = {r.doc_id: r for r in decontamination.op4_decontamination(spark, sf).collect()}
    assert len(got) == len(documents)
    for r in documents:
        words = decontamination.words_of(r.text)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        cover = {}
        for i, w in items.items():
            if len(w) >= 5 and own & grams[i]:
                number = {x: k + 1 for k, x in enumerate(dict.fromkeys(w))}
                cover[i] = sum(t[2] for t in brute_tiles([number[x] for x in w], [number.get(x, 0) for x in words])) / len(w)
        row = got[r.doc_id]
        assert row.coverage == pytest.approx(max(cover.values(), default=0.0)) and row.item_ids == sorted(i for i, c in cover.items() if c >= 0.8)


def test_op4_repetitive_texts_take_little_time():
    import time

    began = time.time()
    items = decontamination.TestSet([(1, "the " * 60), (2, "a b " * 30)])
    assert items.coverage("the " * 300_000) == [(1, 1.0)] and items.coverage("b a " * 150_000) == [(2, 1.0)]
    assert time.time() - began < 30


def test_op4_reordered_and_clean(spark, edges, none):
    item = "one two three four five six. seven eight nine ten eleven twelve. thirteen fourteen fifteen sixteen seventeen eighteen"
    parts = item.split(". ")
    docs = spark.createDataFrame([(1, "x y " + item.upper() + " z"), (2, " -- ".join([parts[2], "filler words here", parts[0], parts[1]])), (3, parts[0]), (4, "nothing of it")], "doc_id long, text string")
    sets = list(decontamination.test_sets(spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")))
    got = {r.doc_id: r for r in decontamination.leaks(docs, sets).collect()}
    assert [got[i].item_ids for i in (1, 2, 3, 4)] == [[7], [7], [], []]
    assert got[3].coverage == pytest.approx(1 / 3) and got[4].coverage == 0
    small = list(decontamination.test_sets(spark.createDataFrame([(7, item), (5, item), (6, item)], "item_id long, text string"), words_in_block=10))
    both = {r.doc_id: r for r in decontamination.leaks(docs, small).collect()}
    assert len(small) == 3 and both[1].item_ids == [5, 6, 7] and [both[i].coverage for i in both] == [got[i].coverage for i in both]
    assert {r.doc_id for r in decontamination.without_leaks(docs, small).collect()} == {3, 4}
    assert decontamination.without_leaks(edges, sets).columns == edges.columns and decontamination.without_leaks(edges, sets).count() == edges.count()
    assert decontamination.leaks(none, sets).count() == 0 and next(decontamination.test_sets(none.select(F.col("doc_id").alias("item_id"), "text"))).coverage("a b c d e f") == []


# 5 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.PieceModel(sentence_pieces.model_path())


def test_op5_lossless_and_reproducible(spark, sf, edges, none):
    for docs in (edges, spark.read.parquet(f"{sf}/documents.parquet")):
        once = sentence_pieces.encode(docs, sentence_pieces.model_path())
        assert once.filter("not lossless").count() == 0 and once.count() == docs.count()
        again = sentence_pieces.encode(docs.repartition(3), sentence_pieces.model_path())
        key = lambda df: sorted((r.doc_id, r.n_bytes, tuple(r.pieces)) for r in df.collect())
        assert key(once) == key(again)
    other = sentence_pieces.encode(edges, sentence_pieces.model_path(), seed=1)
    assert other.exceptAll(sentence_pieces.encode(edges, sentence_pieces.model_path())).count() > 0
    back = {r.doc_id: r.text for r in sentence_pieces.decode(sentence_pieces.encode(edges, sentence_pieces.model_path()), sentence_pieces.model_path()).collect()}
    assert all(back[r.doc_id] == (r.text or "") for r in edges.collect())
    assert sentence_pieces.encode(none, sentence_pieces.model_path()).count() == 0


def test_op5_samples_follow_the_lattice(model):
    """Frequencies of sampled segmentations against the exact distribution of one word."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())
    word = "▁these"
    weight = {sp.id_to_piece(i): -math.log(-sp.get_score(i) + 10.0) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}

    def ways(s):
        if not s:
            yield ()
        for k in range(1, len(s) + 1):
            if s[:k] in weight:
                for rest in ways(s[k:]):
                    yield (s[:k], *rest)

    p = {w: math.exp(sum(weight[x] for x in w)) for w in ways(word)}
    total = sum(p.values())
    n = 20_000
    found = Counter(tuple(sp.id_to_piece(int(i)) for i in e) for e in sentence_pieces.Sampler(model).encode(["these"] * n, list(range(n))))
    assert set(found) <= set(p)
    for w, x in p.items():
        assert found[w] / n == pytest.approx(x / total, abs=0.015)


def test_op5_cache_does_not_matter(model):
    texts = ["the cat sat on the mat", "a dog, a cat", "zzz qqq", "the mat"] * 3
    keys = list(range(12))
    big, small = sentence_pieces.Sampler(model), sentence_pieces.Sampler(model, cache_units=3, chars_at_once=10)
    assert [a.tolist() for a in big.encode(texts, keys)] == [b.tolist() for b in small.encode(texts, keys)]


# 6 ------------------------------------------------------------------------


def test_op6_base(spark, sf, documents, edges, none):
    text = {r.doc_id: r.text for r in documents}
    for r in quality_rules.op6_quality_rules(spark, sf).collect():
        assert tuple(r)[1:7] == brute_base(text[r.doc_id]) and not (r.base_failed and r.kept)
    odd = {r.doc_id: r.text for r in edges.collect()}
    for r in quality_rules.judge(edges, quality_rules.PRIOR).collect():
        assert tuple(r)[1:7] == brute_base(odd[r.doc_id])
    assert quality_rules.judge(none, quality_rules.PRIOR).count() == 0
    assert quality_rules.train_field(none, none.select("doc_id", F.lit(1).alias("quality"))) is quality_rules.PRIOR
    kept = quality_rules.keep_content(edges, quality_rules.PRIOR)
    assert kept.columns == edges.columns and kept.count() <= edges.count()


def test_op6_digits_of_long_lines():
    digits = quality_rules.FEATURES.index("digits")
    for line in ("1234 5678 " * 10, "1234 5678 " * 39 + "123456789", "1234 5678 " * 40, "1234 5678 " * 5000):
        assert quality_rules.line_features(line, line.encode().split(), False)[digits]
    line = "words and 1 more " * 50
    assert not quality_rules.line_features(line, line.encode().split(), False)[digits]


def test_op6_viterbi_against_all_labellings():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 8))
        x = rng.integers(0, 2, (n, len(quality_rules.FEATURES)))
        f = quality_rules.LineField(rng.normal(size=len(quality_rules.FEATURES)), rng.normal(size=(2, 2)))
        u = x @ f.w
        score = lambda y: sum(u[i] * y[i] for i in range(n)) + sum(f.t[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, B905, E731
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert score(f.viterbi(x).tolist()) == pytest.approx(score(best))


def test_op6_held_out_labels(spark, sf):
    big = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    field = quality_rules.train_field(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality_rules.judge(docs, field).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in judged)
    assert len(judged) > 50 and right / len(judged) > 0.95
    assert sum(not r.kept for r in judged if r.quality) == 0


# 7 ------------------------------------------------------------------------


def brute_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        out[i] = (len(raw), int(gone.sum()), len(suffix_dedup.runs(gone)), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_op7_given(spark, sf, documents):
    want = brute_repeats([tuple(r) for r in documents])
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op7_suffix_dedup(spark, sf).collect()} == want


def test_op7_same_as_sql(spark, sf):
    import duckdb

    from orbitgrain.llm.registry import ORACLES

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    assert {tuple(r) for r in suffix_dedup.op7_suffix_dedup(spark, sf).collect()} == set(con.sql(ORACLES["op7_suffix_dedup"]).fetchall())


@pytest.mark.parametrize("most", [2000, 3, 1])
def test_op7_overlaps(spark, most, monkeypatch):
    import random

    rng = random.Random(1)
    base = ["".join(rng.choice("ab é\n") for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(120):
        a = rng.randrange(250)
        text = rng.choice(base)[a : a + rng.randrange(60, 250)] + "x" * rng.randrange(3) + rng.choice(base)[: rng.randrange(200)]
        rows.append((i, "z" * rng.randrange(500) if i % 37 == 0 else text))
    plain = suffix_dedup.repeats
    monkeypatch.setattr(suffix_dedup, "repeats", lambda d: plain(d, most=most))
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute_repeats(rows)


def test_op7_edges(edges, none):
    rows = {tuple(r) for r in edges.select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeated_bytes(edges).collect()}
    assert got == brute_repeats(rows)
    assert suffix_dedup.repeated_bytes(edges).count() == edges.count() and suffix_dedup.repeated_bytes(none).count() == 0
    cut = suffix_dedup.without_repeats(edges)
    assert cut.columns == edges.columns and cut.count() == edges.count()
    assert cut.filter("doc_id = 6").first().text == "" and cut.filter("doc_id = 6").first().n_chars == 0


def test_op7_surroundings_of_two_different_bytes_differ():
    """Pairs of differences that cancel out in a plain sum of words times factors."""
    rng = np.random.default_rng(7)
    text = bytearray(rng.integers(48, 58, 600, np.uint8).tobytes())
    _, places, keys, _, _ = suffix_dedup.anchors([bytes(text)])
    reach, seen = suffix_dedup.REACH, 0
    for f in (suffix_dedup.FACTORS.astype(object), suffix_dedup.OTHERS.astype(object)):
        for q, key in zip(places.tolist(), keys.tolist(), strict=True):
            if not reach <= q <= 600 - reach - suffix_dedup.GRAM:
                continue
            for i in range(21):
                for j in range(i + 1, 21):
                    for d in range(-9, 10):
                        for e in range(-9, 10):
                            a, b = q - reach + 8 * i + 7, q - reach + 8 * j + 7
                            if d and e and (d * f[i] + e * f[j]) % 256 == 0 and 48 <= text[a] + d < 58 and 48 <= text[b] + e < 58:
                                other = bytearray(text)
                                other[a] += d
                                other[b] += e
                                found = [{(p, k): (s, t) for p, k, s, t in zip(*(x.tolist() for x in suffix_dedup.anchors([bytes(t)])[1:]), strict=True)} for t in (text, other)]
                                if (q, key) in found[1]:
                                    seen += 1
                                    assert all(x != y for x, y in zip(found[0][q, key], found[1][q, key], strict=True))
    assert seen


def test_op7_texts_that_share_a_doc_id(spark):
    import random

    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh \n") for _ in range(300)) for _ in range(4)]
    texts = [(1, base[0]), (1, base[1] + base[0]), (1, base[0]), (1, None), (2, base[1]), (2, "x" + base[2]), (3, base[2] + base[3] + base[2])]
    got = suffix_dedup.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    order = {r.text: r.h for r in spark.createDataFrame(texts, "doc_id long, text string").select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = set(), {}
    for i, t in sorted(set(texts), key=lambda x: (x[0], order[x[1]])):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            gone[p : p + 100] |= raw[p : p + 100] in seen
            seen.add(raw[p : p + 100])
        want[i, t] = "".join(c for c, g in zip(t or "", gone, strict=True) if not g)
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((i, want[i, t]) for i, t in texts)


def test_op7_near_copies_with_two_edits(spark):
    import random

    rng, rows = random.Random(11), []
    for g in range(60):
        text = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)]
        if g == 0:
            text[24], text[128] = "B", "L"
        rows.append((2 * g, "".join(text)))
        for i, c in ((24, "c"), (128, "O")) if g == 0 else ((rng.randrange(50) * 8 + 7, rng.choice("xyz#")) for _ in range(2)):
            text[i] = c
        rows.append((2 * g + 1, "".join(text)))
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute_repeats(rows)


def test_op7_deep_shallow_order():
    import random

    rng = random.Random(2)
    for _ in range(60):
        s = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(1, 40))]
        order, lcp = suffix_dedup.deep_shallow(s, shallow=3)
        assert [s[i] for i in order] == sorted(s) and sorted(order) == list(range(len(s)))
        for k in range(1, len(s)):
            assert lcp[k] == suffix_dedup.common_prefix(s[order[k - 1]], s[order[k]])


# 8 ------------------------------------------------------------------------


def test_op8_same_as_the_library(spark, sf, documents, edges, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    text = {r.doc_id: r.text or "" for r in documents}
    for r in token_counts.op8_token_counts(spark, sf).collect():
        n = len(tok.encode(text[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 2048)
    odd = {r.doc_id: r.text or "" for r in edges.collect()}
    with pytest.raises(ValueError):
        token_counts.PreTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    for r in token_counts.count_tokens(edges, path, frequent={}, cache_entries=2).unionByName(token_counts.count_tokens(edges, path, frequent={}, cache_chars=30)).collect():
        assert r.n_tokens == len(tok.encode(odd[r.doc_id], add_special_tokens=False).ids)
    assert token_counts.count_tokens(none, path).count() == 0


def test_op8_splits_as_the_library():
    import public_tokenizers
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, pre = Tokenizer.from_file(path), token_counts.PreTokenizer(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.one_of(st.characters(max_codepoint=0x250), st.sampled_from("'sSrRéΣİıſ漢 ①\n"), st.characters(exclude_categories=["Cs"])), max_size=40))
    def same(text):
        words = pre.split(text)
        if words is not None:
            assert sum(pre.lengths(words)) == len(tok.encode(text, add_special_tokens=False).ids)

    same()


# 9 ------------------------------------------------------------------------


def test_op9_finds_what_brute_force_finds(spark, sf):
    big = sf.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    assert set(got) == set(texts)
    df, n = near_dedup.document_frequencies(docs)
    w = near_dedup.frequency_weights(df, n)
    bags = {}
    for i, t in texts.items():
        keys, counts, _ = near_dedup.shingles([t])
        bags[i] = (keys, near_dedup.weigh(keys, counts, w))
    ids, found, missed, wrong = sorted(texts), 0, 0, 0
    same = {}
    for i in ids:
        same.setdefault(texts[i], []).append(i)
    for own in same.values():
        assert len({got[i].class_id for i in own}) == 1
    sets = {i: set(b[0].tolist()) for i, b in bags.items()}
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = ids[a], ids[b]
            if sets[x] & sets[y] and len(sets[x] & sets[y]) * 3 > max(len(sets[x]), len(sets[y])) and texts[x] != texts[y]:
                alike = near_dedup.weighted_jaccard(bags[x], bags[y]) >= 0.8
                found += alike
                missed += alike and got[x].class_id != got[y].class_id
    classes = {}
    for i in ids:
        classes.setdefault(got[i].class_id, []).append(i)
    for c, own in classes.items():
        assert c == min(own) and [i for i in own if got[i].keep] == [c]
        for i in own:
            if len({texts[j] for j in own}) > 1:
                wrong += not any(texts[i] == texts[j] or near_dedup.weighted_jaccard(bags[i], bags[j]) >= 0.8 for j in own if j != i)
    assert wrong == 0 and found > 0 and missed / found <= 0.05


def test_op9_samples_agree_as_often_as_texts_are_alike():
    import random

    rng = random.Random(4)
    sampler, hits, total, want = near_dedup.WeightedSampler(), 0, 0, 0.0
    flat = np.ones(near_dedup.BUCKETS, np.float32)
    for _ in range(60):
        words = [str(rng.random()) for _ in range(200)]
        other = [w if rng.random() > 0.01 else str(rng.random()) for w in words]
        bags = []
        for t in (" ".join(words), " ".join(other)):
            keys, counts, per = near_dedup.shingles([t])
            bags.append((keys, near_dedup.weigh(keys, counts, flat), per))
        s = near_dedup.weighted_jaccard(bags[0][:2], bags[1][:2])
        a, b = (sampler.bands(*x)[0] for x in bags)
        hits, total, want = hits + (a == b).sum(), total + len(a), want + s**near_dedup.ROWS * len(a)
    assert hits / total == pytest.approx(want / total, abs=0.06)


def test_op9_edges(spark, edges, none):
    rows = {r.doc_id: r for r in near_dedup.near_duplicates(edges).collect()}
    assert rows[1].class_id == rows[2].class_id == 1 and rows[6].class_id == 5 and not rows[6].keep
    assert rows[3].class_id == 3 and rows[4].class_id == 4 and near_dedup.near_duplicates(edges).count() == edges.count()
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.without_near_duplicates(edges)
    assert kept.columns == edges.columns and kept.filter("doc_id in (2, 6)").count() == 0
    # a chain of links is one class
    words = [f"w{i}" for i in range(400)]
    chain = [(k, " ".join(words[: 400 - k] + [f"v{k}.{i}" for i in range(0)])) for k in range(0, 60, 20)]
    got = near_dedup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def lost_links(texts, got, docs):
    """Candidate pairs of at least 0.8 whose texts ended in different classes, and all of them, by brute force."""
    w = near_dedup.frequency_weights(*near_dedup.document_frequencies(docs))
    sampler, bags, buckets = near_dedup.WeightedSampler(), {}, {}
    for i, t in texts.items():
        keys, counts, per = near_dedup.shingles([t])
        bags[i] = (keys, near_dedup.weigh(keys, counts, w))
        for band, key in enumerate(sampler.bands(*bags[i], per)[0].tolist()):
            buckets.setdefault((band, key), []).append(i)
    pairs = {(a, b) for own in buckets.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    alike = [(a, b) for a, b in pairs if near_dedup.weighted_jaccard(bags[a], bags[b]) >= 0.8]
    return [(a, b) for a, b in alike if got[a] != got[b]], alike, max(map(len, buckets.values()))


@pytest.mark.parametrize(("rounds", "cut"), [(3, None), (1, 20_000)])
def test_op9_template_family(spark, monkeypatch, rounds, cut):
    # pages of one template, which meet in large buckets, are alike in pairs only
    if cut:
        plain = near_dedup.grid
        monkeypatch.setattr(near_dedup, "grid", lambda split: plain(split, block_chars=cut, stripe_chars=2 * cut))
    template = [f"t{i}" for i in range(180)]
    texts = {i: " ".join([*template, *(f"p{i // 2}.{k}" for k in range(12)), *(f"o{i}.{k}" for k in range(16))]) for i in range(400)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs, rounds=rounds).collect()}
    lost, alike, most = lost_links(texts, got, docs)
    assert most > 32 and len(alike) > 150 and not lost


def test_op9_grid_brings_every_two_components_together(spark):
    rows = [(b, b * 100 + i, b * 100 + i % 7, 50) for b in range(3) for i in range(40)]
    split = spark.createDataFrame(rows, "bucket long, id long, component long, size int")
    cells = {}
    for r in near_dedup.grid(split, block_chars=500, stripe_chars=400).collect():
        cells.setdefault((r.bucket, r.block, r.stripe), ([], []))[not r.held].append((r.id, r.component))
    met = {frozenset((x[0], y[0])) for held, passing in cells.values() for x in held for y in passing if x[1] != y[1]}
    assert met == {frozenset((x[1], y[1])) for x in rows for y in rows if x[0] == y[0] and x[2] != y[2]}
    assert len(cells) > 30 and max(len(h) for h, _ in cells.values()) < 30


def test_op9_texts_of_two_leaders_are_compared(spark):
    # windows that slide along some texts: each is like its next few only, and taken by different leaders in small buckets
    texts = {(c * 30 + i) * 7919 % 1009: " ".join(f"w{c}.{k}" for k in range(13 * i, 13 * i + 130)) for c in range(12) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    lost, alike, _ = lost_links(texts, got, docs)
    assert len(alike) > 100 and not lost


def test_op9_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 102), (102, 101)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 104))


def test_op9_components_of_long_paths(spark):
    path = [0, *range(150, 0, -1)]
    other = [1000 + (i * 389) % 997 for i in range(300)]
    links = [*zip(path, path[1:], strict=False), *zip(other, other[1:], strict=False)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in path) and all(got[i] == min(other) for i in other)


# 10 -----------------------------------------------------------------------


def test_op10_held_out(spark, sf, edges, none):
    big = sf.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{big}/documents.parquet")
    got = language_id.op10_language_id(spark, big).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    parser = language_id.train(docs.filter(key_crc(F.col("doc_id")) % 4 != 2))
    odd = {r.doc_id: r for r in language_id.predict(edges, parser).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3, 11)] == ["und"] * 4 and odd[1].score == 0 and odd[7].lang_pred != "und"
    assert language_id.predict(edges, language_id.train(none)).filter("lang_pred <> 'und'").count() == 0
    assert language_id.predict(none, parser).count() == 0


def test_op10_copies_do_not_crowd_out_a_language(spark):
    few = [f"wir sehen den hund und die katze im garten nummer {k} zwei drei" for k in "abcdefghij"]
    copies = [("der gleiche satz steht hier immer wieder und wieder", "de")] * 5000
    docs = spark.createDataFrame([*copies, *((t, "de") for t in few), *((f"the cat and the dog are in garden {k} of many", "en") for k in "abc")], "text string, lang string")
    parser = language_id.train(docs)
    assert parser.langs == ["de", "en"]
    # every different text was learned: each is one phrase, but for those held back to scale
    texts = [language_id.normal(t) for t in few]
    assert sum(parser.count([t])[0, 0] == 1 for t in texts) >= 7


def test_op10_lock_step_equals_plain_parse():
    texts = {"a": b"the cat sat on the mat and the rat", "b": "le chat est sur le tapis avec le rat là".encode()}
    parser = language_id.CrossParser(texts, {})
    own = {k: language_id.SuffixAutomaton(t) for k, t in texts.items()}
    some = [t.encode() for t in ("the rat sat", "le rat est là", "", "qqq", "the " * 2000 + "le chat", "x", "猫")]
    for text, row in zip(some, parser.count(some), strict=True):
        assert row.tolist() == [language_id.phrases(own[k], text) for k in ("a", "b")]


def test_op10_wide_alphabets_stay_small():
    rng = np.random.default_rng(3)
    texts = {"zh": "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 24_000))), "ko": "".join(map(chr, rng.integers(0xAC00, 0xD7A3, 24_000))), "en": "".join(map(chr, rng.integers(97, 123, 24_000)))}
    parser = language_id.CrossParser({k: t[:20_000].encode() for k, t in texts.items()}, {k: t[20_000:].encode() for k, t in texts.items()})
    assert sum(codes.nbytes + steps.nbytes for codes, steps in parser.tables) < 200_000_000
    assert [p[0] for p in parser.predict([texts[k][22_000:] for k in ("zh", "ko", "en")])] == ["zh", "ko", "en"]


# all ----------------------------------------------------------------------


def test_megabytes_in_a_word_and_in_a_text(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    word, text = "x" * 1_000_000, "the cat " * 125_000
    docs = spark.createDataFrame([(1, word, "en"), (2, text, "en"), (3, "a short text", "de")], "doc_id long, text string, lang string").repartition(3)
    rows = lambda df: {r.doc_id: r for r in df.collect()}
    assert rows(sharding.documents_to_shards(docs))[1].size == 1_000_001
    got = rows(license_scan.scan(docs, license_scan.inverse_frequencies(docs)))
    assert (got[1].n_words, got[2].n_words, got[2].labels) == (1, 250_000, "")
    items = spark.createDataFrame([(7, "the cat " * 20)], "item_id long, text string")
    assert [rows(decontamination.leaks(docs, decontamination.test_sets(items)))[i].item_ids for i in (1, 2, 3)] == [[], [7], []]
    assert all(r.lossless for r in sentence_pieces.encode(docs, sentence_pieces.model_path()).collect())
    got = rows(quality_rules.judge(docs, quality_rules.PRIOR))
    assert (got[1].n_words, got[1].word_chars, got[2].n_repeat_words) == (1, 1_000_000, 250_000)
    got = rows(suffix_dedup.repeated_bytes(docs))
    assert [got[i].n_removed for i in (1, 2, 3)] == [999_999, 999_992, 0]
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    assert {i: r.n_tokens for i, r in rows(token_counts.count_tokens(docs, path)).items()} == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in ((1, word), (2, text), (3, "a short text"))}
    assert {i: r.class_id for i, r in rows(near_dedup.near_duplicates(docs)).items()} == {1: 1, 2: 2, 3: 3}
    assert set(rows(language_id.predict(docs, language_id.train(docs)))) == {1, 2, 3}
