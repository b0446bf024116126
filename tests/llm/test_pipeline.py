"""The pipeline against its stages done one by one in plain Python where that is possible."""

from __future__ import annotations

import itertools

import pytest
from brute import brute_base, brute_tiles

import corpus_pipeline
from orbitgrain.llm import decontamination, near_dedup, quality_rules, sentence_pieces, suffix_dedup
from orbitgrain.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf, "documents"), [table(spark, sf, "documents")]
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, sf).write.parquet(str(root / str(i)))
        docs = spark.read.parquet(str(root / str(i)))
        out.append(docs)
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "suffix dedup", "decontamination", "sentence pieces"]


def alike_classes(texts, docs):
    """The least doc_id of each text's class, by comparing all pairs of texts."""
    weights = near_dedup.frequency_weights(*near_dedup.document_frequencies(docs))
    bags = {}
    for i, t in texts.items():
        keys, counts, _ = near_dedup.shingles([t])
        bags[i] = (keys, near_dedup.weigh(keys, counts, weights))
    least = {i: i for i in texts}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        if texts[a] == texts[b] or near_dedup.weighted_jaccard(bags[a], bags[b]) >= 0.8:
            x, y = sorted((top(a), top(b)))
            least[y] = x
    return {i: top(i) for i in texts}


def content_share(text, field):
    """Share of the words in lines that the likeliest labelling, of all, calls content; texts of few lines only."""
    x, sizes, _ = quality_rules.lines_of(text)
    unary = x @ field.w
    ways = itertools.product((1, 0), repeat=len(x))
    best = max(ways, key=lambda y: sum(u * k for u, k in zip(unary, y, strict=True)) + sum(field.t[a, b] for a, b in itertools.pairwise(y)))
    return sum(n for n, k in zip(sizes, best, strict=True) if k) / max(1, sizes.sum())


def test_each_stage_on_its_input(spark, sf, stages):
    texts = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in stages[:-1]]
    field = quality_rules.train_field(stages[0], table(spark, sf, "labels"))
    checked = 0
    for i, t in texts[0].items():
        base_failed = brute_base(t)[5]
        assert not (base_failed and i in texts[1])
        if not base_failed and len((t or "").split("\n")) <= 10:
            checked += 1
            assert (i in texts[1]) == (content_share(t, field) >= 0.5)
    assert checked > 50
    classes = alike_classes(texts[1], stages[1])
    assert set(texts[2]) == set(classes.values())
    seen = set()
    for i in sorted(texts[2]):
        raw = texts[2][i].encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(w)
        assert texts[3][i] == bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")
    items = {r.item_id: decontamination.words_of(r.text) for r in table(spark, sf, "benchmark").collect()}
    leaky = set()
    for i, t in texts[3].items():
        words = decontamination.words_of(t)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for w in items.values():
            if any(tuple(w[k : k + 5]) in own for k in range(len(w) - 4)):
                number = {x: k + 1 for k, x in enumerate(dict.fromkeys(w))}
                if sum(n for *_, n in brute_tiles([number[x] for x in w], [number.get(x, 0) for x in words])) >= 0.8 * len(w):
                    leaky.add(i)
    assert set(texts[4]) == set(texts[3]) - leaky
    model = sentence_pieces.PieceModel(sentence_pieces.model_path())
    last = {r.doc_id: r for r in stages[5].collect()}
    assert set(last) == set(texts[4]) and all(model.decode(last[i].pieces) == t for i, t in texts[4].items())


def test_run_is_the_stages(spark, sf, stages):
    assert {(r.doc_id, tuple(r.pieces)) for r in corpus_pipeline.run(spark, sf).collect()} == {(r.doc_id, tuple(r.pieces)) for r in stages[5].collect()}


def test_registered(spark, sf):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert suffix_dedup.WINDOW == 100
