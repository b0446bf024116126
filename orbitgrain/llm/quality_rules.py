"""Quality rules: a linear-chain conditional random field labels lines.

Each line with a word is content or boilerplate; Viterbi decoding finds the
most likely labelling of a text, and the content's share of the words decides
whether the text is kept. The field is trained here on a bounded sample of the
labelled documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import map_texts, mix64, table, texts_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
FEATURES = ("bias", "symbols_some", "symbols_many", "pipes", "shouting", "capitals", "seen_before", "echo_some", "echo_many", "poor_words", "short", "middling", "ends_sentence", "digits", "long_words")


def line_features(line: str, words: list[bytes], seen: bool) -> tuple[bool, ...]:
    """The features of a line with at least one word, in the order of FEATURES."""
    n, chars = len(words), len(line)
    symbols = sum(map(line.count, SYMBOLS))
    letters_up = sum(1 for w in words if w.isupper())
    echoes = sum(map(bytes.__eq__, words, itertools.islice(words, 1, None))) if n > 1 else 0
    kinds = len(set(words))
    last = line.rstrip(SPACES)[-1:]
    return (
        True,
        symbols > 0,
        symbols * 2 > n,
        line.count("|") * 4 > n,
        line.count("!") > n,
        n > 2 and letters_up * 2 > n,
        seen,
        echoes > 1,
        echoes * 3 > n,
        n >= 12 and kinds * 2 < n,
        n < 4,
        4 <= n < 9,
        last in ".?:;\"')",
        sum(map(str.isdigit, line)) * 5 > chars,
        chars > 14 * n,
    )


def lines_of(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Features and word counts of the lines with a word; repeated lines among them."""
    rows, sizes, seen, repeated = [], [], set(), 0
    for line in text.split("\n"):
        words = line.encode("utf-8", "surrogatepass").split()
        if words:
            again = line in seen
            seen.add(line)
            repeated += again
            rows.append(line_features(line, words, again))
            sizes.append(len(words))
    return np.array(rows, dtype=np.uint8).reshape(len(rows), len(FEATURES)), np.array(sizes, dtype=np.int64), repeated


def repeated_window_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, first included."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    key = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        key = mix64(key + ids[i : n - width + 1 + i] + np.uint64(1))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    start = np.flatnonzero(times[back] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + width, -1)
    return int((np.cumsum(cover)[:n] > 0).sum())


class LineField:
    """Two labels: 0 boilerplate, 1 content. ``w`` scores content against boilerplate, ``t[a, b]`` a step from a to b."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The most likely labels; ties go to content."""
        if not len(x):
            return np.zeros(0, np.int8)
        (t00, t01), (t10, t11) = self.t.tolist()
        unary, back = (x @ self.w).tolist(), []
        bad, good = 0.0, unary[0]
        for u in unary[1:]:
            from_bad, from_good = bad + t01, good + t11
            to_good = from_good >= from_bad
            stay_good = good + t10 >= bad + t00
            back.append((stay_good, to_good))
            bad, good = (good + t10 if stay_good else bad + t00), (from_good if to_good else from_bad) + u
        out = np.empty(len(unary), np.int8)
        state = good >= bad
        out[-1] = state
        for i in range(len(back) - 1, -1, -1):
            state = back[i][state]
            out[i] = state
        return out


#: Used where no labelled sample of both kinds exists.
PRIOR = LineField(np.array([2.0, -0.5, -4, -3, -4, -2, -1, -1, -4, -3, -0.5, 0, 0.5, -0.5, -0.5]), np.array([[0.5, -0.5], [-0.5, 0.5]]))


#: Lines that are fitted together; a field knows no step from one run to the next.
RUN = 64


def fit_field(sequences: list[tuple[np.ndarray, int]], rounds: int = 100, penalty: float = 1e-3, length: int = RUN) -> LineField:
    """Maximum likelihood by forward-backward and Adam; every line takes its document's label."""
    parts = [(x[i : i + length], y) for x, y in sequences for i in range(0, len(x), length)]
    if len({y for _, y in parts}) < 2:
        return PRIOR
    s, k = len(parts), len(FEATURES)
    x, mask, y = np.zeros((s, length, k), np.float32), np.zeros((s, length), bool), np.array([p[1] for p in parts])
    for i, (rows, _) in enumerate(parts):
        x[i, : len(rows)], mask[i, : len(rows)] = rows, True
    w, t = PRIOR.w * 0.1, PRIOR.t * 0.1
    m, v = np.zeros(k + 4), np.zeros(k + 4)
    n = mask.sum()
    for r in range(1, rounds + 1):
        u = (x @ w.astype(np.float32)).astype(np.float64)
        score = np.stack([np.zeros_like(u), u], -1)
        a, b = np.zeros((s, length, 2)), np.zeros((s, length, 2))
        a[:, 0] = score[:, 0]
        for j in range(1, length):
            step = np.logaddexp(a[:, j - 1, 0, None] + t[0], a[:, j - 1, 1, None] + t[1]) + score[:, j]
            a[:, j] = np.where(mask[:, j, None], step, a[:, j - 1])
        for j in range(length - 2, -1, -1):
            ahead = b[:, j + 1] + score[:, j + 1]
            step = np.logaddexp(t[:, 0] + ahead[:, 0, None], t[:, 1] + ahead[:, 1, None])
            b[:, j] = np.where(mask[:, j + 1, None], step, 0.0)
        z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        p1 = np.exp(a[..., 1] + b[..., 1] - z[:, None]) * mask
        gold = (y[:, None] * mask).astype(np.float64)
        gw = np.einsum("stk,st->k", x, (gold - p1).astype(np.float32)).astype(np.float64) / n
        gt = np.zeros((2, 2))
        pair = mask[:, 1:]
        for p in (0, 1):
            for q in (0, 1):
                e = np.exp(a[:, :-1, p] + t[p, q] + score[:, 1:, q] + b[:, 1:, q] - z[:, None]) * pair
                gt[p, q] = (((y == p) & (y == q))[:, None] * pair).sum() - e.sum()
        g = np.concatenate([gw - penalty * w, (gt / n - penalty * t).ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-8)
        w, t = w + move[:k], t + move[k:].reshape(2, 2)
    return LineField(w, t)


def train_field(docs: DataFrame, labels: DataFrame, max_documents: int = 2000, max_runs: int = 8) -> LineField:
    """Fit on at most ``max_documents`` labelled documents, those with the least hash of doc_id, and at most ``max_runs`` runs of 64 neighbouring lines of each (evenly spaced).

    Of rows that share a doc_id one is taken.
    """
    sample = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id"), F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def make():
        def step(batch):
            blobs = []
            for text in texts_of(batch):
                x = lines_of(text)[0]
                runs = np.split(x, range(RUN, len(x), RUN))
                if len(runs) > max_runs:
                    runs = [runs[i] for i in np.linspace(0, len(runs) - 1, max_runs).astype(int)]
                blobs.append(b"".join(r.tobytes() for r in runs))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(blobs, pa.binary())], ["doc_id", "quality", "x"])

        return step

    found = map_texts(joined.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text"), make, "doc_id long, quality int, x binary")
    rows = found.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit_field([(np.frombuffer(bytes(r.x), np.uint8).reshape(-1, len(FEATURES)), int(r.quality > 0)) for r in rows if len(r.x)])


def measure(text: str, field: LineField, min_share: float = 0.5) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    x, sizes, repeated = lines_of(text)
    again = repeated_window_words(words)
    failed = n < 10 or 100 * again > 20 * n
    share = float(sizes[field.viterbi(x) == 1].sum() / sizes.sum()) if n else 0.0
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), repeated, again, failed, not failed and share >= min_share, share


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def judge(docs: DataFrame, field: LineField) -> DataFrame:
    """One row of measures for each row of ``docs`` (doc_id, text).

    Null text has no words and fails the base rule, as does empty text;
    repeated rows are judged each; other columns are ignored.
    """

    def make():
        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        names = [p.split()[0] for p in MEASURES.split(", ")]

        def step(batch):
            found = list(zip(*(measure(t, field) for t in texts_of(batch)), strict=True))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(f, t) for f, t in zip(found, types, strict=True))], ["doc_id", *names])

        return step

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, f"doc_id long, {MEASURES}")


def keep_content(docs: DataFrame, field: LineField) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns, in one pass."""

    def make():
        def step(batch):
            return batch.filter(pa.array([measure(t, field)[6] for t in texts_of(batch)], pa.bool_()))

        return step

    return map_texts(docs, make, docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train_field(docs, table(spark, sf_dir, "labels")))
