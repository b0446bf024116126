"""Runs of repeated words, found online by dyadic square catching.

Words are appended one chunk after another. Once a block of 2^k words is
complete its catcher waits for the block to come back: as words come in, the
last 2^k of them are compared with the block, by sums that tell any two
windows apart, and a match at a distance of 2^k to 2^(k+1) opens a square.
Its suffix comparison is taken back to where it began and then goes on with
every word appended, so squares of one period merge into one stretch, until a
word breaks it. A run of three periods or more holds a whole block and its
copy, so no run escapes; at any time one block a level is waited for.

Many texts go through one sequence, each closed by a word that occurs nowhere
else, so that nothing matches across texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import mix64, table

#: A run has at least so many words and so many periods.
LEAST, TIMES = 24, 3
#: Smallest block: a run of 24 words and a period of less than 8 still holds one and its copy.
FIRST = 8

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SquareCatchers:
    """The runs of one growing sequence of word numbers.

    ``longest`` bounds how far two equal stretches can reach, the words of the
    longest text in the sequence.
    """

    def __init__(self, longest: int, least: int = LEAST, times: int = TIMES):
        if least < 3 * FIRST or times < 3:
            raise ValueError("blocks are sure to be met in runs of 24 words and three periods only")
        self.n, self.longest, self.least, self.times = 0, longest, least, times
        self.words, self.sums, self.powers = np.zeros(1024, np.int64), np.zeros(1025, np.uint64), np.ones(1025, np.uint64)
        self.powers[1:] = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))
        none = np.zeros(0, np.int64)
        #: Stretches as (start, end, period); those that reach the last word may go on.
        self.open, self.closed = (none, none, none), (none, none, none)

    def _grow(self, n: int) -> None:
        size = len(self.words)
        if n <= size:
            return
        more = max(n, 2 * size)
        self.words = np.concatenate([self.words, np.zeros(more - size, np.int64)])
        self.sums = np.concatenate([self.sums, np.zeros(more - size, np.uint64)])
        self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(more, 0x9E3779B97F4A7C15, np.uint64))])

    def _same(self, a: np.ndarray, q: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Whether the windows from ``a`` and from ``a - q`` agree; what differs hardly ever seems the same."""
        return (self.sums[a - q + length] - self.sums[a - q]) * self.powers[q] == self.sums[a + length] - self.sums[a]

    def _forward(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """First place from ``at`` on that differs from the one ``q`` before it, or the end."""
        at, step = at.copy(), 1 << self.longest.bit_length()
        while step:
            fits = at + step <= self.n
            fits[fits] = self._same(at[fits], q[fits], step)
            at[fits] += step
            step >>= 1
        return at

    def _backward(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """First of the places before ``at`` that all equal the ones ``q`` before them."""
        at, step = at.copy(), 1 << self.longest.bit_length()
        while step:
            fits = at - step - q >= 0
            fits[fits] = self._same(at[fits] - step, q[fits], step)
            at[fits] -= step
            step >>= 1
        return at

    def _uncovered(self, begin: np.ndarray, end: np.ndarray, q: np.ndarray) -> np.ndarray:
        """False where a known stretch holds the words from begin to end and its period divides q.

        All that repeats at q there is that stretch itself. Of stretches with
        periods of at most half of what they have to hold, only one can.
        """
        start, stop, period = (np.concatenate(x) for x in zip(self.open, self.closed, strict=True))
        if not len(start):
            return np.ones(len(q), bool)
        order = np.lexsort((period, -stop, start))
        start, stop, period = start[order], stop[order], period[order]
        farthest = np.maximum.accumulate(stop)
        first = np.searchsorted(farthest, farthest)  # of those up to here, the first that reaches as far
        i = np.searchsorted(start, begin, side="right") - 1
        j = first[np.maximum(i, 0)]
        return ~((i >= 0) & (stop[j] >= end) & (q % period[j] == 0))

    def append(self, words: np.ndarray) -> None:
        """The next words of the sequence, as numbers from 0 on."""
        a, n = self.n, self.n + len(words)
        self._grow(n)
        self.words[a:n] = words
        self.sums[a + 1 : n + 1] = self.sums[a] + np.cumsum(mix64(np.asarray(words, np.int64).astype(np.uint64) + np.uint64(1)) * self.powers[a:n])
        self.n = n
        start, stop, period = self.open
        self._keep(start, self._forward(stop, period), period, fresh=False)
        times = np.arange(a + 1, n + 1)
        m = FIRST
        while m * self.times <= self.longest or m == FIRST:
            for back in (1, 2) if m == FIRST else (2,):
                block = times // m - back
                t = times[block >= 0]
                q = t % m + (back - 1) * m
                t, q = t[q > 0], q[q > 0]
                met = self._same(t - m, q, m)
                t, q = t[met], q[met]
                if len(t):
                    new = self._uncovered(t - m - q, t, q)
                    t, q = t[new], q[new]
                    self._keep(self._backward(t - m, q) - q, self._forward(t, q), q)
            m *= 2

    def _keep(self, start: np.ndarray, stop: np.ndarray, period: np.ndarray, fresh: bool = True) -> None:
        """Add stretches: those that reach the end stay open, others are kept if they are long enough."""
        ends = stop == self.n
        long = ~ends & (stop - start >= np.maximum(self.least, self.times * period))

        def merged(old, which):
            both = np.stack([np.concatenate([x, y[which]]) for x, y in zip(old, (start, stop, period), strict=True)])
            return tuple(np.unique(both, axis=1)) if both.shape[1] > 1 else tuple(both)

        self.open = merged(self.open if fresh else (self.open[0][:0],) * 3, ends)
        self.closed = merged(self.closed, long)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start and period.

        Every run is compared word by word, so that sums that agree by chance
        change nothing.
        """
        start, stop, period = (np.concatenate(x) for x in zip(self.open, self.closed, strict=True))
        found = {}
        for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist(), strict=True):
            w = self.words[s:e]
            if not np.array_equal(w[q:], w[:-q]):
                differs = np.flatnonzero(w[q:] != w[:-q])
                edges = [0, *(int(x) + 1 for x in differs), len(w) - q + 1]
                parts = [(s + x, s + y - 1 + q) for x, y in zip(edges, edges[1:], strict=False)]
            else:
                parts = [(s, e)]
            for b, z in parts:
                if z - b >= max(self.least, self.times * q):
                    found[b, z] = min(q, found.get((b, z), q))
        return sorted((b, z - b, q) for (b, z), q in found.items())


def runs_of(texts: list[list[bytes]], chunk: int = 65_536) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, a list of words."""
    number: dict[bytes, int] = {}
    sequence = np.concatenate([np.zeros(0, np.int64), *(np.array([*(number.setdefault(w, len(number)) for w in words), -1 - i], np.int64) for i, words in enumerate(texts))])
    sequence[sequence < 0] = len(number) - 1 - sequence[sequence < 0]
    catchers = SquareCatchers(max(map(len, texts), default=0))
    for a in range(0, len(sequence), chunk):
        catchers.append(sequence[a : a + chunk])
    first = np.cumsum([0, *(len(w) + 1 for w in texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in catchers.runs():
        i = int(np.searchsorted(first, start, side="right")) - 1
        out[i].append((start - int(first[i]), length, period))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d])


def words_of(doc_id: int | None, text: str) -> list[bytes]:
    """Words of a text, parted by ASCII white space."""
    return text.encode().split()


def find_runs(docs: DataFrame, words: Callable[[int | None, str], list[bytes]] = words_of, block_chars: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, runs (start, length and period, by start and period), strongest run and collapsed text of every row (doc_id, text).

    Rows stay where they are: nothing is shuffled. A task holds texts of about
    ``block_chars`` characters at a time, and a longer text by itself, whole.
    Null text has no words; a null doc_id stays null; repeated rows are told
    each; other columns are ignored.
    """
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(ids, texts):
            split = [words(i, t or "") for i, t in zip(ids, texts, strict=True)]
            runs = runs_of(split)
            as_rows = lambda found: [dict(zip(("start", "length", "period"), r, strict=True)) for r in found]
            best = [strongest(r) for r in runs]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(w) for w in split], pa.int64()), pa.array([as_rows(r) for r in runs], pa.list_(RUN)),
                    pa.array([b and as_rows([b])[0] for b in best], RUN), pa.array([collapse(w, r) for w, r in zip(split, runs, strict=True)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )

        for batch in batches:
            ids, texts, a, held = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0, 0
            for i, t in enumerate(texts):
                held += len(t or "")
                if held >= block_chars or i == len(texts) - 1:
                    yield told(ids[a : i + 1], texts[a : i + 1])
                    a, held = i + 1, 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def planted_words(doc_id: int | None, text: str) -> list[bytes]:
    """Words of the contract: in one of ten documents, by crc32 of the number, the end repeats a stretch of its own."""
    w = text.encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + (w[a : a + p] * ((n - a) // p + 1))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs and of the collapsed text of all documents, with the strongest run of each."""
    found = find_runs(table(spark, sf_dir, "documents"), planted_words)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"), best.period.alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
