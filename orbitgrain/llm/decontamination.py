"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a seed of five words are candidates. For
each, the longest matches of words that are still unmarked are found by running
Karp-Rabin hashing and marked, longest first, until none of at least
``least`` words remains. The tiles' share of the item is its coverage, which
does not depend on the order of the passages in the document. Test items are
taken in blocks of bounded size, one block a pass over the documents.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import discard, map_texts, materialize, table, texts_of

WORD = re.compile(r"[^\W_]+")
PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def window_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin key of each window of ``width`` numbers, modulo 2 ** 64."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            key = key * PRIME + ids[i : i + n].astype(np.uint64)
    return key


def free_windows(marked: np.ndarray, width: int) -> np.ndarray:
    """Starts of windows without a marked word."""
    if len(marked) < width:
        return np.zeros(0, np.int64)
    before = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(before[width:] == before[:-width])


def matches(item: np.ndarray, doc: np.ndarray, used_item: np.ndarray, used_doc: np.ndarray, width: int) -> np.ndarray:
    """(start in item, start in doc, words) of the matches of unmarked words, of ``width`` or more, that cannot be made longer at either end.

    Only these are looked for, so a word repeated often in both makes as many
    rows as both are long, not as their product.
    """
    a, b = free_windows(used_item, width), free_windows(used_doc, width)
    keys_a, keys_b = window_keys(item, width)[a], window_keys(doc, width)[b]
    b, keys_b = b[order := np.argsort(keys_b, kind="stable")], keys_b[order]
    # what the words before are, 0 where there is none or it is marked: matches start where these differ
    ahead_a, ahead_b = (np.where(used, 0, x)[:-1] for x, used in ((item, used_item), (doc, used_doc)))
    ahead_a, ahead_b = np.r_[0, ahead_a][a], np.r_[0, ahead_b][b]
    found = []
    for i, (lo, hi) in enumerate(zip(np.searchsorted(keys_b, keys_a).tolist(), np.searchsorted(keys_b, keys_a, side="right").tolist(), strict=True)):
        if hi > lo:
            t = b[lo:hi][(ahead_b[lo:hi] != ahead_a[i]) | (ahead_b[lo:hi] == 0)]
            found.append(np.stack([np.full(len(t), a[i]), t]))
    s, t = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    n, growing = np.zeros(len(s), np.int64), np.arange(len(s))
    free_item, free_doc = np.r_[np.where(used_item, -1, item), -1], np.r_[np.where(used_doc, -2, doc), -2]
    while len(growing):
        x, y = s[growing] + n[growing], t[growing] + n[growing]
        growing = growing[free_item[np.minimum(x, len(item))] == free_doc[np.minimum(y, len(doc))]]
        n[growing] += 1
    return np.stack([s, t, n], 1)[n >= width]


def tiles(item: np.ndarray, doc: np.ndarray, least: int, first_width: int = 32) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in doc, words) of each tile.

    Longer matches are marked first; ties go to the earlier place in the item,
    then in the document. What remains of a match beside a tile is a match of
    its own. Words numbered 0 match nothing.
    """
    used_item, used_doc, out = item == 0, doc == 0, []
    width = max(least, min(first_width, len(item)))
    while True:
        found = matches(item, doc, used_item, used_doc, width)
        longest = int(found[:, 2].max(initial=0))
        if longest > 2 * width:
            width = longest
            continue
        queue = list(map(tuple, np.stack([-found[:, 2], found[:, 0], found[:, 1]], 1)[np.lexsort((found[:, 1], found[:, 0], -found[:, 2]))].tolist()))  # sorted, so a heap
        free = len(free_windows(used_item, width)) and len(free_windows(used_doc, width))
        while queue and free:
            n, s, t = heapq.heappop(queue)
            taken = used_item[s : s - n] | used_doc[t : t - n]
            if not taken.any():
                used_item[s : s - n] = used_doc[t : t - n] = True
                out.append((s, t, -n))
                free = len(free_windows(used_item, width)) and len(free_windows(used_doc, width))
                continue
            edges = np.flatnonzero(np.diff(np.r_[1, taken, 1]))
            for k, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if e - k >= width:
                    heapq.heappush(queue, (k - e, s + k, t + k))
        if width == least:
            return out
        width = max(least, width // 2)


class TestSet:
    """Test items as numbered words, with the keys of their seeds."""

    def __init__(self, items: list[tuple[int, str]], seed: int = 5, least: int = 3):
        self.seed, self.least = seed, least
        self.number: dict[str, int] = {}
        self.items, keys, owners = [], [], []
        for item_id, text in items:
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)], np.int64)
            if len(ids) >= seed:
                k = np.unique(window_keys(ids, seed))
                keys.append(k)
                owners.append(np.full(len(k), len(self.items)))
                self.items.append((item_id, ids))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.owners = self.keys[order], self.owners[order]

    def coverage(self, text: str | None) -> list[tuple[int, float]]:
        """(item_id, coverage) of each item that shares a seed with the text."""
        get = self.number.get
        words = words_of(text)
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        key = window_keys(ids, self.seed)
        known = free_windows(ids == 0, self.seed)
        if not len(known) or not len(self.keys):
            return []
        key = np.unique(key[known])
        lo, hi = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        some = hi > lo
        items = {int(i) for a, b in zip(lo[some], hi[some], strict=True) for i in self.owners[a:b]}
        out = []
        for i in sorted(items):
            item_id, own = self.items[i]
            # only stretches of words that the item has can hold a tile
            doc = np.where(np.isin(ids, own), ids, 0)
            keep = np.zeros(len(doc) + 1, np.int64)
            starts = free_windows(doc == 0, self.least)
            np.add.at(keep, starts, 1)
            np.add.at(keep, starts + self.least, -1)
            inside = np.cumsum(keep)[:-1] > 0
            cut = inside | np.r_[False, inside[:-1]]  # one 0 after each stretch
            doc = np.where(inside, doc, 0)[cut]
            out.append((item_id, sum(t[2] for t in tiles(own, doc, self.least)) / len(own)))
        return out


def test_sets(benchmark: DataFrame, words_in_block: int = 2_000_000, **how) -> Iterator[TestSet]:
    """The test items in blocks of bounded size, streamed through the driver; one at least."""
    items, size, any_ = [], 0, False
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null and item_id is not null").toLocalIterator():
        items.append((r.item_id, r.text))
        size += len(r.text) // 6 + 1
        if size > words_in_block:
            yield TestSet(sorted(items), **how)
            items, size, any_ = [], 0, True
    if items or not any_:
        yield TestSet(sorted(items), **how)


def _passes(rows: DataFrame, sets: Iterable[TestSet], step: Callable[[DataFrame, Broadcast], DataFrame]) -> DataFrame:
    """``step`` with each block in turn; between two blocks the rows are set down, so that tasks hold one block only."""
    out, held, table_of_last = rows, None, None
    for block in sets:
        if held is not None:
            out = materialize(out, "pass")
            held.destroy()
            if table_of_last is not None:
                discard(table_of_last)
            table_of_last = out
        held = rows.sparkSession.sparkContext.broadcast(block)
        out = step(out, held)
    return out


def leaks(docs: DataFrame, sets: Iterable[TestSet], threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_ids, coverage, contaminated) of each row of ``docs`` (doc_id, text).

    ``item_ids``: items covered to ``threshold`` or more, sorted; ``coverage``:
    the most of any item, 0 without a shared seed. Null and empty texts are
    clean; repeated rows are judged each; items under five words are not
    looked for.
    """

    def step(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def make():
            def judge(batch):
                ids, most = [], []
                for text, before, so_far in zip(texts_of(batch), batch.column("item_ids").to_pylist(), batch.column("coverage").to_pylist(), strict=True):
                    found = shared.value.coverage(text)
                    ids.append(sorted({*before, *(i for i, c in found if c >= threshold)}))
                    most.append(max([so_far, *(c for _, c in found)]))
                return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int64())), pa.array(most, pa.float64())], ["doc_id", "text", "item_ids", "coverage"])

            return judge

        return map_texts(rows, make, "doc_id long, text string, item_ids array<long>, coverage double")

    start = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.array().cast("array<long>").alias("item_ids"), F.lit(0.0).alias("coverage"))
    return _passes(start, sets, step).select("doc_id", "item_ids", "coverage", (F.size("item_ids") > 0).alias("contaminated"))


def without_leaks(docs: DataFrame, sets: Iterable[TestSet], threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""

    def step(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def make():
            def clean(batch):
                return batch.filter(pa.array([all(c < threshold for _, c in shared.value.coverage(text)) for text in texts_of(batch)], pa.bool_()))

            return clean

        return map_texts(rows, make, docs.schema)

    return _passes(docs, sets, step)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), test_sets(table(spark, sf_dir, "benchmark")))
