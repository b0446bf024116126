"""Scoring by online logistic context mixing.

A text is its words and an end; a word is its bytes and a space, the end is an
empty word. All is predicted by binary decisions. For each, several predictors
look up counts under hashed contexts, a mixer adds up their stretched
probabilities with weights that a gate chooses, and what comes after refines
it.

A word of a text is told by up to three decisions: does it follow the word
before as it did earlier in the text, was it had earlier in the text, is it a
word of the other documents? Contexts are the word before, how the last
decisions went, the share of the last 32, and the place in the text. Weights
start as trained and are refined online in each text. Words had by then and
pairs are told apart by their shares in the text, known words by their shares
in the classes of texts (say, languages) that the text's words so far speak
for; the rest is spelled: every byte is eight decisions, under the last one to
five bytes of the word, and a last stage maps the mixed probability to what was
seen at such probabilities. A word's probability is the sum over the ways to
tell it, so those of all words add up to one at most.

Work on spelling follows distinct words, of which sorted neighbours share their
common beginning:

1. sort the learning documents into classes by their common words (both found
   over all of them), deal texts to shards by hash, and count words by class
   (combined in each shard first), noting the shards that a word is in;
2. fill the byte tables over all distinct words and add them up; their size
   follows the number of words;
3. train the spelling mixers online on all learned words, what is predicted
   taken off the counts: shards of words by hash are trained apart and their
   weights averaged, so they do not depend on how rows are dealt;
4. spell all distinct words;
5. look words of texts up: frequent ones in a broadcast table, rare ones are
   sent to their shards. Which of the two a word takes does not change what it
   counts, and no table holds the texts once more;
6. count contexts and train weights of the decisions on all learning documents,
   in the same shards, and score all texts.
"""

from __future__ import annotations

import functools
import itertools
import math
import pickle
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import discard, drop_unused, key_crc, least_hashed, materialize, mix64, table  # noqa: F401

K, BLOCKS = 5, 64
GATES, CELLS = 4 * 4 * 8, 33
PRIOR = 0.4
STEP = np.uint64(0x9E3779B97F4A7C15)
END = 0x20  # closes a word; no word holds it
#: Longer words are spelled in pieces of so many bytes, each after the five bytes before it.
PIECE = 127


class Slots:
    """Where each predictor's counts are: two small tables, and three that follow the number of distinct words, up to 2 ** 21 slots each."""

    def __init__(self, words: int):
        large = 1 << min(21, max(18, (8 * max(1, words) - 1).bit_length()))
        self.sizes = (1 << 16, 1 << 18, large, large, large)
        self.starts = np.cumsum([0, *self.sizes])[:-1]
        self.all = sum(self.sizes)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers of the words of all texts in a row, words of each text, the different words): A-Z in lower case, each text closed by an empty word, its end."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = pa.concat_arrays([found.flatten(), pa.array([""])]).dictionary_encode()
    raw, words = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.cast(pa.binary())
    end, raw = raw[-1], raw[:-1]
    is_word = raw != end  # white space at either side of a text splits off nothing
    text = np.repeat(np.arange(len(sizes)), sizes)[is_word]
    sizes = np.bincount(text, minlength=len(sizes)) + 1
    ids = np.full(sizes.sum(), end)
    ids[np.arange(len(text)) + text] = raw[is_word]
    return ids, sizes, words


def texts_in(rows: pa.RecordBatch | pa.Table) -> pa.Array:
    """Texts of some rows, null as empty."""
    texts = pc.fill_null(rows.column("text"), "")
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Values of a column of bytes, much faster than to_pylist."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _pieces(words: list[bytes]) -> tuple[np.ndarray, list[bytes], list[bytes], np.ndarray]:
    """(word, five bytes before, bytes, decisions' bytes) of each piece; the last piece of a word has its end too."""
    long = [i for i, w in enumerate(words) if len(w) > PIECE]
    if not long:
        return np.arange(len(words)), [b""] * len(words), words, np.array([len(w) + 1 for w in words], np.int64)
    owner, heads, parts, sizes = [], [], [], []
    for i, w in enumerate(words):
        for a in range(0, max(1, len(w)), PIECE):
            part = w[a : a + PIECE]
            owner.append(i)
            heads.append(w[max(0, a - 5) : a])
            parts.append(part)
            sizes.append(len(part) + (a + PIECE >= len(w)))
    return np.array(owner), heads, parts, np.array(sizes, np.int64)


def _matrices(words: list[bytes], cells: int = 800_000):
    """Sorted pieces of like length as byte matrices: (word numbers, bytes with five before, numbers of bytes to predict)."""
    owner, heads, parts, sizes = _pieces(words)
    for lo, hi in ((0, 16), (16, 32), (32, PIECE + 1)):
        some = np.flatnonzero((sizes > lo) & (sizes <= hi))
        if not len(some):
            continue
        wide = int(sizes[some].max())
        full = [heads[i].rjust(5, b" ") + parts[i] for i in some.tolist()]
        order = sorted(range(len(full)), key=full.__getitem__)
        some = some[order]
        for at in range(0, len(some), max(1, cells // wide)):
            part = some[at : at + max(1, cells // wide)]
            rows = np.frombuffer(b"".join([full[j].ljust(wide + 5, b" ") for j in order[at : at + len(part)]]), np.uint8).reshape(len(part), wide + 5)
            yield owner[part], rows, sizes[part]


class Events:
    """Bytes to be predicted in a matrix of sorted words, those that a word shares with the one before left out."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, slots: Slots):
        n, wide = len(rows), rows.shape[1] - 5
        differ = rows[1:] != rows[:-1]
        shared = np.r_[-1, np.where(differ.any(1), np.maximum(differ.argmax(1) - 5, -1), wide)]
        row_of, column, weight, contexts = [], [], [], []
        for j in range(wide):
            heads = np.flatnonzero(shared <= j)
            total = np.r_[0, np.cumsum(sizes > j)]
            w = total[np.r_[heads[1:], n]] - total[heads]
            heads, w = heads[w > 0], w[w > 0]
            last = rows[heads, j : j + 5].astype(np.uint64)
            o1 = last[:, 4]
            o2 = o1 | (last[:, 3] << np.uint64(10))
            o3 = o2 | (last[:, 2] << np.uint64(18))
            o4 = o3 | (last[:, 1] << np.uint64(26))
            o5 = o4 | (last[:, 0] << np.uint64(34))
            contexts.append(np.stack([o1, o2, o3, o4, o5]))
            row_of.append(heads)
            column.append(np.full(len(heads), j))
            weight.append(w)
        self.shared, self.wide, self.slots = shared, wide, slots
        self.row, self.column, self.weight = np.concatenate(row_of), np.concatenate(column), np.concatenate(weight)
        self.symbol = rows[self.row, self.column + 5]
        with np.errstate(over="ignore"):
            base = mix64(np.concatenate(contexts, 1) * STEP + np.arange(1, K + 1, dtype=np.uint64)[:, None])
        self.base = (base >> np.uint64(20)).astype(np.uint32)

    def bits(self):
        """(bit number, slots of the five predictors, bit) for each of the eight decisions."""
        node = np.ones(len(self.symbol), np.uint32)
        for b in range(8):
            slots = [((self.base[k] + node * np.uint32(0x9E3779B1)) & np.uint32(self.slots.sizes[k] - 1)).astype(np.int64) + self.slots.starts[k] for k in range(K)]
            y = (self.symbol >> (7 - b)) & 1
            yield b, slots, y
            node = node * np.uint32(2) + y

    def totals(self, value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of the events' values over each piece, shared beginnings included."""
        n = len(sizes)
        out, cuts = np.zeros(n), np.searchsorted(self.column, np.arange(self.wide + 1))
        for j in range(self.wide):
            at = np.zeros(n, np.int64)
            heads = self.row[cuts[j] : cuts[j + 1]]
            at[heads] = np.arange(cuts[j], cuts[j + 1])
            at = np.maximum.accumulate(at)
            on = sizes > j
            out[on] += value[at[on]]
        return out


def confidence(n: np.ndarray) -> np.ndarray:
    return (n > 0).astype(np.uint8) + (n > 2) + (n > 15)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


def _refined(p: np.ndarray, x: np.ndarray, gate: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Mean of the mixed probability and what the curve of its gate has at it."""
    at = np.clip(x, -7.999, 7.999) * 2 + 16
    low = at.astype(np.int64)
    part = at - low
    return 0.5 * p + 0.5 * (curve[gate, low] * (1 - part) + curve[gate, low + 1] * part)


def fill(words: list[bytes], into: np.ndarray, slots: Slots) -> None:
    """Add the words' decisions to tables of (zeros, ones), a word once."""
    for _, rows, sizes in _matrices(words):
        e = Events(rows, sizes, slots)
        weight = e.weight.astype(into.dtype)
        for _, places, y in e.bits():
            for s in places:
                np.add.at(into, 2 * s + y, weight)


def packed(counts: np.ndarray) -> np.ndarray:
    """Counts as (slot, zeros and ones) in 16 bits; larger ones are scaled, keeping their ratio."""
    pairs = counts.reshape(-1, 2).astype(np.float64)
    over = np.maximum(pairs.max(1) / 65535, 1)
    return np.rint(pairs / over[:, None]).astype(np.uint16)


LOGS = np.log(np.arange(65536) + PRIOR).astype(np.float32)


class Speller:
    """Byte predictors' counts, the gates' weights and the curve of the last stage."""

    def __init__(self, counts: np.ndarray, slots: Slots):
        self.counts, self.slots = counts, slots
        self.w = np.full((GATES, K + 1), 0.3)
        self.w[:, K] = 0.0
        grid = _squash((np.arange(CELLS) - 16) / 2)
        self.curve = np.tile(grid, (GATES, 1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "ready"}

    def tables(self, off: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretched prediction and confidence of each slot if 0 comes, then if 1 comes, ``off`` occurrences of it taken off; made once a worker."""
        ready = self.__dict__.setdefault("ready", {})
        if off not in ready:
            ready.clear()
            n0, n1 = np.ascontiguousarray(self.counts.T)
            stretched, sure = np.empty(2 * len(n0), np.float32), np.empty(2 * len(n0), np.uint8)
            for y, (zeros, ones) in enumerate(((np.maximum(n0, off) - np.uint16(off), n1), (n0, np.maximum(n1, off) - np.uint16(off)))):
                half = slice(y * len(n0), (y + 1) * len(n0))
                np.take(LOGS, ones, out=stretched[half])
                stretched[half] -= LOGS[zeros]
                sure[half] = confidence(zeros.astype(np.uint32) + ones)
            ready[off] = stretched, sure
        return ready[off]

    def _inputs(self, b: int, places: list[np.ndarray], y: np.ndarray, off: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions and gate of each event."""
        stretched, sure = self.tables(off)
        x, shift = np.empty((K + 1, len(y)), np.float32), y * self.slots.all
        x[K] = 0.3
        for k, s in enumerate(places):
            at = s + shift
            x[k] = stretched[at]
            if k == 2:
                gate = sure[at]
            elif k == 4:
                gate = gate + 4 * sure[at]
        return x, gate.astype(np.int64) * 8 + b

    def trained(self, words: list[bytes], rate: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights after ``words``, all of them counted, are predicted and then learned one by one, and what came how often at each place of the curve."""
        w, push = self.w.copy(), np.full((GATES, K + 1), 1e-3)
        ones, all_ = self.curve * 0.1, np.full((GATES, CELLS), 0.1)
        for _, rows, sizes in _matrices(words, 200_000):
            e = Events(rows, sizes, self.slots)
            scale = np.minimum(e.weight, 1000.0)
            for b, places, y in e.bits():
                y = y.astype(np.int64)
                x, g = self._inputs(b, places, y, 1)
                mixed = (w[g].T * x).sum(0)
                error = (y - _squash(mixed)) * scale
                for k in range(K + 1):
                    grad = np.bincount(g, error * x[k], GATES)
                    push[:, k] += grad * grad
                    w[:, k] += rate * grad / np.sqrt(push[:, k])
                cell = np.rint(np.clip(mixed, -8, 8) * 2 + 16).astype(np.int64)
                ones += np.bincount(g * CELLS + cell, y * scale, GATES * CELLS).reshape(GATES, CELLS)
                all_ += np.bincount(g * CELLS + cell, scale, GATES * CELLS).reshape(GATES, CELLS)
        return w, ones, all_

    def settle(self, w: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> None:
        self.w, self.curve = w.astype(np.float32), ones / all_

    def train(self, words: list[bytes]) -> None:
        """Online over ``words``, all of them counted: predict, then learn."""
        self.settle(*self.trained(words))

    def spell(self, words: list[bytes], off: int) -> np.ndarray:
        """log10 probability of each word as a new one; ``off``: 1 for words that are counted, 0 for others."""
        out = np.zeros(len(words))
        for owner, rows, sizes in _matrices(words, 400_000):
            e = Events(rows, sizes, self.slots)
            value = np.ones(len(e.symbol))
            for b, places, y in e.bits():
                y = y.astype(np.int64)
                x, g = self._inputs(b, places, y, off)
                own = self.w[g]
                mixed = own[:, K] * np.float32(0.3)
                for k in range(K):
                    mixed += own[:, k] * x[k]
                p = np.clip(_refined(_squash(mixed), mixed, g, self.curve), 1e-6, 1 - 1e-6)
                value *= np.where(y == 1, p, 1 - p)
            np.add.at(out, owner, e.totals(np.log10(value), sizes))
        return out


KINDS = 8


def dense(vectors: list[np.ndarray], size: int) -> np.ndarray:
    """Rows of counts from vectors of count * 2 ** 16 + number."""
    flat = np.concatenate([np.zeros(0, np.int64), *vectors])
    at = np.repeat(np.arange(len(vectors)) * size, [len(v) for v in vectors]) + (flat & 0xFFFF)
    return np.bincount(at, flat >> 16, len(vectors) * size).reshape(len(vectors), size)


class TextClasses:
    """A mixture of KINDS word distributions over the commonest words of some texts."""

    def __init__(self, texts: list[list[bytes]], size: int = 512):
        self.name([w for w, _ in sorted(Counter(w for t in texts for w in t if w).items(), key=lambda x: (-x[1], x[0]))[:size]])
        x = dense([v for v in map(self.vector, texts) if len(v)], len(self.number))
        if len(x):
            self.fit(lambda f, _: f(x))

    def name(self, common: list[bytes]) -> None:
        self.number = {w: i for i, w in enumerate(common)}
        self.names, self.common = frozenset(self.number), pa.array(common, pa.binary())
        self.logs = np.zeros((len(common) + 1, KINDS), np.float32)  # the last row is of all other words

    def vector(self, words: list[bytes]) -> np.ndarray:
        """The common words of a text, as count * 2 ** 16 + number."""
        found = Counter(map(self.number.get, words))
        found.pop(None, None)
        return np.array([c << 16 | i for i, c in found.items()], np.int64)

    def fit(self, over, rounds: int = 20) -> None:
        """``over(f, add)`` adds up what ``f`` gives for blocks of texts (rows of counts of common words, none of them empty)."""
        unit = lambda x: np.sqrt(x / x.sum(1, keepdims=True))

        def best(value, x):
            size = x.sum(1)
            some = np.flatnonzero(value == value.min())
            some = some[size[some] == size[some].max()]
            return value.min(), -size[some[0]], min(x[i].tobytes() for i in some)

        # start from texts that are as little alike as can be, of these the longest
        chosen = np.zeros((0, len(self.number)))
        while len(chosen) < KINDS:
            found = over(lambda x, c=unit(chosen): best(np.round((unit(x) @ c.T).max(1), 1) if len(c) else np.zeros(len(x)), x), min)
            chosen = np.r_[chosen, np.frombuffer(found[2])[None]]
        start, logs, ahead = unit(chosen).T * 20, None, 0.0
        for _ in range(rounds):

            def sums(x, logs=logs, ahead=ahead):
                share = unit(x) @ start if logs is None else x @ logs + ahead
                share = np.exp(share - share.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                return np.c_[share.T @ x, share.sum(0)]

            found = over(sums, np.add)
            words, ahead = found[:, :-1], np.log(found[:, -1] + 1)
            words = words + 0.05 * (words.sum(0) + 1) / (words.sum() + 1) * len(self.number)
            logs = np.log(words / words.sum(1, keepdims=True)).T
        self.logs[:-1] = logs - logs.mean(1, keepdims=True)

    def found(self, ids: np.ndarray, sizes: np.ndarray, words: pa.Array) -> np.ndarray:
        """How often each text (a row) has each common word (a column)."""
        number = pc.fill_null(pc.index_in(words, value_set=self.common), -1).to_numpy().astype(np.int64)[ids]
        some = np.flatnonzero(number >= 0)
        text = np.repeat(np.arange(len(sizes)), sizes)[some]
        return np.bincount(text * len(self.number) + number[some], minlength=len(sizes) * len(self.number)).reshape(len(sizes), len(self.number))

    def of(self, found: np.ndarray) -> np.ndarray:
        """The class that fits each text's words, each taken once, best."""
        return ((found > 0).astype(np.float64) @ self.logs[:-1]).argmax(1)


# Decisions about the words of a text: 0 follows as before, 1 had before, 2 known elsewhere.
PLACES, SETS, BLOCK = 1 << 12, 4, 512
#: Part of a known word's share that does not depend on classes.
OVERALL = 0.1


def _grouped(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): places sorted by key (0 to ``top``) and then place, and where each key starts among them."""
    n = len(keys)
    shift = max(1, n - 1).bit_length()
    if int(top).bit_length() + shift < 63:  # key and place fit one number, which sorts faster
        both = np.sort((keys << shift) | np.arange(n))
        order, own = both & ((1 << shift) - 1), both >> shift
    else:
        order = np.argsort(keys, kind="stable")
        own = keys[order]
    return order, np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if n else np.zeros(0, np.int64)


class Streams:
    """The words of some texts in a row, what each text had before them, and the contexts of their decisions.

    ``counts`` and ``hashes`` are those of the different words, ``ids`` are
    numbers of these; where ``learned`` says that a text is counted itself, its own words
    are taken off. No text is without a word, since its end is one.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, counts: np.ndarray, learned: np.ndarray):
        n, m = len(ids), len(hashes) + 1
        self.ids, self.sizes = ids, sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        first = (np.cumsum(sizes) - sizes)[text]
        at = np.arange(n) - first
        order, heads = _grouped(text * m + ids, len(sizes) * m)
        size = np.diff(np.r_[heads, n])
        before, times, rank = np.empty((3, n), np.int64)
        before[order], times[order], rank[order] = np.arange(n) - np.repeat(heads, size), np.repeat(size, size), np.repeat(np.arange(len(heads)), size)
        # what came before came as often as its word had come by then
        lasts = np.where(at > 0, np.r_[0, before[:-1]], 0)
        kinds = len(heads)  # no rank, which stands before the first word
        order, heads = _grouped(np.r_[kinds, rank[:-1]] * kinds + rank, (kinds + 1) * kinds)
        pairs = np.empty(n, np.int64)
        pairs[order] = np.arange(n) - np.repeat(heads, np.diff(np.r_[heads, n]))
        pairs = np.where(at > 0, pairs, 0)
        self.had, self.pair = before / np.maximum(at, 1), pairs / np.maximum(lasts, 1)
        self.times, self.c, self.c_other = times, counts[ids], counts[ids] - times * learned[text]
        self.learned, self.text, self.first, self.at = learned[text], text, first, at
        self.y = np.stack([pairs > 0, before > 0, self.c_other > 0], 1)
        self.on = np.stack([lasts > 0, (at > 0) & ~self.y[:, 0], ~self.y[:, 0] & ~self.y[:, 1]], 1)
        place = np.minimum(np.log2(np.arange(1, sizes.max(initial=1) + 1)).astype(np.int32), 15)[at]
        self.set = np.minimum(place // 3, SETS - 1)
        word = np.r_[np.int32(0), hashes][np.where(at > 0, np.r_[-1, ids[:-1]] + 1, 0)]
        self.contexts = np.empty((3, 3, n), np.int32)
        window = np.minimum(at, 32)
        since = np.arange(n) - window
        shares = (8 * np.arange(33)[:, None] // np.maximum(np.arange(33), 1)).astype(np.int32) * 16  # by decisions that were so, and words looked at
        window = window.astype(np.int32)
        for d in range(3):
            last, y = np.zeros(n, np.int32), self.y[:, d].astype(np.int32)
            for k in (1, 2, 3):
                last[k:] += (y[: n - k] << (k - 1)) * (window[k:] >= k)
            ahead = np.r_[np.int32(0), np.cumsum(y, dtype=np.int32)]
            self.contexts[d, 0] = (last * 16 + place) * 8 + (np.minimum(lasts, 7) if d == 0 else 0)
            self.contexts[d, 1] = word
            self.contexts[d, 2] = shares.ravel()[(ahead[:n] - ahead[since]) * 33 + window] + place


class TextModel:
    """Predictors' counts, and the weights that texts start with, of the three decisions."""

    def __init__(self, n: np.ndarray, classes: TextClasses):
        self.n, self.of_class, self.classes = int(n.sum()), n, classes
        self.seen = np.zeros((3, 3, PLACES, 2))
        self.w = np.full((SETS, 4, 3), 0.4)
        self.w[:, 3] = 0.0

    def learn(self, s: Streams, rounds: int = 2) -> int:
        """Fill the counts from ``s``, then train the weights, texts in turn; gives the number of blocks they were trained on."""
        for d in range(3):
            for k in range(3):
                at = s.contexts[d, k, s.on[:, d]] * 2 + s.y[s.on[:, d], d]
                self.seen[d, k] += np.bincount(at, minlength=2 * PLACES).reshape(PLACES, 2)
        laid = self._laid(s)
        for _ in range(rounds):
            _, last = self._decided(s, laid)
            if last.shape[-1]:
                self.w = last.mean(-1, dtype=np.float64)
        return last.shape[-1]

    def decide(self, s: Streams, rate: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of the three decisions at each word, weights at the end of each block); blocks of BLOCK words go on from the trained weights."""
        return self._decided(s, self._laid(s), rate)

    def _laid(self, s: Streams):
        """Words put in order of their place in a block, longest blocks first, so that a step over all blocks is one slice: (word, words a step, first blocks of a text, stretched predictions, decisions)."""
        blocks = -(-s.sizes // BLOCK)
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(s.sizes) - s.sizes, blocks) + BLOCK * number
        size = np.minimum(BLOCK, np.repeat(np.cumsum(s.sizes), blocks) - start)
        by_size = np.argsort(-size, kind="stable")
        start, size, first = start[by_size], size[by_size], number[by_size] == 0
        steps = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        word = np.concatenate([np.zeros(0, np.int64), *(start[:k] + i for i, k in enumerate(steps))])
        stretched = np.log((self.seen[..., 1] + PRIOR) / (self.seen[..., 0] + PRIOR)).astype(np.float32)
        x = np.empty((3, 3, len(word)), np.float32)
        for d in range(3):
            for k in range(3):
                x[k, d] = stretched[d, k][s.contexts[d, k][word]]
        return word, steps, first, x, *(np.ascontiguousarray(a[word].T, np.float32) for a in (s.y, s.on))

    def _decided(self, s: Streams, laid, rate: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
        word, steps, first, x, y, on = laid
        trained = self.w.astype(np.float32)
        ended = np.repeat(trained[:, :, :, None], len(first), 3)
        # a text's first block goes through the sets of weights, all others have the last one
        current = np.where(first, trained[0][:, :, None], trained[-1][:, :, None])
        own, bias, set_ = np.ascontiguousarray(current[:3]), current[3].copy(), 0
        p, rate_on, at = np.empty_like(y), np.float32(rate) * on, 0
        small = np.float32(0.3)
        for i, k in enumerate(steps):
            if set_ < (now := min(((i + 1).bit_length() - 1) // 3, SETS - 1)):
                ended[set_, :3][..., first], ended[set_, 3][..., first] = own[..., first], bias[..., first]
                own[..., first], bias[..., first], set_ = trained[now, :3, :, None], trained[now, 3, :, None], now
            part = slice(at, at + k)
            sums = (own[..., :k] * x[..., part]).sum(0)
            sums += small * bias[:, :k]
            p[:, part] = 1 / (1 + np.exp(-sums))
            error = (y[:, part] - p[:, part]) * rate_on[:, part]
            own[..., :k] += x[..., part] * error
            bias[:, :k] += small * error
            at += k
        for rows, n in ((first, set_), (~first, SETS - 1)):
            ended[n, :3][..., rows], ended[n, 3][..., rows] = own[..., rows], bias[..., rows]
        out = np.empty((len(word), 3), np.float32)
        out[word] = p.T
        return np.clip(out, 1e-6, 1 - 1e-6), ended

    def shares(self, s: Streams, mix: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of each word among the known ones, given the classes that the words before it speak for, with and without the text's own counts.

        ``mix``: of each different word, its occurrences in each class in
        255ths; ``row``: its row in what the classes know of common words.
        """
        # beliefs change after a common word that comes first only: a row for each text's start, and one after each such word
        rows, last, texts = np.where(s.had == 0, row[s.ids], len(self.classes.logs) - 1), len(self.classes.logs) - 1, np.arange(len(s.sizes))
        change = np.flatnonzero(rows != last)
        through = np.cumsum(rows != last)
        changes = np.bincount(s.text[change], minlength=len(texts))
        logs = np.zeros((len(texts) + len(change), KINDS))
        logs[s.text[change] + through[change]] = self.classes.logs[rows[change]]
        ahead = np.cumsum(logs, 0)
        starts = texts + np.cumsum(changes) - changes
        belief = ahead - np.repeat(ahead[starts], changes + 1, 0)
        # what a text as a whole speaks for is the class it was counted in
        whole = belief[starts + changes].argmax(1)[s.text]
        belief = np.exp((belief - belief.max(1, keepdims=True)).astype(np.float32))
        belief /= belief.sum(1, keepdims=True)
        belief = belief[s.text + through - (rows != last)]
        # a class of no words is all words
        n = max(self.n, 1)
        of_each = np.where(self.of_class > 0, mix / (255.0 * np.maximum(self.of_class, 1)), 1 / n).astype(np.float32)
        classed = s.c * np.einsum("nk,nk->n", of_each[s.ids], belief)
        mine, theirs = belief[np.arange(len(whole)), whole], mix[s.ids, whole] / 255.0
        others = classed - s.c * mine * of_each[s.ids, whole]
        n_other, of_class = np.maximum(n - s.sizes[s.text] * s.learned, 1), self.of_class[whole] - s.sizes[s.text] * s.learned
        c_other = np.maximum(s.c_other, 0) / n_other
        fresh = others + mine * np.where(of_class > 0, np.maximum(s.c * theirs - s.times * s.learned, 0) / np.maximum(of_class, 1), c_other)
        return OVERALL * s.c / n + (1 - OVERALL) * classed, OVERALL * c_other + (1 - OVERALL) * np.maximum(fresh, 0)

    def score(self, s: Streams, spelled: np.ndarray, mix: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each text by the model, and by the model without the text's own counts; ``spelled``: log10 for each different word."""
        p, _ = self.decide(s)
        able = s.on[:, 0] | s.y[:, 0]
        g1 = np.where(able, p[:, 0], 0.0)
        g2 = np.where(s.at > 0, p[:, 1], 0.0)
        g3 = p[:, 2] if self.n else np.zeros(len(s.ids))
        out, left = [], (1 - g1) * (1 - g2) * (1 - g3)
        spell = left * (10.0 ** np.maximum(spelled, -300))[s.ids]
        for known in self.shares(s, mix, row):
            p = g1 * s.pair + (1 - g1) * (g2 * s.had + (1 - g2) * g3 * known) + spell
            word, tiny = np.log10(np.maximum(p, 1e-290)), np.flatnonzero(p < 1e-280)
            word[tiny] = np.log10(left[tiny]) + spelled[s.ids[tiny]]  # spelled by very many bytes
            out.append(np.add.reduceat(word, np.cumsum(s.sizes) - s.sizes))
        return out[0], out[1]


def _in_parts(batches, most: int = 4_000_000) -> Iterator[pa.Array]:
    """Texts of the batches, cut into arrays of about ``most`` bytes."""
    for batch in batches:
        texts = texts_in(batch)
        for p in parts_of(pc.binary_length(texts), most):
            yield texts.slice(p[0], len(p))


def count_common(rows: DataFrame, size: int, least: int, most: int = 4096) -> tuple[list[bytes], bool, int, int] | None:
    """(candidates for the ``size`` commonest words, whether more than these can be among them, words not held out, words held out).

    Tasks tell the words that come ``least`` times in a part of some megabytes,
    so a word's sum lacks ``least - 1`` a part at most. None if that, or ties,
    leave more than ``most`` candidates.
    """

    def count(batches):
        learned = held = parts = 0
        for batch in batches:
            apart = batch.column("held_out")
            held += int(pc.sum(pc.list_value_length(pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), "").filter(apart)))).as_py() or 0) + apart.true_count
            for texts in _in_parts([batch.filter(pc.invert(apart))]):
                ids, _, words = words_of(texts)
                c = np.bincount(ids, minlength=len(words))
                told = np.flatnonzero(c >= least)
                learned, parts = learned + len(ids), parts + 1
                yield pa.RecordBatch.from_arrays([words.take(pa.array(told)), pa.array(c[told]), *(pa.array(np.zeros(len(told), np.int64)),) * 2], ["word", "c", "held", "parts"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), *(pa.array([x], pa.int64()) for x in (learned, held, parts))], ["word", "c", "held", "parts"])

    counted = rows.select("text", "held_out").mapInArrow(count, "word binary, c long, held long, parts long").filter("word is null or length(word) > 0")
    found = counted.groupBy("word").agg(*(F.sum(x).alias(x) for x in ("c", "held", "parts"))).orderBy(F.col("word").isNull().desc(), F.desc("c"), "word").limit(most + 1).collect()
    if not found:
        return [], True, 0, 0
    (_, learned, held, parts), *found = found
    if least == 1:
        return [bytes(r.word) for r in found[:size]], True, learned, held
    lost = (least - 1) * parts
    bar = found[size - 1].c if len(found) >= size else 0
    if bar <= lost or found[-1].c + lost >= bar and len(found) == most:
        return None
    return [bytes(r.word) for r in found if r.c + lost >= bar], False, learned, held


def learn_classes(rows: DataFrame, size: int = 512, least: int = 20) -> tuple[TextClasses, int, int]:
    """(classes, words not held out, words held out) of all rows (text, held_out): the commonest words of those not held out, and a mixture that is fitted over all of them."""
    common, settled, learned, held = count_common(rows, size, least) or count_common(rows, size, 1)
    classes = TextClasses([])
    classes.name(common)
    drop_unused(rows.sparkSession)

    def find(batches):
        for texts in _in_parts(batches):
            c = classes.found(*words_of(texts))
            text, number = np.nonzero(c)
            cuts = np.flatnonzero(np.diff(text)) + 1
            vectors = np.split(c[text, number] << 16 | number, cuts) if len(text) else []
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in vectors], pa.binary())], ["v"])

    vectors = materialize(rows.filter("not held_out").select("text").mapInArrow(find, "v binary"), "vectors")

    def over(f, add, wide):
        def run(batches):
            parts = (bytes_of(b.column("v").slice(at, 500)) for b in batches for at in range(0, b.num_rows, 500))
            blocks = (dense([np.frombuffer(v, np.int64) for v in part], wide) for part in parts)
            total = functools.reduce(lambda a, x: f(x) if a is None else add(a, f(x)), blocks, None)
            yield pa.RecordBatch.from_arrays([pa.array([] if total is None else [pickle.dumps(total)], pa.binary())], ["total"])

        parts = [pickle.loads(r.total) for r in vectors.mapInArrow(run, "total binary").collect()]  # one a task, of 36 KB
        return functools.reduce(add, parts)

    if common and not settled:
        exact = over(lambda x: x.sum(0), np.add, len(common))
        chosen = sorted(range(len(common)), key=lambda i: (-exact[i], common[i]))[:size]
        classes.name([common[i] for i in chosen])
        number = np.full(len(common), -1)
        number[chosen] = np.arange(len(chosen))

        def renumber(batches):
            for batch in batches:
                vs = (np.frombuffer(v, np.int64) for v in bytes_of(batch.column("v")))
                vs = ((v & ~0xFFFF) | to for v, to in ((v[own], to[own]) for v, to in ((v, number[v & 0xFFFF]) for v in vs) for own in (to >= 0,)))
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in vs if len(v)], pa.binary())], ["v"])

        candidates, vectors = vectors, materialize(vectors.mapInArrow(renumber, "v binary"), "vectors")
        discard(candidates)
    if classes.number:
        classes.fit(lambda f, add: over(f, add, len(classes.number)))
    discard(vectors)
    return classes, learned, held


def count_words(rows: DataFrame, classes) -> DataFrame:
    """(word, c, n0 and so on by class, shards) over all rows (shard, text, held_out): occurrences in the rows not held out, 0 for words of others only, and the shards that have the word."""

    def count(group: pa.Table) -> pa.Table:
        held = np.asarray(group.column("held_out").combine_chunks().to_pylist())
        ids, sizes, words = words_of(texts_in(group))
        kind = np.repeat(classes.value.of(classes.value.found(ids, sizes, words)), sizes)
        c = np.bincount(ids * KINDS + kind, ~np.repeat(held, sizes), len(words) * KINDS).astype(np.int64).reshape(-1, KINDS)
        own = np.bincount(ids, minlength=len(words)) > 0
        words, c = words.filter(pa.array(own)), c[own]
        of, k = np.nonzero(c)
        codes = (c[of, k] << 3 | k).tobytes()
        ends = (8 * np.searchsorted(of, np.arange(len(words) + 1))).astype(np.int32)
        return pa.table({"word": words, "shard": np.full(len(words), group.column("shard")[0].as_py(), np.int32), "counts": pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(codes)])})

    def summed(batches):
        """Sums up neighbouring rows of one word; the last word of a chunk may go on in the next."""
        last: list[pa.Table] = []
        for rows_, ended in itertools.chain(((t, False) for t in _chunks(batches)), [(None, True)]):
            table_ = pa.concat_tables([*last, *([] if rows_ is None else [rows_])]).combine_chunks() if last or rows_ is not None else None
            if table_ is None or not table_.num_rows:
                continue
            word = table_.column("word").combine_chunks()
            heads = np.flatnonzero(np.r_[True, pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)])
            n = len(word) if ended else heads[-1]
            last = [] if ended else [table_.slice(n)]
            heads = heads[heads < n]
            if not n:
                continue
            run = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, n]))
            shard, counts = table_.column("shard").to_numpy()[:n].astype(np.int64), table_.column("counts").slice(0, n)
            codes = np.frombuffer(b"".join(bytes_of(counts)), np.int64)
            of = np.repeat(run, pc.binary_length(counts).to_numpy() // 8)
            by_class = np.bincount(of * KINDS + (codes & 7), codes >> 3, len(heads) * KINDS).astype(np.int64).reshape(-1, KINDS)
            own = np.unique(run << 32 | shard)
            shards = pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(heads) + 1) << 32).astype(np.int32)), pa.array((own & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([word.take(pa.array(heads)), pa.array(by_class.sum(1)), *(pa.array(x) for x in by_class.T), shards], ["word", "c", *(f"n{i}" for i in range(KINDS)), "shards"])

    found = rows.select("shard", "text", "held_out").groupBy("shard").applyInArrow(count, "word binary, shard int, counts binary")
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(summed, f"word binary, c long, {', '.join(f'n{k} long' for k in range(KINDS))}, shards array<int>")


def _chunks(batches, most: int = 200_000) -> Iterator[pa.Table]:
    """Many small batches at once."""
    own, n = [], 0
    for batch in batches:
        own.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(own)
            own, n = [], 0
    if n:
        yield pa.Table.from_batches(own)


def _word_batches(batches):
    """(words, counts, rows) of many small batches at once; counts: all and, where they are there, by class."""
    for rows in _chunks(batches):
        counts = np.stack([rows.column(x).to_numpy() for x in rows.column_names if x not in ("word", "shards")], 1)
        yield bytes_of(rows.column("word")), counts, rows


def fill_tables(words: DataFrame, slots: Slots) -> np.ndarray:
    """The byte predictors' tables over all words (word, c), added up block by block in two steps."""

    def run(batches):
        from pyspark import TaskContext

        counts, any_ = np.zeros(2 * slots.all, np.int32), False
        for own, *_ in _word_batches(batches):
            fill(own, counts, slots)  # each distinct word once: spelling is for new words
            any_ = True
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        if any_:
            for i, b in enumerate(np.array_split(counts.reshape(-1, 2), BLOCKS)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([b.tobytes()], pa.binary())], ["block", "part", "counts"])

    def add(kind, finish):
        def of(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b, kind).astype(np.int64) for b in pdf["counts"])
            return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [0], "counts": [finish(total).tobytes()]})

        return of

    schema = "block int, part int, counts binary"
    found = words.select("word", "c").mapInArrow(run, schema).groupBy("block", (F.col("part") % 256).alias("slice")).applyInPandas(add(np.int32, np.asarray), schema)
    out = np.array_split(np.zeros((slots.all, 2), np.uint16), BLOCKS)
    for r in found.groupBy("block").applyInPandas(add(np.int64, packed), schema).toLocalIterator():  # BLOCKS rows, 26 MB in all at most
        out[r.block] = np.frombuffer(bytes(r.counts), np.uint16).reshape(-1, 2)
    return np.concatenate(out)


def train_speller(known: DataFrame, speller: Speller, v: int, shard_words: int, most: int = 256) -> Speller:
    """Trains on all learned words: shards of about ``shard_words`` of them by hash (at most ``most`` shards, which are larger then), whose weights are averaged and whose curves are added up."""
    shared = known.sparkSession.sparkContext.broadcast(speller)

    def train(group: pa.Table) -> pa.Table:
        words = bytes_of(group.column("word"))
        w, ones, all_ = shared.value.trained([words[i] for i in np.lexsort((np.arange(len(words)), np.asarray(group.column("h"))))])
        return pa.table({"shard": group.column("shard")[:1], "n": pa.array([len(words)], pa.int64()), "found": pa.array([np.concatenate([(w * len(words)).ravel(), ones.ravel(), all_.ravel()]).tobytes()], pa.binary())})

    shards = min(most, -(-max(1, v) // shard_words))
    rows = known.select("word", F.xxhash64("word").alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)))
    n, found = 0, 0.0
    for r in rows.groupBy("shard").applyInArrow(train, "shard long, n long, found binary").sort("shard").toLocalIterator():  # 74 KB a shard
        n, found = n + r.n, found + np.frombuffer(bytes(r.found))
    if n:
        w, ones, all_ = np.split(found, np.cumsum([GATES * (K + 1), GATES * CELLS]))
        speller.settle((w / n).reshape(GATES, K + 1), ones.reshape(GATES, CELLS), all_.reshape(GATES, CELLS))
    shared.unpersist()
    return speller


def spell_words(words: DataFrame, speller, least: int | None) -> DataFrame:
    """(word, c, lp, mix, shards): adds the log10 probability of spelling the word, and packs its counts by class as 255ths of all; words that come ``least`` times need no shards.

    Learned words and others are two passes, so that a worker needs one table.
    """

    def spelled(off: int):
        def run(batches):
            own = speller.value
            for tokens, counts, rows_ in _word_batches(batches):
                c = counts[:, 0]
                mix = (counts[:, 1:] * 255 // np.maximum(c, 1)[:, None]).astype(np.uint8).tobytes()
                arrays = [pa.array(tokens, pa.binary()), pa.array(c), pa.array(own.spell(tokens, off)), pa.array([mix[i : i + KINDS] for i in range(0, len(mix), KINDS)], pa.binary()), rows_.column("shards").combine_chunks()]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "c", "lp", "mix", "shards"])

        return run

    shards = "shards" if least is None else F.when(F.col("c") < least, F.col("shards")).alias("shards")
    rows = words.select("word", "c", *(f"n{k}" for k in range(KINDS)), shards)
    schema = "word binary, c long, lp double, mix binary, shards array<int>"
    return rows.filter("c > 0").mapInArrow(spelled(1), schema).unionByName(rows.filter("c = 0").mapInArrow(spelled(0), schema))


class Looked:
    """Words with their counts, the log10 of spelling them, their classes (both 0 where they are left out), hashes and rows in what classes know of common words."""

    def __init__(self, rows: pa.Table, classes: TextClasses):
        rows = rows.combine_chunks()
        self.words = rows.column("word").cast(pa.binary()).combine_chunks()
        n, last = len(self.words), len(classes.number)
        whole = "mix" in rows.column_names
        self.columns = (
            rows.column("c").to_numpy().astype(np.int64), rows.column("lp").to_numpy() if whole else np.zeros(n),
            np.frombuffer(b"".join(bytes_of(rows.column("mix"))), np.uint8).reshape(-1, KINDS) if whole else np.zeros((n, KINDS), np.uint8),
            np.fromiter(map(zlib.crc32, bytes_of(self.words)), np.int64, n).astype(np.int32) & np.int32(PLACES - 1), pc.fill_null(pc.index_in(self.words, value_set=classes.common), last).to_numpy().astype(np.int32),
        )

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "number"}

    @functools.cached_property
    def number(self) -> dict[bytes, int]:
        return dict(zip(bytes_of(self.words), range(len(self.words)), strict=True))

    def find(self, words: pa.Array, others: Looked) -> list[np.ndarray]:
        """The columns of words that are here or among ``others``."""
        here = np.fromiter(map(self.number.get, bytes_of(words), itertools.repeat(-1)), np.int64, len(words))
        away, ours = np.flatnonzero(here < 0), here >= 0
        there = pc.index_in(words.take(pa.array(away)), value_set=others.words)
        if there.null_count:
            raise ValueError("a word of a text was not counted")
        there, out = there.to_numpy(), []
        for mine, more in zip(self.columns, others.columns, strict=True):
            x = np.empty((len(words), *mine.shape[1:]), mine.dtype)
            x[ours] = mine[here[ours]]
            x[away] = more[there]
            out.append(x)
        return out


def least_frequent(words: DataFrame, most: int) -> int | None:
    """How often a word comes at least that is among the ``most`` commonest with all that come as often; None: no word is."""
    histogram = words.groupBy(F.least(F.col("c"), F.lit(1_000_000)).alias("c")).agg(F.count(F.lit(1)).alias("n")).filter("c > 0").orderBy(F.desc("c")).collect()
    least, total = None, 0
    for r in histogram:
        total += r.n
        if total > most:
            break
        least = r.c
    return least


class Numbers(dict):
    """Numbers new keys as they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def streams_of(texts: list[list[bytes]] | pa.Array, find: Callable, learned: np.ndarray) -> tuple[Streams, np.ndarray, np.ndarray, np.ndarray]:
    """Streams of some texts, given whole or as lists of words, and of each different word the log10 of spelling it, its classes and its row; ``find(words)`` gives their columns."""
    if isinstance(texts, list):
        number = Numbers()
        ids = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        sizes, words = np.array([len(w) for w in texts], np.int64), list(number)
    else:
        ids, sizes, words = words_of(texts)
    counts, spelled, mix, hashes, row = find(words)
    return Streams(ids, sizes, hashes, counts, learned), spelled, mix, row


def parts_of(sizes, most: int = 2_000_000) -> list[np.ndarray]:
    """Places of texts, given their bytes, that are worked on together."""
    if not len(sizes):
        return []
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(np.asarray(sizes, np.int64)) // most)) + 1)


def with_rare(texts: DataFrame, rare: DataFrame):
    """Each shard's texts and the rare words that it has."""
    return texts.groupBy("shard").cogroup(rare.groupBy("shard"))


def train_texts(texts: DataFrame, rare: DataFrame, common, n: np.ndarray, classes: TextClasses) -> TextModel:
    """The decisions' model, learned from all rows (shard, text) with the rare words (shard, word, c) of their shards.

    Contexts are counted and weights trained in each shard, and all shards'
    counts are added up and their weights averaged.
    """
    model, spark = TextModel(n, classes), texts.sparkSession
    size = model.seen.size

    def learn(group: pa.Table, words: pa.Table) -> pa.Table:
        usual, looked, found = common.value, Looked(words, classes), np.zeros(size + model.w.size + 1)
        own = texts_in(group)
        own = own.take(pc.sort_indices(own.cast(pa.binary())))
        for p in parts_of(pc.binary_length(own)):
            part = TextModel(n, classes)
            s, *_ = streams_of(own.slice(p[0], len(p)), lambda w: usual.find(w, looked), np.ones(len(p), np.int64))
            blocks = part.learn(s)
            found += np.concatenate([part.seen.ravel(), part.w.ravel() * blocks, [blocks]])
        at = np.flatnonzero(found)
        return pa.table({"at": pa.array(at, pa.int64()), "x": pa.array(found[at])})

    found = np.zeros(size + model.w.size + 1)
    learned = with_rare(texts.select("shard", "text"), rare.select("shard", "word", "c")).applyInArrow(learn, "at long, x double")
    for r in learned.groupBy("at").agg(F.sum("x").alias("x")).collect():  # as many as the model has numbers
        found[r["at"]] = r.x
    if found[-1]:
        model.seen, model.w = found[:size].reshape(model.seen.shape), (found[size:-1] / found[-1]).reshape(model.w.shape)
    drop_unused(spark)
    return model


def score_texts(docs: DataFrame, held_out, frequent: int = 262_144, shard_words: int = 65_536, shard_tokens: int = 500_000) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text), learning from the rows where the column ``held_out`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, fresh_score and bits_per_byte. ``fresh_score`` is what the model
    gives with a learned text's own words taken off the counts, so that it says
    what the other documents make of it, and bits_per_byte is of this; for a
    held-out text both scores are one. Null text counts as empty, which is one
    token, the end. With nothing to learn from, all counts are 0 and the
    predictors know nothing. Repeated rows are learned and scored each; other
    columns are ignored. ``shard_words`` different words and ``shard_tokens``
    words of texts are trained on in a row; texts are counted and scored in
    shards of as many. ``frequent`` bounds the broadcast table and does not
    change a score.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    classes, *sizes = learn_classes(rows)
    shards = [-(-max(1, x) // shard_tokens) for x in sizes]
    hash_ = F.xxhash64("doc_id", F.xxhash64("text"))
    shard = F.when(F.col("held_out"), F.pmod(hash_, F.lit(shards[1])) + shards[0]).otherwise(F.pmod(hash_, F.lit(shards[0])))
    rows = rows.withColumn("shard", shard.cast("int"))
    words = materialize(count_words(rows, spark.sparkContext.broadcast(classes)), "words")
    drop_unused(spark)
    v, *by_class = words.filter("c > 0").agg(F.count(F.lit(1)), *(F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(KINDS))).first()
    n = sum(by_class)
    known, slots, least = words.filter("c > 0"), Slots(v), least_frequent(words, frequent)
    speller = train_speller(known, Speller(fill_tables(known, slots), slots), v, shard_words)
    shared = spark.sparkContext.broadcast(speller)
    scored = materialize(spell_words(words, shared, least), "scored")
    shared.unpersist()
    discard(words)
    drop_unused(spark)
    usual = scored.select("word", "c", "lp", "mix")
    common = spark.sparkContext.broadcast(Looked((usual.limit(0) if least is None else usual.filter(F.col("c") >= least)).toArrow(), classes))
    rare = scored.select(F.explode("shards").alias("shard"), "word", "c", "lp", "mix")
    model = spark.sparkContext.broadcast(train_texts(rows.filter("not held_out"), rare.filter(F.col("shard") < shards[0]), common, np.array(by_class), classes))
    floor = math.log10(n + v + 1)

    def part(texts, looked, held):
        s, *about = streams_of(texts, lambda own: common.value.find(own, looked), 1 - held)
        score, fresh = model.value.score(s, *about)
        starts = np.cumsum(s.sizes) - s.sizes
        base = np.add.reduceat(np.log10(s.c + 1) - floor, starts)
        return s.sizes, np.add.reduceat((s.c > 0).astype(np.int64), starts), base, score, fresh

    def step(group: pa.Table, found: pa.Table) -> pa.Table:
        texts, looked = texts_in(group), Looked(found, model.value.classes)
        held = np.asarray(group.column("held_out").to_pylist(), np.int64)
        n_bytes = pc.binary_length(texts).to_numpy()
        tokens, known_, base, score, fresh = (np.concatenate(x) for x in zip(*(part(texts.slice(p[0], len(p)), looked, held[p]) for p in parts_of(n_bytes)), strict=True))
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = -fresh * math.log2(10) / n_bytes
        arrays = [group.column("doc_id"), group.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known_, pa.int64()), pa.array(np.full(len(texts), n), pa.int64()), pa.array(base), pa.array(score), pa.array(fresh), pa.array(bits, mask=n_bytes == 0)]
        return pa.Table.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "fresh_score", "bits_per_byte"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, fresh_score double, bits_per_byte double"
    return with_rare(rows, rare).applyInArrow(step, schema)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learning from those whose crc32(doc_id as text) mod 7 is not 2."""
    return score_texts(table(spark, sf_dir, "documents"), key_crc(F.col("doc_id")) % 7 == 2)
