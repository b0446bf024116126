"""SentencePiece encoding by sampling, and decoding that gives the text back.

A text is cut into units that no piece can cross (a word with the spaces
before it, a line end). For each new unit the lattice of pieces is filtered
forwards; each occurrence is then sampled backwards, with random numbers that
depend on the row key, the place in the row and the step only. Pieces weigh
1 / (rank + shift), rank being the model's merge order. Characters without a
piece become byte pieces, as does a literal space mark, so decoding is exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import map_texts, mix64, table, texts_of

SPACE = "▁"  # the model's mark for a space
LITERAL = "\ud800"  # stands for that mark where the text itself has it; no valid text holds a lone surrogate
UNIT = re.compile(f"{SPACE}*[^{SPACE}\n{LITERAL}]+|{SPACE}+|\n|{LITERAL}")
STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)


def _keys(chars: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Key of a string from the key of all but its last character."""
    with np.errstate(over="ignore"):
        return (key + chars.astype(np.uint64) + np.uint64(1)) * BASE


class PieceModel:
    """Pieces of a model file, with the tables the lattice needs."""

    def __init__(self, path: str, shift: float = 10.0, sharpness: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        by_length: dict[int, list[tuple[str, int, float]]] = {}
        worst = 0.0
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                weight = -sharpness * float(np.log(-sp.get_score(i) + shift))
                worst = min(worst, weight)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                by_length.setdefault(len(piece), []).append((piece, i, weight))
        self.fallback = worst - 1.0
        self.longest = max(by_length, default=0)
        # for each length: sorted keys, their ids and weights; and the keys of all prefixes of longer pieces
        self.tables, prefixes = {}, {}
        for pieces in by_length.values():
            for p, _, _ in pieces:
                for k in range(1, len(p)):
                    prefixes.setdefault(k, set()).add(p[:k])
        for length in range(1, self.longest + 1):
            pieces = by_length.get(length, [])
            key = self._of([p for p, _, _ in pieces], length)
            order = np.argsort(key)
            ids, weights = np.array([i for _, i, _ in pieces], np.int32), np.array([w for _, _, w in pieces])
            self.tables[length] = (key[order], ids[order], weights[order], np.sort(self._of(sorted(prefixes.get(length, ())), length)))

    @staticmethod
    def _of(strings: list[str], length: int) -> np.ndarray:
        key = np.zeros(len(strings), np.uint64)
        if strings:
            chars = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).reshape(-1, length)
            for k in range(length):
                key = _keys(chars[:, k], key)
        return key

    def decode(self, ids) -> str:
        """The text that was encoded."""
        raw = b"".join([self.bytes_of[i] for i in ids])
        return raw[1:].decode("utf-8") if raw else ""


def _within(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each key among the sorted keys, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


@dataclass
class Lattices:
    """Filtered lattices of many units. A node is a place between characters; node 0 of a unit has no edges.

    ``first`` and ``count`` give a node's edges, each with the node it comes
    from, its piece (-1: the character's bytes) and its cumulated probability.
    """

    last: np.ndarray
    first: np.ndarray
    count: np.ndarray
    source: np.ndarray
    piece: np.ndarray
    below: np.ndarray
    char: np.ndarray

    @staticmethod
    def of(units: list[str], model: PieceModel) -> Lattices:
        size = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-size, kind="stable")
        chars = np.frombuffer("".join([units[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = size[order]
        # nodes lie depth by depth, so their order is one in which they can be filtered
        wide = np.searchsorted(-size, -np.arange(size[0] + 1), side="right")  # units with a node at each depth
        at_depth = np.r_[0, np.cumsum(wide)]
        depth = np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)
        rank = np.repeat(np.arange(len(units)), size)
        left = size[rank] - depth  # characters from here to the unit's end
        at, key = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        edges = []
        for length in range(1, model.longest + 1):
            fits = left[at] >= length
            at, key = at[fits], key[fits]
            if not len(at):
                break
            key = _keys(chars[at + length - 1], key)
            keys, ids, weights, prefixes = model.tables[length]
            i, hit = _within(keys, key)
            edges.append((at[hit], length, ids[i[hit]], weights[i[hit]]))
            if length == 1:
                edges.append((at[~hit], 1, np.full((~hit).sum(), -1, np.int32), np.full((~hit).sum(), model.fallback)))
            more = _within(prefixes, key)[1]
            at, key = at[more], key[more]
        start = np.concatenate([e[0] for e in edges])
        reach = np.concatenate([np.full(len(e[0]), e[1]) for e in edges])
        target = at_depth[depth[start] + reach] + rank[start]
        order_edges = np.argsort(target, kind="stable")
        start, target = start[order_edges], target[order_edges]
        source = at_depth[depth[start]] + rank[start]
        piece = np.concatenate([e[2] for e in edges])[order_edges]
        weight = np.concatenate([e[3] for e in edges])[order_edges]
        n_nodes = at_depth[-1]
        count = np.bincount(target, minlength=n_nodes)
        first = np.cumsum(count) - count
        # forward filtering, all units' nodes of one depth at a time
        alpha, total = np.zeros(n_nodes), np.empty(len(target))
        for d in range(1, size[0] + 1):
            lo, hi = at_depth[d], at_depth[d + 1]
            a, b = first[lo], first[hi - 1] + count[hi - 1]
            w, heads, reps = alpha[source[a:b]] + weight[a:b], first[lo:hi] - a, count[lo:hi]
            top = np.maximum.reduceat(w, heads)
            total[a:b] = np.exp(w - np.repeat(top, reps))
            summed = np.add.reduceat(total[a:b], heads)
            alpha[lo:hi] = top + np.log(summed)
            total[a:b] /= np.repeat(summed, reps)
        below = np.cumsum(total)
        some = count > 0
        below -= np.repeat(below[first[some]] - total[first[some]], count[some])
        char = np.zeros(n_nodes, np.uint32)
        char[at_depth[depth + 1] + rank] = chars
        last = np.empty(len(units), np.int64)
        last[order] = at_depth[size] + np.arange(len(units))
        return Lattices(last.astype(np.int32), first.astype(np.int32), count.astype(np.int32), source.astype(np.int32), piece, below, char)

    def sample(self, units: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each unit asked for, last to first: (which, piece), backward sampling in lock-step.

        A byte fallback is given as -1 - character.
        """
        which, here, draw = np.arange(len(units)), self.last[units], mix64(seeds)
        whose, pieces = [], []
        while len(which):
            u = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = self.first[here].copy()
            end = edge + self.count[here] - 1
            todo = np.flatnonzero((u >= self.below[edge]) & (edge < end))
            while len(todo):
                edge[todo] += 1
                todo = todo[(u[todo] >= self.below[edge[todo]]) & (edge[todo] < end[todo])]
            p = self.piece[edge].astype(np.int64)
            whose.append(which)
            pieces.append(np.where(p >= 0, p, -1 - self.char[here].astype(np.int64)))
            here = self.source[edge]
            on = self.count[here] > 0
            with np.errstate(over="ignore"):
                which, here, draw = which[on], here[on], mix64(draw[on] + STEP)
        whose, pieces = np.concatenate(whose or [which]), np.concatenate(pieces or [which])
        order = np.argsort(whose[::-1], kind="stable")
        return whose[::-1][order], pieces[::-1][order]


class Sampler:
    """Encodes texts; keeps the lattices of ``cache_units`` units at most, then starts anew."""

    def __init__(self, model: PieceModel, seed: int = 0, cache_units: int = 150_000, chars_at_once: int = 1_000_000):
        self.model, self.seed, self.cache_units, self.at_once = model, seed, cache_units, chars_at_once
        self.index: dict[str, int] = {}
        self.kept: Lattices | None = None
        self.nodes = self.edges = 0

    def _add(self, units: list[str], at_once: int = 25_000) -> None:
        """Append lattices to the kept arrays, some units at a time; arrays grow by doubling."""
        for i in range(0, len(units), at_once):
            new = Lattices.of(units[i : i + at_once], self.model)
            n_units, n_nodes, n_edges = len(self.index), self.nodes, self.edges
            new.last += n_nodes
            new.first += n_edges
            new.source += n_nodes
            if self.kept is None:
                self.kept = new
            else:
                for name, used in (("last", n_units), ("first", n_nodes), ("count", n_nodes), ("char", n_nodes), ("source", n_edges), ("piece", n_edges), ("below", n_edges)):
                    old, more = getattr(self.kept, name), getattr(new, name)
                    if used + len(more) > len(old):
                        grown = np.empty(max(2 * len(old), used + len(more)), old.dtype)
                        grown[:used] = old[:used]
                        setattr(self.kept, name, old := grown)
                    old[used : used + len(more)] = more
            self.nodes, self.edges = n_nodes + len(new.first), n_edges + len(new.source)
            for u in units[i : i + at_once]:
                self.index[u] = len(self.index)

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Piece ids of each text under its row key."""
        out: list[np.ndarray] = []
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= self.at_once):
                chars += len(texts[j])
                j += 1
            out += self._encode(texts[i:j], keys[i:j])
            i = j
        return out

    def _encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        split = [UNIT.findall(SPACE + t.replace(SPACE, LITERAL).replace(" ", SPACE)) if t else [] for t in texts]
        index = self.index
        missed = list(dict.fromkeys(u for units in split for u in units if u not in index))
        if missed:
            if len(index) + len(missed) > self.cache_units:
                index.clear()
                self.kept, self.nodes, self.edges = None, 0, 0
                missed = list(dict.fromkeys(u for units in split for u in units))
            self._add(missed)
        sizes = np.array([len(s) for s in split], np.int64)
        total = int(sizes.sum())
        if not total:
            return [np.zeros(0, np.int32) for _ in texts]
        units = np.fromiter((index[u] for s in split for u in s), np.int64, total)
        with np.errstate(over="ignore"):
            row = mix64(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64) + np.uint64(self.seed) * STEP)
            place = (np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint64)
            seeds = np.repeat(row, sizes) ^ (place * STEP)
        which, pieces = self.kept.sample(units, seeds)
        if (odd := pieces < 0).any():
            which, pieces = self._spell(which, pieces, odd)
        ends = np.searchsorted(which, np.cumsum(sizes))
        return [p.astype(np.int32) for p in np.split(pieces, ends[:-1])]

    def _spell(self, which, pieces, odd):
        """Byte pieces for characters that have no piece."""
        width = np.ones(len(pieces), np.int64)
        spots = np.flatnonzero(odd)
        raw = [chr(-1 - c).replace(LITERAL, SPACE).encode() for c in pieces[spots].tolist()]
        width[spots] = [len(r) for r in raw]
        pieces = np.repeat(pieces, width)
        starts = (np.cumsum(width) - width)[spots]
        letters = np.frombuffer(b"".join(raw), np.uint8)
        w = width[spots]
        to = np.repeat(starts, w) + np.arange(len(letters)) - np.repeat(np.cumsum(w) - w, w)
        pieces[to] = self.model.byte_id[letters]
        return np.repeat(which, width), pieces


def encode(docs: DataFrame, path: str, seed: int = 0, shift: float = 10.0, sharpness: float = 1.0) -> DataFrame:
    """(doc_id, n_bytes, n_pieces, pieces array<int>, lossless) of each row of ``docs`` (doc_id, text).

    The row key is doc_id (null: 0); rows with equal key and text get equal
    pieces. Null and empty texts have no pieces and decode to empty text.
    ``lossless`` says that decoding the pieces gave the text. Other columns are
    ignored.
    """

    def make():
        model = PieceModel(path, shift, sharpness)
        sampler = Sampler(model, seed)

        def step(batch):
            texts = texts_of(batch)
            found = sampler.encode(texts, [k or 0 for k in batch.column("doc_id").to_pylist()])
            sizes = [len(f) for f in found]
            flat = pa.array(np.concatenate(found), pa.int32())
            pieces = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), flat)
            same = [model.decode(f.tolist()) == t for f, t in zip(found, texts, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(sizes, pa.int64()), pieces, pa.array(same, pa.bool_())], ["doc_id", "n_bytes", "n_pieces", "pieces", "lossless"])

        return step

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n_bytes long, n_pieces long, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, pieces); null pieces give null text."""

    def make():
        model = PieceModel(path)

        def step(batch):
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([None if p is None else model.decode(p) for p in batch.column("pieces").to_pylist()], pa.string())], ["doc_id", "text"])

        return step

    return map_texts(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "pieces"), make, "doc_id long, text string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), model_path())
