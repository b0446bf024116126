"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is
parsed greedily into the longest substrings that occur in a language's text;
the language that needs the fewest phrases, normalised by the phrases its own
held-back text needs, wins. The letters parsed are the bytes of a text's
letters, so that no alphabet makes a table wide. Texts are parsed in blocks of
``BLOCK`` bytes, a phrase never crossing two blocks, many blocks at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitgrain.llm.common import key_crc, map_texts, materialize, table, texts_of

BLOCK = 2048
#: What is parsed: letters in lower case, anything else as one space.
NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> bytes:
    return NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


class SuffixAutomaton:
    """All substrings of a text; states as dictionaries while it is built."""

    def __init__(self, text: bytes):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """(code of each byte, flat table): state * codes + code -> 2 * next state + (a phrase ended before the byte).

        Only bytes of the text have codes of their own; others, code 0, are
        phrases by themselves, and lead to a last state that any byte leaves
        with a new phrase.
        """
        own = sorted(self.next[0])
        codes = np.zeros(256, np.int64)
        codes[own] = np.arange(1, len(own) + 1)
        last = len(self.next)
        out = np.full((last + 1, len(own) + 1), -1, np.int32)
        for s, after in enumerate(self.next):
            for c, t in after.items():
                out[s, codes[c]] = 2 * t
        root = np.where(out[0] >= 0, out[0] + 1, 2 * last + 1)
        return codes, np.where(out >= 0, out, root).ravel()


def phrases(automaton: SuffixAutomaton, text: bytes) -> int:
    """Phrases of a greedy parse, the plain way."""
    count = 0
    for i in range(0, len(text), BLOCK):
        state, count = 0, count + 1
        for c in text[i : i + BLOCK]:
            if state is not None and c in automaton.next[state]:
                state = automaton.next[state][c]
            else:
                state, count = automaton.next[0].get(c), count + 1
    return count


class CrossParser:
    """Automata of all languages, each as a table as wide as its own bytes are many."""

    def __init__(self, texts: dict[str, bytes], held_back: dict[str, bytes]):
        self.langs = sorted(texts)
        self.tables = [SuffixAutomaton(texts[k]).steps() for k in self.langs]
        # phrases a byte in the language's own unseen text; 1 where there is none
        own = [self.count([held_back.get(k, b"")])[0, j] / max(1, len(held_back.get(k, b""))) for j, k in enumerate(self.langs)]
        self.scale = np.array([o or 1.0 for o in own])
        if not all(held_back.get(k) for k in self.langs):
            self.scale[:] = 1.0

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        joined = np.frombuffer(b"".join(texts), np.uint8)
        if not len(joined) or not self.langs:
            return out
        sizes = np.array([len(t) for t in texts])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        size = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")  # blocks longer than each step
        for j, (codes, steps) in enumerate(self.tables):
            width, own = int(codes.max()) + 1, codes[joined]
            state, found = np.zeros(len(start), np.int64), np.ones(len(start), np.int64)
            for i, k in enumerate(alive):
                at = steps[state[:k] * width + own[start[:k] + i]]
                found[:k] += at & 1
                state[:k] = at >> 1
            np.add.at(out[:, j], owner, found)
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and margin over the next (0 to 1) of each text; ties go to the first name."""
        count = self.count([normal(t) for t in texts]) / self.scale if self.langs else None
        out = []
        for i, text in enumerate(texts):
            if count is None or not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            best = int(np.argmin(count[i]))
            rest = np.delete(count[i], best)
            out.append((self.langs[best], float(1 - count[i, best] / rest.min()) if len(rest) else 1.0))
        return out


def train(docs: DataFrame, letters: int = 24_000, rows: int = 48) -> CrossParser:
    """Fit on labelled rows: (text, lang).

    A bounded sample is taken: the ``rows`` different texts of each language
    with the least hash, or all if there are fewer, cut into sentences' worth of 400 letters, from which
    ``letters`` letters build the automaton and a quarter as many again scale it.
    Rows without text or lang are left out.
    """
    rows_of = docs.filter("lang is not null and text is not null and length(text) > 0")
    # copies count once; the least hashes of slices first, so that no task ranks a whole language
    chosen = rows_of.select("lang", F.xxhash64("text").alias("h")).distinct()
    for slices in (64, 1):
        least = Window.partitionBy("lang", F.pmod("h", F.lit(slices))).orderBy(F.pmod("h", F.lit(1 << 30)), "h")
        chosen = chosen.withColumn("r", F.row_number().over(least)).filter(F.col("r") <= rows).drop("r")
    chosen = materialize(chosen, "chosen")
    if chosen.isEmpty():
        return CrossParser({}, {})
    picked = rows_of.select("lang", "text", F.xxhash64("text").alias("h")).join(F.broadcast(chosen), ["lang", "h"], "left_semi").select("lang", "text").dropDuplicates()
    pieces = picked.select("lang", F.explode(F.regexp_extract_all("text", F.lit("(?s).{1,400}"), F.lit(0))).alias("piece"))
    each = -(-letters * 5 // 4 // 400) + 1
    ranked = pieces.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece"))).filter(F.col("r") <= each)
    texts: dict[str, list[bytes]] = {}
    for r in sorted(ranked.collect(), key=lambda r: (r.lang, r.r)):
        texts.setdefault(r.lang, []).append(normal(r.piece))
    fit, back = {}, {}
    for k, parts in texts.items():
        cut = max(1, len(parts) * 4 // 5)
        fit[k], back[k] = " ".join(p.decode("utf-8", "surrogatepass") for p in parts[:cut])[:letters].encode("utf-8", "surrogatepass"), b" ".join(parts[cut:])
    return CrossParser(fit, back)


def predict(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of ``docs`` (doc_id, text).

    ``und`` with score 0 for null text, text without a letter, and where no
    language was learned. Repeated rows get the same answer; ties go to the
    first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    def make():
        own = shared.value

        def step(batch):
            langs, scores = zip(*own.predict(texts_of(batch)), strict=True)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (key_crc(F.col("doc_id")) % 4 == 2).alias("held_out"), "text")
    return map_texts(rows, make, "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.filter(key_crc(F.col("doc_id")) % 4 != 2).select("text", "lang")
    return predict(docs, train(learn))
