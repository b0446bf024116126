"""Suffix-array dedup: remove bytes covered by 100-byte strings that start earlier.

Not every suffix is sorted. Every 100-byte window has a least 32-byte gram by
hash; these grams are the anchors, and two equal windows have equal anchors at
equal places. Anchors that occur once in the corpus can be forgotten. Of those
that occur again with the same surroundings (68 bytes each way, told apart by
128 bits of hash), all but the first are repeats over their whole reach. Where
an anchor has several surroundings, the suffixes that start at it, and the
reversed prefixes that end there, are ordered by deep-shallow sorting: multikey
quicksort to a shallow depth, then a blind trie for each group with a longer
common prefix. From the order and its common prefixes follows which windows
start earlier elsewhere.

A group of suffixes too large for one task is parted like in the quicksort, by
more of its bytes: the windows' offsets are halved, each half having more bytes
in common that equal windows must share, and suffixes meet again by these. A
group of one offset is one of equal windows, and needs no sorting.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitgrain.llm.common import discard, drop_unused, map_texts, materialize, mix64, table

WINDOW, GRAM = 100, 32
REACH = WINDOW - GRAM
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd numbers by which the mixed words of a gram and of its surroundings are multiplied, for each half of a hash.
FACTORS, OTHERS = (mix64(np.arange(k, k + 32, dtype=np.uint64)) | np.uint64(1) for k in (1, 101))


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one number."""
    return np.ndarray((max(0, len(buf) - 7),), "<u8", buf, strides=(1,))


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over each run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        x, span = of(x[:-span], x[span:]), span * 2
    rest = width - span
    return of(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, gram hash, both halves of the surroundings' hash) of each anchor of some texts.

    Every word is mixed before words are added up, so differences of several
    words cannot cancel out but by chance.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = len(buf) - 8
    empty = np.zeros(0, np.int64)
    if n < WINDOW:
        return empty, empty, *(empty.astype(np.uint64) for _ in range(3))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = ends[owner] - np.arange(n)
    words = mix64(_words(buf))
    with np.errstate(over="ignore"):
        h = words[: n - GRAM + 1] * FACTORS[0]
        for i in range(1, GRAM // 8):
            h += words[8 * i : 8 * i + n - GRAM + 1] * FACTORS[i]
    h ^= h >> np.uint64(29)  # the least is sought, and low bits are the better mixed
    h = np.minimum(h * FACTORS[31], NONE - np.uint64(1))
    h[left[: len(h)] < GRAM] = NONE
    least = _sliding(h, REACH + 1, np.minimum)
    least[left[: len(least)] < WINDOW] = 0
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.flatnonzero(h == _sliding(padded, REACH + 1, np.maximum))
    who, key = owner[at], h[at]
    place = at - (ends - sizes)[who]
    before, after = np.minimum(place, REACH), np.minimum(left[at] - GRAM, REACH)
    around, other = np.zeros((2, len(at)), np.uint64)
    whole = np.flatnonzero((before == REACH) & (after == REACH))
    one, two = np.zeros((2, len(whole)), np.uint64)
    with np.errstate(over="ignore"):
        for i in range((WINDOW + REACH) // 8):
            w = words[at[whole] - REACH + 8 * i]
            one += w * FACTORS[i]
            two += w * OTHERS[i]
    around[whole], other[whole] = one, two
    raw = buf.data
    for j in np.flatnonzero((before < REACH) | (after < REACH)).tolist():
        a, b, c = int(at[j]), int(before[j]), int(after[j])
        digest = xxhash.xxh3_128_intdigest(bytes(raw[a - b : a + GRAM + c]), seed=b * 256 + c)
        around[j], other[j] = digest >> 64, digest & (2**64 - 1)
    return who, place, key, around, other


def byte_batches(batch: pa.RecordBatch, most: int = 2_000_000):
    """(rows, texts as bytes) of a batch in parts of bounded size."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    rows, size = [], 0
    for i, t in enumerate(texts):
        texts[i] = t = t or b""
        rows.append(i)
        size += len(t)
        if size >= most:
            yield rows, [texts[j] for j in rows]
            rows, size = [], 0
    if rows:
        yield rows, [texts[j] for j in rows]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) of each part of a batch."""

    def run(batches):
        for batch in batches:
            for _, texts in byte_batches(batch):
                keys, n = np.unique(anchors(texts)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long")


def occurrences(docs: DataFrame) -> DataFrame:
    """(gram, around, other, doc_id, place) of each anchor of docs (doc_id, base, text)."""

    def run(batches):
        for batch in batches:
            ids, base = (np.asarray(batch.column(c).to_pylist(), np.int64) for c in ("doc_id", "base"))
            for rows, texts in byte_batches(batch):
                who, place, *hashes = anchors(texts)
                arrays = [*(pa.array(h.view(np.int64)) for h in hashes), pa.array(ids[rows][who]), pa.array(place + base[rows][who], pa.int64()).cast(pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, ["gram", "around", "other", "doc_id", "place"])

    return docs.select("doc_id", "base", "text").mapInArrow(run, "gram long, around long, other long, doc_id long, place int")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:  # a[:lo] == b[:lo], a[:hi] != b[:hi]
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


class BlindTrie:
    """Compact trie that keeps branching bytes only; strings are compared once each, with the leaf a blind descent ends at."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings, self.root = strings, [first]  # a leaf is a list of equal strings, a node (depth, {byte: child})

    def add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while isinstance(node, tuple):
            depth, below = node
            node = below.get(s[depth] if depth < len(s) else -1) or next(iter(below.values()))
        other = self.strings[node[0]]
        split = common_prefix(s, other)
        if split == len(s) == len(other):
            node.append(i)
            return
        byte = s[split] if split < len(s) else -1
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < split:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == split:
            node[1][byte] = [i]
            return
        new = (split, {other[split] if split < len(other) else -1: node, byte: [i]})
        if parent is None:
            self.root = new
        else:
            parent[1][edge] = new

    def walk(self, shared: int) -> list[tuple[int, int]]:
        """(string, common prefix with the one before) in order; the first has ``shared``."""
        out, todo = [], [(self.root, shared)]
        while todo:
            node, lcp = todo.pop()
            if isinstance(node, tuple):
                depth, below = node
                order = sorted(below)
                todo += [(below[b], depth if k else lcp) for k, b in reversed(list(enumerate(order)))]
            else:
                out.append((node[0], lcp))
                out += [(i, len(self.strings[i])) for i in node[1:]]
        return out


def deep_shallow(strings: list[bytes], shallow: int = 8) -> tuple[list[int], list[int]]:
    """Order of the strings and the common prefix of each with the one before (-1 for the first)."""
    order: list[int] = []
    lcps: list[int] = []
    todo = [(list(range(len(strings))), 0, -1)]  # strings alike to a depth, and the prefix shared with what precedes them
    while todo:
        group, depth, lcp = todo.pop()
        if len(group) == 1:
            order.append(group[0])
            lcps.append(lcp)
        elif depth >= shallow:
            trie = BlindTrie(strings, group[0])
            for i in group[1:]:
                trie.add(i)
            for i, common in trie.walk(lcp):
                order.append(i)
                lcps.append(common)
        else:
            byte = [strings[i][depth] if depth < len(strings[i]) else -1 for i in group]
            pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
            less = [i for i, b in zip(group, byte, strict=True) if b < pivot]
            same = [i for i, b in zip(group, byte, strict=True) if b == pivot]
            more = [i for i, b in zip(group, byte, strict=True) if b > pivot]
            parts = []
            if less:
                parts.append((less, depth, lcp))
            head = depth if less else lcp
            if pivot < 0:  # these have ended and are equal
                parts += [([i], depth, depth if k else head) for k, i in enumerate(same)]
            else:
                parts.append((same, depth + 1, head))
            if more:
                parts.append((more, depth, depth))
            todo += reversed(parts)
    return order, lcps


def repeated_offsets(before: list[bytes], after: list[bytes], first: int = 0, last: int = REACH) -> np.ndarray:
    """Which windows of some anchors repeat one of an earlier anchor: offset x anchor, for the offsets ``first`` to ``last``.

    Anchors come in corpus order; ``before`` is reversed and ends at the
    anchor, ``after`` starts with the gram. The window at offset o starts o
    bytes before its anchor.
    """
    n = len(before)
    groups: dict[bytes, list[int]] = {}
    for i in range(n):
        groups.setdefault(shared_bytes(before[i], after[i], first, last), []).append(i)
    ranks = []
    for strings, skip in ((before, 0), (after, GRAM)):
        order, lcp = np.empty(n, np.int64), np.empty(n, np.int64)
        at = 0
        for ids in groups.values():
            own, common = deep_shallow([strings[i][skip:] for i in ids])
            order[at : at + len(ids)] = [ids[j] for j in own]
            lcp[at : at + len(ids)] = common
            at += len(ids)
        ranks.append((order, lcp))
    size_before, size_after = np.array([len(b) for b in before]), np.array([len(a) for a in after]) - GRAM

    def classes(side: int, depth: int) -> np.ndarray:
        order, lcp = ranks[side]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(lcp < depth) if depth else np.cumsum(lcp < 0)
        return out

    found = np.zeros((last - first + 1, n), bool)
    for o in range(first, last + 1):
        there = np.flatnonzero((size_before >= o) & (size_after >= REACH - o))
        key = classes(0, o)[there] * (n + 1) + classes(1, REACH - o)[there]
        firsts = np.unique(key, return_index=True)[1]
        found[o - first, there] = True
        found[o - first, there[firsts]] = False
    return found


def shared_bytes(before: bytes, after: bytes, first: int, last: int) -> bytes:
    """What any two anchors have in common if they share a window at an offset from ``first`` to ``last``."""
    return before[:first] + after[: GRAM + REACH - last]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def with_surroundings(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Groups of the offsets 0 to REACH: adds ``before`` (reversed) and ``after`` to wanted (gram, large, doc_id, place)."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "large", "place")).alias("spots"))  # no more than a text's anchors
    schema = pa.schema([("gram", pa.int64()), ("large", pa.bool_()), ("doc_id", pa.int64()), ("place", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])

    def make():
        def step(batch):
            out = {k: [] for k in schema.names}
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, base, text, spots in zip(batch.column("doc_id").to_pylist(), batch.column("base").to_pylist(), texts, batch.column("spots").to_pylist(), strict=True):
                for s in spots:
                    q = s["place"] - base
                    if not 0 <= q < len(text or b""):
                        continue  # of another text with this doc_id
                    row = (s["gram"], s["large"], doc_id, q + base, text[max(0, q - REACH) : q][::-1], text[q : q + WINDOW])
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            return pa.RecordBatch.from_pydict(out, schema=schema)

        return step

    joined = docs.select("doc_id", "base", "text").join(lists, "doc_id")
    whole = map_texts(joined, make, "gram long, large boolean, doc_id long, place int, before binary, after binary")
    return whole.select(F.col("gram").cast("string").cast("binary").alias("meet"), F.lit(0).alias("first"), F.lit(REACH).alias("last"), "doc_id", "place", "before", "after", "large")


GROUPS = "meet binary, first int, last int, doc_id long, place int, before binary, after binary"


def parted(groups: DataFrame) -> DataFrame:
    """Each row of ``groups`` for either half of its offsets, to meet by what a window of that half needs in common.

    Rows too near the start or end of their text for a half's windows are left
    out of it.
    """

    def make():
        def step(batch):
            take, meet, firsts, lasts = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("first", "last", "before", "after"))
            for i, (first, last, before, after) in enumerate(zip(*columns, strict=True)):
                middle = (first + last) // 2
                for lo, hi in ((first, middle), (middle + 1, last)):
                    if len(before) >= lo and len(after) >= GRAM + REACH - hi:
                        take.append(i)
                        meet.append(xxhash.xxh3_128_digest(shared_bytes(before, after, lo, hi), seed=lo * 256 + hi))
                        firsts.append(lo)
                        lasts.append(hi)
            rest = batch.take(pa.array(take, pa.int32()))
            head = [pa.array(meet, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())]
            return pa.RecordBatch.from_arrays([*head, *(rest.column(c) for c in ("doc_id", "place", "before", "after"))], ["meet", "first", "last", "doc_id", "place", "before", "after"])

        return step

    return map_texts(groups, make, GROUPS)


def sorted_spans(groups: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, span) of the windows found by sorting; groups are dealt to blocks."""

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, spans = [], []
        pdf = pdf.sort_values(["doc_id", "place"]).drop_duplicates(["meet", "doc_id", "place"])  # repeated rows of one text
        for (first, last), part in pdf.groupby(["first", "last"], sort=False):
            found = repeated_offsets(part["before"].tolist(), part["after"].tolist(), int(first), int(last))
            some = found.any(0)
            for i, (doc_id, q) in enumerate(zip(part["doc_id"].tolist(), part["place"].tolist(), strict=True)):
                if some[i]:
                    for a, b in runs(found[:, i]):
                        ids.append(doc_id)
                        spans.append([q - (first + b) + 1, q - (first + a) + WINDOW])
        return pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "span": pd.Series(spans, dtype=object)})

    dealt = groups.withColumn("block", F.pmod(F.xxhash64("meet"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(block, "doc_id long, span array<int>")


def equal_spans(groups: DataFrame) -> DataFrame:
    """(doc_id, span) in groups of one offset: all rows but the first of a group repeat its window."""
    firsts = groups.groupBy("meet").agg(F.min(F.struct("doc_id", "place")).alias("earliest"))
    again = groups.join(firsts, "meet").filter(F.struct("doc_id", "place") != F.col("earliest"))
    return again.select("doc_id", F.array(F.col("place") - F.col("first"), F.col("place") - F.col("first") + WINDOW).alias("span"))


def differing_spans(groups: DataFrame, most: int) -> DataFrame:
    """(doc_id, span) of repeated windows among groups (a table of its own); those of over ``most`` rows are parted until they are smaller or of one offset."""
    found = []
    while True:
        n, large = groups.agg(F.count_if(~F.col("large")), F.count_if("large")).first()
        spans = sorted_spans(groups.filter("not large"), max(64, n // 20_000))
        both = groups.filter("large").drop("large")
        if large:
            spans = spans.unionByName(equal_spans(both.filter("first = last")))
        found.append(materialize(spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "spans"))
        if not large:
            discard(groups)
            return reduce(DataFrame.unionByName, found)
        again = parted(both.filter("first < last"))
        sizes = again.groupBy("meet").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("meet", (F.col("n") > most).alias("large"))
        smaller = materialize(again.join(sizes, "meet"), "groups")
        discard(groups)
        drop_unused(groups.sparkSession)
        groups = smaller


def with_bases(rows: DataFrame) -> DataFrame:
    """Adds ``base`` to rows (doc_id, text): where the text starts among those of its doc_id, 0 if it is the only one.

    Different texts of one doc_id stand one after another, in order of hash;
    equal ones stand at the same place.
    """
    keyed = rows.withColumns({"_h": F.xxhash64("text"), "_n": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")})
    several = keyed.groupBy("doc_id").agg(F.min("_h").alias("a"), F.max("_h").alias("b")).filter("a < b").select("doc_id")
    order = Window.partitionBy("doc_id").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    texts = keyed.select("doc_id", "_h", "_n").join(several, "doc_id", "left_semi").groupBy("doc_id", "_h").agg(F.max("_n").alias("_n"))
    bases = materialize(texts.select("doc_id", "_h", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("base")), "bases")  # of such texts only
    return keyed.join(bases, ["doc_id", "_h"], "left").drop("_h", "_n").fillna(0, ["base"])


def repeats(docs: DataFrame, most: int = 20_000) -> DataFrame:
    """(doc_id, whole, spans): places of anchors that repeat over their whole reach, and other repeated spans, of docs (doc_id, base, text).

    ``most`` bounds the rows of a group that one task sorts; larger groups are
    parted first. It does not change the result.
    """
    spark = docs.sparkSession
    # set down, so that the join below reads both sides through exchanges of its own and a very common gram can be split
    again = materialize(gram_counts(docs).groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "grams")
    drop_unused(spark)
    seen = materialize(occurrences(docs).join(again, "gram", "left_semi"), "anchors")
    discard(again)
    drop_unused(spark)
    kinds = materialize(seen.groupBy("gram", "around", "other").agg(F.min(F.struct("doc_id", "place")).alias("first")), "surroundings")
    later = seen.join(kinds, ["gram", "around", "other"]).filter(F.struct("doc_id", "place") != F.col("first")).groupBy("doc_id").agg(F.collect_list("place").alias("whole"))
    later = materialize(later, "later")
    discard(seen)
    drop_unused(spark)
    several = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram", (F.col("n") > most).alias("large"))
    wanted = kinds.join(several, "gram").select("gram", "large", "first.doc_id", "first.place")
    groups = materialize(with_surroundings(wanted, docs), "groups")
    discard(kinds)
    drop_unused(spark)
    spans = differing_spans(groups, most).groupBy("doc_id").agg(F.flatten(F.flatten(F.collect_list("spans"))).alias("spans"))
    out = materialize(later.join(spans, "doc_id", "full_outer"), "repeats")
    discard(later)
    drop_unused(spark)
    return out


def covered(n: int, whole: list[int] | None, spans: list[int] | None) -> np.ndarray:
    """Which of ``n`` bytes are removed."""
    edge = np.zeros(n + 1, np.int32)
    if whole:
        q = np.unique(np.asarray(whole, np.int64))
        before, after = np.minimum(q, REACH), np.minimum(n - q - GRAM, REACH)
        some = before + after >= REACH
        np.add.at(edge, (q - before)[some], 1)
        np.add.at(edge, (q + GRAM + after)[some], -1)
    if spans:
        s = np.asarray(spans, np.int64).reshape(-1, 2)
        np.add.at(edge, s[:, 0], 1)
        np.add.at(edge, s[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def _joined(docs: DataFrame) -> DataFrame:
    """(row, base, found): each row of ``docs`` whole, so that its names cannot clash, and what repeats in its doc_id's texts."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = with_bases(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row))
    found = repeats(rows.filter("doc_id is not null").select("doc_id", "base", "text"))
    own = rows.select(F.col("doc_id").alias("k"), "base", "row")
    return own.join(found.select(F.col("doc_id").alias("k"), F.struct("whole", "spans").alias("found")), "k", "left").drop("k")


def _opened(batch: pa.RecordBatch) -> tuple[dict[str, pa.Array], list[tuple]]:
    """The columns of a batch's rows, and (whole, spans) of each."""
    row, found = batch.column("row"), []
    sizes = pc.binary_length(row.field("text").cast(pa.binary())).to_pylist()
    for f, base, size in zip(batch.column("found").to_pylist(), batch.column("base").to_pylist(), sizes, strict=True):
        whole, spans = (f["whole"], f["spans"]) if f else (None, None)
        if f and (base or (whole and max(whole) >= (size or 0)) or (spans and max(spans) > (size or 0))):  # of several texts, this one's
            whole = [q - base for q in whole or () if 0 <= q - base < (size or 0)]
            spans = [x - base for a, b in zip((spans or ())[::2], (spans or ())[1::2], strict=True) if a >= base and b - base <= (size or 0) for x in (a, b)]
        found.append((whole, spans))
    return {row.type.field(i).name: row.field(i) for i in range(row.type.num_fields)}, found


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of ``docs`` (doc_id, text).

    Null text counts as empty. Rows without doc_id are neither sources nor
    changed. Rows that share doc_id and text are one document; different texts
    of one doc_id stand one after another in it, in order of hash, and no match
    crosses from one to the next. Other columns are ignored.
    """

    def make():
        def step(batch):
            columns, found = _opened(batch)
            out = []
            for text, (whole, spans) in zip(columns["text"].cast(pa.binary()).to_pylist(), found, strict=True):
                text = text or b""
                gone = covered(len(text), whole, spans)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
                out.append((len(text), int(gone.sum()), len(runs(gone)), hashlib.sha256(kept).hexdigest()))
            sizes = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([columns["doc_id"], *(pa.array(f, pa.int64()) for f in sizes[:3]), pa.array(sizes[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return step

    return map_texts(_joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes removed from their texts, all rows and columns kept.

    A character that loses some of its bytes loses all. ``n_chars``, where
    there is such a column, follows the new text.
    """
    names, schema = docs.columns, docs.schema

    def make():
        def step(batch):
            columns, found = _opened(batch)
            texts = columns["text"].to_pylist()
            for i, (whole, spans) in enumerate(found):
                if (whole or spans) and texts[i]:
                    raw = texts[i].encode()
                    texts[i] = np.frombuffer(raw, np.uint8)[~covered(len(raw), whole, spans)].tobytes().decode("utf-8", "ignore")
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else columns[c] for c in names], names)

        return step

    out = map_texts(_joined(docs), make, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))
