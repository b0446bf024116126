"""Importance resampling towards a target distribution over hashed n-grams.

Texts are scanned by an Aho-Corasick automaton over delimiter-bounded words:
each word it knows comes out as a payload, the word's CRC-32 and its length in
bytes. An n-gram's CRC follows from the payloads of its words by composition,
without its bytes being put together, and its bucket from the CRC. Buckets are
counted over all texts and over the target, a bucket's gain is the logarithm
of the ratio of the two smoothed shares, a text's weight the sum of its gains,
and a seeded Gumbel draw without replacement takes the highest scores.

A worker's dictionary starts empty and takes in the words it has missed, so
that it fits what that worker reads; it holds at most ``max_words`` words. A
word it lacks gets the same payload from its bytes, so results do not depend
on it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import materialize, table, texts_of

#: A-Z to lower case; all of ASCII that is no letter or digit becomes a space, the delimiter.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: The polynomial of CRC-32, bits reversed.
CRC_POLYNOMIAL = 0xEDB88320


def _zero_tables(levels: int = 32) -> np.ndarray:
    """[level, byte's place, byte]: what a CRC's bytes become after 2^level zero bytes."""
    one = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ CRC_POLYNOMIAL, one >> 1)
    place = np.arange(256, dtype=np.uint64)
    step = np.stack([one, place, place << 8, place << 16])  # one zero byte: shift down, the low byte is looked up
    out = [step]
    for _ in range(levels - 1):
        step = np.stack([_apply(step, step[k]) for k in range(4)])
        out.append(step)
    return np.stack(out)


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


ZEROS = _zero_tables()
SPACE_CRC = zlib.crc32(b" ")


def compose(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings put together, from theirs and the length of the second."""
    crc = left.astype(np.uint64)
    for level in range(int(right_length.max(initial=0)).bit_length()):
        crc = np.where(right_length >> level & 1, _apply(ZEROS[level], crc), crc)
    return crc ^ right


class WordDictionary:
    """An automaton over words between delimiters, with a payload (crc, length) for each."""

    def __init__(self, max_words: int = 300_000):
        self.max_words, self.number, self.missed = max_words, {}, {}
        self.crc, self.length, self.automaton = np.zeros(0, np.uint64), np.zeros(0, np.int64), None

    def _build(self) -> None:
        """Take in missed words, most often missed first, as far as there is room."""
        room = self.max_words - len(self.number)
        for w in sorted(self.missed, key=self.missed.get, reverse=True)[:room]:
            self.number[w] = len(self.number)
        self.missed = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for w, i in self.number.items():
            self.automaton.add_word(f" {w} ", i)
        self.automaton.make_automaton()
        self.crc = np.array([zlib.crc32(w.encode("latin-1")) for w in self.number], np.uint64)
        self.length = np.array([len(w) for w in self.number], np.int64)

    def scan(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """crc and length of each word of the texts in order, and each text's number of words."""
        joined = b" ".join([b"", *(t.encode().translate(PLAIN) for t in texts), b""])
        sizes = np.array([len(t.encode()) for t in texts], np.int64)
        at = np.frombuffer(joined, np.uint8) != 32
        first = np.flatnonzero(at[1:] & ~at[:-1]) + 1
        last = np.flatnonzero(at[:-1] & ~at[1:]) + 1
        edges = np.cumsum([0, *(sizes + 1)]) + 1
        per_text = np.diff(np.searchsorted(first, edges)) if len(texts) else np.zeros(0, np.int64)
        crc, length = np.zeros(len(first), np.uint64), last - first
        known = np.zeros(len(first), bool)
        if self.automaton is not None and len(first):
            letters = joined.decode("latin-1")
            found = np.fromiter(self.automaton.iter(letters), np.dtype([("end", np.int64), ("word", np.int64)]))
            # a match ends with the delimiter after its word
            i = np.searchsorted(last, found["end"])
            crc[i], known[i] = self.crc[found["word"]], True
        if not known.all():
            self._spell(joined, first, last, crc, np.flatnonzero(~known))
        return crc, length, per_text

    def _spell(self, joined: bytes, first: np.ndarray, last: np.ndarray, crc: np.ndarray, which: np.ndarray) -> None:
        words = [joined[a:b] for a, b in zip(first[which].tolist(), last[which].tolist(), strict=True)]
        crc[which] = list(map(zlib.crc32, words))
        if len(self.number) < self.max_words:
            for w in words:
                if len(w) <= 64 and len(self.missed) < self.max_words:
                    w = w.decode("latin-1")
                    self.missed[w] = self.missed.get(w, 0) + 1
            # built anew only once it grows by half, so the work of building is a few times that of the last one
            if len(self.missed) > max(2000, len(self.number) // 2) or len(self.missed) + len(self.number) >= self.max_words:
                self._build()


#: One a worker process; payloads are properties of words, so it serves any scan.
_DICTIONARY: list[WordDictionary] = []


def worker_dictionary() -> WordDictionary:
    if not _DICTIONARY:
        _DICTIONARY.append(WordDictionary())
    return _DICTIONARY[0]


def features(texts: list[str], n_max: int, n_buckets: int, dictionary: WordDictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each feature, the text it is of, and each text's number of words: all runs of 1 to ``n_max`` words."""
    crc, length, words = dictionary.scan(texts)
    text = np.repeat(np.arange(len(texts)), words)
    buckets, of, run = [(crc % n_buckets).astype(np.int64)], [text], crc
    spaced = compose(np.full(len(crc), SPACE_CRC, np.uint64), crc, length) if n_max > 1 else crc
    for n in range(2, n_max + 1):
        if len(crc) < n:
            break
        # the run that ends here is the one that ended a word before, a space and this word
        run = compose(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1)
        same = text[n - 1 :] == text[: len(text) - n + 1]
        buckets.append((run[same] % n_buckets).astype(np.int64))
        of.append(text[n - 1 :][same])
    return np.concatenate(buckets), np.concatenate(of), words


def blocks_of(texts: list[str], block_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters; a longer text is a range by itself."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= block_chars or i == len(texts) - 1:
            yield a, i + 1
            a, held = i + 1, 0


def bucket_counts(docs: DataFrame, n_max: int = 1, n_buckets: int = 10_000) -> DataFrame:
    """bucket, n: features of all texts (column text) by bucket, added up in each task before the shuffle; empty buckets are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, dictionary = np.zeros(n_buckets, np.int64), worker_dictionary()
        for batch in batches:
            texts = texts_of(batch)
            for a, b in blocks_of(texts):
                total += np.bincount(features(texts[a:b], n_max, n_buckets, dictionary)[0], minlength=n_buckets)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, n_buckets: int = 10_000) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source: at most ``n_buckets`` rows of each come to the driver."""
    s, t = (np.zeros(n_buckets, np.int64) for _ in range(2))
    for counts, into in ((source, s), (target, t)):
        for r in counts.collect():
            into[r.bucket] = r.n
    return np.floor(1000 * np.log((t + 1.0) * float(s.sum() + n_buckets) / ((s + 1.0) * float(t.sum() + n_buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n_max: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight (sum of its features' gains) of every row (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, dictionary = sent.value, worker_dictionary()
        for batch in batches:
            texts = texts_of(batch)
            n_words, n_features, weight = [], [], []
            for a, b in blocks_of(texts):
                buckets, of, words = features(texts[a:b], n_max, len(own), dictionary)
                order = np.argsort(of, kind="stable") if n_max > 1 else slice(None)
                sums = np.concatenate([[0], np.cumsum(own[buckets[order]])])
                each = np.bincount(of, minlength=b - a)
                edges = np.cumsum(np.concatenate([[0], each]))
                n_words.append(words)
                n_features.append(each)
                weight.append(sums[edges[1:]] - sums[edges[:-1]])
            if texts:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (n_words, n_features, weight)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int, key) -> F.Column:
    """floor(-1000 ln(-ln u)) with u from the first 8 hexadecimal digits of sha256(seed:key)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int, least_words: int = 20) -> DataFrame:
    """Adds ``rank``, 1 2 3 ... from the highest score, to the best ``percent`` of the rows with ``least_words`` words; null for the rest.

    Rows (doc_id, n_words, score, ...); ties go to the smaller doc_id, null
    first. A sketch tells a score that the drawn rows are surely above, so
    only somewhat more rows than are drawn are sorted, by ranges of score,
    doc_id and place, which repeated rows cannot make uneven. Ranks follow from
    a row's place in its range and the sizes of the ranges before.
    """
    spark = scored.sparkSession
    fits = F.col("n_words") >= least_words
    share = max(0.0, 1 - percent / 100 - 0.002)
    n, low = scored.filter(fits).agg(F.count(F.lit(1)), F.percentile_approx("score", share, 10_000)).first()
    k = percent * n // 100
    if k and scored.filter(fits & (F.col("score") >= low)).count() < k:
        low = None  # never seen: the sketch is within 0.0001
    high = fits & (F.col("score") >= low if low is not None else F.lit(True)) & F.lit(k > 0)
    keys = F.col("score").desc(), F.col("doc_id").asc_nulls_first()
    dealt = scored.filter(high).withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*keys, "place").sortWithinPartitions(*keys, "place")
    # the number counts on within a range and has the range's own above its lowest 33 bits
    placed = materialize(dealt.drop("place").withColumn("place", F.monotonically_increasing_id()), "ranked")
    sizes = sorted((r.part, r.n) for r in placed.groupBy(F.shiftright("place", 33).cast("int").alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = F.broadcast(spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part int, before long"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.join(offsets, F.shiftright("place", 33).cast("int") == F.col("part")).withColumn("rank", F.when(rank <= k, rank))
    rest = scored.filter(~F.coalesce(high, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int, n_max: int = 1, n_buckets: int = 10_000, seed: int = 2024, least_words: int = 20) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Null text has no features and weight 0; repeated rows each count, score
    alike and are ranked one after another; an empty ``docs`` gives no rows, an
    empty ``target`` a flat one. Texts are read twice, to count and to score,
    and nothing but bucket counts and (doc_id, score) rows is shuffled.
    """
    gain = gains(bucket_counts(docs, n_max, n_buckets), bucket_counts(target, n_max, n_buckets), n_buckets)
    scored = materialize(weigh(docs, gain, n_max).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))), "scored")
    return draw(scored, percent, least_words)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in ten of the documents of 20 words or more, drawn towards the benchmark's words."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
