"""Token counts by a map-side two-tier lookup.

A text's count is the sum of its pre-tokens' lengths in tokens. Tier one is a
broadcast table of frequent pre-tokens, tier two a bounded cache in each
worker, filled by encoding misses in one batch. No pre-token of the corpus is
shuffled. Texts with a special string go to the library
whole, since special strings are cut out before pre-tokenisation.
"""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import least_hashed, map_texts, table, texts_of

#: Fixed values of the tokenizer's own file: its pre-token pattern.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Up to here composition is the identity and lower-casing is per character.
PLAIN = regex.compile("[\\x00-\\x1b\\x20-ɏ]*")


class PreTokenizer:
    """Splits as the tokenizer file at ``path`` does; one per worker.

    A file whose normalizer and splitter are others than those the fast way
    copies is refused, since it would be counted wrongly.
    """

    #: Kinds of normalizers and splitters that the fast way stands for.
    NORMAL, SPLIT = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        normal, split = (made.get("normalizer") or {}).get("normalizers", []), (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [n["type"] for n in normal] != self.NORMAL or [p["type"] for p in split] != self.SPLIT or split[0]["pattern"] != {"Regex": PRE_TOKEN.pattern} or made["model"].get("dropout"):
            raise ValueError("not a tokenizer of lower-cased words")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def split(self, text: str) -> list[str] | None:
        """Pre-tokens, or None if the text holds a special string."""
        if any(s in text for s in self.special):
            return None
        if PLAIN.fullmatch(text):
            return PRE_TOKEN.findall(text.lower())
        text = self.tok.normalizer.normalize_str(text)
        # the second step of the library's own splitter only renames bytes, so offsets still fit
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def lengths(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]


def _single_thread() -> None:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def frequent_pretokens(docs: DataFrame, path: str, size: int = 65_536, sample: int = 4096) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of at most ``sample`` different texts, those with the least hash.

    The table affects speed only, so a bounded sample will do: neither a pass
    over all texts nor a shuffle of their pre-tokens is needed.
    """

    def summary(batches):
        _single_thread()
        pre, seen = PreTokenizer(path), Counter()
        for batch in batches:
            for text in texts_of(batch):
                seen.update(pre.split(text) or ())
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    top = least_hashed(docs, sample).mapInArrow(summary, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(size)
    words = [r.w for r in top.collect()]
    _single_thread()
    return dict(zip(words, PreTokenizer(path).lengths(words), strict=True))


def count_tokens(docs: DataFrame, path: str, frequent: dict[str, int] | None = None, cache_entries: int = 500_000, cache_chars: int = 16_000_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text).

    Null text counts as empty (0 tokens); repeated rows are counted each;
    ``path`` is the tokenizer file, ``cache_entries`` and ``cache_chars`` bound a
    worker's cache (it is emptied when full). Other columns are ignored.
    """
    spark = docs.sparkSession
    tier_one = spark.sparkContext.broadcast(frequent_pretokens(docs, path) if frequent is None else frequent)

    def make():
        _single_thread()
        pre, known, cache, held = PreTokenizer(path), tier_one.value, {}, 0

        def step(batch):
            nonlocal held
            texts = texts_of(batch)
            counts = [0] * len(texts)
            for i, text in enumerate(texts):
                words = pre.split(text)
                if words is None:
                    counts[i] = len(pre.tok.encode(text, add_special_tokens=False).ids)
                    continue
                missed = {w for w in words if w not in known and w not in cache}
                if missed:
                    more = sum(map(len, missed))
                    if len(cache) + len(missed) > cache_entries or held + more > cache_chars:
                        cache.clear()
                        missed = {w for w in words if w not in known}
                        held, more = 0, sum(map(len, missed))
                    held += more
                    missed = list(missed)
                    cache.update(zip(missed, pre.lengths(missed), strict=True))
                counts[i] = sum(known[w] if w in known else cache[w] for w in words)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

        return step

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n_bytes long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > 2048) of all documents."""
    import public_tokenizers

    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
