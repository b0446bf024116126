"""Token ids as fixed-width bit-packed files, with block offsets for random access.

A file holds the ids of consecutive documents: a head, blocks of ``BLOCK`` ids
packed in the fewest bits the vocabulary needs, then the offsets and checksums
of blocks, the documents' numbers and where each begins, and a tail with the
place of that index. Files are written by the tasks that encode, to names that
no other attempt uses; only the files named in the manifest, a table that
Spark writes once all tasks have ended, belong to the result. So a lost
executor or a second attempt leaves nothing but files nobody reads.

Paths are URIs that ``pyarrow.fs`` opens (local or shared folders, HDFS, S3).
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import scratch_folder, table, texts_of

MAGIC = b"PACKIDS1"
BLOCK = 65_536
HEAD = struct.Struct("<8sII")
TAIL = struct.Struct("<QQQII8s")

MANIFEST = "part int, seq int, path string, n_ids long, n_docs long, n_bytes long"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, least significant first, the last byte filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id of {int(ids.max())} does not fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int, first: int = 0) -> np.ndarray:
    """``n`` ids from the ``first`` on: each lies in the eight bytes that begin at its own first byte."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n, first * bits // 8).astype(np.uint32)
    padded = data + bytes(8)
    at = (np.arange(first, first + n, dtype=np.int64)) * bits
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    return ((words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def open_folder(path: str):
    """File system and place of a URI; Hadoop's names of S3 are taken too."""
    from pyarrow import fs

    path = re.sub("^s3[an]:", "s3:", path)
    return fs.FileSystem.from_uri(path if re.match(r"[a-z0-9+]+://|file:/", path) else "file://" + path)


class IdWriter:
    """One file, written block by block; memory holds a block and the documents' index."""

    def __init__(self, path: str, bits: int):
        system, place = open_folder(path)
        self.path, self.bits, self.out = path, bits, system.open_output_stream(place)
        self.out.write(HEAD.pack(MAGIC, bits, BLOCK))
        self.at, self.offsets, self.sums, self.left, self.n_left, self.n_ids, self.docs, self.starts = HEAD.size, [], [], [], 0, 0, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.left.append(ids)
        self.n_left += len(ids)
        if self.n_left >= BLOCK:
            ids = np.concatenate(self.left)
            whole = len(ids) // BLOCK * BLOCK
            for a in range(0, whole, BLOCK):
                self._block(ids[a : a + BLOCK])
            self.left, self.n_left = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.sums.append(zlib.crc32(data))
        self.out.write(data)
        self.at += len(data)

    def close(self) -> tuple[str, int, int, int]:
        """path, ids, documents and bytes of the finished file."""
        if self.n_left:
            self._block(np.concatenate(self.left))
        known = np.array([d is not None for d in self.docs], np.uint8)
        index = np.array([*self.offsets, self.at], "<u8").tobytes() + np.array(self.sums, "<u4").tobytes() + known.tobytes()
        index += np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array([*self.starts, self.n_ids], "<u8").tobytes()
        self.out.write(index + TAIL.pack(self.at, self.n_ids, len(self.docs), len(self.offsets), zlib.crc32(index), MAGIC))
        self.out.close()
        return self.path, self.n_ids, len(self.docs), self.at + len(index) + TAIL.size


class IdReader:
    """Random access to one file: the index is read at once, blocks as they are asked for."""

    def __init__(self, path: str):
        system, place = open_folder(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        if size < HEAD.size + TAIL.size:
            raise ValueError(f"not a whole file of packed ids: {path}")
        magic, self.bits, self.block = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        at, self.n_ids, n_docs, n_blocks, crc, end = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        index = self.file.read_at(size - TAIL.size - at, at) if magic == end == MAGIC and HEAD.size <= at <= size - TAIL.size else b"cut"
        if zlib.crc32(index) != crc:
            raise ValueError(f"not a whole file of packed ids: {path}")
        parts, a = [], 0
        for kind, n in (("<u8", n_blocks + 1), ("<u4", n_blocks), ("u1", n_docs), ("<i8", n_docs), ("<u8", n_docs + 1)):
            parts.append(np.frombuffer(index, kind, n, a))
            a += parts[-1].nbytes
        self.offsets, self.sums, self.known, self.docs, starts = parts
        self.starts = starts.astype(np.int64)

    def read_block(self, k: int) -> np.ndarray:
        """All ids of block ``k``, checked against its sum."""
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        data = self.file.read_at(b - a, a)
        if zlib.crc32(data) != self.sums[k]:
            raise ValueError(f"block {k} is damaged")
        return unpack(data, min(self.block, self.n_ids - k * self.block), self.bits)

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last``, without the last: only the blocks that hold them are read."""
        first, last = max(0, first), min(last, self.n_ids)
        if first >= last:
            return np.zeros(0, np.uint32)
        k, z = first // self.block, (last - 1) // self.block
        ids = np.concatenate([self.read_block(i) for i in range(k, z + 1)])
        return ids[first - k * self.block : last - k * self.block]

    def close(self) -> None:
        self.file.close()


def write_ids(docs: DataFrame, path: str, make_encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]], vocabulary: int, end_id: int | None = None, file_ids: int = 1 << 24) -> DataFrame:
    """Encode documents (doc_id, text) into files below ``path`` in ascending order of doc_id and return their manifest.

    ``make_encoder()`` is called once a task and gives a function from texts
    to arrays of ids. ``end_id`` is appended to each document. A file closes
    once it holds ``file_ids`` ids. Null text counts as empty; null doc_id
    comes first; rows that share a doc_id stand in the order of their texts.
    Ranges part by doc_id, text and place in the input, so that a very common
    doc_id is spread over tasks. An empty table gives an empty manifest.
    """
    bits = bits_for(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("place", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "place").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt, encode, end = TaskContext.get().partitionId(), uuid.uuid4().hex, make_encoder(), [] if end_id is None else [end_id]
        out, made = None, []
        for batch in batches:
            ids_of = encode(texts_of(batch))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                out = out or IdWriter(f"{path}/ids-{part:06d}-{len(made):05d}-{attempt}.bits", bits)
                out.add(doc_id, np.append(ids, end).astype(np.uint32))
                if out.n_ids >= file_ids:
                    made.append(out.close())
                    out = None
        if out:
            made.append(out.close())
        if made:
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": k, "path": p, "n_ids": n, "n_docs": d, "n_bytes": b} for k, (p, n, d, b) in enumerate(made)], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64())]))

    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    dealt.select("doc_id", "text").mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest.parquet")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest.parquet")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all files before: the manifest has one row for each file, so it is summed at the driver.

    A file holds 2^24 ids or a task's whole share, so the rows are at most the
    tasks and the ids divided by 2^24 (64 MB of text a row or more).
    """
    rows = sorted(manifest.collect(), key=lambda r: (r.part, r.seq))
    before = np.cumsum([0, *(r.n_ids for r in rows)])
    out = [(*r, int(n)) for r, n in zip(rows, before, strict=False)]
    return manifest.sparkSession.createDataFrame(out, f"{MANIFEST}, start long").repartition(max(1, len(out)))


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, from the files of a manifest.

    A file is read block by block; what is held is a block and the file's
    index, and with ``with_ids`` the ids of a document.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids

    def rows_of(path: str, start: int) -> Iterator[tuple]:
        reader, k, block = IdReader(path), -1, None
        for i, (known, doc_id) in enumerate(zip(reader.known.tolist(), reader.docs.tolist(), strict=True)):
            a, z, crc, own = int(reader.starts[i]), int(reader.starts[i + 1]), 0, []
            at = a
            while at < z:
                if at // reader.block != k:
                    k = at // reader.block
                    block = reader.read_block(k)
                some = block[at - k * reader.block : z - k * reader.block]
                crc = zlib.crc32(some.astype("<u4"), crc)
                at += len(some)
                own += some.tolist() if with_ids else ()
            yield (doc_id if known else None, start + a, z - a, crc, own)[: len(fields)]
        reader.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], [f[0] for f in fields])

        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows, held = [], 0
                for row in rows_of(path, start):
                    rows.append(row)
                    held += 1 + (row[2] // 1000 if with_ids else 0)
                    if held >= 10_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return with_starts(manifest).select("path", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def read_range(manifest: DataFrame, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (without the last) of the whole stream: opens only the files and reads only the blocks that hold them."""
    out = [np.zeros(0, np.uint32)]
    for r in with_starts(manifest).filter((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first)).orderBy("start").collect():
        reader = IdReader(r.path)
        out.append(reader.read(first - r.start, last - r.start))
        reader.close()
    return np.concatenate(out)


#: White space as the byte-level pre-tokenizer's pattern has it, which is Unicode's property.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SPACES = re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001))))
#: Marks that end units, and letters and digits after which they are a pre-token of their own.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = frozenset(re.findall("[0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]", "".join(map(chr, range(256)))))


def is_odd(text: str) -> bool:
    """A space beside other white space."""
    return any(c + " " in text or " " + c in text for c in SPACES if c in text)


class Units(dict):
    """Ids of units; notes down those that it is asked for and lacks."""

    def __init__(self):
        self.lacked: list[str] = []

    def __missing__(self, unit: str) -> None:
        self.lacked.append(unit)


class ByteLevelEncoder:
    """Ids of texts as the byte-level tokenizer at ``path`` gives them, with a bounded cache of units.

    The pre-tokenizer's pattern joins white space to nothing but a word that
    follows a single space; so a text's ids are those of its units, a space
    and what follows up to the next one. Where a space stands beside other
    white space, units are found by pattern instead, and a text with a special
    string goes to the library whole. A unit that is new goes to the library
    in parts that its pre-tokens do not cross: its lines, and of each the marks
    at the end, so that a word with and without a full stop is encoded once.
    ``cache_bytes`` bounds what the cache
    holds (the half not met of late goes when it is full); units of over ``longest`` characters are
    not kept. A file with a normalizer or another pre-tokenizer is refused.
    """

    def __init__(self, path: str, cache_bytes: int = 320 << 20, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        splitter = made["pre_tokenizer"] or {}
        if splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True) or made["normalizer"] or made["model"].get("dropout"):
            raise ValueError("not a plain byte-level tokenizer")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.line_end = self.tok.token_to_id("\u010a")
        self.between = np.array([self.line_end], "<u4").tobytes()
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        # units that begin a text or line and units after a space; what the young half has not met since it was begun goes with the old one
        self.young, self.old, self.held, self.cache_bytes, self.longest = (Units(), Units()), (Units(), Units()), 0, cache_bytes, longest

    def _encoded(self, units: list[str], after: bool) -> dict[str, bytes]:
        """Ids of units without white space from the library, a thousand in one text.

        After a space each has one token that begins with the space, its
        first. Others are parted by line ends: the pattern makes each line end
        a pre-token of its own there, and its id stands for no part of another.
        """
        out = {}
        for i in range(0, len(units), 1000):
            some = units[i : i + 1000]
            ids = np.array(self._ids([" " + " ".join(some) if after else "\n".join(some)])[0], "<u4")
            raw, cuts = ids.tobytes(), np.flatnonzero(self.spaced[ids] if after else ids == self.line_end) * 4
            firsts, lasts = (cuts.tolist(), [*cuts[1:].tolist(), len(raw)]) if after else ([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)])
            out.update(zip(some, (raw[a:b] for a, b in zip(firsts, lasts, strict=True)), strict=True))
        return out

    def _learn(self, units: set[str], after: bool) -> dict[str, bytes]:
        """Ids of units that the young half of the cache lacks, from the old half or the library."""
        old = self.old[after]
        new = {u: old[u] for u in units if u in old} if old else {}
        parted, odd, need = [], [], (set(), set())

        def cut(line: str, kind: bool) -> tuple[bool, str, str]:
            stem = line.rstrip(MARKS)
            stem = stem if stem[-1:] in LETTERS else line
            need[kind].add(stem)
            if stem != line:
                need[False].add(line[len(stem) :])
            return kind, stem, line[len(stem) :]

        for u in units.difference(new) if new else units:
            if u.isalpha():
                need[after].add(u)
            elif (lines := u.split()) == [u] or lines == u.split("\n"):
                parted.append((u, [cut(x, after and not i) for i, x in enumerate(lines)]))
            else:
                odd.append(u)
        found, ids_of = ({}, {}), []
        for kind in (False, True):
            known, gone = self.young[kind], self.old[kind]
            lacking = {u for u in need[kind] if u not in known}
            if gone:
                found[kind].update((u, gone[u]) for u in lacking if u in gone)
            found[kind].update(self._encoded([u for u in lacking if u not in gone], kind))
            ids_of.append(found[kind] if len(lacking) == len(need[kind]) else found[kind] | {u: known[u] for u in need[kind].difference(lacking)})
        new.update((u, self.between.join([ids_of[kind][stem] + ids_of[False][tail] if tail else ids_of[kind][stem] for kind, stem, tail in lines])) for u, lines in parted)
        before = " " if after else ""
        new.update(zip(odd, (np.array(x, "<u4").tobytes() for x in self._ids([before + u for u in odd])), strict=True))
        if self.held > self.cache_bytes // 2:
            self.old, self.young, self.held = self.young, (Units(), Units()), 0
        for kind, some in ((False, found[False]), (True, found[True]), (after, new)):
            if some and max(map(len, some)) > self.longest:
                some = {u: x for u, x in some.items() if len(u) <= self.longest}
            self.young[kind].update(some)
            self.held += 180 * len(some) + sum(map(len, some)) + sum(map(len, some.values()))
        return ids_of[after] | new

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        whole = [any(s in t for s in self.special) for t in texts]
        # a text is its first unit and the others of a text, each after a space, or units found by pattern
        first, rest, ends = [], [], []
        for t, w in zip(texts, whole, strict=True):
            if w:
                pass
            elif is_odd(t):
                first += UNIT.findall(t)
            else:
                tail = t.split(" ")
                first.append(tail[0])
                del tail[0]
                rest += tail
            ends.append((len(first), len(rest)))
        got = []
        for units, after in ((first, False), (rest, True)):
            known = self.young[after]
            ids, lacked, at = list(map(known.__getitem__, units)), known.lacked, -1
            known.lacked = []
            new = self._learn(set(lacked), after) if lacked else {}
            for u in lacked:
                at = ids.index(None, at + 1)
                ids[at] = new[u]
            got.append(ids)
        out = [np.frombuffer(b"".join(got[0][a:b] + got[1][c:d]), "<u4") for (a, c), (b, d) in itertools.pairwise([(0, 0), *ends])]
        return [np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32) if w else x for t, w, x in zip(texts, whole, out, strict=True)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out, at = [], 0
        for i, n in enumerate(np.cumsum([len(t) for t in texts])):
            if n - at >= 1_000_000 or i == len(texts) - 1:
                out += self._some(texts[len(out) : i + 1])
                at = n
        return out


#: One a worker process and file: ids of units are properties of the file.
_ENCODERS: dict[str, ByteLevelEncoder] = {}


def worker_encoder(path: str) -> ByteLevelEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = ByteLevelEncoder(path)
    return _ENCODERS[path]


def vocabulary_of(path: str) -> int:
    """Ids of the tokenizer file at ``path``, added ones included."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of all documents, read back from the packed files, each document closed by id 0."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = write_ids(table(spark, sf_dir, "documents"), scratch_folder(spark, "ids"), lambda: worker_encoder(path), vocabulary_of(path), end_id=0)
    return read_documents(manifest)
