"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Texts are bags of five-word shingles, weighted by term frequency and inverse
document frequency. Document frequencies are counted over all documents in
``BUCKETS`` hashed buckets, a table of fixed size. Each text gets ``BANDS`` x
``ROWS`` samples; texts that agree on all samples of a band are candidates.

No large bucket is expanded into pairs: all its texts are compared with one
leader (the least id), then with a few drawn from those unlike it, and so on
for ``rounds`` rounds. What links do not join so far is then compared without
exception, block against block: of each bucket, all texts but those of its
largest class are dealt to blocks, and every text of the bucket passes each of
them, so that rows grow with a bucket's size and only the work within a task
with its pairs. Links are verified by weighted Jaccard similarity and joined
into classes by repeated minimum labels. Equal texts count once throughout.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm.common import discard, drop_unused, map_texts, materialize, mix64, table, texts_of

WIDTH, BANDS, ROWS = 5, 10, 4
BUCKETS, BLOCKS = 1 << 20, 64
#: Share of a shingle's weight that does not depend on its document frequency.
FLOOR = 0.8
#: Room for rounding where pairs are ruled out by weight.
SLACK = 1e-4
STEP, PRIME = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of many texts: shingle keys sorted within each text, their counts, and how many each text has.

    Words are runs without white space in lower case. A text of one to four
    words is one shingle; a text without words has none.
    """
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.array([w for own in words for w in own], object)
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    n = len(hashes) - WIDTH + 1
    windows = np.zeros(max(0, n), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WIDTH):
            windows = windows * PRIME + hashes[i : i + max(0, n)]
    windows = mix64(windows)
    keys, counts, per = [], [], np.zeros(len(texts), np.int64)
    for j, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        if size >= WIDTH:
            k, c = np.unique(windows[end - size : end - WIDTH + 1], return_counts=True)
        elif size:
            k, c = mix64(reduce(lambda a, b: a * PRIME + b, hashes[end - size : end].reshape(-1, 1), np.array([size], np.uint64))), np.ones(1, np.int64)
        else:
            continue
        keys.append(k)
        counts.append(c)
        per[j] = len(k)
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), (np.concatenate(counts) if counts else np.zeros(0, np.int64)), per


def parts(texts: list[str], chars: int = 1_000_000) -> list[np.ndarray]:
    """Numbers of the texts in runs of about ``chars`` characters, to bound what is worked on at once."""
    return np.split(np.arange(len(texts)), np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // chars)) + 1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents' shingles in each hashed bucket over all rows, and the number of rows.

    A task hands on one table of counts in blocks; blocks are added up in two
    steps, so that no group grows with the number of tasks beyond its root.
    """

    def count(batches):
        import uuid

        from pyspark import TaskContext

        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            texts = texts_of(batch)
            for part in parts(texts):
                keys, _, _ = shingles([texts[i] for i in part])
                total += np.bincount((keys & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        task = TaskContext.get().partitionId() if TaskContext.get() else uuid.uuid4().int % 1024
        blobs = [b.astype(np.int64).tobytes() for b in np.split(total, BLOCKS)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([task] * BLOCKS, pa.int32()), pa.array([rows] + [0] * (BLOCKS - 1), pa.int64()), pa.array(blobs, pa.binary())], ["block", "part", "n", "counts"])

    schema = "block int, part int, n long, counts binary"

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        summed = sum((np.frombuffer(b, np.int64) for b in pdf["counts"]), np.zeros(BUCKETS // BLOCKS, np.int64))
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [0], "n": [int(pdf["n"].sum())], "counts": [summed.tobytes()]})

    found = docs.select("text").mapInArrow(count, schema)
    found = found.groupBy("block", (F.col("part") % 256).alias("slice")).applyInPandas(add, schema)
    rows = found.groupBy("block").applyInPandas(add, schema).collect()  # BLOCKS rows, 8 MB in all
    out = np.zeros((BLOCKS, BUCKETS // BLOCKS), np.int64)
    for r in rows:
        out[r.block] = np.frombuffer(bytes(r.counts), np.int64)
    return out.ravel(), sum(r.n for r in rows)


def frequency_weights(df: np.ndarray, n: int) -> np.ndarray:
    """Weight of one occurrence in each bucket: FLOOR for a shingle of all documents to 1 for a rare one."""
    idf = np.clip(np.log((n + 1) / (df + 1)) / max(np.log(n + 1), 1e-9), 0, 1)
    return (FLOOR + (1 - FLOOR) * idf).astype(np.float32)


def weigh(keys: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return counts.astype(np.float32) * weights[(keys & np.uint64(BUCKETS - 1)).astype(np.int64)]


def gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, by bisection of 1 - (1 + x) exp(-x)."""
    p, lo, hi = (np.arange(n) + 0.5) / n, np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        low = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return hi


class WeightedSampler:
    """Improved consistent weighted sampling; the variables come from tables of 2 ** 16 quantiles."""

    def __init__(self):
        q = gamma_quantiles()
        self.r, self.inverse, self.log_c = q.astype(np.float32), (1 / q).astype(np.float32), np.log(q).astype(np.float32)

    def bands(self, keys: np.ndarray, weights: np.ndarray, per: np.ndarray) -> np.ndarray:
        """BANDS keys (signed) of each text that has shingles."""
        per = per[per > 0]
        starts = np.cumsum(per) - per
        log_w, low = np.log(weights), np.uint64(0xFFFF)
        out = np.zeros((BANDS, len(per)), np.uint64)
        for band in range(BANDS):
            for row in range(ROWS):
                with np.errstate(over="ignore"):
                    z = mix64(keys + np.uint64(band * ROWS + row + 1) * STEP)
                i = (z & low).astype(np.int32)
                beta = ((z >> np.uint64(32)) & low).astype(np.float32) * np.float32(1 / 65536)
                t = np.floor(log_w * self.inverse[i] + beta)
                log_a = self.log_c[((z >> np.uint64(16)) & low).astype(np.int32)] - self.r[i] * (t - beta + 1)
                least = np.flatnonzero(log_a == np.repeat(np.minimum.reduceat(log_a, starts), per))
                at = least[np.searchsorted(least, starts)]
                with np.errstate(over="ignore"):
                    out[band] = mix64(out[band] * PRIME + (keys[at] ^ t[at].astype(np.int64).astype(np.uint64)) + np.uint64(band))
        return out.T.astype(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two bags (sorted keys, weights); 0 if both are empty."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    shared = float(np.minimum(a[1][at[same]], b[1][same]).sum()) if same.any() else 0.0
    total = float(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def sketch(docs: DataFrame, weights) -> DataFrame:
    """(doc_id, text_key, bands) of each row; no bands for a text without words."""

    def make():
        sampler, own = WeightedSampler(), weights.value

        def step(batch):
            texts = texts_of(batch)
            found = [None] * len(texts)
            for part in parts(texts):
                keys, counts, per = shingles([texts[i] for i in part])
                if len(keys):
                    bands = sampler.bands(keys, weigh(keys, counts, own), per)
                    for i, b in zip(part[per > 0], bands, strict=True):
                        found[i] = b
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text_key", "bands"])

        return step

    return map_texts(docs, make, "doc_id long, text_key string, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """(leader, node) of the pairs whose texts' similarity reaches ``threshold``; texts: (id, text)."""
    with_node = pairs.join(texts.select(F.col("id").alias("node"), F.col("text").alias("node_text")), "node")
    both = with_node.join(texts.select(F.col("id").alias("leader"), F.col("text").alias("leader_text")), "leader")

    def make():
        own, last = weights.value, [None, None]

        def bag(text):
            keys, counts, _ = shingles([text])
            return keys, weigh(keys, counts, own)

        def step(batch):
            keep = []
            for leader, a, b in zip(*(batch.column(c).to_pylist() for c in ("leader", "leader_text", "node_text")), strict=True):
                if last[0] != leader:
                    last[:] = leader, bag(a)
                keep.append(weighted_jaccard(last[1], bag(b)) >= threshold)
            return batch.select(["leader", "node"]).filter(pa.array(keep, pa.bool_()))

        return step

    return map_texts(both.select("leader", "node", "leader_text", "node_text"), make, "leader long, node long")


def apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, id, component) of the buckets whose texts ``links`` (leader, node) do not all join."""
    classes = components(links.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    labelled = members.join(classes.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    labelled = materialize(labelled, "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("bucket")
    return labelled.join(mixed, "bucket", "left_semi")


def grid(split: DataFrame, block_chars: int = 1_000_000, stripe_chars: int = 8_000_000) -> DataFrame:
    """(bucket, block, stripe, held, id, component): the texts of ``split`` (bucket, id, component, size) dealt to tasks.

    ``held`` texts, those outside the bucket's largest component, are dealt to
    blocks by hash and stand in every stripe; each text of the bucket is in one
    stripe and passes all blocks. So any two texts of a bucket and of two
    components meet, and no group is much larger than a block and a stripe.
    """
    kinds = split.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    whole = kinds.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.max_by("size", F.struct("n", "component")).alias("most"), F.sum("size").alias("size"))
    cuts = whole.select("bucket", "largest", F.ceil((F.col("size") - F.col("most") + 1) / block_chars).alias("blocks"), F.ceil((F.col("size") + 1) / stripe_chars).alias("stripes"))
    rows = split.drop("size").join(cuts, "bucket")
    all_of = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    held = rows.filter("component <> largest").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("stripe", F.explode(all_of("stripes")))
    passing = rows.withColumn("stripe", F.pmod(F.xxhash64(F.lit(1), "id"), "stripes")).withColumn("block", F.explode(all_of("blocks")))
    either = [r.select("bucket", "block", "stripe", F.lit(h).alias("held"), "id", "component") for r, h in ((held, True), (passing, False))]
    return either[0].unionByName(either[1])


class Block:
    """Texts that others are compared with all at once: their shingles in order, with the texts that have them."""

    def __init__(self, texts: list[str], weights: np.ndarray):
        keys, counts, per = shingles(texts)
        weight = weigh(keys, counts, weights)
        owner = np.repeat(np.arange(len(texts)), per)
        self.bags = list(zip(np.split(keys, np.cumsum(per)[:-1]), np.split(weight, np.cumsum(per)[:-1]), strict=True))
        self.total = np.bincount(owner, weight, len(texts))
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.weight = keys[order], owner[order], weight[order]

    def alike(self, bag: tuple[np.ndarray, np.ndarray], threshold: float) -> list[int]:
        """Numbers of the texts whose similarity with ``bag`` (sorted keys, weights) reaches ``threshold``."""
        lo, hi = (np.searchsorted(self.keys, bag[0], side) for side in ("left", "right"))
        times = hi - lo
        at = np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())
        shared = np.bincount(self.owner[at], np.minimum(self.weight[at], np.repeat(bag[1], times)), len(self.total))
        near = np.flatnonzero(shared >= (threshold - SLACK) * (self.total + float(bag[1].sum()) - shared))
        return [i for i in near.tolist() if weighted_jaccard(self.bags[i], bag) >= threshold]


def joining_links(split: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """(leader, node): links that join the components of ``split`` (bucket, id, component) as far as texts of a bucket are alike.

    Every pair of a bucket and of two components is compared, but for those
    that links found in the same task join already.
    """

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own, found = weights.value, []
        held, passing = pdf[pdf["held"]], pdf[~pdf["held"]]
        ids, kinds = held["id"].tolist(), held["component"].tolist()
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = x = root.get(y, y)
            return x

        block = Block(held["text"].tolist(), own)
        for i, kind, text in zip(passing["id"].tolist(), passing["component"].tolist(), passing["text"].tolist(), strict=True):
            keys, counts, _ = shingles([text])
            for j in block.alike((keys, weigh(keys, counts, own)), threshold):
                if (a := top(kinds[j])) != (b := top(kind)):
                    root[max(a, b)] = min(a, b)
                    found.append((min(i, ids[j]), max(i, ids[j])))
        return pd.DataFrame(found, columns=["leader", "node"], dtype="int64")

    sized = split.join(texts.select("id", F.length("text").alias("size")), "id")
    dealt = materialize(grid(sized), "grid").join(texts, "id")
    return dealt.groupBy("bucket", "block", "stripe").applyInPandas(compare, "leader long, node long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least id it is connected with.

    Each round a node's label becomes the least among its label's label and
    its neighbours' labels' labels, and the node that is its label takes the
    latter too, so that whole regions move at once. Labels only fall; it ends
    when none moves, and then neighbours have equal labels.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    old = labels
    while True:
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        ahead = materialize(labels.join(jump, "component").select("node", "component", "far"), "ahead")
        near = both.join(ahead.select(F.col("node").alias("b"), "far"), "b").groupBy("a").agg(F.min("far").alias("near"))
        hook = ahead.join(near, ahead.node == near.a).select("node", "component", F.least("far", "near").alias("far"))
        moves = hook.select("node", "far").union(hook.groupBy("component").agg(F.min("far").alias("far")))
        least = moves.groupBy("node").agg(F.min("far").alias("far"))
        new = materialize(labels.join(least, "node").select("node", F.least("component", "far").alias("component"), (F.col("far") < F.col("component")).alias("moved")), "labels")
        discard(old, ahead)
        labels, old = new.select("node", "component"), new
        if new.filter("moved").isEmpty():
            discard(both)
            return labels


def _drawn(open_: DataFrame, turn: int, n: int = 4) -> DataFrame:
    """(bucket, leader): up to ``n`` open texts of each bucket, drawn by hash; combined before the shuffle."""
    least = [F.min(F.struct(F.xxhash64("id", "bucket", F.lit(turn * n + k)).alias("h"), "id"))["id"] for k in range(n)]
    return open_.groupBy("bucket").agg(F.array_distinct(F.array(*least)).alias("l")).select("bucket", F.explode("l").alias("leader"))


def _met(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """(leader, node): the leaders (bucket, leader) with all others of their bucket, the lesser id first."""
    met = members.join(leaders, "bucket").filter("id <> leader")
    return met.select(F.least("id", "leader").alias("leader"), F.greatest("id", "leader").alias("node")).distinct()


def _settle(pairs: DataFrame, tried: DataFrame | None, links: list[DataFrame], made: list[DataFrame], texts: DataFrame, weights, threshold: float) -> DataFrame:
    """Adds the links among ``pairs`` not ``tried`` to ``links``, and tables to ``made``; returns all that are tried by now."""
    if tried is not None:
        pairs = pairs.join(tried, ["leader", "node"], "left_anti")
    pairs = materialize(pairs, "pairs")
    links.append(materialize(verify(pairs, texts, weights, threshold), "verified"))
    made += [pairs, links[-1]]
    drop_unused(pairs.sparkSession)
    return pairs if tried is None else tried.unionByName(pairs)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, rounds: int = 3) -> DataFrame:
    """(doc_id, class_id, keep) of each row of ``docs`` (doc_id, text).

    Every candidate pair is in one class already or compared. ``rounds``, the
    turns with leaders, change the work and not the classes.

    ``class_id`` is the least doc_id of the class, ``keep`` marks that
    document (all its rows if repeated). Null and empty texts are equal texts,
    as are all exact copies; a text without words is like its exact copies
    only. Rows with one doc_id fall into one class. Null doc_ids are left out.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("text_key"))
    df, n = document_frequencies(rows)
    weights = spark.sparkContext.broadcast(frequency_weights(df, n))
    sketched = sketch(rows, weights).groupBy("text_key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    unique = materialize(sketched, "sketches")
    drop_unused(spark)

    keyed = unique.select("id", F.posexplode("bands").alias("band", "key")).select("id", F.xxhash64("band", "key").alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = materialize(keyed.join(sizes, "bucket"), "members")
    wanted = members.select("id").distinct()
    texts = rows.select(F.col("doc_id").alias("id"), "text", "text_key").join(unique.select("id", "text_key").join(wanted, "id", "left_semi"), ["id", "text_key"], "left_semi")
    texts = materialize(texts.dropDuplicates(["id", "text_key"]).select("id", "text"), "texts")
    drop_unused(spark)

    open_, links, tried, made = members, [], None, [members, texts]
    for turn in range(rounds):
        leaders = open_.groupBy("bucket").agg(F.min("id").alias("leader")) if turn == 0 else _drawn(open_, turn)
        tried = _settle(_met(members, leaders), tried, links, made, texts, weights, threshold)
        linked = reduce(DataFrame.unionByName, links)
        either = linked.select("leader", F.col("node").alias("id")).union(linked.select(F.col("node").alias("leader"), F.col("leader").alias("id")))
        # a text stays open in a bucket unless it led there or is linked with one that did
        led = leaders.select("bucket", F.col("leader").alias("id"))
        taken = leaders.join(either, "leader").select("bucket", "id").distinct()
        open_ = materialize(open_.join(led, ["bucket", "id"], "left_anti").join(taken, ["bucket", "id"], "left_anti"), "open")
        made.append(open_)
        if open_.isEmpty():
            break
    # a text taken by one leader may still be like one taken by another: all that links do not join so far is compared
    split = materialize(apart(members, reduce(DataFrame.unionByName, links)), "split")
    links.append(materialize(joining_links(split, texts, weights, threshold), "joining"))
    made += [split, links[-1]]
    drop_unused(spark)
    classes = components(reduce(DataFrame.unionByName, links).select(F.col("leader").alias("a"), F.col("node").alias("b")))
    discard(*made)
    of_text = unique.select("text_key", "id").join(classes.select(F.col("node").alias("id"), "component"), "id", "left").select("text_key", F.coalesce("component", "id").alias("class_id"))
    out = rows.select("doc_id", "text_key").join(of_text, "text_key")
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("keep"))


def without_near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that represent their class, with all their columns."""
    dropped = near_duplicates(docs, threshold).filter("not keep").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
