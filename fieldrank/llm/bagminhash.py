"""Near duplicates by BagMinHash: weighted Jaccard of five-word shingle multisets.

**Signature.** A shingle with count w is the stretch [0, w) of a weight axis, discretised at
the integers and cut into dyadic intervals [0,1), [1,2), [2,4), [4,8), ... Every (shingle,
interval) has a Poisson process of its own, seeded by both: points in time with a rate equal
to the interval's width, each with a weight level in the interval and one of ``HASHES``
signature places. A point counts when its level lies below w, so only the last interval is
thinned; a place keeps its earliest counted point. Two documents agree in a place with
probability sum(min) / sum(max) of their counts, without bias. Points come in order of time,
so a process stops once it is later than the document's slowest place. One byte of each
place is kept (unequal points agree in it with probability 1/256).

**Bands.** ``BANDS`` bands of ``ROWS`` places give the buckets. Documents with the same
shingle multiset are one node first.

**Links without all pairs.** First each node is compared with the least node of its buckets,
which joins most copies at once. Buckets whose members then lie in one component are done.
For the others, a node's candidates are narrowed exactly: two multisets with the similarity
share an element (shingle, occurrence) among the rarest ``n - ceil(t n) + 1`` of each, so the
nodes are dealt to those elements; elements that no other node has only take up places,
which leaves nothing of a text with many edits of its own. Within an element's bucket only
leaders are compared with the members: round by round each bucket with two components gets
leaders (one, then 64 times as many each round), every member of another component that
the lengths and places allow is compared with them, and the leaders leave the bucket, since
all their pairs are known. The rounds end when no bucket has two components left: then each
pair that shares a band was compared, is connected already, or can't be similar, whatever
the bucket's size. Nothing is capped.

**Verification.** Pairs whose signatures agree in far fewer places than the threshold allows
(``SLACK`` standard deviations) are dropped, all others are compared by the exact multiset
overlap of their whole texts.

Defined results: words are runs without white space (space, 09 to 0D), A-Z lower-cased; a
text of fewer than five words has one shingle of all its words; texts without words (null,
empty, blank) are equal to one another; classes are the connected components of the links,
named by their least doc_id (null if all ids are null); repeated rows fall into one class;
an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
HASHES, ROWS, BANDS = 256, 8, 32
SLACK = 5.0
#: So many earlier buckets of a node are kept beside a row, to compare a pair once.
EARLIER = 32
CACHE_WORDS, BATCH_WORDS, BATCH_DOCS = 200_000, 200_000, 2_000
#: Points drawn at once for each process in documents with few shingles.
FEW, BLOCK = 64, 16
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for those seen lately."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def shingles(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words; of all words if they are fewer."""
    size = min(size, len(w))
    if not size:
        return w
    out = np.zeros(len(w) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * GOLDEN + w[k:len(w) - size + 1 + k])
    return out


def _fill(slots: np.ndarray, doc, seed, low, width, count, block: int) -> None:
    """Let the processes (one per element) put their points into ``slots`` (documents x
    HASHES, earliest times)."""
    flat, now, live, step = slots.reshape(-1), np.zeros(len(seed)), np.arange(len(seed)), 0
    rate = width.astype(np.float64)
    while len(live):
        steps = np.arange(step + 1, step + block + 1).astype(np.uint64) * GOLDEN
        r = mix(seed[live, None] + steps)
        wait = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[live, None]
        times = now[live, None] + np.cumsum(wait, axis=1)
        r = mix(r ^ GOLDEN)
        place = doc[live, None] * HASHES + (r & np.uint64(HASHES - 1)).astype(np.int64)
        level = low[live, None] + ((r >> np.uint64(32)) * width[live, None].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        counts = level < count[live, None]
        np.minimum.at(flat, place[counts], times[counts])
        now[live] = times[:, -1]
        live = live[now[live] <= slots.max(axis=1)[doc[live]]]
        step += block


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of HASHES bytes for each bag (distinct hashes, counts); all bags non-empty."""
    slots = np.full((len(bags), HASHES), np.inf)
    size = np.array([len(h) for h, _ in bags])
    doc = np.repeat(np.arange(len(bags)), size)
    seed, count = np.concatenate([h for h, _ in bags]), np.concatenate([c for _, c in bags])
    low, parts = 0, []
    keep = np.arange(len(seed))
    while len(keep):  # interval after interval, for the shingles that reach it
        width = max(1, low)
        parts.append((doc[keep], mix(seed[keep] + np.uint64(low)), np.full(len(keep), low), np.full(len(keep), width), count[keep]))
        low += width
        keep = keep[count[keep] > low]
    doc, seed, low, width, count = map(np.concatenate, zip(*parts, strict=True))
    few = size[doc] < FEW
    for chosen, block in ((~few, 1), (few, BLOCK)):
        _fill(slots, doc[chosen], seed[chosen], low[chosen], width[chosen], count[chosen], block)
    return (mix(slots.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def bag(w: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(w, size), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags; 1 for two empty ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    every = int(a[1].sum() + b[1].sum()) - common
    return common / every if every else 1.0


def _content(bagged: tuple[np.ndarray, np.ndarray]) -> bytes:
    """128 bits that name a multiset."""
    h, c = bagged
    each = mix(h + c.astype(np.uint64) * GOLDEN)
    return np.array([each.sum(dtype=np.uint64), mix(each).sum(dtype=np.uint64)], np.uint64).tobytes()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        texts, at = batch.column(2), 0
        while at < batch.num_rows:
            first, bags, seen = at, [], 0
            while at < batch.num_rows and seen < BATCH_WORDS and at - first < BATCH_DOCS:
                w = hashes.of(texts[at].as_py())
                bags.append(bag(w))
                seen, at = seen + len(w), at + 1
            full = [k for k, b in enumerate(bags) if len(b[0])]
            signs: list = [None] * len(bags)
            if full:
                for k, row in zip(full, signatures([bags[k] for k in full]), strict=True):
                    signs[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[first:at], batch.column(1)[first:at], pa.array([_content(b) for b in bags], pa.binary()),
                 pa.array(signs, pa.binary())], names=["doc_id", "text_hash", "content", "signature"])


def _agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough places."""
    for batch in batches:
        both = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES) for k in ("sa", "sb")]
        agree = (both[0] == both[1]).mean(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array((agree - 1 / 256) / (1 - 1 / 256) >= least))


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs with their exact similarity; the leaders' bags are kept for the next rows."""
    hashes, leaders = WordHashes(), {}
    for batch in batches:
        out = []
        ids, texts, others = batch.column("b").to_pylist(), batch.column("tb"), batch.column("ta")
        for k, b in enumerate(ids):
            if b not in leaders:
                if len(leaders) >= 50:
                    leaders.clear()
                leaders[b] = bag(hashes.of(texts[k].as_py()))
            out.append(similarity(bag(hashes.of(others[k].as_py())), leaders[b]))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Written: rid (row number), doc_id, text_hash, content, signature (null: no words)."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    rows = read.mapInArrow(_signed, "doc_id long, text_hash long, content binary, signature binary")
    return written(rows.withColumn("rid", F.monotonically_increasing_id()), "signed")


def buckets(nodes: DataFrame) -> DataFrame:
    """Written: (bucket, node) of all buckets with at least two nodes."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("signature", k * ROWS + 1, ROWS)) for k in range(BANDS)])
    rows = nodes.where("signature IS NOT NULL").select("node", F.explode(keys).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return written(rows.join(shared, "bucket"), "buckets")


class _Checker:
    """Verifies candidate pairs (a: member, b: leader) and remembers which were tried."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, threshold: float):
        self.nodes, self.texts, self.threshold, self.tried = nodes, texts, threshold, None
        self.least = threshold - SLACK * (threshold * (1 - threshold) / HASHES) ** 0.5

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) not tried before that meet the threshold."""
        pairs = pairs.select("a", "b").distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        least, threshold = self.least, self.threshold
        sign = self.nodes.select("node", "signature")
        signs = pairs.join(sign.toDF("a", "sa"), "a").join(sign.toDF("b", "sb"), "b")
        near = written(signs.mapInArrow(lambda x: _agreeing(x, least), "a long, b long"), "near")
        members = near.join(self.texts.toDF("a", "ta"), "a")
        both = members.join(self.texts.toDF("b", "tb"), "b")
        found = both.mapInArrow(lambda x: _verified(x, threshold), "a long, b long, similarity double")
        return written(found.where(F.col("similarity") >= threshold).select("a", "b"), "links")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, element) of each text's n elements: shingle and occurrence."""
    hashes = WordHashes()
    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            h, c = bag(hashes.of(text.as_py()))
            each = np.repeat(h, c)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(c) - c, c)
            element = mix(each + nth.astype(np.uint64) * GOLDEN).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(element), node)), pa.array(np.full(len(element), len(element))),
                                              pa.array(element)], names=["node", "n", "element"])


def rare_elements(texts: DataFrame, threshold: float) -> DataFrame:
    """(bucket, node, n, at, alone, before) of each node's prefix, rarest elements first, without
    elements that no other node has (``alone`` many); ``at`` is the element's place from 0, ``before`` holds the node's last
    buckets before it: two nodes that also meet in one of them are compared there."""
    every = written(texts.mapInArrow(_elements, "node long, n long, element long"), "elements")
    shared = every.groupBy("element").agg(F.count("*").alias("nodes")).where("nodes > 1")
    own = Window.partitionBy("node")
    rows = every.join(shared, "element")
    rows = rows.withColumn("alone", F.col("n") - F.count("*").over(own))
    rows = rows.withColumn("at", F.col("alone") + F.row_number().over(own.orderBy("nodes", "element")) - 1)
    rows = written(rows.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9))
                   .select(F.col("element").alias("bucket"), "node", "n", "at", "alone"), "prefixes")
    # a node stays in a bucket only if the bucket's shortest member could be similar to it
    met = rows.groupBy("bucket").agg(F.count("*").alias("nodes"), F.min("n").alias("shortest")).where("nodes > 1")
    partner = F.greatest(F.col("shortest"), F.ceil(F.col("n") * threshold - 1e-9))
    may = F.col("n") - F.col("at") >= F.ceil((F.col("n") + partner) * threshold / (1 + threshold) - 1e-9)
    rows = rows.join(met, "bucket").where(may).drop("nodes", "shortest")
    earlier = Window.partitionBy("node").orderBy("at").rowsBetween(-EARLIER, -1)
    return rows.withColumn("before", F.collect_list("bucket").over(earlier))


def _open(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Written: the rows of buckets with two components or more, with ``root``."""
    if roots is None:
        rows = rows.withColumn("root", F.col("node"))
    else:
        rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    many = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    return written(rows.join(many, "bucket"), "open")


def linked(rows: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame | None:
    """(node, root) of all nodes in links; None if there are none."""
    check = _Checker(nodes, texts, threshold)
    first = rows.groupBy("bucket").agg(F.min("node").alias("b"))
    links = check.links(rows.join(first, "bucket").where("node <> b").groupBy(F.col("node").alias("a")).agg(F.min("b").alias("b")))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    unsure = _open(rows, roots).select("node").distinct()
    rows, slots = rare_elements(texts.join(unsure, "node", "left_semi"), threshold), 1
    while True:
        rows = _open(rows, roots)
        if rows.isEmpty():
            return roots
        # leaders: in each of the bucket's slots the node with the smallest share of elements
        # of its own, as an original that many others were made from, then the least by a hash
        slot = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(slots))
        best = rows.groupBy("bucket", slot.alias("slot")).agg(F.min(
            F.struct((F.col("alone") / F.col("n")).alias("share"), F.xxhash64("node").alias("h"), "node", "root", "n", "at", "before")).alias("m"))
        leaders = written(best.select("bucket", F.col("m.node").alias("b"), F.col("m.root").alias("rb"),
                                      F.col("m.n").alias("nb"), F.col("m.at").alias("atb"), F.col("m.before").alias("beforeb")), "leaders")
        may = (F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("atb"))
               >= F.ceil((F.col("n") + F.col("nb")) * threshold / (1 + threshold) - 1e-9)) \
            & (F.least("n", "nb") >= threshold * F.greatest("n", "nb") - 1e-9) & ~F.arrays_overlap("before", "beforeb")
        pairs = rows.join(leaders, "bucket").where((F.col("root") != F.col("rb")) & may)
        more = check.links(pairs.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")))
        if not more.isEmpty():
            links = written(links.union(more), "links")
            roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        rows = rows.drop("root").join(leaders.select("bucket", F.col("b").alias("node")), ["bucket", "node"], "left_anti")
        slots *= 64


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: rid, doc_id, text_hash, class_id, class_size and first (the
    class's row that stays: least doc_id, then least rid)."""
    rows = signed(docs, doc_id, text)
    same = rows.groupBy("content").agg(F.min("rid").alias("node"))
    nodes = rows.join(same.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    shared = buckets(nodes)
    active = written(nodes.join(shared.select("node").distinct(), "node", "left_semi"), "active")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(body).alias("th"), body.alias("text"))
    wanted = active.select("node", "doc_id", "text_hash")
    # the texts are shuffled at every size alike, so that the small runs tell of the large ones
    texts = read.hint("merge").join(wanted, read["id"].eqNullSafe(wanted["doc_id"]) & (read["th"] == wanted["text_hash"])) \
        .select("node", "text").dropDuplicates(["node"])
    roots = linked(shared, active, written(texts, "texts"), threshold)
    members = rows.select("rid", "doc_id", "text_hash", "content").join(same, "content")
    members = members.withColumn("root", F.col("node")) if roots is None else \
        members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = written(members.select("rid", "doc_id", "text_hash", "root"), "members")
    by_class = members.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
                                           F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "rid")).alias("f"))
    return members.join(by_class, "root").select("rid", "doc_id", "text_hash", "class_id", "class_size",
                                                 (F.col("rid") == F.col("f.rid")).alias("first"))


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay, with their columns: one of each class."""
    keep = classes(docs, doc_id, text, threshold).where("first").select(F.col("doc_id").alias("kid"), F.col("text_hash").alias("kh"))
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"),
                         F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("th"))
    stays = packed.join(keep, packed["id"].eqNullSafe(keep["kid"]) & (packed["th"] == keep["kh"]), "left_semi")
    once = F.row_number().over(Window.partitionBy("id", "th").orderBy("id"))
    return stays.withColumn("copy", once).where("copy = 1").select("row.*")


def op6_bagminhash(spark, sf_dir):
    out = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id", "class_size", F.col("first").alias("kept"))
