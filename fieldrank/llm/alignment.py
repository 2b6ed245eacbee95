"""Alignment of two tokenizers' ids on the same bytes, and how often id pairs are linked.

A document is tokenised by both vocabularies (A byte-level BPE, B pieces). Each tokenization
gives cumulative ends in bytes; a dictionary per side maps an end to the index of the token
that ends there. The ends that are keys of both dictionaries (a hash-set intersection,
sorted) slice both id lists into groups, and the links of a group are its A-B pairs whose
byte ranges overlap.

**What a task does.** Neither vocabulary joins across a blank or line feed that follows
another character, nor a Latin letter with a mark of ``MARKS`` after it (B's pieces are
searched for one when it is loaded; texts with other white space aren't cut), so the ids of a
text are those of its chunks between such places, and both sides end where a chunk ends.
Chunks repeat, so each different one is tokenised and aligned once per task, in a cache of
at most ``CACHE_CHUNKS``. A chunk whose pieces don't give its bytes sends the whole text
through the same steps uncut.

**What Spark does.** Per document the different linked pairs and their numbers are written
once; a pair's documents are counted by a partial aggregation, the highest count of an A id
by another; the counts come back to the documents' pairs by a join. Its small side is the
table of pairs: it is broadcast if it has at most ``BROADCAST_PAIRS`` rows, else both sides are
shuffled by the pair, where adaptive execution splits a pair that most documents hold. The
sums of a document are combined before they are shuffled.

Defined results: null and empty texts, and those whose joined bytes differ from the text on
either side, have no tokens: zeros and the empty string; texts of any length are aligned
whole; ties for an A id's highest count are all best; repeated rows and rows without an id
count as documents of their own; an empty table gives an empty result; only id and text
are read, whatever else the table has.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

CACHE_CHUNKS, CACHE_LINKS, BATCH_CHARS = 300_000, 10_000_000, 2_000_000
#: Rows of the pair table (about 30 bytes each) up to which it is broadcast.
BROADCAST_PAIRS = 500_000
#: A pair of ids is kept as one int: A's id above the bits of B's.
B_BITS = 15
#: What may stand after a Latin letter where a text is cut, besides white space.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?|#$%&*"
SPACE, GAP = re.compile(r"[^\S \n]"), re.compile(rf"\s*[{LETTERS}]+(?=[{MARKS}\s]|$)|\s*\S+|\s+")
BLANK = "▁"
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE writes for the 256 bytes: those that print stand for
    themselves, the others are the letters from 256 on, in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


def groups_of(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """Slices (first and last+1 index of A, of B) between the ends that both sides have."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1), strict=True))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1), strict=True))
    out, a0, b0 = [], 0, 0
    for end in sorted(a_at.keys() & b_at.keys()):
        a1, b1 = a_at[end], b_at[end]
        out.append((a0, a1, b0, b1))
        a0, b0 = a1, b1
    return out


def links_of(a_ends: list[int], b_ends: list[int], group: tuple[int, int, int, int]) -> Iterator[tuple[int, int]]:
    """The pairs (index in A, index in B) of a group whose byte ranges overlap: after each
    pair the side whose token ends first goes on (both never do inside a group)."""
    a, a1, b, b1 = group
    while a < a1 and b < b1:
        yield a, b
        if a_ends[a] < b_ends[b]:
            a += 1
        elif a_ends[a] > b_ends[b]:
            b += 1
        else:
            a, b = a + 1, b + 1


class Pair:
    """Both vocabularies, and what is known of the chunks seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes = {i: bytes(map(letters.__getitem__, s)) if all(c in letters for c in s) else s.encode()
                        for s, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x([0-9A-F]{2})>", p)) else p.replace(BLANK, " ").encode()
                        for p in pieces]
        self.blank, self.letter = self.b.piece_to_id(BLANK), self.b.piece_to_id(BLANK + "a")
        self.a_text, self.b_text = {i: str(i) for i in self.a_bytes}, list(map(str, range(len(pieces))))
        if len(pieces) > 1 << B_BITS or len(self.a_bytes) > 1 << (31 - B_BITS):
            raise ValueError("the two vocabularies are too large for a pair in 31 bits")
        joins = re.compile(rf"[^{BLANK}]{BLANK}|\n.|.\n|[{LETTERS}][{MARKS}]", re.DOTALL)
        self.cuts = not any(joins.search(p) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        self.reset()

    def reset(self) -> None:
        #: chunk -> its place; per place: A, B and group counts (no groups: the bytes differ), the groups' text, its links
        self.known: dict[str, int] = {}
        self.counts, self.texts, self.links, self.start = array("q"), [], array("i"), array("q", [0])

    def full(self) -> bool:
        return len(self.known) > CACHE_CHUNKS or len(self.links) > CACHE_LINKS

    def b_ids(self, chunks: list[str]) -> list[list[int]]:
        """B's ids of chunks. B adds a blank itself; a chunk that has none is put after a
        letter, which it doesn't join with."""
        found = self.b.encode([c[1:] if c[0] == " " else "a" + c for c in chunks], num_threads=1)
        return [[self.blank] if c == " " else ids if c[0] == " " else ids[1:] if ids[0] == self.letter else []
                for c, ids in zip(chunks, found, strict=True)]

    def add(self, chunks: list[str]) -> None:
        """Tokenises and aligns chunks that aren't known yet."""
        for chunk, a, b in zip(chunks, self.a.encode_batch(chunks, add_special_tokens=False), self.b_ids(chunks), strict=True):
            self.known[chunk] = len(self.texts)
            n_a, n_b, groups, text, links = self.aligned(chunk, a.ids, b)
            self.counts.extend((n_a, n_b, groups))
            self.texts.append(text)
            self.links.extend(links)
            self.start.append(len(self.links))

    def aligned(self, text: str, a: list[int], b: list[int]) -> tuple[int, int, int, str, list[int]]:
        """Numbers of A and B tokens and groups, the groups as text, the links as pairs of ids."""
        a_bytes, b_bytes, body = list(map(self.a_bytes.__getitem__, a)), list(map(self.b_bytes.__getitem__, b)), text.encode()
        if b"".join(a_bytes) != body or b"".join(b_bytes) != body:
            return 0, 0, 0, "", []
        if len(a) == len(b) == 1:
            return 1, 1, 1, f"{a[0]}|{b[0]}", [a[0] << B_BITS | b[0]]
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        a_text, b_text = list(map(self.a_text.__getitem__, a)), list(map(self.b_text.__getitem__, b))
        said, links = [], []
        for a0, a1, b0, b1 in groups_of(a_ends, b_ends):
            said.append(f"{','.join(a_text[a0:a1])}|{','.join(b_text[b0:b1])}")
            if a1 - a0 == 1 or b1 - b0 == 1:
                links += [x << B_BITS | y for x in a[a0:a1] for y in b[b0:b1]]
            else:
                links += [a[i] << B_BITS | b[k] for i, k in links_of(a_ends, b_ends, (a0, a1, b0, b1))]
        return len(a), len(b), len(said), ";".join(said), links

    def whole(self, text: str) -> tuple[int, int, int, str, list[int]]:
        return self.aligned(" " + text, self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """As ``aligned`` for each text, the links as an array in order of their places."""
        cut = [GAP.findall(" " + t) if t and self.cuts and not SPACE.search(t) else [] for t in texts]
        self.add(list({c for chunks in cut for c in chunks} - self.known.keys()))
        counts = np.array(self.counts, np.int64).reshape(-1, 3)
        flat, start = np.array(self.links, np.int32), np.array(self.start, np.int64)
        said = self.texts
        for text, chunks in zip(texts, cut, strict=True):
            places = list(map(self.known.__getitem__, chunks))
            at = np.array(places, np.int64)
            if not text:
                yield 0, 0, 0, "", flat[:0]
            elif not places or not counts[at, 2].all():
                n_a, n_b, groups, own, links = self.whole(text)
                yield n_a, n_b, groups, own, np.array(links, np.int32)
            else:
                size = start[at + 1] - start[at]
                upto = np.cumsum(size)
                links = flat[np.repeat(start[at] - upto + size, size) + np.arange(upto[-1])]
                yield *counts[at].sum(0).tolist(), ";".join(map(said.__getitem__, places)), links
        if self.full():
            self.reset()


def slices(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BATCH_CHARS together."""
    first = chars = 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= BATCH_CHARS:
            yield first, k + 1
            first, chars = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row per document: ``row`` (a number of its own), doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256, its different linked pairs (``pairs``, see ``ids_of``) and how many
    links each has (``times``); with ``groups`` also the groups' text."""
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())] + [pa.string()] * groups
    names = [c.split()[0] for c in ALIGNED.split(", ")] + ["pairs", "times"] + ["groups"] * groups

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(a_path, b_path)
        for batch in batches:
            rows, ids, texts = (batch.column(k).to_pylist() for k in range(3))
            for a, b in slices(texts):
                out = []
                for row, own, (n_a, n_b, n_groups, said, links) in zip(rows[a:b], ids[a:b], pair.documents(texts[a:b]), strict=True):
                    pairs, times = np.unique(links, return_counts=True)
                    digest = hashlib.sha256(said.encode()).hexdigest() if n_a else ""
                    out.append((row, own, n_a, n_b, n_groups, len(links), digest, pairs, times.astype(np.int32), *([said] if groups else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return read.mapInArrow(task, ALIGNED + ", pairs array<int>, times array<int>" + ", groups string" * groups)


def ids_of(pair) -> tuple:
    """Columns (A's id, B's id) of a pair."""
    return F.shiftright(pair, B_BITS), pair.bitwiseAND((1 << B_BITS) - 1)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents a pair is linked, and whether no pair of its
    A id is linked in more. A task holds the pairs of one A id: at most the B vocabulary."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    highest = F.max("docs").over(Window.partitionBy(ids_of(F.col("pair"))[0]))
    return counts.withColumn("best", F.col("docs") == highest)


def scored(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (written: its rows must stay the same) with n_best and count_sum in place
    of the pairs."""
    counts = written(pair_counts(aligned), "pairs")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    keys = [c.split()[0] for c in ALIGNED.split(", ")]
    held = aligned.where("n_links > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    sums = held.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.select(*keys).join(sums, "row", "left").select(
        *keys[1:6], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op13_alignment(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(written(align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), "aligned"))
