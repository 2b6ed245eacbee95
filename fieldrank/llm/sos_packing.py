"""Packing tokenised documents into sequences by the sum-of-squares rule.

A document becomes its token ids and the separator id 0, cut into pieces of ``LENGTH``
tokens only where it is longer. Each piece goes where the squared counts of open bins per
residual gap then sum to the least: with N(g) open bins of gap g, putting a piece of size s
into a bin of gap g changes the sum by 2 (N(g-s) - N(g)) + 2, a new bin by 2 N(L-s) + 1.
The rule keeps the gaps varied, so that later pieces find one they fill.

Spark deals the pieces to groups of about ``GROUP_PIECES`` by a hash of the whole row (the
number of groups grows with the data; equal rows go in lots of ``COPIES``) and each group is packed in one task, longest
pieces first. Bins that stay open are packed again as items of their filled size, over
``MERGE`` groups together, so a group's last bins don't cost space. Only lengths are
shuffled, never tokens.

Tokenising reuses the ids of equal chunks between white space: the vocabulary's rules lower
the case and never join text across white space, so the ids of a text are those of its
chunks in order (verified against the whole tokenizer in the tests). The cache of chunks is
bounded by ``CACHE_CHUNKS``.

Defined results: a null or empty text is the single id 0; a text of any length is tokenised
whole; repeated rows are packed each for itself; an empty table gives an empty result; only
id and text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

LENGTH = 2048
GROUP_PIECES, MERGE, COPIES = 20_000, 64, 256
CACHE_CHUNKS, BATCH_CHARS = 300_000, 2_000_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: A plain chunk: Latin-1 letters, then perhaps marks. The vocabulary's rules split it there.
PLAIN = re.compile(r"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?%&$*#|]*)")


def byte_letters() -> dict[str, str]:
    """Latin-1 letter -> its UTF-8 bytes as the printable letters that byte-level BPE uses:
    bytes that print stand for themselves, the others for 256 onwards in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    letter = {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {chr(c): "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


#: A full stop or comma that ends a chunk, after a letter: always split off by the rules.
ENDING = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")


def chunks(text: str | None) -> list[bytes]:
    """Parts of a text whose ids in order are the text's ids; fewer different ones than
    between white space alone. (Texts that may name special tokens keep their case.)"""
    body = (text or "").encode()
    return body.split() if b"<|" in body else ENDING.sub(rb" \1", body.lower()).split()


class ChunkIds(dict):
    """Chunk -> its place in the arrays of ids; place 0 is the separator.

    A plain chunk goes straight to the vocabulary's merges, its letters lower-cased, any
    other through the whole tokenizer; the ids are the same."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.merges = self.tokenizer.model.tokenize
        self.letters = str.maketrans(byte_letters())
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat, self.size = array("I", [0]), array("q", [1])

    def __missing__(self, chunk: bytes) -> int:
        text = chunk.decode()
        if plain := PLAIN.fullmatch(text):
            word = plain[1].lower()
            ids = [x.id for x in self.merges(word if word.isascii() else word.translate(self.letters))]
            if plain[2]:
                ids += [x.id for x in self.merges(plain[2])]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.flat.extend(ids)
        self.size.append(len(ids))
        place = self[chunk] = len(self) + 1
        return place

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its separator, and the end of each text in them."""
        places, ends = [], []
        for text in texts:
            places.extend(map(self.__getitem__, chunks(text)))
            places.append(0)
            ends.append(len(places))
        flat, sizes = np.array(self.flat, np.uint32), np.array(self.size, np.int64)
        start = np.cumsum(sizes) - sizes
        at = np.array(places, np.int64)
        size = sizes[at]
        upto = np.cumsum(size)
        ids = flat[np.repeat(start[at] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]
        if len(self) > CACHE_CHUNKS:
            self.reset()
        return ids, upto[np.array(ends, np.int64) - 1] if ends else np.zeros(0, np.int64)


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BATCH_CHARS together."""
    first = chars = 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= BATCH_CHARS:
            yield first, k + 1
            first, chars = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkIds(vocabulary)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _slices(texts):
                ids, ends = known.encode(texts[a:b])
                rows, begin = [], 0
                for name, end in zip(names[a:b], ends.tolist(), strict=True):
                    for k, at in enumerate(range(begin, end, length)):
                        own = ids[at:min(at + length, end)]
                        rows.append((name, k, at - begin, len(own), zlib.crc32(own.astype("<u4").tobytes()), *([own.tolist()] if with_ids else [])))
                    begin = end
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=fields)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return read.mapInArrow(cut, PIECE + ", ids array<long>" * with_ids)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size, placed in the order given."""
    count = np.zeros(length + 1, np.int64)  # open bins per gap; full ones (gap 0) don't count
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets, n = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for k, s in enumerate(sizes.tolist()):
        gap = 0
        if s < length:
            change = 2 * (count[: length - s] - count[s:length]) + 2
            change[0] = 1 - 2 * count[s]
            change[count[s:length] == 0] = 1 << 40
            best = int(change.argmin())  # the first of equals has the least gap
            if change[best] <= 2 * count[length - s] + 1:
                gap = best + s
        if gap:
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b, n = length, n, n + 1
        bins[k], offsets[k] = b, length - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return bins, offsets


def _packed(key: tuple, rows: pd.DataFrame, order: list[str], size: str, length: int) -> pd.DataFrame:
    rows = rows.sort_values([size, *order], ascending=[False] + [True] * len(order), kind="stable", na_position="first").reset_index(drop=True)
    bins, offsets = sum_of_squares(rows[size].to_numpy(), length)
    return rows.assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)


def pack(cut: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    cut = written(cut, "pieces")
    groups = max(1, math.ceil(cut.count() / group_pieces))
    # equal pieces are counted and dealt in lots of COPIES: neither ids that are null or repeated
    # nor pieces that repeat as a whole meet in one group
    columns = cut.columns
    counted = cut.groupBy(*columns).agg(F.count("*").alias("n"))
    lots = counted.select(*columns, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES).cast("long"))).alias("lot"))
    dealt = lots.select(*columns, F.least(F.lit(COPIES), F.col("n") - F.col("lot") * COPIES).cast("int").alias("copies"),
                        F.pmod(F.xxhash64(*columns, "lot"), F.lit(groups)).cast("int").alias("group"))
    order = ["doc_id", "piece", "ids_crc32"]
    schema = f"{PIECE}, group int, sequence_id long, offset long"

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.loc[rows.index.repeat(rows.pop("copies"))]
        return _packed(key, rows, order, "length", length)

    def again(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _packed(key, rows, ["open"], "filled", length)

    placed = written(dealt.groupBy("group").applyInPandas(first, schema), "packed")
    partial = placed.groupBy("sequence_id").agg(F.sum("length").alias("filled")).where(F.col("filled") < length)
    merged = F.floor(F.shiftright("sequence_id", 32) / MERGE).cast("int") + groups  # numbers beyond the first groups'
    moved = partial.select(F.col("sequence_id").alias("open"), "filled", merged.alias("part")).groupBy("part") \
        .applyInPandas(again, "open long, filled long, part int, sequence_id long, offset long") \
        .select("open", F.col("sequence_id").alias("into"), F.col("offset").alias("base"))
    out = placed.join(written(moved, "merged"), placed["sequence_id"] == F.col("open"), "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "sequence_id").alias("sequence_id"),
                      (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """The sequences themselves (sequence_id, ids): pieces with ids, put where ``placed``
    says. Needs (doc_id, piece) to be unique; a sequence has at most ``length`` ids."""
    parts = placed.join(cut.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    return parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))


def op7_sos_packing(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
