import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldrank.llm import sos_packing as S

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "a", "Don't STOP 'sabc I'LL", "naïve Über ß ÿ Ñandú, µm ª", "é é İ K ſ", "日本語。 “x”. x”.", "a\x85b c\x1cd e", "x.1 3.14% ||| a.b. c.\n.",
         "<|endoftext|> x<|ENDOFTEXT|> <|x", "Word, word. WORD.. word,\tword.", "word " * 9000, "naïve. café, ÉTÉ."]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(["don't", "A.", "b,", "é.", "ß", "<|startoftext|>", "'s", "…", "12.5", "Ünï,"])), max_size=6).map(" ".join))
def test_chunks_give_the_tokenizers_ids(tokenizer, known, text):
    text = text.encode("utf-8", "ignore").decode()
    ids, ends = known.encode([text])
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0] and ends.tolist() == [len(ids)]


@pytest.fixture(scope="module")
def known():
    return S.ChunkIds(VOCABULARY)


def test_pieces_and_places(spark, docs_of, tokenizer):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "b c")]
    cut = S.pieces(docs_of(rows, "piece"), VOCABULARY, with_ids=True)
    got = S.pack(cut.drop("ids"), group_pieces=5).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want[i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    gapless(got)


def gapless(rows, length=2048):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(bins)


def test_fills_sequences(spark):
    rng = np.random.default_rng(2)
    sizes = np.minimum(rng.lognormal(5, 1.2, 6000).astype(int) + 1, 2048)
    df = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)], S.PIECE)
    least = -(-int(sizes.sum()) // 2048)
    assert gapless(S.pack(df).collect()) <= least * 1.01 + 1
    assert gapless(S.pack(df, group_pieces=500).collect()) <= least * 1.01 + 2


def test_rule_is_sum_of_squares():
    """Each place makes the squared counts smallest."""
    rng = np.random.default_rng(3)
    sizes, length = rng.integers(1, 30, 300), 40
    bins, offsets = S.sum_of_squares(sizes, length)
    gaps: dict[int, int] = {}
    for s, b, o in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        def squares(state):
            n = collections.Counter(g for g in state.values() if g)
            return sum(v * v for v in n.values())
        options = [squares(gaps | {k: g - s}) for k, g in gaps.items() if g >= s] + [squares(gaps | {-1: length - s})]
        gaps[b] = gaps.get(b, length) - s
        assert o == length - gaps[b] - s and gaps[b] >= 0 and squares(gaps) == min(options)


def test_sequences_hold_the_ids(spark, docs_of, tokenizer):
    rows = [(i, t) for i, t in enumerate(TEXTS) if i < 12]
    cut = S.pieces(docs_of(rows), VOCABULARY, with_ids=True)
    placed = S.pack(cut.drop("ids"))
    got = {r["sequence_id"]: r["ids"] for r in S.sequences(cut, placed).collect()}
    for r in placed.collect():
        ids = np.array(got[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]


def test_groups_hold_with_null_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES", 16, raising=False)
    rows = [(None, 0, 0, 2048, k) for k in range(900)] + [(7, 0, 0, 2048, 5)] * 900 + [(100 + k, 0, 0, 2048, k) for k in range(1200)]
    got = S.pack(spark.createDataFrame(rows, S.PIECE), group_pieces=300).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == collections.Counter(rows)
    gapless(got)
    sizes = collections.Counter(r["sequence_id"] >> 32 for r in got)  # full sequences stay in their group
    assert len(sizes) == 10 and max(sizes.values()) < 600


def test_empty(spark, docs_of):
    assert S.pack(S.pieces(docs_of([]), VOCABULARY)).count() == 0
