"""Cross-tokenizer alignment against a plain version that tokenises whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldrank.llm import alignment as al

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "\n", "a", " a ", "a  b", "one two three", "one\ntwo\n\n three  \n", "tab\tand\r\nreturn", "naïve café — “quoted”",
    "日本語のテキスト と 中文", "emoji 👩‍👩‍👧 here", "mark ▁ inside", "▁", "<s> x </s> <unk> <|endoftext|>", "nul \x00 byte <0x41>",
    "123456789 and 3.14159", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x = foo(bar);\r\n}", " nbsp 　wide", "supercalifragilistic " * 40, "one two three",
    "é combining", " line sep", "()();\n\n\n    indented", " \n mixed", "word\n",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = al.byte_letters()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def spans(tokens):
        at, out = 0, []
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    def one(text):
        """(A ids, B ids, groups text, links) by comparing every A with every B token."""
        if not text:
            return [], [], "", []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return [], [], "", []
        sa, sb = spans(bytes_a), spans(bytes_b)
        links = [(i, k) for i, x in zip(ids_a, sa, strict=True) for k, y in zip(ids_b, sb, strict=True) if x[0] < y[1] and y[0] < x[1]]
        ends = [0, *sorted({e for _, e in sa} & {e for _, e in sb})]
        groups = ";".join("|".join(",".join(str(i) for i, (s, e) in zip(ids, sp, strict=True) if lo <= s and e <= hi) for ids, sp in ((ids_a, sa), (ids_b, sb)))
                          for lo, hi in zip(ends, ends[1:]))
        return ids_a, ids_b, groups, links
    return one


def expected(rows, plain):
    done = [(doc, *plain(text)) for doc, text in rows]
    docs = Counter(p for *_, links in done for p in set(links))
    top = {}
    for (x, _), n in docs.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc, a, b, groups, links in done:
        out.append((doc, len(a), len(b), groups.count(";") + 1 if a else 0, len(links), sum(docs[p] == top[p[0]] for p in links),
                    sum(docs[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def result(df):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def run(docs, **kw):
    return al.scored(al.written(al.align(docs, A_PATH, B_PATH), "aligned"), **kw)


def test_odd_texts_equal_plain_version(spark, docs_of, plain):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "one two"), (3, "repeated id"), (3, "repeated id")]
    docs = docs_of(rows, clash="pairs").withColumn("times", al.F.lit(7))
    want = expected(rows, plain)
    assert result(run(docs)) == want
    assert result(run(docs, broadcast_pairs=0)) == want  # both sides shuffled


def test_random_texts_cut_like_whole_ones(plain):
    random.seed(5)
    pair = al.Pair(A_PATH, B_PATH)
    assert pair.cuts
    letters = "ab Zé\n  .;('\"1日▁ \t\r<0x>"
    texts = ["".join(random.choices(letters, k=random.randrange(1, 40))) for _ in range(800)]
    for text, (n_a, n_b, groups, said, links) in zip(texts, pair.documents(texts), strict=True):
        a, b, want, pairs = plain(text)
        assert (n_a, n_b, said, sorted(links.tolist())) == (len(a), len(b), want, sorted(x << al.B_BITS | y for x, y in pairs)), repr(text)


def test_registered_query_on_the_small_table(spark, sf, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 1500").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(run(docs)) == expected(rows, plain)


def test_long_text_and_empty_table(spark, docs_of):
    text = "the quick brown fox, jumps over\n" * 30_000 + "x" * 50_000
    (row,) = result(run(docs_of([(1, text)])))
    assert row[4] == row[1] + row[2] - row[3]  # a group of a and b tokens has a + b - 1 links
    assert result(run(docs_of([(1, "x")]).where("doc_id > 1"))) == []


def test_groups_are_returned(spark, docs_of):
    (row,) = al.align(docs_of([(1, "hello there")]), A_PATH, B_PATH, groups=True).collect()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and sum(row.times) == row.n_links
