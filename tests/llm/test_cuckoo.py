import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from fieldrank.llm import cuckoo as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def norm(t):
    return (t or "").translate(str.maketrans(UPPER, LOWER))


def test_filter_has_no_false_negatives_and_deletes():
    rng = random.Random(1)
    f, keys = C.CuckooFilter(256), [rng.getrandbits(64) for _ in range(900)]
    assert all(f.insert(k) for k in keys)
    assert all(f.contains(k) for k in keys)
    for k in keys[:450]:
        assert f.delete(k)
    assert all(f.contains(k) for k in keys[450:])
    assert sum(f.contains(k) for k in keys[:450]) < 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=200))
def test_shard_equals_a_dict_with_resizing(steps):
    shard, want = C.Shard(n_buckets=2), {}
    for n, (gone, k) in enumerate(steps):
        d = hashlib.sha256(str(k).encode()).digest()
        if gone:
            assert shard.remove(d) == (d in want)
            want.pop(d, None)
        else:
            shard.add(d, n, 1)
            want[d] = (n, want.get(d, (0, 0))[1] + 1)
    assert {d: (i, n) for d, i, n in shard.records()} == want
    assert all(shard.find(d) for d in want)


def test_fingerprint_collisions_do_not_merge():
    shard = C.Shard()
    a = bytes(32)
    b = bytes(31) + b"\x01"  # the same filter key, another digest
    shard.add(a, 1, 1)
    shard.add(b, 2, 1)
    assert sorted(r[1:] for r in shard.records()) == [[1, 1], [2, 1]]
    shard.remove(a)
    assert shard.find(b) and shard.find(a) is None


ROWS = [(1, "A b"), (5, "a B"), (3, "a b"), (2, None), (9, ""), (4, "É"), (6, "é"), (7, "x" * 200_000), (8, "X" * 200_000), (5, "a B"),
        (None, "a b"), (None, "only"), (None, "ONLY")]


def test_groups(spark, docs_of):
    got = {(r["doc_id"], r["text_sha256"]): r for r in C.dedup(docs_of(ROWS, "digest")).collect()}
    for d, t in ROWS:
        same = [i for i, u in ROWS if norm(u) == norm(t)]
        keep = max((i for i in same if i is not None), default=None)
        r = got[d, hashlib.sha256(norm(t).encode()).hexdigest()]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(same), d == keep)


def test_distinct_keeps_one_of_each_text(spark, docs_of):
    df = docs_of(ROWS, "sha")
    out = C.distinct(df).collect()
    assert len(out) == len({norm(t) for _, t in ROWS}) and out[0].__fields__ == df.columns
    assert {r["doc_id"] for r in out} == {5, 9, 4, 6, 8, None}


def test_index_insert_delete_lookup(spark, docs_of):
    rows = C.digests(docs_of(ROWS))
    index = C.CuckooIndex.build(rows)
    index = index.insert(C.digests(docs_of([(20, "a b"), (21, "new")]))).delete(C.digests(docs_of([(4, "É"), (0, "é"), (0, "absent")])))
    sha = lambda t: hashlib.sha256(norm(t).encode()).digest()
    got = {bytes(r["digest"]): (r["keep_id"], r["n"]) for r in index.lookup(C.digests(docs_of([(0, t) for t in ("a b", "new", "É", "é", "no")]))).collect()}
    assert got == {sha("a b"): (20, 6), sha("new"): (21, 1), sha("É"): (None, 0), sha("é"): (6, 1), sha("no"): (None, 0)}
    again = index.insert(C.digests(docs_of([(30, "É")])))
    assert again.lookup(C.digests(docs_of([(0, "É")]))).first()["keep_id"] == 30


def test_deletion_is_by_copy_and_shards_grow(spark, docs_of, monkeypatch):
    """Against a plain multiset: copies, repeated rows, null ids; more keys than the first shards hold."""
    monkeypatch.setattr(C, "SHARD_KEYS", 50)
    rng = random.Random(4)
    draw = lambda n: [(rng.choice([None, *range(6)]), f"t{rng.randrange(30)}") for _ in range(n)]
    first, more = draw(80), draw(60) + [(100 + i, f"new{i}") for i in range(300)]
    gone = [*first[:40], *more[:20], (1, "absent"), (99, "t1"), *[(5, "t2")] * 30, (100, "new0")]
    index = C.CuckooIndex.build(C.digests(docs_of(first)))
    before = index.n_shards
    index = index.insert(C.digests(docs_of(more))).delete(C.digests(docs_of(gone)))
    live = Counter(first + more)
    live.subtract(Counter(gone))
    live = +live
    want = {}
    for (i, t), n in live.items():
        ids, m = want.get(t, ([], 0))
        want[t] = (ids + [i], m + n)
    want = {hashlib.sha256(t.encode()).digest(): (max((i for i in ids if i is not None), default=None), n) for t, (ids, n) in want.items()}
    entries = index.entries.collect()
    assert {bytes(r["digest"]): (r["keep_id"], r["n"]) for r in entries} == want and len(entries) == len(want)
    assert index.n_shards > before and len({r["shard"] for r in entries}) > before
    emptied = index.delete(C.digests(docs_of([row for row, n in live.items() for _ in range(n)])))
    assert emptied.entries.isEmpty() and emptied.live.isEmpty()


def test_empty(spark, docs_of):
    assert C.dedup(docs_of([])).count() == 0 and C.distinct(docs_of([])).count() == 0
