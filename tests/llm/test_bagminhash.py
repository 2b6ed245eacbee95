import collections
import itertools
import random

import numpy as np

from fieldrank.llm import bagminhash as B


def brute_bag(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else collections.Counter()


def jaccard(a, b):
    top = sum((a & b).values())
    low = sum((a | b).values())
    return top / low if low else 1.0


def brute_classes(rows):
    """Least doc_id of each row's class, by union over all pairs."""
    bags = [brute_bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if jaccard(bags[i], bags[j]) >= 0.8:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(rows))]


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmnop")
    rows, i = [], 0
    for size in (40, 12, 5, 3):  # groups of edited copies of one text
        base = [word() for _ in range(rng.randrange(80, 300))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 12)):
                w[rng.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i + k, " ".join(word() for _ in range(rng.randrange(1, 120)))) for k in range(60)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, "a a a a a a a a"), (506, "a a a a a a a a a"),
             (507, "w " * 30_000), (508, "w " * 29_000), (None, "one two"), (None, "lonely words"), (503, "one two")]
    rng.shuffle(rows)
    return rows


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    a = {k: int(rng.integers(1, 9)) for k in range(200)}
    b = {k: a[k] if k < 160 and k in a else int(rng.integers(1, 9)) for k in range(40, 240)}
    want = jaccard(collections.Counter(a), collections.Counter(b))

    def drawn(bag, seed):
        h = B.mix(np.array(list(bag), np.uint64) * np.uint64(7919) + np.uint64(seed))
        return h, np.array(list(bag.values()))
    found = []
    for seed in range(0, 3000, 20):
        x = B.signatures([drawn(a, seed), drawn(b, seed)])
        found.append(((x[0] == x[1]).mean() - 1 / 256) / (1 - 1 / 256))
    assert abs(np.mean(found) - want) < 4 * np.std(found) / len(found) ** 0.5
    assert abs(np.std(found) - (want * (1 - want) / B.HASHES) ** 0.5) < 0.01


def test_small_and_large_bags_share_processes():
    """Documents drawn point by point and block by block agree as their similarity says."""
    words = np.arange(1, 80, dtype=np.uint64)
    h = B.mix(words)
    few, many = (h[:60], np.ones(60, int)), (h, np.ones(79, int))
    x = B.signatures([few, many])
    assert abs((x[0] == x[1]).mean() - 60 / 79) < 0.12


def test_classes_equal_brute_force(spark, docs_of):
    rows = corpus()
    got = B.classes(docs_of(rows, "content")).collect()
    want = brute_classes(rows)
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == sorted(zip([d for d, _ in rows], want, strict=True), key=str)
    kept = collections.Counter(r["class_id"] for r in got if r["first"])
    assert set(kept.values()) == {1} or kept[None] == len({t for d, t in rows if d is None}) - 1


def test_distinct_keeps_columns(spark, docs_of):
    rows = corpus(3)
    df = docs_of(rows, "bucket")
    out = B.distinct(df)
    assert out.columns == df.columns
    assert out.count() == B.classes(df).where("first").count()


def test_common_passage_links_nothing(spark, docs_of):
    rng = random.Random(8)
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(i, shared + " " + " ".join(f"{rng.random():.6f}" for _ in range(40))) for i in range(80)]
    got = B.classes(docs_of(rows)).collect()
    assert all(r["class_id"] == r["doc_id"] for r in got)


def test_result_does_not_depend_on_the_file_layout(spark, docs_of):
    rows = [(i, " ".join(f"w{k}" for k in range(200)) + f" end{i}") for i in range(12)]
    found = lambda df: sorted(tuple(v for c, v in r.asDict().items() if c not in ("rid", "text_hash")) for r in B.classes(df).collect())
    first = found(docs_of(rows).coalesce(1))
    assert {r[1:3] for r in first} == {(0, 12)}
    assert found(docs_of(rows[::-1]).coalesce(1)) == first
    assert all(len(set(r[1:-1] for r in found(docs_of(rows[k:] + rows[:k]).repartition(4)))) == 1 for k in (0, 5))


def test_empty(spark, docs_of):
    assert B.classes(docs_of([])).count() == 0
    assert B.distinct(docs_of([])).count() == 0
