"""The robust-pruned graph against brute force over all vectors."""

import numpy as np
import pytest

from fieldrank.llm import vector_graph as vg


def nearest(rows, every=1, k=5):
    """query id -> [(id, cosine)] by comparing all vectors in double precision."""
    out, ids = {}, np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(0, len(rows), every):
        s = v @ v[q]
        s[ids == ids[q]] = -9
        order = sorted(range(len(rows)), key=lambda j: (-round(s[j], 12), ids[j]))[:k]
        out[int(ids[q])] = [(int(ids[j]), s[j]) for j in order if s[j] > -9]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS shard", "1 AS rank")


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def floats(v):
    return np.asarray(v, np.float32).astype(float).tolist()


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = vectors.where("vec_id % 50 = 0")
    want = {q: w for q, w in nearest(rows).items() if q % 50 == 0}
    got = found(vg.search(vg.build(vectors, shard_rows=2000), queries, query_rows=30))  # several shards, several blocks
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    assert found(vg.op11_vector_graph(spark, "/root/testdata/sf0.1")).keys() == want.keys()
    scores = {(q, i): s for q, w in want.items() for i, s in w}
    for q, w in got.items():
        for i, s in w:
            assert (q, i) not in scores or abs(scores[q, i] - s) < 1e-12


@pytest.mark.parametrize("spread", [0.3, 1e-3])
def test_clusters_of_nearly_equal_vectors(spark, spread):
    """A third of the vectors lie in one tight group, the rest in small groups."""
    g = np.random.default_rng(7)
    centres = g.normal(size=(40, 16))
    own = np.where(g.random(3000) < 1 / 3, 0, g.integers(1, 40, 3000))
    rows = [(k, floats(centres[c] + spread * g.normal(size=16))) for k, c in enumerate(own)]
    want = nearest(rows, 20)
    got = found(vg.search(vg.build(frame(spark, rows), shard_rows=1500), frame(spark, rows[::20])))
    assert recall(got, want) >= 0.95


def test_copies_are_all_candidates(spark):
    g = np.random.default_rng(3)
    v = [floats(x) for x in g.normal(size=(30, 8))]
    rows = [(k, v[0] if k < 700 else v[k % 30]) for k in range(1500)]
    got = found(vg.search(vg.build(frame(spark, rows), shard_rows=10), frame(spark, rows[::50])))
    want = nearest(rows, 50)
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [4.0, 4.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, inf]),
            (8, [None, 1.0]), (None, [1.0, 0.0]), (100, None), (150, [1.0, 0.0, 0.0]), (0, [1.0, 0.0]), (200, [2.0**100, 2.0**100]), (9, [-0.0, 2.0**-100])]
    got = found(vg.search(vg.build(frame(spark, rows)), frame(spark, [r for r in rows if r[0] is not None and r[0] % 50 == 0])))
    half = 0.5 ** 0.5
    assert {q: [(i, pytest.approx(s)) for i, s in w] for q, w in got.items()} == {
        0: [(1, half), (2, half), (200, half), (9, 0.0), (50, 0.0)][:3] + [(9, 0.0), (50, 0.0)],
        50: [(9, 1.0), (1, half), (2, half), (200, half), (0, 0.0)],
        200: [(1, 1.0), (2, 1.0), (0, half), (9, half), (50, half)]}


def test_empty_table(spark):
    none = frame(spark, [(1, [1.0])]).where("vec_id > 1")
    assert vg.search(vg.build(none), none).collect() == []
