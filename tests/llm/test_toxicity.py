import zlib

import numpy as np

from fieldrank.llm import toxicity as T


def rows_for(n, bias):
    """Texts whose toxicity is the word 'vile'; 'muslim' is mentioned more often in toxic ones."""
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    out = []
    for i in range(n):
        toxic = int(rng.random() < 0.4)
        text = list(rng.choice(words, 12)) + ["vile"] * int(toxic and rng.random() < 0.7)
        if rng.random() < (bias if toxic else 0.03):
            text.insert(3, "muslim")
        elif rng.random() < 0.3:
            text.insert(3, "buddhist")
        out.append((i, " ".join(text) + ".", toxic))
    return out


def model(spark, rows, penalty):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return T.train(docs, labels, penalty=penalty)


def score(spark, m, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    return [r["s"] for r in df.select("i", T.scorer(m)("text").alias("s")).orderBy("i").collect()]


def test_swaps_cost_group_mentions_their_weight(spark):
    rows = rows_for(600, 0.95)
    free, fair = model(spark, rows, 0.0), model(spark, rows, T.PENALTY)
    neutral = ["the muslim family wab wac", "the buddhist family wab wac"]
    a, b = score(spark, free, neutral), score(spark, fair, neutral)
    assert a[0] - a[1] > 3 * abs(b[0] - b[1])
    assert b[0] < a[0] and b[0] < T.CUT
    assert score(spark, fair, ["this is vile wab"])[0] > 0.5


def test_swap_texts():
    got = T.swaps("A Muslim man. No one. muslims", {"r": ["muslim", "jewish"], "g": ["man", "woman"]})
    assert got == ["a jewish man. no one. muslims", "a muslim woman. no one. muslims"]
    assert T.swaps(None) == []


def test_edges_and_fold(spark, docs_of):
    rows = rows_for(80, 0.5)
    docs = docs_of([r[:2] for r in rows] + [(None, "vile"), (900, None), (901, ""), (902, "vile wab " * 30_000), (902, "vile wab " * 30_000)])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (900, None), (5000, 1)], "doc_id long, toxic int")
    s = T.scorer(T.train(docs, labels))
    got = docs.select("doc_id", T.in_fold(docs["doc_id"]).alias("h"), s("text").alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in got) and len(got) == docs.count()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 4 == 2) for r in got)
    by = [r["s"] for r in got if r["doc_id"] in (900, 901)]
    assert by[0] == by[1] and len({r["s"] for r in got if r["doc_id"] == 902}) == 1
    assert score(spark, T.train(docs, labels.limit(0)), ["x", None]) == [0.5, 0.5]
    assert docs.limit(0).select(s("text")).count() == 0


def test_held_out_labels_change_nothing(spark):
    rows = rows_for(200, 0.3)
    flip = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, t, y in rows]
    a, b = model(spark, rows, T.PENALTY), model(spark, flip, T.PENALTY)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_held_out_accuracy(spark):
    from fieldrank.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r["score"], labels[r["doc_id"]]) for r in QUERIES["op2_toxicity"](spark, sf).collect() if r["doc_id"] in labels and r["held_out"]]
    good, bad = [s for s, y in got if y], [s for s, y in got if not y]
    auc = np.mean([[(a > b) + (a == b) / 2 for b in bad] for a in good])
    assert auc > 0.85


def plain_features(text):
    import xxhash

    out = set()
    for word in text.lower().replace(".", " ").split():
        s = "^" + word + "$"
        out |= {word, s[:4], s[:5], s[:6]} | {s[i:i + 4] for i in range(len(s) - 3)}
    return {xxhash.xxh3_64_intdigest(g) % 2**T.BITS for g in out}


def plain_scores(train_rows, texts):
    """The dealt loss with dense matrices and swaps by tokens, minimised by the same steps."""
    x = [plain_features(t) for t, _ in train_rows]
    y = np.array([label for _, label in train_rows], float)
    swapped = []
    for t, _ in train_rows:
        tokens = t.lower().rstrip(".").split()
        for axis in T.IDENTITY_TERMS.values():
            for term in axis:
                if term in tokens:
                    swapped += [(t, " ".join(o if w == term else w for w in tokens) + ".") for o in axis if o != term]
    places = sorted(set().union(*x, *(plain_features(s) for _, s in swapped)))
    rows = lambda sets: np.array([[p in s for p in places] for s in sets], float)
    raw = rows(x)
    ratio = np.log((raw[y == 1].sum(0) + 1) / (y.sum() + 2)) - np.log((raw[y == 0].sum(0) + 1) / ((1 - y).sum() + 2))
    ratio[raw.sum(0) < T.MIN_DOCS] = 0
    m = raw * ratio
    change = (rows([plain_features(s) for _, s in swapped]) - rows([plain_features(t) for t, _ in swapped])) * ratio
    weight = np.where(y == 1, np.clip((1 - y).sum() / y.sum(), 1, T.MOST_WEIGHT), 1) / len(y)
    w, first, second = np.zeros(len(places) + 1), 0.0, 0.0
    for k in range(1, T.ROUNDS + 1):
        error = weight * (1 / (1 + np.exp(-(m @ w[:-1] + w[-1]))) - y)
        grad = np.append(m.T @ error + T.L2 * w[:-1] + 2 * T.PENALTY * change.T @ (change @ w[:-1]) / len(change), error.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w = w - T.RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return 1 / (1 + np.exp(-(rows([plain_features(t) for t in texts]) * ratio @ w[:-1] + w[-1])))


def test_equals_a_plain_fit_and_score(spark):
    rows = rows_for(160, 0.6)
    got = score(spark, model(spark, rows, T.PENALTY), [t for _, t, _ in rows] + ["", "unseen words only"])
    fold = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    want = plain_scores(fold, [t for _, t, _ in rows] + ["", "unseen words only"])
    assert np.abs(np.array(got) - want).max() < 1e-4
    assert max(got) > 0.6 and min(got) < 0.3
