import math
import random

from pyspark.sql import functions as F

from fieldrank.llm import quality as Q


def combined(spark, rows):
    df = spark.createDataFrame(rows, "host string, path string, p double")
    return Q.combined(df).collect()


def brute(rows):
    """Scores by plain loops; rows are (host, path, p)."""
    n = len(rows)
    mean = round(sum(p for *_, p in rows) / n, 9)

    def weight(sites, prior):
        many = {k: v for k, v in sites.items() if len(v) > 1}
        total = sum(map(len, many.values()))
        if len(many) < 2 or total <= len(many):
            return Q.MOST_WEIGHT
        means = {k: sum(v) / len(v) for k, v in many.items()}
        inside = sum(sum((x - means[k]) ** 2 for x in v) for k, v in many.items()) / (total - len(many))
        outside = sum(len(v) * (means[k] - prior(k)) ** 2 for k, v in many.items())
        between = max((outside - len(many) * inside) / total, 1e-9)
        return round(min(max(inside / between, 1.0), Q.MOST_WEIGHT), 6)
    hosts, paths = {}, {}
    for h, d, p in rows:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, d), []).append(p)
    kh = weight(hosts, lambda h: mean)
    host_mean = {h: (sum(v) + kh * mean) / (len(v) + kh) for h, v in hosts.items()}
    kp = weight(paths, lambda k: host_mean[k[0]])
    logit = lambda x: math.log(min(max(x, 1e-6), 1 - 1e-6) / (1 - min(max(x, 1e-6), 1 - 1e-6)))
    out = []
    for h, d, p in rows:
        hp = (sum(hosts[h]) - p + kh * mean) / (len(hosts[h]) - 1 + kh)
        pp = (sum(paths[h, d]) - p + kp * hp) / (len(paths[h, d]) - 1 + kp)
        shift = max(min(logit(pp) - logit(mean), Q.MOST_SHIFT), -Q.MOST_SHIFT)
        out.append((h, d, p, 1 / (1 + math.exp(-(logit(p) + shift)))))
    return out


def test_posteriors_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for h in range(12):
        level = rng.random()
        for d in range(rng.randrange(1, 4)):
            rows += [(f"h{h}", f"h{h}/{d}", min(max(rng.gauss(level, 0.15), 0.001), 0.999)) for _ in range(rng.choice([1, 2, 5, 60]))]
    rows += [(None, None, 0.4), (None, "x", 0.9), ("lone", None, 0.2)]
    rows = [(h, d, round(p, 6)) for h, d, p in rows]
    got = sorted(((r["host"], r["path"], r["p"], r["score"]) for r in combined(spark, rows)), key=str)
    for a, b in zip(got, sorted(brute(rows), key=str), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 2e-6


def test_sparse_sites_shrink_and_sites_alone_reject_nothing(spark):
    rows = [("bad", "bad/a", 0.05)] * 300 + [("good", "good/a", 0.95)] * 300 + [("bad", "bad/a", 0.99), ("good", "good/a", 0.5), ("new", "new/a", 0.5), ("bad", "bad/a", 0.5)]
    got = {(r["host"], r["p"]): r for r in combined(spark, rows)}
    assert got["bad", 0.5]["score"] < got["new", 0.5]["score"] < got["good", 0.5]["score"]
    assert abs(got["new", 0.5]["score"] - 0.5) < 0.05
    assert got["bad", 0.99]["score"] >= Q.CUT


def texts(n=120):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 80))]
        good = i % 3 > 0
        out.append((i, " ".join(words) + "." if good else "%% ".join(words).upper(), int(good)))
    return out


def test_keeps_good_documents_and_edges(spark, docs_of):
    rows = texts()
    extra = [(500, None), (501, ""), (None, "some words here now"), (502, "word " * 50_000), (0, rows[0][1])]
    docs = docs_of([(i, t, "en", f"s{i % 2}") for i, t, _ in rows] + [(i, t, None, None) for i, t in extra], "p")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (501, None), (9999, 0)], "doc_id long, quality int")
    got = Q.scored(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert sum((i in kept) == bool(y) for i, _, y in rows) >= 118
    out = Q.good(docs, labels)
    assert out.columns == docs.columns and out.count() == sum(r["kept"] for r in got)
    assert Q.scored(docs, labels.limit(0)).where(F.col("p").between(0.49, 0.51)).count() == len(got)
    assert Q.scored(docs_of([]), labels).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    p = Q.scorer(Q.train(docs, labels.where(~fold)))
    got = docs.join(labels.where(fold), "doc_id").select(p("text").alias("p"), "quality").collect()
    right = sum((r["p"] >= Q.CUT) == (r["quality"] == 1) for r in got)
    assert right / len(got) > 0.95
