import collections
import random
import re

from fieldrank.llm import outliers as O


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + d for k in range(len(w) - 2) if runs[tuple(w[k:k + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in O.SYMBOLS for c in text), dup, len(covered)


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n", "a", "a a a", "a a a a", "a b a b a", "a a a a a", "x y z x y z", "é ñ 日 é ñ 日", "l\nl\n l\nl\r\n\n\n", "a\u00a0b\x85c", "a b c " * 5000]
    for _ in range(80):
        out.append("".join(rng.choice(["a", "b", "c", "#", "é"]) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randrange(40))))
    return out


def test_base_statistics(spark, docs_of):
    rows = list(enumerate(texts()))
    got = {r["row"]["doc_id"]: r for r in O.judged(docs_of(rows, "n_words")).collect()}
    for i, t in rows:
        r = got[i]
        assert tuple(r[c] for c in O.STATS) == brute(t), t
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rejects_odd_documents_of_a_group_only(spark, docs_of):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, n)))
    rows = [(i, " ".join(word(9) for _ in range(rng.randrange(60, 400))), "en", "s1") for i in range(200)]
    rows += [(1000 + i, " ".join(word(9) + "#%&" for _ in range(100)), "en", "s1") for i in range(40)]
    # in another source symbols are usual
    rows += [(2000 + i, " ".join(word(9) + "#%&" for _ in range(rng.randrange(60, 400))), "en", "s2") for i in range(100)]
    rows += [(3000, " ".join(word(9) for _ in range(100)), None, None)]  # alone in its group and language
    got = {r["row"]["doc_id"]: r["kept"] for r in O.judged(docs_of(rows)).collect()}
    assert not any(got[1000 + i] for i in range(40))
    assert all(got[i] for i in got if i < 1000 or i >= 2000)


def moments(x):
    import numpy as np

    return x.mean(axis=0), np.cov(x.T, bias=True).reshape(5, 5) + O.FLOOR * np.eye(5)


def distances(x, m, c):
    import numpy as np

    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)


def plain_mcd(x):
    """Mean and covariance by the module's rule, row by row."""
    import numpy as np

    def core(d2):
        rung = np.round(np.log1p(d2) * 100 + 1e-9).astype(int)
        return x[rung <= np.sort(rung)[int(np.ceil(O.CORE * len(x))) - 1]]

    m = np.median(np.round(x, 2), axis=0)
    mad = np.median(np.round(np.abs(x - m), 2), axis=0)
    found = []
    for start, at in enumerate([(m, np.diag((1.4826 * mad) ** 2 + O.FLOOR)), (m, np.eye(5)), moments(x)]):
        last = np.inf
        while True:
            at = moments(core(distances(x, *at)))
            now = np.linalg.slogdet(at[1])[1]
            if now >= last - O.LEAST_FALL:
                break
            found.append((now, start, at))
            last = now
    m, c = min(found, key=lambda f: f[:2])[2]
    scale = np.expm1(np.median(np.round(np.log1p(distances(x, m, c)), 2))) / O.CHI2_MEDIAN
    return moments(x[distances(x, m, c) <= O.CUTOFF * max(scale, 1)])


def combined(own, n, above):
    import numpy as np

    w = n / (n + O.PRIOR)
    gap = own[0] - above[0]
    return w * own[0] + (1 - w) * above[0], w * own[1] + (1 - w) * above[1] + w * (1 - w) * np.outer(gap, gap)


def vectors(spark, rows):
    """A table of (lang, source, vector) rows."""
    flat = [(lang, source, i % O.SALTS, *map(float, v)) for i, (lang, source, v) in enumerate(rows)]
    return spark.createDataFrame(flat, "lang string, source string, salt int, " + ", ".join(f"x{k} double" for k in range(5)))


def test_matches_numpy_mcd(spark):
    """The estimates of groups of 1, 7, 60 and 300 rows equal those computed row by row."""
    import numpy as np

    rng = np.random.default_rng(0)
    mix = rng.normal(size=(5, 5))
    rows = []
    for lang, source, n in (("en", "a", 300), ("en", "b", 60), ("en", None, 7), ("de", "a", 1), (None, "c", 90)):
        x = rng.normal(size=(n, 5)) @ mix + rng.normal(size=5)
        x[: n // 3] += 25  # junk of one kind in a third
        rows += [(lang, source, np.round(v, 6)) for v in x]
    group = lambda lang=0, source=0: np.array([v for a, b, v in rows if lang in (0, a) and source in (0, b)])
    everything = plain_mcd(group())
    got = {tuple(map(r["group"].__contains__, ('"en"', '"de"', '"a"', '"b"', '"c"'))): r
           for r in O.group_shapes(vectors(spark, rows)).collect()}
    assert len(got) == 5
    for (lang, source), key in {("en", "a"): (1, 0, 1, 0, 0), ("en", "b"): (1, 0, 0, 1, 0), ("en", None): (1, 0, 0, 0, 0),
                                ("de", "a"): (0, 1, 1, 0, 0), (None, "c"): (0, 0, 0, 0, 1)}.items():
        language = combined(plain_mcd(group(lang)), len(group(lang)), everything)
        own = group(lang, source)
        m, c = combined(plain_mcd(own), len(own), language)
        r = got[tuple(map(bool, key))]
        assert np.allclose([r[f"m{k}"] for k in range(5)], m, atol=1e-6)
        l = np.linalg.cholesky(c)
        assert np.allclose([r[f"l{i}_{j}"] for i, j in O.PAIRS], [l[i, j] for i, j in O.PAIRS], atol=1e-6)


def test_small_groups_are_judged_by_their_language(spark, docs_of):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    text = lambda tail="": " ".join(word() + tail for _ in range(rng.randrange(60, 400)))
    rows = [(i, text(), "en", f"s{i % 40}") for i in range(400)]  # ten a source
    rows += [(1000 + i, text("#%&"), "en", f"s{i}") for i in range(40)]  # one more each
    rows += [(2000, text("#%&"), "en", "alone"), (2001, text(), "en", "alone2"), (2002, text(), None, None)]
    rows += [(3000, rows[0][1], "en", "s0")] * 3  # repeated rows
    got = {r["row"]["doc_id"]: r["kept"] for r in O.judged(docs_of(rows)).collect()}
    assert {i for i in got if not got[i]} == {*range(1000, 1040), 2000}


def test_empty(spark, docs_of):
    assert O.judged(docs_of([])).count() == 0


def test_rejects_junk_of_one_kind_in_up_to_two_fifths_of_a_group(spark, docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows = []
    for k, junk in enumerate((60, 80)):  # of 200
        rows += [(1000 * k + i, " ".join(word() for _ in range(rng.randrange(60, 400))), "en", f"s{k}") for i in range(200 - junk)]
        rows += [(1000 * k + 500 + i, " ".join(word() + "#%&" for _ in range(100)), "en", f"s{k}") for i in range(junk)]
    got = {r["row"]["doc_id"]: r["kept"] for r in O.judged(docs_of(rows)).collect()}
    assert {i for i in got if got[i]} == {i for i in got if i % 1000 < 500}
