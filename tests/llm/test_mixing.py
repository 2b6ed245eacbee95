import hashlib
import random
import re

from fieldrank.llm import mixing as M


def brute(rows, weights=(5, 2, 1), epochs=3):
    """doc -> (size, source_size, target, times) by plain loops; rows are (id, text, lang, source)."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows]
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None] * any(r[3] is None for r in rows)
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    left, open_ = float(sum(total.values())), [s for s in names if total[s]]
    while open_:  # deal out what is left by weight; clamp who is above and deal the rest again
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if epochs * total[s] <= level * weight[s]]
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in above:
            target[s] = float(epochs * total[s])
            left -= target[s]
            open_.remove(s)
    out = []
    for s in names:
        own = sorted((hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), (r[0] is not None, r[0] or 0), n, r)
                     for n, r in zip(size, rows, strict=True) if r[3] == s)
        whole = int(target[s] // total[s]) if total[s] else 0
        extra, upto = target[s] - whole * total[s], 0
        for _, _, n, r in own:
            upto += n
            out.append((r[0], n, total[s], round(target[s], 6), whole + (extra > 0 and 2 * upto - n <= 2 * extra)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["row"]["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["times"]) for r in df.collect()), key=str)


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(6)
    rows = [(i, " ".join("w" * rng.randrange(1, 50)), "en", rng.choice(["big"] * 8 + ["b", "é", "z", "Z", None])) for i in range(300)]
    rows += [(400, None, "en", "b"), (401, "", "en", "empty"), (402, " \n", "en", "empty"), (403, "x " * 40_000, "en", "long"), (404, "a b", "en", "tiny"),
             (404, "a b", "en", "tiny"), (None, "c d e", "en", "z")]
    assert found(M.mix(docs_of(rows))) == brute(rows)


def test_clamped_sources_reach_three_epochs_and_targets_sum_up(spark, docs_of):
    rows = [(i, "w " * 100, "en", "a") for i in range(3)] + [(100 + i, "w " * 10, "en", "b") for i in range(500)] + [(900 + i, "w", "en", "c") for i in range(9)]
    got = M.mix(docs_of(rows)).collect()
    by = {s: [r for r in got if r["row"]["source"] == s] for s in "abc"}
    assert all(r["times"] == 3 for r in by["a"]) and all(r["times"] == 3 for r in by["c"])
    assert abs(sum(by[s][0]["target"] for s in "abc") - sum(r["size"] for r in got)) < 1e-6
    assert abs(sum(r["times"] * r["size"] for r in by["b"]) - by["b"][0]["target"]) <= 10


def test_mixed_repeats_rows_and_keeps_columns(spark, docs_of):
    rows = [(i, "w " * (i + 1), "en", "ab"[i % 2]) for i in range(40)]
    df = docs_of(rows, "size")
    out, taken = M.mixed(df), {r["row"]["doc_id"]: r["times"] for r in M.mix(df).collect()}
    assert out.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_reruns_agree_and_empty(spark, docs_of):
    rows = [(i, "w " * (i % 7 + 1), "en", "abc"[i % 3]) for i in range(90)]
    assert found(M.mix(docs_of(rows))) == found(M.mix(docs_of(rows).repartition(5)))
    assert M.mix(docs_of([])).count() == 0 and M.mixed(docs_of([(1, None)])).count() == 0


def test_rows_without_an_id_or_with_one_id_are_cut_exactly(spark, docs_of):
    rng = random.Random(8)
    rows = [(None, "w " * rng.randrange(1, 6) + rng.choice("xyz"), "en", "hot") for _ in range(700)]  # one hash, many equal rows
    rows += [(i, "w " * rng.randrange(1, 30), "en", rng.choice("ab")) for i in range(200)]
    rows += [(1007, "same words here", "en", "same")] * 300 + [(8, None, "en", "same")] * 20
    rows += [(None, "", "en", None), (5, "last", "en", None)]
    df = docs_of(rows)
    want = brute(rows)
    assert found(M.mix(df)) == want and found(M.mix(df.repartition(7))) == want
    assert any(0 < r[4] for r in want if r[0] == 1007) and len({r[4] for r in want if r[0] == 1007}) == 2
    # which of the rows without an id are repeated depends on their texts, not on their places
    texts = lambda d: sorted((r["row"]["text"], r["times"]) for r in M.mix(d).where("row.source = 'hot'").collect())
    assert texts(df) == texts(df.orderBy("text").repartition(3))


def test_equal_rows_are_numbered_over_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BITS", 3)
    rows = [(7, "same words here", "en", "a")] * 200 + [(1, "w " * 90, "en", "b")]
    assert found(M.mix(docs_of(rows).repartition(4))) == brute(rows)


def test_texts_are_not_shuffled(spark, docs_of):
    out = M.mixed(docs_of([(i, "w " * (i % 9 + 1), "en", "abc"[i % 3]) for i in range(90)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
