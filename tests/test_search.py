"""The weight search against a plain replay whose means come from the sweep's DuckDB twin."""

import math
import random

from oracle_check import duck

from fieldrank.params import FIELDS, CosineWeights, cosine_weight_grid
from fieldrank.plans import catalog
from fieldrank.plans.sweeps import next_settings, search_cosine_weights

SF = "/root/testdata/sf0.001"


def by_sql(con, settings):
    cur = con.execute(catalog._cos_sweep_sql(settings))
    names = [d[0] for d in cur.description]
    rows = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    found = {}
    for w in settings:
        near = [r for r in rows if all(math.isclose(float(r[f"w_{f}"]), getattr(w, f), rel_tol=1e-9) for f in FIELDS)]
        assert len(near) == 1
        found[w] = near[0]["mean_ndcg"]
    return found


def test_search_equals_a_plain_replay(spark):
    got = search_cosine_weights(catalog.docs_job(spark, SF), spark, seed=3, rounds=1, per_round=6, keep=2).collect()
    con, rng = duck(SF), random.Random(3)
    grid = list(cosine_weight_grid())
    means = by_sql(con, grid)
    best = sorted(grid, key=lambda w: -means[w])[:2]
    second = [CosineWeights(**{f: getattr(best[k % 2], f) * math.exp(rng.uniform(-math.log(8), math.log(8))) for f in FIELDS})
              for k in range(6)]
    means |= by_sql(con, second)
    assert [(r["round"], tuple(r)[1:6]) for r in got] == [(n, w.as_tuple()) for n, part in enumerate((grid, second)) for w in part]
    assert all(abs(r["mean_ndcg"] - means[CosineWeights(*tuple(r)[1:6])]) < 2e-6 for r in got)
    top = [r for r in got if r["best"]]
    assert len(top) == 1 and top[0]["mean_ndcg"] == max(r["mean_ndcg"] for r in got)
    assert max(r["mean_ndcg"] for r in got) >= max(r["mean_ndcg"] for r in got if r["round"] == 0)


def test_settings_depend_on_the_seed_only():
    best = list(cosine_weight_grid())[:3]
    one, two, other = (next_settings(best, 9, 1.0, random.Random(s)) for s in (1, 1, 2))
    assert one == two != other and len(set(one)) == 9
    for k, w in enumerate(one):
        assert all(math.exp(-1) <= getattr(w, f) / getattr(best[k % 3], f) <= math.exp(1) for f in FIELDS)
