"""fieldrank: fielded search ranking and evaluation as Spark DataFrame jobs.

Layout
------
functions/  Column -> Column helpers (tokenisers, tf transforms, boosts, BM25F maths, NDCG gain)
sources/    readers and writers (feature files, judgments, rankings, corpus, parquet test tables)
operators/  DataFrame -> DataFrame building blocks (statistics, index, vectors, windows, ranking, NDCG)
plans/      end-to-end rankers, evaluation and parameter sweeps
streaming/  ranking applied to query files that arrive over time
"""

from fieldrank.params import (  # noqa: F401
    BM25FParams,
    CosineWeights,
    WindowBoost,
)
