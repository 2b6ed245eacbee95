"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared folder and rereads it as the next stage's documents. All but the last keep the
columns of ``documents``.

1. quality: documents that the hierarchical empirical Bayes classifier rejects go;
2. exact dedup: of equal texts (A-Z lower-cased) the one with the largest doc_id stays;
3. near dedup: one document of each class of near copies stays (its least doc_id);
4. mixing: each source's documents are dropped or repeated to meet its target weight;
5. packing: the tokenised documents are cut into pieces and placed in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldrank.llm import bagminhash, cuckoo, mixing, quality, sos_packing
from fieldrank.llm.common import table, written

VOCABULARY = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cuckoo.distinct(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sos_packing.pack(sos_packing.pieces(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: No SQL expresses the classifier, the signatures or the tokeniser; the tests compare the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
