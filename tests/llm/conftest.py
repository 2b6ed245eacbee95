import pytest

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source) rows, with a column
    whose name clashes with computed ones."""
    from pyspark.sql import functions as F

    def make(rows, clash="size"):
        full = [(*r, "en", "s") if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, DOCS).withColumn(clash, F.lit("x")).withColumn("row", F.lit(1))
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
