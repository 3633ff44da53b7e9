import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def documents(spark):
    """documents(("text", ...)) -> rows with ids from 0; documents({id: text})"""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame(list(zip(ids, texts)), DOCS)

    return make


@pytest.fixture
def with_clashes(documents):
    """The same rows with columns named like those that the operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "ids", "path", "comp", "train", "places", "score", "label", "bucket", "kept", "item_id", "edits", "rest", "word"]

    def make(texts, ids=None):
        return documents(texts, ids).select("*", *(F.lit("x").alias(n) for n in names))

    return make
