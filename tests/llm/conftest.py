import pytest

from tidemark.llm.common import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def texts_frame(spark, texts, **more):
    """documents with the given texts, ids 0..., and a clashing or extra column for each keyword."""
    rows = [(i, t, *more.values()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", `{k}` string" for k in more))


@pytest.fixture
def frame(spark):
    return lambda texts, **more: texts_frame(spark, texts, **more)


ODD = [None, "", " \t\n ", "a", "éß 中文 😀", "same text here", "same text here", "x" * 5000, "word " * 3000, "\x0b\x0c\r\x85\xa0"]


@pytest.fixture
def odd():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return list(ODD)
