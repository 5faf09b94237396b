import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

from llm_tables import DOCS  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def _ship(spark):
    from scrubjay.session import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra
    columns whose names clash with outputs."""
    rows = [(1, "the mit license", "en", "b", 1), (1, "the mit license", "en", "b", 1), (2, None, None, None, None),
            (3, "", "en", "a", 0), (4, "word " * 60_000, "en", "b", 300_000), (None, "some other text here", "de", None, 3),
            (5, "é \t ü\n", "fr", "a", 3), (6, "   ", None, "c", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for clash in ("Size", "shard", "n_words", "component_id", "score", "labels", "k"):
        df = df.selectExpr("*", f"'x' AS `{clash}`")
    return df
