import os
import sys

import pytest

sys.path.append(os.path.dirname(os.path.abspath(__file__)))

from llm_cases import CLASH, SCHEMA, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, a long one, ties, repeated rows, clashing names."""
    data = [(i, t, ("en", "fr", None)[i % 3], "s", len(t) if t else None) + ("clash",) * len(CLASH)
            for i, t in enumerate(TEXTS)]
    data.append(data[12])  # a repeated row
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
