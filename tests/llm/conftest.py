import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.llm.common import ship_code

from odd_rows import SF001


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship_code(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank and long texts, repeated rows, and columns
    whose names the operators use themselves."""
    def make(rows):
        schema = "doc_id long, text string, score double, kept boolean, digest string, words long, pos int, n_tokens long, lang string"
        return spark.createDataFrame([(i, t, 1.0, True, "x", 1, 1, 1, None) for i, t in rows], schema)

    return make
