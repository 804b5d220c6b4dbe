from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import FIXTURE_SF, MESSY, documents  # noqa: E402

from kiln.llm import queries  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    return documents(spark, MESSY)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def fixture_table(spark):
    return lambda name: spark.read.parquet(f"{FIXTURE_SF}/{name}.parquet")


@pytest.fixture(scope="session")
def result(spark):
    """A registered query's rows on the fixture, computed once."""
    done = {}

    def get(name: str):
        if name not in done:
            done[name] = queries.QUERIES[name](spark, FIXTURE_SF).toPandas()
        return done[name]

    return get
