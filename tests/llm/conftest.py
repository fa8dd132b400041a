import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import nasty  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return nasty.documents(spark).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return nasty.empty(spark)
