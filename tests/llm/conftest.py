import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def awkward(spark):
    from data import awkward, frame
    return frame(spark, awkward()).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    from data import frame
    return frame(spark, [])


@pytest.fixture(scope="session")
def vocabulary():
    from lumora.llm.queries import tokenizer
    return tokenizer()
