import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def run(spark):
    from claimflow.llm.scratch import scratch

    with scratch(spark) as r:
        yield r


@pytest.fixture(scope="session")
def awkward(spark):
    from helpers_llm import awkward_docs, docs_frame

    rows = awkward_docs()
    return rows, docs_frame(spark, rows)
