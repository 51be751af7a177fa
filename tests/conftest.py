import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from claimflow.session import get_session

    with tempfile.TemporaryDirectory(prefix="claimflow-tests-") as shared:
        s = get_session("local[4]", app_name="claimflow-tests", shuffle_partitions=8,
                        **{"spark.checkpoint.dir": f"file://{shared}/checkpoints",
                           "spark.sql.warehouse.dir": f"file://{shared}/warehouse"})
        yield s
        s.stop()


@pytest.fixture(scope="session")
def fixture_tables(spark):
    from helpers import SF_SMALL

    from claimflow.sources.fixtures import entities

    return entities(spark, SF_SMALL)
