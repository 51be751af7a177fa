"""Library-wide rules: the data stays in Spark, staged data is cleaned up."""

import pathlib
import re

import pytest

from claimflow.session import materialize, staging_scope

PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "claimflow"

# Calls that would pull data through the driver, leave the JVM row by row,
# pair rows up, cut lineage to executor-local storage or force a broadcast.
FORBIDDEN = {
    "collect": r"\.collect\(",
    "toPandas": r"\.toPandas\(",
    "rdd": r"\.rdd\b",
    "python udf": r"\budf\(|pandas_udf|applyInPandas|mapInPandas",
    "localCheckpoint": r"localCheckpoint",
    "cross join": r"crossJoin|\"cross\"",
    "broadcast hint": r"\bbroadcast\(|\.hint\((?!\"merge\"\))",
}


@pytest.mark.parametrize("rule", sorted(FORBIDDEN))
def test_library_has_no(rule):
    hits = [f"{p.relative_to(PACKAGE.parent)}:{i}"
            for p in sorted(PACKAGE.rglob("*.py")) if "llm" not in p.relative_to(PACKAGE).parts
            for i, line in enumerate(p.read_text().splitlines(), 1)
            if re.search(FORBIDDEN[rule], line)]
    assert not hits, hits


def test_staging_scope_deletes_staged_tables_on_failure(spark):
    import glob

    with pytest.raises(RuntimeError):
        with staging_scope(spark) as paths:
            materialize(spark.range(5), "scope-test").count()
            raise RuntimeError("report write failed")
    assert len(paths) == 1
    assert not glob.glob(paths[0].removeprefix("file:"))
