import pytest

from fleetmart.llm import inputs

#: Columns that operators use inside themselves.
CLASHING = ["node", "label", "size", "path", "shard", "group", "a", "own", "weight", "fold", "sequence_id", "ids", "score", "rank"]


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    inputs.importable(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with columns whose names clash with the operators' own."""

    def make(rows):
        own = ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([(*r, *("x" for _ in CLASHING)) for r in rows], f"doc_id long, text string, {own}")

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
