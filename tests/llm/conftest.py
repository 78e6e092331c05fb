import pytest

from .helpers import awkward_rows, documents


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The awkward documents, with further columns of clashing names."""
    return documents(spark, rows).cache()


@pytest.fixture(scope="session")
def unique_rows(rows):
    """Those of known, unique doc_id: what brute force over ids can speak of."""
    ids = [r[0] for r in rows]
    return [r for r in rows if r[0] is not None and ids.count(r[0]) == 1]


@pytest.fixture(scope="session")
def unique_docs(spark, unique_rows):
    return documents(spark, unique_rows).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
