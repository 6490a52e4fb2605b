import pytest

from millrace.llm.batches import prepare

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sp(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(sp):
    """Documents with what tends to break a pass: nulls, blanks, repeated rows and ids, a very long text."""
    long = "The long and winding text goes on, " * 9000
    rows = [
        (1, "The first text of all, written in plain words for everyone to read.", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "de", "b", 4),
        (5, long, "en", "a", len(long)),
        (6, "Über die Straße geht ein Mann 😀 und läuft.", "de", "b", 5),
        (6, "Über die Straße geht ein Mann 😀 und läuft.", "de", "b", 5),
        (7, "one id", "en", "a", 1),
        (7, "two texts", "en", "a", 1),
        (None, "no id here", "en", "a", 1),
        (None, "no id here", "en", "a", 1),
        (9, "x" * 300, None, "a", 300),
    ]
    return sp.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(sp):
    return sp.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def sample(sp):
    return lambda name: sp.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
