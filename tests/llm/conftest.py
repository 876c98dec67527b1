
import pytest

from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Nulls, empty, blank and long texts, ties, repeated rows and a repeated id."""
    long = "".join(f"wort{i % 977} " for i in range(30000))
    passage = " ".join(f"stück{i}" for i in range(60))
    return [
        (900001, None, None, None, None), (900002, "", "en", "s", 0), (900003, " \n\t ", "en", "s", 4),
        (900004, "one", "xx", "s", 3), (900005, "a b", "de", None, None), (900006, long, "en", "s", len(long)),
        (900007, long, "en", "s", len(long)), (900008, "ab " * 400, "en", "s", 1200), (900008, "ab " * 400, "en", "s", 1200),
        (900009, f"vor {passage} nach", "de", "s", 1), (900010, f"Erst {passage} dann", "de", "s", 1),
        (900011, "x" * 1000, "en", "s", 1000), (900012, "MIT license, GNU General Public License v3; cc-by", "en", "s", 1),
        (900009, "another text of the same id", "en", "s", 1), (900013, "É é É ß don't 12.5,  x", "fr", "s", 1),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    return table.union(spark.createDataFrame(odd_rows(), DOCS)).repartition(5).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [tuple(r)[:2] for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


