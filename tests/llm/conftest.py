import pytest

from meterline.llm.common import prepare, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(ready):
    return table(ready, SF_DIR, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"{w}{i}" for i in range(3000) for w in WORDS.split())


@pytest.fixture(scope="session")
def odd(ready):
    """Nulls in every column, empty and very long texts, ties, a repeated row, and extra columns with clashing names."""
    rows = [
        (1, None, "en", "s"), (2, "", "en", "s"), (3, "   \n\t ", None, None), (4, LONG, "en", "s"), (5, LONG, "de", "s"), (6, WORDS, "en", "s"),
        (6, WORDS, "en", "s"), (None, "one two three four five six", "en", "s"), (7, "one two three four five six", "en", "s"), (8, "\n\n\n", "en", None),
    ]
    rows = [(i, t, lang, s, "x", 1.5, "y", 3, [1], "z") for i, t, lang, s in rows]
    return ready.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept string, shard double, size string, text_hash int, spans array<int>, n string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
