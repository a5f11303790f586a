import pytest

from marquee.llm.common import ship_package

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, shard int, score string, bucket int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names operators use."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    base = " ".join(words * 3)
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", "b"), (3, base + " omega", "en", "a"),
        (4, None, "en", "a"), (5, "", None, None), (6, "  \n\t ", "de", "b"), (7, "one two", "de", None),
        (None, "a row without an id, with some words in it", "en", "c"), (8, "\n".join([base, "own line of doc eight", base]), "en", "c"),
        (9, "x" * 3000, "en", "a"), (10, " ".join(f"w{i}" for i in range(4000)), None, "a"), (11, "äöü ÉÈ 東京 " * 50, "de", "b"),
        (12, "Mail olm.80@mail9.example.com or +1 (668) 555-2281, card 4539 5787 6362 1486, on 2019-05-03 from 19.158.174.88", "en", "a"),
        (13, base.upper(), "en", "b"),
    ]
    return [(i, t, lang, source, len(t or ""), "big", 7, "high", 3) for i, t, lang, source in rows]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
