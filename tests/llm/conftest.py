import duckdb
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n_tokens string, ids string, __id string, score string, _text_key string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long_text = " ".join(f"word{i % 977} of the long\nline {i}" for i in range(12_000))
    shared = "The same line for everyone"
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, long_text), (5, long_text), (5, long_text), (6, "<|endoftext|> and <|startoftext|>x"),
        (7, "a" * 5000), (8, "ÀÉ Straße İstanbul ΟΔΟΣ 日本語 👍 \x1c\x85  it's we'll 123"), (None, "no id"), (None, None), (9, "dup"), (10, "dup"),
        *[(20 + i, f"{shared}\nown line number {i} of document\n  {shared.upper()}  ") for i in range(12)], (40, shared), (40, shared),
    ]
    rows = [(i, t, None if k % 3 else "en", "x", None, "y", "z", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con
