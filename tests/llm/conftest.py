import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


LONG = "lorem ipsum dolor sit amet " * 4000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_lines string, dropped string, toxicity string, _id string, template string, sig string, rep string")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    base = [(1, None), (2, ""), (3, "one"), (4, "one"), (4, "one"), (5, LONG), (6, LONG), (None, "one two three four"),
            (None, None), (7, "\n\n \n"), (8, "a line that repeats\nb"), (9, "A line that REPEATS \nc"),
            (9, "a second text under one id\nc"), (10, "é" * 300), (11, "x" * 700)]
    return [(d, t, None if d == 3 else "en", "s" if d != 4 else None, None if t is None else len(t), "x", "x", "x", "x",
             "x", "x", "x") for d, t in base]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}
