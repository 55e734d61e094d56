import duckdb
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, body string, digest string, _file string, doc string, node string, hub string"


def _prose(n: int, start: int) -> str:
    return " ".join(f"w{(start * 7919 + i * i * 31 + i) % 997}" for i in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls everywhere, empty and long texts, ties, repeated rows, shared lines, near copies."""
    base = _prose(120, 1)
    near = base.replace("w", "w", 1).rsplit(" ", 2)[0] + " Changed end"
    line = "This licence line is shared by many documents."
    texts = [
        (0, base, "en", "b"), (1, base.upper(), "en", "b"), (2, near, "en", "a"), (3, None, "en", "a"), (4, "", None, None),
        (5, "   \t\n ", "de", None), (6, f"{line}\n{_prose(60, 5)}\n{line}", "de", "a"), (7, f"  {line.upper()}\n{_prose(70, 6)}", "de", "a"),
        (8, f"{_prose(80, 7)}\n{line}\n\nshort\nshort", "fr", "é"), (9, line, "fr", "é"), (10, "1234 5678 !!!", "fr", "z"),
        (11, "a b c a b c a b c", None, "z"), (12, _prose(20_000, 9), "en", "z"), (13, "x" * 50_000, "en", "z"),
        (14, "naïve café ▁ 漢字 😀 ß end", "fr", "z"), (15, base, None, "b"),
    ]
    texts += [(16, _prose(55, 40), "en", "a")] * 2 + [(None, _prose(58, 41), "en", "a"), (None, None, None, None)]
    texts += [(20 + k, _prose(60 + k, 50 + k), ("en", "de")[k % 2], f"s{k % 4}") for k in range(30)]
    return [(i, t, lang, s, None, "k", "b", "d", "f", "doc", "n", "h") for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(rows, COLUMNS).coalesce(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "none.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(0, 1, 0), (6, 0, 0), (6, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 0)] + [(20 + k, k % 2, 0) for k in range(30)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    return con

