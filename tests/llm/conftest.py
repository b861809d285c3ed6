import pytest

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF0001


@pytest.fixture(scope="session")
def documents(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]


#: Texts that break careless code: null, empty, white space, ties, repeats, odd characters, very long words.
ODD = [None, "", " ", "\n\n", "a", "a b c d", "a b c d", "A\x0bB\x1cC\x85D\xa0E", "x" * 5000, "é ß 漢字 🙂 <|endoftext|> <|EndOfText|>", "1 " * 3000, "l1\nl2\nl3\nl4"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i if i != 5 else None, t, "en", None if i % 3 else "s", len(t) if t else None, i, "clash") for i, t in enumerate(ODD)]
    rows.append((2, " ", "en", "s", 1, 2, "clash"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, `id` string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
