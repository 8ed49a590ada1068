import pytest

from keelson.session import ship_package

#: One text of each odd kind: (doc_id, text).
LONG = " ".join(f"word{i % 977} goes{i % 13}" for i in range(30000)) + ".\nLast line here."
SAME = "The same five words and then some more words follow here. Another sentence of it.\nA second line of it all."
ODD = [
    (1, None), (2, ""), (3, " \n\t \n"), (4, "one two three"), (5, SAME), (6, SAME), (6, SAME), (7, SAME + " more"),
    (None, SAME), (8, LONG), (9, LONG), (10, "é 日本 ▁x <|im_end|> 🙂\x00 <|endoftext|>\r\n\x0bend"), (11, "x" * 5000), (None, None),
    (12, "This This This " * 40),
]
#: Extra columns, with names that operators use themselves.
CLASH = ["kept", "n_words", "part", "batch", "bytes", "blob", "score", "uid", "tokens", "group", "node", "bucket", "n_tokens",
         "_keelson", "rank"]


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture()
def odd(llm):
    rows = [(i, t, "en", "s", len(t or "")) + tuple(range(len(CLASH))) for i, t in ODD]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` int" for c in CLASH)
    return llm.createDataFrame(rows, schema)


@pytest.fixture()
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(llm):
    return llm.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
