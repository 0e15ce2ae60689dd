import pytest

from millrace.llm.common import ready

CLASHING = "key string, node string, token string, block string, shard string, slot string, verdict string, score string, spans string"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture
def make(llm):
    """Documents with columns whose names operators might use themselves."""
    def docs(rows):
        data = [(i, t, "en", "s", None if t is None else len(t), *["mine"] * 9) for i, t in rows]
        return llm.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
    return docs


LONG = " ".join(f"word{i % 977}" for i in range(60_000))

#: Nulls, empty, blank, very long, repeated rows, ties, other scripts.
ODD = [(1, None), (2, ""), (3, "  \n\t\n "), (4, "one"), (5, "one two three"), (6, LONG), (7, "same text here"), (7, "same text here"),
       (7, "another text"), (None, "no id"), (None, None), (9, "äöü ßé\u0000 \U0001F600 漢字"), (10, "same text here")]
