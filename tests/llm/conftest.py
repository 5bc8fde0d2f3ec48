import pytest

from cumulo.llm.common import prepare

#: Rows that every operator must survive: NULLs, blanks, ties, repeated rows, odd characters, long texts.
TRICKY = [
    (1, "the cat sat on the mat and looked at the dog", "en"), (2, "The Cat sat on the mat AND looked at the dog", "en"),
    (2, "The Cat sat on the mat AND looked at the dog", "en"), (3, None, "en"), (4, "", None), (5, "   \n\t ", None),
    (None, "the cat sat on the mat and looked at the dog", None), (None, None, None), (6, "one two", "en"), (7, "one two", "en"),
    (8, "12 34 !!! ??", None), (9, "x" * 5000, "en"), (10, " ".join(f"word{i % 700}" for i in range(9000)), "en"),
    (11, "Straße ÄÖÜ ñandú çé 中文 😀 <|endoftext|> <|im_end|>", "de"), (12, "Straße äöü ñandú çé 中文 😀 <|endoftext|> <|im_end|>", "de"),
    (13, " ".join(f"word{i % 700}" for i in range(9000)) + " end", "en"), (14, "a\x00b \x1c\x85   c", None), (-5, "one two", "en"),
]


@pytest.fixture(scope="session")
def spark_llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def tricky(spark_llm):
    """The rows above with extra columns whose names operators use inside."""
    schema = "doc_id long, text string, lang string, node string, _id long, seed int, n long, ids string"
    return spark_llm.createDataFrame([(*r, "x", 1, 2, None, "y") for r in TRICKY], schema)


@pytest.fixture(scope="session")
def empty(tricky):
    return tricky.where("false")
