import pytest

#: Null, empty, blank, one word, repeated rows, ties, several bytes a character, long.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It's 42 degrees!\n\nAll rights reserved.\n"),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "word"),
    (5, "word"),
    (6, "Größe naïve 東京 😀 İstanbul ﬁne space wide café café"),
    (7, "The quick brown fox jumps over the lazy dog. It's 42 degrees!\n\nAll rights reserved.\n"),
    (8, "a" * 3000),
    (9, "ab " * 4000),
    (10, "x1y2 don't we'll I'd  you're\r\nnew\x0bline \x1c sep <|endoftext|> end   "),
    (None, "no id here, licensed CC BY and the General Public License"),
    (11, "".join(chr(33 + i * 7 % 90) + (" " if i % 11 == 0 else "") for i in range(20000))),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts, under further columns whose names an operator might want for itself."""
    rows = [(k, t, "en", f"s{i}", 0, "own", 7, "own") for i, (k, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, text_hash string, _part int, ranges string").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
