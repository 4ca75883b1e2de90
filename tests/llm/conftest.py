import pytest

from gridloom.llm import copies, mixing, near, pieces, private, quality, rules, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet, " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "the same text of a few words and the end", "en", "a", 3),
        (2, "the same text of a few words and the end", None, "b", None),
        (2, "the same text of a few words and the end", None, "b", None),
        (3, None, "en", "a", 3), (4, "", "en", None, 0), (5, " \n\t ", "en", "a", 4), (None, "no id here", "en", "a", 1),
        (6, LONG, "en", "b", 9), (7, "x" * 100_000, "en", "b", 9), (8, "a\u0000b \U0001f600 é ▁ <|endoftext|> </s>", "de", "c", 9),
        (9, "9 " * 30_000, "en", None, 9), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, DOCS)
    # Names that operators might use themselves.
    for name in ("node", "row", "sha", "size", "kept", "score", "x", "rank", "bucket", "_row", "a.b"):
        df = df.withColumn(name, df["n_chars"])
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def operators(labels):
    """Every operator over documents: name -> DataFrame -> DataFrame, a row per row."""
    return {
        "rules": rules.judge,
        "tokens": tokens.token_counts,
        "copies": copies.exact_groups,
        "pieces": pieces.encode_decode,
        "mixing": mixing.mix,
        "near": near.near_groups,
        "private": private.find_private,
        "quality": lambda df: quality.score_quality(df, quality.fit_quality(df, labels)),
    }

