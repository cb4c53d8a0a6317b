import pytest

CLASHING = ("pos", "h", "name", "n", "key", "cls", "size", "sig", "words", "language", "line_dedup", "gone", "doc", "block", "start", "spots", "x", "of", "host", "label", "id", "v", "kept", "Text_Hash")


def documents(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns of clashing names."""
    full = [(*r, *("en", "s")[len(r) - 2 :])[:4] for r in rows]
    df = spark.createDataFrame([(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in full], "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("extra") for c in CLASHING})


#: Nulls, empty and white texts, ties, repeated rows and a very long text.
LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(60_000))
EDGES = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "one two three four five six"), (6, "one two three four five six"), (7, "one two three four five six"), (None, "no id here at all"), (None, None),
         (8, LONG), (9, LONG), (10, "a\n\nlonger line here\na\nlonger line here"), (11, "Longer Line Here \n\x0bx"), (12, "\U0001f600 é ß x 漢字"), (13, "123 !!! ---"), (6, "another text with the same id")]


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, EDGES).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [(1, "x")]).limit(0)


@pytest.fixture(scope="session")
def middle():
    return "/root/testdata/sf0.01"
