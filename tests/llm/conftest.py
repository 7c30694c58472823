import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = "some words of a very long text, " * 4000
# nulls, empty and very long texts, repeated rows, ties, equal texts, special strings, odd characters
ROWS = [(1, "Alpha beta gamma delta", "en", "src0", 1), (2, "alpha BETA gamma delta", "en", None, 1),
        (3, None, None, None, None), (4, "", "en", "src1", 0), (5, "  \n\t ", "fr", "zzz", 5),
        (None, "no id here at all", "en", "src0", 3), (None, "no id here at all", "en", "src0", 3),
        (7, LONG, "en", "src0", 9), (8, LONG + "tail", "en", "src0", 9), (9, "naïve ÉCOLE <|endoftext|> 日本語 🤪", "fr", "src2", 1),
        (9, "another row of id nine", "de", "src2", 1), (10, "dup", "en", "src0", 3), (10, "dup", "en", "src0", 3),
        (11, "!!! 123", "en", "src0", 3), (12, "x" * 70 + " " + "you stupid idiot", "en", "src0", 3),
        (13, "tell " + "x" * 70, "en", "src0", 3)]


@pytest.fixture()
def docs(spark):
    """The odd rows, with further columns named like results."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("score", "fingerprint", "ids", "row", "g", "place", "kept", "fp",
                                                       "range", "which", "n_bytes", "recipe", "component_id")})


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
