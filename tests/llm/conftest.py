import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# a row per case: nulls, empty, blank, one word, repeated rows, special strings, a long text
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "src0", 0),
    (3, "   \n\t ", "en", "src0", 6),
    (4, "Word", "en", None, 4),
    (5, "the of and to in that is was for it with as", "en", "src0", 44),
    (5, "the of and to in that is was for it with as", "en", "src0", 44),
    (6, "the of and to in that is was for it with as", "en", "src1", 44),
    (None, "no id here but some words that are all its own", "en", "src1", 45),
    (7, "a<|endoftext|>b  two  blanks\n\n and é日本 😀", "fr", "src1", 40),
    (8, "12345 %% ### !!", "de", "src1", 15),
    (9, " ".join(f"w{i}" for i in range(20_000)), "en", "src2", 100_000),
    (10, "x" * 5_000, "en", "src2", 5_000),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(edge):
    """Extra columns with the names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ("row", "key", "id", "bits", "score", "digest", "n_tokens", "shard", "p", "host", "path", "node", "found", "label", "posterior", "times")
    return edge.select("*", *[F.lit(1).alias(n) for n in names])
