import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: NULLs, empty and blank texts, repeated rows, ties, special strings, other scripts.
TEXTS = [
    None, "", " \n\t ", "one", "one two three", "Hello world, it's the   end.\n\nNew line\x0b here",
    "<|endoftext|> and <|startoftext|>", "Ünï çødé — 漢字 ελληνικά ΣΑΣ İ    x\u0085y",
    "a b c d e f g h", "a b c d e f g h", "A B C D E F G H", "😀 emoji 👩‍👩‍👧 ́combining",
    "line one\nline two\nline one\n" * 30, "x" * 5000, "1234567890 " * 40, "!?!? *** ### $$$ " * 20,
]


def rows(texts=TEXTS):
    out = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s", 0)
           for i, t in enumerate(texts)]
    return [*out, out[8], (None, "no key here", "en", "s", 0), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def spark(spark):
    from chainyard.llm.common import prepared
    return prepared(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Documents with columns named like what operators add."""
    from pyspark.sql import functions as F
    names = ("n_tokens start length ids ids_crc32 fingerprint component_id score predicted kept "
             "base_failed stats__ own mean g k t fp score__ entities__ row__ at__ Shard x0").split()
    df = spark.createDataFrame(rows(), DOCS)
    return df.select("*", *[F.lit("other").alias(n) for n in names])


SMALL = "/root/testdata/sf0.001"
