import pytest
from pyspark.sql import SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("n_words long, row string, matches string, component_id long, lines string, "
            "fp string, h long, id long, pos int, rank int, score double")


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """A function from texts (or pairs of id and text) to a documents table with
    further columns whose names the operators use themselves."""
    def build(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        data = [(i, t, "en", "s", None if t is None else len(t), 1, "r", "m", 2, "l", "f", 3, 4,
                 5, 6, 0.5) for i, t in rows]
        return spark.createDataFrame(data, f"{DOCUMENT}, {CLASHING}").repartition(3)
    return build


ODD_TEXTS = [None, "", " \n\t", "a", "same text here", "same text here", "é" * 50,
             "word " * 30_000, "x" * 100_000, "1" * 20_000, "\n" * 500, "😀 \x00 \x1c ́"]


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls, empty and very long texts, ties, repeated rows and null ids."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    return documents(rows + [(4, "same text here"), (None, "same text here"), (None, None)])


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents([(1, "x")]).where("false")
