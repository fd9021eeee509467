"""Tables of the tests, as fixtures."""

import pytest

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing extra columns."""
    line = "the same line in many documents"
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (None, None, None, None, None),
        (None, "a text without an id", "en", "b", 1),
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "a", 3),
        (4, long, "en", None, 5),
        (5, long + " more", "en", None, 5),
        (6, "twice the same row\nwith two lines", "en", "a", 7),
        (6, "twice the same row\nwith two lines", "en", "a", 7),
        (7, "one id", "en", "a", 1),
        (7, "several texts", "de", "b", 2),
        *[(10 + i, f"{line}\nown line {i}", "en", "c", 9) for i in range(12)],
    ]
    names = "id key pos set part rank block kept _doc _row line score".split()
    schema = DOCS + "".join(f", {n} string" for n in names)
    return spark.createDataFrame([(*r, *names) for r in rows], schema)
