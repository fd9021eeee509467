"""Documents are shuffled only where their ids are marked."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from callweave.llm import jaccard  # noqa: E402


def test_documents_that_cannot_go_are_not_shuffled(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = [(i, f"{words} x{i}") for i in (3, 4, 5)] + [(i, " ".join(f"{i}-{k}" for k in range(30))) for i in range(10, 40)] + [(None, words), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = jaccard.first_of_each(df)
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([3, *range(10, 40), None, 7], key=str)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "getbit" in text and "LeftAnti" in text
