"""Every operator on odd tables and on an empty one."""

import pytest
from callweave.llm import embed, jaccard, langid, licenses, line_dedup, mixing, pieces, quality, secrets, suffix
from pyspark.sql import functions as F
from tables import odd  # noqa: F401


def model(docs):
    return langid.train(docs)


OPERATORS = {
    "quality": lambda d: quality.judge(d),
    "jaccard": lambda d: jaccard.similar_sets(d),
    "jaccard_first": lambda d: jaccard.first_of_each(d),
    "mixture": lambda d: mixing.mixture(d),
    "mix": lambda d: mixing.mix(d),
    "secrets": lambda d: secrets.scan(d, None, path_col="source"),
    "licenses": lambda d: licenses.scan(d, path=F.concat("source", F.lit("/x"))),
    "lines": lambda d: line_dedup.drop_common_lines(d),
    "pieces": lambda d: pieces.decode(pieces.encode(d, pieces.read_table(pieces.MODEL)), pieces.read_table(pieces.MODEL)),
    "suffix": lambda d: suffix.without_repeats(d),
    "language": lambda d: langid.predict(d, model(d)),
}
#: Operators that return one row per row.
WHOLE = "quality jaccard mixture licenses lines pieces suffix language".split()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_table(odd, name):
    out = OPERATORS[name](odd).collect()
    if name in WHOLE:
        assert len(out) == odd.count()


def test_embeddings_empty(spark):
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, key string")).collect() == []


def test_extra_columns_pass(odd):
    for name in ("quality", "mix", "lines", "pieces", "language"):
        out = OPERATORS[name](odd)
        for c in set(odd.columns) - {"kept", "text", "score"}:
            assert out.filter(f"doc_id = 6 AND `{c}` IS NULL").count() == 0, (name, c)


def test_null_and_empty_results(odd):
    lines = {r["doc_id"]: r for r in line_dedup.drop_common_lines(odd).collect()}
    assert (lines[1]["text"], lines[1]["n_lines"], lines[1]["n_dropped"]) == ("", 1, 0)
    assert (lines[10]["text"], lines[10]["n_dropped"]) == ("own line 0", 1)
    sets = {r["doc_id"]: r for r in jaccard.similar_sets(odd).collect() if r["doc_id"] is not None}
    assert (sets[1]["n_shingles"], sets[1]["component_id"]) == (0, 1)
    assert (sets[4]["component_id"], sets[5]["component_id"]) == (4, 4)
    told = {r["doc_id"]: r for r in OPERATORS["language"](odd).collect()}
    assert [told[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    ids = {r["doc_id"]: r for r in OPERATORS["pieces"](odd).collect()}
    assert (ids[1]["ids"], ids[1]["decoded"], ids[2]["ids"], ids[2]["decoded"]) == (None, None, [], "")
    assert ids[4]["decoded"] == ids[4]["text"]
    bytes_ = {r["doc_id"]: r for r in suffix.without_repeats(odd).collect()}
    assert (bytes_[1]["n_bytes"], bytes_[5]["n_removed"]) == (0, bytes_[4]["n_bytes"])
