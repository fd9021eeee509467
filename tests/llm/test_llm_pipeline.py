"""The pipeline, stage by stage on each one's own input."""

import brute
import corpus_pipeline
from callweave.llm import langid, line_dedup
from tables import FOLDER, docs  # noqa: F401


def test_stages(spark, docs, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    at = docs
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(at)
        if name != "sentencepiece":
            assert at.columns == docs.columns
    told, lines, first, mixed, ids = seen[1:]
    wrong = langid.predict(docs, langid.model_of(docs)).filter("lang_pred = 'und' OR score < 0.5")
    assert told.count() == docs.count() - wrong.count()
    assert lines.count() == told.count()
    assert line_dedup.drop_common_lines(lines).filter("n_dropped > 0").count() == 0
    rows = [tuple(r) for r in lines.select("doc_id", "text").collect()]
    component = brute.jaccard(rows, 5, 80)
    assert {r[0] for r in first.select("doc_id").collect()} == {i for i, (_, c) in component.items() if i == c}
    assert {r[0] for r in mixed.select("doc_id").distinct().collect()} <= {r[0] for r in first.select("doc_id").collect()}
    assert ids.count() == mixed.count() and ids.filter("ids IS NULL").count() == 0
