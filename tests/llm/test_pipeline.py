"""The pipeline's stages on the small table, each against its own input."""

from __future__ import annotations

import corpus_pipeline as pipeline
from lakebook.scratch import materialize


def test_stages_keep_what_they_should(spark, sf_dir):
    docs, seen = pipeline.read(spark, sf_dir, "documents"), []
    for name, stage in pipeline.STAGES:
        result = materialize(stage(spark, docs, sf_dir), name)
        if name != pipeline.STAGES[-1][0]:
            assert set(result.columns) == set(pipeline.COLUMNS)
            assert result.count() == result.select("doc_id").distinct().count()
            assert result.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
            assert result.count() >= 0.8 * docs.count()
        seen.append((docs, result))
        docs = result
    before, after = seen[1]
    texts = before.groupBy("text").agg({"doc_id": "min"})
    assert after.join(texts, "text").where("doc_id > `min(doc_id)`").count() == 0
    before, after = seen[3]
    leaked = before.join(after.select("doc_id"), "doc_id", "left_anti").collect()
    items = [r.text for r in pipeline.read(spark, sf_dir, "benchmark").collect()]
    kept = after.collect()
    assert leaked and not any(item in r.text for r in kept for item in items)
    before, after = seen[4]
    assert after.select("doc_id").distinct().count() == before.count()
