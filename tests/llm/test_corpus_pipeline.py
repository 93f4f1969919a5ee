"""The pipeline's stages against their operators' own decisions."""

from __future__ import annotations

import corpus_pipeline


def test_stages_take_effect(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, last = docs.columns, docs
    counts = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, last, sf)
        out.write.parquet(str(tmp_path / name))
        last = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert last.columns == columns
        counts.append(last.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[3] > 0
    assert last.select("doc_id").distinct().count() == last.count()


def test_stages_on_odd_rows(spark, sf, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "word " * 80, "en", None, 400)]
    rows += [(3, " ".join(f"w{k}" for k in range(90)), "en", "a", 400)] * 2 + [(None, " ".join(f"v{k}" for k in range(90)), "en", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        last = table
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{table is docs}")
            stage(spark, last, sf).write.parquet(path)
            last = spark.read.parquet(path)
        assert last.count() <= 2
