"""The pipeline: every stage on what its predecessor kept, and its columns."""

import corpus_pipeline
from statlake.llm.ngram_join import jaccard_groups
from statlake.session import scratch_dir

from ..conftest import SF_SMALL
from .conftest import odd_rows


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_dir(spark, "t")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out = spark.read.parquet(path)
        if name != "packing":
            assert out.columns == columns
        if name == "quality classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            kept = {r.doc_id for r in out.collect()}
            assert all((d in kept) == (q == 1) for d, q in labels.items())
        if name == "line dedup":
            lines = [x for r in out.collect() for x in r.text.split("\n") if len(x.split()) >= 8]
            assert len(lines) == len(set(lines))
        if name == "n-gram Jaccard join":
            groups = jaccard_groups(out).collect()
            assert all(r.doc_id == r.component_id for r in groups)
        if name == "mixing sources":
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
            before = out.count()
        docs = out
    assert docs.select("doc_id").distinct().count() <= before
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).drop("sequence_id", "offset").collect())) is not None


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            if name != "packing":
                assert out.columns == docs.columns
            n = out.count()
            assert n == 0 if docs is empty else n <= 3 * len(odd_rows()) or name == "packing"
