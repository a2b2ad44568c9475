"""The pipeline over the smallest tables, stage by stage."""

import corpus_pipeline
from corpusloom.llm.store import table


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs.write.mode("overwrite").format("noop").save()
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(last) == sizes[-1] and all(r.exact and r.n_tokens == len(r.ids) for r in last)
