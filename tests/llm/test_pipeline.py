"""The pipeline, stage by stage, against what each stage says of its input."""

import corpus_pipeline
from strata.llm import langid, minhash, toxicity
from strata.llm.common import table, written

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_duplicates", "packing"]
    given, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept.append(given := written(stage(spark, given, SF_DIR), "stage"))
        assert given.columns == docs.columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    model = langid.fit(langid.training_rows(docs), "doc_id", "text", "lang")
    assert ids[0] == {r.doc_id for r in langid.predict(docs, model).where("lang_pred <> 'und' AND score >= 0.5").collect()}
    chain = toxicity.fit(kept[0], table(spark, SF_DIR, "labels"))
    assert ids[1] == {r.doc_id for r in toxicity.predict(kept[0], chain).where("NOT toxic").collect()}
    found = minhash.near_duplicates(kept[1], minhash.Params())
    assert ids[2] == {r.doc_id for r in found.where("kept").collect()}
    assert len(ids[2]) < len(ids[1]) <= len(ids[0])
    packed = corpus_pipeline.STAGES[3][1](spark, kept[2], SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids[2]


def test_run(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(result.columns)
    assert result.count() > 100
