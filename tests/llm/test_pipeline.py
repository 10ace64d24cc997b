"""The pipeline's stages: each takes effect, and all but the last keep the columns of documents."""

import corpus_pipeline
from helpers import HARD, SF, documents, empty, hard

from tapeloom.llm import jaccard, langid, pii, toxicity


def test_stages(spark, tmp_path):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    clean = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    kept = docs
    want = {
        "toxicity": lambda d: {r.doc_id for r in d.collect()} & clean,
        "language ID": lambda d: {r.doc_id for r in langid.predict(d, langid.fit(d)).where("NOT rejected").collect()},
        "n-gram Jaccard join": lambda d: {r.doc_id for r in jaccard.join(d)[0].where("doc_id = component_id").collect()},
        "PII": lambda d: {r.doc_id for r in d.collect()},
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == [*want, "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, kept, SF)
        assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert {r.doc_id for r in after.collect()} == want[name](kept), name
        if name == "PII":
            assert {(r.doc_id, r.text) for r in after.collect()} == {(r.doc_id, r.text) for r in pii.pseudonymise(kept, "tapeloom").collect()}
        kept = after
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    assert len(toxic - {r.doc_id for r in kept.collect()}) >= 0.9 * len(toxic)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() > 100


def test_stages_stand_hard_and_empty_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, a very long text, further columns of clashing names; and no rows at all."""
    again = hard(spark, [(None, "a text without an id that is long enough to be read"), (None, None), (1, HARD[0][1])])
    for name, docs in {"hard": hard(spark).unionByName(again), "empty": empty(spark)}.items():
        kept = docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            stage(spark, kept, SF).write.parquet(f"{tmp_path}/{name}{k}")
            after = spark.read.parquet(f"{tmp_path}/{name}{k}")
            assert after.columns == docs.columns and after.count() <= kept.count()
            kept = after
        texts = [r.text for r in kept.collect()]
        assert None not in texts and "" not in texts and len(texts) == len(set(texts))
        assert name != "empty" or not texts
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
        assert sum(p.start == 0 for p in packed) == len(texts)
