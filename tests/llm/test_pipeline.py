from collections import Counter

import corpus_pipeline

from curbline.llm import mixing, packing, pu_quality, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_chain_and_equal_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    for before, after in zip(frames[:3], frames[1:4]):
        assert after.columns == docs.columns and after.count() <= before.count()
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert ids[0] - ids[1] == {r.doc_id for r in toxicity.classify(docs, labels).collect() if r.predicted}
    assert ids[1] - ids[2] == {r.doc_id for r in pu_quality.classify(frames[1], labels).collect() if not r.predicted}
    assert ids[3] == {r.component_id for r in simhash.classes(frames[2]).collect()}
    copies = Counter({r.doc_id: r.copies for r in mixing.mix(frames[3]).collect()})
    assert Counter(r.doc_id for r in frames[4].collect()) == +copies
    assert frames[5].where("piece = 0").count() == frames[4].count()
    assert frames[5].select("sequence_id").distinct().count() <= frames[5].count()


def test_registered_queries():
    import __spark_entry__
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert packing.CAPACITY == 4096
