import corpus_pipeline
from flowgauge.llm import exact_dedup, mixing, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages_agree_with_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    sizes = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, before, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        if name == "exact_dedup":
            kept = {r.doc_id for r in exact_dedup.mark_copies(before).filter("kept").collect()}
            assert {r.doc_id for r in after.collect()} == kept and after.count() == len(kept)
        if name == "near_dedup":
            found = simhash.near_copies(before).collect()
            assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in found})
        if name == "mix":
            taken = mixing.mix(before).agg({"_mix_taken": "sum"}).first()[0]
            assert sum(len(r.text.split()) for r in after.collect()) == taken
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        sizes[name] = after.count()
        before = after
    assert sizes["quality"] >= sizes["exact_dedup"] >= sizes["near_dedup"]
    whole = corpus_pipeline.run(spark, FOLDER)
    drop = ["sequence_id"]
    assert sorted(map(tuple, whole.drop(*drop).collect())) == sorted(map(tuple, before.drop(*drop).collect()))
    assert len({r.sequence_id for r in whole.collect()}) == whole.count()


def test_awkward_rows_pass_all_stages(spark, awkward, nothing):
    for docs in (awkward, nothing):
        at = docs
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, FOLDER)
        at.collect()
