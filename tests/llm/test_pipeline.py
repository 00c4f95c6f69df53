import corpus_pipeline

from test_exact import normal
from test_layout import check_packed
from test_near import brute

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        held[name] = (docs, out)
        if name != "packing":
            assert out.columns == columns
            assert out.exceptAll(docs).count() == 0
        docs = out
    before, after = (x.collect() for x in held["exact_dedup"])
    assert len(after) == len({normal(r.text) for r in before}) == len({normal(r.text) for r in after})
    before, after = (x.collect() for x in held["near_dedup"])
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute([(r.doc_id, r.text) for r in before], 5, 80)})
    check_packed(held["packing"][1].collect(), {r.doc_id: r.text for r in after})


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
