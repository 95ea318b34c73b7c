import corpus_pipeline

from threatlens.llm import queries


def test_every_operator_is_registered_once():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_keep_columns_and_decisions_take_effect(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, sf_dir)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.dtypes == docs.dtypes
        assert 0 < after.count() <= before.count()
        before = after
    assert before.filter("not round_trip").count() == 0
    full = corpus_pipeline.run(spark, sf_dir)
    assert sorted(tuple(r) for r in full.select("doc_id", "n_ids").collect()) == sorted(tuple(r) for r in before.select("doc_id", "n_ids").collect())
